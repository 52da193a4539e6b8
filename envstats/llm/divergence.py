"""Source divergence audit (operator 13): Gustavson row accumulation.

For every language, each source's use of the language's vocabulary is compared
with the use of every other source (part ``pair``) and of the whole language
(part ``term``), by the integer triangular discrimination

    f(p, q) = floor((p - q)^2 / (p + q)),   p = 1 + floor(10^9 (count + 2) / (N + 2 V)).

``count`` is a term's count in the group, N the sum of the counts, V the
number of kept terms: those in at least ``MIN_DOCS`` documents of the language.

The sum over all kept terms for all pairs of sources is a sparse product.  The
postings (term, source, count) are dealt into blocks by a hash of the term;
inside a block they form a term-major index, and every group walks the index
rows of its own terms and scatters into one dense accumulator with a cell for
each peer (Gustavson's row order), so that a pair of postings is never a row.
A term that a group lacks still has its baseline count of 0.  These baselines
are not scattered either: with z = p(0), and T the terms of a group,

    sum f = V f(zg, zh) + [sum over T_g of f(p, zh) - f(zg, zh)]
                        + [sum over T_h of f(zg, q) - f(zg, zh)]
                        + sum over T_g and T_h of f(p, q) - f(p, zh) - f(zg, q) + f(zg, zh),

whose bracketed sums need only the histogram of a group's counts; the
accumulator holds the last line.  All arithmetic is in 64-bit integers.

Scale: tokens are counted in the scan's tasks (``ENTRIES`` terms held at most)
before one exchange by (language, term); a hot source or term is one partial
row per task.  A block holds about ``BLOCK`` postings, an accumulator one cell
per source of a language, and the result one row per ordered pair of sources.

Defined results: null text, language or source is the empty string; every row
is a document, also one that repeats; a language without kept terms has pairs
of value 0 and no terms; a language with one source has no pairs; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envstats.llm import common
from envstats.operators.joins import sized_broadcast

MIN_DOCS = 10        # documents of a language that hold a kept term
TOP_TERMS = 10       # ranks of part ``term``
ENTRIES = 500_000    # counted terms that a task holds before it passes them on
BLOCK = 100_000      # postings of one block of the index, about
SCATTER = 1 << 20    # index entries walked at once

# A-Z in lower case, a-z and all bytes of non-ASCII characters stay, a blank for all else.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32
                    for c in range(256))


def terms(text: str) -> list[bytes]:
    """The terms of a text, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, source, term, n, d): occurrences and documents, summed in the task."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def out() -> Iterator[pd.DataFrame]:
        for (lang, source), (n, d) in held.items():
            if n:
                yield pd.DataFrame({"lang": lang, "source": source, "term": list(n),
                                    "n": list(n.values()), "d": [d[t] for t in n]})
        held.clear()

    for b in batches:
        for lang, source, text in zip(b["lang"], b["source"], b["text"]):
            found = terms(text)
            n, d = held.setdefault((lang, source), (Counter(), Counter()))
            n.update(found)
            d.update(set(found))
        if sum(len(n) for n, _ in held.values()) >= ENTRIES:
            yield from out()
    yield from out()


def _share(count: Column, total: Column, size: Column) -> Column:
    """p, by long division in base 1000, so that no product leaves 64 bits."""
    a, b = count + 2, total + 2 * size
    quotient, rest = F.call_function("div", a, b), a % b
    for _ in range(3):
        quotient, rest = quotient * 1000 + F.call_function("div", rest * 1000, b), rest * 1000 % b
    return 1 + quotient


def share(count, total, size) -> np.ndarray:
    """The same in numpy."""
    a, b = np.asarray(count, np.int64) + 2, np.asarray(total, np.int64) + 2 * np.int64(size)
    quotient, rest = a // b, a % b
    for _ in range(3):
        quotient, rest = quotient * 1000 + rest * 1000 // b, rest * 1000 % b
    return 1 + quotient


def apart(p, q):
    """f: triangular discrimination of two shares, rounded down."""
    return (p - q) ** 2 // (p + q)


def scatter(group: np.ndarray, term: np.ndarray, p: np.ndarray, zero: np.ndarray
            ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(group, touched peers, sums of the last line) of one block of postings.

    ``group`` and ``term`` are numbers from 0; ``zero`` is each group's p(0).
    """
    by_term = np.argsort(term, kind="stable")
    peer, peer_p = group[by_term], p[by_term]
    row = np.zeros(term.max() + 2, np.int64)
    row[1:] = np.cumsum(np.bincount(term, minlength=len(row) - 1))
    by_group = np.argsort(group, kind="stable")
    ends = np.cumsum(np.bincount(group, minlength=len(zero)))
    for g, own in enumerate(np.split(by_group, ends[:-1])):
        acc, seen = np.zeros(len(zero), np.int64), np.zeros(len(zero), bool)
        length = row[term[own] + 1] - row[term[own]]
        cut = np.flatnonzero(np.diff(np.cumsum(length) // SCATTER)) + 1
        for mine, n in zip(np.split(own, cut), np.split(length, cut)):
            first = np.cumsum(n) - n
            at = np.arange(n.sum()) - np.repeat(first, n) + np.repeat(row[term[mine]], n)
            h, q, own_p = peer[at], peer_p[at], np.repeat(p[mine], n)
            np.add.at(acc, h, apart(own_p, q) - apart(own_p, zero[h]) - apart(zero[g], q)
                      + apart(zero[g], zero[h]))
            seen[h] = True
        seen[g] = False
        touched = np.flatnonzero(seen)
        yield g, touched, acc[touched]


def _accumulate(block: pd.DataFrame) -> pd.DataFrame:
    group, names = pd.factorize(block["source"])
    term, _ = pd.factorize(block["term"])
    zero = np.zeros(len(names), np.int64)
    zero[group] = block["zero"].to_numpy()
    got = [(g, h, v) for g, h, v in scatter(group, term, block["p"].to_numpy(), zero) if len(h)]
    none = [np.zeros(0, np.int64)]
    names = names.to_numpy() if hasattr(names, "to_numpy") else names
    return pd.DataFrame({"source": names[np.concatenate([np.full(len(h), g) for g, h, _ in got] + none)],
                         "item": names[np.concatenate([h for _, h, _ in got] + none)],
                         "value": np.concatenate([v for _, _, v in got] + none)}
                        ).assign(lang=block["lang"].iloc[0])[["lang", "source", "item", "value"]]


def _baselines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first two lines: rows (g, h) with the group's own sum and the constant,
    rows (h, g) with its sum alone; the other group's row adds the rest."""
    for b in batches:
        for lang, source, total, size, counts, times, peers, totals in b.itertuples(index=False):
            peers, totals = np.asarray(peers, object), np.asarray(totals, np.int64)
            other = peers != source
            peers, totals = peers[other], totals[other]
            if not len(peers):
                continue
            own, base = np.zeros(len(peers), np.int64), np.zeros(len(peers), np.int64)
            if size:
                z, zh = share(0, total, size), share(0, totals, size)
                base = apart(z, zh)
                times = np.asarray(times, np.int64)
                own -= times.sum() * base
                for c, m in zip(share(counts, total, size), times):
                    own += m * apart(c, zh)
            yield pd.DataFrame({"lang": lang, "source": np.append([source] * len(peers), peers),
                                "item": np.append(peers, [source] * len(peers)),
                                "value": np.append(own + size * base, own)})


def kept_terms(rows: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, of_lang, has) of the terms in ``min_docs`` documents of their
    language: counts per source and in all.  One exchange: both groupings keep
    the partitioning by (lang, term)."""
    counted = (rows.mapInPandas(_counts, "lang string, source string, term binary, n long, d long")
               .withColumn("term", F.col("term").cast("string")).repartition("lang", "term"))
    per_source = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    return (per_source.groupBy("lang", "term")
            .agg(F.collect_list(F.struct("source", "n")).alias("has"), F.sum("n").alias("of_lang"),
                 F.sum("d").alias("docs")).where(F.col("docs") >= min_docs).drop("docs"))


def postings(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
             min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """(index, groups): the kept terms' counts with all totals and shares, and
    every (lang, source) with its total N and its language's V; both written."""
    rows = common.pick(docs, lang=lang, source=source, text=text).select(
        *[common.text_of(F.col(c)).alias(c) for c in ("lang", "source", "text")])
    index = kept_terms(rows, min_docs)
    index = common.written(index.select("lang", "term", "of_lang", F.inline("has")), "terms")
    of_lang = index.groupBy("lang").agg(F.countDistinct("term").alias("size"), F.sum("n").alias("lang_total"))
    of_group = index.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(of_group, ["lang", "source"], "left")
    zero = F.lit(0).cast("long")
    groups = common.written(
        groups.join(of_lang, "lang", "left").select(
            "lang", "source", *[F.coalesce(F.col(c), zero).alias(c) for c in ("total", "size", "lang_total")]),
        "groups")
    count = F.col("n")
    index = index.join(sized_broadcast(groups), ["lang", "source"]).select(
        "lang", "source", "term", "n", _share(count, F.col("total"), F.col("size")).alias("p"),
        _share(zero, F.col("total"), F.col("size")).alias("zero"),
        _share(F.col("of_lang"), F.col("lang_total"), F.col("size")).alias("q"))
    return common.written(index, "postings"), groups


def pairs(index: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): every ordered pair of sources of a language."""
    blocks = max(1, -(-index.count() // BLOCK))
    by = ("lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block"))
    schema = "lang string, source string, item string, value long"
    met = (index.select(*by, "source", "term", "p", "zero").groupBy("lang", "block")
           .applyInPandas(_accumulate, schema))
    histogram = (index.groupBy("lang", "source", "n").agg(F.count("*").alias("times"))
                 .groupBy("lang", "source")
                 .agg(F.collect_list("n").alias("counts"), F.collect_list("times").alias("times")))
    peers = groups.groupBy("lang").agg(F.collect_list(F.struct("source", "total")).alias("peers"))
    none = F.array().cast("array<bigint>")
    rows = (groups.join(histogram, ["lang", "source"], "left").join(sized_broadcast(peers), "lang")
            .select("lang", "source", "total", "size", F.coalesce("counts", none).alias("counts"),
                    F.coalesce("times", none).alias("times"), F.col("peers.source").alias("peers"),
                    F.col("peers.total").alias("totals")))
    return (met.unionByName(rows.mapInPandas(_baselines, schema))
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
          min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source lies from each
    other source of its language, and the terms it uses most above the language."""
    index, groups = postings(docs, lang, source, text, min_docs)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    p, q = F.col("p"), F.col("q")
    above = index.where(p > q).select("lang", "source", F.col("term").alias("item"),
                                      F.call_function("div", (p - q) * (p - q), p + q).alias("value"))
    ranked = [(part, rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
               if most else rows.withColumn("rank", F.row_number().over(order)))
              for part, rows, most in (("pair", pairs(index, groups), None), ("term", above, top_terms))]
    out = [rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
           for part, rows in ranked]
    return out[0].unionByName(out[1])
