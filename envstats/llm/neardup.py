"""Near-duplicates (operator 7): MinHash bands, odd sketches, exact check.

A document is the set of its distinct 5-word shingles.  Documents with equal
sets form one class before anything is paired, so copies cost one row each.
For the classes:

1. ``SAMPLES`` MinHash values in bands of ``band_rows(like)`` give band
   hashes; two sets of the wanted similarity share no band with probability
   below ``MISSED`` (30 bands of 6 for 0.85, 36 of 5 for 0.8).
2. All MinHash samples are folded into an odd sketch: sample (i, value)
   toggles one of ``BITS`` parity bits.  The population count of the XOR of
   two sketches estimates how many samples differ, precisely at high
   similarity; a candidate pair with more than ``most_bits(like)`` odd bits (4.5
   standard deviations above what the wanted similarity gives) is dropped.  A second
   odd sketch of ``WHOLE`` bits folds every shingle: its count never exceeds
   the number of shingles that differ, so for small sets it drops exactly,
   and for large ones at 4.5 standard deviations, what cannot be linked.
3. Candidates, first round: each class of a bucket with the bucket's smallest
   class - a star, not all pairs.  Pairs inside a component cannot change it,
   so a bucket of near copies costs as many pairs as it has classes.
4. Second round, for buckets whose classes are not yet in one component: each
   class outside the bucket's largest component with the classes of the other
   components and of its own or the next range of set sizes, joined under both
   sketch conditions, so pairs that cannot be linked are never made.
5. Every pair is confirmed on the full sets (64-bit shingle hashes):
   ``100 * intersection >= like * union``; ``like`` is 85 unless the caller
   sets another (the pipeline's stage: 80).

Components are found by alternating stars over the confirmed links.

Defined results: a text of fewer than five words is its whole sequence as one
shingle; a null, empty or blank text has the empty set and is linked with
nothing; equal texts under one id (repeated rows) get equal results; a null
id is never the smallest id (a component of null ids alone has a null id and
is kept); an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstats.llm import common
from envstats.llm.components import components
from envstats.operators.joins import sized_broadcast

WORDS = 5                  # words of a shingle
LIKE, OF = 85, 100         # linked when OF * intersection >= like * union; the default
SAMPLES = 180              # MinHash values of a set
MISSED = 1e-6              # chance that a link at the threshold shares no band, at most
BITS = 512                 # of an odd sketch
PARTNERS = 64              # sets that meet a class's set in one row
WHOLE = 1024               # bits of the odd sketch of all shingles
DEVIATIONS = 4.5           # standard deviations of its count that are allowed for
CACHED = 200_000           # words kept per worker (memory bound)
CHUNK_CHARS = 1_500_000
_LOWER = bytes(range(256)).translate(None).replace(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240229)
_FACTORS = _rng.integers(0, 2**63, SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = _rng.integers(0, 2**63, SAMPLES, np.uint64)


def band_rows(like: int = LIKE) -> int:
    """MinHash values of a band: the most at which links are not missed."""
    return next(r for r in range(SAMPLES, 0, -1)
                if (1 - (like / OF)**r)**(SAMPLES // r) < MISSED)


def most_bits(like: int = LIKE) -> int:
    """Odd bits of the sketches of a pair of similarity ``like``, at most (in eights)."""
    differ = SAMPLES * (1 - like / OF)                     # samples; each toggles two bits
    even = (1 - 2 / BITS)**(2 * differ)
    odd = BITS * (1 - even) / 2
    each = BITS * even * 2 / BITS                          # odd bits of one more sample
    spread = (odd * (1 - odd / BITS) + each**2 * differ * like / OF)**0.5
    return 8 * math.ceil((odd + DEVIATIONS * spread) / 8)


MOST_BITS = most_bits()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class Shingles:
    """Distinct shingle hashes of texts; a word is hashed once per worker."""

    def __init__(self):
        self.cache: dict[bytes, int] = {}

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, hash), ascending and distinct."""
        words = [t.encode().translate(_LOWER).split() for t in texts]
        cache = self.cache
        if len(cache) > CACHED:
            cache.clear()
        for w in set(chain.from_iterable(words)) - cache.keys():
            cache[w] = xxhash.xxh64_intdigest(w)
        n = np.fromiter(map(len, words), np.int64, len(words))
        h = np.fromiter(map(cache.__getitem__, chain.from_iterable(words)), np.uint64, int(n.sum()))
        doc = np.repeat(np.arange(len(words)), n)
        rows = max(0, len(h) - WORDS + 1)
        value = np.zeros(rows, np.uint64)
        for j in range(WORDS):
            value = value * _MIX + h[j:j + rows]
        inside = doc[:rows] == doc[WORDS - 1:]
        value, owner = value[inside], doc[:rows][inside]
        short = np.flatnonzero((n > 0) & (n < WORDS))
        if len(short):
            starts = np.cumsum(n) - n
            whole = []
            for d in short:
                v = int(n[d])
                for w in h[starts[d]:starts[d] + n[d]].tolist():
                    v = (v * int(_MIX) + w) % 2**64
                whole.append(v)
            value = np.concatenate([value, np.array(whole, np.uint64)])
            owner = np.concatenate([owner, short])
        value = _mixed(value)
        order = np.lexsort((value, owner))
        value, owner = value[order], owner[order]
        first = np.append(True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1]))[:len(value)]
        return owner[first], value[first]


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= CHUNK_CHARS:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def sketch(value: np.ndarray, starts: np.ndarray,
           like: int = LIKE) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes and odd sketches of the sets that begin at ``starts``."""
    sets, of_band = len(starts), band_rows(like)
    count = SAMPLES // of_band
    bands = np.zeros((count, sets), np.uint64)
    odd = np.zeros((sets, BITS), bool)
    rows = np.arange(sets)
    for i in range(SAMPLES):
        least = np.minimum.reduceat(value * _FACTORS[i], starts)
        sample = _mixed(least ^ _SALTS[i])
        odd[rows, (sample % np.uint64(BITS)).astype(np.int64)] ^= True
        if i < count * of_band:
            bands[i // of_band] = bands[i // of_band] * _MIX + sample
    bands = _mixed(bands + np.arange(count, dtype=np.uint64)[:, None])
    return (bands.T.astype(np.int64),
            np.packbits(odd, 1, "little").view(np.int64))


def parity(owner: np.ndarray, value: np.ndarray, sets: int) -> np.ndarray:
    """Odd sketches (WHOLE bits) of all values of each set."""
    bit = owner * WHOLE + (value >> np.uint64(20) & np.uint64(WHOLE - 1)).astype(np.int64)
    odd = np.bincount(bit, minlength=sets * WHOLE).reshape(sets, WHOLE) & 1
    return np.packbits(odd.astype(bool), 1, "little").view(np.int64)


def features(docs: DataFrame, key: str = "doc_id", text: str = "text",
             like: int = LIKE) -> DataFrame:
    """(key, sig, n, cid, bands, odd, whole) of every row: text hash, set size,
    class of equal sets, band hashes and odd sketches (empty sets have none)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Shingles()
        for b in batches:
            texts = b["text"].tolist()
            for lo, hi in _chunks(texts):
                owner, value = of(texts[lo:hi])
                n = np.bincount(owner, minlength=hi - lo)
                full = np.flatnonzero(n)
                starts = np.searchsorted(owner, full)
                cid = np.zeros(hi - lo, np.uint64)
                bands, odd, whole = ([None] * (hi - lo) for _ in range(3))
                if len(full):
                    two = [np.add.reduceat(_mixed(value ^ s), starts) for s in _SALTS[:2]]
                    cid[full] = _mixed(two[0] ^ _mixed(two[1] + n[full].astype(np.uint64)))
                    every = parity(np.searchsorted(full, owner), value, len(full))
                    for i, x, y, z in zip(full, *sketch(value, starts, like), every):
                        bands[i], odd[i], whole[i] = x, y, z
                yield pd.DataFrame({"key": b["key"].iloc[lo:hi], "sig": b["sig"].iloc[lo:hi],
                                    "n": n, "cid": cid.astype(np.int64),
                                    "bands": pd.Series(bands, b.index[lo:hi], object),
                                    "odd": pd.Series(odd, b.index[lo:hi], object),
                                    "whole": pd.Series(whole, b.index[lo:hi], object)})

    rows = common.pick(docs, key=key, text=text).withColumn("text", common.text_of(F.col("text")))
    rows = rows.withColumn("sig", F.xxhash64("text"))
    return common.through_python(
        rows, run, "sig long, n long, cid long, bands array<long>, odd array<long>, "
                   "whole array<long>")


def odd_bits(a: Column, b: Column, bits: int = BITS) -> Column:
    """Population count of the XOR of two sketches."""
    return reduce(lambda x, y: x + y,
                  [F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(bits // 64)])


def may_link(x: str, y: str, like: int = LIKE) -> Column:
    """Whether the sketches of classes ``x`` and ``y`` (aliases) allow a link."""
    both = F.col(f"{x}.n") + F.col(f"{y}.n")
    differ = F.floor(both * (OF - like) / (OF + like))     # shingles that may differ at most
    odd = (1 - F.pow(F.lit(1 - 2 / WHOLE), differ)) / 2    # chance that a bit is odd then
    most = WHOLE * odd + DEVIATIONS * F.sqrt(WHOLE * odd * (1 - odd))
    return ((OF * F.least(f"{x}.n", f"{y}.n") >= like * F.greatest(f"{x}.n", f"{y}.n"))
            & (odd_bits(F.col(f"{x}.whole"), F.col(f"{y}.whole"), WHOLE) <= F.least(differ, most))
            & (odd_bits(F.col(f"{x}.odd"), F.col(f"{y}.odd")) <= most_bits(like)))


def _sets(cids: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """(cid, held): the full shingle sets of some classes, from one text each."""
    who = classes.join(cids.distinct(), "cid", "left_semi").select("cid", F.col("first.*"))
    rows = common.pick(docs, key=key, text=text).withColumn("text", common.text_of(F.col("text")))
    rows = rows.withColumn("sig", F.xxhash64("text"))
    picked = rows.alias("d").join(
        sized_broadcast(who).alias("w"), (F.col("d.sig") == F.col("w.sig"))
        & F.col("d.key").eqNullSafe(F.col("w.key"))).select("cid", "text")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Shingles()
        for b in batches:
            texts = b["text"].tolist()
            for lo, hi in _chunks(texts):
                owner, value = of(texts[lo:hi])
                cut, value = np.searchsorted(owner, np.arange(hi - lo + 1)), value.view(np.int64)
                yield pd.DataFrame({"cid": b["cid"].iloc[lo:hi], "held": pd.Series(
                    [value[x:y] for x, y in zip(cut[:-1], cut[1:])], b.index[lo:hi], object)})

    return common.written(picked.mapInPandas(sets, "cid long, held array<long>")
                          .dropDuplicates(["cid"]), "sets")


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, key: str,
               text: str, like: int) -> DataFrame:
    """Pairs (a, b) of classes whose full sets are similar enough."""
    held = _sets(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")),
                 classes, docs, key, text)

    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).alias("parts"))
    dealt = pairs.join(sizes, "a").withColumn("part", F.pmod(F.xxhash64("b"), "parts"))
    met = (dealt.select("a", "b", "part").join(held.toDF("b", "hb"), "b")
           .groupBy("a", "part").agg(F.collect_list("b").alias("b"), F.collect_list("hb").alias("hb"))
           .join(held.toDF("a", "ha"), "a"))          # a set once for PARTNERS partners, however many it has

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, names, sets, own in zip(batch["a"], batch["b"], batch["hb"], batch["ha"]):
                both = np.array([len(np.intersect1d(x, own, True)) for x in sets], np.int64)
                size = np.fromiter(map(len, sets), np.int64, len(sets)) + len(own)
                yield pd.DataFrame({"a": a, "b": np.asarray(names, np.int64)[OF * both >= like * (size - both)]})

    return met.select("a", "b", "hb", "ha").mapInPandas(check, "a long, b long")


def _sketched(pairs: DataFrame, classes: DataFrame, like: int) -> DataFrame:
    """Pairs (a, b) whose sketches allow a link."""
    side = classes.select("cid", "n", "odd", "whole")
    met = (pairs.join(side.alias("x"), F.col("a") == F.col("x.cid"))
           .join(side.alias("y"), (F.col("b") == F.col("y.cid")) & may_link("x", "y", like)))
    return met.select("a", "b")


def group(docs: DataFrame, key: str = "doc_id", text: str = "text",
          like: int = LIKE) -> DataFrame:
    """(key, sig, n_shingles, component_id, kept) of every row; texts are linked
    from a similarity of ``like`` hundredths on."""
    made = common.written(features(docs, key, text, like), "features")
    classes = common.written(
        made.where("n > 0").groupBy("cid")
        .agg(F.min(F.when(F.col("key").isNotNull(), F.struct("key", "sig"))).alias("keyed"),
             F.min(F.struct("key", "sig")).alias("unkeyed"),
             *[F.first(c).alias(c) for c in ("n", "bands", "odd", "whole")])
        .select("cid", F.coalesce("keyed", "unkeyed").alias("first"), "n", "bands", "odd", "whole"),
        "classes")
    banded = classes.select("cid", F.explode("bands").alias("bucket"))
    shared = (banded.groupBy("bucket").agg(F.min("cid").alias("pivot"), F.count("*").alias("n"))
              .where("n > 1").drop("n"))
    members = common.written(banded.join(shared.hint("merge"), "bucket"), "buckets")
    first = common.written(
        _sketched(members.where("cid <> pivot").select(F.col("pivot").alias("a"),   # a < b
                                                       F.col("cid").alias("b")).distinct(),
                  classes, like), "pairs")
    links = common.written(_confirmed(first, classes, docs, key, text, like), "links")
    linked = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    more = common.written(_rest(members, linked, first, classes, like), "pairs")
    if more.limit(1).count():
        again = common.written(_confirmed(more, classes, docs, key, text, like), "links")
        linked = components(links.union(again).select(F.col("a").alias("u"), F.col("b").alias("v")))
    of = classes.select("cid", F.col("first.key").alias("least")).join(
        linked.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
        "component", F.coalesce("component", "cid"))
    least = of.groupBy("component").agg(F.min("least").alias("component_id"))
    named = of.join(least.hint("merge"), "component").select("cid", "component_id")
    out = made.where("n > 0").select("key", "sig", "n", "cid").join(
        named.hint("merge"), "cid").select("key", "sig", "n", "component_id")
    out = out.union(made.where("n = 0").select("key", "sig", "n", "key"))
    return out.select("key", "sig", F.col("n").alias("n_shingles"), "component_id",
                      F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))


def _rest(members: DataFrame, linked: DataFrame, tested: DataFrame,
          classes: DataFrame, like: int) -> DataFrame:
    """Untested pairs across components in one bucket that may be linked."""
    label = linked.withColumnRenamed("node", "cid")
    placed = members.select("bucket", "cid").join(label, "cid", "left").withColumn(
        "component", F.coalesce("component", "cid"))
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("members"))
    split = (sizes.groupBy("bucket")
             .agg(F.max_by("component", F.struct("members", "component")).alias("largest"),
                  F.count("*").alias("parts")).where("parts > 1").drop("parts"))
    # sets of one band meet only in the same or the next range of sizes: a factor
    # of OF / like holds all that two linked sets can differ by
    step = math.log(OF / like) * (1 + 1e-9) + 1e-9
    open_ = (placed.join(split, "bucket").join(classes.select("cid", "n", "odd", "whole"), "cid")
             .withColumn("size", F.floor(F.log(F.col("n").cast("double")) / step)))
    near = F.array(*[F.col("size") + k for k in (-1, 0, 1)])
    a = open_.where("component <> largest").withColumn("size", F.explode(near)).alias("x")
    b = open_.alias("y")
    met = a.join(b, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.size") == F.col("y.size"))
                 & (F.col("x.component") != F.col("y.component")) & may_link("x", "y", like))
    pairs = met.select(F.least("x.cid", "y.cid").alias("a"),
                       F.greatest("x.cid", "y.cid").alias("b")).distinct()
    return pairs.join(tested, ["a", "b"], "left_anti")


def members(grouped: DataFrame) -> DataFrame:
    """The query's columns."""
    return grouped.select(F.col("key").alias("doc_id"), "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text",
             like: int = LIKE) -> DataFrame:
    """``docs`` with one document of each group: the smallest id (of rows that
    repeat entirely, one)."""
    grouped = common.written(group(docs, key, text, like), "groups")
    gone = sized_broadcast(grouped.where(~F.col("kept")).select("key", "sig").distinct())
    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    k, t = (F.col(f"_c{common.position(docs, c)}") for c in (key, text))
    out = plain.join(gone, k.eqNullSafe(F.col("key"))
                     & (F.xxhash64(common.text_of(t)) == F.col("sig")), "left_anti")
    repeated = grouped.where("kept").groupBy("key", "sig").count().where("count > 1").limit(1).count()
    return (out.dropDuplicates() if repeated else out).toDF(*docs.columns)
