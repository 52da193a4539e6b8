"""Suffix array of many token streams with common-prefix lengths, as Spark jobs.

A stream is a row with the ids of its tokens (8 bytes each, big-endian); it ends
with a mark of its own, less than all tokens and ordered by the stream's number,
so that its suffixes end with it.  No suffix is cut and none is left out.

* Order: prefix doubling.  All suffixes are ranked by their first ``width``
  tokens; a rank is the number of smaller suffixes.  Each round ranks those that
  still tie by (own rank, rank of the suffix ``h`` tokens on) and doubles ``h``.
  A stream's ranks are one row, so the second rank is read in place; only ties
  move.  Numbers of smaller suffixes are sums inside ranges of the sorted keys
  plus the sums of the ranges before: no task holds a group, and rounds are
  logarithmic in the longest repeat.
* Common prefixes: a suffix whose preceding token is also that of its
  predecessor in the array shares one token less than the suffix before it in
  the stream does (Kaerkkaeinen, Manzini, Puglisi 2009).  Only the others, where
  repeats begin, compare tokens, up to the window that told them apart.
* Intervals: neighbours with a common prefix of ``width`` tokens or more.

Streams of groups that share no token (hosts) need no common array: the array of
a group of at most ``WHOLE`` tokens is built by one task in the same way (prefix
doubling, ties end with their streams), of several such groups at once; larger
groups go through the jobs above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envstats.llm import common
from envstats.operators.joins import sized_broadcast

ID = 8             # bytes of a token's id
PIECE = 1 << 18    # suffixes, or tokens of slices, that a task holds as rows at a time
WHOLE = 1 << 20    # tokens of a group, at most, whose array one task builds (about 200 bytes each)
BIN = 1 << 16      # tokens of a task's groups, about


def _ranged(rows: DataFrame, *by: str) -> DataFrame:
    """``rows`` sorted into ranges (``part``), written."""
    return common.written(rows.repartitionByRange(*by).withColumn(
        "part", F.spark_partition_id()), "order")


def _carried(parts: DataFrame, value: Column, name: str) -> DataFrame:
    """(part, name): ``value``, an aggregate, over the ranges before each (a row per range)."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", value.over(before).alias(name))


def _ranked(keys: DataFrame, group: str, *rest: str) -> DataFrame:
    """Distinct keys (group, *rest, n) with ``smaller``: how many of the ``n``
    counted suffixes of the same group have a smaller key, and ``head``: how many
    are in smaller groups."""
    by = [group, *rest]
    placed = _ranged(keys, *by)
    parts = placed.groupBy("part").agg(F.sum("n").alias("n"), F.min(group).alias("first"),
                                       F.max(group).alias("last"))
    offset = _carried(parts, F.sum("n"), "offset").join(parts.drop("n"), "part")
    inside = placed.join(F.broadcast(offset), "part").withColumn(
        "place", F.coalesce("offset", F.lit(0)) - F.col("n")
        + F.sum("n").over(Window.partitionBy("part").orderBy(*by)))
    inside = inside.withColumn("start", F.min("place").over(Window.partitionBy("part", group)))
    edges = (inside.where(F.col(group).isin(F.col("first"), F.col("last")))   # may cross ranges
             .groupBy(group).agg(F.min("place").alias("edge")))
    head = F.coalesce("edge", "start")
    return inside.join(F.broadcast(edges), group, "left").select(
        *by, "n", head.alias("head"), (F.col("place") - head).alias("smaller"))


def _by_stream(rows: DataFrame, found: DataFrame, value: str) -> DataFrame:
    """``rows`` with the positions (``at``) and the ``value`` found for each stream, if any."""
    lists = found.groupBy("stream").agg(F.collect_list(F.struct("at", value)).alias("found"))
    return rows.join(lists, "stream", "left").select(
        *rows.columns, F.col("found.at").alias("at"), F.col(f"found.{value}").alias("value"))


def _filled(into: np.ndarray, at: np.ndarray | None, value: np.ndarray | None) -> np.ndarray:
    """``into`` with the values of ``_by_stream`` at their positions."""
    if at is not None:
        into[at] = value
    return into


def _pieces(batches: Iterator[pd.DataFrame], size) -> Iterator[pd.DataFrame]:
    """The batches cut where ``size`` of their rows, summed, passes PIECE."""
    for b in batches:
        piece = np.cumsum([size(r) for r in b.itertuples()]) // PIECE
        for _, part in b.groupby(piece):
            yield part


def _size(ids: bytes) -> int:
    return len(ids) // ID


def _spread(streams, at: list[np.ndarray], **columns) -> pd.DataFrame:
    """A row per position of each stream."""
    none = np.zeros(0, np.int64)
    return pd.DataFrame({"stream": np.repeat(np.asarray(streams, np.int64), [len(a) for a in at]),
                         "at": np.concatenate([none, *at]),
                         **{k: np.concatenate([none, *v]) for k, v in columns.items()}})


def ranks(streams: DataFrame, width: int) -> DataFrame:
    """(stream, rank, seen) of each stream: ``rank`` is the place of each
    suffix in the array (that of the first of those equal to their streams' ends),
    ``seen`` the window that told it apart."""

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _pieces(batches, lambda r: _size(r.ids)):
            at = [np.arange(_size(s)) for s in b["ids"]]
            yield _spread(b["stream"], at).assign(key=[
                s[ID * i:ID * (i + width)] for s, a in zip(b["ids"], at) for i in a])

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({
                "stream": b["stream"],
                "rank": [_filled(np.zeros(_size(s), np.int64), a, v)
                         for s, a, v in zip(b["ids"], b["at"], b["value"])],
                "seen": [np.full(_size(s), width, np.int64) for s in b["ids"]]})

    state = "stream long, rank array<long>, seen array<long>"
    cut = streams.mapInPandas(windows, "stream long, at long, key binary")
    keys = _ranked(cut.groupBy("key").agg(F.count("*").alias("n")), "key")
    ties = (F.col("n") > 1) & (F.length("key") == width * ID)
    found = cut.join(keys, "key").select(
        "stream", "at", F.when(ties, F.col("head")).otherwise(F.bitwise_not("head")).alias("rank"))
    # ranks of suffixes that are in place are stored as their complement
    now = common.written(_by_stream(streams.select("stream", "ids"), found, "rank")
                         .mapInPandas(first, state), "ranks")
    h = width
    while True:
        def tied(batches: Iterator[pd.DataFrame], h: int = h) -> Iterator[pd.DataFrame]:
            for b in _pieces(batches, lambda r: len(r.rank)):
                at = [np.flatnonzero(r >= 0) for r in b["rank"]]
                place = [np.append(np.where(r < 0, ~r, r), np.full(h, -1)) for r in b["rank"]]
                yield _spread(b["stream"], at, own=[p[a] for p, a in zip(place, at)],
                              later=[p[a + h] for p, a in zip(place, at)])

        def moved(batches: Iterator[pd.DataFrame], h: int = h) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({
                    "stream": b["stream"],
                    "rank": [_filled(r.copy(), a, v) for r, a, v in zip(b["rank"], b["at"], b["value"])],
                    "seen": [np.where(r >= 0, 2 * h, s) for r, s in zip(b["rank"], b["seen"])]})

        with common.passing(streams.sparkSession):
            open_ = common.written(now.select("stream", "rank").mapInPandas(
                tied, "stream long, at long, own long, later long"), "ties")
            if not open_.limit(1).count():
                return now.withColumn("rank", F.transform("rank", lambda r: F.bitwise_not(r)))
            keys = _ranked(open_.groupBy("own", "later").agg(F.count("*").alias("n")), "own", "later")
            place = F.col("own") + F.col("smaller")
            ties = (F.col("n") > 1) & (F.col("later") >= 0)
            found = open_.join(sized_broadcast(keys), ["own", "later"]).select(
                "stream", "at", F.when(ties, place).otherwise(F.bitwise_not(place)).alias("rank"))
            now = common.written(_by_stream(now, found, "rank").mapInPandas(moved, state), "ranks")
        h *= 2


def common_prefixes(streams: DataFrame, places: DataFrame) -> DataFrame:
    """(stream, rank, lcp), written: of each suffix, tokens shared with its predecessor in the array."""

    def suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _pieces(batches, lambda r: _size(r.ids)):
            ids = [np.frombuffer(s, ">i8").astype(np.int64) for s in b["ids"]]
            yield _spread(b["stream"], [np.arange(len(i)) for i in ids],
                          rank=list(b["rank"]), seen=list(b["seen"]),
                          before=[np.roll(i, 1) for i in ids])

    def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            asked = {c: np.concatenate(list(b[c])) for c in ("stream", "at", "here", "most") if len(b)}
            rows = pd.DataFrame({**asked, "ids": np.repeat(b["ids"].to_numpy(object), [len(a) for a in b["at"]])})
            for _, r in rows.groupby(np.cumsum(rows["most"].to_numpy()) // PIECE) if len(rows) else ():
                yield r[["stream", "at"]].assign(slice=[
                    s[ID * i:ID * (i + n)] for s, i, n in zip(r["ids"], r["here"], r["most"])])

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            lcp = []
            for x, y in b["slices"]:
                n = min(len(x), len(y)) // ID
                differ = np.frombuffer(x, np.int64, n) != np.frombuffer(y, np.int64, n)
                lcp.append(int(differ.argmax()) if differ.any() else n)
            yield pd.DataFrame({"stream": b["stream"], "at": b["at"],
                                "lcp": np.array(lcp, np.int64)})

    def inferred(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for s, begin, value in zip(b["ids"], b["at"], b["value"]):
                at = np.arange(_size(s))
                lcp = _filled(np.full(len(at), -1), begin, value)
                source = np.maximum.accumulate(np.where(lcp >= 0, at, 0))
                out.append(lcp[source] - (at - source))
            yield pd.DataFrame({"stream": b["stream"], "rank": b["rank"], "lcp": out})

    ranked = streams.select("stream", "ids").join(places, "stream")
    sorted_ = _ranged(ranked.mapInPandas(
        suffixes, "stream long, at long, rank long, seen long, before long"), "rank", "stream")
    entry = F.struct("rank", "stream", "at", "seen", "before")
    ends = sorted_.groupBy("part").agg(F.max(entry).alias("end"))
    lag = F.lag(entry).over(Window.partitionBy("part").orderBy("rank", "stream"))
    prev = F.coalesce("inside", "end")
    pairs = (sorted_.withColumn("inside", lag)
             .join(F.broadcast(_carried(ends, F.max("end"), "end")), "part").withColumn("prev", prev))
    begins = common.written(
        pairs.where(F.col("prev").isNull() | (F.col("at") == 0) | (F.col("prev.at") == 0)
                    | (F.col("before") != F.col("prev.before")))
        .select("stream", "at", "prev", F.least("seen", "prev.seen").alias("most")), "begins")
    asked = begins.where("prev IS NOT NULL").select(F.explode(F.array(
        F.struct("stream", F.struct("stream", "at", F.col("at").alias("here"), "most").alias("x")),
        F.struct(F.col("prev.stream"), F.struct(
            "stream", "at", F.col("prev.at").alias("here"), "most").alias("x")))).alias("q"))
    asked = asked.select("q.*").groupBy("stream").agg(F.collect_list("x").alias("asked"))
    told = (streams.select("stream", "ids").join(asked, "stream")
            .select("ids", *[F.col(f"asked.{c}").alias(c) for c in ("stream", "at", "here", "most")])
            .mapInPandas(slices, "stream long, at long, slice binary")
            .groupBy("stream", "at").agg(F.collect_list("slice").alias("slices"))
            .mapInPandas(compared, "stream long, at long, lcp long"))
    told = told.union(begins.where("prev IS NULL").select("stream", "at", F.lit(0).cast("long")))
    return common.written(_by_stream(ranked.select("stream", "ids", "rank"), told, "lcp").mapInPandas(
        inferred, "stream long, rank array<long>, lcp array<long>"), "prefixes")


def intervals(streams: DataFrame, width: int) -> DataFrame:
    """(stream, at, rank, lcp, interval) of every suffix of (stream, ids):
    neighbours that share ``width`` tokens or more have the same interval."""
    with common.passing(streams.sparkSession):
        arrays = common_prefixes(streams, ranks(streams, width))
    rows = arrays.select("stream", F.size("rank").alias("n"),
                         F.posexplode(F.arrays_zip("rank", "lcp")).alias("at", "x"))
    sorted_ = _ranged(rows.select("stream", F.col("at").cast("long").alias("at"), "x.rank", "x.lcp",
                                  (F.col("n") - F.col("at")).cast("long").alias("rest")), "rank", "stream")
    begin = F.when(F.col("lcp") < width, F.struct("rank", "stream"))
    parts = sorted_.groupBy("part").agg(F.max(begin).alias("begin"))
    inside = F.max(begin).over(Window.partitionBy("part").orderBy("rank", "stream"))
    return (sorted_.withColumn("inside", inside)
            .join(F.broadcast(_carried(parts, F.max("begin"), "begin")), "part")
            .select("stream", "at", "rank", "lcp", "rest", F.coalesce("inside", "begin").alias("interval")))


def array_of(streams: np.ndarray, ids: list[bytes], width: int) -> pd.DataFrame:
    """The rows of ``intervals`` of a few streams, in the array's order."""
    sizes = np.array([_size(s) for s in ids], np.int64)
    owner = np.repeat(np.asarray(streams, np.int64), sizes)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rest = np.repeat(sizes, sizes) - at
    if not len(owner):
        return pd.DataFrame({c: at for c in ("stream", "at", "rank", "lcp", "rest", "first", "of")})
    every = np.frombuffer(b"".join(ids), f">u{ID}")
    here = np.arange(len(owner))
    levels = [np.unique(every, return_inverse=True)[1].astype(np.int64) + 1]     # 0 is a stream's end
    while True:                                     # by 1, 2, 4, ... tokens, until nothing more differs
        now, h = levels[-1], 1 << (len(levels) - 1)
        later = np.where(rest > h, now[np.minimum(here + h, len(here) - 1)], 0)
        kinds, finer = np.unique(now * (len(here) + 1) + later, return_inverse=True)
        if len(kinds) == now.max():
            break
        levels.append(finer.astype(np.int64) + 1)
    order = np.lexsort((owner, now))
    placed = now[order]
    x, y = order[1:], order[:-1]
    least = np.minimum(rest[x], rest[y])
    same = placed[1:] == placed[:-1]
    shared = np.where(same, least, 0)
    for k in reversed(range(len(levels) - 1)):
        more = ~same & (shared < least)
        i, j = (np.minimum(z + shared, len(here) - 1) for z in (x, y))
        more &= levels[k][i] == levels[k][j]
        shared += np.where(more, np.minimum(1 << k, least - shared), 0)
    lcp = np.concatenate([[0], shared])
    rank = np.searchsorted(placed, placed)
    begin = np.maximum.accumulate(np.where(lcp < width, here, 0))
    return pd.DataFrame({"stream": owner[order], "at": at[order], "rank": rank, "lcp": lcp, "rest": rest[order],
                         "first": rank[begin], "of": owner[order][begin]})


def group_intervals(streams: DataFrame, width: int, group: str) -> DataFrame:
    """``intervals`` of written (group, stream, ids), where groups share no token: an
    array for each large group or for some small ones, in which its ranks count."""
    tokens = streams.groupBy(group).agg(F.sum(F.length("ids") / ID).alias("n"))
    large = tokens.where(F.col("n") > WHOLE).select(group)
    few = streams.join(F.broadcast(large), group, "left_anti")          # a row per WHOLE tokens at most
    total = tokens.where(F.col("n") <= WHOLE).agg(F.sum("n")).first()[0] or 0

    def arrays(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("group", kind="stable")
        ends = rows["ids"].map(_size).groupby(rows["group"]).sum().cumsum() // PIECE    # whole groups
        return pd.concat([array_of(r["stream"].to_numpy(), list(r["ids"]), width)
                          for _, r in rows.groupby(rows["group"].map(ends))])

    names = ("stream", "at", "rank", "lcp", "rest", "first", "of")
    made = (few.withColumn("group", F.xxhash64(group))
            .withColumn("bin", F.pmod("group", F.lit(int(total) // BIN + 1)))
            .groupBy("bin").applyInPandas(lambda rows: arrays(rows)[list(names)],
                                          ", ".join(f"{c} long" for c in names)))
    made = made.select(*names[:-2], F.struct(F.col("first").alias("rank"), F.col("of").alias("stream")).alias("interval"))
    if not large.limit(1).count():
        return made
    rest = streams.join(F.broadcast(large), group, "left_semi")
    return made.unionByName(intervals(common.written(rest.select("stream", "ids"), "large"), width))
