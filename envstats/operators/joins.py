"""Dimension joins and repair (JON-1..4, FIX-1).

A dimension is broadcast only after a bounded check of its size: the check
reads at most ``max_rows + 1`` rows, counting them and measuring the bytes
of their text values, so it costs little even when the dimension turns out
to be large.  Beyond the bound the join is left to a
shuffle join, where adaptive execution splits skewed fact partitions
(a hot key holding a third of the rows is split across tasks, not kept in
one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DateType, DoubleType,
                               FloatType, IntegerType, LongType, ShortType,
                               StructType, TimestampNTZType, TimestampType)

from envstats.session import data_version

BROADCAST_BUDGET_BYTES = 64 * 1024 * 1024
_FIXED_WIDTH = {LongType: 8, DoubleType: 8, IntegerType: 4, FloatType: 4, DateType: 4,
                ShortType: 2, ByteType: 1, BooleanType: 1, TimestampType: 8,
                TimestampNTZType: 8}
_ROW_OVERHEAD = 16


def _fixed_row_bytes(schema: StructType) -> int:
    return _ROW_OVERHEAD + sum(_FIXED_WIDTH.get(type(f.dataType), 0) for f in schema.fields)


def broadcast_row_limit(df: DataFrame, budget_bytes: int = BROADCAST_BUDGET_BYTES) -> int:
    """Most rows that can fit the budget (fixed-width part of a row only)."""
    return max(1, budget_bytes // _fixed_row_bytes(df.schema))


_PROVEN: dict = {}


def fits_broadcast(df: DataFrame, max_rows: int | None = None, cache_key=None,
                   budget_bytes: int = BROADCAST_BUDGET_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and its measured size is
    within ``budget_bytes`` (bounded check).

    One aggregate over at most ``limit + 1`` rows counts them and sums the
    bytes of every variable-width value (strings, binaries, nested values as
    text), so a dimension with long text is measured, not guessed.  The
    check reads a bounded number of rows even when the table is huge.
    ``cache_key`` names the derivation of ``df``; the result of the check is
    then reused in this process while the files that ``df`` reads are the
    same (paths, sizes, modification times): a table that grows is checked
    again.
    """
    limit = broadcast_row_limit(df, budget_bytes) if max_rows is None else int(max_rows)
    if cache_key is not None:
        cache_key = (cache_key, data_version(df), limit, budget_bytes)
        if cache_key in _PROVEN:
            return _PROVEN[cache_key]
    var_cols = [f.name for f in df.schema.fields if type(f.dataType) not in _FIXED_WIDTH]
    aggs = [F.count(F.lit(1)).alias("n")]
    if var_cols:
        width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
                     for c in var_cols), F.lit(0))
        aggs.append(F.sum(width.cast("long")).alias("var_bytes"))
    r = df.limit(limit + 1).agg(*aggs).first()
    n, var_bytes = r["n"], (r["var_bytes"] or 0) if var_cols else 0
    ok = n <= limit and n * _fixed_row_bytes(df.schema) + var_bytes <= budget_bytes
    if cache_key is not None:
        _PROVEN[cache_key] = ok
    return ok


def sized_broadcast(df: DataFrame, max_rows: int | None = None, cache_key=None) -> DataFrame:
    """``F.broadcast(df)`` if its size is proven small, else ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, cache_key) else df


def join_dimension(fact: DataFrame, dim: DataFrame, key: str | list[str] = "fips",
                   how: str = "left", max_rows: int | None = None, cache_key=None) -> DataFrame:
    """Fact <- dimension equi-join on a using key (one key column out) (JON-1/2)."""
    return fact.join(sized_broadcast(dim, max_rows, cache_key), on=key, how=how)


def unmatched_keys(fact: DataFrame, dim: DataFrame, key: str = "fips",
                   max_rows: int | None = None) -> DataFrame:
    """Distinct fact keys with no dimension row (JON-3, AGG-5).

    Keys are made distinct first (partial aggregation collapses hot keys in
    the map stage), then anti-joined.
    """
    keys = fact.select(key).where(F.col(key).isNotNull()).distinct()
    return keys.join(sized_broadcast(dim.select(key), max_rows), on=key, how="left_anti")


def unmatched_after_join(joined: DataFrame, probe: str, key: str = "fips") -> DataFrame:
    """Keys whose joined ``probe`` column is null (the null-probe form of JON-3)."""
    return joined.where(F.col(probe).isNull()).select(key).distinct()


def duplicate_keys(dim: DataFrame, key: str | list[str] = "fips") -> DataFrame:
    """Dimension keys that occur more than once (JON-4); empty = no fan-out."""
    keys = [key] if isinstance(key, str) else list(key)
    return (dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
               .where(F.col("n_rows") > 1))


def join_coverage(fact: DataFrame, joined: DataFrame) -> DataFrame:
    """Row counts before and after a left join (JON-4), long form (stage, n_rows)."""
    a = fact.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("before").alias("stage"), "n_rows")
    b = joined.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("after").alias("stage"), "n_rows")
    return a.unionByName(b)


def left_join_coverage(fact: DataFrame, dims, key: str = "fips",
                       max_rows: int | None = None) -> DataFrame:
    """Row counts before and after left-joining ``fact`` with each of ``dims``
    on ``key`` (JON-4), long form (stage, n_rows), in one pass over the fact.

    A left join gives each fact row max(1, number of dimension rows with its
    key) output rows, so per dimension only the key counts are needed: one
    row per dimension key, joined with a size-checked broadcast.  The
    product of the multiplicities, summed, is the row count after all the
    joins; no joined row is built.
    """
    f = fact.select(key)
    mult = F.lit(1).cast("long")
    for i, d in enumerate(dims):
        n = f"__n{i}"
        kc = d.groupBy(key).agg(F.count(F.lit(1)).alias(n))
        f = f.join(sized_broadcast(kc, max_rows), on=key, how="left")
        mult = mult * F.greatest(F.coalesce(F.col(n), F.lit(0)), F.lit(1)).cast("long")
    s = f.agg(F.count(F.lit(1)).alias("before"), F.sum(mult).alias("after"))
    arr = F.array(F.struct(F.lit("before").alias("stage"), F.col("before").alias("n_rows")),
                  F.struct(F.lit("after").alias("stage"), F.col("after").cast("long").alias("n_rows")))
    return s.select(F.inline(arr))


def repair_dimension(dim: DataFrame, overrides: DataFrame, key: str = "fips") -> DataFrame:
    """Apply override rows to a dimension before it is joined (FIX-1).

    For every key in ``overrides`` each override column takes the override
    value, whether or not the dimension had one; columns the override does
    not name keep the dimension's value (null when the key is new).  Repairing
    the dimension, rather than the joined fact, keeps later filters on these
    columns able to reach the dimension side of the join.

    ``overrides`` is normally a short list of corrections: after the bounded
    size check it is broadcast into a left join over the dimension (no
    shuffle of the dimension); a correction table beyond the budget is
    joined by a shuffle join instead.  Override keys that the dimension has
    are found by a left semi join of the dimension with the override keys
    (broadcast: no shuffle of the dimension, one row per override key out);
    the other override rows are added.  Two override rows with one key would
    multiply the dimension and then every fact row: they raise.
    """
    twice = [r[0] for r in duplicate_keys(overrides, key).limit(5).collect()]
    if twice:
        raise ValueError(f"override rows with one {key}: {twice}")
    o = overrides.select(*[F.col(c).alias(f"__o_{c}") if c != key else F.col(c)
                           for c in overrides.columns])
    patched = dim.join(sized_broadcast(o), on=key, how="left")
    out = []
    for c in dim.columns:
        if c != key and c in overrides.columns:
            out.append(F.coalesce(F.col(f"__o_{c}"), F.col(c)).cast(dim.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    existing = patched.select(*out)
    there = dim.select(key).join(sized_broadcast(overrides.select(key)), on=key,
                                 how="left_semi").distinct()
    new_keys = overrides.join(sized_broadcast(there), on=key, how="left_anti")
    added = new_keys.select(*[(F.col(c) if c in overrides.columns else F.lit(None))
                              .cast(dim.schema[c].dataType).alias(c) for c in dim.columns])
    return existing.unionByName(added)


def hot_keys(fact: DataFrame, key: str = "fips", support: float = 0.01) -> dict:
    """Keys that hold at least ``support`` of the rows, and their shares.

    A frequent-items sketch of one pass names the candidates (bounded by
    1 / support, none is missed); a second pass counts these alone.
    """
    found = fact.where(F.col(key).isNotNull()).stat.freqItems([key], support).first()[0]
    if not found:
        return {}
    counts = fact.groupBy(F.when(F.col(key).isin(*found), F.col(key)).alias("k")).agg(
        F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["n"] for r in counts)
    return {r["k"]: r["n"] / total for r in counts
            if r["k"] is not None and r["n"] >= support * total}


SALTS_PER_PARTITION = 16     # pieces of a key that would fill one partition's fair part


def salted_left_join(fact: DataFrame, dim: DataFrame, key: str = "fips",
                     support: float = 0.01) -> DataFrame:
    """Left join of a fact with hot keys and a dimension beyond the broadcast
    budget (JON-1, JON-2), by shuffle, without adaptive splitting.

    The rows of a hot key get a salt (a hash of the whole row, the same when a
    lost task runs again), and its dimension rows are repeated for each salt; all
    other keys have salt 0.  Rows without a key match nothing and are spread by
    their salt, too.
    """
    parts = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = {k: max(2, int(SALTS_PER_PARTITION * parts * share))
              for k, share in hot_keys(fact, key, support).items()}
    none = F.lit(1)
    if pieces:
        each = F.create_map(*[F.lit(x) for kv in pieces.items() for x in kv])
        none = F.coalesce(F.try_element_at(each, F.col(key)), none)
    n = F.when(F.col(key).isNull(), F.lit(SALTS_PER_PARTITION * parts)).otherwise(none)
    row = F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns])
    left = fact.withColumn("__salt", F.pmod(row, n.cast("long")))
    right = dim.where(F.col(key).isNotNull()).withColumn(
        "__salt", F.explode(F.sequence(F.lit(0).cast("long"), (none - 1).cast("long"))))
    return left.join(right.hint("merge"), on=[key, "__salt"], how="left").drop("__salt")
