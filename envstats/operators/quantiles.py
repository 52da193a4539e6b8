"""Exact quantiles with bounded memory, box-plot statistics and outlier
fractions (AGG-23, AGG-24).

Spark's exact ``percentile`` keeps every distinct value of a group in one
task, which does not hold at scale.  Here an exact ``quantile_cont``
(linear interpolation between the order statistics at (n-1)p, the same
definition as Spark's ``percentile`` and SQL ``quantile_cont``) is found by
narrowing each wanted rank to a value bracket:

1. Each wanted order statistic is a *target* (column, 0-based rank k) with a
   bracket of values known to contain it, and the number of values below
   the bracket.  Targets with the same bracket share one sketch.  The first
   pass gives each column's count and a sketch of the whole column.
2. A sketch pass computes a KLL quantile sketch (bounded size, merged in a
   two-level tree so that no reduce task merges every task's partial
   sketch) at a grid of fractions inside each bracket; the grid points
   around the target's relative rank give a narrower bracket.
3. A count pass gives, per bracket, a histogram of (#ends below the value,
   #ends at or below it) - a few cells, no row multiplication - from which
   the exact number of values below / at every proposed end follows.  That
   gives the exact rank offset of the new bracket, or the answer itself when
   the target rank falls on an end value (this is how a hot value holding a
   third of all rows is resolved in one step).
4. Once a bracket holds at most ``final_rows`` values, one window ranks
   them (partitioned by target, so each window partition is bounded).

The input is read in full by the first sketch pass, the first count pass
and the extraction of the values inside the open brackets (about one grid
cell of each column per bracket), which are written once as a reliable
checkpoint; all later passes read only that subset, however many the scale
needs.  The full passes are wide: sketches and counts are aggregates over
the columns themselves with literal ends, ``WIDE`` columns at a time (each
scan reads those columns only), so no row is multiplied and nothing is
joined; only values inside an open bracket become rows.
Only bracket ends and counts (a few numbers per target) go to the driver;
every pass is a distributed aggregate over a column-pruned scan.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GRID = 200            # grid fractions per bracket and pass
ACCURACY = 5000       # sketch size (KLL k, capped at 65535); rank error about 2.3 / k^0.97
FINAL_ROWS = 200_000  # rank exactly once a bracket holds at most this many values
WIDE = 8              # columns of one wide pass (bounds the size of its generated code)
MERGE_FAN_IN = 256    # first-level sketch groups per key: scan partitions are merged in a tree


def wide_values(df: DataFrame, columns) -> DataFrame:
    """The columns as doubles, NaN as null, one row per input row."""
    return df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c)
                       for c in columns])


def _chunks(columns) -> list[list[str]]:
    cols = list(columns)
    return [cols[i:i + WIDE] for i in range(0, len(cols), WIDE)]


def _wide_sketch(wide: DataFrame, columns, grid_fracs, k: int) -> dict:
    """Per column: exact count and the values at ``grid_fracs`` of a KLL sketch,
    merged in two levels like ``_grid_sketch``."""
    out = {}
    fracs = F.array(*[F.lit(float(f)) for f in grid_fracs])
    for cols in _chunks(columns):
        lvl1 = wide.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGE_FAN_IN)).alias("__salt")).agg(
            *[F.count(c).alias(f"n_{c}") for c in cols],
            *[F.kll_sketch_agg_double(c, k).alias(f"s_{c}") for c in cols])
        r = lvl1.agg(*[F.sum(f"n_{c}").alias(f"n_{c}") for c in cols],
                     *[F.kll_merge_agg_double(f"s_{c}", k).alias(f"s_{c}") for c in cols]).select(
            *[f"n_{c}" for c in cols],
            *[F.when(F.col(f"n_{c}") > 0, F.kll_sketch_get_quantile_double(f"s_{c}", fracs))
              .alias(f"q_{c}") for c in cols]).first()
        out.update({c: (int(r[f"n_{c}"] or 0), list(r[f"q_{c}"] or [])) for c in cols})
    return out


def _wide_counts(wide: DataFrame, ends: dict) -> dict:
    """{(column, end): (values below it, values at or below it)} in wide passes."""
    out = {}
    for cols in _chunks(ends):
        wanted = [(c, e) for c in cols for e in sorted(ends[c])]
        r = wide.agg(*[F.count_if(F.col(c) < F.lit(e)).alias(f"a{i}") for i, (c, e) in enumerate(wanted)],
                     *[F.count_if(F.col(c) <= F.lit(e)).alias(f"b{i}")
                       for i, (c, e) in enumerate(wanted)]).first()
        out.update({w: (r[f"a{i}"], r[f"b{i}"]) for i, w in enumerate(wanted)})
    return out


def _bracketed(wide: DataFrame, unresolved: dict) -> DataFrame:
    """(column, value) of the values inside any unresolved bracket, each once, as a
    reliable checkpoint in the shared folder."""
    from envstats.session import shared_dir
    inside: dict[str, list] = {}
    for b in _group_brackets(unresolved.items())[0].values():
        v = F.col(b["column"])
        test = v.isNotNull()
        if b["lo"] is not None:
            test &= (v >= F.lit(b["lo"])) if b["lo_incl"] else (v > F.lit(b["lo"]))
        if b["hi"] is not None:
            test &= (v <= F.lit(b["hi"])) if b["hi_incl"] else (v < F.lit(b["hi"]))
        inside.setdefault(b["column"], []).append(test)
    parts = []
    for cols in _chunks(inside):
        tests = {c: _any(inside[c]) for c in cols}
        picked = F.array_compact(F.array(*[F.when(t, F.struct(F.lit(c).alias("column"),
                                                              F.col(c).alias("value")))
                                           for c, t in tests.items()]))
        parts.append(wide.where(_any(tests.values())).select(F.inline(picked)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    shared_dir(wide.sparkSession)
    return out.checkpoint(eager=True)


def _any(tests):
    out = None
    for t in tests:
        out = t if out is None else out | t
    return out


def _settle(s: dict, k: int, a: float, b: float, lt_a: int, le_a: int, lt_b: int, le_b: int) -> None:
    """Resolve a target of rank ``k`` or narrow its bracket, given how many of the
    bracket's values lie below / at or below the proposed ends a and b."""
    k_rel = k - s["below"]
    if lt_a <= k_rel < le_a:
        s["value"] = a
    elif lt_b <= k_rel < le_b:
        s["value"] = b
    elif k_rel < lt_a:            # below a: keep lower end, cut at a
        s.update(hi=a, hi_incl=False, within=lt_a)
    elif k_rel >= le_b:           # above b: cut at b, keep upper end
        s.update(lo=b, lo_incl=False, below=s["below"] + le_b, within=s["within"] - le_b)
    else:                         # strictly between a and b
        s.update(lo=a, lo_incl=False, hi=b, hi_incl=False,
                 below=s["below"] + le_a, within=lt_b - le_a)


def _in_bracket(lo, lo_incl, hi, hi_incl):
    v = F.col("value")
    lo_ok = F.when(F.col(lo).isNull(), F.lit(True)).when(F.col(lo_incl), v >= F.col(lo)).otherwise(v > F.col(lo))
    hi_ok = F.when(F.col(hi).isNull(), F.lit(True)).when(F.col(hi_incl), v <= F.col(hi)).otherwise(v < F.col(hi))
    return lo_ok & hi_ok


_BRACKET_SCHEMA = ("bid long, column string, lo double, lo_incl boolean, hi double, hi_incl boolean")


def _bracket_rows(spark: SparkSession, lng: DataFrame, brackets: dict) -> DataFrame:
    rows = [(bid, b["column"], b["lo"], b["lo_incl"], b["hi"], b["hi_incl"])
            for bid, b in brackets.items()]
    bdf = spark.createDataFrame(rows, _BRACKET_SCHEMA)
    # bounded: one row per open bracket (at most 2 per wanted quantile)
    j = lng.join(F.broadcast(bdf), on="column", how="inner")
    return j.where(_in_bracket("lo", "lo_incl", "hi", "hi_incl")).select("bid", "value")


def _grid_sketch(df: DataFrame, key: str, grid_fracs, k: int) -> dict:
    """Per ``key``: exact count and the values at ``grid_fracs`` of a KLL sketch.

    Sketches are merged in two levels: first per (key, scan partition id mod
    ``MERGE_FAN_IN``), then per key.  Each map task still emits one partial
    sketch per key, but no reduce task merges more than a share of them (a
    one-level ``percentile_approx`` would send every task's partial digest
    of a column to one reducer).  Sketch accuracy only affects how many
    passes are needed: the exact count pass corrects any bracket."""
    salted = df.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(MERGE_FAN_IN)))
    lvl1 = salted.groupBy(key, "__salt").agg(F.count(F.lit(1)).alias("n"),
                                             F.kll_sketch_agg_double("value", k).alias("sk"))
    lvl2 = lvl1.groupBy(key).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sk", k).alias("sk"))
    rows = lvl2.select(key, "n", F.kll_sketch_get_quantile_double(
        "sk", F.array(*[F.lit(float(f)) for f in grid_fracs])).alias("q")).collect()
    return {r[key]: (int(r["n"]), list(r["q"])) for r in rows}


def _bracket_key(t, s):
    return (t[0], s["lo"], s["lo_incl"], s["hi"], s["hi_incl"])


def _group_brackets(items):
    """Targets sharing a bracket share one sketch / one count."""
    brackets, tb = {}, {}
    for t, s in items:
        key = _bracket_key(t, s)
        if key not in brackets:
            brackets[key] = len(brackets)
        tb[t] = brackets[key]
    bmap = {bid: dict(zip(("column", "lo", "lo_incl", "hi", "hi_incl"), key))
            for key, bid in brackets.items()}
    return bmap, tb


def _propose(targets, open_t, tb, sketches, grid_fracs, eps):
    """New bracket ends around each target's relative rank, from the grid."""
    grid = len(grid_fracs) - 1
    prop = {}
    for t in open_t:
        s = targets[t]
        q = sketches.get(tb[t])
        if q is None:
            continue
        r = (t[1] - s["below"]) / s["within"]
        lo_i = max([i for i, f in enumerate(grid_fracs) if f <= r - 2 * eps] or [0])
        hi_i = min([i for i, f in enumerate(grid_fracs) if f >= r + 2 * eps] or [grid])
        prop[t] = (q[lo_i], q[hi_i])
    return prop


def exact_quantiles(df: DataFrame, columns, probs=(0.25, 0.5, 0.75), *,
                    accuracy: int = ACCURACY, grid: int = GRID,
                    final_rows: int = FINAL_ROWS, max_passes: int = 64) -> DataFrame:
    """Exact ``quantile_cont`` per (column, p) -> DataFrame(column, p, value, n).

    Raises when a bracket is still too large to rank after ``max_passes``.
    """
    spark = df.sparkSession
    cols = list(columns)
    wide = wide_values(df, cols)
    grid_fracs = [i / grid for i in range(grid + 1)]
    sketch_k = int(min(65535, max(8, accuracy)))
    eps = max(1.0 / accuracy, 2.3 / sketch_k ** 0.97)     # KLL normalized rank error

    # pass 1: per column, the count and a sketch of the whole column
    first_rows = _wide_sketch(wide, cols, grid_fracs, sketch_k)
    counts = {c: v[0] for c, v in first_rows.items()}
    targets: dict[tuple[str, int], dict] = {}
    for c in cols:
        n = counts[c]
        for p in probs if n else ():
            h = (n - 1) * p
            for k in {math.floor(h), math.ceil(h)}:
                targets.setdefault((c, k), {"lo": None, "lo_incl": True, "hi": None,
                                            "hi_incl": True, "below": 0, "within": n,
                                            "value": None})
    _, tb = _group_brackets(targets.items())
    prop = _propose(targets, list(targets), tb, {tb[t]: first_rows[t[0]][1] for t in targets},
                    grid_fracs, eps)

    # pass 2: exact counts at the proposed ends, then only the open brackets' values
    ends: dict[str, set] = {}
    for (c, _), ab in prop.items():
        ends.setdefault(c, set()).update(map(float, ab))
    at = _wide_counts(wide, ends)
    for t, (a, b) in prop.items():
        _settle(targets[t], t[1], a, b, *at[t[0], float(a)], *at[t[0], float(b)])
    unresolved = {t: s for t, s in targets.items() if s["value"] is None}
    lng = _bracketed(wide, unresolved) if unresolved else None

    for _ in range(max_passes):
        # sketch pass over the brackets still too large to rank directly
        open_t = [t for t, s in targets.items() if s["value"] is None and s["within"] > final_rows]
        if not open_t:
            break
        bmap, tb = _group_brackets((t, targets[t]) for t in open_t)
        sk = {b: q for b, (_, q) in _grid_sketch(
            _bracket_rows(spark, lng, bmap), "bid", grid_fracs, sketch_k).items()}
        prop = _propose(targets, open_t, tb, sk, grid_fracs, eps)
        # count pass: one histogram per bracket of (#ends < value, #ends <= value)
        bmap, tb = _group_brackets((t, targets[t]) for t in prop)
        marks: dict = {}
        for t, (a, b) in prop.items():
            marks.setdefault(tb[t], set()).update((float(a), float(b)))
        marks = {bid: sorted(v) for bid, v in marks.items()}
        # ends as columns e0..e{m-1} (null-padded) so the comparisons stay in codegen
        m = max(len(v) for v in marks.values())
        edf = spark.createDataFrame(
            [(bid, *(e + [None] * (m - len(e)))) for bid, e in marks.items()],
            "bid long, " + ", ".join(f"e{i} double" for i in range(m)))
        inb = _bracket_rows(spark, lng, bmap)
        v = F.col("value")
        n_lt = sum(F.coalesce((F.col(f"e{i}") < v).cast("int"), F.lit(0)) for i in range(m))
        n_le = sum(F.coalesce((F.col(f"e{i}") <= v).cast("int"), F.lit(0)) for i in range(m))
        hist = (inb.join(F.broadcast(edf), on="bid", how="inner")
                   .select("bid", n_lt.alias("a"), n_le.alias("b"))
                   .groupBy("bid", "a", "b").agg(F.count(F.lit(1)).alias("c")).collect())
        hb: dict = {}
        for r in hist:
            hb.setdefault(r["bid"], []).append((r["a"], r["b"], r["c"]))

        def lt_le(bid, v):
            i = marks[bid].index(float(v)) + 1
            rows = hb.get(bid, [])
            return (sum(c for _, b_, c in rows if b_ <= i - 1), sum(c for a_, _, c in rows if a_ <= i - 1))

        for t, (a, b) in prop.items():
            _settle(targets[t], t[1], a, b, *lt_le(tb[t], a), *lt_le(tb[t], b))
    still = [t for t, s in targets.items() if s["value"] is None and s["within"] > final_rows]
    if still:
        raise RuntimeError(f"brackets not narrow enough after {max_passes} passes: {still[:5]}; "
                           "raise max_passes, accuracy or final_rows")

    # final: rank the few values left in each bracket with a bounded window
    rest = {t: s for t, s in targets.items() if s["value"] is None}
    if rest:
        bmap, tb = _group_brackets(rest.items())
        inb = _bracket_rows(spark, lng, bmap)
        want = spark.createDataFrame([(tb[t], t[1] - s["below"] + 1, t[0], t[1])
                                      for t, s in rest.items()],
                                     "bid long, rn long, column string, k long")
        ranked = inb.withColumn("rn", F.row_number().over(Window.partitionBy("bid").orderBy("value")))
        got = ranked.join(F.broadcast(want), on=["bid", "rn"], how="inner").collect()
        for r in got:
            targets[(r["column"], r["k"])]["value"] = r["value"]

    out = []
    for c in cols:
        n = counts.get(c, 0)
        for p in probs:
            if n == 0:
                out.append((c, float(p), None, 0))
                continue
            h = (n - 1) * p
            lo_v = targets[(c, math.floor(h))]["value"]
            hi_v = targets[(c, math.ceil(h))]["value"]
            frac = h - math.floor(h)
            # same weighting as Spark's percentile: lo*(1-d) + hi*d
            val = lo_v if frac == 0 or lo_v == hi_v else lo_v * (1.0 - frac) + hi_v * frac
            out.append((c, float(p), float(val), int(n)))
    return spark.createDataFrame(out, "column string, p double, value double, n long")


def box_stats(df: DataFrame, columns, whisker: float = 1.5, **kw) -> DataFrame:
    """Per column: quartiles, IQR fences, whisker ends, outlier count and
    fraction (AGG-23, AGG-24).

    Whisker ends are the most extreme values inside the fences.  The last
    pass is wide, too: per column the counts and extremes inside its literal
    fences, one row per task.
    """
    cols = list(columns)
    quartiles: dict = {}
    for r in exact_quantiles(df, cols, (0.25, 0.5, 0.75), **kw).collect():   # 3 rows per column
        quartiles.setdefault(r["column"], {})[r["p"]] = r["value"]
    wide = wide_values(df, cols)
    rows = []
    for part in _chunks(cols):
        aggs = []
        for i, c in enumerate(part):
            q1, q3 = quartiles[c][0.25], quartiles[c][0.75]
            lo, hi = (None, None) if q1 is None else (q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1))
            x = F.col(c)
            inside = (x >= F.lit(lo).cast("double")) & (x <= F.lit(hi).cast("double"))
            aggs += [F.count(x).alias(f"n{i}"), F.count_if(~inside).alias(f"o{i}"),
                     F.min(F.when(inside, x)).alias(f"lo{i}"), F.max(F.when(inside, x)).alias(f"hi{i}")]
        r = wide.agg(*aggs).first()
        for i, c in enumerate(part):
            q1, median, q3 = (quartiles[c][p] for p in (0.25, 0.5, 0.75))
            if q1 is None:
                rows.append((c, *[None] * 6, 0, 0, None, None, None))
                continue
            iqr = q3 - q1
            rows.append((c, q1, median, q3, iqr, q1 - whisker * iqr, q3 + whisker * iqr, r[f"n{i}"],
                         r[f"o{i}"], r[f"lo{i}"], r[f"hi{i}"], r[f"o{i}"] / r[f"n{i}"]))
    return df.sparkSession.createDataFrame(
        rows, "column string, q1 double, median double, q3 double, iqr double, lower_fence double, "
              "upper_fence double, n long, n_outliers long, whisker_low double, whisker_high double, "
              "outlier_fraction double")
