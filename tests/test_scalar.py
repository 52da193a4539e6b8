from pyspark.sql import functions as F

from envstats import constants as C
from envstats.functions import scalar as S


def test_floor_labels_and_dedup_option(spark, obs_rows):
    from envstats.functions.scalar import severity_label
    from envstats.plans.batch import build_features
    df = spark.createDataFrame([(0.5,), (3.0,), (3.9,), (6.0,), (None,)], "score double")
    got = [r[0] for r in df.select(severity_label("score", mode="floor")).collect()]
    assert got == ["D0 - No Drought", "D3 - Severe Drought", "D3 - Severe Drought", "Unknown", "Unknown"]
    assert [r[0] for r in df.select(severity_label("score")).collect()].count("Unknown") == 4
    with_all = build_features(obs_rows, None, None).count()
    assert build_features(obs_rows, None, None, dedup=True).count() == with_all - 1


def test_severity_label_exact_and_flags(spark):
    nan = float("nan")
    df = spark.createDataFrame([(v,) for v in (0.0, 0.5, 1.0, 2.5, 3.0, 3.7, 5.0, None, nan)],
                               "score double")
    out = df.select("score", S.severity_label("score").alias("lab"),
                    S.flag_at_least("score", 1.0).alias("d"),
                    S.flag_at_least("score", 3.0).alias("h")).collect()
    got = {(None if r.score is None else ("nan" if r.score != r.score else r.score)): (r.lab, r.d, r.h)
           for r in out}
    assert got[0.0] == ("D0 - No Drought", 0, 0)
    assert got[0.5] == (C.UNKNOWN_LABEL, 0, 0)
    assert got[1.0] == ("D1 - Abnormally Dry", 1, 0)
    assert got[3.0] == ("D3 - Severe Drought", 1, 1)
    assert got[3.7] == (C.UNKNOWN_LABEL, 1, 1)          # fractional: Unknown yet high risk
    assert got[5.0] == ("D5 - Exceptional Drought", 1, 1)
    assert got[None] == (C.UNKNOWN_LABEL, 0, 0)
    assert got["nan"][0] == C.UNKNOWN_LABEL


def test_pad_key_keeps_long_keys(spark):
    df = spark.createDataFrame([(1001,), (46102,), (123456,), (None,)], "k long")
    got = [r[0] for r in df.select(S.pad_key("k", 5)).collect()]
    assert got == ["01001", "46102", "123456", None]


def test_pct_guards_zero_denominator(spark):
    df = spark.createDataFrame([(1, 8), (3, 0), (None, 4)], "a long, b long")
    got = [r[0] for r in df.select(S.pct("a", "b")).collect()]
    assert got == [12.5, None, None]


def test_pct_decimal_half_up(spark):
    # 1/16*100 = 6.25 -> 6.3 (HALF_UP in exact decimal), 1/3 -> 33.3
    df = spark.createDataFrame([(1, 16), (1, 3), (2, 0)], "a long, b long")
    got = [r[0] for r in df.select(S.pct_decimal("a", "b", 1)).collect()]
    assert got == [6.3, 33.3, None]


def test_parse_date_malformed_is_null(spark):
    df = spark.createDataFrame([("2001-02-03",), ("not a date",), (None,)], "d string")
    got = [r[0] for r in df.select(S.parse_date("d")).collect()]
    assert str(got[0]) == "2001-02-03" and got[1] is None and got[2] is None


def test_month_bucket_and_start(spark):
    df = spark.createDataFrame([("2001-02-03",)], "d string").withColumn("dd", F.to_date("d"))
    r = df.select(S.month_bucket("d").alias("a"), S.month_bucket("dd").alias("b"),
                  S.month_start(F.lit(2001), F.lit(2)).alias("c")).first()
    assert r.a == "2001-02" and r.b == "2001-02" and str(r.c) == "2001-02-01"


def test_place_label_null_propagates(spark):
    df = spark.createDataFrame([("C", "S"), (None, "S")], "c string, s string")
    assert [r[0] for r in df.select(S.place_label("c", "s")).collect()] == ["C, S", None]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r[0] for r in df.select(S.nan_to_null("x")).collect()] == [None, 1.0]
