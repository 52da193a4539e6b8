import pandas as pd
import pytest

from envstats.operators import alerts, quality, severity, trends
from envstats.spec import DEFAULT


@pytest.fixture(scope="module")
def feat(obs_rows, geo_rows):
    from envstats.plans.batch import build_features
    return build_features(obs_rows, None, geo_rows, DEFAULT)


@pytest.fixture(scope="module")
def enr(feat):
    return severity.enrich(feat)


def test_rolling_mean_counts_rows_not_months(feat):
    r = trends.rolling_trend(feat, rows=2).where("State_or_Territory = 'Alpha'") \
              .orderBy("year", "month").collect()
    assert [(x.year, x.month) for x in r] == [(2000, 1), (2000, 2), (2000, 4)]   # March not filled
    # pandas rolling(window=2, min_periods=1) over the monthly means
    means = pd.Series([x.avg_drought_score for x in r])
    want = means.rolling(window=2, min_periods=1).mean().tolist()
    assert [x.rolling_drought for x in r] == pytest.approx(want)


def test_monthly_trend_for_region(feat):
    r = trends.monthly_trend_for(feat, "Beta").collect()
    assert [(x.year, x.month) for x in r] == [(2000, 1)]


def test_severe_share_zero_denominator(spark):
    df = spark.createDataFrame([("A", None), ("A", None), ("B", 3.0), ("B", 1.0)],
                               "State_or_Territory string, score double")
    got = {r.State_or_Territory: r for r in severity.severe_share(df, "State_or_Territory").collect()}
    assert got["A"].total_weeks == 0 and got["A"].pct_severe is None
    assert got["B"].severe_weeks == 1 and got["B"].pct_severe == 50.0


def test_top_k_tie_break(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5)], "k string, v double")
    assert [r.k for r in severity.top_k(df, "v", 2, tie_keys=("k",)).collect()] == ["a", "b"]


def test_county_risk_padded(enr):
    got = {r.fips: r for r in severity.county_risk(enr).collect()}
    assert "01001" in got and "123456" in got
    assert got["01002"].weeks_in_severe_drought == 4 and got["01002"].total_weeks_recorded == 4


def test_region_summary_and_drilldown(enr):
    s = alerts.region_summary_pct(alerts.region_summary(enr), min_support=1)
    d = severity.worst_group_drilldown(s, "avg_drought_score", "State_or_Territory",
                                       "County_Name", "state_mean").collect()
    # worst county is 1002 (Alpha); both Alpha counties come back with the unweighted mean
    assert {r.County_Name for r in d} == {"One", "Two"}
    assert d[0].state_mean == pytest.approx(sum(r.avg_drought_score for r in d) / 2)


def test_alert_pivot_fills_zero(enr):
    a = alerts.alert_feed(enr)
    p = alerts.alert_year_pivot(a).first()
    assert p["year"] == 2000
    assert p["D3 - Severe Drought"] == 1 and p["D4 - Extreme Drought"] == 1
    assert p["D5 - Exceptional Drought"] == 1


def test_season_pivot_missing_month_is_null(enr):
    t = trends.month_bucket_trend(enr)
    r = trends.season_pivot(t).first()
    assert r["year"] == "2000" and r["Mar"] is None and r["Jan"] is not None
    last = trends.last_periods(t, 2).collect()
    assert [x.year_month for x in last] == ["2000-02", "2000-04"]


def test_label_weather_and_distribution(enr):
    dist = {r.drought_label: r["count"] for r in alerts.label_distribution(enr).collect()}
    assert dist["Unknown"] == 4      # 0.5, 2.5, 3.7 twice
    assert sum(dist.values()) == quality.drop_null(enr, "score").count()
    assert alerts.label_weather_summary(enr).count() == len(dist)


def test_captured_counts_support_and_null_month(spark):
    import datetime as dt
    d = dt.date(2000, 1, 3)
    rows = [("A", "x", d)] * 3 + [("A", "y", dt.date(2000, 2, 1))] + [(None, None, None)] * 2
    df = spark.createDataFrame(rows, "State_or_Territory string, County_Name string, date date")
    r = alerts.captured_counts(df, min_support=2).collect()[0]
    # groups (A,x)=3 and (null,null)=2 reach the support; (A,y)=1 does not
    assert r.regions_captured == 2
    # months 2000-01 and 2000-02; the null month is not a period
    assert r.months_captured == 2
