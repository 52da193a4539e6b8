import pytest

from envstats.plans import catalog, report
from envstats.sources import fixtures as fx

from .conftest import SF_SMALL


def _rows(df):
    out = []
    for r in df.collect():
        out.append(tuple(sorted((k, round(v, 6) if isinstance(v, float) else
                                 (str(v) if v is not None and not isinstance(v, (int, str)) else v))
                                for k, v in r.asDict().items())))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rep(spark):
    return report.run_report(spark, fx.obs_raw(spark, SF_SMALL), fx.soil(spark, SF_SMALL),
                             fx.geo_repaired(spark, SF_SMALL))


@pytest.mark.parametrize("name", ["county_risk", "region_summary_pct", "season_pivot",
                                  "alert_year_pivot", "rolling_trend", "top20_regions",
                                  "label_weather_summary"])
def test_report_equals_direct_query(spark, rep, name):
    direct = catalog.QUERIES[name](spark, SF_SMALL)
    assert _rows(rep[name].transform(catalog.checked)) == _rows(direct)


def test_report_covers_analyses(rep):
    assert len(rep) == 18 and all(df.count() >= 0 for df in rep.values())
