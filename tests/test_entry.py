"""Driver contract, and every SQL-checked query against DuckDB at sf0.001."""

import os
import sys

import duckdb
import pytest

from .conftest import ROOT, SF_MID, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

# keys 42, 77 and 97 (repaired, unmatched, without attributes) exist from sf0.01 on
MID = ("override_repair", "unmatched_keys", "join_coverage", "null_profile", "duplicate_keys",
       "county_risk", "county_risk_from_csv", "mean_by_region")


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["fips", "overall_avg_score", "weeks_in_severe_drought",
                          "total_weeks_recorded", "pct_severe_drought"]
    assert df.count() > 0


def test_every_query_has_sql():
    from envstats.plans.catalog import QUERIES, VALUES
    from envstats.plans.oracle import ORACLE
    import __spark_entry__ as E
    assert set(ORACLE) == set(QUERIES) - set(VALUES) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_works_without_the_corpus_package(monkeypatch):
    import __spark_entry__ as E
    from envstats.plans.catalog import QUERIES
    for name in ("corpus_pipeline", "envstats.llm", "envstats.llm.catalog"):
        monkeypatch.setitem(sys.modules, name, None)
    from envstats.plans.oracle import ORACLE
    assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) == set(ORACLE)


def _connect(folder):
    c = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def con():
    return _connect(SF_SMALL)


def _names():
    from envstats.plans.oracle import ORACLE
    return sorted(ORACLE)


@pytest.mark.parametrize("name", MID)
def test_query_matches_sql_on_the_larger_tables(spark, name):
    import __spark_entry__ as E
    from check_oracle import compare
    df = E.queries()[name](spark, SF_MID)
    res = _connect(SF_MID).execute(E.oracle_sql()[name])
    msg = compare(df.columns, [tuple(r) for r in df.collect()],
                  [d[0] for d in res.description], res.fetchall())
    assert msg is None, msg


@pytest.mark.parametrize("name", _names())
def test_query_matches_sql(spark, con, name):
    import __spark_entry__ as E
    from check_oracle import compare
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    msg = compare(df.columns, rows, [d[0] for d in res.description], res.fetchall())
    assert msg is None, msg
