import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from envstats.session import build_session
    s = build_session("local[*]", 8, app="envstats-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def obs_rows(spark):
    """Hand-made county-day rows with the edge cases of the fixture notes."""
    import datetime as dt
    nan = float("nan")
    d = dt.date
    rows = [
        # fips, date, PRECTOT, T2M, T2M_MAX, WS10M, QV2M, score
        (1001, d(2000, 1, 3), 1.0, 10.0, 15.0, 2.0, 5.0, 0.0),
        (1001, d(2000, 1, 10), 0.0, 11.0, 16.0, 2.5, 5.5, 0.5),
        (1001, d(2000, 2, 7), 3.0, 12.0, 17.0, 3.0, 6.0, 1.0),
        (1001, d(2000, 4, 3), 0.5, 13.0, 18.0, 3.5, 6.5, 2.5),   # March missing
        (1002, d(2000, 1, 3), 0.2, 20.0, 25.0, 1.0, 4.0, 3.0),
        (1002, d(2000, 1, 10), 0.1, 21.0, 26.0, 1.5, 4.5, 3.7),
        (1002, d(2000, 1, 10), 0.1, 21.0, 26.0, 1.5, 4.5, 3.7),  # exact duplicate
        (1002, d(2000, 2, 7), 0.0, 22.0, 27.0, 2.0, 5.0, 5.0),
        (1003, d(2000, 1, 3), 2.0, 5.0, 9.0, 4.0, 7.0, None),    # null score
        (1003, d(2000, 1, 10), 2.0, 5.0, 9.0, 4.0, 7.0, nan),    # NaN score
        (1004, d(2000, 1, 3), 1.0, 6.0, 10.0, 1.0, 3.0, 4.0),    # key missing from geo
        (46102, d(2000, 1, 3), 1.0, 6.0, 10.0, 1.0, 3.0, 2.0),   # repaired key
        (123456, d(2000, 1, 3), 1.0, 6.0, 10.0, 1.0, 3.0, 1.0),  # 6-digit key
    ]
    return spark.createDataFrame(
        rows, "fips long, date date, PRECTOT double, T2M double, T2M_MAX double, "
              "WS10M double, QV2M double, score double")


@pytest.fixture(scope="session")
def geo_rows(spark):
    rows = [(1001, 1, "Alpha", "AL", 1, "One"), (1002, 1, "Alpha", "AL", 2, "Two"),
            (1003, 2, "Beta", "BE", 3, "Three"), (123456, 2, "Beta", "BE", 456, "Big")]
    return spark.createDataFrame(rows, "fips long, State_Code int, State_or_Territory string, "
                                       "State_Abbreviation string, County int, County_Name string")
