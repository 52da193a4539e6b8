"""Reference SQL (DuckDB dialect) for the named queries.

The fixture tables are inlined as CTEs over the driver's pre-registered
tables, written independently of the DataFrame code.  Output columns are
normalised the same way as ``catalog.checked``: doubles rounded to 6
decimals, dates as text.
"""

from __future__ import annotations

_LABEL_CASE = """CASE WHEN score = 0 THEN 'D0 - No Drought'
              WHEN score = 1 THEN 'D1 - Abnormally Dry'
              WHEN score = 2 THEN 'D2 - Moderate Drought'
              WHEN score = 3 THEN 'D3 - Severe Drought'
              WHEN score = 4 THEN 'D4 - Extreme Drought'
              WHEN score = 5 THEN 'D5 - Exceptional Drought' ELSE 'Unknown' END"""
_MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
_SEVERE_LABELS = ("D3 - Severe Drought", "D4 - Extreme Drought", "D5 - Exceptional Drought")

# Measures and attributes of the fixture, written out.
_MEASURES = {
    "PRECTOT": "l_quantity", "T2M": "l_extendedprice / 1000.0",
    "T2M_MAX": "l_extendedprice / 1000.0 + l_tax * 100.0",
    "T2M_MIN": "l_extendedprice / 1000.0 - l_tax * 100.0",
    "QV2M": "l_tax * 100.0 + l_linenumber", "WS10M": "l_tax * 100.0",
    "PS": "CAST(l_partkey % 500 AS DOUBLE) + 800.0",
    "T2MDEW": "l_extendedprice / 1000.0 - l_linenumber",
    "T2MWET": "l_extendedprice / 1000.0 - l_quantity / 10.0",
    "T2M_RANGE": "l_tax * 100.0 * 2.0", "TS": "l_extendedprice / 1000.0 + l_quantity / 5.0",
    "WS10M_MAX": "l_tax * 100.0 + l_quantity / 10.0",
    "WS10M_MIN": "l_tax * 100.0 - l_quantity / 100.0", "WS10M_RANGE": "l_quantity / 8.0",
    "WS50M": "l_tax * 100.0 * 1.5", "WS50M_MAX": "l_tax * 100.0 * 1.5 + l_linenumber",
    "WS50M_MIN": "l_tax * 100.0 * 1.5 - l_linenumber", "WS50M_RANGE": "l_linenumber * 2.0",
}
_ATTRIBUTES = {
    "lat": "CAST(s_nationkey AS DOUBLE) + 25.0", "lon": "s_acctbal / 100.0 - 90.0",
    "elevation": "s_acctbal", "slope1": "s_acctbal / 100.0", "slope2": "s_acctbal / 200.0",
    "slope3": "s_acctbal / 300.0", "slope4": "s_acctbal / 400.0", "slope5": "s_acctbal / 500.0",
    "slope6": "s_acctbal / 600.0", "slope7": "s_acctbal / 700.0", "slope8": "s_acctbal / 800.0",
    "aspectN": "CAST(s_suppkey % 7 AS DOUBLE)", "aspectE": "CAST(s_suppkey % 11 AS DOUBLE)",
    "aspectS": "CAST(s_suppkey % 13 AS DOUBLE)", "aspectW": "CAST(s_suppkey % 17 AS DOUBLE)",
    "aspectUnknown": "CAST(s_suppkey % 3 AS DOUBLE)", "WAT_LAND": "s_acctbal / 1000.0",
    "NVG_LAND": "CAST(s_suppkey % 5 AS DOUBLE)", "URB_LAND": "CAST(s_suppkey % 6 AS DOUBLE)",
    "GRS_LAND": "CAST(s_nationkey AS DOUBLE)", "FOR_LAND": "CAST(s_suppkey % 8 AS DOUBLE)",
    "CULTRF_LAND": "CAST(s_suppkey % 9 AS DOUBLE)", "CULTIR_LAND": "CAST(s_suppkey % 10 AS DOUBLE)",
    "CULT_LAND": "CAST(s_suppkey % 12 AS DOUBLE)", "SQ1": "CAST(s_suppkey % 2 AS DOUBLE)",
    "SQ2": "CAST(s_suppkey % 4 AS DOUBLE)", "SQ3": "CAST(s_suppkey % 14 AS DOUBLE)",
    "SQ4": "CAST(s_suppkey % 15 AS DOUBLE)", "SQ5": "CAST(s_suppkey % 16 AS DOUBLE)",
    "SQ6": "CAST(s_suppkey % 18 AS DOUBLE)", "SQ7": "CAST(s_suppkey % 19 AS DOUBLE)",
}
_OBS_SQL = ",\n         ".join(f"{sql} AS {c}" for c, sql in _MEASURES.items())
_SOIL_SQL = ",\n         ".join(f"{sql} AS {c}" for c, sql in _ATTRIBUTES.items())

FIXTURE_CTES = f"""
obs_raw AS (
  SELECT l_suppkey + 1001 AS fips,
         CAST(l_shipdate AS DATE) AS date,
         {_OBS_SQL},
         CASE WHEN l_linenumber = 7 THEN NULL ELSE round(l_discount * 50.0, 1) END AS score
  FROM lineitem),
soil AS (
  SELECT s_suppkey + 1001 AS fips,
         {_SOIL_SQL}
  FROM supplier WHERE s_suppkey <> 97),
geo AS (
  SELECT s_suppkey + 1001 AS fips,
         CAST(n_nationkey AS INTEGER) AS State_Code,
         n_name AS State_or_Territory,
         substr(n_name, 1, 2) AS State_Abbreviation,
         CAST(s_suppkey AS INTEGER) AS County,
         s_name AS County_Name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  WHERE s_suppkey NOT IN (42, 77)),
geo_fixed AS (
  SELECT coalesce(g.fips, o.fips) AS fips,
         coalesce(o.State_Code, g.State_Code) AS State_Code,
         coalesce(o.State_or_Territory, g.State_or_Territory) AS State_or_Territory,
         coalesce(o.State_Abbreviation, g.State_Abbreviation) AS State_Abbreviation,
         coalesce(o.County, g.County) AS County,
         g.County_Name
  FROM geo g FULL JOIN (SELECT CAST(1043 AS BIGINT) AS fips, 99 AS State_Code,
                               'NATION_X' AS State_or_Territory, 'NX' AS State_Abbreviation,
                               42 AS County) o
    ON g.fips = o.fips),
feat AS (
  SELECT o.fips, o.date, o.score, {", ".join("o." + c for c in _MEASURES)},
         {", ".join("s." + c for c in _ATTRIBUTES)},
         CASE WHEN o.fips = 1043 THEN 99 ELSE g.State_Code END AS State_Code,
         CASE WHEN o.fips = 1043 THEN 'NATION_X' ELSE g.State_or_Territory END AS State_or_Territory,
         CASE WHEN o.fips = 1043 THEN 'NX' ELSE g.State_Abbreviation END AS State_Abbreviation,
         CASE WHEN o.fips = 1043 THEN 42 ELSE g.County END AS County,
         g.County_Name,
         CAST(year(o.date) AS INTEGER) AS year,
         CAST(month(o.date) AS INTEGER) AS month
  FROM obs_raw o LEFT JOIN soil s ON o.fips = s.fips LEFT JOIN geo g ON o.fips = g.fips
  WHERE o.score IS NOT NULL AND NOT isnan(o.score)),
enr AS (
  SELECT *, {_LABEL_CASE} AS drought_label,
         CASE WHEN score >= 1 THEN 1 ELSE 0 END AS is_drought,
         CASE WHEN score >= 3 THEN 1 ELSE 0 END AS high_risk
  FROM feat),
summary AS (
  SELECT State_or_Territory, County_Name, count(*) AS total_obs,
         round(avg(score), 3) AS avg_drought_score,
         round(avg(PRECTOT), 3) AS avg_precip_mm,
         round(avg(T2M_MAX), 2) AS avg_max_temp_c,
         CAST(sum(is_drought) AS BIGINT) AS drought_obs,
         CAST(sum(high_risk) AS BIGINT) AS high_risk_obs
  FROM enr GROUP BY State_or_Territory, County_Name),
summary_pct AS (
  SELECT *, round(drought_obs * 100.0 / total_obs, 1) AS drought_pct,
            round(high_risk_obs * 100.0 / total_obs, 1) AS high_risk_pct
  FROM summary WHERE total_obs >= 10),
month_trend AS (
  SELECT substr(CAST(date AS VARCHAR), 1, 7) AS year_month, count(*) AS obs_count,
         round(avg(score), 3) AS avg_drought_score,
         round(avg(PRECTOT), 3) AS avg_precip_mm,
         round(avg(T2M_MAX), 2) AS avg_temp_c,
         CAST(sum(is_drought) AS BIGINT) AS drought_obs
  FROM enr GROUP BY 1),
alerts AS (
  SELECT State_or_Territory, County_Name, CAST(date AS VARCHAR) AS date, drought_label,
         score, PRECTOT, T2M_MAX, WS10M
  FROM enr WHERE high_risk = 1)
"""


def R(body: str, doubles=(), dates=()) -> str:
    """WITH fixtures + body, doubles rounded to 6 decimals, dates as text."""
    rep = [f'round(CAST("{c}" AS DOUBLE), 6) + 0.0 AS "{c}"' for c in doubles]
    rep += [f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in dates]
    sel = f"SELECT * REPLACE ({', '.join(rep)}) FROM q" if rep else "SELECT * FROM q"
    return f"WITH {FIXTURE_CTES.strip()},\nq AS (\n{body.strip()}\n)\n{sel}"


_SEVERE = "CAST(sum(CASE WHEN score >= 3 THEN 1 ELSE 0 END) AS BIGINT)"
# keys longer than the width are kept whole (lpad would cut them)
_PAD = ("CASE WHEN length(CAST(fips AS VARCHAR)) >= 5 THEN CAST(fips AS VARCHAR) "
        "ELSE lpad(CAST(fips AS VARCHAR), 5, '0') END")
_FEAT_COLS = ("fips", "date", "score", *_MEASURES, *_ATTRIBUTES, "State_Code",
              "State_or_Territory", "State_Abbreviation", "County", "County_Name", "year", "month")
_OBS_DOUBLES = (*_MEASURES, "score")
# every screened column: the measures, the score and the attributes but the position
_STATS_COLS = (*_MEASURES, "score", *(c for c in _ATTRIBUTES if c not in ("lat", "lon")))


def _months_pivot() -> str:
    return ",\n".join(
        f"max(CASE WHEN substr(year_month, 6, 2) = '{m:02d}' THEN avg_drought_score END) AS {_MONTHS[m - 1]}"
        for m in range(1, 13))


def _severe_label_cols() -> tuple:
    return _SEVERE_LABELS


ORACLE = {
    "county_risk": R(f"""
        SELECT {_PAD} AS fips, avg(score) AS overall_avg_score,
               {_SEVERE} AS weeks_in_severe_drought, count(score) AS total_weeks_recorded,
               {_SEVERE} / count(score) * 100.0 AS pct_severe_drought
        FROM feat GROUP BY 1""", doubles=("overall_avg_score", "pct_severe_drought")),

    "null_profile": R("SELECT " + ", ".join(
        f'CAST(sum(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS "{c}"' for c in _FEAT_COLS)
        + " FROM feat"),

    "duplicate_report": R("""
        SELECT b.n AS rows_before, a.n AS rows_after, b.n - a.n AS duplicates
        FROM (SELECT count(*) AS n FROM obs_raw) b,
             (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM obs_raw)) a"""),

    "duplicate_report_keys": R("""
        SELECT b.n AS rows_before, a.n AS rows_after, b.n - a.n AS duplicates
        FROM (SELECT count(*) AS n FROM obs_raw) b,
             (SELECT count(*) AS n FROM (SELECT DISTINCT fips, date FROM obs_raw)) a"""),

    "dedup_rows": R("SELECT DISTINCT * FROM obs_raw", doubles=_OBS_DOUBLES, dates=("date",)),

    "unmatched_keys": R("""
        SELECT DISTINCT fips FROM obs_raw
        WHERE score IS NOT NULL AND fips NOT IN (SELECT fips FROM geo) AND fips <> 1043"""),

    "unmatched_before_repair": R("""
        SELECT DISTINCT o.fips FROM obs_raw o LEFT JOIN geo g ON o.fips = g.fips
        WHERE o.score IS NOT NULL AND g.State_Code IS NULL"""),

    "key_uniqueness": R("""
        SELECT fips, count(*) AS n_rows FROM geo_fixed GROUP BY fips HAVING count(*) > 1"""),

    "duplicate_keys": R("""
        SELECT fips, date, count(*) AS n_rows FROM obs_raw GROUP BY fips, date HAVING count(*) > 1""",
        dates=("date",)),

    "join_coverage": R("""
        SELECT 'before' AS stage, count(*) AS n_rows FROM obs_raw WHERE score IS NOT NULL
        UNION ALL SELECT 'after' AS stage, count(*) AS n_rows FROM feat"""),

    "override_repair": R("SELECT * FROM geo_fixed"),

    "summary_stats": R("\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", avg({c}) AS mean,
                   stddev_samp({c}) AS stddev, CAST(min({c}) AS DOUBLE) AS "min",
                   CAST(max({c}) AS DOUBLE) AS "max" FROM feat""" for c in _STATS_COLS),
        doubles=("mean", "stddev", "min", "max")),

    "mean_by_region": R("""
        SELECT State_or_Territory, avg(score) AS Average_Drought_Score
        FROM feat GROUP BY 1""", doubles=("Average_Drought_Score",)),

    "landuse_by_region": R("""
        SELECT State_or_Territory, avg(WAT_LAND) AS "Water", avg(NVG_LAND) AS "Natural Vegetation",
               avg(URB_LAND) AS "Urban", avg(GRS_LAND) AS "Grassland", avg(FOR_LAND) AS "Forest",
               avg(CULTRF_LAND) AS "Cultivated Rainfed", avg(CULTIR_LAND) AS "Cultivated Irrigated",
               avg(CULT_LAND) AS "Cultivated"
        FROM feat GROUP BY 1""", doubles=("Water", "Natural Vegetation", "Urban", "Grassland", "Forest",
                                          "Cultivated Rainfed", "Cultivated Irrigated", "Cultivated")),

    "severity_profile": R("""
        SELECT round(score) AS score_binned, avg(PRECTOT) AS avg_precipitation,
               avg(T2M) AS avg_temp, avg(QV2M) AS avg_humidity, avg(WS10M) AS avg_wind
        FROM feat GROUP BY 1""",
        doubles=("score_binned", "avg_precipitation", "avg_temp", "avg_humidity", "avg_wind")),

    "monthly_trend": R("""
        SELECT year, month, avg(score) AS avg_drought_score, avg(PRECTOT) AS avg_precipitation,
               make_date(year, month, 1) AS month_start
        FROM feat GROUP BY year, month""",
        doubles=("avg_drought_score", "avg_precipitation"), dates=("month_start",)),

    "monthly_trend_by_region": R("""
        SELECT State_or_Territory, year, month, avg(score) AS avg_drought_score,
               avg(PRECTOT) AS avg_precipitation, make_date(year, month, 1) AS month_start
        FROM feat GROUP BY State_or_Territory, year, month""",
        doubles=("avg_drought_score", "avg_precipitation"), dates=("month_start",)),

    "monthly_trend_region": R("""
        SELECT year, month, avg(score) AS avg_drought_score, avg(PRECTOT) AS avg_precipitation,
               make_date(year, month, 1) AS month_start
        FROM feat WHERE State_or_Territory = 'NATION_3' GROUP BY year, month""",
        doubles=("avg_drought_score", "avg_precipitation"), dates=("month_start",)),

    "rolling_trend": R("""
        SELECT *, avg(avg_drought_score) OVER w AS rolling_drought,
                  avg(avg_precipitation) OVER w AS rolling_precip
        FROM (SELECT State_or_Territory, year, month, avg(score) AS avg_drought_score,
                     avg(PRECTOT) AS avg_precipitation, make_date(year, month, 1) AS month_start
              FROM feat GROUP BY State_or_Territory, year, month) m
        WINDOW w AS (PARTITION BY State_or_Territory ORDER BY year, month
                     ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
        doubles=("avg_drought_score", "avg_precipitation", "rolling_drought", "rolling_precip"),
        dates=("month_start",)),

    "severe_share_by_region": R(f"""
        SELECT State_or_Territory, avg(score) AS avg_score, {_SEVERE} AS severe_weeks,
               count(score) AS total_weeks, {_SEVERE} / count(score) * 100.0 AS pct_severe
        FROM feat GROUP BY 1""", doubles=("avg_score", "pct_severe")),

    "worst_regions_top10": R(f"""
        SELECT * FROM (
          SELECT State_or_Territory, avg(score) AS avg_score, {_SEVERE} AS severe_weeks,
                 count(score) AS total_weeks, {_SEVERE} / count(score) * 100.0 AS pct_severe
          FROM feat GROUP BY 1) s
        ORDER BY pct_severe DESC NULLS LAST, State_or_Territory ASC NULLS FIRST LIMIT 10""",
        doubles=("avg_score", "pct_severe")),

    "county_risk_by_year": R(f"""
        SELECT year, {_PAD} AS fips, {_SEVERE} AS severe_weeks, count(score) AS total_weeks,
               {_SEVERE} / count(score) * 100.0 AS pct_severe_drought
        FROM feat GROUP BY year, 2""", doubles=("pct_severe_drought",)),

    "region_summary": R("SELECT * FROM summary",
                        doubles=("avg_drought_score", "avg_precip_mm", "avg_max_temp_c")),

    "region_summary_pct": R("SELECT * FROM summary_pct",
                            doubles=("avg_drought_score", "avg_precip_mm", "avg_max_temp_c",
                                     "drought_pct", "high_risk_pct")),

    "top20_regions": R("""
        SELECT *, County_Name || ', ' || State_or_Territory AS place FROM summary_pct
        ORDER BY avg_drought_score DESC NULLS LAST, State_or_Territory ASC NULLS FIRST,
                 County_Name ASC NULLS FIRST
        LIMIT 20""", doubles=("avg_drought_score", "avg_precip_mm", "avg_max_temp_c",
                              "drought_pct", "high_risk_pct")),

    "worst_region_drilldown": R("""
        SELECT s.*, avg(s.avg_drought_score) OVER (PARTITION BY s.State_or_Territory) AS state_mean
        FROM summary_pct s
        WHERE s.State_or_Territory = (
          SELECT State_or_Territory FROM summary_pct WHERE State_or_Territory IS NOT NULL
          ORDER BY avg_drought_score DESC NULLS LAST, State_or_Territory ASC NULLS FIRST,
                   County_Name ASC NULLS FIRST
          LIMIT 1)""", doubles=("avg_drought_score", "avg_precip_mm", "avg_max_temp_c",
                                "drought_pct", "high_risk_pct", "state_mean")),

    "captured_counts": R("""
        SELECT (SELECT count(*) FROM summary WHERE total_obs >= 10) AS regions_captured,
               (SELECT count(*) FROM month_trend WHERE year_month IS NOT NULL) AS months_captured"""),

    "month_bucket_trend": R("SELECT * FROM month_trend",
                            doubles=("avg_drought_score", "avg_precip_mm", "avg_temp_c")),

    "last10_months": R("""
        SELECT * FROM month_trend WHERE year_month IS NOT NULL
        ORDER BY year_month DESC LIMIT 10""",
        doubles=("avg_drought_score", "avg_precip_mm", "avg_temp_c")),

    "season_pivot": R(f"""
        SELECT substr(year_month, 1, 4) AS year,
        {_months_pivot()}
        FROM month_trend WHERE year_month IS NOT NULL GROUP BY 1""",
        doubles=_MONTHS),

    "label_distribution": R("SELECT drought_label, count(*) AS count FROM enr GROUP BY 1"),

    "label_weather_summary": R("""
        SELECT drought_label, count(*) AS count, round(avg(PRECTOT), 3) AS avg_precip,
               round(avg(T2M_MAX), 2) AS avg_max_temp, round(avg(WS10M), 2) AS avg_wind
        FROM enr GROUP BY 1""", doubles=("avg_precip", "avg_max_temp", "avg_wind")),

    "alert_feed": R("SELECT * FROM alerts", doubles=("score", "PRECTOT", "T2M_MAX", "WS10M")),

    "alert_summary": R("""
        SELECT drought_label, count(*) AS alert_count, round(avg(score), 2) AS avg_score,
               round(avg(PRECTOT), 3) AS avg_precip_mm, round(avg(T2M_MAX), 2) AS avg_max_temp_c,
               round(avg(WS10M), 2) AS avg_wind_ms
        FROM alerts GROUP BY 1""",
        doubles=("avg_score", "avg_precip_mm", "avg_max_temp_c", "avg_wind_ms")),

    "alert_frequency": R("""
        SELECT CAST(year(CAST(date AS DATE)) AS INTEGER) AS year, drought_label,
               count(*) AS alert_count
        FROM alerts WHERE drought_label <> 'Unknown' GROUP BY 1, 2"""),

    "alert_year_pivot": R("SELECT CAST(year(CAST(date AS DATE)) AS INTEGER) AS year, " + ", ".join(
        f"count(*) FILTER (WHERE drought_label = '{t}') AS \"{t}\"" for t in _severe_label_cols())
        + " FROM alerts WHERE drought_label <> 'Unknown' GROUP BY 1"),
}


# --- outliers, correlation -----------------------------------------------------

_BOX_COLS = _STATS_COLS
_CORR_COLS = list(_MEASURES)


def _box_body(values_sql: str) -> str:
    return f"""
    lv AS ({values_sql}),
    qs AS (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3
           FROM lv GROUP BY 1),
    f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence,
                 q3 + 1.5 * (q3 - q1) AS upper_fence FROM qs),
    b AS (
      SELECT f."column", any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
             any_value(iqr) AS iqr, any_value(lower_fence) AS lower_fence,
             any_value(upper_fence) AS upper_fence,
             count(*) AS n,
             count(*) FILTER (WHERE value < lower_fence OR value > upper_fence) AS n_outliers,
             min(value) FILTER (WHERE value >= lower_fence AND value <= upper_fence) AS whisker_low,
             max(value) FILTER (WHERE value >= lower_fence AND value <= upper_fence) AS whisker_high
      FROM f JOIN lv ON f."column" = lv."column" GROUP BY f."column")"""


def _values_of(table: str, cols) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS DOUBLE) AS value FROM {table}
            WHERE {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))""" for c in cols)


def _box(values_sql: str, select: str, doubles) -> str:
    body = _box_body(values_sql)
    return R(f"WITH {body.strip()}\nSELECT {select} FROM b", doubles=doubles)


ORACLE.update({
    "box_stats": _box(_values_of("feat", _BOX_COLS),
                      '"column", q1, median, q3, iqr, lower_fence, upper_fence, whisker_low, whisker_high',
                      ("q1", "median", "q3", "iqr", "lower_fence", "upper_fence",
                       "whisker_low", "whisker_high")),
    "outlier_fraction": _box(_values_of("feat", _BOX_COLS),
                             '"column", n, n_outliers, CAST(n_outliers AS DOUBLE) / n AS outlier_fraction',
                             ("outlier_fraction",)),
    "outlier_fraction_events": _box(_values_of("events", ["value"]),
                                    '"column", q1, median, q3, n, n_outliers, '
                                    'CAST(n_outliers AS DOUBLE) / n AS outlier_fraction',
                                    ("q1", "median", "q3", "outlier_fraction")),
    "correlation_long": R("\nUNION ALL\n".join(
        f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, corr({a}, {b}) AS corr FROM feat"
        for a in _CORR_COLS for b in _CORR_COLS), doubles=("corr",)),
})


# --- streaming keys: the batch SQL over the staged rows (score, PRECTOT and
# T2M_MAX not null), read back from the stream sinks ---------------------------

_ENR_S = "(SELECT * FROM enr WHERE PRECTOT IS NOT NULL AND T2M_MAX IS NOT NULL)"

ORACLE.update({
    "stream_region_summary": R(f"""
        SELECT State_or_Territory, County_Name, count(*) AS total_obs,
               round(avg(score), 3) AS avg_drought_score, round(avg(PRECTOT), 3) AS avg_precip_mm,
               round(avg(T2M_MAX), 2) AS avg_max_temp_c,
               CAST(sum(is_drought) AS BIGINT) AS drought_obs,
               CAST(sum(high_risk) AS BIGINT) AS high_risk_obs
        FROM {_ENR_S} e GROUP BY 1, 2""",
        doubles=("avg_drought_score", "avg_precip_mm", "avg_max_temp_c")),
    "stream_month_trend": R(f"""
        SELECT substr(CAST(date AS VARCHAR), 1, 7) AS year_month, count(*) AS obs_count,
               round(avg(score), 3) AS avg_drought_score, round(avg(PRECTOT), 3) AS avg_precip_mm,
               round(avg(T2M_MAX), 2) AS avg_temp_c, CAST(sum(is_drought) AS BIGINT) AS drought_obs
        FROM {_ENR_S} e GROUP BY 1""", doubles=("avg_drought_score", "avg_precip_mm", "avg_temp_c")),
    "stream_region_pct_sql": R(f"""
        SELECT *, round(drought_obs * 100.0 / total_obs, 1) AS drought_pct,
                  round(high_risk_obs * 100.0 / total_obs, 1) AS high_risk_pct
        FROM (SELECT State_or_Territory, County_Name, count(*) AS total_obs,
                     round(avg(score), 3) AS avg_drought_score,
                     round(avg(PRECTOT), 3) AS avg_precip_mm,
                     round(avg(T2M_MAX), 2) AS avg_max_temp_c,
                     CAST(sum(is_drought) AS BIGINT) AS drought_obs,
                     CAST(sum(high_risk) AS BIGINT) AS high_risk_obs
              FROM {_ENR_S} e GROUP BY 1, 2) s
        WHERE total_obs >= 10""",
        doubles=("avg_drought_score", "avg_precip_mm", "avg_max_temp_c", "drought_pct",
                 "high_risk_pct")),
    "stream_trend_sql": R(f"""
        SELECT substr(CAST(date AS VARCHAR), 1, 7) AS year_month, count(*) AS obs_count,
               round(avg(score), 3) AS avg_drought_score, round(avg(PRECTOT), 3) AS avg_precip_mm,
               round(avg(T2M_MAX), 2) AS avg_temp_c, CAST(sum(is_drought) AS BIGINT) AS drought_obs
        FROM {_ENR_S} e WHERE date IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 10""",
        doubles=("avg_drought_score", "avg_precip_mm", "avg_temp_c")),
    "stream_alert_summary_sql": R(f"""
        SELECT drought_label, count(*) AS alert_count, round(avg(score), 2) AS avg_score,
               round(avg(PRECTOT), 3) AS avg_precip_mm
        FROM {_ENR_S} e WHERE high_risk = 1 GROUP BY 1""", doubles=("avg_score", "avg_precip_mm")),
    "stream_alert_years_sql": R(f"""
        SELECT CAST(year(date) AS INTEGER) AS year, drought_label, count(*) AS alert_count
        FROM {_ENR_S} e WHERE high_risk = 1 AND drought_label <> 'Unknown' GROUP BY 1, 2"""),
    "stream_alerts": R(f"""
        SELECT State_or_Territory, County_Name, CAST(date AS VARCHAR) AS date, drought_label,
               score, PRECTOT, T2M_MAX, WS10M
        FROM {_ENR_S} e WHERE high_risk = 1""", doubles=("score", "PRECTOT", "T2M_MAX", "WS10M")),
    "stream_severe_memory": R(f"""
        SELECT State_or_Territory, count(*) AS alert_count
        FROM {_ENR_S} e WHERE score >= 5 GROUP BY 1"""),
    "stream_published": R(f"""
        SELECT drought_label, count(*) AS count FROM {_ENR_S} e WHERE high_risk = 1 GROUP BY 1"""),
    "stream_parquet_readback": R(f"""
        SELECT drought_label, count(*) AS count FROM {_ENR_S} e GROUP BY 1"""),
})


# --- models with an SQL form: per-county training mean, time split ------------

_BASELINE = """
    train AS (SELECT * FROM feat WHERE date < DATE '2000-01-01'),
    test AS (SELECT * FROM feat WHERE date >= DATE '2000-01-01'),
    cm AS (SELECT fips, avg(score) AS m FROM train GROUP BY fips),
    p AS (SELECT t.score, coalesce(cm.m, (SELECT avg(score) FROM train)) AS prediction
          FROM test t LEFT JOIN cm ON t.fips = cm.fips)"""

ORACLE.update({
    "regression_metrics": R(f"""
        WITH {_BASELINE.strip()},
        s AS (SELECT sqrt(avg((score - prediction) * (score - prediction))) AS rmse,
                     avg(abs(score - prediction)) AS mae,
                     1 - sum((score - prediction) * (score - prediction))
                         / sum((score - (SELECT avg(score) FROM p)) * (score - (SELECT avg(score) FROM p))) AS r2,
                     avg((score - prediction) * (score - prediction)) AS mse
              FROM p)
        SELECT 'county_mean' AS model, 'RMSE' AS Metric, rmse AS Value FROM s
        UNION ALL SELECT 'county_mean', 'MAE', mae FROM s
        UNION ALL SELECT 'county_mean', 'R²', r2 FROM s
        UNION ALL SELECT 'county_mean', 'MSE', mse FROM s""", doubles=("Value",)),
    "calibration_bins": R(f"""
        WITH {_BASELINE.strip()}
        SELECT round(score) AS score_bin, count(*) AS n, avg(score) AS avg_actual,
               avg(prediction) AS avg_prediction
        FROM p GROUP BY 1""", doubles=("score_bin", "avg_actual", "avg_prediction")),
})


ORACLE.update({
    "overall_mean_line": R("""
        SELECT 'ALL' AS scope, avg(avg_drought_score) AS mean_of_means FROM summary_pct
        UNION ALL
        SELECT State_or_Territory AS scope, avg(avg_drought_score) AS mean_of_means
        FROM summary_pct WHERE State_or_Territory IS NOT NULL GROUP BY 1""",
        doubles=("mean_of_means",)),
    "plot_ranges": R(f"""
        WITH cr AS (SELECT fips, {_SEVERE} AS sev, count(score) AS n FROM feat GROUP BY fips)
        SELECT (SELECT max(CAST(sev AS DOUBLE) / n * 100.0) FROM cr) AS max_pct_severe,
               (SELECT max(n) FROM cr) AS max_weeks,
               (SELECT min(score) FROM feat) AS min_score,
               (SELECT max(score) FROM feat) AS max_score""",
        doubles=("max_pct_severe", "min_score", "max_score")),
})


# --- tree models: sizes, label mean and baseline error by arithmetic keys; the
# model side states what any sound fit gives (it halves the baseline error) ------

_MODEL_ROWS = """
    rows AS (SELECT l_orderkey * 7 + l_linenumber AS row_key,
                    l_quantity / 12.0 + (l_tax * 100.0 + l_linenumber - l_tax * 100.0) / 8.0 AS score
             FROM lineitem),
    train AS (SELECT * FROM rows WHERE row_key % 5 <> 0),
    test AS (SELECT * FROM rows WHERE row_key % 5 = 0)"""
_FEATURES = ("lat", "lon", "PRECTOT", "T2M_MAX", "T2M_MIN", "WS10M", "QV2M", "PS", "T2MDEW",
             "T2M_RANGE", "elevation", "slope1", "aspectN", "aspectE", "WAT_LAND", "NVG_LAND",
             "URB_LAND", "GRS_LAND", "SQ1", "SQ2", "SQ3")


def _holdout(kind: str) -> str:
    return R(f"""
        WITH {_MODEL_ROWS.strip()}
        SELECT '{kind}' AS model, (SELECT count(*) FROM train) AS n_train, count(*) AS n_test,
               count(*) AS n_scored, avg(score) AS label_mean,
               sqrt(avg((score - (SELECT avg(score) FROM train))
                        * (score - (SELECT avg(score) FROM train)))) AS baseline_rmse,
               true AS halves_baseline, true AS explains_label
        FROM test""", doubles=("label_mean", "baseline_rmse"))


def _importance(kind: str) -> str:
    return R("\nUNION ALL\n".join(
        f"SELECT '{kind}' AS model, '{f}' AS feature, {'true' if f == 'PRECTOT' else 'false'} AS is_top, "
        "CAST(1.0 AS DOUBLE) AS total" for f in _FEATURES), doubles=("total",))


ORACLE.update({
    "rf_metrics": _holdout("random_forest"),
    "gbt_metrics": _holdout("gbt"),
    "rf_importance": _importance("random_forest"),
    "gbt_importance": _importance("gbt"),
    "rf_actual_vs_predicted": R(f"""
        WITH {_MODEL_ROWS.strip()}
        SELECT row_key, score, true AS is_near FROM rows WHERE row_key % 500 = 0""",
        doubles=("score",)),
    "score_prediction_range": R(f"""
        WITH {_BASELINE.strip()}
        SELECT least(min(score), min(prediction)) AS lowest,
               greatest(max(score), max(prediction)) AS highest FROM p""",
        doubles=("lowest", "highest")),
    "county_risk_from_csv": R(f"""
        SELECT {_PAD} AS fips, avg(score) AS overall_avg_score,
               {_SEVERE} AS weeks_in_severe_drought, count(score) AS total_weeks_recorded,
               {_SEVERE} / count(score) * 100.0 AS pct_severe_drought,
               (SELECT count(*) FROM obs_raw WHERE PRECTOT = 50 AND WS10M = 0) AS rows_rejected
        FROM feat WHERE NOT (PRECTOT = 50 AND WS10M = 0) GROUP BY 1""",
        doubles=("overall_avg_score", "pct_severe_drought")),
})


# --- mechanisms: the same tables by another way ---------------------------------

def _corr_gaps() -> str:
    gaps = ", ".join(f"CASE WHEN fips % {len(c) + 1} <> 0 THEN {c} END AS {c}" for c in _CORR_COLS)
    each = "\nUNION ALL\n".join(
        f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, corr({a}, {b}) AS corr FROM gaps"
        for a in _CORR_COLS for b in _CORR_COLS)
    return R(f"WITH gaps AS (SELECT {gaps} FROM feat)\n{each}", doubles=("corr",))


_BAD = "PRECTOT = 50 AND WS10M = 0"

ORACLE.update({
    "dedup_rows_digest": ORACLE["dedup_rows"],
    "salted_join": R("""
        SELECT s.NVG_LAND, count(*) AS n_rows, avg(o.score) AS avg_score
        FROM (SELECT CASE WHEN PRECTOT % 3 = 0 THEN 1011 ELSE fips END AS fips, score FROM obs_raw) o
        LEFT JOIN soil s ON o.fips = s.fips GROUP BY 1""", doubles=("NVG_LAND", "avg_score")),
    "incremental_county_risk": ORACLE["county_risk"],
    "correlation_nulls": _corr_gaps(),
    "stream_labels_seen": R(f"SELECT DISTINCT State_or_Territory, drought_label FROM {_ENR_S} e"),
    "stream_alerts_restarted": ORACLE["stream_alerts"],
    "stream_summary_restarted": ORACLE["stream_region_summary"],
    "stream_state": R(f"""
        SELECT CAST(fips AS VARCHAR) AS fips, count(*) AS n, CAST(sum(is_drought) AS BIGINT) AS drought_obs,
               max(score) AS top_score FROM {_ENR_S} e GROUP BY 1""", doubles=("top_score",)),
    "stream_rejects": R(f"""
        SELECT count(*) FILTER (NOT ({_BAD}) AND score IS NOT NULL) AS rows_good,
               sum(score) FILTER (NOT ({_BAD})) AS total_score,
               count(*) FILTER ({_BAD}) AS rows_rejected FROM obs_raw""", doubles=("total_score",)),
    "stream_progress": R(f"""
        SELECT count(*) AS rows_in, count(*) AS rows_read, count(*) FILTER ({_BAD}) AS rejected,
               count(*) FILTER (NOT ({_BAD}) AND score IS NULL) AS null_score FROM obs_raw"""),
    "random_split": """
        SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_lost, CAST(0 AS BIGINT) AS n_both,
               true AS share_within_bounds FROM lineitem""",
    **{f"{short}_compiled": f"""
        SELECT '{kind}' AS model, count(*) AS n_test, count(*) AS n_equal
        FROM lineitem WHERE (l_orderkey * 7 + l_linenumber) % 5 = 0"""
       for short, kind in (("rf", "random_forest"), ("gbt", "gbt"))},
})
