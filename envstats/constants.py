"""Fixed values that results depend on.

Everything in this module is a value that must equal the analysed
application's own constants for results to match (labels, display names,
column lists, the known repair row).  They are listed plainly and in their
natural order; no logic lives here.
"""

from __future__ import annotations

# --- fixed values: drought severity labels for exact scores 0..5 -------------
SEVERITY_LABELS = (
    (0, "D0 - No Drought"),
    (1, "D1 - Abnormally Dry"),
    (2, "D2 - Moderate Drought"),
    (3, "D3 - Severe Drought"),
    (4, "D4 - Extreme Drought"),
    (5, "D5 - Exceptional Drought"),
)
UNKNOWN_LABEL = "Unknown"

# --- fixed values: land-use columns and their display names ------------------
LAND_USE_NAMES = {
    "WAT_LAND": "Water",
    "NVG_LAND": "Natural Vegetation",
    "URB_LAND": "Urban",
    "GRS_LAND": "Grassland",
    "FOR_LAND": "Forest",
    "CULTRF_LAND": "Cultivated Rainfed",
    "CULTIR_LAND": "Cultivated Irrigated",
    "CULT_LAND": "Cultivated",
}
LAND_USE_COLUMNS = tuple(LAND_USE_NAMES)

# --- fixed values: month short names, January first --------------------------
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun",
               "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# --- fixed values: the 18 meteorological measures of the correlation matrix --
METEO_COLUMNS = (
    "T2M", "T2MDEW", "T2MWET", "T2M_MAX", "T2M_MIN", "T2M_RANGE", "TS", "QV2M",
    "WS10M", "WS10M_MAX", "WS10M_MIN", "WS10M_RANGE",
    "WS50M", "WS50M_MAX", "WS50M_MIN", "WS50M_RANGE",
    "PS", "PRECTOT",
)

# --- fixed values: numeric columns screened for outliers ---------------------
OUTLIER_COLUMNS = (
    "PRECTOT", "PS", "QV2M", "T2M", "T2MDEW", "T2MWET", "T2M_MAX", "T2M_MIN",
    "T2M_RANGE", "TS", "WS10M", "WS10M_MAX", "WS10M_MIN", "WS10M_RANGE", "WS50M",
    "WS50M_MAX", "WS50M_MIN", "WS50M_RANGE", "score", "elevation", "slope1",
    "slope2", "slope3", "slope4", "slope5", "slope6", "slope7", "slope8",
    "aspectN", "aspectE", "aspectS", "aspectW", "aspectUnknown", "WAT_LAND",
    "NVG_LAND", "URB_LAND", "GRS_LAND", "FOR_LAND", "CULTRF_LAND", "CULTIR_LAND",
    "CULT_LAND", "SQ1", "SQ2", "SQ3", "SQ4", "SQ5", "SQ6", "SQ7",
)

# --- fixed values: the 21 model features -------------------------------------
MODEL_FEATURES = (
    "lat", "lon",
    "PRECTOT", "T2M_MAX", "T2M_MIN", "WS10M",
    "QV2M", "PS", "T2MDEW", "T2M_RANGE",
    "elevation", "slope1",
    "aspectN", "aspectE",
    "WAT_LAND", "NVG_LAND", "URB_LAND", "GRS_LAND",
    "SQ1", "SQ2", "SQ3",
)

# --- fixed values: stream input columns, in file order -----------------------
STREAM_COLUMNS = (
    "fips", "State_or_Territory", "County_Name", "date", "lat", "lon",
    "PRECTOT", "T2M", "T2M_MAX", "T2M_MIN", "WS10M", "score",
)

# --- fixed values: regression metric labels, in table order ------------------
METRIC_NAMES = ("RMSE", "MAE", "R²", "MSE")

# --- fixed values: model settings --------------------------------------------
RF_PARAMS = {"numTrees": 50, "maxDepth": 8, "seed": 42}
GBT_PARAMS = {"maxIter": 50, "maxDepth": 5, "stepSize": 0.1, "seed": 42}
SPLIT_WEIGHTS = (0.8, 0.2)
SPLIT_SEED = 42
ROLLING_ROWS = 6
SEVERE_THRESHOLD = 3.0
DROUGHT_THRESHOLD = 1.0
MIN_SUPPORT = 10
STREAM_CHUNK_ROWS = 100_000
