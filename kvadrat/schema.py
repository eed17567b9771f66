"""Column contracts and fixed values of the listings model.

Everything under "fixed values" must equal the surveyed project's values for results to
match (column names and order, thresholds, labels, word lists). They are stated here once,
plainly, and imported everywhere else.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# fixed values
# ---------------------------------------------------------------------------

RAW_COLUMNS = [
    "title",
    "description",
    "area_m2",
    "price_eur",
    "city",
    "region",
    "street",
    "heating_type",
    "rooms",
    "parking",
    "raw_floor_string",
    "year_built",
    "url",
]

MODELING_COLUMNS = [
    "area_m2",
    "price_eur",
    "city",
    "region",
    "heating_type",
    "rooms",
    "parking",
    "raw_floor_string",
    "year_built",
]

NUMERIC_RAW_COLUMNS = ["area_m2", "price_eur", "rooms", "year_built"]

TARGET = "price_eur"

COMPOSITE_KEY = ["title", "description", "area_m2", "price_eur", "city"]

MODEL_NUMERIC_FEATURES = [
    "area_m2",
    "rooms",
    "floor",
    "total_floors",
    "is_last_floor",
    "year_built",
    "building_age",
    "is_lux",
    "is_penthouse",
    "is_duplex",
]

MODEL_CATEGORICAL_FEATURES = ["city", "region", "city_region", "heating_type", "parking"]

TEXT_FLAG_COLUMNS = ["is_lux", "is_penthouse", "is_duplex"]

CATEGORICAL_COLUMNS_TO_NORMALIZE = [
    "city",
    "region",
    "street",
    "heating_type",
    "parking",
    "raw_floor_string",
]

UNKNOWN = "Nepoznato"
PLACEHOLDERS = ["-", ""]
CURRENT_YEAR = 2026

# inclusive quality ranges of the cleaned dataset
AREA_RANGE = (10, 500)
PRICE_RANGE = (10_000, 1_000_000)
ROOMS_RANGE = (0.5, 10)
YEAR_RANGE = (1800, 2028)

# inclusive ranges checked when scoring a property
FLOOR_RANGE = (-5, 200)
TOTAL_FLOORS_RANGE = (0, 200)

# text flag patterns: whole words in lower(title + " " + description)
LUX_WORDS = ["lux", "luks"]
PENTHOUSE_WORDS = ["penthouse", "penthaus"]
DUPLEX_WORDS = ["duplex", "dupleks"]

# pandas' default missing-value tokens when reading CSV
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# candidate models: (display name, model key)
DEFAULT_MODEL_CANDIDATES = [
    ("Baseline - DummyRegressor median", "dummy_median"),
    ("LinearRegression", "linear_regression"),
    ("RidgeRegression", "ridge_regression"),
    ("RandomForestRegressor", "random_forest"),
    ("ExtraTreesRegressor", "extra_trees"),
    ("ExtraTreesRegressor log target", "extra_trees_log_target"),
    ("GradientBoostingRegressor", "gradient_boosting"),
    ("HistGradientBoostingRegressor", "hist_gradient_boosting"),
    ("HistGradientBoostingRegressor log target", "hist_gradient_boosting_log_target"),
    ("CatBoostRegressor", "catboost"),
    ("CatBoostRegressor log target", "catboost_log_target"),
    ("XGBoostRegressor", "xgboost"),
    ("XGBoostRegressor log target", "xgboost_log_target"),
]
LOG_TARGET_SUFFIX = "_log_target"
RANDOM_STATE = 42
TEST_SIZE = 0.2

# crawl frontier: listing host, listing-path rule, page size and filter partitions
BASE_HOST = "https://www.nekretnine.rs"
BASE_NETLOC = "www.nekretnine.rs"
LISTING_PATH_PATTERN = r"/Nk[-_A-Za-z0-9]+/?$"
PAGE_SIZE = 50
DEFAULT_MAX_PAGES_PER_SOURCE = 200
PRICE_RANGES = [
    "0_50000",
    "50001_100000",
    "100001_150000",
    "150001_200000",
    "200001_300000",
    "300001_500000",
    "500001_1000000",
    "1000001_5000000",
    "5000001_10000000",
]
AREA_RANGES = [
    "1_30",
    "31_40",
    "41_50",
    "51_60",
    "61_75",
    "76_100",
    "101_150",
    "151_250",
    "251_500",
    "501_5000",
]
PARTITION_PATH = "/stambeni-objekti/stanovi/izdavanje-prodaja/prodaja/{kind}/{value}/lista/po-stranici/20/"

# Cyrillic letters that look like Latin ones, mapped when normalizing detail keys
CYRILLIC_FROM = "аејкмопстхАЕЈКМОПСТХ"
CYRILLIC_TO = "aejkmopsthaejkmopsth"

PARKING_KEYWORDS = ["parking", "garaza", "garazno mesto", "spoljno parking mesto"]

# detail keys read from a listing page
KEY_AREA = "kvadratura"
KEY_ROOMS_MAIN = "sobe"
KEY_ROOMS_AMENITY = "ukupan broj soba"
KEY_HEATING = "grejanje"
KEY_PARKING = "parking"
KEY_FLOOR_MAIN = "sprat"
KEY_FLOOR_AMENITY = "spratnost"
KEY_TOTAL_FLOORS = "ukupan broj spratova"
KEY_YEAR = "godina izgradnje"

# ---------------------------------------------------------------------------
# Spark schemas
# ---------------------------------------------------------------------------

RAW_STRING_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

RAW_TYPED_SCHEMA = T.StructType(
    [
        T.StructField(c, T.DoubleType() if c in NUMERIC_RAW_COLUMNS else T.StringType(), True)
        for c in RAW_COLUMNS
    ]
)

PAGES_SCHEMA = T.StructType(
    [T.StructField("url", T.StringType(), True), T.StructField("html", T.StringType(), True)]
)


def model_feature_columns() -> list[str]:
    """The 15 model inputs in stable order; never the target or price_per_m2."""
    return MODEL_NUMERIC_FEATURES + MODEL_CATEGORICAL_FEATURES
