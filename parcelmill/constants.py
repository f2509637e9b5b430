"""Fixed values. Names, bounds and word lists that decide results; all of
them must keep exactly these values."""

# Property kind that all analysis works on.
HOME_TYPE = "Residential"

# Columns cast to date / to number when a feed is cleaned.
DATE_COLUMNS = ["CloseDate", "PurchaseContractDate", "ListingContractDate", "ContractStatusChangeDate"]
NUMBER_COLUMNS = [
    "ClosePrice", "ListPrice", "OriginalListPrice", "LivingArea", "LotSizeAcres",
    "BedroomsTotal", "BathroomsTotalInteger", "DaysOnMarket", "YearBuilt",
    "Latitude", "Longitude",
]

# Columns profiled by the distribution summary.
DESCRIBE_COLUMNS = [
    "ClosePrice", "ListPrice", "OriginalListPrice", "LivingArea", "LotSizeAcres",
    "BedroomsTotal", "BathroomsTotalInteger", "DaysOnMarket", "YearBuilt",
]
DESCRIBE_POINTS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]

# Columns whose completeness is always reported.
CORE_COLUMNS = [
    "ClosePrice", "ListPrice", "CloseDate", "LivingArea", "DaysOnMarket",
    "CountyOrParish", "PropertySubType", "Latitude", "Longitude",
]

# A column is dropped when its missing share is above this (strict), in percent.
SPARSE_PERCENT = 90
HALF_EMPTY_PERCENT = 50

# Plausible coordinates: latitude and longitude, low and high.
LATITUDE_RANGE = (32.5, 42.0)
LONGITUDE_RANGE = (-124.5, -114.1)

# Close / original list ratio outside this closed band is a typing error.
RATIO_BAND = (0.5, 2.0)

# Tukey fence width.
FENCE = 1.5

# Outlier fields of the two feeds and the flag each one sets.
SOLD_OUTLIERS = {
    "ClosePrice": "outlier_price_flag",
    "LivingArea": "outlier_area_flag",
    "DaysOnMarket": "outlier_dom_flag",
}
LISTED_OUTLIERS = {
    "ListPrice": "outlier_price_flag",
    "LivingArea": "outlier_area_flag",
    "DaysOnMarket": "outlier_dom_flag",
}

# Rule flags in report order.
VALUE_FLAGS = [
    "invalid_price_flag", "invalid_area_flag", "invalid_dom_flag",
    "invalid_beds_flag", "invalid_baths_flag",
]
DATE_FLAGS = ["listing_after_close_flag", "purchase_after_close_flag", "negative_timeline_flag"]
GEO_FLAGS = [
    "coord_missing_flag", "coord_zero_flag", "coord_positive_lon_flag", "coord_out_of_state_flag",
]
OUTLIER_FLAGS = ["outlier_price_flag", "outlier_area_flag", "outlier_dom_flag"]

# Flags that make a row a quality issue; the others do not.
QUALITY_FLAGS = [
    "outlier_price_flag", "outlier_area_flag", "outlier_dom_flag",
    "invalid_price_flag", "invalid_area_flag", "invalid_dom_flag",
    "listing_after_close_flag", "purchase_after_close_flag", "coord_missing_flag",
]

# Words that a text flag column may use for yes.
TRUE_WORDS = ["true", "1", "yes", "y", "t"]

# Lean extracts, in column order.
SOLD_EXTRACT = [
    "CountyOrParish", "City", "PostalCode", "MLSAreaMajor", "PropertyType", "PropertySubType",
    "ListOfficeName", "BuyerOfficeName", "ListAgentFullName", "BuyerAgentFullName",
    "CloseDate", "yr_mo", "close_year", "close_month",
    "ClosePrice", "ListPrice", "OriginalListPrice", "LivingArea",
    "BedroomsTotal", "BathroomsTotalInteger", "DaysOnMarket",
    "price_ratio", "close_to_original_list_ratio", "price_per_sqft",
    "listing_to_contract_days", "contract_to_close_days", "Latitude", "Longitude",
]
LISTED_EXTRACT = [
    "CountyOrParish", "City", "PostalCode", "MLSAreaMajor", "PropertyType", "PropertySubType",
    "MlsStatus", "ListOfficeName", "ListAgentFullName",
    "ListingContractDate", "yr_mo", "list_year", "list_month",
    "ListPrice", "OriginalListPrice", "ClosePrice", "LivingArea",
    "BedroomsTotal", "BathroomsTotalInteger", "DaysOnMarket",
    "list_price_per_sqft", "price_reduction_ratio", "close_to_list_ratio",
    "listing_to_contract_days", "contract_to_close_days", "Latitude", "Longitude",
]

# Columns made by the feature step of each feed.
SOLD_ENGINEERED = [
    "price_ratio", "close_to_original_list_ratio", "price_per_sqft", "close_year",
    "close_month", "yr_mo", "listing_to_contract_days", "contract_to_close_days",
]
LISTED_ENGINEERED = [
    "list_price_per_sqft", "price_reduction_ratio", "close_to_list_ratio", "list_year",
    "list_month", "yr_mo", "listing_to_contract_days", "contract_to_close_days",
]

# Market filters of the trend and ranking views.
MARKET_FILTERS = ["City", "CountyOrParish", "PostalCode", "PropertySubType"]

# Valuation model: target, inputs, and columns that would leak the answer.
VALUE_TARGET = "ClosePrice"
VALUE_NUMERIC = [
    "LivingArea", "BedroomsTotal", "BathroomsTotalInteger", "YearBuilt",
    "LotSizeSquareFeet", "GarageSpaces", "Latitude", "Longitude",
    "close_year", "close_month", "rate_30yr_fixed",
]
VALUE_BOOLEAN = ["PoolPrivateYN", "FireplaceYN", "ViewYN", "NewConstructionYN"]
VALUE_CATEGORY = ["PropertySubType", "CountyOrParish"]
LEAKAGE = frozenset([
    "ListPrice", "OriginalListPrice", "price_per_sqft", "price_ratio",
    "close_to_original_list_ratio", "DaysOnMarket",
    "listing_to_contract_days", "contract_to_close_days",
])
VALUE_TREES = {"maxIter": 500, "maxDepth": 8, "stepSize": 0.05, "subsamplingRate": 0.8,
               "featureSubsetStrategy": "0.8", "minInstancesPerNode": 5, "seed": 42}
VALUE_TEST_SHARE = 0.2
DRIVER_TOP = 15

# Forecast: months ahead, months held out, interval level, season length.
FORECAST_STEPS = 3
FORECAST_HOLDOUT = 3
FORECAST_LEVEL = 0.80
FORECAST_NORMAL_QUANTILE = 1.2815515655446004  # two-sided 80 %
SEASON = 12

# Isolation forest.
FOREST_FEATURES = [
    "ClosePrice", "LivingArea", "BedroomsTotal", "BathroomsTotalInteger",
    "DaysOnMarket", "price_per_sqft", "LotSizeSquareFeet", "YearBuilt",
]
FOREST_TREES = 200
FOREST_BAG = 256
FOREST_SHARE = 0.01
FOREST_SEED = 42
FOREST_EXAMPLES = 8

# Ranking sizes.
TOP_MARKETS = 8
TOP_PARTIES = 100
TOP_PARTIES_PER_MARKET = 5
QUERY_ROW_CAP = 2000

# Statement gate: words that never occur in a read-only statement, and
# functions that reach files or code outside the tables.
BLOCKED_WORDS = [
    "insert", "update", "delete", "drop", "alter", "create", "attach", "detach", "copy",
    "pragma", "export", "import", "install", "load", "call", "set", "truncate", "grant",
]
BLOCKED_FILE_CALLS = [
    "read_csv", "read_csv_auto", "read_text", "read_blob", "read_json", "read_json_auto",
    "read_parquet", "parquet_scan", "sniff_csv", "glob",
]
# The same kind of escape in Spark SQL: calls into the JVM, names built from
# text, and relations that are a file path behind a format name.
BLOCKED_SPARK_CALLS = ["reflect", "try_reflect", "java_method", "identifier"]
PATH_FORMATS = ["csv", "json", "parquet", "orc", "text", "avro", "xml", "binaryfile"]

# Outcomes of an attempt in the score rollup.
OUTCOMES = ["correct", "wrong", "exec_error", "guard_reject", "llm_fail"]
SOLVED_AT = 2
