"""Names, labels, bounds, patterns and messages that results must carry verbatim."""

# --- Fixed values: schema ----------------------------------------------------------------------
SOURCE_COLUMNS = [
    "country_name",
    "country_code",
    "region",
    "income_group",
    "year",
    "gdp_usd",
    "population",
    "life_expectancy",
    "unemployment_rate",
    "co2_emissions_per_capita",
    "access_to_electricity_pct",
    "source_file",
    "ingested_at",
]
INDICATORS = [
    "gdp_usd",
    "population",
    "life_expectancy",
    "unemployment_rate",
    "co2_emissions_per_capita",
    "access_to_electricity_pct",
]
DIM_ATTRIBUTES = ["country_name", "region", "income_group"]

# --- Fixed values: accepted bounds (None = open) -----------------------------------------------
BOUNDS = {
    "gdp_usd": (0, None),
    "population": (0, None),
    "life_expectancy": (0, 120),
    "unemployment_rate": (0, 100),
    "co2_emissions_per_capita": (0, None),
    "access_to_electricity_pct": (0, 100),
}

# --- Fixed values: types of the clean panel ----------------------------------------------------
CLEAN_TYPES = {
    "gdp_usd": "decimal(20,2)",
    "population": "bigint",
    "life_expectancy": "decimal(5,2)",
    "unemployment_rate": "decimal(5,2)",
    "co2_emissions_per_capita": "decimal(10,4)",
    "access_to_electricity_pct": "decimal(5,2)",
}
# Official values keep every digit of the source; Spark needs a declared scale.
OFFICIAL_DECIMAL = "decimal(38,15)"

# --- Fixed values: text patterns (\z, because $ also matches before a trailing newline) --------
YEAR_PLAIN = r"^[0-9]{4}\z"
YEAR_FISCAL = r"^FY[0-9]{4}\z"
YEAR_FLOAT = r"^[0-9]{4}\.0\z"
NUMBER_PLAIN = r"^-?[0-9]+([.][0-9]+)?\z"
NUMBER_SIGNED = r"^[+-]?[0-9]+([.][0-9]+)?\z"
NUMBER_COMMA = r"^[0-9]+,[0-9]+\z"
NUMBER_COMMA_SIGNED = r"^(-?[0-9]+),([0-9]+)\z"
NUMBER_PERCENT = r"^[0-9]+([.][0-9]+)?%\z"
NUMBER_CURRENCY = r"^[$][0-9,]+([.][0-9]+)?\z"
# Input formats of the numeric, integer and timestamp types, outer white space allowed.
INPUT_INTEGER = r"^\s*[+-]?[0-9]+\s*\z"
INPUT_NUMERIC = r"^\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\s*\z"
INPUT_TIMESTAMP = (
    r"^\s*([0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?)"
    r"\s*([Zz]|UTC|utc|GMT|gmt|[+-](0[0-9]|1[0-5])(:?[0-5][0-9](:?[0-5][0-9])?)?)?\s*\z"
)
NOT_FINITE = ["nan", "infinity", "+infinity", "-infinity", "inf", "+inf", "-inf"]

# --- Fixed values: audit vocabulary ------------------------------------------------------------
QUARANTINED = "quarantined"
CORRECTED = "corrected"
SET_TO_NULL = "set_to_null"
EXCLUDED_DUPLICATE = "excluded_duplicate"
EXCLUDING_ACTIONS = [QUARANTINED, EXCLUDED_DUPLICATE]
OUTSIDE_SCOPE = "outside_reference_scope"
YEAR_OUT_OF_RANGE = "year_out_of_range"
CODE_STANDARDIZED = "country_code_standardized"
YEAR_STANDARDIZED = "year_format_standardized"
REFERENCE_STANDARDIZED = "reference_values_standardized"
FORMAT_STANDARDIZED = "numeric_format_standardized"
MISSING_NUMERIC = "missing_numeric_value"
INVALID_NUMERIC = "invalid_numeric_value"
OUT_OF_RANGE = "numeric_out_of_range"
OVERFLOW = "numeric_overflow"  # of this library: a number with more digits than its type holds
DUPLICATE_KEY = "duplicate_country_year"
POPULATION_SCALE = "population_scale_corrected"
LIFE_DECIMAL = "life_expectancy_decimal_corrected"
GDP_UNIT = "gdp_unit_corrected"
DOCUMENTED_ISSUES = [POPULATION_SCALE, LIFE_DECIMAL, GDP_UNIT]
PART_SEPARATOR = " | "
MISSING_MARK = "[missing]"

# --- Fixed values: profiling labels ------------------------------------------------------------
AGGREGATE_CODES = ["EUU", "WLD"]
LABEL_AGGREGATE = "aggregate entity"
LABEL_CODE_MISMATCH = "country-code mismatch"
LABEL_OUTSIDE = "outside approved reference scope"
LABEL_YEAR_MISSING = "missing year"
LABEL_YEAR_FORMAT = "invalid year format"

# --- Fixed values: gate messages, in the order in which the first failing one is reported ------
MESSAGE_ROWS = "Expected {rows} staging rows"
MESSAGE_IDENTITY = "Invalid country, year, source or ingestion timestamp"
MESSAGE_VALUES = "Missing, nonnumeric or nonfinite indicator value"
MESSAGE_RANGES = "Year or indicator value outside the accepted range"
MESSAGE_DUPLICATE = "Duplicate country-year combination"
MAX_POPULATION = 9223372036854775807

# --- Fixed values: run states, retention, report columns ---------------------------------------
RUNNING, SUCCEEDED, FAILED = "running", "succeeded", "failed"
KEEP_NEWEST = 3
SNAPSHOT_DAYS = 180
LOG_DAYS = 90
SNAPSHOT_NAME = r"^(\d{4}-\d{2}-\d{2}_\d{6}_\d{6}Z)\z"
LOG_NAME = r"^pipeline_(\d{8}T\d{6}_\d{6}Z)\.log\z"
SNAPSHOT_FORMAT = "yyyy-MM-dd_HHmmss_SSSSSS'Z'"
LOG_FORMAT = "yyyyMMdd'T'HHmmss_SSSSSS'Z'"
CHANGE_REPORT_COLUMNS = [
    "country_name",
    "country_code",
    "electricity_change_pp",
    "life_expectancy_change_years",
]
COMPARISON_REPORT_COLUMNS = [
    "country_name",
    "country_code",
    "year",
    "gdp_per_capita_current_usd",
    "life_expectancy_years",
    "access_to_electricity_pct",
]
MESSAGE_REPORT_COLUMNS = "Unexpected report CSV columns."
MESSAGE_REPORT_ROWS = "Expected {rows} unique countries in the report."
