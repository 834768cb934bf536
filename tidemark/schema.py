"""Table schemas and fixed values."""

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
PAYLOAD_WRAPPER = "Time Series (Daily)"
PAYLOAD_FIELDS = {
    "open": "1. open",
    "high": "2. high",
    "low": "3. low",
    "close": "4. close",
    "volume": "5. volume",
}
TRAILING_ROWS = 30
TEST_ROWS = 2000
TRAIN_WINDOW, VALIDATION_WINDOW, FOLD_GAP = 1000, 500, 100
HYPERBAND_BUDGET, HALVING_FACTOR = 100, 4
PATIENCE, TOLERANCE = 10, 1e-5
BUFFER_ROWS, MICRO_BATCH_ROWS, DRIFT_ROWS = 300, 4, 1024
POLL_SECONDS = 1
REFERENCE_DAYS = 3
PRODUCTION_WINDOW = 7
BATCH_ROWS = 32
DRIFT_LEVEL = 0.05
CLIP_NORM = 1.0
LEARNING_RATE_RANGE = (1e-5, 1e-2)

NUMERIC_COLUMNS = [
    "open", "high", "low", "volume", "ave_open", "ave_high", "ave_low",
    "ave_close", "total_volume", "30_day_ma_close", "timestamp_in_ms",
]
CATEGORICAL_COLUMNS = ["dt", "year", "month", "date"]
TARGET = "close"

QUALITY_CHECK, QUALITY_LEVEL = "Weekly Stock Data Check", "Warning"
QUALITY_RULES = [
    ("size", None, ">", 0.0),
    ("completeness", "close", "=", 1.0),
    ("completeness", "volume", "=", 1.0),
    ("min", "open", ">", 0.0),
    ("max", "volume", "<", 10000000000.0),
]

PROVIDER_NAMES = {
    "Open": "open", "High": "high", "Low": "low",
    "Close": "close", "Volume": "volume", "Datetime": "dt",
}
PROVIDER_EXTRAS = ["Dividends", "Stock Splits"]
REFERENCE_COLUMNS = ["open", "high", "low", "close", "volume", "dt"]
CLOCK_COLUMNS = ["dt", "timestamp_in_ms"]
# ----------------------------------------------------------------------------

# The target's logged copy and the per-row date would leak the answer or never repeat,
# so they are kept in gold but are not features unless asked for.
DEFAULT_NUMERIC = [c for c in NUMERIC_COLUMNS if c != "ave_close"]
DEFAULT_CATEGORICAL = [c for c in CATEGORICAL_COLUMNS if c != "dt"]

SERIES_KEY = ["series"]
BAR_KEY = ["series", "dt"]


def _fields(*specs):
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in specs])


RAW_BAR = T.StructType([T.StructField(f, T.StringType()) for f in PAYLOAD_FIELDS.values()])
RAW_PAYLOAD = T.MapType(T.StringType(), RAW_BAR)

SILVER = _fields(
    ("series", T.StringType(), False),
    ("dt", T.DateType(), False),
    ("open", T.FloatType(), False),
    ("high", T.FloatType(), False),
    ("low", T.FloatType(), False),
    ("close", T.FloatType(), False),
    ("volume", T.LongType(), False),
    ("timestamp_in_ms", T.LongType(), False),
)

GOLD = _fields(
    ("series", T.StringType(), False),
    ("dt", T.DateType(), False),
    ("open", T.FloatType(), False),
    ("high", T.FloatType(), False),
    ("low", T.FloatType(), False),
    ("close", T.DoubleType(), False),
    ("volume", T.LongType(), False),
    ("timestamp_in_ms", T.LongType(), False),
    ("ave_open", T.FloatType(), False),
    ("ave_high", T.FloatType(), False),
    ("ave_low", T.FloatType(), False),
    ("ave_close", T.DoubleType(), False),
    ("total_volume", T.LongType(), False),
    ("30_day_ma_close", T.DoubleType(), False),
    ("year", T.IntegerType(), False),
    ("month", T.IntegerType(), False),
    ("date", T.IntegerType(), False),
)

# One message is a JSON array of these; dt travels as ISO 8601 text.
RECORD = _fields(
    ("series", T.StringType(), True),
    ("open", T.DoubleType(), True),
    ("high", T.DoubleType(), True),
    ("low", T.DoubleType(), True),
    ("close", T.DoubleType(), True),
    ("volume", T.LongType(), True),
    ("dt", T.StringType(), True),
    ("timestamp_in_ms", T.LongType(), True),
)
