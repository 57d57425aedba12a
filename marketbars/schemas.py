"""Table shapes, column lists and the fixed values of the bar warehouse."""

from __future__ import annotations

from pyspark.sql import types as T

# The warehouse's contract with its users.
DEFAULT_SYMBOLS = ("AAPL", "GOOGL", "MSFT")
DEFAULT_START = "2020-01-01"
WEEKLY_ROWS = 7
MONTHLY_ROWS = 30
HORIZON_DAYS = 30
UP_PERCENT = 3.0
DOWN_PERCENT = -3.0
HIGH_POSITIVE = "High Positive Change"
HIGH_NEGATIVE = "High Negative Change"
NORMAL = "Normal"
SYMBOL_LENGTH = 10
LANDING_TABLE = "stock_data"
BRONZE_TABLE = "stock_data_bronze"
SILVER_TABLE = "stock_data_silver"
GOLD_TABLE = "stock_data_gold"
FORECAST_CLOSE_TABLE = "future_predictions_close"
FORECAST_AVG_CLOSE_TABLE = "future_predictions_avg_close"

KEY = ("date", "symbol")
MONTH = "month"  # storage partition of the bar tables, first day of the bar's month

# The landing feed as files hold it. `seq` is the arrival order inside a file.
FEED = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        T.StructField("Symbol", T.StringType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("High", T.DoubleType()),
        T.StructField("Low", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Volume", T.LongType()),
        T.StructField("Dividends", T.DoubleType()),
        T.StructField("Stock Splits", T.DoubleType()),
        T.StructField("seq", T.LongType()),
    ]
)

BARS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("dividends", T.DoubleType()),
        T.StructField("stock_splits", T.DoubleType()),
    ]
)
BAR_COLUMNS = tuple(BARS.fieldNames())

SILVER_COLUMNS = BAR_COLUMNS + (
    "prev_close",
    "daily_change",
    "daily_change_percent",
    "weekly_ma",
    "monthly_ma",
    "monthly_volatility",
)

GOLD_COLUMNS = (
    "date",
    "symbol",
    "avg_open",
    "avg_high",
    "avg_low",
    "avg_close",
    "total_volume",
    "total_dividends",
    "total_stock_splits",
    "avg_daily_change",
    "avg_daily_change_percent",
    "avg_weekly_ma",
    "avg_monthly_ma",
    "avg_monthly_volatility",
    "anomaly_type",
)

FORECAST_COLUMNS = ("date", "symbol", "predicted_close")

_BAR_DDL = f"""
    date DATE NOT NULL,
    symbol VARCHAR({SYMBOL_LENGTH}) NOT NULL,
    open DOUBLE,
    high DOUBLE,
    low DOUBLE,
    close DOUBLE,
    volume BIGINT,
    dividends DOUBLE,
    stock_splits DOUBLE"""

BAR_TABLE_DDL = f"({_BAR_DDL}, {MONTH} DATE) USING parquet PARTITIONED BY ({MONTH})"

SILVER_TABLE_DDL = f"""({_BAR_DDL},
    prev_close DOUBLE,
    daily_change DOUBLE,
    daily_change_percent DOUBLE,
    weekly_ma DOUBLE,
    monthly_ma DOUBLE,
    monthly_volatility DOUBLE,
    {MONTH} DATE) USING parquet PARTITIONED BY ({MONTH})"""

FORECAST_TABLE_DDL = f"""(
    date DATE NOT NULL,
    symbol VARCHAR({SYMBOL_LENGTH}) NOT NULL,
    predicted_close DOUBLE NOT NULL) USING parquet"""
