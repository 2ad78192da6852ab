"""Schemas and fixed names shared by batch and streaming code."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the trained models' expectations) -------------
# The 27 model inputs, in the one order used for training and serving.
FEATURES = (
    "price_to_sma5", "price_to_sma10", "price_to_sma20", "price_momentum",
    "body", "range", "upper_wick", "lower_wick",
    "high_lag1", "high_lag2", "high_lag3", "high_lag4", "high_lag5", "high_lag6",
    "close_lag3", "close_lag4",
    "open_lag3", "open_lag5", "open_lag6",
    "number_of_trades_lag1", "number_of_trades_lag2", "number_of_trades_lag3",
    "taker_buy_quote_asset_volume_lag1", "taker_buy_quote_asset_volume_lag2",
    "taker_buy_quote_asset_volume_lag3",
    "bb_position", "atr_10",
)

# Lags computed for every candle (close lags 1..LOOKBACK are added on top).
LOOKBACK = 20
LAGS = {
    "high": (1, 2, 3, 4, 5, 6),
    "close": tuple(range(1, LOOKBACK + 1)),
    "open": (3, 5, 6),
    "number_of_trades": (1, 2, 3),
    "taker_buy_quote_asset_volume": (1, 2, 3),
}
WINDOW_SIZE = LOOKBACK + 1          # candles held per symbol by the live scorer
CANDLE_MINUTES = 30
VALID_INTERVALS = ("1m", "30m")
# -----------------------------------------------------------------------------

# Columns of a candle (bar) table, keyed by (symbol, open_time).
CANDLE_COLUMNS = ("symbol", "open_time", "open", "high", "low", "close", "volume",
                  "number_of_trades", "taker_buy_quote_asset_volume")

CANDLE_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("open_time", T.LongType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("number_of_trades", T.LongType()),
    T.StructField("taker_buy_quote_asset_volume", T.DoubleType()),
])

# --- fixed values: wire formats of the bus and the exchange --------------------
# The flat candle record carried on the message bus (13 fields, all nullable).
STREAM_RECORD_SCHEMA = T.StructType([
    T.StructField("open_time", T.LongType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("quote_asset_volume", T.DoubleType()),
    T.StructField("number_of_trades", T.IntegerType()),
    T.StructField("taker_buy_base_asset_volume", T.DoubleType()),
    T.StructField("taker_buy_quote_asset_volume", T.DoubleType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("interval", T.StringType()),
    T.StructField("ingested_at", T.StringType()),
])

# Exchange kline event: optional ``data`` envelope, numbers sent as text.
_KLINE = T.StructType([
    T.StructField("t", T.LongType()),
    T.StructField("o", T.StringType()),
    T.StructField("h", T.StringType()),
    T.StructField("l", T.StringType()),
    T.StructField("c", T.StringType()),
    T.StructField("v", T.StringType()),
    T.StructField("q", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("V", T.StringType()),
    T.StructField("Q", T.StringType()),
    T.StructField("i", T.StringType()),
    T.StructField("x", T.BooleanType()),
])
_EVENT_BODY = T.StructType([
    T.StructField("s", T.StringType()),
    T.StructField("k", _KLINE),
])
EXCHANGE_EVENT_SCHEMA = T.StructType([
    T.StructField("data", _EVENT_BODY),
    T.StructField("s", T.StringType()),
    T.StructField("k", _KLINE),
])

# The same kline struct with unambiguous names (Spark resolves names without
# case, so "v"/"V" and "q"/"Q" clash); structs cast by position.
KLINE_NAMED = T.StructType([
    T.StructField(n, f.dataType) for n, f in zip(
        ("t", "o", "h", "l", "c", "vol", "quote", "n", "taker_base", "taker_quote", "i", "x"),
        _KLINE.fields)
])

# REST kline response: a JSON array of positional arrays.
KLINE_ARRAY_SCHEMA = T.ArrayType(T.ArrayType(T.StringType()))
# -----------------------------------------------------------------------------


def interval_ms(interval: str) -> int:
    """'1m' -> 60000, '30m' -> 1800000, '1h' -> 3600000, '1d' -> 86400000."""
    units = {"s": 1_000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}
    return int(interval[:-1]) * units[interval[-1]]
