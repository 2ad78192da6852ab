"""Event-time candle resampling on a stream (STR-2, STR-8).

Ticks or 1-minute records are bucketed with ``window`` under a watermark;
append mode emits a candle once the watermark passes its end, so a late or
misaligned start never splits a candle (the count-of-arrivals buffer it
replaces did). Records older than the watermark are dropped by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.functions.time import epoch_micros


def stream_candles(bars: DataFrame, candle_minutes: int = 30, watermark: str = "10 minutes",
                   time_col: str = "open_time", order_col: str | None = None, once: bool = False) -> DataFrame:
    """Streaming (or batch) bars -> candles; open_time is the window start in ms.
    ``once``: of bars of one symbol and time only the first that arrives counts
    (re-sent bars within the watermark)."""
    us = epoch_micros(bars, time_col)
    prepared = bars.select(
        "symbol", F.timestamp_micros(us).alias("_event"),
        (F.col(order_col).cast("long") if order_col else us).alias("_t"),
        "open", "high", "low", "close", "volume", "number_of_trades",
        "taker_buy_quote_asset_volume")
    prepared = prepared.withWatermark("_event", watermark)
    if once:
        prepared = prepared.dropDuplicatesWithinWatermark(["symbol", "_t"])
    agg = (prepared
           .groupBy("symbol", F.window("_event", f"{candle_minutes} minutes").alias("_w"))
           .agg(F.min_by("open", "_t").alias("open"), F.max("high").alias("high"),
                F.min("low").alias("low"), F.max_by("close", "_t").alias("close"),
                F.sum("volume").alias("volume"),
                F.sum(F.col("number_of_trades").cast("long")).alias("number_of_trades"),
                F.sum("taker_buy_quote_asset_volume").alias("taker_buy_quote_asset_volume")))
    return agg.select("symbol", F.unix_millis(F.col("_w.start")).alias("open_time"),
                      "open", "high", "low", "close", "volume", "number_of_trades",
                      "taker_buy_quote_asset_volume")
