"""Stored tables as raw bus messages, input for the ingest queries and tests.

Each ``events`` row becomes one exchange kline message (a one-trade 1-minute
candle, or a 30-minute one for a share of rows), in the exchange's nested
layout, with numbers as text. A fixed share of messages carries the defects
the parsers must reject; which ones is a function of ``event_id``, so the same
rows are defective on every run and in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.functions.time import ISO_UTC, epoch_micros, floor_to, millis_to_utc_text

# --- fixed defect plan (event_id modulus, remainder) --------------------------
UNCLOSED = (29, 1)      # "x": false
NO_KLINE = (31, 2)      # no "k" object
BAD_NUMBER = (37, 3)    # close is "n/a"
TRUNCATED = (41, 4)     # text cut short
BAD_INTERVAL = (43, 5)  # interval "5m"
HALF_HOUR = (5, 0)      # sent as a 30-minute candle
ENVELOPE = (2, 0)       # wrapped in {"data": ...}
# -----------------------------------------------------------------------------


def _is(rule: tuple[int, int]) -> Column:
    m, r = rule
    return F.col("event_id") % m == r


def exchange_messages(events: DataFrame) -> DataFrame:
    """``events`` -> one JSON text per row in column ``value``."""
    us = epoch_micros(events, "ts")
    half_hour = _is(HALF_HOUR)
    step_us = F.when(half_hour, F.lit(1_800_000_000)).otherwise(F.lit(60_000_000))
    t_ms = ((us - F.pmod(us, step_us)) / F.lit(1000)).cast("long")
    price = F.col("value").cast("string")
    taker = F.when(F.col("user_id") % 2 == 0, F.col("value")).otherwise(F.lit(0.0)).cast("string")
    interval = (F.when(_is(BAD_INTERVAL), F.lit("5m"))
                .when(half_hour, F.lit("30m")).otherwise(F.lit("1m")))
    kline = F.struct(
        t_ms.alias("t"), price.alias("o"), price.alias("h"), price.alias("l"),
        F.when(_is(BAD_NUMBER), F.lit("n/a")).otherwise(price).alias("c"),
        price.alias("v"), price.alias("q"), F.lit(1).alias("n"),
        F.lit("0.0").alias("V"), taker.alias("Q"), interval.alias("i"),
        (~_is(UNCLOSED)).alias("x"))
    body = F.struct(F.lower("event_type").alias("s"),
                    F.when(~_is(NO_KLINE), kline).alias("k"))
    text = F.when(_is(ENVELOPE), F.to_json(F.struct(body.alias("data")))).otherwise(F.to_json(body))
    raw = events.select(text.alias("_t"), "event_id")
    cut = F.expr("substring(_t, 1, length(_t) - 3)")
    return raw.select(F.when(_is(TRUNCATED), cut).otherwise(F.col("_t")).alias("value"))


def kline_responses(events: DataFrame, rows_per_response: int = 100) -> DataFrame:
    """``events`` -> REST-style responses: (symbol, interval, response) where
    response is a JSON array of positional arrays, at most ``rows_per_response``
    per response (grouped by event_id blocks, so groups stay bounded).

    Position 6 (close time) is the bar end; numbers are text except the open
    time and trade count. Rows with event_id % 37 == 3 carry "n/a" as close.
    """
    us = epoch_micros(events, "ts")
    t_ms = (floor_to(us, 60_000_000) / F.lit(1000)).cast("long")
    price = F.col("value").cast("string")
    taker = F.when(F.col("user_id") % 2 == 0, F.col("value")).otherwise(F.lit(0.0)).cast("string")
    close = F.when(_is(BAD_NUMBER), F.lit("n/a")).otherwise(price)
    arr = F.array(t_ms.cast("string"), price, price, price, close, price,
                  (t_ms + F.lit(59_999)).cast("string"), price, F.lit("1"), F.lit("0.0"), taker,
                  F.lit("0"))
    grouped = (events.select(F.upper("event_type").alias("symbol"),
                             (F.col("event_id") / F.lit(rows_per_response)).cast("long").alias("_blk"),
                             arr.alias("_a"))
               .groupBy("symbol", "_blk").agg(F.collect_list("_a").alias("_arrs")))
    # numbers (open time, trade count) are written as JSON numbers
    resp = F.regexp_replace(F.to_json("_arrs"), r'\["(-?\d+)"', "[$1")
    resp = F.regexp_replace(resp, r',"1","0.0",', ',1,"0.0",')
    return grouped.select("symbol", F.lit("1m").alias("interval"), resp.alias("response"))


def candle_versions(candles: DataFrame, interval: str = "30m") -> DataFrame:
    """Re-send every candle as the bus would: an unclosed snapshot a third
    of the bar in (close off by 0.1%), the closed candle 5 s after its end, and for every
    seventh bucket a correction 15 minutes later (volume + 1), for every
    eleventh one more copy with the closed candle's stamp (volume - 1)."""
    step_ms = 1_800_000 if interval == "30m" else 60_000

    def iso(ms: Column) -> Column:
        return millis_to_utc_text(ms, ISO_UTC)

    base = candles.select("symbol", "open_time", "open", "high", "low", "close", "volume",
                          "number_of_trades", "taker_buy_quote_asset_volume")
    snap = base.withColumn("close", F.col("close") * F.lit(0.999)).withColumn(
        "ingested_at", iso(F.col("open_time") + F.lit(step_ms // 3)))
    closed = base.withColumn("ingested_at", iso(F.col("open_time") + F.lit(step_ms + 5_000)))
    fix = (base.filter((F.col("open_time") / F.lit(step_ms)).cast("long") % 7 == 0)
           .withColumn("volume", F.col("volume") + F.lit(1.0))
           .withColumn("ingested_at", iso(F.col("open_time") + F.lit(step_ms + 900_000))))
    same = (closed.filter((F.col("open_time") / F.lit(step_ms)).cast("long") % 11 == 0)
            .withColumn("volume", F.col("volume") - F.lit(1.0)))
    return (snap.unionByName(closed).unionByName(fix).unionByName(same)
            .withColumn("interval", F.lit(interval)))


def candle_records(candles: DataFrame, interval: str, delay_ms: int = 5_000) -> DataFrame:
    """Candles as flat bus records (13 fields), stamped ``delay_ms`` after close."""
    from barforge.schema import interval_ms
    ends = F.col("open_time") + F.lit(interval_ms(interval) + delay_ms)
    return candles.select(
        F.col("open_time").cast("long").alias("open_time"), "open", "high", "low", "close", "volume",
        F.col("volume").alias("quote_asset_volume"),
        F.col("number_of_trades").cast("int").alias("number_of_trades"),
        F.lit(0.0).alias("taker_buy_base_asset_volume"), "taker_buy_quote_asset_volume",
        "symbol", F.lit(interval).alias("interval"),
        millis_to_utc_text(ends, ISO_UTC).alias("ingested_at"))
