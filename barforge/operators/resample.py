"""Candle resampling (AGG-1), last N candles per symbol (WIN-8), latest
version per key (duplicate / re-sent candles)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.time import bucket_ms, epoch_micros
from barforge.schema import CANDLE_MINUTES


def aggregate_candles(bars: DataFrame, candle_minutes: int = CANDLE_MINUTES,
                      time_col: str = "open_time", order_col: str | None = None,
                      sort: bool = False, tiebreak_col: str | None = None) -> DataFrame:
    """Resample bars (or single-trade ticks) into ``candle_minutes`` candles.

    ``bars`` has symbol, a time column (Long ms, TIMESTAMP or TIMESTAMP_NTZ),
    open, high, low, close, volume, number_of_trades and
    taker_buy_quote_asset_volume. Open and close are taken at the earliest and
    latest event time (``min_by`` / ``max_by`` on a Long, so the plan stays a
    HashAggregate with a map-side partial aggregate; a hot symbol is split by
    its buckets). ``order_col`` overrides the ordering key (Long). The result is
    unsorted unless ``sort``. ``tiebreak_col`` orders trades that share a time
    (open = lowest, close = highest tiebreak); it makes the key a struct, so
    Spark plans a sort-based aggregate: use it only where times can repeat.
    """
    t_us = epoch_micros(bars, time_col)
    step_ms = candle_minutes * 60_000
    prepared = bars.select(
        "symbol",
        bucket_ms(t_us, step_ms).alias("open_time"),
        (F.col(order_col).cast("long") if order_col else t_us).alias("_t"),
        "open", "high", "low", "close", "volume", "number_of_trades",
        "taker_buy_quote_asset_volume",
        *([F.col(tiebreak_col).alias("_tb")] if tiebreak_col else []),
    )
    if tiebreak_col is not None:
        prepared = prepared.withColumn("_t", F.struct("_t", "_tb")).drop("_tb")
    out = prepared.groupBy("symbol", "open_time").agg(
        F.min_by("open", "_t").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "_t").alias("close"),
        F.sum("volume").alias("volume"),
        F.sum(F.col("number_of_trades").cast("long")).alias("number_of_trades"),
        F.sum("taker_buy_quote_asset_volume").alias("taker_buy_quote_asset_volume"),
    )
    return out.orderBy("symbol", "open_time") if sort else out


def last_n_candles(candles: DataFrame, n: int, key: str = "symbol",
                   order: str = "open_time") -> DataFrame:
    """The newest ``n`` candles of each symbol, with ``recency`` 1 = newest.

    ``row_number() <= n`` is planned with a group limit on the map side, so a
    hot symbol ships at most n rows per task through the shuffle.
    """
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return (candles.withColumn("recency", F.row_number().over(w))
            .filter(F.col("recency") <= n))


def latest_per_key(records: DataFrame, keys: list[str], version_col: str,
                   value_cols: list[str]) -> DataFrame:
    """Keep the newest version (largest ``version_col``, a Long) per key; of equal
    versions the one with the larger values. One maximum over (version, values),
    so a row is never put together from two versions."""
    best = records.groupBy(*keys).agg(F.max(F.struct(version_col, *value_cols)).alias("_b"))
    return best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in (*value_cols, version_col)])
