"""Message bus and file edges: read, publish, bootstrap (SRC-6, SRC-10, SRC-11, STR-7).

The bus format is a parameter: ``kafka`` on a cluster (the connector jar must
be on the classpath), or any file source exposing a ``value`` column (``text``
over JSON lines) offline. Parsing happens downstream in ``sources.raw``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.operators.resample import last_n_candles
from barforge.schema import CANDLE_COLUMNS, STREAM_RECORD_SCHEMA, WINDOW_SIZE
from barforge.sources.raw import latest_closed


def read_bus(spark: SparkSession, fmt: str = "kafka", options: dict | None = None,
             path: str | None = None, stream: bool = True) -> DataFrame:
    """Messages as a DataFrame with a ``value`` column (SRC-6).

    Kafka example: options={"kafka.bootstrap.servers": ..., "subscribe": topic,
    "startingOffsets": "earliest", "maxOffsetsPerTrigger": ...}; the rate limit
    bounds each micro-batch.
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.format(fmt).options(**(options or {}))
    df = reader.load(path) if path else reader.load()
    return df.select(F.col("value").cast("string").alias("value"))


def to_messages(records: DataFrame) -> DataFrame:
    """Rows -> JSON text in ``value`` (one message per row)."""
    return records.select(F.to_json(F.struct(*records.columns)).alias("value"))


def publish(records: DataFrame, fmt: str = "kafka", options: dict | None = None,
            path: str | None = None, checkpoint: str | None = None, trigger: dict | None = None):
    """Publish rows as JSON messages (SRC-11). Streams need ``checkpoint``;
    batches are written once. Returns the streaming query, or None."""
    msgs = to_messages(records)
    if records.isStreaming:
        w = msgs.writeStream.format(fmt).options(**(options or {}))
        w = w.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"}))
        return w.start(path) if path else w.start()
    w = msgs.write.format(fmt).options(**(options or {})).mode("append")
    w.save(path) if path else w.save()
    return None


def save_bootstrap_json(records: DataFrame, path: str) -> None:
    """Backup of bootstrap candles as JSON lines (SRC-10)."""
    records.write.mode("overwrite").json(path)


def read_bootstrap_json(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    """Read a bootstrap backup: JSON lines, or one JSON array per file."""
    reader = spark.read.schema(STREAM_RECORD_SCHEMA)
    if array_file:
        reader = reader.option("multiLine", True)
    return reader.json(path)


def seed_feed(history: DataFrame, feed_path: str, n: int = WINDOW_SIZE, interval: str = "30m") -> None:
    """Warm-up (STR-7): write the newest ``n`` closed candles of each symbol as
    the first part of the candle feed the live job reads, so the first live
    candle is scored at once (the group limit ships at most n rows per symbol
    per task). History with arrival stamps is filtered and merged first
    (``latest_closed``): an unclosed last candle is never seeded."""
    if "ingested_at" in history.columns:
        records = history if "interval" in history.columns else history.withColumn("interval", F.lit(interval))
        history = latest_closed(records).filter(F.col("interval") == interval)
    seed = last_n_candles(history.select(*CANDLE_COLUMNS), n).drop("recency")
    seed.write.mode("append").parquet(feed_path)
