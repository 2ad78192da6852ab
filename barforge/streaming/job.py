"""The whole live path as three checkpointed queries (STR-2..6, RTE-1, FLT-6).

    messages ──parse, tag──► table "parsed" (status=closed / status=rejected)
    status=closed ──30m pass, 1m resampled──► candle table
    candle table ──► live job (tail and batch) ──► predictions, outcomes, late

The source is read and parsed once: every message goes to one table, closed candles
as records and all others, whatever the reason, as text with the reason; closed and
rejected together are the messages. The source's rate limit (``maxFilesPerTrigger`` /
``maxOffsetsPerTrigger``) bounds the first query's batches, ``files_per_batch`` the
others'.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barforge.schema import CANDLE_COLUMNS, CANDLE_SCHEMA
from barforge.sources.raw import MESSAGE_SCHEMA, tag_candle_records, tag_closed
from barforge.streaming import live as lv
from barforge.streaming.resample import stream_candles

FEED_SCHEMA = T.StructType([*CANDLE_SCHEMA.fields, T.StructField("ingested_at", T.StringType())])


def route_stream(closed: DataFrame, candle_minutes: int = 30, watermark: str = "10 minutes") -> DataFrame:
    """Streaming form of ``route_intervals`` over closed records: native candles pass
    with their stamp, one-minute records become candles under the watermark, each
    minute counted once."""
    step = f"{candle_minutes}m"
    native = closed.filter(F.col("interval") == step).select(
        *[F.col(c).cast("long").alias(c) if c == "number_of_trades" else F.col(c) for c in CANDLE_COLUMNS], "ingested_at")
    built = stream_candles(closed.filter(F.col("interval") != step), candle_minutes, watermark, once=True)
    return native.unionByName(built.select(*CANDLE_COLUMNS, F.lit(None).cast("string").alias("ingested_at")))


def start_messages(messages: DataFrame, root: str, tag: Callable = tag_candle_records, trigger: dict | None = None):
    """Parse ``messages`` (a stream with a ``value`` column) once and append them, tagged,
    to ``{root}/parsed`` by status."""
    w = (tag_closed(tag(messages)).writeStream.format("parquet").partitionBy("status").option("path", f"{root}/parsed")
         .option("checkpointLocation", f"{root}/checkpoints/messages").outputMode("append")
         .trigger(**(trigger or {"processingTime": "10 seconds"})))
    return w.start()


def rejects(spark: SparkSession, root: str) -> DataFrame:
    """The rejected messages so far: ``raw`` and ``reason``."""
    return spark.read.schema(MESSAGE_SCHEMA).parquet(f"{root}/parsed").filter(F.col("status") == "rejected").select("raw", "reason")


def closed_records(spark: SparkSession, root: str) -> DataFrame:
    """The accepted messages so far, as records."""
    return spark.read.schema(MESSAGE_SCHEMA).parquet(f"{root}/parsed").filter(F.col("status") == "closed").drop(
        "raw", "reason", "status")


def start_job(messages: DataFrame, root: str, model: PipelineModel | None = None, tag: Callable = tag_candle_records,
              trigger: dict | None = None, watermark: str = "10 minutes", state_partitions: int | None = None,
              files_per_batch: int = 64, wait: bool = False) -> list:
    """Start the queries: messages, candles, live. ``messages`` is a stream with a
    ``value`` column; ``wait`` lets each query come to its end before the next
    starts (with ``availableNow``, for backfills)."""
    spark = messages.sparkSession
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    first = start_messages(messages, root, tag, trigger)
    if wait:
        first.awaitTermination()
    closed = reader.schema(MESSAGE_SCHEMA).parquet(f"{root}/parsed").filter(F.col("status") == "closed").drop(
        "raw", "reason", "status")
    second = lv.start(route_stream(closed, watermark=watermark), f"{root}/candles", f"{root}/checkpoints/candles", trigger,
                      state_partitions=state_partitions)
    if wait:
        second.awaitTermination()
    feed = spark.readStream.schema(FEED_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
    last = lv.start_live(feed.parquet(f"{root}/candles"), f"{root}/tables", f"{root}/checkpoints/live", model, trigger,
                         state_partitions=state_partitions)
    return [first, second, last]
