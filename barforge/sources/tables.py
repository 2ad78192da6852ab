"""Batch sources: parquet scans and the mapping of the test tables to bars.

Mapping of the given tables onto price bars:

* ``events``: one trade per row. symbol = event_type, time = ts,
  price = value, volume = value, one trade, taker-buy quote volume = value
  when user_id is even (else 0).
* ``lineitem``: symbol = l_partkey, time = l_shipdate (day precision),
  price = l_extendedprice / l_quantity; a wide symbol set for scale runs.
* ``orders``: symbol = o_orderpriority, time = o_orderdate,
  price = o_totalprice; daily bars.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barforge.functions.time import epoch_micros

# The symbol is the base name of SYMBOL.parquet, a file or a folder of parts.
SYMBOL_FROM_FILE = r"([^/\\]+?)\.parquet(?:[/\\]part-[^/\\]+)?$"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_symbol_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Scan one-parquet-per-symbol history; the symbol is the file's base name.

    Uses the ``_metadata.file_path`` column: no Python, and a filter that compares the
    symbol with literals is applied to the file list when the scan is planned.
    """
    paths = [paths] if isinstance(paths, str) else paths
    df = spark.read.parquet(*paths)
    return df.withColumn(
        "symbol", F.regexp_extract(F.col("_metadata.file_path"), SYMBOL_FROM_FILE, 1))


def write_symbol_files(candles: DataFrame, path: str) -> None:
    """History laid out by symbol: ``symbol=X`` folders. The rows are rebalanced by
    symbol: small symbols share a task, a symbol with very many rows is split over several
    tasks and files."""
    candles.hint("rebalance", "symbol").write.partitionBy("symbol").parquet(path)


def read_symbol_folders(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scan ``symbol=X`` folders; with the schema given, a symbol of digits stays text."""
    return spark.read.schema(schema).parquet(path)


def _trade_bars(symbol, time_col, price, taker, order) -> list:
    return [
        symbol.alias("symbol"), time_col.alias("open_time"), order.alias("trade_order"),
        price.alias("open"), price.alias("high"), price.alias("low"), price.alias("close"),
        price.alias("volume"), F.lit(1).cast("long").alias("number_of_trades"),
        taker.alias("taker_buy_quote_asset_volume"),
    ]


def event_trades(events: DataFrame) -> DataFrame:
    """Each event is one trade, as a one-trade bar (open = high = low = close)."""
    price = F.col("value")
    taker = F.when(F.col("user_id") % 2 == 0, price).otherwise(F.lit(0.0))
    return events.select(*_trade_bars(F.col("event_type"), F.col("ts"), price, taker,
                                      epoch_micros(events, "ts")))


def lineitem_trades(lineitem: DataFrame) -> DataFrame:
    """Line items as trades of part ``l_partkey`` at unit price.

    Ship dates have day precision, so trades of one day tie on time. The
    ordering key packs (ship day, order key, line number) into one Long so open
    and close are deterministic and the aggregate keeps primitive buffers.
    """
    price = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    taker = F.when(F.col("l_orderkey") % 2 == 0, price).otherwise(F.lit(0.0))
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    order = day * F.lit(1 << 43) + F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber") % 8
    return lineitem.select(*_trade_bars(F.col("l_partkey").cast("string"), F.col("l_shipdate"),
                                        price, taker, order))
