"""Raw message parsing as Spark jobs (SRC-7..13, FLT-6, RTE-1).

Every parser takes a DataFrame of text (batch or streaming) and returns
``(records, rejects)``: records in the 13-field candle record layout and
rejects with the original text and a reason. Nothing is parsed in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barforge.functions.time import ISO_UTC, epoch_micros
from barforge.operators.resample import aggregate_candles, latest_per_key
from barforge.schema import (EXCHANGE_EVENT_SCHEMA, KLINE_ARRAY_SCHEMA, KLINE_NAMED,
                             STREAM_RECORD_SCHEMA, VALID_INTERVALS, interval_ms)

CORRUPT = "_corrupt"
_JSON_OPTS = {"columnNameOfCorruptRecord": CORRUPT}


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])


def iso_now() -> Column:
    """ISO-8601 UTC arrival stamp, e.g. 2027-01-15T18:25:00.000000+00:00."""
    return F.date_format(F.convert_timezone(None, F.lit("UTC"), F.current_timestamp()), ISO_UTC)


def _once(df: DataFrame, keep: list[str], parsed: Column) -> DataFrame:
    """``keep`` and the parsed value ``_j``, through a generator of one row: filters
    are not pushed through it, so the text is parsed once."""
    return df.select(*keep, F.explode(F.array(parsed)).alias("_j"))


def _tagged(df: DataFrame, reason: Column, record_cols: list[Column], text: str) -> DataFrame:
    """Every message once: ``raw``, ``reason`` (NULL for a good one) and ``record``."""
    return df.select(F.col(text).alias("raw"), F.inline(F.array(F.struct(
        reason.alias("reason"), F.struct(*record_cols).alias("record")))))


def split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(records, rejects)`` of a tagged table. To keep both at the cost of one
    parse, store the tagged table first and split what was stored."""
    return (tagged.filter(F.col("reason").isNull()).select("record.*"),
            tagged.filter(F.col("reason").isNotNull()).select("raw", "reason"))


def parse_candle_records(df: DataFrame, text: str = "value"):
    """Bus value (bytes or text) -> the flat 13-field candle record (SRC-7)."""
    return split_tagged(tag_candle_records(df, text))


def tag_candle_records(df: DataFrame, text: str = "value") -> DataFrame:
    """Rejected: text that is not JSON, a record without symbol or open_time."""
    parsed = _once(df.select(F.col(text).cast("string").alias(text)), [text],
                   F.from_json(F.col(text), _with_corrupt(STREAM_RECORD_SCHEMA), _JSON_OPTS))
    reason = (F.when(F.col("_j").isNull() | F.col(f"_j.{CORRUPT}").isNotNull(), F.lit("malformed"))
              .when(F.col("_j.symbol").isNull() | F.col("_j.open_time").isNull(), F.lit("no_key")))
    cols = [F.col(f"_j.{f.name}").alias(f.name) for f in STREAM_RECORD_SCHEMA.fields]
    return _tagged(parsed, reason, cols, text)


def parse_exchange_events(df: DataFrame, text: str = "value", symbols: list[str] | None = None,
                          ingested_at: Column | None = None):
    """Exchange kline events -> closed candle records (SRC-8, FLT-6, SRC-12/13).

    The payload may sit in a ``data`` envelope or be bare. Rejected: text that
    is not JSON, no kline ``k``, a candle not marked closed (``x``), a missing
    or non-numeric field, an interval other than 1m / 30m, and (when
    ``symbols`` is given) other symbols. Symbols are upper-cased.
    """
    return split_tagged(tag_exchange_events(df, text, symbols, ingested_at))


def tag_exchange_events(df: DataFrame, text: str = "value", symbols: list[str] | None = None,
                        ingested_at: Column | None = None) -> DataFrame:
    """The events once each, with their reject reason (see ``parse_exchange_events``)."""
    parsed = _once(df.select(F.col(text).cast("string").alias(text)), [text],
                   F.from_json(F.col(text), _with_corrupt(EXCHANGE_EVENT_SCHEMA), _JSON_OPTS))
    body = F.when(F.col("_j.data").isNotNull(), F.struct(
        F.col("_j.data.s").alias("s"), F.col("_j.data.k").cast(KLINE_NAMED).alias("k"))).otherwise(
        F.struct(F.col("_j.s").alias("s"), F.col("_j.k").cast(KLINE_NAMED).alias("k")))
    p = parsed.withColumn("_b", body)
    k = "_b.k"

    def num(field: str) -> Column:
        return F.col(f"{k}.{field}").try_cast("double")

    nums = {"open": num("o"), "high": num("h"), "low": num("l"), "close": num("c"),
            "volume": num("vol"), "quote_asset_volume": num("quote"),
            "taker_buy_base_asset_volume": num("taker_base"),
            "taker_buy_quote_asset_volume": num("taker_quote")}
    trades = F.col(f"{k}.n").try_cast("long")
    required = [F.col(f"{k}.t"), trades, F.col(f"{k}.i"), *nums.values()]
    any_null = F.lit(False)
    for c in required:
        any_null = any_null | c.isNull()
    symbol = F.upper(F.coalesce(F.col("_b.s"), F.lit("")))
    reason = (F.when(F.col(f"_j.{CORRUPT}").isNotNull(), F.lit("malformed"))
              .when(F.col(k).isNull(), F.lit("no_kline"))
              .when(~F.coalesce(F.col(f"{k}.x"), F.lit(False)), F.lit("not_closed"))
              .when(any_null, F.lit("bad_field"))
              .when(~F.col(f"{k}.i").isin(*VALID_INTERVALS), F.lit("bad_interval")))
    if symbols is not None:
        reason = reason.when(~symbol.isin(*[s.upper() for s in symbols]), F.lit("other_symbol"))
    cols = [F.col(f"{k}.t").alias("open_time"),
            *[nums[c].alias(c) for c in ("open", "high", "low", "close", "volume", "quote_asset_volume")],
            trades.cast("int").alias("number_of_trades"),
            nums["taker_buy_base_asset_volume"].alias("taker_buy_base_asset_volume"),
            nums["taker_buy_quote_asset_volume"].alias("taker_buy_quote_asset_volume"),
            symbol.alias("symbol"), F.col(f"{k}.i").alias("interval"),
            (ingested_at if ingested_at is not None else iso_now()).alias("ingested_at")]
    return _tagged(p, reason, cols, text)


# Positions in a REST kline array (0-based): fixed by the exchange format.
KLINE_POSITIONS = {"open_time": 0, "open": 1, "high": 2, "low": 3, "close": 4, "volume": 5,
                   "quote_asset_volume": 7, "number_of_trades": 8,
                   "taker_buy_base_asset_volume": 9, "taker_buy_quote_asset_volume": 10}


def parse_kline_arrays(df: DataFrame, text: str = "response", symbol: str = "symbol",
                       interval: str = "interval", ingested_at: Column | None = None):
    """REST responses (JSON array of positional arrays) -> candle records (SRC-9).

    One output row per inner array; a short array or a non-numeric value
    rejects that row only.
    """
    rows = _once(df.select(F.col(text).alias("_text"), F.col(symbol).alias("_sym"), F.col(interval).alias("_int")),
                 ["_text", "_sym", "_int"], F.from_json(F.col("_text"), KLINE_ARRAY_SCHEMA))
    rows = rows.withColumn("_bad_json", F.col("_j").isNull()).withColumn("_k", F.explode_outer("_j"))

    def at(name: str, to: str) -> Column:
        return F.try_element_at(F.col("_k"), F.lit(KLINE_POSITIONS[name] + 1)).try_cast(to)

    vals = {n: at(n, "long" if n in ("open_time", "number_of_trades") else "double")
            for n in KLINE_POSITIONS}
    any_null = F.lit(False)
    for c in vals.values():
        any_null = any_null | c.isNull()
    reason = (F.when(F.col("_bad_json"), F.lit("malformed"))
              .when(F.col("_k").isNull(), F.lit("empty"))
              .when(any_null, F.lit("bad_field")))
    cols = [vals["open_time"].alias("open_time"),
            *[vals[c].alias(c) for c in ("open", "high", "low", "close", "volume", "quote_asset_volume")],
            vals["number_of_trades"].cast("int").alias("number_of_trades"),
            vals["taker_buy_base_asset_volume"].alias("taker_buy_base_asset_volume"),
            vals["taker_buy_quote_asset_volume"].alias("taker_buy_quote_asset_volume"),
            F.col("_sym").alias("symbol"), F.col("_int").alias("interval"),
            (ingested_at if ingested_at is not None else iso_now()).alias("ingested_at")]
    rows = rows.withColumn("_raw", F.coalesce(F.to_json("_k"), F.col("_text")))
    return split_tagged(_tagged(rows, reason, cols, "_raw"))


def route_intervals(records: DataFrame, candle_minutes: int = 30) -> DataFrame:
    """30-minute records pass through; anything else (default 1m) is resampled
    to 30 minutes (RTE-1). Output: candle columns plus ``source_interval``."""
    step = f"{candle_minutes}m"
    interval = F.coalesce(F.col("interval"), F.lit("1m"))
    native = records.filter(interval == step).select(
        "symbol", F.col("open_time").cast("long").alias("open_time"), "open", "high", "low", "close",
        "volume", F.col("number_of_trades").cast("long").alias("number_of_trades"),
        "taker_buy_quote_asset_volume", F.lit(step).alias("source_interval"))
    small = records.filter(interval != step)
    built = aggregate_candles(small, candle_minutes).withColumn("source_interval", F.lit("1m"))
    return native.unionByName(built)


def closed_reason(record: str = "") -> Column:
    """Why a record is no closed candle, NULL if it is one: its bar must have ended when
    it was stamped (open_time + interval <= ingested_at; records carry no closed flag).
    A NULL interval is 1m, as in ``route_intervals``."""
    at = f"{record}." if record else ""
    interval = F.coalesce(F.col(f"{at}interval"), F.lit("1m"))
    step = F.coalesce(*[F.when(interval == i, F.lit(interval_ms(i))) for i in VALID_INTERVALS])
    stamp = F.unix_micros(F.to_timestamp(F.col(f"{at}ingested_at"))) / F.lit(1000)
    return (F.when(F.col(f"{at}symbol").isNull() | F.col(f"{at}open_time").isNull(), "no_key")
            .when(step.isNull(), "bad_interval").when(stamp.isNull(), "no_stamp")
            .when(F.col(f"{at}open_time") + step > stamp, "not_closed"))


def split_closed(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(closed, rejects)``: the closed records, and the others with a reason (see
    ``closed_reason``)."""
    tagged = records.withColumn("reason", closed_reason()).withColumn("interval", F.coalesce("interval", F.lit("1m")))
    return (tagged.filter(F.col("reason").isNull()).drop("reason"), tagged.filter(F.col("reason").isNotNull()))


def tag_closed(tagged: DataFrame) -> DataFrame:
    """A tagged table (``raw``, ``reason``, ``record``) with the records that are no closed
    candles tagged too: every message once, in one table, by ``status`` ('closed' with
    the record's columns, or 'rejected' with the text and the reason)."""
    once = tagged.select("raw", "record", F.explode(F.array(F.coalesce("reason", closed_reason("record")))).alias("reason"))
    good = F.col("reason").isNull()
    cols = [F.when(good, F.coalesce(F.col("record.interval"), F.lit("1m")) if f.name == "interval" else F.col(f"record.{f.name}"))
            .alias(f.name) for f in STREAM_RECORD_SCHEMA.fields]
    return once.select(*cols, F.when(~good, F.col("raw")).alias("raw"), "reason",
                       F.when(good, F.lit("closed")).otherwise(F.lit("rejected")).alias("status"))


#: the layout of ``tag_closed``
MESSAGE_SCHEMA = T.StructType([*STREAM_RECORD_SCHEMA.fields, *(T.StructField(n, T.StringType()) for n in ("raw", "reason", "status"))])


def closed_only(records: DataFrame) -> DataFrame:
    """The closed records alone (see ``split_closed``)."""
    return split_closed(records)[0]


def latest_closed(records: DataFrame) -> DataFrame:
    """Closed records, newest version per (symbol, interval, open_time) by arrival (D3)."""
    closed = closed_only(records).withColumn(
        "_v", F.unix_micros(F.to_timestamp("ingested_at")))
    values = ["open", "high", "low", "close", "volume", "number_of_trades",
              "taker_buy_quote_asset_volume"]
    out = latest_per_key(closed, ["symbol", "interval", "open_time"], "_v", values)
    return out.select("symbol", "interval", "open_time", *values).withColumn(
        "number_of_trades", F.col("number_of_trades").cast("long"))


__all__ = ["parse_candle_records", "parse_exchange_events", "parse_kline_arrays", "tag_candle_records",
           "tag_exchange_events", "tag_closed", "split_tagged", "route_intervals", "split_closed", "closed_only",
           "latest_closed", "epoch_micros"]
