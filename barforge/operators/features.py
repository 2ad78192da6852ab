"""Batch candle features (WIN-1..5, FEA-1..14, FLT-1) and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.features import (column_formulas, complete_row, feature_names,
                                         lag_accessor, lags_used)
from barforge.functions.time import floor_to
from barforge.operators.halo import HALO, with_halo
from barforge.schema import CANDLE_COLUMNS, CANDLE_MINUTES, FEATURES, LOOKBACK

# Rows per (symbol, chunk) partition of the feature window, in candles.
CHUNK_CANDLES = 1 << 16

_INT_COLUMNS = {"symbol", "open_time", "label", "number_of_trades"}


def chunk_of(open_time: Column, chunk_ms: int) -> Column:
    return (floor_to(open_time, chunk_ms) / F.lit(chunk_ms)).cast("long")


def next_candle_label(close: Column, next_close: Column) -> Column:
    """1 if the next close is higher, else 0 (ties and a missing next -> 0)."""
    return F.when(next_close > close, F.lit(1)).otherwise(F.lit(0))


def add_features(candles: DataFrame, lookback: int = LOOKBACK, label: bool = True,
                 tail: str = "drop", candle_minutes: int = CANDLE_MINUTES,
                 chunk_ms: int | None = None, keep: str = "model",
                 complete: bool = True, require_contiguous: bool = False,
                 split: bool = True) -> DataFrame:
    """Features of every candle that has a full lookback, one row per candle.

    ``candles``: symbol, open_time (Long ms), open, high, low, close, volume,
    number_of_trades, taker_buy_quote_asset_volume.

    label    True: next-candle label; False: dummy 0 (live scoring).
    tail     "drop": the last candle of a symbol has no next close and is left
             out; "zero": it is kept with label 0.
    chunk_ms time span of one window partition (default 2^16 candles); see
             ``barforge.operators.halo``.
    split    False: one window partition a symbol, for callers whose symbols hold few
             candles each (the live tail); the plan is shorter.
    keep     "model": symbol, open_time, close, label and the 27 inputs;
             "all": every candle column, lag, derived and working column.
    complete True: apply the NULL/NaN row test below; False: keep every candle.
    require_contiguous
             lags count rows, so a missing candle stretches the lookback
             (kept by default, as in the original); True also requires the
             candle ``lookback`` rows back to be exactly ``lookback`` intervals
             earlier.

    A row is kept only when no candle column, lag or feature is NULL or NaN
    (the ``dropna()`` rule; the first ``lookback`` candles of each symbol drop
    out on their close lags).
    """
    if tail not in ("drop", "zero"):
        raise ValueError("tail must be 'drop' or 'zero'")
    chunk_ms = chunk_ms or CHUNK_CANDLES * candle_minutes * 60_000
    base = candles.select(
        *[F.col(c).cast("long").alias(c) if c == "number_of_trades" else F.col(c)
          for c in CANDLE_COLUMNS])
    if split:
        base = base.withColumn("_chunk", chunk_of(F.col("open_time"), chunk_ms))
        rows = with_halo(base, ["symbol"], "open_time", "_chunk",
                         back=lookback, forward=1 if label else 0)
        w = Window.partitionBy("symbol", "_chunk").orderBy("open_time")
    else:
        rows, w = base.withColumn(HALO, F.lit(False)), Window.partitionBy("symbol").orderBy("open_time")
    # one Window node computes every lag the formulas read (and the lead);
    # the formulas then run on plain columns, exactly as on streams
    lagged = lag_accessor(w)
    needed = [(n, k) for n, k in lags_used(lookback) if k > 0]
    rows = rows.select(*CANDLE_COLUMNS, HALO,
                       *[F.col(n).alias(f"_x_{n}_0") for n in CANDLE_COLUMNS[2:]],
                       *[lagged(n, k).alias(f"_x_{n}_{k}") for n, k in needed],
                       lagged("open_time", lookback).alias("_t_back"),
                       (F.lead("close", 1).over(w) if label else F.lit(0.0)).alias("_next_close"))
    feats = column_formulas("_x_", lookback)
    work = column_formulas("_x_", lookback, working=True) if keep == "all" else {}
    next_close = F.col("_next_close")
    label_col = next_candle_label(F.col("close"), next_close) if label else F.lit(0)
    # what needs no formula is filtered first, on the candle and lag columns
    rows = rows.filter(~F.col(HALO))
    if label and tail == "drop":
        rows = rows.filter(F.col("_next_close").isNotNull())
    if require_contiguous:
        span = lookback * candle_minutes * 60_000
        rows = rows.filter((F.col("open_time") - F.col("_t_back")) == F.lit(span))
    if complete:
        direct = [f"_x_{n}_0" for n in CANDLE_COLUMNS[2:]] + [f"_x_close_{k}" for k in range(1, lookback + 1)]
        rows = rows.filter(complete_row(direct, {c for c in direct if "number_of_trades" not in c}))
    # a generator of one row: the filter below is not pushed through it, so every
    # formula is evaluated once and the filter reads plain columns
    wide = rows.select(F.inline(F.array(F.struct(
        *CANDLE_COLUMNS, *[c.alias(n) for n, c in feats.items()], *[c.alias(n) for n, c in work.items()],
        label_col.alias("label")))))

    checked = list(CANDLE_COLUMNS) + list(feats) + ["label"]
    doubles = {c for c in checked
               if c not in _INT_COLUMNS and not c.startswith("number_of_trades")}
    out = wide.filter(complete_row(checked, doubles)) if complete else wide
    if keep == "all":
        return out.select(*CANDLE_COLUMNS, *feature_names(lookback), *work, "label")
    return out.select("symbol", "open_time", "close", "label", *FEATURES)


def add_labels(candles: DataFrame, tail: str = "drop",
               candle_minutes: int = CANDLE_MINUTES, chunk_ms: int | None = None) -> DataFrame:
    """Next close and the up/down label for every candle (WIN-2, WIN-3)."""
    chunk_ms = chunk_ms or CHUNK_CANDLES * candle_minutes * 60_000
    base = candles.select("symbol", "open_time", "close").withColumn(
        "_chunk", chunk_of(F.col("open_time"), chunk_ms))
    rows = with_halo(base, ["symbol"], "open_time", "_chunk", back=0, forward=1)
    w = Window.partitionBy("symbol", "_chunk").orderBy("open_time")
    nxt = F.lead("close", 1).over(w)
    out = rows.select("symbol", "open_time", "close", HALO, nxt.alias("next_close"),
                      next_candle_label(F.col("close"), nxt).alias("label"))
    out = out.filter(~F.col(HALO))
    if tail == "drop":
        out = out.filter(F.col("next_close").isNotNull())
    return out.drop(HALO)
