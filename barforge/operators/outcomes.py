"""Prediction log and outcomes (SNK-2, STR-5, JON-4, AGG-15).

Predictions and outcomes are separate append-only tables keyed by
(symbol, open_time); the log is their left join, so an outcome that arrives
later (or is corrected) never rewrites a prediction row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.functions.time import millis_to_utc_text
from barforge.operators.features import add_labels


def outcomes_from_candles(candles: DataFrame, **kw) -> DataFrame:
    """actual_label of each candle: 1 if the next close is higher, else 0;
    candles without a next one have no outcome yet."""
    return add_labels(candles, tail="drop", **kw).select(
        "symbol", "open_time", F.col("label").alias("actual_label"))


def prediction_log(predictions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The prediction log: timestamp, UTC datetime, symbol, close, final_prob,
    prediction, actual_label and is_correct (NULL until the outcome exists)."""
    p = predictions.select("symbol", "open_time", "close", "final_prob", "prediction")
    j = p.join(outcomes.select("symbol", "open_time", "actual_label"), ["symbol", "open_time"], "left")
    return j.select(
        F.col("open_time").alias("timestamp"),
        millis_to_utc_text(F.col("open_time")).alias("datetime"),
        "symbol", "close", "final_prob", "prediction", "actual_label",
        F.when(F.col("actual_label").isNotNull(),
               (F.col("prediction") == F.col("actual_label")).cast("int")).alias("is_correct"))


def hit_rate(log: DataFrame) -> DataFrame:
    """Share of correct calls per symbol and UTC day, over rows with an outcome."""
    day = F.substring(millis_to_utc_text(F.col("timestamp")), 1, 10)
    scored = log.filter(F.col("is_correct").isNotNull())
    return scored.groupBy("symbol", day.alias("day")).agg(
        F.count(F.lit(1)).alias("scored"), F.avg("is_correct").alias("hit_rate"))
