"""Scores to decisions: probability extraction and the trading signal (SGN-1)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: signal thresholds and texts --------------------------------
VERY_HIGH_BAND = (0.7, 0.3)     # p >= .7 or p <= .3
HIGH_BAND = (0.6, 0.4)          # p >= .6 or p <= .4
BUY, SELL, WAIT = "BUY (Long)", "SELL (Short)", "WAIT"
VERY_HIGH, HIGH, LOW = "VERY HIGH", "HIGH", "Low"
# ------------------------------------------------------------------------------


def prob_up(probability: Column) -> Column:
    """P(up) from an MLlib probability vector; 0.5 when the vector is NULL.

    ``vector_to_array`` runs in the JVM, so no Python worker is involved.
    """
    return F.coalesce(F.try_element_at(vector_to_array(probability), F.lit(2)), F.lit(0.5))


def predicted_class(p: Column, threshold: float = 0.5) -> Column:
    """1 when p > threshold (MLlib's binary rule), else 0."""
    return F.when(p > F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def _in_band(p: Column, band: tuple[float, float]) -> Column:
    hi, lo = band
    return (p >= F.lit(hi)) | (p <= F.lit(lo))


def confidence(p: Column) -> Column:
    return (F.when(_in_band(p, VERY_HIGH_BAND), F.lit(VERY_HIGH))
            .when(_in_band(p, HIGH_BAND), F.lit(HIGH)).otherwise(F.lit(LOW)))


def signal(p: Column, prediction: Column) -> Column:
    """BUY / SELL when p is in a high band (side from the prediction), else WAIT."""
    side = F.when(prediction == 1, F.lit(BUY)).otherwise(F.lit(SELL))
    return F.when(_in_band(p, HIGH_BAND) | _in_band(p, VERY_HIGH_BAND), side).otherwise(F.lit(WAIT))
