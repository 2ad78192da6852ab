"""barforge: candle analytics, walk-forward stacking and live scoring on Spark.

Subpackages
-----------
sources    table loaders, raw message parsing (JSON, kline arrays), sinks
functions  Column-level formulas shared by batch and streaming
operators  DataFrame operators: resampling, features, folds, evaluation
plans      MLlib stacking, training flow, the registered query catalog
streaming  Structured Streaming jobs: watermark resample, window state
"""

from barforge.schema import FEATURES  # noqa: F401

__version__ = "0.1.0"
