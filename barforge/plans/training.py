"""Walk-forward out-of-fold stacking (ML-4..8) over a feature table.

features -> class weights -> exact folds -> base models fitted side by side, on
folds < k for k = 1..K-1 and on everything -> score fold k by the models of folds
< k (chained transforms, no join) -> OOF union -> meta fit -> one PipelineModel
with the bases of everything. The feature table is persisted once
and every fold's predictions are cut from the lineage with a reliable
checkpoint in the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.operators.folds import add_class_weights, class_weights, walk_forward_folds
from barforge.plans import stack as st
from barforge.schema import FEATURES
from barforge.session import cut_lineage


def laid_out(features: DataFrame, partitions: int) -> DataFrame:
    """The rows in an order that depends on their keys only: MLlib seeds its
    bagging by partition and position, so the layout of the input must not
    reach it. The number of partitions is a parameter, never taken from the data."""
    return features.repartition(partitions, "symbol", "open_time").sortWithinPartitions("symbol", "open_time")


@dataclass
class StackResult:
    model: PipelineModel
    oof: DataFrame
    base: dict
    use_weights: bool


def train_stack(features: DataFrame, k: int = 3, downscale: float = 1.0,
                params: st.StackParams | None = None, fold_weights: str = "global",
                snap_folds: bool = False) -> StackResult:
    """Train the stacked model on ``features`` (symbol, open_time, label, FEATURES).

    fold_weights  "global": class weights from all training rows (as the
                  original); "per_fold": each fold's base models use weights
                  from their own training rows only (no look-ahead).
    snap_folds    fold edges on whole timestamps (see ``walk_forward_folds``).
    """
    if fold_weights not in ("global", "per_fold"):
        raise ValueError("fold_weights must be 'global' or 'per_fold'")
    params = params or st.StackParams()
    if k < 2:
        raise ValueError("k must be at least 2: the first fold is never scored")
    base = laid_out(features.select("symbol", "open_time", "label", *FEATURES), params.partitions).persist()
    weights = class_weights(base, downscale).collect()         # at most two rows
    use_weights = len(weights) == 2
    # weights and folds are literals over the one cached table
    table = add_class_weights(base, downscale) if use_weights else base.withColumn("weight", F.lit(1.0))
    table = walk_forward_folds(table, k, snap_to_time=snap_folds)
    try:
        sets = []
        for f in range(1, k):
            train = table.filter(F.col("fold") < f)
            if fold_weights == "per_fold" and use_weights:
                train = add_class_weights(train.drop("weight"), downscale)
            sets.append(train)
        *earlier, final = st.fit_base_models([*sets, table], params, use_weights)
        parts = []
        for f, models in enumerate(earlier, 1):
            valid = table.filter(F.col("fold") == f)
            scored = st.base_probabilities(st.base_pipeline(models).transform(valid))
            keep = scored.select("symbol", "open_time", "label", "weight", "fold",
                                 *[f"{n}_p" for n in st.BASE], *[f"{n}_prob" for n in st.BASE])
            parts.append(cut_lineage(keep))
        oof = parts[0]
        for p in parts[1:]:
            oof = oof.unionByName(p)
        meta = st.fit_meta(oof, params, use_weights)
        return StackResult(st.stacked_pipeline(final, meta), oof, final, use_weights)
    finally:
        base.unpersist()


def feature_importance(base: dict, spark, low: float = 0.01) -> DataFrame:
    """Per feature: RF and GBT importances, their mean, ranks, cumulative share
    of the top features per model, and a low-importance flag (ML-8, TOP-1).

    Importances are model metadata (27 numbers), turned into a small table.
    """
    from pyspark.sql import Window
    rf = base["rf"].featureImportances.toArray().tolist()
    gbt = base["gbt"].featureImportances.toArray().tolist()
    rows = [(f, float(a), float(b)) for f, a, b in zip(FEATURES, rf, gbt)]
    df = spark.createDataFrame(rows, "feature string, rf_importance double, gbt_importance double")
    df = df.withColumn("avg_importance", (F.col("rf_importance") + F.col("gbt_importance")) / 2)
    out = df
    for m in ("rf", "gbt", "avg"):
        w = Window.orderBy(F.col(f"{m}_importance").desc(), F.col("feature"))
        out = out.withColumn(f"{m}_rank", F.row_number().over(w)).withColumn(
            f"{m}_cumulative", F.sum(f"{m}_importance").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return out.withColumn("low_importance", F.col("avg_importance") < F.lit(low))
