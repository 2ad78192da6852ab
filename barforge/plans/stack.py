"""Stacked ensemble: RF + GBT + LR under a logistic meta-learner (ML-1..9).

Every base model writes its own probability / raw / prediction columns, a
``VectorSlicer`` keeps P(up), and the meta-learner reads the three slices.
Base models and meta-learner live in one ``PipelineModel`` together with the
feature assembler, so training and serving use the same feature order (D1)
and scoring is one chain of transforms: no join, no exchange, no Python
function in the plan.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.functions.signals import predicted_class, prob_up
from barforge.operators.folds import undersample_majority
from barforge.schema import FEATURES

BASE = ("rf", "gbt", "lr")


@dataclass
class StackParams:
    """Hyper-parameters; defaults are the original training values (fixed values)."""
    rf: dict = field(default_factory=lambda: dict(numTrees=50, maxDepth=6, maxBins=24,
                                                  subsamplingRate=0.7, seed=42))
    gbt: dict = field(default_factory=lambda: dict(maxIter=50, maxDepth=5, stepSize=0.1,
                                                   subsamplingRate=0.8, seed=42))
    lr: dict = field(default_factory=lambda: dict(maxIter=100, regParam=0.01, elasticNetParam=0.0))
    meta: dict = field(default_factory=lambda: dict(maxIter=100, regParam=0.001))
    gbt_undersample: bool = True     # GBT on class-balanced rows instead of weights
    sample_seed: int = 42
    partitions: int = 8              # of the training table; set it to the cluster's cores
    parallelism: int = 6             # base models fitted at the same time


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="skip")


def _named(est, name: str):
    """Give a classifier its own output columns (set after construction:
    not every constructor takes them)."""
    return (est.setFeaturesCol("features").setLabelCol("label")
            .setPredictionCol(f"{name}_prediction").setProbabilityCol(f"{name}_probability")
            .setRawPredictionCol(f"{name}_raw"))


def _slicer(name: str) -> VectorSlicer:
    return VectorSlicer(inputCol=f"{name}_probability", outputCol=f"{name}_p", indices=[1])


def fit_base_model(name: str, train: DataFrame, params: StackParams, use_weights: bool):
    """Fit one of ``BASE`` on ``train`` (feature columns, label, weight)."""
    data = assembler().transform(train)
    wcol = {"weightCol": "weight"} if use_weights else {}
    if name == "rf":
        return _named(RandomForestClassifier(**wcol, **params.rf), "rf").fit(data)
    if name == "gbt":
        gbt_rows = undersample_majority(data, params.sample_seed) if params.gbt_undersample else data
        gbt_w = {} if params.gbt_undersample else wcol
        return _named(GBTClassifier(**gbt_w, **params.gbt), "gbt").fit(gbt_rows)
    return _named(LogisticRegression(**wcol, **params.lr), "lr").fit(data)


def fit_base_models(sets: list[DataFrame], params: StackParams, use_weights: bool) -> list[dict]:
    """RF, GBT and LR of each of the training ``sets`` (the largest last).

    No fit needs another's result, and most of a fit is a chain of short jobs of
    ``params.partitions`` tasks, so ``params.parallelism`` fits run side by side, the
    longest first. A fit's models depend on its rows and seeds only."""
    todo = [(i, name) for name in ("gbt", "rf", "lr") for i in reversed(range(len(sets)))]
    tasks = [inheritable_thread_target(sets[i].sparkSession)(
        lambda i=i, name=name: fit_base_model(name, sets[i], params, use_weights)) for i, name in todo]
    with ThreadPool(min(params.parallelism, len(tasks))) as pool:
        fitted = dict(zip(todo, pool.map(lambda task: task(), tasks, chunksize=1)))
    return [{name: fitted[i, name] for name in BASE} for i in range(len(sets))]


def base_pipeline(models: dict) -> PipelineModel:
    """assembler -> each base model -> its P(up) slice."""
    stages = [assembler()]
    for name in BASE:
        stages += [models[name], _slicer(name)]
    return PipelineModel(stages=stages)


def base_probabilities(scored: DataFrame) -> DataFrame:
    """rf_prob, gbt_prob, lr_prob as doubles from the slices (JVM-side)."""
    return scored.select("*", *[vector_to_array(F.col(f"{n}_p"))[0].alias(f"{n}_prob") for n in BASE])


def meta_assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=[f"{n}_p" for n in BASE], outputCol="meta_features",
                           handleInvalid="skip")


def fit_meta(oof: DataFrame, params: StackParams, use_weights: bool):
    """Meta LR on the out-of-fold slices (rf_p, gbt_p, lr_p)."""
    data = meta_assembler().transform(oof)
    wcol = {"weightCol": "weight"} if use_weights else {}
    return LogisticRegression(featuresCol="meta_features", labelCol="label", **wcol,
                              **params.meta).fit(data)


def stacked_pipeline(models: dict, meta) -> PipelineModel:
    """The single serving model: base pipeline + meta assembler + meta LR."""
    return PipelineModel(stages=base_pipeline(models).stages + [meta_assembler(), meta])


def score(model: PipelineModel, features: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Stacked P(up) and 0/1 prediction for every feature row."""
    out = model.transform(features)
    p = prob_up(F.col("probability"))
    return out.select("symbol", "open_time", *keep, p.alias("prob_up"),
                      predicted_class(p).alias("prediction"),
                      *[vector_to_array(F.col(f"{n}_p"))[0].alias(f"{n}_prob") for n in BASE])


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
