"""Model evaluation reports (AGG-5..14) as aggregates over a predictions table.

Inputs: ``label`` (0/1), ``prediction`` (0/1) and a probability of the up
class. Every report is one or two aggregations; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.session import cut_lineage


def _count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def confusion(df: DataFrame) -> DataFrame:
    """(label, prediction, count) for the cells that occur (AGG-5)."""
    return (df.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("label", "prediction"))


def _cells(df: DataFrame) -> DataFrame:
    l, p = F.col("label"), F.col("prediction")
    return df.agg(
        _count_if((l == 1) & (p == 1)).alias("tp1"), _count_if((l == 0) & (p == 1)).alias("fp1"),
        _count_if((l == 1) & (p == 0)).alias("fn1"), _count_if((l == 0) & (p == 0)).alias("tp0"),
        F.count(F.lit(1)).alias("n"))


def _ratio0(num: Column, den: Column) -> Column:
    """num / den, 0 when den is 0."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def _rates(tp1: Column, fp1: Column, fn1: Column, tp0: Column) -> dict[str, Column]:
    """Recall of both classes, accuracy and label-weighted F1 from the four cells
    (doubles). Per class: precision = tp / predicted (0 if none), recall = tp / actual,
    F1 = 2PR / (P + R) (0 if both 0); classes weighted by their label share."""
    fp0, fn0, n = fn1, fp1, tp1 + fp1 + fn1 + tp0

    def f1(tp, fp, fn):
        prec, rec = _ratio0(tp, tp + fp), _ratio0(tp, tp + fn)
        return F.when(prec + rec == 0, F.lit(0.0)).otherwise(F.lit(2.0) * prec * rec / (prec + rec))

    w1, w0 = _ratio0(tp1 + fn1, n), _ratio0(tp0 + fp1, n)
    return {"up_recall": _ratio0(tp1, tp1 + fn1), "down_recall": _ratio0(tp0, tp0 + fp1),
            "accuracy": F.when(n > 0, (tp1 + tp0) / n),
            "f1": F.when(n > 0, f1(tp1, fp1, fn1) * w1 + f1(tp0, fp0, fn0) * w0)}


_CELL_NAMES = ("tp1", "fp1", "fn1", "tp0")


def class_recall(df: DataFrame) -> DataFrame:
    """UP and DOWN recall, 0 for an empty class (AGG-6)."""
    rates = _rates(*(F.col(x).cast("double") for x in _CELL_NAMES))
    return _cells(df).select(*[rates[m].alias(m) for m in ("up_recall", "down_recall")])


def accuracy_f1(df: DataFrame) -> DataFrame:
    """Accuracy and label-weighted F1 as MLlib defines them (AGG-7, AGG-8)."""
    rates = _rates(*(F.col(x).cast("double") for x in _CELL_NAMES))
    return _cells(df).select(*[rates[m].alias(m) for m in ("accuracy", "f1")], F.col("n").alias("count"))


def auc_exact(df: DataFrame, score: str = "prob_up", by: tuple[str, ...] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counted half (AGG-9), for each group of
    ``by`` (a few groups, such as models).

    AUC = sum over positives of (#negatives scored lower + #tied / 2) / (P N).
    Scores are first reduced to (by, score, pos, neg). These rows are range
    partitioned by group and score, as evenly as they lie and whatever outliers there
    are, and frozen by a reliable checkpoint; totals per range (a row a partition and
    a group it holds, broadcast) give each range's offset in its group, and a window
    inside each range adds the rest.
    """
    per = df.groupBy(*by, F.col(score).alias("s")).agg(
        F.sum(F.col("label").cast("long")).alias("pos"),
        F.sum((1 - F.col("label")).cast("long")).alias("neg"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per = cut_lineage(per.repartitionByRange(n, *by, "s").withColumn("b", F.spark_partition_id()))
    totals = per.groupBy(*by, "b").agg(F.sum("neg").alias("bneg"))
    wb = Window.partitionBy(*by).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("before", F.coalesce(F.sum("bneg").over(wb), F.lit(0))).drop("bneg")
    wi = Window.partitionBy(*by, "b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (per.join(F.broadcast(offsets), [*by, "b"])
              .withColumn("below", F.col("before") + F.coalesce(F.sum("neg").over(wi), F.lit(0))))
    pairs = F.lit(2.0) * F.sum("pos").cast("double") * F.sum("neg").cast("double")
    wins = F.sum(F.col("pos").cast("double") * (F.col("below") * F.lit(2.0) + F.col("neg")))
    return ranked.groupBy(*by).agg(
        F.when(pairs > 0, wins / pairs).alias("auc"),      # undefined with one class
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))


def prob_bin(p: Column) -> Column:
    """5%-wide bin: round(floor(p * 20) / 20, 2)."""
    return F.round(F.floor(p * F.lit(20)) / F.lit(20), 2)


def calibration_table(df: DataFrame, prob: str = "prob_up") -> DataFrame:
    """Per 5% bin: count, mean predicted p, share of UP, error = actual - mean p (AGG-10)."""
    return (df.groupBy(prob_bin(F.col(prob)).alias("prob_bin"))
            .agg(F.count(F.lit(1)).alias("count"),
                 F.avg(prob).alias("avg_predicted_prob"),
                 F.avg(F.when(F.col("label") == 1, F.lit(1.0)).otherwise(F.lit(0.0))).alias("actual_prob_up"))
            .withColumn("calibration_error", F.col("actual_prob_up") - F.col("avg_predicted_prob"))
            .orderBy("prob_bin"))


def calibration_error(df: DataFrame, prob: str = "prob_up") -> DataFrame:
    """Count-weighted mean absolute calibration error over the bins (AGG-11)."""
    t = calibration_table(df, prob)
    return t.agg((F.sum(F.col("count") * F.abs("calibration_error")) / F.sum("count"))
                 .alias("mean_abs_calibration_error"), F.count(F.lit(1)).alias("bins"))


def probability_summary(df: DataFrame, prob: str = "prob_up") -> DataFrame:
    """count, mean, sample stddev, min, max of p (AGG-12)."""
    return df.agg(F.count(prob).alias("count"), F.avg(prob).alias("mean"),
                  F.stddev_samp(prob).alias("stddev"), F.min(prob).alias("min"),
                  F.max(prob).alias("max"))


# --- fixed values: confidence bands (upper edges, exclusive) and names ---------
BAND_EDGES = (0.45, 0.50, 0.55, 0.60, 0.65, 0.70)
BAND_NAMES = ("Very Low (0-45%)", "Low (45-50%)", "Borderline (50-55%)", "Moderate (55-60%)",
              "Confident (60-65%)", "High (65-70%)", "Very High (70%+)")
# --------------------------------------------------------------------------------


def confidence_band(p: Column) -> tuple[Column, Column]:
    band = F.lit(len(BAND_EDGES))
    for i in reversed(range(len(BAND_EDGES))):
        band = F.when(p < F.lit(BAND_EDGES[i]), F.lit(i)).otherwise(band)
    name = F.element_at(F.array(*[F.lit(n) for n in BAND_NAMES]), band + 1)
    return band, name


def confidence_bands(df: DataFrame, prob: str = "prob_up") -> DataFrame:
    """Predictions per confidence band, with a numeric band id (AGG-13)."""
    band, name = confidence_band(F.col(prob))
    return df.groupBy(band.alias("band"), name.alias("confidence_range")).agg(
        F.count(F.lit(1)).alias("count")).orderBy("band")


def confident_subset(df: DataFrame, thresholds=(0.6, 0.7), prob: str = "prob_up") -> DataFrame:
    """For each t: rows with p >= t or p <= 1 - t, their share, accuracy, and the
    overall accuracy, all from one aggregate (AGG-14, FLT-4, FLT-5)."""
    p, hit = F.col(prob), F.col("prediction") == F.col("label")
    aggs = [F.count(F.lit(1)).alias("total"), _count_if(hit).alias("correct")]
    for i, t in enumerate(thresholds):
        inside = (p >= F.lit(t)) | (p <= F.lit(1.0 - t))
        aggs += [_count_if(inside).alias(f"n{i}"), _count_if(inside & hit).alias(f"c{i}")]
    n, c, total = (lambda i: F.col(f"n{i}")), (lambda i: F.col(f"c{i}")), F.col("total")
    return df.agg(*aggs).select(F.inline(F.array(*[F.struct(
        F.lit(t).alias("threshold"), n(i).alias("count"),
        F.when(total > 0, n(i) * F.lit(100.0) / total).otherwise(F.lit(0.0)).alias("pct_of_total"),
        F.when(n(i) > 0, c(i) / n(i)).alias("accuracy"),
        F.when(total > 0, F.col("correct") / total).alias("overall_accuracy"))
        for i, t in enumerate(thresholds)])))


# ---- all reports for several models at once (ML-10) ---------------------------------

def by_model(df: DataFrame, scores: dict[str, str], keep: tuple[str, ...] = ("label",)) -> DataFrame:
    """One row a row of ``df`` and model: ``keep``, ``model``, ``p`` and ``prediction`` (p > 0.5).
    ``scores``: model -> its probability column."""
    rows = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("p")) for m, c in scores.items()])
    return df.select(*keep, F.inline(rows)).withColumn("prediction", (F.col("p") > 0.5).cast("int"))


def _tall(df: DataFrame, report: str, values: dict[str, Column], item: Column | None = None,
          item2: Column | None = None) -> DataFrame:
    """``model, report, item, item2, metric, value``, a row a value."""
    no = F.lit(None).cast("double")
    return df.select("model", F.lit(report).alias("report"), (no if item is None else item.cast("double")).alias("item"),
                     (no if item2 is None else item2.cast("double")).alias("item2"),
                     F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value"))
                                        for m, v in values.items()])))


def evaluation_bundle(df: DataFrame, scores: dict[str, str], thresholds: tuple[float, ...] = (0.6, 0.7)) -> DataFrame:
    """Every report (AGG-5..14) for each model: ``model, report, item, item2, metric, value``.

    One aggregate over the unpivoted rows counts the cells (model, 5% bin, confidence
    band, thresholds passed, label, prediction): at most a few hundred a model, whatever the
    rows. They are stored, and all reports but AUC are sums over them. AUC takes a second
    pass (``auc_exact`` by model). ``df`` is read twice: store it if it is expensive.

    report           item        item2       metrics
    confusion        label       prediction  count
    rates                                    up_recall, down_recall, accuracy, f1, count
    auc                                      auc, positives, negatives
    calibration      bin                     count, avg_predicted_prob, actual_prob_up, calibration_error
    calibration_error                        mean_abs_calibration_error, bins
    summary                                  count, mean, stddev, min, max
    bands            band                    count
    confident        threshold               count, pct_of_total, accuracy, overall_accuracy
    """
    rows = by_model(df, scores)
    p, half = F.col("p"), F.col("p") - F.lit(0.5)
    inside = [((p >= F.lit(t)) | (p <= F.lit(1.0 - t))).alias(f"in{i}") for i, t in enumerate(thresholds)]
    cells = cut_lineage(rows.groupBy("model", prob_bin(p).alias("bin"), confidence_band(p)[0].alias("band"), *inside, "label", "prediction").agg(
        F.count(F.lit(1)).alias("n"), F.sum(p).alias("s"), F.sum(half).alias("h"), F.sum(half * half).alias("hh"),
        F.min(p).alias("lo"), F.max(p).alias("hi")))
    n, hit = F.sum("n"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))

    confusion_ = _tall(cells.groupBy("model", "label", "prediction").agg(n.alias("n")), "confusion", {"count": F.col("n")},
                       F.col("label"), F.col("prediction"))
    cell = {x: F.sum(F.when((F.col("label") == a) & (F.col("prediction") == b), F.col("n")).otherwise(0)).cast("double").alias(x)
            for x, (a, b) in zip(_CELL_NAMES, ((1, 1), (0, 1), (1, 0), (0, 0)))}
    rates = _tall(cells.groupBy("model").agg(*cell.values(), n.alias("n")), "rates",
                  {**_rates(*map(F.col, _CELL_NAMES)), "count": F.col("n")})
    bins = cells.groupBy("model", "bin").agg(n.alias("n"), (F.sum("s") / n).alias("said"), (F.sum(
        F.when(F.col("label") == 1, F.col("n")).otherwise(0)) / n).alias("was"))
    off = F.col("was") - F.col("said")
    calibration = _tall(bins, "calibration", {"count": F.col("n"), "avg_predicted_prob": F.col("said"),
                                              "actual_prob_up": F.col("was"), "calibration_error": off}, F.col("bin"))
    error = _tall(bins.groupBy("model").agg((F.sum(F.col("n") * F.abs(off)) / F.sum("n")).alias("e"), F.count(F.lit(1)).alias("k")),
                  "calibration_error", {"mean_abs_calibration_error": F.col("e"), "bins": F.col("k")})
    spread = F.sqrt(F.greatest(F.col("hh") - F.col("h") * F.col("h") / F.col("n"), F.lit(0.0)) / (F.col("n") - 1))
    summary = _tall(cells.groupBy("model").agg(n.alias("n"), *[F.sum(c).alias(c) for c in ("s", "h", "hh")], F.min("lo").alias("lo"),
                                               F.max("hi").alias("hi")),
                    "summary", {"count": F.col("n"), "mean": F.col("s") / F.col("n"), "stddev": F.when(F.col("n") > 1, spread),
                                "min": F.col("lo"), "max": F.col("hi")})
    bands = _tall(cells.groupBy("model", "band").agg(n.alias("n")), "bands", {"count": F.col("n")}, F.col("band"))
    own = cells.groupBy("model").agg(n.alias("n"), hit.alias("hit"), *[x for i in range(len(thresholds)) for x in (
        F.sum(F.when(F.col(f"in{i}"), F.col("n")).otherwise(0)).alias(f"n{i}"),
        F.sum(F.when(F.col(f"in{i}") & (F.col("label") == F.col("prediction")), F.col("n")).otherwise(0)).alias(f"c{i}"))])
    parts = [confusion_, rates, calibration, error, summary, bands, _tall(auc_exact(rows, "p", ("model",)), "auc", {
        "auc": F.col("auc"), "positives": F.col("positives"), "negatives": F.col("negatives")})]
    for i, t in enumerate(thresholds):
        k, c = F.col(f"n{i}"), F.col(f"c{i}")
        parts.append(_tall(own, "confident", {"count": k, "pct_of_total": k * 100.0 / F.col("n"), "accuracy": F.when(k > 0, c / k),
                                              "overall_accuracy": F.col("hit") / F.col("n")}, F.lit(t)))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out
