"""Exact folds, splits, sampling, evaluation edge cases."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from barforge.functions import signals as sg
from barforge.operators import evaluate as ev
from barforge.operators import folds as fo


def _ntile_brute(n, k):
    q, r = divmod(n, k)
    out = []
    for j in range(k):
        out += [j] * (q + 1 if j < r else q)
    return out


def test_ntile_starts_match_definition():
    for n in range(0, 40):
        for k in range(1, 6):
            b = _ntile_brute(n, k)
            starts = [b.index(j) if j in b else n for j in range(1, k)]
            got = fo.ntile_starts(n, k)
            assert [g if g < n else n for g in got] == starts, (n, k)


def test_folds_equal_global_ntile_with_ties(spark):
    rnd = random.Random(7)
    rows = [(f"S{s:02d}", 1000 * rnd.randint(0, 40), rnd.randint(0, 1)) for s in range(23) for _ in range(9)]
    rows = list({(a, b): (a, b, c) for a, b, c in rows}.values())
    df = spark.createDataFrame(rows, "symbol string, open_time long, label int")
    for k in (2, 3, 5):
        got = fo.walk_forward_folds(df.repartition(7), k)
        want = df.withColumn("fold", F.ntile(k).over(Window.orderBy("open_time", "symbol")) - 1)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_fold_plan_has_no_single_partition_exchange(spark):
    df = spark.range(0, 5000).select((F.col("id") % 37).cast("string").alias("symbol"),
                                     (F.col("id") * 60_000).alias("open_time"))
    plan = fo.walk_forward_folds(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Exchange" not in plan


def test_weights_average_one(spark):
    df = spark.createDataFrame([(i % 3 == 0 and 1 or 0,) for i in range(300)], "label int")
    w = fo.add_class_weights(df, 1.0)
    assert abs(w.agg(F.avg("weight")).first()[0] - 1.0) < 1e-12


def test_one_class_gives_unit_weights(spark):
    df = spark.createDataFrame([(1,)] * 10, "label int")
    assert {r["weight"] for r in fo.class_weights(df).collect()} == {1.0}


def test_undersampling_layout_independent(spark):
    df = spark.range(0, 2000).select(F.lit("X").alias("symbol"), F.col("id").alias("open_time"),
                                     (F.col("id") % 3 == 0).cast("int").alias("label"))
    a = sorted(map(tuple, fo.undersample_majority(df.repartition(1)).collect()))
    b = sorted(map(tuple, fo.undersample_majority(df.repartition(13)).collect()))
    assert a == b
    ones = sum(1 for r in a if r[2] == 1)
    zeros = len(a) - ones
    assert abs(zeros - ones) < 0.15 * ones


def test_signal_edges(spark):
    ps = [0.3, 0.4, 0.5, 0.6, 0.7, 1.0, 0.0, 0.55]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    df = df.withColumn("pred", sg.predicted_class(F.col("p")))
    got = {r["p"]: (r["s"], r["c"]) for r in df.select(
        "p", sg.signal(F.col("p"), F.col("pred")).alias("s"), sg.confidence(F.col("p")).alias("c")).collect()}
    assert got[0.3] == ("SELL (Short)", "VERY HIGH")
    assert got[0.4] == ("SELL (Short)", "HIGH")
    assert got[0.5] == ("WAIT", "Low")
    assert got[0.6] == ("BUY (Long)", "HIGH")
    assert got[0.7] == ("BUY (Long)", "VERY HIGH")
    assert got[1.0] == ("BUY (Long)", "VERY HIGH")
    assert got[0.55] == ("WAIT", "Low")


def test_recall_with_missing_class(spark):
    df = spark.createDataFrame([(1, 1), (1, 0)], "label int, prediction int")
    r = ev.class_recall(df).first()
    assert r["up_recall"] == 0.5 and r["down_recall"] == 0.0


def test_auc_ties_and_brute_force(spark):
    rnd = random.Random(3)
    rows = [(round(rnd.random(), 2), rnd.randint(0, 1)) for _ in range(500)]
    df = spark.createDataFrame(rows, "prob_up double, label int")
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = ev.auc_exact(df).first()["auc"]
    assert abs(got - brute) < 1e-12


def test_auc_matches_mllib_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rnd = random.Random(5)
    rows = [(rnd.random(), rnd.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "prob_up double, label int")
    mllib = BinaryClassificationEvaluator(rawPredictionCol="prob_up", labelCol="label",
                                          numBins=0).evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert abs(ev.auc_exact(df).first()["auc"] - mllib) < 1e-9


def test_f1_matches_mllib(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rnd = random.Random(11)
    rows = [(float(rnd.randint(0, 1)), float(rnd.randint(0, 1))) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    f1 = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    acc = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df)
    got = ev.accuracy_f1(df.select(F.col("label").cast("int").alias("label"),
                                   F.col("prediction").cast("int").alias("prediction"))).first()
    assert abs(got["f1"] - f1) < 1e-12 and abs(got["accuracy"] - acc) < 1e-12


def test_reports_on_one_class_and_empty_input(spark):
    one = spark.createDataFrame([(0.7, 1, 1), (0.6, 1, 0)], "prob_up double, label int, prediction int")
    assert ev.auc_exact(one).first()["auc"] is None
    empty = one.filter("label = 2")
    r = ev.accuracy_f1(empty).first()
    assert r["count"] == 0 and r["accuracy"] is None


def test_snapped_folds_keep_moments_whole(spark):
    rows = [(f"S{s}", 1000 * t, 0) for t in range(10) for s in range(7)]
    df = spark.createDataFrame(rows, "symbol string, open_time long, label int")
    out = fo.walk_forward_folds(df, 3, snap_to_time=True)
    per_time = out.groupBy("open_time").agg(F.countDistinct("fold").alias("n")).agg(F.max("n")).first()[0]
    assert per_time == 1
    edges = out.groupBy("fold").agg(F.min("open_time").alias("a"), F.max("open_time").alias("b")).orderBy("fold").collect()
    assert all(edges[i]["b"] < edges[i + 1]["a"] for i in range(len(edges) - 1))


def test_key_ranks_distributed_equal_sorted(spark):
    rnd = random.Random(4)
    keys = list({"".join(rnd.choice("ABCDEFGH") for _ in range(rnd.randint(1, 6))) for _ in range(3000)})
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys * 2)], "symbol string, x long")
    ranked, n = fo.key_ranks(df, "symbol", keys_per_part=97)           # many blocks
    got = {r["symbol"]: r["_rank"] for r in ranked.collect()}
    assert n == len(keys) and got == {k: i for i, k in enumerate(sorted(keys))}


def test_auc_with_narrow_scores_and_outliers(spark):
    """Nearly all scores within a hair, two far out: ranges follow the scores, the value is exact."""
    rows = [(i % 2, 0.5 + (i * 7919 % 5000) / 1e7) for i in range(5000)] + [(0, 1e9), (1, -1e9)]
    df = spark.createDataFrame(rows, "label int, prob_up double")
    pos, neg = [s for y, s in rows if y], sorted(s for y, s in rows if not y)
    import bisect
    wins = sum((bisect.bisect_left(neg, s) + bisect.bisect_right(neg, s)) / 2 for s in pos)
    assert abs(ev.auc_exact(df).first()["auc"] - wins / (len(pos) * len(neg))) < 1e-12
