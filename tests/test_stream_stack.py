"""Streaming = batch (with a restart), arrival rules, stacked pipeline parity."""

import math
import os
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from barforge.operators.features import add_features
from barforge.plans import stack as st
from barforge.plans import training as tr
from barforge.plans.catalog import event_candles, event_features
from barforge.schema import CANDLE_SCHEMA, FEATURES
from barforge.session import scratch_path
from barforge.streaming import live as lv
from tests.conftest import SMALL


def _feed(spark, candles, parts, folder, first=0):
    lo, hi = candles.agg(F.min("open_time"), F.max("open_time")).first()
    step = (hi - lo) // parts + 1
    for i in range(parts):
        part = candles.filter((F.col("open_time") >= lo + i * step) & (F.col("open_time") < lo + (i + 1) * step))
        part.coalesce(1).write.parquet(os.path.join(folder, f"part={first + i:04d}"))


def _run(spark, feed, out, model=None):
    schema = spark.read.parquet(feed).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed)
    q = lv.start_live(stream, f"{out}/tables", f"{out}/ck", model, {"availableNow": True})
    q.awaitTermination()


def test_stream_equals_batch_with_restart(spark):
    candles = event_candles(spark, SMALL).persist()
    root = scratch_path(spark, "t-stream")
    feed = f"{root}/feed"
    lo, hi = candles.agg(F.min("open_time"), F.max("open_time")).first()
    mid = lo + (hi - lo) // 2
    _feed(spark, candles.filter(F.col("open_time") < mid), 2, feed)
    _run(spark, feed, root)
    _feed(spark, candles.filter(F.col("open_time") >= mid), 2, feed, first=2)   # new files, then restart
    _run(spark, feed, root)
    got = spark.read.parquet(f"{root}/tables/predictions").select("symbol", "open_time", "close", *FEATURES)
    want = add_features(candles, label=False).select("symbol", "open_time", "close", *FEATURES)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    outs = spark.read.parquet(f"{root}/tables/outcomes")
    n_candles = candles.count()
    n_symbols = candles.select("symbol").distinct().count()
    assert outs.count() == n_candles - n_symbols


def _c(spark, rows):
    data = [(s, t * 1_800_000, c, c + 1, c - 1, c, 1.0, 1, 0.5) for s, t, c in rows]
    return spark.createDataFrame(data, CANDLE_SCHEMA)


def test_resent_and_late_candles(spark):
    root = scratch_path(spark, "t-arrivals")
    first = [("A", t, 100.0 + math.sin(t)) for t in range(25)]
    _c(spark, first).coalesce(1).write.parquet(f"{root}/feed/part=0000")
    _run(spark, f"{root}/feed", root)
    # re-send the newest candle with a new close, and one far older candle
    _c(spark, [("A", 24, 500.0), ("A", 1, 7.0)]).coalesce(1).write.parquet(f"{root}/feed/part=0001")
    _run(spark, f"{root}/feed", root)
    preds = spark.read.parquet(f"{root}/tables/predictions")
    kinds = {(r["open_time"] // 1_800_000, r["kind"]) for r in preds.collect()}
    assert (24, "update") in kinds and (24, "window") in kinds
    outs = spark.read.parquet(f"{root}/tables/outcomes")
    log = lv.log_view(preds.withColumn("final_prob", F.lit(0.5)).withColumn("prediction", F.lit(1)), outs)
    row = log.filter(F.col("timestamp") == 23 * 1_800_000).first()
    assert row["actual_label"] == 1 and row["close"] == 100.0 + math.sin(23)


@pytest.fixture(scope="module")
def small_stack(spark):
    feats = event_features(spark, SMALL, tail="drop")
    params = st.StackParams(rf=dict(numTrees=5, maxDepth=3, seed=42), gbt=dict(maxIter=3, maxDepth=2, seed=42),
                            lr=dict(maxIter=20, regParam=0.01), meta=dict(maxIter=20, regParam=0.001))
    return tr.train_stack(feats, k=3, params=params), feats


def test_stack_parity_with_meta_coefficients(spark, small_stack):
    result, feats = small_stack
    scored = st.score(result.model, feats).collect()
    meta = result.model.stages[-1]
    w, b = meta.coefficients.toArray(), meta.intercept
    for r in scored[:50]:
        z = w[0] * r["rf_prob"] + w[1] * r["gbt_prob"] + w[2] * r["lr_prob"] + b
        assert abs(r["prob_up"] - 1 / (1 + math.exp(-z))) < 1e-12
        assert r["prediction"] == int(r["prob_up"] > 0.5)


def test_scoring_plan_has_no_python_and_no_join(spark, small_stack):
    result, feats = small_stack
    plan = st.score(result.model, feats)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "Join" not in plan


def test_save_load_round_trip(spark, small_stack):
    result, feats = small_stack
    path = scratch_path(spark, f"model-{uuid.uuid4().hex[:6]}")
    st.save(result.model, path)
    again = st.load(path)
    a = sorted(map(tuple, st.score(result.model, feats).collect()))
    b = sorted(map(tuple, st.score(again, feats).collect()))
    assert a == b
    assert again.stages[0].getInputCols() == list(FEATURES)


def test_oof_covers_later_folds_only(spark, small_stack):
    result, feats = small_stack
    folds = {r["fold"] for r in result.oof.select("fold").distinct().collect()}
    assert folds == {1, 2}
    assert result.oof.count() < feats.count()


def test_two_queries_ticks_to_live_windows(spark):
    """Query A: trades -> watermark candles appended to a table; query B reads
    that table as a stream into the live window state."""
    from barforge.sources.tables import event_trades, table
    from barforge.streaming.resample import stream_candles
    root = scratch_path(spark, "t-two-queries")
    events = table(spark, SMALL, "events")
    trades_stream = spark.readStream.schema(events.schema).parquet(os.path.join(SMALL, "event[s].parquet"))
    a = lv.start(stream_candles(event_trades(trades_stream), 30, "10 minutes", order_col="trade_order"),
                 f"{root}/candles", f"{root}/ck-a", {"availableNow": True})
    a.awaitTermination()
    candles = spark.read.parquet(f"{root}/candles")
    stream = spark.readStream.schema(candles.schema).parquet(f"{root}/candles")
    b = lv.start_live(stream, f"{root}/tables", f"{root}/ck-b", None, {"availableNow": True})
    b.awaitTermination()
    got = spark.read.parquet(f"{root}/tables/predictions").select("symbol", "open_time", "close", *FEATURES)
    want = add_features(candles, label=False).select("symbol", "open_time", "close", *FEATURES)
    assert got.count() > 0
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_out_of_order_while_filling(spark):
    """Candles of the warm-up arrive newest-first across batches: the window
    still fills in time order and the first full window is scored."""
    root = scratch_path(spark, "t-fill")
    rows = [("B", t, 50.0 + math.cos(t)) for t in range(22)]
    _c(spark, rows[10:]).coalesce(1).write.parquet(f"{root}/feed/part=0000")
    _run(spark, f"{root}/feed", root)
    _c(spark, rows[:10]).coalesce(1).write.parquet(f"{root}/feed/part=0001")
    _run(spark, f"{root}/feed", root)
    _c(spark, [("B", 22, 51.0)]).coalesce(1).write.parquet(f"{root}/feed/part=0002")
    _run(spark, f"{root}/feed", root)
    preds = lv.newest(spark.read.parquet(f"{root}/tables/predictions"))
    got = preds.select("symbol", "open_time", "close", *FEATURES).collect()
    # every candle is scored once its lookback is complete, whatever the order of arrival: 20, 21 and 22
    want = add_features(_c(spark, rows + [("B", 22, 51.0)]), label=False).select("symbol", "open_time", "close", *FEATURES).collect()
    assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in want)


def test_watermark_drops_late_trades(spark):
    """A trade older than the watermark does not reopen its (already emitted)
    candle. Spark judges lateness against the watermark of the previous
    micro-batch, so the late trade arrives two batches after the data that
    moved the watermark past its candle."""
    from barforge.streaming.resample import stream_candles
    root = scratch_path(spark, "t-late")
    schema = ("symbol string, open_time long, open double, high double, low double, close double, "
              "volume double, number_of_trades long, taker_buy_quote_asset_volume double")
    hour = 3_600_000

    def trades(minutes, price=1.0):
        return [("X", m * 60_000, price, price, price, price, 1.0, 1, 0.0) for m in minutes]

    parts = [trades(range(0, 180)), trades(range(180, 240)), [("X", 5 * 60_000 + 1, 9.0, 9.0, 9.0, 9.0, 1.0, 1, 0.0)]]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/feed/part={i:04d}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/feed")
    q = lv.start(stream_candles(stream.drop("part"), 30, "10 minutes"), f"{root}/out", f"{root}/ck",
                 {"availableNow": True})
    q.awaitTermination()
    rows = spark.read.parquet(f"{root}/out").collect()
    first = [r for r in rows if r["open_time"] == 0]
    assert len(first) == 1 and first[0]["number_of_trades"] == 30 and first[0]["high"] == 1.0
    assert max(r["open_time"] for r in rows) == 3 * hour          # 3:00-3:30 closed, 3:30 still open


def test_resent_middle_candle_updates_both_outcomes(spark):
    root = scratch_path(spark, "t-middle")
    rows = [("M", t, 10.0 + t) for t in range(25)]                  # always up
    _c(spark, rows).coalesce(1).write.parquet(f"{root}/feed/part=0000")
    _run(spark, f"{root}/feed", root)
    _c(spark, [("M", 22, 100.0)]).coalesce(1).write.parquet(f"{root}/feed/part=0001")   # spike
    _run(spark, f"{root}/feed", root)
    outs = spark.read.parquet(f"{root}/tables/outcomes")
    latest = {r["open_time"] // 1_800_000: r["a"] for r in
              outs.groupBy("open_time").agg(F.max_by("actual_label", "seq").alias("a")).collect()}
    assert latest[21] == 1 and latest[22] == 0 and latest[23] == 1


def test_a_candle_that_comes_late_between_two_others_moves_what_follows(spark):
    root = scratch_path(spark, "t-between")
    rows = [("L", t, 20.0 + math.sin(t)) for t in range(45)]
    missing = rows[33]
    feed = f"{root}/feed"
    _c(spark, [r for r in rows if r != missing]).coalesce(1).write.parquet(f"{feed}/part=0000")
    _run(spark, feed, root)
    _c(spark, [missing]).coalesce(1).write.parquet(f"{feed}/part=0001")
    _run(spark, feed, root)
    got = lv.newest(spark.read.parquet(f"{root}/tables/predictions")).select("symbol", "open_time", "close", *FEATURES)
    want = add_features(_c(spark, rows), label=False).select("symbol", "open_time", "close", *FEATURES)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    outs = {r["open_time"] // 1_800_000: r["actual_label"] for r in lv.newest(spark.read.parquet(f"{root}/tables/outcomes")).collect()}
    assert outs == {t: int(b[2] > a[2]) for t, (a, b) in enumerate(zip(rows, rows[1:]))}
    # far older than the tail: kept, with its values, in the late table
    _c(spark, [("L", 1, 77.0)]).coalesce(1).write.parquet(f"{feed}/part=0002")
    _run(spark, feed, root)
    late = spark.read.parquet(f"{root}/tables/late").collect()
    assert [(r["open_time"], r["close"]) for r in late if r["close"] == 77.0] == [(1_800_000, 77.0)]


def test_training_does_not_depend_on_the_layout(spark):
    feats = event_features(spark, SMALL, tail="drop").persist()
    params = st.StackParams(rf=dict(numTrees=5, maxDepth=4, seed=42, subsamplingRate=0.7), gbt=dict(maxIter=3, maxDepth=2, seed=42),
                            lr=dict(maxIter=10, regParam=0.01), meta=dict(maxIter=10, regParam=0.001))
    seen = []
    for n in (1, 4, 32):
        r = tr.train_stack(feats.repartition(n), k=2, params=params)
        probs = sorted((x["symbol"], x["open_time"], round(x["rf_prob"], 9), round(x["gbt_prob"], 9), round(x["lr_prob"], 9))
                       for x in r.oof.collect())
        seen.append(([round(v, 9) for v in r.base["rf"].featureImportances.toArray()], probs))
    feats.unpersist()
    assert seen[0] == seen[1] == seen[2]


def test_base_models_are_fitted_side_by_side(spark, monkeypatch):
    """Two fits wait for each other, so one after the other would break the barrier; the
    models are those of one fit at a time."""
    feats = event_features(spark, SMALL, tail="drop").persist()
    small = dict(rf=dict(numTrees=3, maxDepth=3, seed=42), gbt=dict(maxIter=2, maxDepth=2, seed=42),
                 lr=dict(maxIter=10, regParam=0.01), meta=dict(maxIter=10, regParam=0.001))
    alone = tr.train_stack(feats, k=2, params=st.StackParams(**small, parallelism=1))
    together, real = threading.Barrier(2, timeout=120), st.fit_base_model

    def fit(*args):
        together.wait()
        return real(*args)

    monkeypatch.setattr(st, "fit_base_model", fit)
    both = tr.train_stack(feats, k=2, params=st.StackParams(**small, parallelism=2))
    feats.unpersist()
    rows = [sorted((x["symbol"], x["open_time"], round(x["rf_prob"], 9), round(x["gbt_prob"], 9), round(x["lr_prob"], 9))
                   for x in r.oof.collect()) for r in (alone, both)]
    assert rows[0] and rows[0] == rows[1]
    for m in ("rf", "gbt"):
        assert alone.base[m].featureImportances.toArray().tolist() == pytest.approx(both.base[m].featureImportances.toArray().tolist())


def test_feature_filter_holds_no_formula(spark):
    plan = event_features(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if line.strip(" +-:").startswith("Filter"):
            assert "/" not in line.split("Filter", 1)[1].split("[plan")[0].replace("//", ""), line[:300]
