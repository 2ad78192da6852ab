"""Late candles below the tail, the live job's tables, message status."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from barforge.operators.features import add_features
from barforge.operators.outcomes import outcomes_from_candles
from barforge.schema import CANDLE_SCHEMA, FEATURES
from barforge.session import scratch_path
from barforge.sources import raw
from barforge.streaming import job
from barforge.streaming import live as lv
from barforge.streaming import repair as rp
from barforge.streaming import tables as tb

STEP = 1_800_000


def _c(spark, rows):
    data = [(s, t * STEP, c, c + 1, c - 1, c, 1.0, 1, 0.5) for s, t, c in rows]
    return spark.createDataFrame(data, CANDLE_SCHEMA)


def _live(spark, batches, **kw):
    """Feed each list of rows as one micro-batch; the root of the tables."""
    root = scratch_path(spark, "t-repair")
    for i, rows in enumerate(batches):
        _c(spark, rows).coalesce(1).write.parquet(f"{root}/feed/part={i:04d}")
    stream = spark.readStream.schema(CANDLE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/feed")
    lv.start_live(stream, f"{root}/tables", f"{root}/ck", None, {"availableNow": True}, **kw).awaitTermination()
    return f"{root}/tables"


def _state(spark, root):
    preds = lv.newest(tb.read_table(spark, root, "predictions")).select("symbol", "open_time", "close", *FEATURES)
    outs = lv.newest(tb.read_table(spark, root, "outcomes")).select("symbol", "open_time", "actual_label")
    return sorted(map(tuple, preds.collect())), sorted(map(tuple, outs.collect()))


def _batch(spark, rows):
    """What the batch operators make of the last version of every candle."""
    candles = _c(spark, list({(s, t): (s, t, c) for s, t, c in rows}.values()))
    feats = add_features(candles, label=False).select("symbol", "open_time", "close", *FEATURES)
    outs = outcomes_from_candles(candles).select("symbol", "open_time", "actual_label")
    return sorted(map(tuple, feats.collect())), sorted(map(tuple, outs.collect()))


def test_a_candle_below_the_tail_moves_its_followers(spark):
    rows = [("A", t, 100 + math.sin(t)) for t in range(100)] + [("B", t, 50 + math.cos(t)) for t in range(100)]
    missing = ("A", 52, 100 + math.sin(52))
    batches = [[r for r in rows if r != missing], [missing]]
    root = _live(spark, batches)
    assert _state(spark, root) == _batch(spark, batches[0] + batches[1])
    second = spark.read.parquet(f"{root}/predictions/batch=1").select("symbol", "open_time", "kind").collect()
    # its own row and the 20 that follow it, and nothing else
    assert {(r["symbol"], r["open_time"] // STEP) for r in second} == {("A", t) for t in range(52, 73)}
    assert {r["kind"] for r in second} == {"repair"} and len(second) == 21
    late = spark.read.parquet(f"{root}/late").collect()
    assert [(r["symbol"], r["open_time"] // STEP, r["reason"]) for r in late] == [("A", 52, "below")]


def test_gaps_corrections_and_the_tails_lower_end(spark):
    rng = random.Random(3)
    times = sorted(rng.sample(range(5000), 120))       # sparse: neighbours lie far apart
    rows = [("G", t, 10 + rng.random()) for t in times] + [("H", t, 20 + rng.random()) for t in range(90)]
    first = [r for i, r in enumerate(rows) if i % 11]
    floor = sorted(t for s, t, _ in first if s == "H")[-lv.TAIL]
    batches = [first, [("H", floor, 77.0), ("G", times[3], 5.0)], [r for i, r in enumerate(rows) if not i % 11],
               [("H", 0, 1.0), ("H", 89, 2.0), ("G", -7, 3.0), ("H", 91, 4.0)]]
    root = _live(spark, batches)
    assert _state(spark, root) == _batch(spark, [r for b in batches for r in b])


def test_versions_below_the_tail(spark):
    """The later stamp wins whatever the order of arrival; without stamps the last arrival."""
    root = scratch_path(spark, "t-versions")
    base = [("V", t, 30 + math.sin(t), 100) for t in range(90)]
    batches = [base, [("V", 20, 8.0, 300)], [("V", 20, 9.0, 200)], [("V", 21, 5.0, 100)]]
    for i, rows in enumerate(batches):
        stamped = spark.createDataFrame([(s, t * STEP, c, c + 1, c - 1, c, 1.0, 1, 0.5, f"1970-01-01T00:00:00.{v:06d}+00:00")
                                         for s, t, c, v in rows], job.FEED_SCHEMA)
        stamped.coalesce(1).write.parquet(f"{root}/feed/part={i:04d}")
    stream = spark.readStream.schema(job.FEED_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/feed")
    lv.start_live(stream, f"{root}/tables", f"{root}/ck", None, {"availableNow": True}).awaitTermination()
    want = {t: c for _, t, c, _ in base} | {20: 8.0, 21: 5.0}
    assert _state(spark, f"{root}/tables") == _batch(spark, [("V", t, c) for t, c in want.items()])


def test_repair_reads_no_whole_history(spark):
    """Only chunks around the seeds enter the windows, and the stored files are filtered by time."""
    path = scratch_path(spark, "t-history")
    _c(spark, [("A", t, 1.0 + t) for t in range(20_000)]).select("*", F.lit(0).cast("long").alias("version"),
                                                                F.lit(0).cast("long").alias("seq")).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("spread", F.when(F.col("open_time") == 7000 * STEP, 1))
    state = rp.candle_state(stored, stored.limit(0))
    near = rp.neighbourhood(state, state.filter("spread = 1").select(*rp.KEY), rp.REACH_MS)
    rows = near.collect()
    assert 60 <= len(rows) <= 3 * rp.REACH_MS // STEP and sum(bool(r["whole"]) for r in rows) == 1
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(open_time" in plan and "LessThanOrEqual(open_time" in plan
    feats, outs = rp.recompute(state)
    assert sorted(r["open_time"] // STEP for r in feats.collect()) == list(range(7000, 7021))
    assert sorted(r["open_time"] // STEP for r in outs.collect()) == [6999, 7000]


def test_replayed_batch_writes_the_same(spark):
    """A batch whose commit was lost is processed again from the same slot and tables."""
    rng = random.Random(8)
    rows = [("R", t, 10 + rng.random()) for t in range(120)]
    late = rows[30]
    batches = [[r for r in rows[:100] if r != late], [late, *rows[100:110]], rows[110:]]
    root = _live(spark, batches[:2])
    before = sorted(map(tuple, spark.read.parquet(f"{root}/predictions/batch=1").collect()))
    base = os.path.dirname(root)
    commit = f"{base}/ck/commits/1"
    os.replace(commit, f"{base}/commit-1-lost")
    if os.path.exists(f"{base}/ck/commits/.1.crc"):
        os.replace(f"{base}/ck/commits/.1.crc", f"{base}/commit-1-lost.crc")
    _c(spark, batches[2]).coalesce(1).write.parquet(f"{base}/feed/part=0002")
    stream = spark.readStream.schema(CANDLE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/feed")
    lv.start_live(stream, root, f"{base}/ck", None, {"availableNow": True}).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(f"{root}/predictions/batch=1").collect())) == before
    assert _state(spark, root) == _batch(spark, rows)


def test_snapshots_hold_the_log_and_bound_the_files(spark):
    rows = [("S", t, 10 + math.sin(t)) for t in range(160)]
    batches = [[r for r in rows[i * 20:(i + 1) * 20] if r[1] % 13] for i in range(8)] + [[r for r in rows if not r[1] % 13]]
    root = _live(spark, batches, compact_every=3)
    want = _batch(spark, rows)
    assert _state(spark, root) == want
    log = lv.log_view(lv.read_table(spark, root, "predictions").withColumn("final_prob", F.lit(0.5)).withColumn("prediction", F.lit(1)),
                      lv.read_table(spark, root, "outcomes"))
    before = sorted(map(str, log.collect()))
    for name, order in lv.TABLES.items():
        tb.compact(spark, root, name, 1 << 30, order)
        assert tb.compact(spark, root, name, 1 << 30, order) is None      # nothing new
        assert len(tb.sources(spark, root, name)) == 1                    # whatever the number of batches
        assert tb.vacuum(spark, root, name) >= len(batches)
    assert _state(spark, root) == want
    log = lv.log_view(lv.read_table(spark, root, "predictions").withColumn("final_prob", F.lit(0.5)).withColumn("prediction", F.lit(1)),
                      lv.read_table(spark, root, "outcomes"))
    assert sorted(map(str, log.collect())) == before
    assert tb.read_table(spark, root, "nothing") is None


def test_every_message_is_closed_or_rejected_and_parsed_once(spark):
    import json
    good = {"open_time": 0, "open": 1.0, "high": 1.0, "low": 1.0, "close": 1.0, "volume": 1.0, "number_of_trades": 1,
            "symbol": "A", "ingested_at": "1970-01-01T00:30:05.000000+00:00"}
    items = [good, dict(good, interval="30m"), dict(good, interval="30m", ingested_at="1970-01-01T00:10:00+00:00"),
             dict(good, interval="5m"), dict(good, symbol=None), {k: v for k, v in good.items() if k != "ingested_at"}, "{oops", "", None]
    texts = spark.createDataFrame([(m if m is None or isinstance(m, str) else json.dumps(m),) for m in items], "value string")
    out = raw.tag_closed(raw.tag_candle_records(texts))
    assert out.columns == raw.MESSAGE_SCHEMA.fieldNames()
    got = out.collect()
    assert len(got) == len(items)
    assert sorted(str(r["reason"]) for r in got) == sorted(["None", "None", "not_closed", "bad_interval", "no_key", "no_stamp",
                                                            "malformed", "malformed", "malformed"])
    assert {r["interval"] for r in got if r["status"] == "closed"} == {"1m", "30m"}
    assert all((r["raw"] is None) == (r["status"] == "closed") for r in got if r["reason"] != "malformed")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize("wait", [True, False])
def test_job_from_messages(spark, wait):
    """All three queries at once, or one after another; the source is read by the first alone."""
    import json
    root = scratch_path(spark, "t-job")
    rows = [{"open_time": t * STEP, "open": 1.0 + t, "high": 2.0 + t, "low": 1.0, "close": 1.0 + math.sin(t), "volume": 1.0,
             "number_of_trades": 1, "taker_buy_quote_asset_volume": 0.5, "symbol": "A", "interval": "30m",
             "ingested_at": "2030-01-01T00:00:00.000000+00:00"} for t in range(40)]
    texts = [json.dumps(r) for r in rows] + ["{bad"]
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(f"{root}/source")
    stream = spark.readStream.schema("value string").text(f"{root}/source")
    trigger = {"availableNow": True} if wait else {"processingTime": "1 second"}
    queries = job.start_job(stream, root, trigger=trigger, wait=wait, state_partitions=2)
    if wait:
        queries[-1].awaitTermination()
    else:
        for _ in range(120):
            found = tb.read_table(spark, f"{root}/tables", "predictions")
            if found is not None and found.count() == 20:
                break
            queries[-1].awaitTermination(1)
        for q in queries:
            q.stop()
    assert tb.read_table(spark, f"{root}/tables", "predictions").count() == 20
    assert [r["reason"] for r in job.rejects(spark, root).collect()] == ["malformed"]
    assert job.closed_records(spark, root).count() == 40
