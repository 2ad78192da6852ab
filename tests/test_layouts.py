"""Exact folds with wide cut times, holdouts that prune files, positions, the bundle."""

import random

import pytest
from pyspark.sql import functions as F

from barforge.operators import evaluate as ev
from barforge.operators import folds as fo
from barforge.schema import CANDLE_SCHEMA
from barforge.session import scratch_path
from barforge.sources.tables import read_symbol_files, read_symbol_folders, write_symbol_files


def _files_read(df) -> int:
    """Files of the scan after pruning (a plan of its own: metrics are sent once)."""
    df = df.select("*")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    total = 0
    for i in range(leaves.size()):
        m = leaves.apply(i).metrics()
        if m.contains("numFiles"):
            total += m.apply("numFiles").value()
    return total


@pytest.mark.parametrize("per_part", [7, 1_000_000])
def test_folds_with_very_wide_cut_times(spark, monkeypatch, per_part):
    monkeypatch.setattr(fo, "KEYS_PER_PART", per_part)
    rng = random.Random(1)
    rows = [(f"s{rng.randint(0, 10**6):06d}", t * 86_400_000) for t in range(3) for _ in range(200)]
    df = spark.createDataFrame(rows, "symbol string, open_time long").repartition(5)
    got = sorted((r["open_time"], r["symbol"], r["fold"]) for r in fo.walk_forward_folds(df, 4).collect())
    place = {}
    for i, (s, t) in enumerate(sorted(rows, key=lambda r: (r[1], r[0]))):
        place.setdefault((t, s), set()).add(i * 4 // len(rows))
    assert all(f in place[(t, s)] for t, s, f in got)
    counts = [sum(1 for r in got if r[2] == f) for f in range(4)]
    assert max(counts) - min(counts) <= 2      # repeated keys share a fold


def test_no_window_sees_all_symbols_of_a_time(spark, monkeypatch):
    """Every window over ties is partitioned by the block as well as by the time."""
    seen = []
    real = fo.Window.partitionBy
    monkeypatch.setattr(fo.Window, "partitionBy", staticmethod(lambda *c: (seen.append(c), real(*c))[1]))
    monkeypatch.setattr(fo, "KEYS_PER_PART", 10)
    df = spark.createDataFrame([(f"s{i:03d}", 0) for i in range(100)], "symbol string, open_time long")
    n, cuts = fo.rows_at_ranks(df, lambda n: [33, 66, 99, 100])
    assert n == 100 and cuts == [(0, "s033"), (0, "s066"), (0, "s099"), None]
    over_ties = [c for c in seen if c[0] in ("_t", "open_time")]
    assert over_ties and all("_block" in c for c in over_ties)


def test_fold_cuts_do_not_run_every_shuffle_partition_at_each_level(spark):
    """The counts per time are small: a level of the search takes a few tasks, however
    many shuffle partitions there are."""
    df = spark.createDataFrame([("a", t * 60_000) for t in range(300)], "symbol string, open_time long").repartition(2)
    sc, key = spark.sparkContext, "spark.sql.shuffle.partitions"
    was = spark.conf.get(key)
    spark.conf.set(key, "64")
    sc.setJobGroup("fold-cuts", "")
    try:
        n, cuts = fo.rows_at_ranks(df, lambda n: [100, 200])
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set(key, was)
    assert n == 300 and cuts == [(6_000_000, "a"), (12_000_000, "a")]
    status = sc.statusTracker()
    tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup("fold-cuts")
             for s in status.getJobInfo(j).stageIds if status.getStageInfo(s)]
    assert tasks and sum(t >= 64 for t in tasks) == 0


def _candles(spark, symbols):
    rows = [(s, t * 1_800_000, 1.0, 2.0, 0.5, 1.5, 1.0, 1, 0.5) for s in symbols for t in range(5)]
    return spark.createDataFrame(rows, CANDLE_SCHEMA)


def test_holdout_reads_its_own_folders_only(spark):
    symbols = [str(i) for i in range(20)]      # text: sorted as text, not as numbers
    path = scratch_path(spark, "t-folders")
    write_symbol_files(_candles(spark, symbols), path)
    files = read_symbol_folders(spark, path, CANDLE_SCHEMA)
    train, test = fo.holdout_files(files, 0.8)
    want = sorted(symbols)
    assert sorted({r["symbol"] for r in train.collect()}) == want[:16]
    assert sorted({r["symbol"] for r in test.collect()}) == want[16:]
    assert train.count() + test.count() == 100
    whole = _files_read(files)
    assert _files_read(test) == whole // 5 and _files_read(train) == whole - whole // 5
    assert "PartitionFilters: [isnotnull(symbol" in test._jdf.queryExecution().executedPlan().toString()
    some, few = fo.holdout_files(files, 0.8, 0.25)
    assert sorted({r["symbol"] for r in some.collect()}) == want[:4] and sorted({r["symbol"] for r in few.collect()}) == want[16:17]
    assert _files_read(some) + _files_read(few) == whole // 4
    for side in fo.holdout_files(files, 1.0):      # everything trains
        assert side.count() in (100, 0)
    none = fo.holdout_files(files.limit(0), 0.8)
    assert none[0].count() == none[1].count() == 0


def test_symbol_from_the_file_name_prunes_files(spark):
    path = scratch_path(spark, "t-names")
    for s in ("AAA", "BBB", "CCC", "DDD", "EEE"):
        _candles(spark, [s]).drop("symbol").coalesce(1).write.parquet(f"{path}/{s}.parquet")
    files = read_symbol_files(spark, f"{path}/*.parquet")
    train, test = fo.holdout_files(files, 0.8)
    assert {r["symbol"] for r in train.collect()} == {"AAA", "BBB", "CCC", "DDD"} and {r["symbol"] for r in test.collect()} == {"EEE"}
    assert _files_read(files) == 5 and _files_read(test) == 1 and _files_read(train) == 4


@pytest.mark.parametrize("per_part", [3, 1000])
def test_positions(spark, monkeypatch, per_part):
    rows = [(f"s{i % 7}", i // 7) for i in range(40)]
    df = spark.createDataFrame(rows, "symbol string, open_time long").repartition(6)
    ranked, n = fo.key_ranks(df, ["symbol", "open_time"], per_key=True, keys_per_part=per_part)
    assert n == 40
    assert [(r["symbol"], r["open_time"]) for r in sorted(ranked.collect(), key=lambda r: r["_rank"])] == sorted(rows)
    assert sorted(r["position"] for r in fo.positions(df, ["symbol", "open_time"]).collect()) == list(range(1, 41))


def test_bundle_of_odd_models(spark):
    """One class only, one score only, ties: every report is there, undefined values are NULL."""
    df = spark.createDataFrame([(1, 0.5, 0.9), (1, 0.5, 0.2), (1, 0.5, 0.7)], "label int, a double, b double")
    got = {(r["model"], r["report"], r["item"], r["item2"], r["metric"]): r["value"]
           for r in ev.evaluation_bundle(df, {"a": "a", "b": "b"}).collect()}
    assert got[("a", "auc", None, None, "auc")] is None and got[("a", "auc", None, None, "positives")] == 3
    assert got[("a", "rates", None, None, "up_recall")] == 0 and got[("b", "rates", None, None, "up_recall")] == pytest.approx(2 / 3)
    assert got[("a", "confident", 0.6, None, "accuracy")] is None and got[("b", "confident", 0.7, None, "count")] == 3
    assert got[("a", "summary", None, None, "stddev")] == 0 and got[("a", "bands", 2.0, None, "count")] == 3
    empty = ev.evaluation_bundle(df.limit(0), {"a": "a"}).collect()
    assert not [r for r in empty if r["value"]]


def test_auc_by_model_equals_pairs(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 1), rng.randint(0, 30) / 30, rng.random()) for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, a double, b double")
    got = {r["model"]: r["auc"] for r in ev.auc_exact(ev.by_model(df, {"a": "a", "b": "b"}), "p", ("model",)).collect()}
    for i, m in ((1, "a"), (2, "b")):
        up, down = [r[i] for r in rows if r[0]], [r[i] for r in rows if not r[0]]
        assert got[m] == pytest.approx(sum((x > y) + (x == y) / 2 for x in up for y in down) / (len(up) * len(down)))


def test_symbols_of_a_layout_are_sought_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "folders")
    spark.range(40).select(F.concat(F.lit("S"), F.col("id") % 10).alias("symbol"), "id").write.partitionBy("symbol").parquet(path)
    files = spark.read.parquet(path)
    plans, ranks = [], fo.key_ranks

    def spy(keys, *args, **kw):
        plans.append(keys._jdf.queryExecution().optimizedPlan().toString())
        return ranks(keys, *args, **kw)

    monkeypatch.setattr(fo, "key_ranks", spy)
    keys = fo.file_keys(files) if hasattr(fo, "file_keys") else None
    given = {"keys": keys} if keys is not None else {}
    train, test = fo.holdout_files(files, 0.8, **given)
    assert (train.count(), test.count()) == (32, 8)
    assert [x.count() for x in fo.holdout_files(files, 0.8)] == [32, 8]
    assert len(plans) == 2 and not any("parquet" in p for p in plans)      # ranked from the stored symbols
