"""Resampling and feature invariants, edge fixtures, plan shape."""

import math

import pytest
from pyspark.sql import functions as F

from barforge.operators.features import add_features, add_labels
from barforge.operators.resample import aggregate_candles, last_n_candles
from barforge.plans.catalog import event_candles
from barforge.schema import CANDLE_SCHEMA, FEATURES
from barforge.sources.tables import event_trades, table
from tests.conftest import MEDIUM, SMALL

HALF_HOUR = 1_800_000


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _candles(spark, rows):
    """rows: (symbol, i, open, high, low, close) -> candle table, 30 min apart."""
    data = [(s, 1_700_000_000_000 + i * HALF_HOUR, o, h, lo, c, 1.0, 1, 0.5)
            for s, i, o, h, lo, c in rows]
    return spark.createDataFrame(data, CANDLE_SCHEMA)


def _walk(symbol, n, start=100.0):
    out, p = [], start
    for i in range(n):
        q = p * (1 + 0.01 * math.sin(i * 1.7))
        out.append((symbol, i, p, max(p, q) + 0.5, min(p, q) - 0.5, q))
        p = q
    return out


def test_candle_invariants(spark):
    c = event_candles(spark, MEDIUM)
    bad = c.filter((F.col("low") > F.col("open")) | (F.col("low") > F.col("close"))
                   | (F.col("high") < F.col("open")) | (F.col("high") < F.col("close"))).count()
    assert bad == 0
    trades = event_trades(table(spark, MEDIUM, "events"))
    v1 = trades.agg(F.sum("volume")).first()[0]
    v2 = c.agg(F.sum("volume")).first()[0]
    assert abs(v1 - v2) < 1e-6 * abs(v1)
    assert c.agg(F.sum("number_of_trades")).first()[0] == trades.count()


def test_resample_layout_independent(spark):
    """Picks (open, close) are exact at any layout; sums agree to rounding."""
    trades = event_trades(table(spark, SMALL, "events"))
    exact = ["symbol", "open_time", "open", "high", "low", "close", "number_of_trades"]
    sums = ["volume", "taker_buy_quote_asset_volume"]
    base = aggregate_candles(trades, 30, order_col="trade_order")
    want = {tuple(r[:7]): r[7:] for r in base.select(*exact, *sums).collect()}
    for n in (1, 4, 32):
        got = aggregate_candles(trades.repartition(n), 30, order_col="trade_order").select(*exact, *sums)
        rows = got.collect()
        assert {tuple(r[:7]) for r in rows} == set(want)
        for r in rows:
            assert all(abs(a - b) < 1e-9 for a, b in zip(r[7:], want[tuple(r[:7])]))


def test_resample_is_hash_aggregate(spark):
    plan = event_candles(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_two_step_resample_equals_direct(spark):
    five = event_candles(spark, SMALL, minutes=5)
    direct = event_candles(spark, SMALL)
    two = aggregate_candles(five, 30)
    key = ["symbol", "open_time", "open", "high", "low", "close", "number_of_trades"]
    assert _rows(two.select(*key)) == _rows(direct.select(*key))


@pytest.mark.parametrize("chunk_ms", [2 * 3600_000, 5 * 3600_000 + 7, 3 * 86_400_000])
def test_features_independent_of_chunking(spark, chunk_ms):
    c = event_candles(spark, MEDIUM)
    assert _rows(add_features(c, chunk_ms=chunk_ms)) == _rows(add_features(c))


def test_labels_independent_of_chunking(spark):
    c = event_candles(spark, SMALL)
    assert _rows(add_labels(c, tail="zero", chunk_ms=3 * 3600_000)) == _rows(add_labels(c, tail="zero"))


@pytest.mark.parametrize("n,expected", [(1, 0), (20, 0), (21, 1), (22, 2), (40, 20)])
def test_warmup_rows(spark, n, expected):
    f = add_features(_candles(spark, _walk("A", n)), label=False)
    assert f.count() == expected


def test_tail_modes(spark):
    c = _candles(spark, _walk("A", 30))
    assert add_features(c, tail="drop").count() == 9
    zero = add_features(c, tail="zero")
    assert zero.count() == 10
    last = zero.orderBy(F.col("open_time").desc()).first()
    assert last["label"] == 0


def test_zero_close_gives_bb_zero_not_error(spark):
    rows = _walk("Z", 30)
    rows[22] = ("Z", 22, 1.0, 2.0, 0.0, 0.0)
    f = add_features(_candles(spark, rows), label=False)
    got = {r["open_time"]: r for r in f.collect()}
    t = 1_700_000_000_000
    for i in (24, 25, 26):  # the zero is close_lag2, lag3, lag4 (a divisor)
        assert got[t + i * HALF_HOUR]["bb_position"] == 0.0
    # momentum with a zero base is 0, never an error
    assert got[t + 27 * HALF_HOUR]["price_momentum"] == 0.0


def test_null_and_nan_prices_drop_rows(spark):
    rows = _walk("N", 45)
    rows[30] = ("N", 30, rows[30][2], rows[30][3], rows[30][4], None)
    rows[40] = ("N", 40, rows[40][2], rows[40][3], rows[40][4], float("nan"))
    f = add_features(_candles(spark, rows), label=False)
    times = {r["open_time"] for r in f.collect()}
    t = 1_700_000_000_000
    assert t + 30 * HALF_HOUR not in times and t + 40 * HALF_HOUR not in times
    assert t + 29 * HALF_HOUR in times
    # a NULL close is a lag for the next 20 candles; those rows drop too
    assert t + 31 * HALF_HOUR not in times


def test_no_lookahead(spark):
    """Removing future candles changes no feature of the remaining rows."""
    rows = _walk("A", 60) + _walk("B", 45, 50.0)
    full = {(r["symbol"], r["open_time"]): r for r in add_features(_candles(spark, rows), label=False).collect()}
    cut = [r for r in rows if r[1] < 35]
    part = add_features(_candles(spark, cut), label=False).collect()
    assert part
    for r in part:
        assert tuple(r) == tuple(full[(r["symbol"], r["open_time"])])


def test_flat_prices(spark):
    rows = [("F", i, 10.0, 10.0, 10.0, 10.0) for i in range(25)]
    f = add_features(_candles(spark, rows), label=False).collect()
    assert len(f) == 5
    assert all(r["bb_position"] == 0.0 and r["price_to_sma20"] == 0.0 and r["atr_10"] == 0.0 for r in f)


def test_feature_order():
    assert len(FEATURES) == 27 and len(set(FEATURES)) == 27


def test_last_n_group_limit_plan(spark):
    df = last_n_candles(event_candles(spark, SMALL), 21)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.groupBy("symbol").count().agg(F.max("count")).first()[0] == 21
    assert "WindowGroupLimit" in plan or "RankLimit" in plan


def test_require_contiguous(spark):
    rows = _walk("G", 50)
    rows = [r for r in rows if r[1] != 30]          # one missing candle
    loose = {r["open_time"] for r in add_features(_candles(spark, rows), label=False).collect()}
    strict = {r["open_time"] for r in add_features(_candles(spark, rows), label=False,
                                                   require_contiguous=True).collect()}
    t = 1_700_000_000_000
    gap_rows = {t + i * HALF_HOUR for i in range(31, 51)}
    assert loose - strict == gap_rows & loose and strict < loose


def test_halo_hot_key_exact_and_bounded(spark):
    """One symbol holds most rows; chunks are uneven (some empty, some shorter
    than the lookback). Lags equal the unsplit window; groups stay bounded."""
    from pyspark.sql import Window
    from barforge.operators.halo import HALO, with_halo
    import random
    rnd = random.Random(1)
    times = sorted(rnd.sample(range(0, 20_000), 3000))          # gaps of all sizes
    rows = [("HOT", t, float(i)) for i, t in enumerate(times)]
    rows += [(f"C{s}", t, float(t)) for s in range(3) for t in range(0, 20_000, 997)]
    df = spark.createDataFrame(rows, "symbol string, t long, v double")
    chunk = 150
    split = with_halo(df.withColumn("c", (F.col("t") / chunk).cast("long")), ["symbol"], "t", "c",
                      back=20, forward=1)
    w = Window.partitionBy("symbol", "c").orderBy("t")
    got = split.select("symbol", "t", HALO, *[F.lag("v", k).over(w).alias(f"l{k}") for k in (1, 7, 20)],
                       F.lead("v", 1).over(w).alias("n1")).filter(~F.col(HALO)).drop(HALO)
    wf = Window.partitionBy("symbol").orderBy("t")
    want = df.select("symbol", "t", *[F.lag("v", k).over(wf).alias(f"l{k}") for k in (1, 7, 20)],
                     F.lead("v", 1).over(wf).alias("n1"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    biggest = split.groupBy("symbol", "c").count().agg(F.max("count")).first()[0]
    assert biggest <= chunk + 21


def test_tiebreak_makes_shared_times_deterministic(spark):
    from barforge.schema import CANDLE_SCHEMA as S
    rows = [("T", 1_700_000_000_000, p, p, p, p, p, 1, 0.0) for p in (5.0, 7.0, 6.0)]
    df = spark.createDataFrame(rows, S).withColumn("seq", F.when(F.col("open") == 5.0, 3).when(F.col("open") == 7.0, 1).otherwise(2))
    for n in (1, 3):
        c = aggregate_candles(df.repartition(n), 30, tiebreak_col="seq").first()
        assert (c["open"], c["close"]) == (7.0, 5.0)
