"""Raw message parsing: accepted records, rejects, round trips."""

import json

from pyspark.sql import functions as F

from barforge.sources import raw
from barforge.sources.tables import read_symbol_files

# invented numbers
K = {"t": 1800000000000, "o": "101.25", "h": "104.5", "l": "99.75", "c": "103.0",
     "v": "12.5", "q": "1285.5", "n": 321, "V": "6.25", "Q": "640.75", "i": "30m", "x": True}


def _msgs(spark, items):
    return spark.createDataFrame([(m if isinstance(m, str) else json.dumps(m),) for m in items], "value string")


def test_exchange_events_accept_and_reject(spark):
    items = [
        {"data": {"s": "btcusdt", "k": K}},                       # envelope
        {"s": "ethusdt", "k": dict(K, t=K["t"] + 1)},             # bare
        {"s": "btcusdt", "k": dict(K, x=False)},                  # not closed
        {"data": {"s": "btcusdt"}},                               # no kline
        {"s": "btcusdt", "k": {kk: vv for kk, vv in K.items() if kk != "c"}},  # missing field
        {"s": "btcusdt", "k": dict(K, o="abc")},                  # non-numeric
        {"s": "btcusdt", "k": dict(K, i="5m")},                   # bad interval
        '{"s": "btcusdt", "k": {"t": 1',                          # malformed
    ]
    rec, rej = raw.parse_exchange_events(_msgs(spark, items), ingested_at=F.lit("2026-01-01T00:00:00+00:00"))
    got = rec.collect()
    assert {r["symbol"] for r in got} == {"BTCUSDT", "ETHUSDT"}
    r0 = [r for r in got if r["symbol"] == "BTCUSDT"][0]
    assert r0["open"] == 101.25 and r0["number_of_trades"] == 321 and r0["interval"] == "30m"
    assert r0["taker_buy_base_asset_volume"] == 6.25 and r0["volume"] == 12.5
    reasons = sorted(r["reason"] for r in rej.collect())
    assert reasons == sorted(["not_closed", "no_kline", "bad_field", "bad_field", "bad_interval", "malformed"])


def test_symbol_filter(spark):
    items = [{"s": "btcusdt", "k": K}, {"s": "dogeusdt", "k": K}]
    rec, rej = raw.parse_exchange_events(_msgs(spark, items), symbols=["BTCUSDT"])
    assert [r["symbol"] for r in rec.collect()] == ["BTCUSDT"]
    assert [r["reason"] for r in rej.collect()] == ["other_symbol"]


def test_kline_arrays(spark):
    resp = json.dumps([[1499040000000, "1.5", "2.0", "1.0", "1.8", "10", 1499040059999, "15", 7, "4", "6", "0"],
                       [1499040060000, "1.8"],
                       [1499040120000, "x", "2.0", "1.0", "1.8", "10", 1, "15", 7, "4", "6", "0"]])
    df = spark.createDataFrame([("BTCUSDT", "1m", resp), ("BTCUSDT", "1m", "oops")],
                               "symbol string, interval string, response string")
    rec, rej = raw.parse_kline_arrays(df)
    rows = rec.collect()
    assert len(rows) == 1 and rows[0]["open_time"] == 1499040000000 and rows[0]["number_of_trades"] == 7
    assert rows[0]["taker_buy_quote_asset_volume"] == 6.0 and rows[0]["quote_asset_volume"] == 15.0
    assert sorted(r["reason"] for r in rej.collect()) == ["bad_field", "bad_field", "malformed"]


def test_candle_record_round_trip(spark):
    from barforge.schema import STREAM_RECORD_SCHEMA
    rec = {"open_time": 1, "open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5, "volume": 3.0,
           "quote_asset_volume": 4.0, "number_of_trades": 5, "taker_buy_base_asset_volume": 1.0,
           "taker_buy_quote_asset_volume": 2.0, "symbol": "BTCUSDT", "interval": "30m",
           "ingested_at": "2027-01-15T18:25:00.000000+00:00"}
    df = spark.createDataFrame([rec], STREAM_RECORD_SCHEMA)
    published = df.select(F.to_json(F.struct("*")).alias("value"))        # publish (SRC-11)
    back, rej = raw.parse_candle_records(published.union(spark.createDataFrame([("{bad",)], "value string")))
    assert [r.asDict() for r in back.collect()] == [rec]
    assert rej.count() == 1


def test_bootstrap_json_array_file(spark, tmp_path):
    recs = [{"open_time": 1800000000000 + i * 1_800_000, "open": 1.0 + i, "high": 2.0 + i, "low": 0.5,
             "close": 1.5 + i, "volume": 3.0, "quote_asset_volume": 4.0, "number_of_trades": 5,
             "taker_buy_base_asset_volume": 1.0, "taker_buy_quote_asset_volume": 2.0,
             "symbol": "BTCUSDT", "interval": "30m", "ingested_at": "2027-01-15T18:25:00.000000+00:00"}
            for i in range(21)]
    p = tmp_path / "boot.json"
    p.write_text(json.dumps(recs, indent=2))
    from barforge.schema import STREAM_RECORD_SCHEMA
    df = spark.read.schema(STREAM_RECORD_SCHEMA).option("multiLine", True).json(str(p))
    assert df.count() == 21
    # the last candle was stamped before it closed: the closed filter drops it
    assert raw.closed_only(df).count() == 20


def test_latest_closed_keeps_newest_version(spark):
    from barforge.schema import STREAM_RECORD_SCHEMA
    base = dict(open_time=0, open=1.0, high=2.0, low=0.5, close=1.5, volume=3.0, quote_asset_volume=4.0,
                number_of_trades=5, taker_buy_base_asset_volume=1.0, taker_buy_quote_asset_volume=2.0,
                symbol="BTCUSDT", interval="30m")
    rows = [dict(base, close=1.1, ingested_at="1970-01-01T00:10:00.000000+00:00"),   # unclosed
            dict(base, close=1.2, ingested_at="1970-01-01T00:30:05.000000+00:00"),
            dict(base, close=1.3, ingested_at="1970-01-01T00:45:00.000000+00:00")]
    out = raw.latest_closed(spark.createDataFrame(rows, STREAM_RECORD_SCHEMA)).collect()
    assert len(out) == 1 and out[0]["close"] == 1.3


def test_merge_keeps_intervals_apart_and_rejects_with_a_reason(spark):
    from barforge.schema import STREAM_RECORD_SCHEMA
    base = dict(open_time=0, open=1.0, high=2.0, low=0.5, close=1.5, volume=3.0, quote_asset_volume=4.0,
                number_of_trades=5, taker_buy_base_asset_volume=1.0, taker_buy_quote_asset_volume=2.0,
                symbol="X", interval="30m", ingested_at="1970-01-01T01:00:00.000000+00:00")
    rows = [base, dict(base, interval="1m", close=1.1), dict(base, interval=None, close=1.05),
            dict(base, close=0.9, volume=9.0), dict(base, interval="5m"), dict(base, symbol=None), dict(base, open_time=None),
            dict(base, ingested_at=None), dict(base, open_time=1_800_000 * 5)]
    df = spark.createDataFrame(rows, STREAM_RECORD_SCHEMA)
    out = {r["interval"]: (r["close"], r["volume"]) for r in raw.latest_closed(df).collect()}
    # equal stamps: one whole version, the one with the larger values
    assert out == {"30m": (1.5, 3.0), "1m": (1.1, 3.0)}
    kept, rejects = raw.split_closed(df)
    assert kept.count() + rejects.count() == len(rows)
    assert sorted(r["reason"] for r in rejects.collect()) == ["bad_interval", "no_key", "no_key", "no_stamp", "not_closed"]


def test_events_are_parsed_once(spark):
    from event_fixtures import exchange_messages
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    messages = exchange_messages(events)
    tagged = raw.tag_exchange_events(messages)
    for df in (tagged, *raw.split_tagged(tagged)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1, plan.count("from_json")
    good, bad = raw.split_tagged(tagged)
    assert good.count() + bad.count() == events.count()
    assert raw.parse_candle_records(spark.createDataFrame([('{"open_time": 1}',), ("x",)], "value string"))[1].count() == 2


def test_route_default_interval(spark):
    from barforge.schema import STREAM_RECORD_SCHEMA
    base = dict(open=1.0, high=2.0, low=0.5, close=1.5, volume=3.0, quote_asset_volume=4.0,
                number_of_trades=1, taker_buy_base_asset_volume=1.0, taker_buy_quote_asset_volume=2.0,
                symbol="X", ingested_at=None)
    rows = [dict(base, open_time=i * 60_000, interval=None if i % 2 else "1m", close=float(i)) for i in range(30)]
    rows.append(dict(base, open_time=1_800_000, interval="30m"))
    out = {r["open_time"]: r for r in raw.route_intervals(spark.createDataFrame(rows, STREAM_RECORD_SCHEMA)).collect()}
    assert out[0]["number_of_trades"] == 30 and out[0]["close"] == 29.0 and out[0]["source_interval"] == "1m"
    assert out[1_800_000]["source_interval"] == "30m"


def test_symbol_from_file_name(spark, tmp_path):
    for s in ("BTCUSDT", "ETHUSDT"):
        spark.range(3).withColumn("close", F.col("id") * 1.0).coalesce(1).write.parquet(str(tmp_path / s) + ".parquet")
    df = read_symbol_files(spark, [str(tmp_path / "BTCUSDT.parquet"), str(tmp_path / "ETHUSDT.parquet")])
    assert sorted({r["symbol"] for r in df.collect()}) == ["BTCUSDT", "ETHUSDT"]


def test_bus_round_trip_and_bootstrap(spark, tmp_path):
    from barforge.schema import STREAM_RECORD_SCHEMA
    from barforge.sources import bus
    rec = dict(open_time=1, open=1.0, high=2.0, low=0.5, close=1.5, volume=3.0, quote_asset_volume=4.0,
               number_of_trades=5, taker_buy_base_asset_volume=1.0, taker_buy_quote_asset_volume=2.0,
               symbol="BTCUSDT", interval="30m", ingested_at="2027-01-15T18:25:00.000000+00:00")
    df = spark.createDataFrame([rec, dict(rec, open_time=2)], STREAM_RECORD_SCHEMA)
    bus.publish(df, fmt="text", path=str(tmp_path / "topic"))               # a file topic
    msgs = bus.read_bus(spark, fmt="text", path=str(tmp_path / "topic"), stream=False)
    back, rej = raw.parse_candle_records(msgs)
    assert sorted(r["open_time"] for r in back.collect()) == [1, 2] and rej.count() == 0
    bus.save_bootstrap_json(df, str(tmp_path / "boot"))
    assert bus.read_bootstrap_json(spark, str(tmp_path / "boot")).count() == 2


def test_seed_feed_keeps_last_window(spark, tmp_path):
    from barforge.plans.catalog import event_candles
    from barforge.sources import bus
    from tests.conftest import SMALL
    candles = event_candles(spark, SMALL)
    bus.seed_feed(candles, str(tmp_path / "feed"), 21)
    seeded = spark.read.parquet(str(tmp_path / "feed"))
    per = seeded.groupBy("symbol").count().collect()
    assert per and all(r["count"] == 21 for r in per)


def test_seed_feed_leaves_the_unclosed_candle_out(spark, tmp_path):
    from event_fixtures import candle_records
    from barforge.plans.catalog import event_candles
    from barforge.sources import bus
    from tests.conftest import SMALL
    candles = event_candles(spark, SMALL)
    records = candle_records(candles, "30m")
    newest = records.agg(F.max("open_time")).first()[0]
    early = records.withColumn("ingested_at", F.when(F.col("open_time") == newest, F.lit("1970-01-01T00:00:00.000000+00:00")).otherwise(F.col("ingested_at")))
    bus.seed_feed(early, str(tmp_path / "feed"), 21)
    assert spark.read.parquet(str(tmp_path / "feed")).where(F.col("open_time") == newest).count() == 0
