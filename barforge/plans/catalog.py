"""The registered queries: name -> (Spark DataFrame builder, DuckDB SQL twin).

Each builder takes ``(spark, sf_dir)`` and reads the given tables. Computed
columns carry the same names as in the SQL twin; doubles are rounded to 6
places in both (engines sum in different orders).
"""

from __future__ import annotations

import os
from collections.abc import Callable

import event_fixtures as rp
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barforge.functions import signals as sg
from barforge.operators import evaluate as ev
from barforge.operators import folds as fo
from barforge.operators import outcomes as oc
from barforge.operators.features import add_features, add_labels, feature_names
from barforge.functions.time import bucket_ms, epoch_micros
from barforge.operators.resample import aggregate_candles, last_n_candles
from barforge.plans import oracle as sql
from barforge.plans import stack as st
from barforge.plans import training as tr
from barforge.schema import CANDLE_SCHEMA, FEATURES
from barforge.session import cut_lineage, scratch_path
from barforge.sources import bus
from barforge.sources import raw as rw
from barforge.sources.tables import (event_trades, lineitem_trades, read_symbol_files, read_symbol_folders,
                                     table, write_symbol_files)
from barforge.streaming import live as lv
from barforge.streaming import tables as tb
from barforge.streaming.job import closed_records, rejects, start_job, start_messages
from barforge.streaming.resample import stream_candles

PLACES = 6

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def rounded(df: DataFrame, places: int = PLACES) -> DataFrame:
    """Round every double column (comparison form)."""
    return df.select(*[F.round(F.col(f.name), places).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


# ---- shared inputs -----------------------------------------------------------

def event_candles(spark: SparkSession, sf_dir: str, minutes: int = 30) -> DataFrame:
    """Candles from the ``events`` trades (symbol = event_type)."""
    return aggregate_candles(event_trades(table(spark, sf_dir, "events")), minutes,
                             order_col="trade_order")


def event_features(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return add_features(event_candles(spark, sf_dir), **kw)


# ---- candles -------------------------------------------------------------------

@register("candles_30m", sql.q_candles_30m())
def candles_30m(spark, sf_dir):
    return rounded(event_candles(spark, sf_dir))


@register("candles_5m_to_30m", sql.q_candles_5m_to_30m())
def candles_5m_to_30m(spark, sf_dir):
    five = event_candles(spark, sf_dir, minutes=5)
    return rounded(aggregate_candles(five, 30))


@register("last_n_candles", sql.q_last_n_candles(21))
def last_n(spark, sf_dir):
    return rounded(last_n_candles(event_candles(spark, sf_dir), 21))


# ---- features --------------------------------------------------------------

def _all_features(spark, sf_dir) -> DataFrame:
    return event_features(spark, sf_dir, keep="all", complete=False, tail="zero")


@register("lag_features", sql.q_lag_features())
def lag_features(spark, sf_dir):
    lags = [c for c in feature_names() if "_lag" in c]
    return rounded(_all_features(spark, sf_dir).select("symbol", "open_time", *lags))


@register("labels_next_candle", sql.q_labels_next_candle("drop"))
def labels_next_candle(spark, sf_dir):
    return rounded(add_labels(event_candles(spark, sf_dir), tail="drop"))


@register("labels_next_candle_zero_tail", sql.q_labels_next_candle("zero"))
def labels_next_candle_zero(spark, sf_dir):
    return rounded(add_labels(event_candles(spark, sf_dir), tail="zero"))


def _some(cols):
    def build(spark, sf_dir):
        return rounded(_all_features(spark, sf_dir).select("symbol", "open_time", *cols))
    return build


register("candle_shape", sql.q_candle_shape())(
    _some(["body", "range", "upper_wick", "lower_wick"]))
register("sma_ratios", sql.q_sma_ratios())(
    _some(["sma_5", "sma_10", "sma_20", "price_to_sma5", "price_to_sma10", "price_to_sma20"]))
register("momentum_volatility", sql.q_momentum_volatility())(
    _some(["price_momentum", "volatility"]))
register("bb_position", sql.q_bb_position())(_some(["sma_20", "volatility", "bb_position"]))
register("atr_10", sql.q_atr_10())(_some(["true_range", "atr_10"]))


@register("feature_matrix", sql.q_feature_matrix("drop"))
def feature_matrix(spark, sf_dir):
    return rounded(event_features(spark, sf_dir, tail="drop"))


@register("feature_matrix_zero_tail", sql.q_feature_matrix("zero"))
def feature_matrix_zero_tail(spark, sf_dir):
    return rounded(event_features(spark, sf_dir, tail="zero"))


# ---- splits, folds, balance -------------------------------------------------


def _fm(spark, sf_dir) -> DataFrame:
    return event_features(spark, sf_dir, tail="drop").select("symbol", "open_time", "close", "label")


def _stored_fm(spark, sf_dir) -> DataFrame:
    """The feature rows written once to the shared checkpoint folder, for the
    operators that read their input several times (fold cuts, counts)."""
    return cut_lineage(_fm(spark, sf_dir))


@register("walk_forward_folds", sql.q_walk_forward_folds(3))
def walk_forward_folds(spark, sf_dir):
    return fo.walk_forward_folds(_stored_fm(spark, sf_dir), 3).select("symbol", "open_time", "label", "fold")


@register("fold_summary", sql.q_fold_summary(3))
def fold_summary(spark, sf_dir):
    return fo.fold_summary(fo.walk_forward_folds(_stored_fm(spark, sf_dir), 3))


@register("holdout_by_time", sql.q_holdout_by_time(0.8))
def holdout_by_time(spark, sf_dir):
    return fo.holdout_by_time(_stored_fm(spark, sf_dir), 0.8).select("symbol", "open_time", "label", "split")


def _lineitem_daily(spark, sf_dir) -> DataFrame:
    return aggregate_candles(lineitem_trades(table(spark, sf_dir, "lineitem")), 1440,
                             order_col="trade_order")


def _lineitem_days(spark, sf_dir) -> DataFrame:
    """(symbol, day) pairs with a trade: the key of a daily candle, from two columns."""
    t = lineitem_trades(table(spark, sf_dir, "lineitem"))
    return t.select("symbol", bucket_ms(epoch_micros(t, "open_time"), 86_400_000).alias("open_time")).distinct()


@register("holdout_by_symbol", sql.q_holdout_by_symbol())
def holdout_by_symbol(spark, sf_dir):
    counts = _lineitem_days(spark, sf_dir).groupBy("symbol").agg(F.count(F.lit(1)).alias("n_candles"))
    return fo.symbol_ranks(counts, 0.8, per_symbol=True).select("symbol", "split", "n_candles")


@register("sample_symbols", sql.q_sample_symbols(0.2))
def sample_symbols(spark, sf_dir):
    ranks = fo.symbol_ranks(_lineitem_days(spark, sf_dir), 0.8)
    return fo.sample_symbols(ranks, 0.2).select("symbol", "split", "split_rank")


@register("holdout_rows_by_symbol", sql.q_holdout_rows_by_symbol())
def holdout_rows_by_symbol(spark, sf_dir):
    """The daily candles themselves, split by symbol."""
    ranks = fo.symbol_ranks(_lineitem_days(spark, sf_dir), 0.8)
    return rounded(_lineitem_daily(spark, sf_dir).join(ranks.select("symbol", "split"), "symbol").select(
        "symbol", "open_time", "number_of_trades", "split"))


@register("sample_rows", sql.q_sample_rows(0.2))
def sample_rows(spark, sf_dir):
    """The daily candles of the leading fifth of the symbols of each split: a semi
    join, and the candles of other symbols are never aggregated."""
    ranks = fo.sample_symbols(fo.symbol_ranks(_lineitem_days(spark, sf_dir), 0.8), 0.2)
    trades = lineitem_trades(table(spark, sf_dir, "lineitem")).join(ranks.select("symbol"), "symbol", "left_semi")
    return rounded(aggregate_candles(trades, 1440, order_col="trade_order").select(
        "symbol", "open_time", "number_of_trades"))


@register("holdout_symbol_files", sql.q_holdout_symbol_files(0.2))
def holdout_symbol_files(spark, sf_dir):
    """Daily candles of each supplier's parts laid out by symbol (one folder each); both
    sides of the holdout and the leading fifth of each are scans that list their own
    folders only."""
    lines = table(spark, sf_dir, "lineitem").withColumn("l_partkey", F.col("l_suppkey"))
    path = scratch_path(spark, "symbol-folders")
    write_symbol_files(aggregate_candles(lineitem_trades(lines), 1440, order_col="trade_order"), path)
    files = read_symbol_folders(spark, path, CANDLE_SCHEMA)
    keys = fo.file_keys(files)
    sides = [side.withColumn("split", F.lit(name)).withColumn("part", F.lit(part))
             for part, share in (("all", 1.0), ("sample", 0.2))
             for name, side in zip(("train", "test"), fo.holdout_files(files, 0.8, share, keys=keys))]
    out = sides[0]
    for s in sides[1:]:
        out = out.unionByName(s)
    return out.select("part", "split", "symbol", "open_time", "number_of_trades")


@register("symbol_from_file_name", sql.q_symbol_from_file_name())
def symbol_from_file_name(spark, sf_dir):
    """One SYMBOL.parquet a symbol, without a symbol column; the name gives it back, and
    a comparison with it leaves out the other files."""
    candles = cut_lineage(event_candles(spark, sf_dir))
    path = scratch_path(spark, "symbol-files")
    for (symbol,) in candles.select("symbol").distinct().collect():      # the five event types
        candles.filter(F.col("symbol") == symbol).drop("symbol").write.parquet(f"{path}/{symbol}.parquet")
    files = read_symbol_files(spark, f"{path}/*.parquet")
    train, test = fo.holdout_files(files, 0.8)
    return rounded(train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test"))).select(
        "symbol", "open_time", "close", "split"))


@register("ordered_candles", sql.q_ordered_candles())
def ordered_candles(spark, sf_dir):
    """Every candle with its place in the order of symbol and time (SRT-1)."""
    return rounded(fo.positions(cut_lineage(event_candles(spark, sf_dir)), ["symbol", "open_time"]).select(
        "symbol", "open_time", "close", "position"))


@register("walk_forward_folds_daily", sql.q_walk_forward_folds_daily(3))
def walk_forward_folds_daily(spark, sf_dir):
    """Folds over daily candles of all parts: very many symbols share each cut time."""
    days = cut_lineage(_lineitem_days(spark, sf_dir))
    return fo.walk_forward_folds(days, 3).select("symbol", "open_time", "fold")


@register("class_balance", sql.q_class_balance())
def class_balance(spark, sf_dir):
    return rounded(fo.class_balance(_fm(spark, sf_dir)))


@register("class_weights", sql.q_class_weights(1.0))
def class_weights(spark, sf_dir):
    return rounded(fo.class_weights(_fm(spark, sf_dir), 1.0))


@register("undersample_majority", sql.q_undersample_majority(42))
def undersample_majority(spark, sf_dir):
    return fo.undersample_majority(_stored_fm(spark, sf_dir), 42).select("symbol", "open_time", "label")


# ---- ingest ------------------------------------------------------------------


_RECORD_OUT = ["open_time", "open", "high", "low", "close", "volume", "quote_asset_volume",
               "number_of_trades", "taker_buy_base_asset_volume", "taker_buy_quote_asset_volume",
               "symbol", "interval"]


@register("parse_events", sql.q_parse_events())
def parse_events(spark, sf_dir):
    records, _ = rw.parse_exchange_events(rp.exchange_messages(table(spark, sf_dir, "events")))
    return rounded(records.select(*_RECORD_OUT))


@register("parse_rejects", sql.q_parse_rejects())
def parse_rejects(spark, sf_dir):
    _, rejects = rw.parse_exchange_events(rp.exchange_messages(table(spark, sf_dir, "events")))
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register("parse_kline_arrays", sql.q_parse_kline_arrays())
def parse_kline_arrays(spark, sf_dir):
    records, _ = rw.parse_kline_arrays(rp.kline_responses(table(spark, sf_dir, "events")))
    return rounded(records.select(*_RECORD_OUT))


@register("route_intervals", sql.q_route_intervals())
def route_intervals(spark, sf_dir):
    one_minute = event_candles(spark, sf_dir, minutes=1)
    half_hour = event_candles(spark, sf_dir, minutes=30)
    records = (rp.candle_records(one_minute.filter(F.col("symbol") != "view"), "1m")
               .unionByName(rp.candle_records(half_hour.filter(F.col("symbol") == "view"), "30m")))
    return rounded(rw.route_intervals(records, 30))


@register("latest_closed", sql.q_latest_closed())
def latest_closed(spark, sf_dir):
    half_hour = rp.candle_versions(event_candles(spark, sf_dir), "30m")
    minute = rp.candle_versions(event_candles(spark, sf_dir, minutes=1), "1m")
    minute = minute.withColumn("interval", F.when(F.col("symbol") != "view", F.col("interval")))
    return rounded(rw.latest_closed(half_hour.unionByName(minute)))


@register("bus_round_trip", sql.q_bus_round_trip())
def bus_round_trip(spark, sf_dir):
    """Records published to the bus as messages, read back, parsed, backed up as JSON
    lines and read again (SRC-6, SRC-10, SRC-11): the records, and none rejected."""
    path = scratch_path(spark, "bus")
    records = rp.candle_records(event_candles(spark, sf_dir, minutes=1), "1m")
    bus.publish(records, "text", path=f"{path}/topic")
    back, rejects = rw.parse_candle_records(bus.read_bus(spark, "text", path=f"{path}/topic", stream=False))
    bus.save_bootstrap_json(back, f"{path}/backup")
    again = bus.read_bootstrap_json(spark, f"{path}/backup")
    lost = rejects.agg(F.count(F.lit(1)).alias("rejected"))      # one row
    return rounded(again.crossJoin(F.broadcast(lost)))


@register("parse_candle_records", sql.q_parse_candle_records())
def parse_candle_records(spark, sf_dir):
    """The bus record: one-minute candles as JSON text and back."""
    records = rp.candle_records(event_candles(spark, sf_dir, minutes=1), "1m")
    text = records.select(F.to_json(F.struct(*records.columns)).alias("value"))
    return rounded(rw.parse_candle_records(text)[0])


# ---- scores, signals, evaluation -------------------------------------------


def momentum_score(momentum):
    """Transparent stand-in score for checking the reports against SQL:
    x = 20 * price_momentum, p = 0.5 + 0.5 * x / (1 + |x|)."""
    x = F.lit(20.0) * momentum
    return F.lit(0.5) + F.lit(0.5) * x / (F.lit(1.0) + F.abs(x))


def _preds(spark, sf_dir, labelled: bool = True) -> DataFrame:
    feats = event_features(spark, sf_dir, label=labelled, tail="drop")
    p = momentum_score(F.col("price_momentum"))
    return feats.select("symbol", "open_time", "close", "label", p.alias("prob_up")).withColumn(
        "prediction", sg.predicted_class(F.col("prob_up")))


@register("trading_signals", sql.q_trading_signals())
def trading_signals(spark, sf_dir):
    p = _preds(spark, sf_dir, labelled=False)
    return rounded(p.select("symbol", "open_time", "prob_up", "prediction",
                            sg.signal(F.col("prob_up"), F.col("prediction")).alias("signal"),
                            sg.confidence(F.col("prob_up")).alias("confidence")))


@register("confusion", sql.q_confusion())
def confusion(spark, sf_dir):
    return ev.confusion(_preds(spark, sf_dir))


@register("class_recall", sql.q_class_recall())
def class_recall(spark, sf_dir):
    return rounded(ev.class_recall(_preds(spark, sf_dir)))


@register("accuracy_f1", sql.q_accuracy_f1())
def accuracy_f1(spark, sf_dir):
    return rounded(ev.accuracy_f1(_preds(spark, sf_dir)))


@register("auc_exact", sql.q_auc_exact())
def auc_exact(spark, sf_dir):
    return rounded(ev.auc_exact(cut_lineage(_preds(spark, sf_dir))))


@register("calibration_table", sql.q_calibration_table())
def calibration_table(spark, sf_dir):
    return rounded(ev.calibration_table(_preds(spark, sf_dir)))


@register("calibration_error", sql.q_calibration_error())
def calibration_error(spark, sf_dir):
    return rounded(ev.calibration_error(_preds(spark, sf_dir)))


@register("probability_summary", sql.q_probability_summary())
def probability_summary(spark, sf_dir):
    return rounded(ev.probability_summary(_preds(spark, sf_dir)))


@register("confidence_bands", sql.q_confidence_bands())
def confidence_bands(spark, sf_dir):
    return ev.confidence_bands(_preds(spark, sf_dir))


def _scored_by_four(spark, sf_dir) -> DataFrame:
    """Four transparent scores of the same rows, stored, as four models' output."""
    feats = event_features(spark, sf_dir, tail="drop")
    p = {m: momentum_score(F.col(c) * w) for m, (c, w) in sql.FOUR_SCORES.items()}
    return cut_lineage(feats.select("symbol", "open_time", "label", *[c.alias(f"p_{m}") for m, c in p.items()]))


@register("evaluation_bundle", sql.q_evaluation_bundle())
def evaluation_bundle(spark, sf_dir):
    """Every report for four scores at once (ML-10)."""
    return rounded(ev.evaluation_bundle(_scored_by_four(spark, sf_dir), {m: f"p_{m}" for m in sql.FOUR_SCORES}))


@register("ordered_reports", sql.q_ordered_reports())
def ordered_reports(spark, sf_dir):
    """The calibration, band and fold reports with their rows' places (SRT-2); a report
    has at most 21 rows."""
    preds = cut_lineage(_preds(spark, sf_dir))
    folds = fo.fold_summary(fo.walk_forward_folds(preds, 3))
    reports = {"calibration": (ev.calibration_table(preds), "prob_bin"), "bands": (ev.confidence_bands(preds), "band"),
               "folds": (folds, "fold"), "classes": (ev.confusion(preds).groupBy("label").agg(F.sum("count").alias("count")), "label")}
    out = None
    for name, (report, order) in reports.items():
        one = report.select(F.lit(name).alias("report"), F.row_number().over(Window.orderBy(order)).alias("position"),
                            F.col(order).cast("double").alias("item"), F.col("count").cast("long").alias("count"))
        out = one if out is None else out.unionByName(one)
    return rounded(out)


@register("confident_subset", sql.q_confident_subset())
def confident_subset(spark, sf_dir):
    return rounded(ev.confident_subset(_preds(spark, sf_dir)))


def _log(spark, sf_dir) -> DataFrame:
    preds = _preds(spark, sf_dir, labelled=False).withColumnRenamed("prob_up", "final_prob")
    outcomes = oc.outcomes_from_candles(event_candles(spark, sf_dir))
    return oc.prediction_log(preds, outcomes)


@register("prediction_outcomes", sql.q_prediction_outcomes())
def prediction_outcomes(spark, sf_dir):
    return rounded(_log(spark, sf_dir))


@register("live_hit_rate", sql.q_live_hit_rate())
def live_hit_rate(spark, sf_dir):
    return rounded(oc.hit_rate(_log(spark, sf_dir)))


# ---- stacked model (rows-only checks: MLlib training has no SQL twin) --------


_TRAINED: dict = {}


def _trained(spark, sf_dir, split: str):
    """Train once per session, data folder and split; reused by the queries."""
    key = (spark.sparkContext.applicationId, sf_dir, split)
    if key not in _TRAINED:
        # stored: fold cuts, training and every later scoring read it
        feats = cut_lineage(event_features(spark, sf_dir, tail="drop"))
        if split == "holdout":
            feats = fo.holdout_by_time(feats, 0.8)
            train = feats.filter(F.col("split") == "train").drop("split")
            test = feats.filter(F.col("split") == "test").drop("split")
        else:
            train, test = feats, None
        _TRAINED[key] = (tr.train_stack(train, k=3), test)
    return _TRAINED[key]


@register("stack_oof")
def stack_oof(spark, sf_dir):
    result, _ = _trained(spark, sf_dir, "holdout")
    return result.oof.select("symbol", "open_time", "label", "weight", "fold",
                             "rf_prob", "gbt_prob", "lr_prob")


@register("stack_scores")
def stack_scores(spark, sf_dir):
    result, test = _trained(spark, sf_dir, "holdout")
    scored = st.score(result.model, test, keep=("close", "label"))
    return scored.select("*", sg.signal(F.col("prob_up"), F.col("prediction")).alias("signal"),
                         sg.confidence(F.col("prob_up")).alias("confidence"))


@register("feature_importance")
def feature_importance(spark, sf_dir):
    result, _ = _trained(spark, sf_dir, "holdout")
    return tr.feature_importance(result.base, spark)


@register("stack_evaluation")
def stack_evaluation(spark, sf_dir):
    """The evaluation bundle on the stacked model's holdout predictions."""
    preds = cut_lineage(stack_scores(spark, sf_dir))
    acc = ev.accuracy_f1(preds)
    rec = ev.class_recall(preds)
    auc = ev.auc_exact(preds)
    cal = ev.calibration_error(preds)
    rows = [acc.select(F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value")),
            acc.select(F.lit("f1").alias("metric"), F.col("f1").alias("value")),
            rec.select(F.lit("up_recall").alias("metric"), F.col("up_recall").alias("value")),
            rec.select(F.lit("down_recall").alias("metric"), F.col("down_recall").alias("value")),
            auc.select(F.lit("auc").alias("metric"), F.col("auc").alias("value")),
            cal.select(F.lit("calibration_error").alias("metric"),
                       F.col("mean_abs_calibration_error").alias("value"))]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


MODELS = {"rf": "rf_prob", "gbt": "gbt_prob", "lr": "lr_prob", "stack": "prob_up"}


@register("stack_evaluation_bundle")
def stack_evaluation_bundle(spark, sf_dir):
    """Every report (AGG-5..14), AUC included, for the three base models and the stack on
    the holdout's predictions."""
    return ev.evaluation_bundle(cut_lineage(stack_scores(spark, sf_dir)), MODELS)


def exact_auc_by_mllib(df: DataFrame, score: str) -> float:
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    return BinaryClassificationEvaluator(rawPredictionCol=score, labelCol="label", numBins=0).evaluate(
        df.select(score, F.col("label").cast("double").alias("label")))


@register("stack_evaluation_bundle_check", sql.q_stack_evaluation_bundle_check())
def stack_evaluation_bundle_check(spark, sf_dir):
    """Each model's reports equal the single reports of its own predictions, its counts the
    number of holdout rows, and its AUC MLlib's curve without binning."""
    preds = cut_lineage(stack_scores(spark, sf_dir))
    bundle = cut_lineage(ev.evaluation_bundle(preds, MODELS))
    n = preds.count()
    again = None
    for model, column in MODELS.items():
        own = preds.select("label", F.col(column).alias("prob_up"), (F.col(column) > 0.5).cast("int").alias("prediction"))
        reports = [
            ("confusion", ev.confusion(own), "label", "prediction"),
            ("rates", ev.class_recall(own).join(F.broadcast(ev.accuracy_f1(own))), None, None),      # one row each
            ("auc", spark.range(1).select(F.lit(exact_auc_by_mllib(own, "prob_up")).alias("auc")), None, None),
            ("calibration", ev.calibration_table(own), "prob_bin", None), ("calibration_error", ev.calibration_error(own), None, None),
            ("summary", ev.probability_summary(own), None, None),
            ("bands", ev.confidence_bands(own).drop("confidence_range"), "band", None),
            ("confident", ev.confident_subset(own), "threshold", None)]
        for name, df, item, item2 in reports:
            values = [c for c in df.columns if c not in (item, item2)]
            no = F.lit(None).cast("double")
            tall = df.select(F.lit(model).alias("model"), F.lit(name).alias("report"),
                             (F.col(item).cast("double") if item else no).alias("item"), (F.col(item2).cast("double") if item2 else no).alias("item2"),
                             F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("again")) for c in values])))
            again = tall if again is None else again.unionByName(tall)
    sides = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("model", "report", "item", "item2", "metric")]
    both = bundle.filter("metric NOT IN ('positives', 'negatives')").alias("a").join(again.alias("b"), sides, "full")
    counted = bundle.filter("report = 'confusion'").groupBy("model").agg((F.sum("value") == F.lit(float(n))).alias("complete"))
    name = {c: F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in ("model", "report")}
    equal = both.groupBy(*name.values()).agg(F.bool_and(_near(F.col("value"), F.col("again"))).alias("equal"))
    return equal.join(F.broadcast(counted), "model").select("model", "report", "equal", "complete")      # a row a model


def _near(a, b, places: float = 1e-9):
    return F.coalesce(F.abs(a - b) < places, a.isNull() & b.isNull())


@register("stack_oof_check", sql.q_stack_oof_check(3))
def stack_oof_check(spark, sf_dir):
    """Keys, labels, weights and folds of the out-of-fold rows; every probability in [0, 1]."""
    inside = F.lit(True)
    for c in ("rf_prob", "gbt_prob", "lr_prob"):
        inside = inside & F.col(c).between(0.0, 1.0)
    return rounded(stack_oof(spark, sf_dir).select("symbol", "open_time", "label", "weight", "fold", inside.alias("in_range")))


@register("stack_scores_check", sql.q_stack_scores_check())
def stack_scores_check(spark, sf_dir):
    """Holdout keys; the stacked probability equals the meta model's sigmoid of the
    three base probabilities, and prediction, signal and confidence follow from it."""
    result, _ = _trained(spark, sf_dir, "holdout")
    meta = result.model.stages[-1]
    w, b = [float(x) for x in meta.coefficients.toArray()], float(meta.intercept)
    z = F.lit(b)
    for c, x in zip(("rf_prob", "gbt_prob", "lr_prob"), w):
        z = z + F.lit(x) * F.col(c)
    p = F.col("prob_up")
    ok = (_near(p, 1 / (1 + F.exp(-z))) & (F.col("prediction") == (p > 0.5).cast("int"))
          & (F.col("signal") == F.expr("CASE WHEN prob_up > 0.4 AND prob_up < 0.6 THEN 'WAIT' WHEN prob_up > 0.5 THEN 'BUY (Long)' ELSE 'SELL (Short)' END"))
          & (F.col("confidence") == F.expr("CASE WHEN prob_up >= 0.7 OR prob_up <= 0.3 THEN 'VERY HIGH' "
                                           "WHEN prob_up >= 0.6 OR prob_up <= 0.4 THEN 'HIGH' ELSE 'Low' END")))
    return rounded(stack_scores(spark, sf_dir).select("symbol", "open_time", "close", "label", ok.alias("consistent")))


@register("feature_importance_check", sql.q_feature_importance_check())
def feature_importance_check(spark, sf_dir):
    """The 27 inputs, each ranked 1 to 27 by either model, importances summing to one."""
    imp = feature_importance(spark, sf_dir)
    sums = imp.agg(F.sum("rf_importance").alias("rf"), F.sum("gbt_importance").alias("gbt"),
                   *[F.count_distinct(f"{m}_rank").alias(f"{m}_n") for m in ("rf", "gbt", "avg")])
    ranked = F.lit(True)
    for m in ("rf", "gbt", "avg"):
        ranked = ranked & F.col(f"{m}_rank").between(1, len(FEATURES)) & (F.col(f"{m}_n") == len(FEATURES))
    return imp.join(F.broadcast(sums)).select(      # one row
        "feature", ranked.alias("ranked"), (_near(F.col("rf"), F.lit(1.0), 1e-6) & _near(F.col("gbt"), F.lit(1.0), 1e-6)).alias("sums_to_one"))


@register("stack_evaluation_check", sql.q_stack_evaluation_check())
def stack_evaluation_check(spark, sf_dir):
    """The reported metrics equal a recount of the stored holdout predictions: one
    aggregate, and for AUC MLlib's curve without binning."""
    preds = cut_lineage(stack_scores(spark, sf_dir))
    hit = (F.col("label") == F.col("prediction")).cast("double")
    tp = F.sum(F.col("label") * F.col("prediction"))
    auc = exact_auc_by_mllib(preds, "prob_up")

    def f1(c):
        both = F.sum(((F.col("label") == c) & (F.col("prediction") == c)).cast("double"))
        have = F.sum((F.col("label") == c).cast("double"))
        said = F.sum((F.col("prediction") == c).cast("double"))
        return F.coalesce(2 * both / (have + said), F.lit(0.0)) * have
    again = preds.agg(F.avg(hit).alias("accuracy"), ((f1(0) + f1(1)) / F.count(F.lit(1))).alias("f1"),
                      (tp / F.sum("label")).alias("up_recall"),
                      (F.sum((1 - F.col("label")) * (1 - F.col("prediction"))) / F.sum(1 - F.col("label"))).alias("down_recall"))
    wide = again.withColumn("auc", F.lit(auc)).join(F.broadcast(ev.calibration_error(preds).select(
        F.col("mean_abs_calibration_error").alias("calibration_error"))))      # one row each
    names = ["accuracy", "f1", "up_recall", "down_recall", "auc", "calibration_error"]
    tall = wide.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("again")) for m in names])))
    return stack_evaluation(spark, sf_dir).join(tall, "metric").select("metric", _near(F.col("value"), F.col("again")).alias("equal"))


# ---- streaming ---------------------------------------------------------------


def _events_stream(spark, sf_dir) -> DataFrame:
    """The events table as a file stream (glob: the source wants a pattern)."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(os.path.join(sf_dir, "event[s].parquet"))


@register("stream_resample", sql.q_stream_resample(30, 600_000))
def stream_resample(spark, sf_dir):
    out = scratch_path(spark, "stream-resample")
    candles = stream_candles(event_trades(_events_stream(spark, sf_dir)), 30, "10 minutes",
                             order_col="trade_order")
    q = lv.start(candles, f"{out}/table", f"{out}/checkpoint", {"availableNow": True},
                 state_partitions=spark.sparkContext.defaultParallelism)
    q.awaitTermination()
    return rounded(spark.read.parquet(f"{out}/table"))


FEED_FILES = 2


def _replay_candles(spark, sf_dir, parts: int = 4) -> str:
    """Write the 30-minute candles in ``parts`` steps of time, ``FEED_FILES`` files
    each, and return the folder; a micro-batch reads as many files."""
    out = scratch_path(spark, "candle-feed")
    candles = cut_lineage(event_candles(spark, sf_dir))
    lo, hi = candles.agg(F.min("open_time"), F.max("open_time")).first()
    step = (hi - lo) // parts + 1
    for i in range(parts):
        part = candles.filter((F.col("open_time") >= lo + i * step) & (F.col("open_time") < lo + (i + 1) * step))
        part.repartition(FEED_FILES, "symbol", "open_time").write.parquet(f"{out}/part={i:04d}")
    return out


def _run_live(spark, sf_dir, model, feed: str | None = None, **kw) -> str:
    feed = feed or _replay_candles(spark, sf_dir)
    schema = spark.read.parquet(feed).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", FEED_FILES).parquet(feed)
    out = scratch_path(spark, "live")
    q = lv.start_live(stream, f"{out}/tables", f"{out}/checkpoint", model, {"availableNow": True},
                      state_partitions=spark.sparkContext.defaultParallelism, **kw)
    q.awaitTermination()
    return f"{out}/tables"


@register("stream_features", sql.q_stream_features())
def stream_features(spark, sf_dir):
    tables = _run_live(spark, sf_dir, None)
    preds = lv.newest(spark.read.parquet(f"{tables}/predictions"))
    return rounded(preds.select("symbol", "open_time", "close", *FEATURES))


@register("stream_out_of_order", sql.q_stream_out_of_order())
def stream_out_of_order(spark, sf_dir):
    """The candles arrive in any order over the micro-batches, most of them below the
    tail by then, some twice, and every thirteenth first with a wrong close and an
    older stamp: features and outcomes equal the batch's."""
    candles = cut_lineage(event_candles(spark, sf_dir))
    stamped = candles.withColumn("ingested_at", F.lit("2030-01-01T00:00:00.000000+00:00"))
    place = F.pmod(F.xxhash64("symbol", "open_time"), F.lit(4))
    wrong = (stamped.filter(F.pmod(F.col("open_time") / 1_800_000, F.lit(13)) == 0)
             .withColumn("close", F.col("close") * 2).withColumn("ingested_at", F.lit("2029-01-01T00:00:00.000000+00:00")))
    twice = stamped.filter(F.pmod(F.xxhash64("open_time", "symbol"), F.lit(5)) == 0)
    feed = scratch_path(spark, "mixed-feed")
    for i in range(4):
        part = stamped.filter(place == i).unionByName(wrong.filter(F.pmod(place + 2, F.lit(4)) == i)).unionByName(
            twice.filter(F.pmod(place + 1, F.lit(4)) == i))
        part.repartition(FEED_FILES, "symbol", "open_time").write.parquet(f"{feed}/part={i:04d}")
    tables = _run_live(spark, sf_dir, None, feed)
    preds = lv.newest(lv.read_table(spark, tables, "predictions"))
    outs = lv.newest(lv.read_table(spark, tables, "outcomes"))
    return rounded(preds.join(outs, ["symbol", "open_time"], "left").select(
        "symbol", "open_time", "close", *FEATURES, "actual_label"))


def _mixed_feed(spark, candles: DataFrame, parts: int) -> str:
    """The candles in any order over ``parts`` micro-batches, a fifth of them twice."""
    stamped = candles.withColumn("ingested_at", F.lit("2030-01-01T00:00:00.000000+00:00"))
    place = F.pmod(F.xxhash64("symbol", "open_time"), F.lit(parts))
    twice = stamped.filter(F.pmod(F.xxhash64("open_time", "symbol"), F.lit(5)) == 0)
    feed = scratch_path(spark, "mixed-feed")
    for i in range(parts):
        part = stamped.filter(place == i).unionByName(twice.filter(F.pmod(place + 1, F.lit(parts)) == i))
        part.repartition(FEED_FILES, "symbol", "open_time").write.parquet(f"{feed}/part={i:04d}")
    return feed


@register("stream_compacted", sql.q_stream_out_of_order())
def stream_compacted(spark, sf_dir):
    """Out-of-order candles with a snapshot of all tables every second batch, and at the end
    one of everything, the folders it replaces removed: what is read is the snapshot alone,
    and it equals the batch."""
    root = _run_live(spark, sf_dir, None, _mixed_feed(spark, cut_lineage(event_candles(spark, sf_dir)), 5), compact_every=2)
    for name, order in lv.TABLES.items():
        tb.compact(spark, root, name, 1 << 30, order)
        tb.vacuum(spark, root, name)
    preds, outs = (lv.newest(tb.read_table(spark, root, name)) for name in ("predictions", "outcomes"))
    return rounded(preds.join(outs, ["symbol", "open_time"], "left").select(
        "symbol", "open_time", "close", *FEATURES, "actual_label"))


@register("stream_restart", sql.q_stream_out_of_order())
def stream_restart(spark, sf_dir):
    """The live job is stopped after its first batches and started again on its
    checkpoint (STR-6): features and outcomes are those of one run, of the batch."""
    feed, out = _replay_candles(spark, sf_dir), scratch_path(spark, "restart")
    schema = spark.read.parquet(feed).schema

    def start(trigger):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", FEED_FILES).parquet(feed)
        return lv.start_live(stream, f"{out}/tables", f"{out}/checkpoint", None, trigger,
                             state_partitions=spark.sparkContext.defaultParallelism)

    q = start({"processingTime": "0 seconds"})
    while q.isActive and not q.recentProgress:      # until one batch is through
        q.awaitTermination(1)
    q.stop()
    start({"availableNow": True}).awaitTermination()
    preds, outs = (lv.newest(lv.read_table(spark, f"{out}/tables", name)) for name in ("predictions", "outcomes"))
    return rounded(preds.join(outs, ["symbol", "open_time"], "left").select(
        "symbol", "open_time", "close", *FEATURES, "actual_label"))


@register("stream_warm_up", sql.q_stream_warm_up())
def stream_warm_up(spark, sf_dir):
    """The feed begins with the newest stored candles of each symbol (STR-7); the
    first live candle after them is scored at once."""
    candles = cut_lineage(event_candles(spark, sf_dir))
    lo, hi = candles.agg(F.min("open_time"), F.max("open_time")).first()
    now, feed = lo + (hi - lo) // 2, scratch_path(spark, "warm-feed")
    bus.seed_feed(candles.filter(F.col("open_time") < now), f"{feed}/part=0000")
    for i in range(2):
        edge = now + i * ((hi - now) // 2 + 1)
        part = candles.filter((F.col("open_time") >= edge) & (F.col("open_time") < now + (i + 1) * ((hi - now) // 2 + 1)))
        part.repartition(FEED_FILES, "symbol", "open_time").write.parquet(f"{feed}/part={i + 1:04d}")
    preds = lv.newest(lv.read_table(spark, _run_live(spark, sf_dir, None, feed), "predictions"))
    return rounded(preds.select("symbol", "open_time", "close", *FEATURES))


def _defective_records(spark, sf_dir) -> DataFrame:
    """One-minute candle records as messages, a share of them with a defect each (by
    the minute): cut text, no symbol, another interval, no stamp, stamped too early."""
    records = rp.candle_records(event_candles(spark, sf_dir, minutes=1), "1m")
    minute = F.col("open_time") / 60_000

    def has(rule: str):
        return F.pmod(minute, F.lit(sql.RECORD_DEFECTS[rule][0])) == sql.RECORD_DEFECTS[rule][1]

    early = records.withColumn("symbol", F.when(~has("no_key"), F.col("symbol"))).withColumn(
        "interval", F.when(has("bad_interval"), F.lit("5m")).otherwise(F.col("interval"))).withColumn(
        "ingested_at", F.when(has("no_stamp"), None).when(has("not_closed"), rp.millis_to_utc_text(F.col("open_time") + 20_000, rp.ISO_UTC))
        .otherwise(F.col("ingested_at")))
    text = early.select(F.to_json(F.struct(*records.columns)).alias("t"), has("malformed").alias("cut"))
    return text.select(F.when(F.col("cut"), F.expr("substring(t, 1, length(t) - 3)")).otherwise(F.col("t")).alias("value"))


@register("stream_rejects", sql.q_stream_rejects())
def stream_rejects(spark, sf_dir):
    """Messages with every kind of defect through the live job's parser: closed records
    by symbol and rejects by reason, together all messages, read and parsed once."""
    root = scratch_path(spark, "rejects")
    _defective_records(spark, sf_dir).write.text(f"{root}/source")
    messages = bus.read_bus(spark, "text", path=f"{root}/source")
    start_messages(messages, root, trigger={"availableNow": True}).awaitTermination()
    good = closed_records(spark, root).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("number_of_trades").alias("trades"))
    bad = rejects(spark, root).groupBy("reason").agg(F.count("raw").alias("n"))
    return good.select(F.lit("closed").alias("status"), F.col("symbol").alias("item"), "n", "trades").unionByName(
        bad.select(F.lit("rejected").alias("status"), F.col("reason").alias("item"), "n", F.lit(None).cast("long").alias("trades")))


@register("stream_end_to_end", sql.q_stream_end_to_end())
def stream_end_to_end(spark, sf_dir):
    """One-minute bus messages as text, in steps of time, some sent twice, through both queries."""
    root = scratch_path(spark, "end-to-end")
    records = cut_lineage(rp.candle_records(event_candles(spark, sf_dir, minutes=1), "1m"))
    lo, hi = records.agg(F.min("open_time"), F.max("open_time")).first()
    step = (hi - lo) // 3 + 1
    for i in range(3):
        part = records.filter((F.col("open_time") >= lo + i * step) & (F.col("open_time") < lo + (i + 1) * step))
        twice = part.unionByName(part.filter(F.pmod(F.xxhash64("symbol", "open_time"), F.lit(7)) == 0))
        twice.select(F.to_json(F.struct(*records.columns)).alias("value")).repartition(FEED_FILES).write.text(
            f"{root}/messages/part={i:04d}")
    messages = spark.readStream.schema("value string").option("maxFilesPerTrigger", FEED_FILES).text(f"{root}/messages")
    queries = start_job(messages.select("value"), root, trigger={"availableNow": True}, wait=True,
                        state_partitions=spark.sparkContext.defaultParallelism)
    queries[-1].awaitTermination()
    preds = lv.newest(lv.read_table(spark, f"{root}/tables", "predictions"))
    return rounded(preds.select("symbol", "open_time", "close", *FEATURES))


@register("stream_scores")
def stream_scores(spark, sf_dir):
    result, _ = _trained(spark, sf_dir, "holdout")
    tables = _run_live(spark, sf_dir, result.model)
    preds = spark.read.parquet(f"{tables}/predictions")
    outs = spark.read.parquet(f"{tables}/outcomes")
    return lv.log_view(preds.select("symbol", "open_time", "close", "final_prob", "prediction", "seq"),
                       outs.select("symbol", "open_time", "actual_label", "seq"))


@register("stream_scores_check", sql.q_stream_scores_check())
def stream_scores_check(spark, sf_dir):
    """Every live score equals the batch score of the same candle."""
    result, _ = _trained(spark, sf_dir, "holdout")
    tables = _run_live(spark, sf_dir, result.model)
    live = lv.newest(spark.read.parquet(f"{tables}/predictions")).select("symbol", "open_time", "final_prob")
    batch = st.score(result.model, cut_lineage(event_features(spark, sf_dir, label=False))).select(
        "symbol", "open_time", "prob_up")
    return live.join(batch, ["symbol", "open_time"], "full").select(
        "symbol", "open_time", _near(F.col("final_prob"), F.col("prob_up")).alias("equal"))
