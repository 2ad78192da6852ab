"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written as plain SQL over the given tables, independently of the Spark code:
lags and frames are SQL window functions, open/close are ``arg_min`` /
``arg_max``. Doubles are rounded to 6 places (``+ 0.0`` folds -0.0 into 0.0)
on both sides, since sums run in a different order in each engine.
"""

from __future__ import annotations

from barforge.schema import FEATURES, LAGS, LOOKBACK

R = 6  # decimal places compared


def rnd(expr: str, alias: str | None = None) -> str:
    return f"round(CAST({expr} AS DOUBLE), {R}) + 0.0 AS {alias or expr}"


# ---- candles ---------------------------------------------------------------

TRADES = """
trades AS (
  SELECT event_type AS symbol, epoch_us(ts) AS t_us, value AS price,
         CASE WHEN user_id % 2 = 0 THEN value ELSE 0.0 END AS taker
  FROM events
)"""


def _bucket(us: str, step_ms: int) -> str:
    step = step_ms * 1000
    return f"CAST(({us} - ((({us}) % {step}) + {step}) % {step}) // 1000 AS BIGINT)"


def candles_cte(minutes: int = 30, name: str = "candles") -> str:
    return f"""
{name} AS (
  SELECT symbol, {_bucket('t_us', minutes * 60_000)} AS open_time,
         arg_min(price, t_us) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, t_us) AS close, sum(price) AS volume,
         CAST(count(*) AS BIGINT) AS number_of_trades,
         sum(taker) AS taker_buy_quote_asset_volume
  FROM trades GROUP BY 1, 2
)"""


CANDLE_OUT = ("symbol, open_time, " + ", ".join(
    rnd(c) for c in ("open", "high", "low", "close", "volume"))
    + ", number_of_trades, " + rnd("taker_buy_quote_asset_volume"))


def q_candles_30m() -> str:
    return f"WITH {TRADES}, {candles_cte()} SELECT {CANDLE_OUT} FROM candles"


def q_candles_5m_to_30m() -> str:
    return f"""
WITH {TRADES}, {candles_cte(5, 'c5')},
candles AS (
  SELECT symbol, {_bucket('open_time * 1000', 30 * 60_000)} AS open_time,
         arg_min(open, open_time) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, open_time) AS close, sum(volume) AS volume,
         CAST(sum(number_of_trades) AS BIGINT) AS number_of_trades,
         sum(taker_buy_quote_asset_volume) AS taker_buy_quote_asset_volume
  FROM c5 GROUP BY 1, 2
)
SELECT {CANDLE_OUT} FROM candles"""


def q_last_n_candles(n: int = 21) -> str:
    return f"""
WITH {TRADES}, {candles_cte()},
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) AS INTEGER) AS recency
  FROM candles
)
SELECT {CANDLE_OUT}, recency FROM ranked WHERE recency <= {n}"""


# ---- features --------------------------------------------------------------

def _lag_list(lookback: int = LOOKBACK) -> list[tuple[str, int]]:
    lags = dict(LAGS, close=tuple(range(1, lookback + 1)))
    return [(n, k) for n, ks in lags.items() for k in ks]


def _lag_sql() -> str:
    return ",\n         ".join(f"lag({n}, {k}) OVER w AS {n}_lag{k}" for n, k in _lag_list())


def _sum_closes(n: int) -> str:
    return "(" + " + ".join(f"close_lag{k}" for k in range(1, n + 1)) + f") / {float(n)}::DOUBLE"


def _ret(k: int) -> str:
    d = f"close_lag{k + 1}"
    return f"(CASE WHEN {d} = 0 THEN NULL ELSE (close_lag{k} - {d}) / {d} END)"


FEATURE_CTES = f"""
lagged AS (
  SELECT symbol, open_time, open, high, low, close, volume, number_of_trades,
         taker_buy_quote_asset_volume,
         {_lag_sql()},
         lead(close, 1) OVER w AS next_close,
         greatest(high - low, abs(high - lag(close, 1) OVER w),
                  abs(low - lag(close, 1) OVER w)) AS true_range
  FROM candles
  WINDOW w AS (PARTITION BY symbol ORDER BY open_time)
),
smas AS (
  SELECT *,
         {_sum_closes(5)} AS sma_5,
         {_sum_closes(10)} AS sma_10,
         {_sum_closes(20)} AS sma_20,
         sqrt((pow({_ret(1)}, 2) + pow({_ret(2)}, 2) + pow({_ret(3)}, 2)) / 3.0::DOUBLE) AS volatility,
         avg(true_range) OVER (PARTITION BY symbol ORDER BY open_time
                               ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS atr_10
  FROM lagged
),
feats AS (
  SELECT *,
         close - open AS body,
         high - low AS range,
         high - CASE WHEN close > open THEN close ELSE open END AS upper_wick,
         CASE WHEN close < open THEN close ELSE open END - low AS lower_wick,
         CASE WHEN sma_5 <> 0 THEN (close - sma_5) / sma_5 ELSE 0.0 END AS price_to_sma5,
         CASE WHEN sma_10 <> 0 THEN (close - sma_10) / sma_10 ELSE 0.0 END AS price_to_sma10,
         CASE WHEN sma_20 <> 0 THEN (close - sma_20) / sma_20 ELSE 0.0 END AS price_to_sma20,
         CASE WHEN close_lag5 <> 0 THEN (close - close_lag5) / close_lag5 ELSE 0.0 END AS price_momentum,
         CASE WHEN volatility <> 0 THEN (close - sma_20) / (2.0::DOUBLE * volatility) ELSE 0.0 END AS bb_position,
         CAST(CASE WHEN next_close > close THEN 1 ELSE 0 END AS INTEGER) AS label
  FROM smas
)"""

_DERIVED = ["body", "range", "upper_wick", "lower_wick", "price_to_sma5", "price_to_sma10",
            "price_to_sma20", "price_momentum", "bb_position", "atr_10"]
_CANDLE_DOUBLES = ["open", "high", "low", "close", "volume", "taker_buy_quote_asset_volume"]


def complete_where() -> str:
    """The dropna() rule over candle columns, lags, derived values and label."""
    conds = ["symbol IS NOT NULL", "open_time IS NOT NULL", "number_of_trades IS NOT NULL",
             "label IS NOT NULL"]
    doubles = _CANDLE_DOUBLES + [f"{n}_lag{k}" for n, k in _lag_list()
                                 if n != "number_of_trades"] + _DERIVED
    conds += [f"number_of_trades_lag{k} IS NOT NULL" for k in LAGS["number_of_trades"]]
    conds += [f"({c} IS NOT NULL AND NOT isnan({c}))" for c in doubles]
    return " AND ".join(conds)


def _feature_base() -> str:
    return f"WITH {TRADES}, {candles_cte()}, {FEATURE_CTES}"


def _model_out() -> str:
    ints = {f"number_of_trades_lag{k}" for k in (1, 2, 3)}
    cols = ["symbol", "open_time", rnd("close"), "label"]
    cols += [f if f in ints else rnd(f) for f in FEATURES]
    return ", ".join(cols)


def q_feature_matrix(tail: str = "drop") -> str:
    where = complete_where()
    if tail == "drop":
        where += " AND next_close IS NOT NULL"
    return f"{_feature_base()} SELECT {_model_out()} FROM feats WHERE {where}"


def q_lag_features() -> str:
    cols = ["symbol", "open_time"]
    for n, k in _lag_list():
        c = f"{n}_lag{k}"
        cols.append(c if n == "number_of_trades" else rnd(c))
    return f"{_feature_base()} SELECT {', '.join(cols)} FROM feats"


def q_labels_next_candle(tail: str = "drop") -> str:
    where = "WHERE next_close IS NOT NULL" if tail == "drop" else ""
    return (f"{_feature_base()} SELECT symbol, open_time, {rnd('close')}, "
            f"{rnd('next_close')}, label FROM feats {where}")


def _some(cols: list[str]) -> str:
    return f"{_feature_base()} SELECT symbol, open_time, {', '.join(rnd(c) for c in cols)} FROM feats"


def q_candle_shape() -> str:
    return _some(["body", "range", "upper_wick", "lower_wick"])


def q_sma_ratios() -> str:
    return _some(["sma_5", "sma_10", "sma_20", "price_to_sma5", "price_to_sma10", "price_to_sma20"])


def q_momentum_volatility() -> str:
    return _some(["price_momentum", "volatility"])


def q_bb_position() -> str:
    return _some(["sma_20", "volatility", "bb_position"])


def q_atr_10() -> str:
    return _some(["true_range", "atr_10"])


# ---- splits, folds, balance -------------------------------------------------

def _fm(tail: str = "drop") -> str:
    where = complete_where() + (" AND next_close IS NOT NULL" if tail == "drop" else "")
    return (f"{_feature_base()}, fm AS (SELECT symbol, open_time, close, label "
            f"FROM feats WHERE {where})")


def q_walk_forward_folds(k: int = 3) -> str:
    return (f"{_fm()} SELECT symbol, open_time, label, "
            f"CAST(ntile({k}) OVER (ORDER BY open_time, symbol) - 1 AS INTEGER) AS fold FROM fm")


def q_fold_summary(k: int = 3) -> str:
    return f"""{_fm()}, folded AS (
  SELECT open_time, CAST(ntile({k}) OVER (ORDER BY open_time, symbol) - 1 AS INTEGER) AS fold FROM fm)
SELECT fold, min(open_time) AS start_time, max(open_time) AS end_time,
       CAST(count(*) AS BIGINT) AS count
FROM folded GROUP BY fold"""


def q_holdout_by_time(f: float = 0.8) -> str:
    return f"""{_fm()}, ranked AS (
  SELECT symbol, open_time, label, row_number() OVER (ORDER BY open_time, symbol) - 1 AS rk,
         count(*) OVER () AS n FROM fm)
SELECT symbol, open_time, label,
       CASE WHEN rk < floor(n * {f}::DOUBLE) THEN 'train' ELSE 'test' END AS split
FROM ranked"""


LINEITEM_SYMBOLS = """
line_days AS (
  SELECT CAST(l_partkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS d FROM lineitem
),
syms AS (SELECT symbol, CAST(count(DISTINCT d) AS BIGINT) AS n_candles FROM line_days GROUP BY symbol),
ranked AS (
  SELECT symbol, n_candles, row_number() OVER (ORDER BY symbol) - 1 AS rk,
         count(*) OVER () AS total FROM syms
),
splits AS (
  SELECT symbol, n_candles,
         CASE WHEN rk < floor(total * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split,
         CAST(CASE WHEN rk < floor(total * 0.8::DOUBLE) THEN rk
                   ELSE rk - floor(total * 0.8::DOUBLE) END AS BIGINT) AS split_rank,
         CAST(CASE WHEN rk < floor(total * 0.8::DOUBLE) THEN floor(total * 0.8::DOUBLE)
                   ELSE total - floor(total * 0.8::DOUBLE) END AS BIGINT) AS split_size
  FROM ranked
)"""


def q_holdout_by_symbol() -> str:
    return f"WITH {LINEITEM_SYMBOLS} SELECT symbol, split, n_candles FROM splits"


def q_sample_symbols(f: float = 0.2) -> str:
    return (f"WITH {LINEITEM_SYMBOLS} SELECT symbol, split, split_rank FROM splits "
            f"WHERE split_rank < floor(split_size * {f}::DOUBLE)")


_DAILY = """
daily AS (
  SELECT CAST(l_partkey AS VARCHAR) AS symbol, epoch_ms(date_trunc('day', l_shipdate)) AS open_time,
         CAST(count(*) AS BIGINT) AS number_of_trades
  FROM lineitem GROUP BY 1, 2)"""


def q_holdout_rows_by_symbol() -> str:
    return (f"WITH {LINEITEM_SYMBOLS}, {_DAILY} SELECT symbol, open_time, number_of_trades, split "
            f"FROM daily JOIN splits USING (symbol)")


def q_sample_rows(f: float = 0.2) -> str:
    return (f"WITH {LINEITEM_SYMBOLS}, {_DAILY} SELECT symbol, open_time, number_of_trades FROM daily "
            f"WHERE symbol IN (SELECT symbol FROM splits WHERE split_rank < floor(split_size * {f}::DOUBLE))")


def q_holdout_symbol_files(f: float = 0.2) -> str:
    return f"""WITH daily AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol, epoch_ms(date_trunc('day', l_shipdate)) AS open_time,
         CAST(count(*) AS BIGINT) AS number_of_trades
  FROM lineitem GROUP BY 1, 2),
ranked AS (
  SELECT symbol, row_number() OVER (ORDER BY symbol) - 1 AS rk, count(*) OVER () AS n FROM (SELECT DISTINCT symbol FROM daily)),
sides AS (
  SELECT symbol, CASE WHEN rk < floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split,
         CASE WHEN rk < floor(n * 0.8::DOUBLE) THEN rk ELSE rk - floor(n * 0.8::DOUBLE) END AS own,
         CASE WHEN rk < floor(n * 0.8::DOUBLE) THEN floor(n * 0.8::DOUBLE) ELSE n - floor(n * 0.8::DOUBLE) END AS size
  FROM ranked)
SELECT 'all' AS part, split, symbol, open_time, number_of_trades FROM daily JOIN sides USING (symbol)
UNION ALL
SELECT 'sample' AS part, split, symbol, open_time, number_of_trades FROM daily JOIN sides USING (symbol)
WHERE own < floor(size * {f}::DOUBLE)"""


def q_symbol_from_file_name() -> str:
    return f"""WITH {TRADES}, {candles_cte()},
ranked AS (
  SELECT symbol, row_number() OVER (ORDER BY symbol) - 1 AS rk, count(*) OVER () AS n FROM (SELECT DISTINCT symbol FROM candles))
SELECT symbol, open_time, {rnd('close')}, CASE WHEN rk < floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split
FROM candles JOIN ranked USING (symbol)"""


def q_ordered_candles() -> str:
    return f"""WITH {TRADES}, {candles_cte()}
SELECT symbol, open_time, {rnd('close')}, row_number() OVER (ORDER BY symbol, open_time) AS position FROM candles"""


def q_walk_forward_folds_daily(k: int = 3) -> str:
    return f"""WITH {_DAILY.strip()}
SELECT symbol, open_time, CAST(ntile({k}) OVER (ORDER BY open_time, symbol) - 1 AS INTEGER) AS fold FROM daily"""


def q_class_balance() -> str:
    return f"""{_fm()}, c AS (SELECT label, CAST(count(*) AS BIGINT) AS count FROM fm GROUP BY label)
SELECT label, count, {rnd('count * 100.0::DOUBLE / sum(count) OVER ()', 'pct')} FROM c"""


def q_class_weights(downscale: float = 1.0) -> str:
    return f"""{_fm()}, c AS (SELECT label, CAST(count(*) AS BIGINT) AS count FROM fm GROUP BY label),
t AS (SELECT sum(count) AS total, count(*) FILTER (WHERE label = 0) AS has0,
             count(*) FILTER (WHERE label = 1) AS has1 FROM c)
SELECT label, count,
       {rnd(f'CASE WHEN has0 > 0 AND has1 > 0 THEN 1.0::DOUBLE + (total / (2.0::DOUBLE * count) - 1.0::DOUBLE) * {downscale}::DOUBLE ELSE 1.0::DOUBLE END', 'weight')}
FROM c, t"""


def key_fraction_sql(seed: int = 42) -> str:
    return (f"CAST(('0x' || substr(md5(symbol || ':' || CAST(open_time AS VARCHAR) || ':{seed}'), 1, 8)) AS BIGINT)"
            f" / 4294967296.0::DOUBLE")


def q_undersample_majority(seed: int = 42) -> str:
    return f"""{_fm()},
cnt AS (SELECT count(*) FILTER (WHERE label = 1) AS up, count(*) FILTER (WHERE label = 0) AS down FROM fm),
p AS (SELECT CASE WHEN down > up THEN 0 ELSE 1 END AS maj,
             CASE WHEN down > up THEN up::DOUBLE / down::DOUBLE
                  WHEN up = 0 THEN 1.0::DOUBLE ELSE down::DOUBLE / up::DOUBLE END AS ratio FROM cnt)
SELECT symbol, open_time, label FROM fm, p
WHERE label <> maj OR {key_fraction_sql(seed)} < ratio"""


# ---- ingest ------------------------------------------------------------------

_REJECT_REASON = """CASE WHEN event_id % 41 = 4 THEN 'malformed'
     WHEN event_id % 31 = 2 THEN 'no_kline'
     WHEN event_id % 29 = 1 THEN 'not_closed'
     WHEN event_id % 37 = 3 THEN 'bad_field'
     WHEN event_id % 43 = 5 THEN 'bad_interval' END"""


def q_parse_events() -> str:
    return f"""
WITH e AS (SELECT *, epoch_us(ts) AS us, {_REJECT_REASON} AS reason FROM events)
SELECT CAST(CASE WHEN event_id % 5 = 0 THEN us - us % 1800000000 ELSE us - us % 60000000 END // 1000 AS BIGINT) AS open_time,
       {rnd('value', 'open')}, {rnd('value', 'high')}, {rnd('value', 'low')}, {rnd('value', 'close')},
       {rnd('value', 'volume')}, {rnd('value', 'quote_asset_volume')},
       CAST(1 AS INTEGER) AS number_of_trades, 0.0::DOUBLE AS taker_buy_base_asset_volume,
       {rnd('CASE WHEN user_id % 2 = 0 THEN value ELSE 0.0 END', 'taker_buy_quote_asset_volume')},
       upper(event_type) AS symbol, CASE WHEN event_id % 5 = 0 THEN '30m' ELSE '1m' END AS interval
FROM e WHERE reason IS NULL"""


def q_parse_rejects() -> str:
    return f"""
SELECT reason, CAST(count(*) AS BIGINT) AS n
FROM (SELECT {_REJECT_REASON} AS reason FROM events) WHERE reason IS NOT NULL GROUP BY reason"""


def q_parse_kline_arrays() -> str:
    return f"""
WITH e AS (SELECT *, epoch_us(ts) AS us FROM events WHERE event_id % 37 <> 3)
SELECT CAST((us - us % 60000000) // 1000 AS BIGINT) AS open_time,
       {rnd('value', 'open')}, {rnd('value', 'high')}, {rnd('value', 'low')}, {rnd('value', 'close')},
       {rnd('value', 'volume')}, {rnd('value', 'quote_asset_volume')},
       CAST(1 AS INTEGER) AS number_of_trades, 0.0::DOUBLE AS taker_buy_base_asset_volume,
       {rnd('CASE WHEN user_id % 2 = 0 THEN value ELSE 0.0 END', 'taker_buy_quote_asset_volume')},
       upper(event_type) AS symbol, '1m' AS interval
FROM e"""


def q_route_intervals() -> str:
    return (f"WITH {TRADES}, {candles_cte()} SELECT {CANDLE_OUT}, "
            f"CASE WHEN symbol = 'view' THEN '30m' ELSE '1m' END AS source_interval FROM candles")


def q_latest_closed() -> str:
    def out(step: int, interval: str, table: str) -> str:
        cols = CANDLE_OUT.replace(rnd("volume"), rnd(
            f"CASE WHEN (open_time // {step}) % 7 = 0 THEN volume + 1.0::DOUBLE ELSE volume END", "volume"))
        return f"SELECT '{interval}' AS interval, {cols} FROM {table}"
    return (f"WITH {TRADES}, {candles_cte()}, {candles_cte(1, 'minutes')} "
            f"{out(1_800_000, '30m', 'candles')} UNION ALL {out(60_000, '1m', 'minutes')}")


def q_parse_candle_records() -> str:
    return f"""WITH {TRADES}, {candles_cte(1)}
SELECT open_time, {rnd('open')}, {rnd('high')}, {rnd('low')}, {rnd('close')}, {rnd('volume')},
       {rnd('volume', 'quote_asset_volume')}, CAST(number_of_trades AS INTEGER) AS number_of_trades,
       0.0::DOUBLE AS taker_buy_base_asset_volume, {rnd('taker_buy_quote_asset_volume')}, symbol, '1m' AS interval,
       strftime(make_timestamp((open_time + 65000) * 1000), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS ingested_at
FROM candles"""


def q_bus_round_trip() -> str:
    return q_parse_candle_records().replace("AS ingested_at", "AS ingested_at, CAST(0 AS BIGINT) AS rejected")


# ---- scores, signals, evaluation -------------------------------------------
# The transparent momentum score used to check the report operators:
# x = 20 * price_momentum, p = 0.5 + 0.5 * x / (1 + |x|).

def _scored(labelled: bool = True) -> str:
    where = complete_where() + (" AND next_close IS NOT NULL" if labelled else "")
    return f"""{_feature_base()},
scored AS (
  SELECT symbol, open_time, close, label, next_close,
         0.5::DOUBLE + 0.5::DOUBLE * (20.0::DOUBLE * price_momentum)
             / (1.0::DOUBLE + abs(20.0::DOUBLE * price_momentum)) AS prob_up
  FROM feats WHERE {where}
),
preds AS (SELECT *, CAST(CASE WHEN prob_up > 0.5::DOUBLE THEN 1 ELSE 0 END AS INTEGER) AS prediction
          FROM scored)"""


def q_trading_signals() -> str:
    return f"""{_scored(False)}
SELECT symbol, open_time, {rnd('prob_up')}, prediction,
       CASE WHEN prob_up >= 0.6::DOUBLE OR prob_up <= 0.4::DOUBLE
                 OR prob_up >= 0.7::DOUBLE OR prob_up <= 0.3::DOUBLE
            THEN CASE WHEN prediction = 1 THEN 'BUY (Long)' ELSE 'SELL (Short)' END
            ELSE 'WAIT' END AS signal,
       CASE WHEN prob_up >= 0.7::DOUBLE OR prob_up <= 0.3::DOUBLE THEN 'VERY HIGH'
            WHEN prob_up >= 0.6::DOUBLE OR prob_up <= 0.4::DOUBLE THEN 'HIGH' ELSE 'Low' END AS confidence
FROM preds"""


def q_confusion() -> str:
    return (f"{_scored()} SELECT label, prediction, CAST(count(*) AS BIGINT) AS count "
            f"FROM preds GROUP BY label, prediction")


_CELLS = """cells AS (
  SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE AS tp1,
         count(*) FILTER (WHERE label = 0 AND prediction = 1)::DOUBLE AS fp1,
         count(*) FILTER (WHERE label = 1 AND prediction = 0)::DOUBLE AS fn1,
         count(*) FILTER (WHERE label = 0 AND prediction = 0)::DOUBLE AS tp0,
         count(*) AS n
  FROM preds)"""


def q_class_recall() -> str:
    return f"""{_scored()}, {_CELLS}
SELECT {rnd('CASE WHEN tp1 + fn1 > 0 THEN tp1 / (tp1 + fn1) ELSE 0.0 END', 'up_recall')},
       {rnd('CASE WHEN tp0 + fp1 > 0 THEN tp0 / (tp0 + fp1) ELSE 0.0 END', 'down_recall')}
FROM cells"""


def q_accuracy_f1() -> str:
    return f"""{_scored()}, {_CELLS},
pr AS (
  SELECT *, CASE WHEN tp1 + fp1 > 0 THEN tp1 / (tp1 + fp1) ELSE 0.0 END AS p1,
            CASE WHEN tp1 + fn1 > 0 THEN tp1 / (tp1 + fn1) ELSE 0.0 END AS r1,
            CASE WHEN tp0 + fn1 > 0 THEN tp0 / (tp0 + fn1) ELSE 0.0 END AS p0,
            CASE WHEN tp0 + fp1 > 0 THEN tp0 / (tp0 + fp1) ELSE 0.0 END AS r0
  FROM cells)
SELECT {rnd('(tp1 + tp0) / n', 'accuracy')},
       {rnd('CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END * ((tp1 + fn1) / n) + CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2 * p0 * r0 / (p0 + r0) END * ((tp0 + fp1) / n)', 'f1')},
       CAST(n AS BIGINT) AS count
FROM pr"""


def q_auc_exact() -> str:
    return f"""{_scored()},
s AS (SELECT prob_up AS s, sum(label) AS pos, count(*) - sum(label) AS neg FROM preds GROUP BY prob_up),
r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT {rnd('sum(pos * (2 * below + neg))::DOUBLE / (2.0 * sum(pos) * sum(neg))', 'auc')},
       CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
FROM r"""


_CAL = """cal AS (
  SELECT round(floor(prob_up * 20) / 20.0, 2) AS prob_bin, count(*) AS count,
         avg(prob_up) AS avg_predicted_prob,
         avg(CASE WHEN label = 1 THEN 1.0 ELSE 0.0 END) AS actual_prob_up
  FROM preds GROUP BY 1)"""


def q_calibration_table() -> str:
    return f"""{_scored()}, {_CAL}
SELECT {rnd('prob_bin')}, CAST(count AS BIGINT) AS count, {rnd('avg_predicted_prob')},
       {rnd('actual_prob_up')}, {rnd('actual_prob_up - avg_predicted_prob', 'calibration_error')}
FROM cal"""


def q_calibration_error() -> str:
    return f"""{_scored()}, {_CAL}
SELECT {rnd('sum(count * abs(actual_prob_up - avg_predicted_prob)) / sum(count)', 'mean_abs_calibration_error')},
       CAST(count(*) AS BIGINT) AS bins
FROM cal"""


def q_probability_summary() -> str:
    return f"""{_scored()}
SELECT CAST(count(prob_up) AS BIGINT) AS count, {rnd('avg(prob_up)', 'mean')},
       {rnd('stddev_samp(prob_up)', 'stddev')}, {rnd('min(prob_up)', 'min')}, {rnd('max(prob_up)', 'max')}
FROM preds"""


def q_confidence_bands() -> str:
    return f"""{_scored()}, b AS (
  SELECT CASE WHEN prob_up < 0.45::DOUBLE THEN 0 WHEN prob_up < 0.50::DOUBLE THEN 1
              WHEN prob_up < 0.55::DOUBLE THEN 2 WHEN prob_up < 0.60::DOUBLE THEN 3
              WHEN prob_up < 0.65::DOUBLE THEN 4 WHEN prob_up < 0.70::DOUBLE THEN 5 ELSE 6 END AS band
  FROM preds)
SELECT CAST(band AS INTEGER) AS band,
       ['Very Low (0-45%)', 'Low (45-50%)', 'Borderline (50-55%)', 'Moderate (55-60%)',
        'Confident (60-65%)', 'High (65-70%)', 'Very High (70%+)'][band + 1] AS confidence_range,
       CAST(count(*) AS BIGINT) AS count
FROM b GROUP BY band"""


def q_confident_subset() -> str:
    parts = []
    for t in (0.6, 0.7):
        inside = f"(prob_up >= {t}::DOUBLE OR prob_up <= 1.0::DOUBLE - {t}::DOUBLE)"
        parts.append(f"""
SELECT {rnd(f'{t}', 'threshold')},
       CAST(count(*) FILTER (WHERE {inside}) AS BIGINT) AS count,
       {rnd(f'count(*) FILTER (WHERE {inside}) * 100.0 / count(*)', 'pct_of_total')},
       {rnd(f'CASE WHEN count(*) FILTER (WHERE {inside}) > 0 THEN count(*) FILTER (WHERE {inside} AND prediction = label)::DOUBLE / count(*) FILTER (WHERE {inside}) END', 'accuracy')},
       {rnd('count(*) FILTER (WHERE prediction = label)::DOUBLE / count(*)', 'overall_accuracy')}
FROM preds""")
    return f"{_scored()} " + " UNION ALL ".join(parts)


#: model -> (feature, weight): the score's x is 20 * feature * weight
FOUR_SCORES = {"momentum": ("price_momentum", 1.0), "short": ("price_to_sma5", 0.5), "long": ("price_to_sma20", 0.25),
               "band": ("bb_position", 0.001)}


def q_evaluation_bundle(thresholds=(0.6, 0.7)) -> str:
    """Every report, for one model at a time, from its own rows."""
    scores = " UNION ALL ".join(
        f"SELECT '{m}' AS model, label, 0.5::DOUBLE + 0.5::DOUBLE * (20.0::DOUBLE * ({c} * {w}::DOUBLE)) "
        f"/ (1.0::DOUBLE + abs(20.0::DOUBLE * ({c} * {w}::DOUBLE))) AS p FROM feats "
        f"WHERE {complete_where()} AND next_close IS NOT NULL" for m, (c, w) in FOUR_SCORES.items())

    def out(report, metric, value, source, item="CAST(NULL AS DOUBLE)", item2="CAST(NULL AS DOUBLE)"):
        return (f"SELECT model, '{report}' AS report, round(CAST({item} AS DOUBLE), {R}) AS item, CAST({item2} AS DOUBLE) AS item2, "
                f"'{metric}' AS metric, {rnd(value, 'value')} FROM {source}")

    f = "CASE WHEN p{0} + r{0} = 0 THEN 0.0 ELSE 2 * p{0} * r{0} / (p{0} + r{0}) END"
    rows = [out("confusion", "count", "n", "conf", "label", "hit")]
    rows += [out("rates", m, v, "pr") for m, v in (
        ("up_recall", "r1"), ("down_recall", "r0"), ("accuracy", "(tp1 + tp0) / n"), ("count", "n"),
        ("f1", f"{f.format(1)} * ((tp1 + fn1) / n) + {f.format(0)} * ((tp0 + fp1) / n)"))]
    rows += [out("auc", m, v, "auc") for m, v in (("auc", "auc"), ("positives", "pos"), ("negatives", "neg"))]
    rows += [out("calibration", m, v, "cal", "prob_bin") for m, v in (
        ("count", "n"), ("avg_predicted_prob", "said"), ("actual_prob_up", "was"), ("calibration_error", "was - said"))]
    rows += [out("calibration_error", m, v, "(SELECT model, sum(n * abs(was - said)) / sum(n) AS e, count(*) AS k FROM cal GROUP BY model)")
             for m, v in (("mean_abs_calibration_error", "e"), ("bins", "k"))]
    rows += [out("summary", m, v, "(SELECT model, count(p) AS n, avg(p) AS a, stddev_samp(p) AS s, min(p) AS lo, max(p) AS hi FROM preds GROUP BY model)")
             for m, v in (("count", "n"), ("mean", "a"), ("stddev", "s"), ("min", "lo"), ("max", "hi"))]
    rows += [out("bands", "count", "n", "(SELECT model, CASE WHEN p < 0.45::DOUBLE THEN 0 WHEN p < 0.50::DOUBLE THEN 1 WHEN p < 0.55::DOUBLE THEN 2 "
                 "WHEN p < 0.60::DOUBLE THEN 3 WHEN p < 0.65::DOUBLE THEN 4 WHEN p < 0.70::DOUBLE THEN 5 ELSE 6 END AS band, "
                 "count(*) AS n FROM preds GROUP BY ALL)", "band")]
    for t in thresholds:
        inside = f"(p >= {t}::DOUBLE OR p <= 1.0::DOUBLE - {t}::DOUBLE)"
        source = (f"(SELECT model, count(*) AS n, count(*) FILTER (WHERE {inside}) AS k, count(*) FILTER (WHERE hit = label) AS h, "
                  f"count(*) FILTER (WHERE {inside} AND hit = label) AS c FROM preds GROUP BY model)")
        rows += [out("confident", m, v, source, f"{t}") for m, v in (
            ("count", "k"), ("pct_of_total", "k * 100.0 / n"), ("accuracy", "CASE WHEN k > 0 THEN c::DOUBLE / k END"),
            ("overall_accuracy", "h::DOUBLE / n"))]
    return f"""{_feature_base()},
raw AS ({scores}), preds AS (SELECT *, CAST(p > 0.5::DOUBLE AS INTEGER) AS hit FROM raw),
conf AS (SELECT model, label, hit, count(*) AS n FROM preds GROUP BY ALL),
cells AS (
  SELECT model, count(*) FILTER (WHERE label = 1 AND hit = 1)::DOUBLE AS tp1, count(*) FILTER (WHERE label = 0 AND hit = 1)::DOUBLE AS fp1,
         count(*) FILTER (WHERE label = 1 AND hit = 0)::DOUBLE AS fn1, count(*) FILTER (WHERE label = 0 AND hit = 0)::DOUBLE AS tp0,
         count(*) AS n FROM preds GROUP BY model),
pr AS (
  SELECT *, CASE WHEN tp1 + fp1 > 0 THEN tp1 / (tp1 + fp1) ELSE 0.0 END AS p1, CASE WHEN tp1 + fn1 > 0 THEN tp1 / (tp1 + fn1) ELSE 0.0 END AS r1,
            CASE WHEN tp0 + fn1 > 0 THEN tp0 / (tp0 + fn1) ELSE 0.0 END AS p0, CASE WHEN tp0 + fp1 > 0 THEN tp0 / (tp0 + fp1) ELSE 0.0 END AS r0
  FROM cells),
steps AS (SELECT model, p, sum(label) AS pos, count(*) - sum(label) AS neg FROM preds GROUP BY model, p),
below AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM steps),
auc AS (SELECT model, sum(pos * (2 * b + neg))::DOUBLE / (2.0 * sum(pos) * sum(neg)) AS auc, sum(pos) AS pos, sum(neg) AS neg FROM below GROUP BY model),
cal AS (SELECT model, round(floor(p * 20) / 20.0, 2) AS prob_bin, count(*) AS n, avg(p) AS said, avg(CASE WHEN label = 1 THEN 1.0 ELSE 0.0 END) AS was
        FROM preds GROUP BY 1, 2)
{" UNION ALL ".join(rows)}"""


def q_ordered_reports() -> str:
    def out(name, source, item):
        return (f"SELECT '{name}' AS report, CAST(row_number() OVER (ORDER BY {item}) AS INTEGER) AS position, "
                f"{rnd(item, 'item')}, CAST(count AS BIGINT) AS count FROM {source}")
    folds = "(SELECT fold, count(*) AS count FROM (SELECT ntile(3) OVER (ORDER BY open_time, symbol) - 1 AS fold FROM preds) GROUP BY fold)"
    bands = q_confidence_bands().split("b AS (", 1)[1].split(")\nSELECT", 1)[0]
    return f"""{_scored()}, {_CAL}, b AS ({bands})
{out('calibration', 'cal', 'prob_bin')}
UNION ALL {out('bands', '(SELECT band, count(*) AS count FROM b GROUP BY band)', 'band')}
UNION ALL {out('folds', folds, 'fold')}
UNION ALL {out('classes', '(SELECT label, count(*) AS count FROM preds GROUP BY label)', 'label')}"""


def q_prediction_outcomes() -> str:
    return f"""{_scored(False)},
outc AS (SELECT symbol, open_time, label AS actual_label FROM feats WHERE next_close IS NOT NULL)
SELECT p.open_time AS timestamp, strftime(make_timestamp(p.open_time * 1000), '%Y-%m-%d %H:%M:%S') AS datetime,
       p.symbol, {rnd('p.close', 'close')}, {rnd('p.prob_up', 'final_prob')}, p.prediction, o.actual_label,
       CAST(CASE WHEN o.actual_label IS NULL THEN NULL WHEN o.actual_label = p.prediction THEN 1 ELSE 0 END AS INTEGER) AS is_correct
FROM preds p LEFT JOIN outc o ON p.symbol = o.symbol AND p.open_time = o.open_time"""


def q_live_hit_rate() -> str:
    return f"""{_scored(False)},
outc AS (SELECT symbol, open_time, label AS actual_label FROM feats WHERE next_close IS NOT NULL),
log AS (
  SELECT p.symbol, strftime(make_timestamp(p.open_time * 1000), '%Y-%m-%d') AS day,
         CASE WHEN o.actual_label = p.prediction THEN 1 ELSE 0 END AS is_correct
  FROM preds p JOIN outc o ON p.symbol = o.symbol AND p.open_time = o.open_time)
SELECT symbol, day, CAST(count(*) AS BIGINT) AS scored, {rnd('avg(is_correct)', 'hit_rate')}
FROM log GROUP BY symbol, day"""


# ---- streaming ---------------------------------------------------------------

def q_stream_resample(minutes: int = 30, delay_ms: int = 600_000) -> str:
    """Candles whose window closed under the watermark (max event time - delay)."""
    return f"""WITH {TRADES}, {candles_cte(minutes)},
wm AS (SELECT max(t_us) // 1000 - {delay_ms} AS w FROM trades)
SELECT {CANDLE_OUT} FROM candles, wm WHERE open_time + {minutes * 60_000} <= w"""


def q_stream_features() -> str:
    ints = {f"number_of_trades_lag{k}" for k in (1, 2, 3)}
    cols = ["symbol", "open_time", rnd("close")] + [f if f in ints else rnd(f) for f in FEATURES]
    return f"{_feature_base()} SELECT {', '.join(cols)} FROM feats WHERE {complete_where()}"


def q_stream_out_of_order() -> str:
    out = "CAST(CASE WHEN next_close IS NOT NULL THEN label END AS INTEGER) AS actual_label"
    return q_stream_features().replace(" FROM feats WHERE", f", {out} FROM feats WHERE")


# ---- model queries: keys, folds, weights and consistency flags ------------------

def _split() -> str:
    return f"""{_fm()}, r AS (
  SELECT *, row_number() OVER (ORDER BY open_time, symbol) - 1 AS rk, count(*) OVER () AS n FROM fm),
train AS (SELECT symbol, open_time, close, label FROM r WHERE rk < floor(n * 0.8::DOUBLE)),
test AS (SELECT symbol, open_time, close, label FROM r WHERE rk >= floor(n * 0.8::DOUBLE))"""


def q_stack_oof_check(k: int = 3) -> str:
    return f"""{_split()},
c AS (SELECT label, count(*) AS m FROM train GROUP BY label), t AS (SELECT sum(m) AS total, count(*) AS classes FROM c),
w AS (SELECT label, CASE WHEN classes = 2 THEN total / (2.0::DOUBLE * m) ELSE 1.0::DOUBLE END AS weight FROM c, t),
f AS (SELECT *, CAST(ntile({k}) OVER (ORDER BY open_time, symbol) - 1 AS INTEGER) AS fold FROM train)
SELECT symbol, open_time, label, {rnd('weight')}, fold, TRUE AS in_range FROM f JOIN w USING (label) WHERE fold > 0"""


def q_stack_scores_check() -> str:
    return f"{_split()} SELECT symbol, open_time, {rnd('close')}, label, TRUE AS consistent FROM test"


def q_feature_importance_check() -> str:
    names = ", ".join(f"('{f}')" for f in FEATURES)
    return f"SELECT feature, TRUE AS ranked, TRUE AS sums_to_one FROM (VALUES {names}) AS t(feature)"


def q_stack_evaluation_check() -> str:
    names = ("accuracy", "f1", "up_recall", "down_recall", "auc", "calibration_error")
    return "SELECT metric, TRUE AS equal FROM (VALUES " + ", ".join(f"('{m}')" for m in names) + ") AS t(metric)"


def q_stack_evaluation_bundle_check() -> str:
    reports = ("confusion", "rates", "auc", "calibration", "calibration_error", "summary", "bands", "confident")
    return ("SELECT model, report, TRUE AS equal, TRUE AS complete FROM (VALUES ('rf'), ('gbt'), ('lr'), ('stack')) AS m(model), "
            "(VALUES " + ", ".join(f"('{r}')" for r in reports) + ") AS r(report)")


def q_stream_warm_up() -> str:
    """Rows from each symbol's newest candle before the middle of the time range on."""
    return q_stream_features() + """
AND (symbol, open_time) IN (
  SELECT c.symbol, c.open_time FROM candles c JOIN (
    SELECT symbol, max(open_time) AS first FROM candles
    WHERE open_time < (SELECT min(open_time) + (max(open_time) - min(open_time)) // 2 FROM candles) GROUP BY symbol) s
  ON c.symbol = s.symbol AND c.open_time >= s.first)"""


#: defects of the message query, by the minute (modulus, remainder); the first that applies is the reason
RECORD_DEFECTS = {"malformed": (41, 4), "no_key": (43, 5), "bad_interval": (37, 3), "no_stamp": (31, 2), "not_closed": (29, 1)}


def q_stream_rejects() -> str:
    when = " ".join(f"WHEN (open_time // 60000) % {m} = {r} THEN '{name}'" for name, (m, r) in RECORD_DEFECTS.items())
    return f"""WITH {TRADES}, {candles_cte(1)}, tagged AS (SELECT *, CASE {when} END AS reason FROM candles)
SELECT 'closed' AS status, symbol AS item, CAST(count(*) AS BIGINT) AS n, CAST(sum(number_of_trades) AS BIGINT) AS trades
FROM tagged WHERE reason IS NULL GROUP BY symbol
UNION ALL SELECT 'rejected', reason, count(*), NULL FROM tagged WHERE reason IS NOT NULL GROUP BY reason"""


def q_stream_scores_check() -> str:
    return f"{_feature_base()} SELECT symbol, open_time, TRUE AS equal FROM feats WHERE {complete_where()}"


def q_stream_end_to_end(delay_ms: int = 600_000) -> str:
    """Candles of the minutes whose end the watermark has passed, and their features."""
    candles = f"""
candles AS (
  SELECT symbol, {_bucket('open_time * 1000', 30 * 60_000)} AS open_time,
         arg_min(open, open_time) AS open, max(high) AS high, min(low) AS low, arg_max(close, open_time) AS close,
         sum(volume) AS volume, CAST(sum(number_of_trades) AS BIGINT) AS number_of_trades,
         sum(taker_buy_quote_asset_volume) AS taker_buy_quote_asset_volume
  FROM c1, (SELECT max(open_time) - {delay_ms} AS w FROM c1) GROUP BY 1, 2
  HAVING {_bucket('min(open_time) * 1000', 30 * 60_000)} + 1800000 <= any_value(w))"""
    return q_stream_features().replace(candles_cte(), candles_cte(1, "c1") + "," + candles, 1)
