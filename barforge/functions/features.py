"""The candle feature formulas, written once over an accessor.

``L(column, k)`` returns the value of ``column`` k candles before the current
one (k = 0 is the current candle). Batch jobs pass a ``lag`` accessor over a
window; streaming jobs pass an array accessor over the live window state. Both
therefore compute the same expressions in the same order, bit for bit.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from barforge.schema import CANDLE_COLUMNS, FEATURES, LAGS, LOOKBACK

Accessor = Callable[[str, int], Column]

ATR_PERIOD = 10


def lag_accessor(window: WindowSpec) -> Accessor:
    """Batch accessor: ``lag(column, k)`` over an ordered window."""
    def at(name: str, k: int) -> Column:
        return F.col(name) if k == 0 else F.lag(name, k).over(window)
    return at


@lru_cache(maxsize=None)
def lags_used(lookback: int = LOOKBACK) -> list[tuple[str, int]]:
    """Every (column, k) the formulas read, found by running them once with a
    recording accessor."""
    seen: dict[tuple[str, int], None] = {}

    def record(name: str, k: int) -> Column:
        seen[(name, k)] = None
        return F.lit(None).cast("double")

    feature_columns(record, lookback)
    working_columns(record)
    for name, ks in dict(LAGS, close=tuple(range(1, lookback + 1))).items():
        for k in ks:
            record(name, k)
    return list(seen)


@lru_cache(maxsize=None)
def column_formulas(prefix: str = "_x_", lookback: int = LOOKBACK,
                    working: bool = False) -> dict[str, Column]:
    """The formulas over pre-projected lag columns, built once per process
    (they reference column names only, so they can be reused by any plan)."""
    L = column_accessor(prefix)
    return working_columns(L) if working else feature_columns(L, lookback)


def column_accessor(prefix: str = "_x_") -> Accessor:
    """Accessor over pre-projected columns ``{prefix}{column}_{k}``."""
    def at(name: str, k: int) -> Column:
        return F.col(f"{prefix}{name}_{k}")
    return at


def _ratio_to(c: Column, base: Column) -> Column:
    # (c - base) / base, and 0 when base is 0 or NULL (kept as in the original)
    return F.when(base != 0, (c - base) / base).otherwise(F.lit(0.0))


def _sma(L: Accessor, n: int) -> Column:
    return reduce(lambda a, b: a + b, [L("close", k) for k in range(1, n + 1)]) / F.lit(float(n))


def true_range(L: Accessor, j: int) -> Column:
    """True range of the candle j back; ``greatest`` skips NULL, so the first
    candle of a series has range high - low."""
    h, lo, prev_c = L("high", j), L("low", j), L("close", j + 1)
    return F.greatest(h - lo, F.abs(h - prev_c), F.abs(lo - prev_c))


def atr(L: Accessor, period: int = ATR_PERIOD) -> Column:
    """Mean true range of the ``period`` candles before the current one
    (current excluded); fewer are averaged near the start, NULL if none."""
    trs = [true_range(L, j) for j in range(1, period + 1)]
    total = reduce(lambda a, b: a + b, [F.coalesce(t, F.lit(0.0)) for t in trs])
    n = reduce(lambda a, b: a + b, [t.isNotNull().cast("int") for t in trs])
    return F.when(n > 0, total / n)


def volatility(L: Accessor) -> Column:
    """Root mean square of the last three close-to-close returns (no mean
    subtracted). A zero close gives NULL instead of an error."""
    def ret(k: int) -> Column:
        return F.try_divide(L("close", k) - L("close", k + 1), L("close", k + 1))
    return F.sqrt((F.pow(ret(1), 2) + F.pow(ret(2), 2) + F.pow(ret(3), 2)) / F.lit(3.0))


def feature_columns(L: Accessor, lookback: int = LOOKBACK) -> dict[str, Column]:
    """All lag columns and derived features, keyed by output name.

    Lags follow ``LAGS`` with close lags 1..lookback (lookback >= 20, since
    the 20-candle average reads close_lag20).
    """
    if lookback < 20:
        raise ValueError("lookback must be at least 20")
    out: dict[str, Column] = {}
    lags = dict(LAGS, close=tuple(range(1, lookback + 1)))
    for name, ks in lags.items():
        for k in ks:
            out[f"{name}_lag{k}"] = L(name, k)

    c, o, h, lo = L("close", 0), L("open", 0), L("high", 0), L("low", 0)
    out["body"] = c - o
    out["range"] = h - lo
    out["upper_wick"] = h - F.when(c > o, c).otherwise(o)
    out["lower_wick"] = F.when(c < o, c).otherwise(o) - lo
    out["price_to_sma5"] = _ratio_to(c, _sma(L, 5))
    out["price_to_sma10"] = _ratio_to(c, _sma(L, 10))
    sma20 = _sma(L, 20)
    out["price_to_sma20"] = _ratio_to(c, sma20)
    out["price_momentum"] = _ratio_to(c, L("close", 5))
    vol = volatility(L)
    out["bb_position"] = F.when(vol != 0, (c - sma20) / (F.lit(2.0) * vol)).otherwise(F.lit(0.0))
    out["atr_10"] = atr(L)
    return out


def working_columns(L: Accessor) -> dict[str, Column]:
    """Intermediate values (not model inputs, never part of the NULL test)."""
    return {
        "sma_5": _sma(L, 5), "sma_10": _sma(L, 10), "sma_20": _sma(L, 20),
        "volatility": volatility(L), "true_range": true_range(L, 0),
    }


def complete_row(columns: list[str], double_columns: set[str]) -> Column:
    """The ``dropna()`` test: no NULL in any column and no NaN in doubles."""
    conds = []
    for name in columns:
        cond = F.col(name).isNotNull()
        if name in double_columns:
            cond = cond & ~F.isnan(F.col(name))
        conds.append(cond)
    return reduce(lambda a, b: a & b, conds)


def feature_names(lookback: int = LOOKBACK) -> list[str]:
    """Names produced by ``feature_columns`` (lags first, then derived)."""
    lags = dict(LAGS, close=tuple(range(1, lookback + 1)))
    names = [f"{n}_lag{k}" for n, ks in lags.items() for k in ks]
    derived = ["body", "range", "upper_wick", "lower_wick", "price_to_sma5",
               "price_to_sma10", "price_to_sma20", "price_momentum", "bb_position", "atr_10"]
    return names + derived


assert set(FEATURES) <= set(feature_names()), "every model input is produced"
assert set(CANDLE_COLUMNS[2:]) >= {"open", "high", "low", "close"}
