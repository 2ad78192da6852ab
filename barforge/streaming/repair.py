"""Rows that late candles move, recomputed from the stored candles (STR-1, STR-8).

The live job carries the newest candles of each symbol. A candle below them (new,
or a later version of a stored one) changes its own row and the ``LOOKBACK`` rows
that follow it; a changed candle near the tail's lower end changes rows whose
lookback has left the tail. Both kinds are *seeds* here. Their neighbourhoods are
read from the candles the job has stored and only those rows are computed again, by
the batch operators.

A neighbourhood is the chunks of time at a seed and beside it, so finding it is an
equi-join on (symbol, chunk); adjacent chunks of a symbol are one stretch, and a
stretch is a symbol of its own for the feature windows. Where candles are sparse
and a seed lacks rows on either side, its chunks are widened ``WIDER`` times and
looked up again, until they hold all there is. The work follows the number of
seeds, which the source's rate limit bounds, and not the length of the history;
the time range of the seeds is a literal filter on the stored files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.time import floor_to
from barforge.operators.features import add_features, next_candle_label
from barforge.schema import CANDLE_COLUMNS, CANDLE_MINUTES, FEATURES, LOOKBACK
from barforge.session import cut_lineage

KEY = ["symbol", "open_time"]
VALUES = CANDLE_COLUMNS[2:]
#: time on either side of a seed that is looked up first: four lookbacks of gapless candles
REACH_MS = 4 * LOOKBACK * CANDLE_MINUTES * 60_000
WIDER = 32


def candle_state(stored: DataFrame, current: DataFrame) -> DataFrame:
    """One row a candle: KEY, VALUES and ``spread`` (NULL: no seed; 0: only its own
    row is wanted; 1: its followers too). ``stored``: candles below the tail with
    ``version``, ``seq`` and ``spread``; the later version wins, of equal ones the later
    batch, then the larger values. ``current``: the tail's, which are merged already."""
    best = stored.groupBy(*KEY).agg(F.max(F.struct("version", "seq", *VALUES)).alias("w"), F.max("spread").alias("spread"))
    merged = best.select(*KEY, *[F.col(f"w.{v}").alias(v) for v in VALUES], "spread")
    return merged.unionByName(current.select(*KEY, *VALUES, "spread"))


def chunk_of(width: int):
    return (floor_to(F.col("open_time"), width) / F.lit(width)).cast("long")


def neighbourhood(state: DataFrame, seeds: DataFrame, width: int) -> DataFrame:
    """The rows of ``state`` in the chunks at and beside each seed, by ``stretch``: with
    the next candle, whether a seed's surroundings are complete (``whole``), and
    whether the row (``wanted``) or its outcome (``answered``) is to be computed."""
    lo, hi = seeds.agg(F.min("open_time"), F.max("open_time")).first()
    chunks = seeds.select("symbol", F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: chunk_of(width) + d))
                          .alias("_chunk")).distinct()
    run = Window.partitionBy("symbol").orderBy("_chunk")
    chunks = chunks.withColumn("stretch", F.col("_chunk") - F.row_number().over(run))
    near = state.filter(F.col("open_time").between(lo - 2 * width, hi + 2 * width)).withColumn("_chunk", chunk_of(width))
    rows = near.join(chunks, ["symbol", "_chunk"]).join(seeds.select(*KEY, F.lit(True).alias("_asked")), KEY, "left")
    w = Window.partitionBy("symbol", "stretch").orderBy("open_time")
    everything = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place, count = F.row_number().over(w), F.count(F.lit(1)).over(everything)
    seed = F.col("_asked") & F.col("spread").isNotNull()
    rows = rows.select("*", (seed & (place > LOOKBACK) & ((F.col("spread") == 0) | (count - place >= LOOKBACK))).alias("whole"),
                       F.lead("close").over(w).alias("_next_close"))
    return rows.withColumn("seed", F.coalesce(seed, F.lit(False))).drop("_asked")


def targets(rows: DataFrame) -> DataFrame:
    """``rows`` with ``wanted`` and ``answered``, from the seeds marked ``whole``."""
    w = Window.partitionBy("symbol", "stretch").orderBy("open_time")
    own = F.coalesce(F.col("whole"), F.lit(False))
    spreads = (own & (F.col("spread") == 1)).cast("int")
    return rows.select("*", (own | (F.max(spreads).over(w.rowsBetween(-LOOKBACK, 0)) == 1)).alias("wanted"),
                       (F.col("_next_close").isNotNull() & (F.max(own.cast("int")).over(w.rowsBetween(0, 1)) == 1)).alias("answered"))


def recompute(state: DataFrame, reach_ms: int = REACH_MS) -> tuple[DataFrame, DataFrame]:
    """``(features, outcomes)`` of the rows that the seeds in ``state`` move, stored."""
    pending, width, span = state.filter(F.col("spread").isNotNull()).select(*KEY), reach_ms, None
    rounds: list[DataFrame] = []
    while True:
        rows = cut_lineage(neighbourhood(state, pending, width))
        short = rows.filter("seed AND NOT whole").select(*KEY)
        if short.isEmpty():
            rounds.append(rows)
            break
        if span is None:
            lo, hi = state.agg(F.min("open_time"), F.max("open_time")).first()
            span = hi - lo + 1
        if width >= span:      # the chunks hold all there is
            rounds.append(rows.withColumn("whole", F.col("seed")))
            break
        rounds.append(rows)
        pending, width = short, width * WIDER
    # the stretches of each round are apart; a row that follows seeds of two rounds is computed alike
    named = None
    for i, rows in enumerate(rounds):
        one = rows.withColumn("stretch", F.concat_ws(".", F.lit(str(i)), F.col("stretch").cast("string")))
        named = one if named is None else named.unionByName(one)
    feats, outs = (cut_lineage(x.dropDuplicates(KEY)) for x in computed(targets(named)))
    return feats, outs


def computed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features of the wanted rows and outcomes of the answered ones; every stretch
    is a symbol of its own for the feature windows."""
    name = F.concat("stretch", F.lit(":"), "symbol").alias("symbol")
    own = F.expr("substring(symbol, locate(':', symbol) + 1)").alias("symbol")
    made = add_features(rows.select(name, *CANDLE_COLUMNS[1:]), label=False, split=False).join(
        rows.filter("wanted").select(name, "open_time"), KEY, "left_semi")
    said = rows.filter("answered").select(*KEY, next_candle_label(F.col("close"), F.col("_next_close")).alias("actual_label"))
    return made.select(own, "open_time", "close", *FEATURES), said
