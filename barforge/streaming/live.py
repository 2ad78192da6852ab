"""Live scoring: candle stream -> tail and batch -> features -> stacked score.

    records ──route/closed──► candle table (append) ──readStream──► micro-batch
        ──► (stored tail ∪ batch) ──► add_features ──► score ──► tables (append)

Every micro-batch joins the last ``TAIL`` candles of each symbol, kept as a small
table in the query's folder, with the arriving ones and runs the batch
operators on both: the same ``add_features`` and the same label rule. A candle
that is new, late, out of order or corrected changes every row from its place
on, and exactly those are written again with a higher ``seq`` (the batch id);
``predictions`` / ``outcomes`` / the prediction log are views that take the
newest. Of two versions of one candle the later ``ingested_at`` wins, of equal
stamps the one that arrived last, of equal ones in a batch the larger values.

Candles that leave the tail go to the ``history`` table. An arrival below the tail
goes there too, and to the ``late`` table with its values; the rows it moves, like
those whose lookback has left the tail, are computed again in the same batch from
history and tail (``streaming.repair``): after every batch the newest
rows equal what the batch operators make of all candles arrived so far. The tail of
batch n is written to slot ``n % 3`` and read from slot ``(n - 1) % 3``, and stored
tables are read as of the batches before, so a batch replayed after a failure
reads and writes the same files.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barforge.operators.features import add_features, next_candle_label
from barforge.operators.outcomes import prediction_log
from barforge.plans import stack as st
from barforge.schema import CANDLE_COLUMNS, FEATURES, LOOKBACK, WINDOW_SIZE
from barforge.streaming.repair import candle_state, recompute
from barforge.streaming.tables import compact, newest, read_table, write_batch

VALUES = CANDLE_COLUMNS[2:]
KEY = ["symbol", "open_time"]
TAIL = 2 * WINDOW_SIZE


def versioned(candles: DataFrame) -> DataFrame:
    """Candle columns and ``version``, the arrival stamp in microseconds (0 without one)."""
    stamp = (F.coalesce(F.unix_micros(F.to_timestamp("ingested_at")), F.lit(0)) if "ingested_at" in candles.columns
             else F.lit(0)).cast("long")
    return candles.select(*[F.col(c).cast("long").alias(c) if c == "number_of_trades" else F.col(c)
                            for c in CANDLE_COLUMNS], stamp.alias("version"))


def merge(batch: DataFrame, tail: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(candles, late): tail and batch with one version a candle, flags ``changed``
    and ``known`` and the symbol's ``floor`` (the oldest candle kept, once any was
    let go); and the arrivals below the floor."""
    new = versioned(batch).withColumn("fresh", F.lit(1))
    if tail is None:
        rows, late = new.withColumn("floor", F.lit(None).cast("long")), new.limit(0)
    else:
        floors = tail.groupBy("symbol").agg(F.max("floor").alias("floor"))
        placed = new.join(floors, "symbol", "left")
        below = F.coalesce(F.col("open_time") < F.col("floor"), F.lit(False))
        late = placed.filter(below)
        rows = placed.filter(~below).unionByName(tail.withColumn("fresh", F.lit(0)))
    values = F.struct(*VALUES)
    best = rows.groupBy(*KEY).agg(
        F.max(F.struct("version", "fresh", *VALUES)).alias("w"),
        F.max(F.when(F.col("fresh") == 0, values)).alias("old"), F.max("floor").alias("floor"))
    now = F.struct(*[F.col(f"w.{v}").alias(v) for v in VALUES])
    return best.select(*KEY, *[F.col(f"w.{v}").alias(v) for v in VALUES], F.col("w.version").alias("version"),
                       F.col("old").isNotNull().alias("known"),
                       ((F.col("w.fresh") == 1) & ~now.eqNullSafe(F.col("old"))).alias("changed"), "floor"), late


def affected(candles: DataFrame) -> DataFrame:
    """``candles`` with their place among the symbol's, the next candle, and whether
    a change lies at or before them (``moved``) or at the next one (``answered``)."""
    w = Window.partitionBy("symbol").orderBy("open_time")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.min(F.when(F.col("changed"), F.col("open_time"))).over(whole)
    out = candles.select("*", first.alias("_first"), F.lead("open_time").over(w).alias("_next_time"),
                         F.lead("close").over(w).alias("_next_close"), F.row_number().over(w).alias("_place"),
                         F.count(F.lit(1)).over(whole).alias("_count"), F.max("floor").over(whole).alias("_floor"))
    return out.select("*", F.coalesce(F.col("open_time") >= F.col("_first"), F.lit(False)).alias("moved"),
                      F.coalesce(F.col("_next_time") >= F.col("_first"), F.lit(False)).alias("answered"))


def outcomes_of(rows: DataFrame) -> DataFrame:
    """Outcome of each candle whose next one is known and new, or moved."""
    return rows.filter("answered").select(*KEY, next_candle_label(F.col("close"), F.col("_next_close")).alias("actual_label"))


def features_of(rows: DataFrame) -> DataFrame:
    """Features of every moved candle with a full lookback, by the batch operator."""
    feats = add_features(rows, label=False, split=False).select(*KEY, "close", *FEATURES)
    kinds = rows.filter("moved").select(*KEY, F.when(F.col("known"), "update").otherwise("window").alias("kind"))
    return feats.join(kinds, KEY).select(*KEY, "kind", "close", *FEATURES)


def without_lookback(rows: DataFrame) -> DataFrame:
    """Moved candles whose lookback has left the tail."""
    return rows.filter(F.col("moved") & F.col("_floor").isNotNull() & (F.col("_place") <= LOOKBACK))


def late_rows(late: DataFrame, rows: DataFrame) -> DataFrame:
    """The seeds of a repair, with their values: arrivals below the tail, and rows
    of the tail without their lookback."""
    return late.select(*KEY, *VALUES, "version", F.lit("below").alias("reason")).unionByName(
        without_lookback(rows).select(*KEY, *VALUES, "version", F.lit("lookback").alias("reason")))


def repaired(root: str, batch_id: int, seeds: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(features, outcomes)`` of the rows that ``seeds`` move and the tail cannot give."""
    below = seeds.filter("reason = 'below'").select(*KEY, *VALUES, "version", F.lit(batch_id).cast("long").alias("seq"),
                                                    F.lit(1).alias("spread"))
    before = read_table(rows.sparkSession, root, "history", batch_id)
    stored = below if before is None else below.unionByName(
        before.select(*KEY, *VALUES, "version", "seq", F.lit(None).cast("int").alias("spread")))
    marks = seeds.filter("reason = 'lookback'").select(*KEY, F.lit(0).alias("spread"))
    feats, outs = recompute(candle_state(stored, rows.join(marks, KEY, "left")))
    # the tail's own rows of this batch are written already
    theirs = rows.filter(F.col("moved") & (F.col("_floor").isNull() | (F.col("_place") > LOOKBACK))).select(*KEY)
    return (feats.join(theirs, KEY, "left_anti").select(*KEY, F.lit("repair").alias("kind"), "close", *FEATURES),
            outs.join(rows.filter("answered").select(*KEY), KEY, "left_anti"))


def tail_of(rows: DataFrame, size: int) -> DataFrame:
    kept = F.col("_place") > F.col("_count") - size
    cut = F.when((F.col("_count") > size) | F.col("_floor").isNotNull(), F.min(F.when(kept, F.col("open_time"))).over(
        Window.partitionBy("symbol")))
    return rows.withColumn("_cut", cut).filter(kept).select(*KEY, *VALUES, "version", F.col("_cut").alias("floor"))


def below_the_tail(rows: DataFrame, seeds: DataFrame, size: int) -> DataFrame:
    """What history gains: the candles that the tail lets go, and arrivals below it."""
    gone = rows.filter(F.col("_place") <= F.col("_count") - size)
    return gone.select(*KEY, *VALUES, "version").unionByName(
        seeds.filter("reason = 'below'").select(*KEY, *VALUES, "version"))


def _started(writer, spark, state_partitions: int | None) -> StreamingQuery:
    """Start ``writer``; with ``state_partitions`` the query's state store gets
    that many partitions (a streaming query copies the session conf when it
    starts, and the number is then fixed in its checkpoint). The session's own
    setting is restored at once."""
    if state_partitions is None:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)


#: the tables and what makes a row of a key the newest
TABLES = {"predictions": ("seq",), "outcomes": ("seq",), "history": ("version", "seq"), "late": ("version", "seq")}


def start_live(candles: DataFrame, root: str, checkpoint: str, model: PipelineModel | None = None,
               trigger: dict | None = None, name: str | None = None,
               state_partitions: int | None = None, tail: int = TAIL, compact_every: int = 0) -> StreamingQuery:
    """Run the live job, writing append-only tables under ``root`` (SNK-1, SNK-2,
    STR-4..6, STR-8): ``predictions`` (features and, with a model, final_prob /
    prediction), ``outcomes``, ``late`` and ``history``, each batch in its
    ``batch=<id>`` folder with overwrite. ``tail`` candles of each symbol are
    carried over; ``compact_every`` batches (0: never) the folders before the
    batch are folded into a snapshot. The source's rate limit bounds a micro-batch."""
    if tail < WINDOW_SIZE:
        raise ValueError("the tail must hold a whole window")

    def scored(feats: DataFrame) -> DataFrame:
        return (st.score(model, feats, keep=("close", "kind")).withColumnRenamed("prob_up", "final_prob")
                if model is not None else feats)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = spark.read.parquet(f"{root}/tail/slot={(batch_id - 1) % 3}") if batch_id else None
        merged, late = merge(batch, kept)
        rows = affected(merged).persist()
        feats = features_of(rows).persist()
        seeds = late_rows(late, rows).persist()
        try:
            # scored from the stored rows: the formulas are not planned again
            predictions, outcomes = scored(feats), outcomes_of(rows)
            if not seeds.isEmpty():
                more, answers = repaired(root, batch_id, seeds, rows)
                predictions = predictions.unionByName(scored(more))
                outcomes = outcomes.unionByName(answers)
            for table, df in zip(TABLES, (predictions, outcomes, below_the_tail(rows, seeds, tail), seeds)):
                write_batch(df, root, table, batch_id)
            tail_of(rows, tail).write.mode("overwrite").parquet(f"{root}/tail/slot={batch_id % 3}")
            if compact_every and batch_id and batch_id % compact_every == 0:
                for table, order in TABLES.items():
                    compact(spark, root, table, batch_id - 1, order)
        finally:
            seeds.unpersist()
            feats.unpersist()
            rows.unpersist()

    w = (candles.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"processingTime": "10 seconds"})))
    if name:
        w = w.queryName(name)
    return _started(w, candles.sparkSession, state_partitions)


def start(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
          name: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Append ``df`` to a parquet table with a checkpoint (candle table, etc.)."""
    w = (df.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(**(trigger or {"processingTime": "10 seconds"})))
    if name:
        w = w.queryName(name)
    return _started(w, df.sparkSession, state_partitions)


def log_view(predictions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Prediction log over the append-only tables; the newest version per key wins."""
    return prediction_log(newest(predictions.select(*KEY, "close", "final_prob", "prediction", "seq")),
                          newest(outcomes.select(*KEY, "actual_label", "seq")))
