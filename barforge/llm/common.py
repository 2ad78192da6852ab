"""Helpers shared by the training-data operators: reading tables, shared scratch
tables, whole-text normalisation, and one connected-components job."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.session import checkpoint_root

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: the lineage is cut, a
    lost executor costs nothing, and the rows are computed once. With ``free`` the
    write's shuffle files go when it ends (``df`` itself must not be used again)."""
    path = shared_path(df.sparkSession, name)
    conf = df.sparkSession.conf
    before = conf.get(FREE)
    conf.set(FREE, str(free or before == "true").lower())
    try:
        df.write.parquet(path)
    finally:
        conf.set(FREE, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_BYTES, BATCH_ROWS = 4 << 20, 1000


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; its session hands Python tasks at most ``BATCH_BYTES`` of text at a
    time (a single longer text passes alone), so that a worker's memory follows
    the longest text and not the number of rows. A lower setting stays."""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
                      ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)):
        now = conf.get(key)
        if not now.rstrip("bB").isdigit() or not 0 < int(now.rstrip("bB")) <= most:
            conf.set(key, str(most))
    return df


def ascii_lower(text: Column) -> Column:
    """A-Z only; every other code point stays."""
    return F.translate(text, UPPER, LOWER)


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of the whole text (null: empty)."""
    return F.coalesce(text, F.lit("")).cast("binary")


def evaluated(df: DataFrame, name: str) -> DataFrame:
    """``df`` with column ``name`` computed once a row. Projections are merged and
    would repeat the expression wherever the column is used, inside a lambda even
    for each element; a generator of one row is not merged."""
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, F.explode(F.array(name)).alias(name))


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for edges ``(a, b)`` of longs; component = least node.

    Alternating star contraction (each round: every node links its larger
    neighbours to its least neighbour, then its smaller ones): O(log^2 n) rounds,
    rows never exceed the edges, each round is written to the shared folder.
    Neighbour minima are partial aggregates, so a node with very many
    neighbours costs one row per task; its edges are joined as skewed keys.
    """
    def star(e: DataFrame, both: bool) -> DataFrame:
        pairs = e.select("a", "b").where("a <> b")
        near = (pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if both
                else pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
        least = near.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        linked = near.join(least, near.a == least.k)
        moved = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if both else (
            linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(linked.select("a", F.col("m").alias("b"))))
        return moved.where("a <> b").distinct()

    current = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    while True:
        current = stored(star(star(current, True), False), "edges")
        now = current.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == before:
            break
        before = now
    # stars now: every node points at the least node of its component
    return (current.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component")))
            .distinct())
