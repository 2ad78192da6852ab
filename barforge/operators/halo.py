"""Exact ordered windows over split partitions ("halo" rows).

A window ``partitionBy(symbol).orderBy(time)`` sends a symbol's whole history
to one task; one symbol may hold a third of all rows. Instead we partition by
(symbol, chunk), where chunk is a coarse time bucket, and copy into each chunk
the ``back`` rows that precede it and the ``forward`` rows that follow it. Lags
up to ``back`` and leads up to ``forward`` computed per (symbol, chunk) then
equal those of the unsplit window for every original row, however uneven the
chunks are (empty or short chunks included).

How the borrowed rows are found without touching the full data twice more
than needed:

* tails = the last ``back`` rows of every (symbol, chunk) and heads = the
  first ``forward`` rows, each with ``row_number() <= n``, which Spark plans
  with a map-side group limit (at most n rows per chunk per task shuffle).
* The ``back`` rows before chunk c are exactly the ``back`` tail rows that
  precede c's first tail row in time order (a row among the last ``back``
  before c has fewer than ``back`` rows after it in its own chunk, so it is a
  tail row). Over the tails table, a row is borrowed by every chunk whose first
  tail row lies 1..back rows after it: a ``collect_list`` over a bounded row
  frame. Heads are handled the same way, mirrored.

The tails/heads tables hold at most ``back + forward`` rows per chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HALO = "_halo"


def with_halo(df: DataFrame, keys: list[str], order: str, chunk: str,
              back: int, forward: int = 0) -> DataFrame:
    """Return ``df`` plus borrowed rows (``_halo`` = true) for each chunk.

    ``order`` must be unique within ``keys`` and ``chunk`` non-decreasing in
    ``order``. Borrowed rows carry the chunk that borrows them in ``chunk``.
    """
    cols = df.columns
    others = [c for c in cols if c != chunk]
    parts = [df.withColumn(HALO, F.lit(False))]
    by_key = Window.partitionBy(*keys).orderBy(order)
    if back > 0:
        newest = Window.partitionBy(*keys, chunk).orderBy(F.col(order).desc())
        tails = (df.withColumn("_r", F.row_number().over(newest))
                 .filter(F.col("_r") <= back).drop("_r"))
        tails = tails.withColumn(
            "_starts", F.coalesce(F.lag(chunk).over(by_key) != F.col(chunk), F.lit(True)))
        tails = tails.withColumn(
            "_to", F.collect_list(F.when(F.col("_starts"), F.col(chunk)))
            .over(by_key.rowsBetween(1, back)))
        parts.append(tails.select(*others, F.explode("_to").alias(chunk))
                     .withColumn(HALO, F.lit(True)))
    if forward > 0:
        oldest = Window.partitionBy(*keys, chunk).orderBy(order)
        heads = (df.withColumn("_r", F.row_number().over(oldest))
                 .filter(F.col("_r") <= forward).drop("_r"))
        heads = heads.withColumn(
            "_ends", F.coalesce(F.lead(chunk).over(by_key) != F.col(chunk), F.lit(True)))
        heads = heads.withColumn(
            "_to", F.collect_list(F.when(F.col("_ends"), F.col(chunk)))
            .over(by_key.rowsBetween(-forward, -1)))
        parts.append(heads.select(*others, F.explode("_to").alias(chunk))
                     .withColumn(HALO, F.lit(True)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
