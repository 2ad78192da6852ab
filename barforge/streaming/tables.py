"""The live job's append-only tables: one ``batch=<id>`` folder a micro-batch,
rewritten on replay, and now and then a snapshot in their place.

``compact`` folds the folders up to a batch, together with the snapshot before,
into ``<table>.snapshot/upto=<batch>``: one row a key, the newest. A reader takes
the newest finished snapshot and the folders after it, so the files it opens do not
depend on how many batches there were. ``vacuum`` removes the folders and
snapshots that the newest one has replaced. Only batches that can no longer be
replayed may be folded: those before the newest one written. A folder counts once it
holds the ``_SUCCESS`` file that Spark's writers leave by default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = ["symbol", "open_time"]


def _listed(spark: SparkSession, folder: str, prefix: str) -> dict[int, str]:
    """number -> path of the finished ``prefix=<number>`` folders (one listing)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{prefix}=*/_SUCCESS")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath().getParent() for s in (fs.globStatus(path) or [])]
    return {int(p.getName().split("=")[1]): p.toString() for p in found}


def write_batch(df: DataFrame, root: str, table: str, batch: int) -> None:
    """``df`` as the table's part of this batch, with ``seq`` = the batch."""
    df.withColumn("seq", F.lit(batch).cast("long")).write.mode("overwrite").parquet(f"{root}/{table}/batch={batch}")


def sources(spark: SparkSession, root: str, table: str, before: int | None = None) -> list[str]:
    """The folders that hold the table (as of the batches below ``before``)."""
    snapshots = _listed(spark, f"{root}/{table}.snapshot", "upto")
    upto = max((n for n in snapshots if before is None or n < before), default=-1)
    batches = _listed(spark, f"{root}/{table}", "batch")
    return ([snapshots[upto]] if upto >= 0 else []) + [
        p for n, p in sorted(batches.items()) if n > upto and (before is None or n < before)]


def read_table(spark: SparkSession, root: str, table: str, before: int | None = None) -> DataFrame | None:
    """The table's rows, or None while it has no folder."""
    paths = sources(spark, root, table, before)
    return spark.read.parquet(*paths) if paths else None


def newest(table: DataFrame) -> DataFrame:
    """The newest version of every key (one row a key and batch)."""
    rest = [c for c in table.columns if c not in (*KEY, "seq", "batch")]
    best = table.groupBy(*KEY).agg(F.max_by(F.struct(*rest), "seq").alias("v"))
    return best.select(*KEY, *[F.col(f"v.{c}").alias(c) for c in rest])


def compact(spark: SparkSession, root: str, table: str, through: int | None = None,
            order: tuple[str, ...] = ("seq",)) -> int | None:
    """Write the snapshot up to batch ``through`` (default: all but the newest batch);
    its number, or None if there is nothing new to fold. Of a key the row that is
    greatest in ``order`` stays, of equal ones the one with the larger values. Readers that
    have listed their files already go on with those."""
    batches = sorted(_listed(spark, f"{root}/{table}", "batch"))
    if through is None:
        through = batches[-2] if len(batches) > 1 else -1
    done = max(_listed(spark, f"{root}/{table}.snapshot", "upto"), default=-1)
    if not any(done < n <= through for n in batches):
        return None
    rows = read_table(spark, root, table, through + 1)
    rest = [c for c in rows.columns if c not in (*KEY, *order)]
    best = rows.groupBy(*KEY).agg(F.max(F.struct(*order, *rest)).alias("v"))
    best.select(*KEY, *[F.col(f"v.{c}").alias(c) for c in rows.columns if c not in KEY]).write.mode("overwrite").parquet(
        f"{root}/{table}.snapshot/upto={through}")
    return through


def vacuum(spark: SparkSession, root: str, table: str) -> int:
    """Remove the batch folders and older snapshots that the newest finished snapshot
    holds; the number of folders removed. For the job's own folders only, when no
    reader works on files listed before that snapshot."""
    snapshots = _listed(spark, f"{root}/{table}.snapshot", "upto")
    upto = max(snapshots, default=-1)
    old = [p for n, p in snapshots.items() if n < upto]
    old += [p for n, p in _listed(spark, f"{root}/{table}", "batch").items() if n <= upto]
    for p in old:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(old)
