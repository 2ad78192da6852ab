"""Sharding along a Hilbert curve.

DataFrame functions only. Several metadata columns are quantised to ``2**BITS``
levels at quantiles of all rows (mergeable sketches; strings by the order of
their first bytes), the levels of a row give its place on a Hilbert curve, and
the rows, in curve order, are cut into runs: law ``rows``, run sizes differ by
one at most. Neighbours on the curve are neighbours in every dimension, so each
file spans a small box and ``manifest``'s minima and maxima prune files on any
of the columns.

The order is found without sorting everything in one place: rows are counted by
(curve cell, salt), running totals over cells are taken in three levels (groups
of cells, cells of a group, salts of a cell), each level's window holding at
most 1024 rows, and a row's number within its (cell, salt) completes its rank.
A cell that holds a third of all rows is split over ``SALTS`` salts.

Defined cases: a null is the lowest level of its dimension and a null text has
no bytes; ties on the curve follow the salt (a hash of id and text), then the
text's checksum, then the id; equal rows take neighbouring places in any order;
an empty table gives an empty result; further columns, whatever their names,
pass through ``ordered``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.common import evaluated, stored, text_bytes

BITS = 5
SALTS = 1024
SHARDS = 8
ACCURACY = 10000


def dimensions(docs: DataFrame) -> dict[str, Column]:
    return {"size": text_size(F.col("text")), "lang": F.coalesce(F.col("lang").cast("string"), F.lit("")),
            "source": F.coalesce(F.col("source").cast("string"), F.lit("")), "doc_id": F.col("doc_id").cast("long")}


def text_size(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long")


def text_cuts(rows: DataFrame, name: str, bits: int) -> list[str]:
    """The whole values that stand at the quantiles of a text column, exactly: rows are
    counted per distinct value, the counts sorted in blocks, and each quantile is looked up
    inside the one block that holds it."""
    counts = rows.groupBy(name).agg(F.count("*").alias("n"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = stored(counts.repartitionByRange(n, name).withColumn("block", F.spark_partition_id()), "value-counts")
    totals = blocks.groupBy("block").agg(F.sum("n").alias("n")).orderBy("block").collect()      # a row a partition
    total, done, wanted = sum(r["n"] for r in totals), 0, []
    for r in totals:
        wanted += [(r["block"], rank - done) for i in range(1, 1 << bits) if done <= (rank := total * i >> bits) < done + r["n"]]
        done += r["n"]
    if not wanted:
        return []
    upto = F.sum("n").over(Window.partitionBy("block").orderBy(name).rowsBetween(Window.unboundedPreceding, 0))
    inside = blocks.where(F.col("block").isin(sorted({b for b, _ in wanted}))).withColumn("upto", upto)
    hit = [(F.col("block") == b) & (F.col("upto") - F.col("n") <= r) & (F.lit(r) < F.col("upto")) for b, r in wanted]
    found = inside.select(name, F.explode(F.array(*hit)).alias("hit")).where("hit").orderBy(name)
    return [r[0] for r in found.collect()]      # a row a quantile


def level_cuts(rows: DataFrame, names: list[str], bits: int = BITS) -> dict[str, list]:
    """Quantiles of every dimension over all rows."""
    text = [n for n in names if rows.schema[n].dataType.typeName() == "string"]
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = [n for n in names if n not in text]
    got = rows.agg(F.lit(0), *[F.percentile_approx(n, shares, ACCURACY).alias(n) for n in numbers]).first()
    return {n: text_cuts(rows, n, bits) if n in text else list(got[n] or []) for n in names}


def level(value: Column, cuts: list) -> Column:
    """How many cuts lie below the value (null: none)."""
    if not cuts:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < value)), F.lit(0))


def hilbert(df: DataFrame, levels: list[Column], name: str, bits: int = BITS) -> DataFrame:
    """``df`` with the Hilbert index of the levels: Skilling's transform, one fold
    over (bit, axis), then Gray decoding and interleaving of the axes."""
    d = len(levels)
    steps = F.array(*[F.struct(F.lit(1 << q).alias("q"), F.lit(i).alias("i")) for q in range(bits - 1, 0, -1) for i in range(d)])

    def step(x: Column, s: Column) -> Column:
        low = s["q"] - 1
        own = F.get(x, s["i"])
        swap = F.get(x, F.lit(0)).bitwiseXOR(own).bitwiseAND(low)
        is_set = own.bitwiseAND(s["q"]) != 0
        return F.transform(x, lambda v, j: F.when(is_set, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
                           .when((j == 0) | (j == s["i"]), v.bitwiseXOR(swap)).otherwise(v))

    df = evaluated(df.withColumn(name, F.aggregate(steps, F.array(*[x.cast("int") for x in levels]), step)), name)
    axes = [F.get(F.col(name), F.lit(0))]
    for i in range(1, d):
        axes.append(axes[-1].bitwiseXOR(F.get(F.col(name), F.lit(i))))
    df = evaluated(df.withColumn(name, F.array(*axes)), name)
    last, turn = F.get(F.col(name), F.lit(d - 1)), F.lit(0)
    for q in range(bits - 1, 0, -1):
        turn = turn.bitwiseXOR(F.when(last.bitwiseAND(F.lit(1 << q)) != 0, (1 << q) - 1).otherwise(0))
    df = evaluated(df.withColumn(name, F.array(*[F.get(F.col(name), F.lit(i)).bitwiseXOR(turn) for i in range(d)])), name)
    index = F.lit(0).cast("long")
    for q in range(bits - 1, -1, -1):
        for i in range(d):
            index = index * 2 + F.shiftright(F.get(F.col(name), F.lit(i)), q).bitwiseAND(F.lit(1))
    return evaluated(df.withColumn(name, index.cast("long")), name)


def running_base(counts: DataFrame) -> DataFrame:
    """``(cell, salt, base)``: how many rows come before each (cell, salt)."""
    def before(*by: str):
        def over(order: str) -> Column:
            w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
            return F.coalesce(F.sum("n").over(w), F.lit(0))
        return over
    cells = counts.groupBy("cell").agg(F.sum("n").alias("n")).withColumn("grp", F.shiftright("cell", 10))
    # at most 2**(dimensions * bits - 10) groups stand in the one window without a key
    groups = cells.groupBy("grp").agg(F.sum("n").alias("n")).select(F.col("grp").alias("g"), before()("grp").alias("of_group"))
    cells = cells.select("grp", F.col("cell").alias("c"), before("grp")("cell").alias("of_cell"))
    cells = cells.join(groups, F.col("grp") == F.col("g")).select("c", (F.col("of_group") + F.col("of_cell")).alias("of_cell"))
    salts = counts.select("cell", "salt", before("cell")("salt").alias("of_salt"))
    return salts.join(cells, F.col("cell") == F.col("c")).select("cell", "salt", (F.col("of_cell") + F.col("of_salt")).alias("base"))


def shards(docs: DataFrame, n_shards: int = SHARDS, bits: int = BITS, dims: dict[str, Column] | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, size, crc, cell, shard, slot)``, a row for each row of ``docs``."""
    dims = dims or dimensions(docs)
    rows = stored(docs.select(F.col(id_col).alias("id"), text_size(F.col(text_col)).alias("size"),
                              F.crc32(text_bytes(F.col(text_col))).alias("crc"),
                              *[c.alias(f"d_{n}") for n, c in dims.items()]), "shard-rows")
    names = [f"d_{n}" for n in dims]
    cuts = level_cuts(rows, names, bits)
    placed = hilbert(rows, [level(F.col(n), cuts[n]) for n in names], "cell", bits).drop(*names)
    placed = stored(placed.withColumn("salt", F.pmod(F.xxhash64("id", "crc", "size"), F.lit(SALTS)).cast("int")), "shard-cells")
    base = running_base(placed.groupBy("cell", "salt").agg(F.count("*").alias("n"))).select(
        F.col("cell").alias("c"), F.col("salt").alias("s"), "base")
    total = placed.count()
    place = F.row_number().over(Window.partitionBy("cell", "salt").orderBy("crc", "id", "size"))
    ranked = (placed.join(base, (F.col("cell") == F.col("c")) & (F.col("salt") == F.col("s")))
              .select("id", "size", "crc", "cell", (F.col("base") + place - 1).alias("rank")))
    ranked = ranked.withColumn("shard", F.expr(f"CAST(rank * {n_shards} DIV {max(total, 1)} AS INT)"))
    first = F.expr(f"(shard * {max(total, 1)}L + {n_shards - 1}) DIV {n_shards}")
    return ranked.select("id", "size", "crc", "cell", "shard", (F.col("rank") - first).alias("slot"))


def manifest(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Minimum and maximum of the columns in each shard: what a reader prunes files by."""
    return rows.groupBy("shard").agg(F.count("*").alias("n"), *[f(c).alias(f"{c}_{f.__name__}") for c in columns for f in (F.min, F.max)])
