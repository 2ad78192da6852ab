"""Hilbert sharding: the curve, the cut, pruning, edge rows, against a plain ordering."""

import zlib

from pyspark.sql import functions as F

from barforge.llm import queries
from barforge.llm import sharding as sd
from tests.conftest import MEDIUM


def test_curve_visits_every_cell_once_in_unit_steps(spark):
    for d, bits in ((2, 3), (3, 2), (4, 2)):
        n = 1 << bits
        cells = spark.range(n ** d).select(*[(F.floor(F.col("id") / n ** i) % n).cast("int").alias(f"x{i}") for i in range(d)])
        rows = sd.hilbert(cells, [F.col(f"x{i}") for i in range(d)], "h", bits).orderBy("h").collect()
        assert [r["h"] for r in rows] == list(range(n ** d))
        for a, b in zip(rows, rows[1:]):
            assert sum(abs(a[f"x{i}"] - b[f"x{i}"]) for i in range(d)) == 1


def test_query_cuts_the_curve_into_even_runs(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    rows = queries.QUERIES["op7_shards"](spark, MEDIUM).collect()
    assert {r["doc_id"] for r in rows} == set(docs) and len(rows) == len(docs)
    for r in rows:
        text = (docs[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 1, zlib.crc32(text), "rows", None)
    sizes = []
    for s in range(8):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
        sizes.append(len(slots))
    assert max(sizes) - min(sizes) <= 1
    out = sd.shards(spark.read.parquet(f"{MEDIUM}/documents.parquet")).collect()
    order = sorted(out, key=lambda r: (r["shard"], r["slot"]))
    assert [r["cell"] for r in order] == sorted(r["cell"] for r in order)


def test_shards_span_less_than_random_ones(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    two = {"size": sd.text_size(F.col("text")), "doc_id": F.col("doc_id")}
    m = sd.manifest(sd.shards(docs, 16, dims=two), ["size", "id"])
    span = m.agg(F.avg(F.col("id_max") - F.col("id_min"))).first()[0]
    assert m.count() == 16 and span < 0.5 * docs.count()


def test_edge_rows(spark):
    schema = "doc_id long, text string, lang string, source string, cell int, salt int, rank int"
    rows = [(1, None, None, None, 1, 1, 1), (None, "", "en", None, 1, 1, 1), (2, "é" * 50_000, "", "s", 0, 0, 0)] + [(3, "same", "en", "s", 0, 0, 0)] * 20
    docs = spark.createDataFrame(rows, schema)
    out = sd.shards(docs).collect()
    assert len(out) == len(rows) and sorted({r["size"] for r in out}) == [1, 5, 100_001]
    per = [sum(r["shard"] == s for r in out) for s in range(8)]
    assert sum(per) == 23 and max(per) - min(per) <= 1
    assert sd.shards(docs.limit(0)).count() == 0


def test_sources_with_a_long_common_beginning_are_pruned_apart(spark):
    """Whole values make the levels, in the order of the values."""
    names = [f"https://www.example.org/archive/{i:02d}/" for i in range(16)]
    rows = [(i, "t" * (i % 97), names[i % 16]) for i in range(3200)] + [(None, "x", None)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    source = F.coalesce("source", F.lit(""))
    cuts = sd.text_cuts(docs.select(source.alias("s")), "s", 4)
    values = sorted([n for _, _, n in rows if n] + [""] * 5)
    assert cuts == [values[len(values) * i >> 4] for i in range(1, 16)]
    out = sd.shards(docs, 8, dims={"source": source, "doc_id": F.col("doc_id")})
    own = out.join(docs.where("doc_id IS NOT NULL"), F.col("id") == F.col("doc_id")).groupBy("source").agg(F.count_distinct("shard").alias("n"))
    # a reader of one source opens few of the eight shards
    assert own.agg(F.avg("n")).first()[0] < 4
    assert sd.text_cuts(docs.limit(0).select(source.alias("s")), "s", 4) == []
