"""Compression classifier: held-out ranking, and the defined cases."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from barforge.llm import quality as q
from barforge.llm import queries
from tests.conftest import MEDIUM

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score int"


def auc(score, y):
    order = np.argsort(np.argsort(score, kind="stable")) + 1
    n1 = y.sum()
    return (order[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_query_ranks_the_held_out_rows(spark):
    out = queries.QUERIES["op10_quality"](spark, MEDIUM)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(spark.read.parquet(f"{MEDIUM}/labels.parquet"), "doc_id").collect()
    for r in out.collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in rows if r["held_out"]]
    assert auc(np.array([r["score"] for r in held]), np.array([r["quality"] for r in held])) > 0.9


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(q.fold(F.col("doc_id")) == 0, 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    assert q.fit(docs, labels) == q.fit(docs, flipped) == q.fit(docs.repartition(7), labels.repartition(3))


def test_nulls_empties_long_texts_ties_and_clashing_columns(spark):
    good, bad = "the cat sat on the mat and was warm ", "XX!! $$$ ### YY!! "
    rows = [(i, (good if i % 2 else bad) * (i % 7 + 1), "en", None, None, 5) for i in range(120)]
    rows += [(500, None, None, None, None, 1), (501, "", None, None, None, 1), (None, good, None, None, None, 1),
             (502, good * 20000, None, None, None, 1), (1, good * 2, "en", None, None, 5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)] + [(3, None), (None, 1), (1, 1)],
                                   "doc_id long, quality int")
    model = q.fit(docs, labels)
    out = q.score(docs, model, score_col="p").collect()
    assert len(out) == len(rows) and all(0 <= r["p"] <= 1 and r["score"] is not None for r in out)
    by = {r["doc_id"]: r["p"] for r in out}
    assert by[500] == by[501]
    assert by[502] > 0.5 and min(by[i] for i in range(1, 120, 2)) > max(by[i] for i in range(0, 120, 2))


def test_one_class_or_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5, 0)], SCHEMA)
    model = q.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert [r["p"] for r in q.score(docs, model, score_col="p").collect()] == [0.5]
    assert q.score(docs.limit(0), model, score_col="p").count() == 0
    assert q.fit(docs.limit(0), spark.createDataFrame([], "doc_id long, quality int")).good is None


def test_texts_that_turn_bad_after_a_good_beginning(spark):
    """What tells the classes apart lies behind the first 8 KB of every labelled text."""
    good, bad = "the cat sat on the mat and was warm and dry ", "XX!! $$$ ### YY!! zz%% "
    rows = [(i, good * 220 + ((good if i % 2 else bad) * 400)[:6000 + i], "en", None, None, 0) for i in range(80)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    out = q.score(docs, q.fit(docs, labels), score_col="p").collect()
    held = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert auc(np.array([r["p"] for r in held]), np.array([r["doc_id"] % 2 for r in held])) == 1.0


def test_equals_a_plain_recomputation(spark):
    """Rows, pieces, dictionaries, curve and scores again, without Spark."""
    import xxhash
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def order(i):
        return signed(xxhash.xxh64(str(i).encode(), seed=42).intdigest()), i

    def pieces(i):
        t, seed = docs[i], xxhash.xxh64(str(i).encode(), seed=42).intdigest()
        at = sorted(range(max(-(-len(t) // 1024), 1)), key=lambda k: (signed(xxhash.xxh64(k.to_bytes(4, "little"), seed=seed).intdigest()), k))[:8]
        return b"".join(t[k * 1024:k * 1024 + 1024] for k in sorted(at))

    learnt = {y: sorted((i for i, v in labels.items() if v == y and docs.get(i) and zlib.crc32(str(i).encode()) % 5), key=order)[:q.PER_CLASS]
              for y in (0, 1)}
    model = q.CompressionModel(*(q.dictionary([pieces(i) for i in learnt[y][::2]]) for y in (1, 0)))
    held = [i for y in (0, 1) for i in learnt[y][1::2]]
    y = np.array([labels[i] for i in held])
    total = np.array([sum(v == c and zlib.crc32(str(i).encode()) % 5 > 0 for i, v in labels.items()) for c in (0, 1)])
    share = total / np.bincount(y, minlength=2)
    model = q.CompressionModel(model.good, model.bad, q.logistic(model.differences([docs[i] for i in held]), y, share[y] / share[y].mean()))
    want = dict(zip(docs, model.scores(list(docs.values()))))
    got = {r["doc_id"]: r["score"] for r in queries.QUERIES["op10_quality"](spark, MEDIUM).collect()}
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in got) < 1e-9
    assert any(len(t) > 8192 for t in docs.values())
