"""Quality classifier by compression.

Two zstandard dictionaries are trained, one on texts labelled good (1), one on
texts labelled bad (0). A text is cut into pieces of ``PIECE`` bytes, all of
them, and each piece is compressed with either dictionary: text that resembles
good text shrinks more with the good one. The normalised difference of the two
total sizes, and how far the better of them lies below the plain size (which
gives endless repetition away), become a probability by a logistic curve fitted
on labelled rows that the dictionaries have not seen.

Training reads a bounded sample of the labelled rows (``PER_CLASS`` rows a
class, the ones with the smallest hash of their id). The dictionaries learn from
pieces of their texts, ``SAMPLE_BYTES`` of each in pieces spread by hash over the whole
text; the curve is fitted on the sizes of whole texts, computed in Spark; scoring reads
every text whole. Both dictionaries (``DICT_BYTES`` each) travel
to the tasks inside the scoring function.

Defined cases: a null or empty text has sizes that don't differ and gets the
curve's value there; rows whose label is null are not learnt from, of several labels for one
id the largest holds; equal texts get equal scores; an empty table gives an
empty result; with no rows of one class every score is 0.5 (kept by any
threshold up to a half). Further columns of the input stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import small_batches, text_bytes

PIECE = 1024
LEVEL = 3
DICT_BYTES = 65536
PER_CLASS = 3000
SAMPLE_BYTES = 8192
THRESHOLD = 0.3
FOLDS = 5


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null id: fold 0)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


@dataclass(frozen=True)
class CompressionModel:
    good: bytes | None
    bad: bytes | None
    curve: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)

    def differences(self, texts) -> np.ndarray:
        """A row a text: (bad size - good size) / (bad size + good size) over all
        pieces, the logarithm of the smaller size over the plain one, its square."""
        out = np.zeros((len(texts), 3))
        if self.good is None or self.bad is None:
            return out
        good, bad = compressor(self.good), compressor(self.bad)
        for i, t in enumerate(texts):
            a = b = 0
            for k in range(0, len(t), PIECE):
                piece = t[k:k + PIECE]
                a += len(good.compress(piece))
                b += len(bad.compress(piece))
            if a + b:
                out[i, :2] = (b - a) / (b + a), np.log(min(a, b) / len(t))
        out[:, 2] = out[:, 1] ** 2
        return out

    def scores(self, texts) -> np.ndarray:
        x = np.column_stack([self.differences(texts), np.ones(len(texts))])
        return 1.0 / (1.0 + np.exp(-np.clip(x @ np.array(self.curve), -40, 40)))


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(content)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=d, write_checksum=False, write_content_size=False,
                                    write_dict_id=False)


def dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; where there is too little text to train on, the
    text itself serves (zstandard takes plain content as well)."""
    pieces = [t[k:k + PIECE] for t in texts for k in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICT_BYTES:]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, ...]:
    """Platt's fit: Newton steps with his smoothed targets and a small ridge, so
    separable classes keep a finite slope. ``weight`` restores the class shares
    that the balanced sample has changed."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = np.append(np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0), 1.0)
    z = np.column_stack([x, np.ones(len(x))]) / scale
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        grad = z.T @ (weight * (p - target)) + 1e-3 * w
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w / scale)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> CompressionModel:
    """Learn from rows of ``labels`` outside the held-out fold 0."""
    marked = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
              .where("_id IS NOT NULL AND _y IN (0, 1)").where(fold(F.col("_id")) != 0)
              .groupBy("_id").agg(F.max("_y").alias("_y")))
    order = F.xxhash64(F.col("_id").cast("string"))
    few = [marked.where(F.col("_y") == y).orderBy(order, "_id").limit(per_class) for y in (0, 1)]
    chosen = few[0].unionByName(few[1])
    # at most 2 * per_class ids: broadcast, the documents are not shuffled
    rows = docs.select(F.col(id_col).alias("_id"), text_bytes(F.col(text_col)).alias("_t")).where("length(_t) > 0").join(
        F.broadcast(chosen), "_id")
    pieces = (rows.groupBy("_id", "_y").agg(F.min(spread_pieces(F.col("_t"), F.col("_id").cast("string"))).alias("_p"))
              .orderBy(F.xxhash64(F.col("_id").cast("string")), "_id").collect())
    learnt = {y: [r for r in pieces if r["_y"] == y] for y in (0, 1)}
    if min(map(len, learnt.values())) < 2:
        return CompressionModel(None, None)
    # even rows make the dictionaries, odd rows the curve
    model = CompressionModel(*(dictionary([bytes(r["_p"]) for r in learnt[y][::2]]) for y in (1, 0)))
    held = [r["_id"] for y in (0, 1) for r in learnt[y][1::2]]
    x = whole_differences(rows.where(F.col("_id").isin(held)), model)
    y = np.array([0] * len(learnt[0][1::2]) + [1] * len(learnt[1][1::2]))
    total = {r["_y"]: r["n"] for r in marked.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    share = np.array([total[0], total[1]]) / np.bincount(y, minlength=2)
    return CompressionModel(model.good, model.bad,
                            logistic(np.array([x[i] for i in held]), y, share[y] / share[y].mean()))


def spread_pieces(text: Column, key: Column) -> Column:
    """At most ``SAMPLE_BYTES`` of a text in pieces of ``PIECE`` bytes from all over it: those of
    least hash, in their order (a shorter text whole)."""
    n = F.greatest(F.ceil(F.octet_length(text) / PIECE), F.lit(1)).cast("int")
    ranked = F.array_sort(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.xxhash64(key, i).alias("h"), i.alias("i"))))
    chosen = F.array_sort(F.transform(F.slice(ranked, 1, SAMPLE_BYTES // PIECE), lambda p: p["i"]))
    return F.aggregate(chosen, F.lit(b""), lambda done, i: F.concat(done, F.substring(text, i * PIECE + 1, F.lit(PIECE))))


def whole_differences(rows: DataFrame, model: CompressionModel) -> dict:
    """``_id`` -> the curve's numbers of the whole text (of repeated ids the least)."""
    @F.pandas_udf("array<double>")
    def numbers(texts: pd.Series) -> pd.Series:
        return pd.Series(list(model.differences(texts.tolist())))

    found = small_batches(rows).select("_id", numbers(F.col("_t")).alias("x")).groupBy("_id").agg(F.min("x").alias("x"))
    return {r["_id"]: r["x"] for r in found.collect()}      # at most PER_CLASS rows


def score(docs: DataFrame, model: CompressionModel, text_col: str = "text",
          score_col: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is good."""
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()))

    return small_batches(docs).withColumn(score_col, scored(text_bytes(F.col(text_col))))
