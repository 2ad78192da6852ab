"""Ranked lexical search: the best documents of each query, exactly.

A document's impact vector has one whole number a term, a query has one weight a
term, and the score is their inner product. Search follows LEMP: vectors are
ordered by length and cut into buckets; with a query's threshold, the score that
its last place holds already,

* a bucket whose longest vector times the query's length stays below the
  threshold is skipped (Cauchy-Schwarz);
* inside a bucket the query's heaviest coordinates are its focus: they are as many
  as are needed until the others together, by their largest values in the bucket
  or by their length, stay below the threshold, so a document without a focus
  coordinate cannot reach it and only the focus lists are read;
* a document found there stays if its partial sum and the bound of what is left
  of it (largest values, or the lengths of both rests) reach the threshold;
* the survivors are scored again in whole numbers. Bounds are floating point with
  a margin; scores never are.

Vectors hold the terms of queries only: a bitmap of ``BITS`` hashed query terms, a
fixed size, goes to the tasks, and what a false hit lets through meets no query.
Queries are taken in blocks of at most ``BLOCK`` terms (counted before they are
broadcast; a longer query is a block of its own), each block against all vectors. First
thresholds come from about ``SEED`` documents by hash; a threshold of any
documents is a true lower bound, so they change the work and not the result. A task takes
its vectors in runs of ``RUN``, orders each by length and cuts it into buckets
of ``BUCKET``, so no vector is shuffled and no range of lengths meets in one task.
It passes on its ten best of each query, and Spark ranks those.

Terms, weights and impacts: see ``rank_documents``. Defined cases: null, empty and
termless texts are no documents and no queries with results; very long texts are
counted whole; repeated rows are documents (queries) of their own; equal scores go
by ascending id, null ids last; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.bytebpe import joined
from barforge.llm.common import small_batches, stored

BITS = 1 << 24
BLOCK = 1 << 16
SEED = 1 << 14
RUN = 1 << 15
BUCKET = 1 << 11
MARGIN = 1e-9

#: bytes of terms: ASCII letters and digits and every byte of other code points
TERM = np.array([chr(b).isalnum() or b >= 0x80 for b in range(256)])
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


# ---- terms ------------------------------------------------------------------------

def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms, and of each occurrence its term and its text."""
    raw, size = joined(pc.binary_join_element_wise(texts, pa.scalar(""), pa.scalar(" ")))
    raw = np.frombuffer(raw.translate(LOWER), np.uint8)
    inside = TERM[raw]
    turn = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
    start, stop = turn[::2], turn[1::2]
    at = np.r_[0, np.cumsum(stop - start)].astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), len(start), [
        None, pa.py_buffer(at), pa.py_buffer(raw[inside])]).dictionary_encode()
    owner = np.searchsorted(np.cumsum(size), start, side="right")
    return coded.dictionary.cast(pa.string()), coded.indices.to_numpy(zero_copy_only=False), owner


def vectors(df: DataFrame, id_col: str, text_col: str, bitmap=None) -> DataFrame:
    """``uid, id, n`` and the distinct ``terms`` with their ``times``, those of the
    bitmap only if there is one; ``n`` counts all."""
    rows = small_batches(df).select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"),
                                    F.coalesce(text_col, F.lit("")).alias("text"))

    def work(batches):
        for b in batches:
            if not b.num_rows:
                continue
            terms, code, owner = terms_of(b.column("text"))
            n = np.bincount(owner, minlength=b.num_rows)
            if bitmap is not None:
                bits = bitmap.value
                place = np.array([zlib.crc32(t) % BITS for t in terms.cast(pa.binary()).to_pylist()], np.int64)
                wanted = (bits[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
                keep = wanted[code]
                code, owner = code[keep], owner[keep]
            key, times = np.unique(owner.astype(np.int64) * max(len(terms), 1) + code, return_counts=True)
            owner, code = np.divmod(key, max(len(terms), 1))
            at = pa.array(np.r_[0, np.cumsum(np.bincount(owner, minlength=b.num_rows))], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("uid"), b.column("id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, terms.take(pa.array(code))),
                 pa.ListArray.from_arrays(at, pa.array(times, pa.int64()))], ["uid", "id", "n", "terms", "times"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"uid bigint, id {kind}, n bigint, terms array<string>, times array<bigint>")


def term_bitmap(queries: DataFrame) -> np.ndarray:
    """The bitmap of all query terms, put together in Spark: at most ``BITS`` / 64 rows."""
    place = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(BITS)).alias("place")
    words = (queries.select(F.explode("terms").alias("term")).select(place).groupBy(F.expr("place div 64").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 AS int)))").alias("bits"))).toArrow()
    out = np.zeros(BITS // 64, np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return out


# ---- search inside a task ---------------------------------------------------------

@dataclass
class Block:
    """A block of queries: their distinct terms, and per query (``first`` to the next)
    its terms, heaviest first, with whole and floating weights and the length of what follows."""
    terms: pa.Array
    root: np.ndarray
    uid: np.ndarray
    first: np.ndarray
    term: np.ndarray
    whole: np.ndarray
    weight: np.ndarray
    rest: np.ndarray
    least: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table, least: dict[int, int]) -> Block:
        """``rows``: uid, term, times, w (above 0)."""
        terms = rows["term"].combine_chunks().dictionary_encode()
        w, times, uid = (rows[c].to_numpy().astype(np.int64) for c in ("w", "times", "uid"))
        code = terms.indices.to_numpy(zero_copy_only=False)
        root = np.zeros(len(terms.dictionary))
        root[code] = np.sqrt(w)
        weight = times * root[code]
        by = np.lexsort((code, -weight, uid))
        uid, code, weight, whole = uid[by], code[by], weight[by], (times * w)[by]
        own, start = np.unique(uid, return_index=True)
        first = np.r_[start, len(uid)]
        # the length of a query's coordinates from each one on
        tail = np.r_[np.cumsum((weight ** 2)[::-1])[::-1], 0.0]
        ends = np.repeat(tail[first[1:]], np.diff(first))
        return cls(terms.dictionary, root, own, first, code, whole, weight, np.sqrt(np.maximum(tail[:-1] - ends, 0)),
                   np.array([least.get(u, 0) for u in own.tolist()], np.int64))


class Search:
    """One task's search: thresholds and the best so far of each query of the block."""

    def __init__(self, block: Block, k: int):
        self.block, self.k = block, k
        self.least = block.least.copy()
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in block.uid]
        self.dense = np.zeros(len(block.terms), np.int64)
        self.read = 0  # entries of focus lists

    def run(self, at: np.ndarray, term: np.ndarray, impact: np.ndarray, place: np.ndarray) -> None:
        """Vectors (``at`` to the next: terms and impacts), numbered by ``place`` so that a
        lower number goes first among equals: ordered by length, bucket by bucket."""
        value = impact * self.block.root[term]
        size = np.diff(at)
        square = np.r_[0.0, np.cumsum(value ** 2)]
        length = np.sqrt(np.maximum(square[at[1:]] - square[at[:-1]], 0)) * (1 + MARGIN)
        order = np.argsort(-length, kind="stable")
        order = order[size[order] > 0]
        for lo in range(0, len(order), BUCKET):
            rows = order[lo:lo + BUCKET]
            n = size[rows]
            flat = np.repeat(at[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            self.bucket(length[rows], np.r_[0, np.cumsum(n)], term[flat], impact[flat], value[flat], place[rows])

    def bucket(self, length, at, term, impact, value, place) -> None:
        b, n = self.block, len(length)
        longest = length[0]
        by = np.argsort(term, kind="stable")
        lists = np.r_[0, np.cumsum(np.bincount(term, minlength=len(b.terms)))]
        owner = np.repeat(np.arange(n), np.diff(at))[by]
        listed = value[by]
        most = np.zeros(len(b.terms))
        np.maximum.at(most, term, value)
        reach = b.rest[b.first[:-1]] * longest * (1 + MARGIN)  # Cauchy-Schwarz
        for q in np.flatnonzero((reach >= self.least) & (reach > 0)):
            lo, hi = b.first[q], b.first[q + 1]
            t, weight, least = b.term[lo:hi], b.weight[lo:hi], max(int(self.least[q]), 1)
            by_value = np.r_[np.cumsum((weight * most[t])[::-1])[::-1], 0.0]
            by_length = np.r_[b.rest[lo:hi], 0.0]
            left = np.minimum(by_value, by_length * longest) * (1 + MARGIN)  # descending
            focus = int(np.count_nonzero(left >= least))
            if not focus:
                continue
            spans = [slice(lists[x], lists[x + 1]) for x in t[:focus]]
            count = [s.stop - s.start for s in spans]
            if not any(count):
                continue
            rows = np.concatenate([owner[s] for s in spans])
            found = np.concatenate([listed[s] for s in spans])
            self.read += len(rows)
            partial = np.bincount(rows, np.repeat(weight[:focus], count) * found, n)
            used = np.bincount(rows, found ** 2, n)
            rest = np.sqrt(np.maximum(length ** 2 * (1 + MARGIN) - used, 0))
            bound = (partial + np.minimum(by_value[focus], by_length[focus] * rest)) * (1 + MARGIN)
            stay = np.flatnonzero((bound >= least) & (partial > 0))
            if len(stay):
                self.rescore(q, stay, at, term, impact, place)

    def rescore(self, q: int, rows, at, term, impact, place) -> None:
        """Exact scores of ``rows``, and the query's best with them."""
        b = self.block
        lo, hi = b.first[q], b.first[q + 1]
        self.dense[b.term[lo:hi]] = b.whole[lo:hi]
        n = at[rows + 1] - at[rows]
        flat = np.repeat(at[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        score = np.add.reduceat(self.dense[term[flat]] * impact[flat], np.cumsum(n) - n)
        self.dense[b.term[lo:hi]] = 0
        good = (score > 0) & (score >= self.least[q])
        scores, places = np.r_[self.best[q][0], score[good]], np.r_[self.best[q][1], place[rows][good]]
        by = np.lexsort((places, -scores))[:self.k]
        self.best[q] = scores[by], places[by]
        if len(by) == self.k:
            self.least[q] = max(self.least[q], scores[by[-1]])


# ---- jobs -------------------------------------------------------------------------

def best_of_tasks(vecs: DataFrame, block, k: int, texts: int, words: int) -> DataFrame:
    """``query, score, id``: each task's ``k`` best documents of each query of the block."""
    def work(batches):
        search = Search(block.value, k)
        ids: list[pa.Array] = []  # of all runs, where a best document may lie
        kept, held = [], 0

        def flush():
            nonlocal kept, held
            t = pa.Table.from_batches(kept).combine_chunks()
            kept, held = [], 0
            lists, times = t["terms"].combine_chunks(), t["times"].combine_chunks().flatten().to_numpy()
            term = pc.index_in(lists.flatten(), search.block.terms)
            known = np.asarray(term.is_valid())
            owner = np.asarray(pc.list_parent_indices(lists))[known]
            term, times = np.asarray(term.fill_null(0))[known].astype(np.int64), times[known]
            n = t["n"].to_numpy()
            m = 100 - 75 + (75 * n * texts) // words
            impact = (1_000_000_000 * times) // (1000 * times + 8 * m[owner])
            at = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(t)))]
            merge(t["id"].combine_chunks(), at, term, impact)

        def merge(new: pa.Array, at, term, impact):
            """The documents among any query's best so far, and the run's, in one order by
            id, nulls last, which decides among equal scores."""
            named = np.unique(np.concatenate([p for _, p in search.best])) if search.best else np.zeros(0, np.int64)
            old = ids[0].take(pa.array(named)) if ids else new.slice(0, 0)
            both = pa.concat_arrays([old, new])
            by = np.asarray(pc.sort_indices(both, null_placement="at_end"))
            place = np.empty(len(both), np.int64)
            place[by] = np.arange(len(both))
            search.best = [(s, place[np.searchsorted(named, p)]) for s, p in search.best]
            ids[:] = [both.take(pa.array(by))]
            search.run(at, term, impact, place[len(old):])

        for b in batches:
            kept.append(b)
            held += b.num_rows
            if held >= RUN:
                flush()
        if held:
            flush()
        for uid, (scores, places) in zip(search.block.uid.tolist(), search.best):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uid] * len(scores), pa.int64()), pa.array(scores, pa.int64()), ids[0].take(pa.array(places))],
                    ["query", "score", "id"])

    kind = vecs.schema["id"].dataType.simpleString()
    return vecs.select("id", "n", "terms", "times").mapInArrow(work, f"query bigint, score bigint, id {kind}")


def blocks_of(terms: DataFrame, most: int) -> DataFrame:
    """``terms`` with ``block``: as few blocks as keep each within ``most`` rows, or alone."""
    sizes = stored(terms.groupBy("uid").agg(F.count(F.lit(1)).alias("rows")), "query-sizes")
    total = sizes.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    n = max(1, -(-total // most))
    while True:
        block = F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int").alias("block")
        worst = sizes.groupBy(block).agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("queries")).where(
            (F.col("rows") > most) & (F.col("queries") > 1)).limit(1).count()
        if not worst:
            return terms.select("*", block)
        n *= 2


def rank_documents(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", query_col: str = "item_id",
                   text_col: str = "text", k: int = 10) -> DataFrame:
    """``query_col, rank, id_col, score``: the ``k`` documents of highest score above 0
    for each row of ``queries``, equal scores by ascending id.

    With N documents that have terms, L terms in them, n in one, df documents that
    hold a term and tf of it in one: w = floor(1000 ln((2N + 2) / (2 df + 1))),
    m = 25 + 75 n N div L, and a query's score is the sum over its terms, repeats
    included, of w (10^9 tf div (1000 tf + 8 m))."""
    sc = docs.sparkSession.sparkContext
    asked = stored(vectors(queries, query_col, text_col), "queries")
    vecs = stored(vectors(docs, id_col, text_col, sc.broadcast(term_bitmap(asked))), "impacts")
    texts, words = vecs.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    words = max(words, 1)
    df = vecs.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    w = F.floor(F.lit(1000.0) * F.log((F.lit(2.0) * texts + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long")
    terms = (asked.select("uid", F.inline(F.arrays_zip("terms", "times")))
             .toDF("uid", "term", "times").join(df.select("term", w.alias("w")), "term").where("w > 0"))
    terms = stored(blocks_of(stored(terms, "query-weights"), BLOCK), "query-blocks")
    share = max(1, texts // SEED)
    seed = vecs.where(F.pmod(F.xxhash64("uid"), F.lit(share)) == 0)
    parts = []
    for (number,) in terms.select("block").distinct().orderBy("block").collect():  # at most total rows / BLOCK, doubled
        rows = terms.where(F.col("block") == number).select("uid", "term", "times", "w").toArrow()  # at most BLOCK, or one query
        first = best_of_tasks(seed, sc.broadcast(Block.of(rows, {})), k, texts, words)
        top = first.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))).where(
            F.col("place") <= k).groupBy("query").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("found")).where(F.col("found") == k)
        least = {r["query"]: r["least"] for r in top.collect()}  # a row a query of the block
        parts.append(stored(best_of_tasks(vecs, sc.broadcast(Block.of(rows, least)), k, texts, words), "best"))
    kind = vecs.schema["id"].dataType.simpleString()
    found = docs.sparkSession.createDataFrame([], f"query bigint, score bigint, id {kind}")
    for p in parts:
        found = found.unionByName(p)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    names = asked.select(F.col("uid").alias("query"), F.col("id").alias("name"))
    return ranked.join(names, "query").select(F.col("name").alias(query_col), "rank", F.col("id").alias(id_col), "score")
