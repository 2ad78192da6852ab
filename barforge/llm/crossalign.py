"""Alignment of two tokenizers over whole texts, and how far corpus-wide pair
counts agree with it.

Both tokenizers cover the same bytes, a blank and the text. Byte offsets at which
tokens of both end cut them into groups; every token pair of a group is a link. An
id pair's count is the number of documents that hold it linked.

The work is Arrow arrays inside Spark's tasks. A batch's token lists are
flattened and keep their parents' indices; a segmented cumulative sum of the
tokens' byte lengths gives the ends inside each document; an Acero hash join on
(document, end) finds the common ends. Links are expanded in stretches of
``LINKS`` rows and reduced by ``Table.group_by`` to distinct pairs of a document.
These are stored, counted per task by ``Table.group_by`` and merged by Spark. A
second look at the stored pairs adds the counts up per document: the ``FREQUENT``
most common pairs (a fixed number, broadcast) are looked up inside the task, so a
pair that every document holds is never shuffled; all others meet their count in
a join. In a group of more than ``WIDE`` links equal ids are counted first, so
that links are not written out one by one.

A is a byte-level vocabulary (JSON) encoded as in ``bytebpe``, B a sentencepiece
model; the files are parameters. The JSON file is read on the driver and broadcast
with the model's bytes. Special strings inside texts are plain text.

Defined cases: null and empty texts, and texts whose tokens do not give back the
blank and the text byte for byte, have no tokens: zeros, and no groups; very long
texts are aligned whole; repeated rows are documents of their own; an empty table
gives an empty result; ``keep`` columns pass through under any name.
"""

from __future__ import annotations

import hashlib
import json
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm import bytebpe
from barforge.llm.bpe import SYMBOLS
from barforge.llm.common import small_batches, stored

BLANK = "▁"  # as sentencepiece writes it
SLICE = 1 << 20
LINKS = 1 << 20
WIDE = 1024
COUNTED = 1 << 20
FREQUENT = 1 << 19


def load_json(path: str) -> bytebpe.Vocabulary:
    """A byte-level vocabulary file with its merges in order."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    byte = {s: i for i, s in enumerate(SYMBOLS)}
    raw = {s: bytes(map(byte.__getitem__, s)) for s in model["vocab"] if all(c in byte for c in s)}
    ids = model["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    return bytebpe.Vocabulary.of({raw[s]: ids[s] for s in raw},
                                 [(ids[a], ids[b], o, ids[a + b]) for o, (a, b) in enumerate(merges)], False)


def joins_by_file(path: str):
    """Whether the tokenizers library takes a text of two code points as one piece."""
    from tokenizers import Tokenizer
    splitter = Tokenizer.from_file(path).pre_tokenizer
    return lambda text: len(splitter.pre_tokenize_str(text)) == 1


def model_size(model: bytes) -> int:
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_proto=model).get_piece_size()


class Pair:
    """Both tokenizers in one task."""

    def __init__(self, vocab: bytebpe.Vocabulary, table: np.ndarray, model: bytes):
        from sentencepiece import SentencePieceProcessor
        self.a = bytebpe.Coder(vocab, table)
        self.b = SentencePieceProcessor(model_proto=model)
        size = self.b.get_piece_size()
        self.b_tokens = pa.array([
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode("utf-8")
            for i, p in enumerate(map(self.b.id_to_piece, range(size)))], pa.binary())
        self.n_a, self.n_b = len(self.a.tokens), size
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.cut_at_blanks = not any(BLANK in p.lstrip(BLANK) for p in pieces) and BLANK in pieces
        self.alone = self.b.piece_to_id(BLANK)
        self.words: dict[bytes, tuple[int, ...]] = {}
        # every id as text: alone, after a comma, after a semicolon; B's after a bar, after a comma
        forms = [f"{c}{i}" for c in ("", ",", ";") for i in range(self.n_a)] + [
            f"{c}{i}" for c in ("|", ",") for i in range(self.n_b)]
        self.forms = pa.array(forms, pa.string())

    def encode_b(self, raw: bytes, size: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """B's ids of all texts end to end (``raw``: each after its blank), and where each
        text's begin. Where no piece of B has a blank after anything else, nothing is
        merged over such a place: there the texts are cut, and each distinct word, with
        the blanks before it, is encoded once and cached."""
        if not self.cut_at_blanks:
            rows = self.b.encode(texts.to_pylist(), num_threads=1)
            return (np.fromiter(chain.from_iterable(rows), np.int32),
                    np.r_[0, np.cumsum(np.array([len(r) for r in rows], np.int64))])
        begin = np.cumsum(size) - size
        blank = np.frombuffer(raw, np.uint8) == 0x20
        head = blank & ~np.r_[False, blank[:-1]]
        head[begin] = True
        at = np.flatnonzero(head)
        words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.r_[at, len(raw)].astype(np.int32)),
                                                             pa.py_buffer(raw)]).dictionary_encode()
        seen, known = words.dictionary.to_pylist(), self.words
        if len(known) + len(seen) > bytebpe.CACHE:
            known.clear()
        new = [w for w in seen if w not in known]
        # the library puts a blank before each text itself
        known.update(zip(new, map(tuple, self.b.encode([w[1:].decode("utf-8") for w in new], num_threads=1))))
        known[b" "] = (self.alone,)
        rows = [known[w] for w in seen]
        flat = np.fromiter(chain.from_iterable(rows), np.int32)
        count = np.array([len(r) for r in rows], np.int64)
        start = np.cumsum(count) - count
        which = words.indices.to_numpy(zero_copy_only=False)
        each = count[which]
        end = np.cumsum(each)
        ids = flat[np.repeat(start[which] - (end - each), each) + np.arange(int(end[-1]))]
        return ids, np.r_[0, end][np.searchsorted(at, np.r_[begin, len(raw)])]

    def align(self, texts: pa.Array, digest: bool) -> dict[str, list | np.ndarray]:
        """Per text (none empty): ``n_a, n_b, n_groups, n_links, groups``, and ``pairs``
        (a * n_b + b, ascending) with their ``times``, ended at ``upto``."""
        raw, size = bytebpe.joined(pc.binary_join_element_wise(pa.scalar(" "), texts, pa.scalar("")))
        a, at_a = self.a.encode(raw, size)
        b, at_b = self.encode_b(raw, size, texts)
        begin = np.r_[0, np.cumsum(size)]
        right = same_bytes(self.a.tokens, a, at_a, raw, begin) & same_bytes(self.b_tokens, b, at_b, raw, begin)
        if not right.all():
            a, at_a = only(a, at_a, right)
            b, at_b = only(b, at_b, right)
        lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, pa.int32()))
                 for x, at in ((a, at_a), (b, at_b))]
        ends = [document_ends(x, t) for x, t in zip(lists, (self.a.tokens, self.b_tokens))]
        cut_a, cut_b = common_ends(*ends)
        doc = np.asarray(pc.list_parent_indices(lists[0]))[cut_a]  # of each group
        n = len(texts)
        in_a, in_b = np.diff(np.r_[-1, cut_a]), np.diff(np.r_[-1, cut_b])
        upto = np.r_[0, np.cumsum(np.bincount(doc, minlength=n))]
        links = np.r_[0, np.cumsum(in_a * in_b)]
        keys, times = self.distinct_pairs(a, b, in_a, in_b, doc)
        owner, pair = np.divmod(keys, self.n_a * self.n_b)
        return {"n_a": np.diff(at_a), "n_b": np.diff(at_b), "n_groups": np.diff(upto),
                "n_links": links[upto[1:]] - links[upto[:-1]],
                "groups": self.written(a, b, at_a, at_b, in_a, in_b, upto, digest),
                "pairs": pair, "times": times, "upto": np.r_[0, np.cumsum(np.bincount(owner, minlength=n))]}

    def distinct_pairs(self, a, b, in_a, in_b, doc) -> tuple[np.ndarray, np.ndarray]:
        """(document, a, b) as one number, ascending, and how often it is linked."""
        ones = (a, np.repeat(np.arange(len(in_a)), in_a), np.ones(len(a), np.int64))
        twos = (b, np.repeat(np.arange(len(in_b)), in_b), np.ones(len(b), np.int64))
        wide = in_a * in_b > WIDE
        if wide.any():
            ones, twos = counted_in(ones, wide, self.n_a), counted_in(twos, wide, self.n_b)
        per = np.bincount(twos[1], minlength=len(in_b))
        first = np.cumsum(per) - per
        ids, group, weight = ones
        upto = np.cumsum(per[group])
        parts, lo = [], 0
        while lo < len(ids):
            done = int(upto[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(upto, done + LINKS, side="right")))
            g, rows = group[lo:hi], per[group[lo:hi]]
            left = np.repeat(np.arange(lo, hi), rows)
            right = np.repeat(first[g] - (upto[lo:hi] - rows - done), rows) + np.arange(len(left))
            parts.append(summed(((doc[group[left]].astype(np.int64) * self.n_a + ids[left]) * self.n_b + twos[0][right]),
                                weight[left] * twos[2][right]))
            lo = hi
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, times = parts[0] if len(parts) == 1 else summed(*map(np.concatenate, zip(*parts)))
        by = np.argsort(keys)
        return keys[by], times[by]

    def written(self, a, b, at_a, at_b, in_a, in_b, upto, digest: bool) -> list[str]:
        """The groups as text, ``a1,a2|b1;a3|b2,b3``, or its SHA-256; '' without tokens."""
        total = len(a) + len(b)
        if not total:
            return [""] * (len(at_a) - 1)
        end_a, end_b = np.cumsum(in_a), np.cumsum(in_b)
        head_a, head_b = end_a - in_a, end_b - in_b  # the first token of each group
        form = np.ones(len(a), np.int64)
        form[head_a] = 2
        form[head_a[upto[:-1][np.diff(upto) > 0]]] = 0
        code = np.empty(total, np.int64)
        code[np.arange(len(a)) + np.repeat(head_b, in_a)] = form * self.n_a + a
        form = np.ones(len(b), np.int64)
        form[head_b] = 0
        code[np.arange(len(b)) + np.repeat(end_a, in_b)] = 3 * self.n_a + form * self.n_b + b
        _, offsets, data = self.forms.take(pa.array(code)).buffers()
        at = np.frombuffer(offsets, np.int32)[at_a + at_b].tolist()
        view = memoryview(data)
        if digest:
            return [hashlib.sha256(view[x:y]).hexdigest() if y > x else "" for x, y in zip(at, at[1:])]
        return [str(view[x:y], "ascii") for x, y in zip(at, at[1:])]


def same_bytes(tokens: pa.Array, ids: np.ndarray, at: np.ndarray, raw: bytes, begin: np.ndarray) -> np.ndarray:
    """Whether each text's tokens, joined, are its bytes."""
    _, offsets, data = tokens.take(pa.array(ids, pa.int32())).buffers()
    ends = np.frombuffer(offsets, np.int32)[at] if offsets is not None and len(offsets) else np.zeros(len(at), np.int32)
    made = memoryview(data).cast("B") if data is not None else memoryview(b"")
    if np.array_equal(ends, begin) and made[:len(raw)] == raw:
        return np.ones(len(at) - 1, bool)
    view = memoryview(raw)
    return np.array([made[c:d] == view[x:y] for c, d, x, y in zip(ends, ends[1:], begin, begin[1:])], bool)


def only(ids: np.ndarray, at: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of the texts marked ``right``; the others have none."""
    n = np.diff(at)
    return ids[np.repeat(right, n)], np.r_[0, np.cumsum(np.where(right, n, 0))]


def document_ends(tokens: pa.ListArray, raw: pa.Array) -> pa.Table:
    """``doc, end, at`` of each token: the running sum of byte lengths, less what lay
    before its document."""
    parent = pc.list_parent_indices(tokens)
    running = np.asarray(pc.cumulative_sum(pc.cast(pc.binary_length(raw).take(pc.list_flatten(tokens)), pa.int64())))
    starts = np.asarray(tokens.offsets)[:-1]
    before = np.where(starts > 0, running[np.maximum(starts, 1) - 1] if len(running) else 0, 0)
    return pa.table({"doc": parent, "end": running - before[np.asarray(parent)], "at": np.arange(len(running))})


def common_ends(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places in A and in B, ascending, of the tokens that end together."""
    both = a.join(b, ["doc", "end"], join_type="inner", right_suffix="_b", use_threads=False)
    at, at_b = both["at"].to_numpy(), both["at_b"].to_numpy()
    by = np.argsort(at)
    return at[by], at_b[by]


def counted_in(tokens, wide: np.ndarray, size: int):
    """``(ids, group, weight)`` with equal ids of a wide group as one row."""
    ids, group, weight = tokens
    inside = wide[group]
    key, n = np.unique(group[inside] * size + ids[inside], return_counts=True)
    group = np.r_[group[~inside], key // size]
    by = np.argsort(group, kind="stable")
    return np.r_[ids[~inside], key % size][by], group[by], np.r_[weight[~inside], n][by]


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    t = pa.table({"k": keys, "n": n}).group_by("k", use_threads=False).aggregate([("n", "sum")])
    return t["k"].to_numpy(), t["n_sum"].to_numpy()


# ---- jobs -------------------------------------------------------------------------

ALIGNED = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pairs array<bigint>, times array<bigint>"


def aligned(docs: DataFrame, path_a: str, path_b: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
            digest: bool = False) -> tuple[DataFrame, int]:
    """One stored row a document (``uid``, ``kept`` columns, counts, groups, distinct
    pairs), and the number of B's ids. ``digest``: the SHA-256 of the groups instead."""
    with open(path_b, "rb") as f:
        model = f.read()
    vocab = load_json(path_a)
    sent = docs.sparkSession.sparkContext.broadcast((vocab, bytebpe.class_table(joins_by_file(path_a)), model))
    rows = small_batches(docs).select(F.monotonically_increasing_id().alias("uid"), F.struct(*keep).alias("kept"),
                                      F.coalesce(text_col, F.lit("")).alias("text"))
    names = [c.split()[0] for c in ALIGNED.split(", ")]

    def work(batches):
        pair = Pair(*sent.value)
        for batch in batches:
            sizes = np.asarray(pc.binary_length(batch.column("text"))).astype(np.int64)
            part = (np.cumsum(sizes) - sizes) // SLICE
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
            for lo, hi in zip(edges, edges[1:]):
                yield one(pair, batch.slice(lo, hi - lo), sizes[lo:hi] > 0)

    def one(pair: Pair, batch: pa.RecordBatch, full: np.ndarray) -> pa.RecordBatch:
        n = len(full)
        got = pair.align(batch.column("text").filter(pa.array(full)), digest) if full.any() else None
        out, place = [], np.flatnonzero(full)
        for name in names[:4]:
            x = np.zeros(n, np.int64)
            if got:
                x[place] = got[name]
            out.append(pa.array(x))
        texts, held = [""] * n, np.zeros(n, np.int64)
        if got:
            for i, s in zip(place.tolist(), got["groups"]):
                texts[i] = s
            held[place] = np.diff(got["upto"])
        at = pa.array(np.r_[0, np.cumsum(held)], pa.int32())
        out.append(pa.array(texts, pa.string()))
        out += [pa.ListArray.from_arrays(at, pa.array(got[name] if got else [], pa.int64())) for name in names[5:]]
        return pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("kept"), *out], ["uid", "kept", *names])

    kept = rows.schema["kept"].dataType.simpleString()
    return stored(rows.mapInArrow(work, f"uid bigint, kept {kept}, {ALIGNED}"), "aligned"), model_size(model)


def pair_counts(found: DataFrame, n_b: int) -> DataFrame:
    """``(pair, n, best)``: documents that hold the pair linked, and whether no other
    pair of its A id has more. Tasks count before the shuffle and pass on what they
    have whenever it exceeds ``COUNTED`` pairs."""
    def count(batches):
        held = [np.zeros(0, np.int64)] * 2
        for b in batches:
            pairs = b.column("pairs").flatten().to_numpy()
            held = summed(np.r_[held[0], pairs], np.r_[held[1], np.ones(len(pairs), np.int64)])
            if len(held[0]) > COUNTED:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["pair", "n"])
                held = [np.zeros(0, np.int64)] * 2
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["pair", "n"])

    counts = stored(found.select("pairs").mapInArrow(count, "pair bigint, n bigint")
                    .groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    a = F.expr(f"pair div {n_b}")
    top = counts.groupBy(a.alias("a")).agg(F.max("n").alias("top"))  # at most A's vocabulary
    return counts.withColumn("a", a).join(F.broadcast(top), "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def least_frequent(counts: DataFrame, most: int) -> int:
    """The least count that at most ``most`` pairs reach, from a histogram of the
    counts (16 steps an octave)."""
    step = F.floor(F.log2("n") * 16).cast("int")
    total, least = 0, 1 << 62
    for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("k"), F.min("n").alias("n")).orderBy(F.desc("s")).collect():
        total += r["k"]
        if total > most:
            break
        least = r["n"]
    return least


def agreement(docs: DataFrame, path_a: str, path_b: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
              digest: bool = False, frequent: int = FREQUENT) -> DataFrame:
    """``keep`` columns, ``n_a, n_b, n_groups, n_links, groups``, ``n_best`` (links whose
    pair is its A id's most common one, ties included) and ``count_sum`` (of the
    counts over all links)."""
    found, n_b = aligned(docs, path_a, path_b, keep, text_col, digest)
    counts = stored(pair_counts(found, n_b), "pair-tops")
    least = least_frequent(counts, frequent)
    top = counts.where(F.col("n") >= least).orderBy("pair").toArrow()  # at most ``frequent`` rows
    sent = docs.sparkSession.sparkContext.broadcast(
        tuple(top[c].to_numpy().astype(np.int64) for c in ("pair", "n", "best")))

    def add_up(batches):
        key, n, best = sent.value
        key, n, best = np.r_[key, 1 << 62], np.r_[n, 0], np.r_[best, 0]
        for b in batches:
            pairs, times = b.column("pairs"), b.column("times").flatten().to_numpy()
            at = np.r_[0, np.cumsum(np.asarray(pairs.value_lengths()).astype(np.int64))]
            flat = pairs.flatten().to_numpy()
            place = np.searchsorted(key, flat)
            known = key[place] == flat
            uid = b.column("uid").to_numpy()
            sums = []
            for value in (times * best[place], times * n[place]):
                run = np.r_[0, np.cumsum(np.where(known, value, 0))]
                sums.append(run[at[1:]] - run[at[:-1]])
            rest = ~known
            owner = np.repeat(uid, np.diff(at))[rest]
            none = np.zeros(len(owner), np.int64)
            # a document's own sum joins nothing: its key is no pair
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[x, y]) for x, y in ((uid, owner), (-1 - uid, flat[rest]), (np.zeros(len(uid), np.int64), times[rest]),
                                                    (sums[0], none), (sums[1], none))],
                ["uid", "pair", "times", "n_best", "count_sum"])

    parts = found.select("uid", "pairs", "times").mapInArrow(
        add_up, "uid bigint, pair bigint, times bigint, n_best bigint, count_sum bigint")
    rare = counts.where(F.col("n") < least)
    zero = F.lit(0).cast("long")
    sums = parts.join(rare, "pair", "left").groupBy("uid").agg(
        F.sum(F.col("n_best") + F.when(F.col("best"), F.col("times")).otherwise(zero)).alias("n_best"),
        F.sum(F.col("count_sum") + F.col("times") * F.coalesce("n", zero)).alias("count_sum"))
    return found.drop("pairs", "times").join(sums, "uid").select(
        "kept.*", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")
