"""Suffix-array dedup: remove every byte inside a string of ``LENGTH`` bytes that
also starts anywhere else in the corpus.

Suffix arrays are built where equal strings can meet, and only over text that may
repeat:

1. Anchors. In every window of LENGTH bytes the least hash of its K-byte strings
   marks one place, its anchor; equal windows have equal anchors at equal
   offsets. Windows in a row with one anchor are a run. A run is cut into
   ``SIDES`` by the anchor's offset; all windows of a side share a core of
   about ``LENGTH * (1 - 1 / SIDES)`` bytes, whose hash is the side's key.
   Equal windows have equal keys, so a window whose key is alone is unique.
2. Keys are counted (partial counts before the shuffle); the texts that hold a
   repeated key are read again and give up the stretch that the side's windows
   cover. Equal stretches under one key are merged and counted: the windows of
   one that occurs twice are repeated.
3. Distinct stretches of a key come together, keys packed into batches of
   ``BATCH`` bytes, and a suffix array of the batch is built by two-stage sorting:
   only suffixes smaller than their successors are sorted directly, the others
   are induced by scanning the buckets in order. Adjacent common prefixes of
   LENGTH or more bytes mark repeated windows.
4. A key with more than ``HOT`` bytes of distinct stretches would be one task's
   burden; its stretches give up their windows one by one, and equal windows
   are counted by a 128-bit hash instead. No window is skipped.
5. Repeated windows go back to their texts as byte ranges.

Whole equal texts are one text here (by SHA-256 of the bytes): if it occurs
twice, all its windows are repeated. Keys and merged stretches are 128-bit
hashes; a match is decided byte by byte in step 3.

Defined cases: a null text is empty; a text shorter than LENGTH keeps all its
bytes; strings are judged on the input, overlapping occurrences count, matches
never cross documents; repeated rows repeat each other; null ids and extra
columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import small_batches, stored, text_bytes

LENGTH = 400
K = 16
SIDES = 2
BATCH = 1 << 20
HOT = 4 << 20


# ---- anchors --------------------------------------------------------------------

def eights(b: np.ndarray, kind: str) -> np.ndarray:
    """The eight bytes at each place as one number (``kind``: byte order)."""
    n = len(b) - 7
    out = np.empty(n, np.uint64)
    for o in range(min(8, n)):
        part = np.frombuffer(b, kind, count=(len(b) - o) // 8, offset=o)
        out[o::8] = part[:len(out[o::8])]
    return out


def gram_hashes(b: np.ndarray, k: int = K) -> np.ndarray:
    """A mixed 64-bit hash of the k bytes (a multiple of eight) at each place."""
    w, n = eights(b, "<u8"), len(b) - k + 1
    x = np.zeros(n, np.uint64)
    for i in range(0, k, 8):
        x ^= w[i:i + n]
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    return x * np.uint64(0xBF58476D1CE4E5B9)


def least_places(x: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value (of its upper half; the first of equal ones) in each
    stretch of ``width``: the place rides in the lower half."""
    n, blocks = len(x) - width + 1, -(-len(x) // width)
    v = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    v[:len(x)] = (x & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(x), dtype=np.uint64)
    v = v.reshape(blocks, width)
    head = np.minimum.accumulate(v, axis=1).ravel()
    tail = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(tail[:n], head[width - 1:width - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def sides(text: bytes, length: int, k: int = K, n_sides: int = SIDES) -> list[tuple[bytes, int, int, int]]:
    """(key, first window, last window, anchor) of every side of every run."""
    if len(text) < length:
        return []
    b = np.frombuffer(text, np.uint8)
    anchor = least_places(gram_hashes(b, k), length - k + 1)
    starts = np.arange(len(anchor))
    step = -(-(length - k + 1) // n_sides)
    side = (anchor - starts) // step
    cut = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (side[1:] != side[:-1])])
    last = np.r_[cut[1:], len(anchor)] - 1
    out, digest = [], xxhash.xxh128_digest
    for f, t, a, s in zip(cut.tolist(), last.tolist(), anchor[cut].tolist(), side[cut].tolist()):
        # the core: the bytes that every window of this side holds
        core = text[a - s * step:a - min((s + 1) * step - 1, length - k) + length]
        out.append((digest(core, seed=s), f, t, a))
    return out


# ---- suffix arrays --------------------------------------------------------------

def direct_sort(w: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of the strings of ``depth`` bytes that start there. ``w``:
    eight bytes at each place. Ties of the first eight bytes are settled by the
    next eight, and so on; a group whose next eight bytes agree is not sorted."""
    order = at[np.argsort(w[at], kind="stable")]
    x = w[order]
    fresh = np.r_[True, x[1:] != x[:-1]]  # whether a place begins a group of ties
    open_ = np.flatnonzero(~fresh | np.r_[~fresh[1:], False])
    for d in range(8, depth, 8):
        if not len(open_):
            break
        part = order[open_]
        x, first = w[part + d], fresh[open_]
        group = np.cumsum(first) - 1
        odd = x != x[np.flatnonzero(first)][group]
        if not odd.any():
            continue
        mixed = np.zeros(group[-1] + 1, bool)
        mixed[group[odd]] = True
        sel = np.flatnonzero(mixed[group])
        by = sel[np.lexsort((x[sel], group[sel]))]
        order[open_[sel]] = part[by]
        x[sel] = x[by]
        fresh[open_[sel]] |= np.r_[True, x[sel][1:] != x[sel][:-1]]
        still = fresh[open_]
        open_ = open_[~still | np.r_[~still[1:] & (np.diff(open_) == 1), False]]
    return order


def suffix_array(b: np.ndarray, n: int, depth: int) -> np.ndarray:
    """Suffixes of ``b[:n]`` in the order of their first ``depth`` bytes, two-stage.
    ``b`` ends in zeros, at least depth + 8 of them behind n; its last real byte
    is a zero (separator), which no text byte is."""
    t = b[:n].astype(np.int64)
    # type: smaller than the successor; equal bytes take the type of the next place
    nxt = np.r_[t[1:], -1]
    kind = np.sign(nxt - t)
    known = np.flatnonzero(kind)
    kind = kind[known[np.minimum(np.searchsorted(known, np.arange(n)), len(known) - 1)]]
    small = kind > 0
    sorted_small = direct_sort(eights(b, ">u8"), np.flatnonzero(small), depth)
    by_byte = np.searchsorted(t[sorted_small], np.arange(257))
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def induce(found: np.ndarray) -> None:
        """Predecessors of sorted suffixes, larger than they are, in this order."""
        before = found[found > 0] - 1
        before = before[~small[before]]
        if not len(before):
            return
        by = np.argsort(t[before], kind="stable")
        before = before[by]
        ends = np.searchsorted(t[before], np.arange(257))
        for c in np.flatnonzero(np.diff(ends)):
            pending[c].append(before[ends[c]:ends[c + 1]])

    induce(np.array([n]))  # the end of the text is the least suffix
    for c in range(256):
        # the large ones of the bucket come first; runs of c induce into the bucket itself
        while pending[c]:
            batch = np.concatenate(pending[c])
            pending[c] = []
            out.append(batch)
            induce(batch)
        bucket = sorted_small[by_byte[c]:by_byte[c + 1]]
        if len(bucket):
            out.append(bucket)
            induce(bucket)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def common_prefixes(b: np.ndarray, sa: np.ndarray, depth: int) -> np.ndarray:
    """Whether each neighbour pair agrees in its first ``depth`` bytes."""
    w, left, right = eights(b, ">u8"), sa[:-1], sa[1:]
    live = np.arange(len(left))
    for d in range(0, depth, 8):
        over = np.uint64(8 * max(0, d + 8 - depth))  # the last step may reach past depth
        live = live[(w[left[live] + d] ^ w[right[live] + d]) >> over == 0]
    out = np.zeros(len(left), bool)
    out[live] = True
    return out


def repeated_windows(stretches: list[bytes], length: int) -> list[np.ndarray]:
    """For each stretch, the starts of its windows that occur at least twice in all."""
    # bytes are raised by one so that zero can separate; UTF-8 never holds 255
    whole = np.zeros(sum(map(len, stretches)) + len(stretches) + length + 16, np.uint8)
    first, at = [], 0
    for s in stretches:
        whole[at:at + len(s)] = np.frombuffer(s, np.uint8) + 1
        first.append(at)
        at += len(s) + 1
    sa = suffix_array(whole, at, length)
    # a window must lie inside its stretch
    size = np.array([len(s) for s in stretches])
    owner = np.searchsorted(first, sa, side="right") - 1
    sa = sa[sa - np.array(first)[owner] <= size[owner] - length]
    same = common_prefixes(whole, sa, length)
    hit = np.sort(sa[np.r_[False, same][:len(sa)] | np.r_[same, False][:len(sa)]])
    ends = np.searchsorted(hit, [*first, at])
    return [hit[a:b] - f for a, b, f in zip(ends, ends[1:], first)]


# ---- jobs -----------------------------------------------------------------------

def ranges(starts: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of consecutive numbers, both ends included."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.r_[0, cut + 1]].tolist(), starts[np.r_[cut, len(starts) - 1]].tolist()))


KEYS = "digest binary, key binary, first int, last int, anchor int"
STRETCHES = "digest binary, key binary, first int, anchor int, own binary, stretch binary"
MARKS = "key binary, own binary, lo int, hi int"


def batches_of(schema: str, columns: list[list]) -> pa.RecordBatch:
    kinds = {"binary": pa.binary(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)],
                                      names=[n for n, _ in fields])


def key_rows(length: int):
    def run(batches):
        for b in batches:
            rows = [(d, k, f, t, a) for d, x in zip(b["digest"].to_pylist(), b["text"].to_pylist())
                    for k, f, t, a in sides(x, length)]
            yield batches_of(KEYS, [list(c) for c in zip(*rows)] or [[]] * 5)
    return run


def stretch_rows(length: int):
    def run(batches):
        for b in batches:
            rows = []
            for d, x, many in zip(b["digest"].to_pylist(), b["text"].to_pylist(), b["sides"].to_pylist()):
                for s in many:
                    part = x[s["first"]:s["last"] + length]
                    # equal parts that stand differently to the anchor share no windows, but need not be told apart
                    rows.append((d, s["key"], s["first"], s["anchor"], xxhash.xxh128_digest(part), part))
                    if len(rows) >= 4000:
                        yield batches_of(STRETCHES, [list(c) for c in zip(*rows)])
                        rows = []
            yield batches_of(STRETCHES, [list(c) for c in zip(*rows)] or [[]] * 6)
    return run


def mark_rows(length: int, batch: int = BATCH):
    """Stretches sorted by key -> ranges of repeated windows; whole keys per batch."""
    def solve(rows):
        found = repeated_windows([r[2] for r in rows], length)
        return batches_of(MARKS, [list(c) for c in zip(*[
            (k, o, lo, hi) for (k, o, _), hit in zip(rows, found) for lo, hi in ranges(hit)])] or [[]] * 4)

    def run(batches):
        rows, size = [], 0
        for b in batches:
            for r in zip(b["key"].to_pylist(), b["own"].to_pylist(), b["stretch"].to_pylist()):
                if size >= batch and rows[-1][0] != r[0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[2])
        if rows:
            yield solve(rows)
    return run


def window_rows(length: int):
    def run(batches):
        for b in batches:
            for k, o, x in zip(b["key"].to_pylist(), b["own"].to_pylist(), b["stretch"].to_pylist()):
                n = len(x) - length + 1
                yield batches_of("key binary, own binary, lo int, win binary", [
                    [k] * n, [o] * n, list(range(n)), [xxhash.xxh128_digest(x[i:i + length]) for i in range(n)]])
    return run


def repeated_ranges(texts: DataFrame, chosen: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """``(digest, lo, hi)``: windows starting at lo..hi of the text are repeated.
    ``texts``: ``id, digest, text`` (bytes), copies included; ``chosen``: for each
    ``digest`` the id ``of`` the copy that is read again."""
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = stored(texts.select("digest", "text").mapInArrow(key_rows(length), KEYS), "window-keys")
    # a key is repeated if it stands at two places of different texts; copies share their places;
    # stored, so that the join below reads two shuffles and a very common key is split
    place = F.xxhash64("digest", "first")
    twice = stored(keys.groupBy("key").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo <> hi")
                   .select(F.col("key").alias("k")), "repeated-keys")
    sought = (keys.join(twice, F.col("key") == F.col("k")).groupBy("digest")
              .agg(F.collect_set(F.struct("key", "first", "last", "anchor")).alias("sides")))  # at most the text's own
    sought = sought.join(chosen.select(F.col("digest").alias("d"), "of"), F.col("digest") == F.col("d")).select("d", "of", "sides")
    found = stored(texts.join(sought, (F.col("digest") == F.col("d")) & F.col("id").eqNullSafe(F.col("of")))
                   .select("digest", "text", "sides").mapInArrow(stretch_rows(length), STRETCHES), "stretches")
    owners = found.select("digest", "key", "first", "own")
    distinct = stored(found.groupBy("key", "own").agg(F.count("*").alias("n"), F.first("stretch").alias("stretch")), "distinct")
    size = distinct.groupBy("key").agg(F.sum(F.length("stretch")).alias("bytes"), F.count("*").alias("m")).select(
        F.col("key").alias("k"), "bytes", "m")
    sized = distinct.join(size, F.col("key") == F.col("k")).drop("k")
    # a stretch of its own kind only, under its key: nothing to compare with
    whole = distinct.where("n > 1").select("key", "own", F.lit(0).alias("lo"), (F.length("stretch") - length).alias("hi"))
    cold = (sized.where((F.col("m") > 1) & (F.col("bytes") <= hot)).select("key", "own", "stretch")
            .repartition(n, "key").sortWithinPartitions("key").mapInArrow(mark_rows(length), MARKS))
    wins = stored(sized.where(F.col("bytes") > hot).select("key", "own", "stretch")
                  .mapInArrow(window_rows(length), "key binary, own binary, lo int, win binary"), "windows")
    again = wins.groupBy("win").agg(F.count("*").alias("n")).where("n > 1").select(F.col("win").alias("w"))
    single = wins.join(again, F.col("win") == F.col("w")).select("key", "own", "lo", F.col("lo").alias("hi"))
    marks = whole.unionByName(cold).unionByName(single).select(F.col("key").alias("k"), F.col("own").alias("o"), "lo", "hi")
    return owners.join(marks, (F.col("key") == F.col("k")) & (F.col("own") == F.col("o"))).select(
        "digest", (F.col("first") + F.col("lo")).alias("lo"), (F.col("first") + F.col("hi")).alias("hi"))


def spans_of(lo: list[int], hi: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal removed byte ranges, end exclusive."""
    out: list[list[int]] = []
    for a, b in sorted(zip(lo, hi)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + length)
        else:
            out.append([a, b + length])
    return [tuple(s) for s in out]


def dedup(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
          hot: int = HOT) -> DataFrame:
    """``(id, kept, n_bytes, n_removed, n_spans)``, a row for each row of ``docs``;
    ``kept`` are the remaining bytes."""
    rows = small_batches(docs).select(F.col(id_col).alias("id"), text_bytes(F.col(text_col)).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    copies = stored(rows.select("digest", "id").groupBy("digest").agg(F.count("*").alias("copies"), F.min("id").alias("of")), "copies")
    # equal (id, text) rows are all read again, but they are copies and go whole anyway
    long = rows.where(F.length("text") >= length)
    marks = (repeated_ranges(long, copies.select("digest", "of"), length, hot).groupBy("digest")
             .agg(F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi")))
    marks = copies.join(marks.select(F.col("digest").alias("md"), "lo", "hi"), F.col("digest") == F.col("md"), "left").select(
        F.col("digest").alias("md"), "copies", "lo", "hi")

    @F.arrow_udf("struct<kept:binary,n_removed:bigint,n_spans:bigint>")
    def cut(text: pa.Array, copies: pa.Array, lo: pa.Array, hi: pa.Array) -> pa.Array:
        kept, removed, n_spans = [], [], []
        for t, c, a, b in zip(text.to_pylist(), copies.to_pylist(), lo.to_pylist(), hi.to_pylist()):
            spans = [(0, len(t))] if c > 1 and len(t) >= length else spans_of(a or [], b or [], length)
            at, out = 0, []
            for x, y in spans:
                out.append(t[at:x])
                at = y
            kept.append(b"".join([*out, t[at:]]))
            removed.append(len(t) - len(kept[-1]))
            n_spans.append(len(spans))
        return pa.StructArray.from_arrays([pa.array(kept, pa.binary()), pa.array(removed, pa.int64()),
                                           pa.array(n_spans, pa.int64())], ["kept", "n_removed", "n_spans"])

    joined = rows.join(marks, F.col("digest") == F.col("md")).select("id", "text", "copies", "lo", "hi")
    return joined.withColumn("r", cut("text", "copies", "lo", "hi")).select(
        "id", F.col("r.kept").alias("kept"), F.length("text").cast("long").alias("n_bytes"),
        F.col("r.n_removed").alias("n_removed"), F.col("r.n_spans").alias("n_spans"))
