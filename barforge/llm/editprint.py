"""Document fingerprints by randomised edit embedding.

All texts share one family of random walks: standing on a character at time j,
the walk writes that character and moves on to the next one or stays, as a fixed
random bit of (character class, j) says. Texts at small edit distance fall into
step again after each edit, so their written strings differ in few places: edit
distance becomes Hamming distance. How long a walk stays is looked up in a
table, one step a character.

The fingerprint samples the written string at ``SAMPLES`` times, ``2**e`` apart,
e the least power that spans it, and keeps four random bits of each sampled
character (one hex digit; ``-`` past the end), led by e as a letter. Sampling
times of neighbouring e are nested, so fingerprints of any two texts can be
compared: ``likeness`` is the share of common times, not past both ends, whose
digits agree. ``node_links`` finds fingerprints of high likeness by bands of
sampled digits and verifies them. The digits of a band are as many as counted
collisions make cheapest, the bands as many as the recall then needs. Fingerprints
are first compared with the least one of a few of their buckets; what that connects
bears one label, and of all buckets only those with several labels are verified
further, pair by pair between labels, in blocks where a bucket is hot. The links
returned connect whatever shares a band and is alike.
``with_components`` names the components of these links on the documents.

``successions`` puts every document beside its successor in ascending id
without a global sort: documents are dealt to ranges of ids (quantiles in two
levels), and the first of a range is also sent to the range before it.

Defined cases: a null text is empty; the empty text's fingerprint is all ends
and its likeness to itself is 1; equal texts have equal fingerprints; null ids
come first; rows with equal ids are ordered by their text, equal rows in either
order; a single row succeeds itself; an empty table gives an empty result; very
long texts are walked whole; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.common import components, small_batches, stored

SAMPLES = 128
CLASSES, PERIOD = 64, 1 << 14
LIKE = 0.8
WIDTHS, COUNTED, STARS = (4, 6, 8, 10, 12), 2, 4
MISS = 0.01
ROW_COST = 50.0
BLOCK = 1024
RANGE_BYTES = 4 << 20


def walks(seed: int = 5) -> list[bytes]:
    """For each class and time (they repeat after PERIOD): how long the walk stays."""
    move = np.random.default_rng(seed).integers(0, 2, (CLASSES, PERIOD), np.uint8).astype(bool)
    move[:, ::64] = True  # bounds a stay, so that it fits a byte
    out = []
    for row in move:
        at = np.flatnonzero(np.concatenate([row, row[:128]]))
        out.append((at[np.searchsorted(at, np.arange(PERIOD))] - np.arange(PERIOD) + 1).astype(np.uint8).tobytes())
    return out


STAY = walks()


def walk(classes: bytes, start: int, times: list[int]) -> int:
    """Append the time at which each character is reached; the time after the last."""
    stay, mask, put, j = STAY, PERIOD - 1, times.append, start
    for c in classes:
        put(j)
        j += stay[c][j & mask]
    return j


def codes(text: str) -> tuple[np.ndarray, bytes]:
    """(code points, their classes)"""
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return c, ((c * np.uint32(0x9E3779B1)) >> np.uint32(26)).astype(np.uint8).tobytes()


def sampled(c: np.ndarray, times: np.ndarray, end: int) -> str:
    e = max(0, int(end - 1).bit_length() - (SAMPLES.bit_length() - 1)) if end > 0 else 0
    at = np.arange(SAMPLES, dtype=np.int64) << e
    live = at < end
    out = np.full(SAMPLES, ord("-"), np.uint8)
    chars = c[np.searchsorted(times, at[live], side="right") - 1].astype(np.uint64)
    # four bits of each character; at time t the same character always gives the same four
    mixed = (chars * np.uint64(0x9E3779B97F4A7C15)) ^ (at[live].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    out[live] = np.frombuffer(b"0123456789abcdef", np.uint8)[(mixed >> np.uint64(60)).astype(np.int64)]
    return chr(97 + e) + out.tobytes().decode()


def fingerprint(text: str) -> str:
    return fingerprint_pair(text, None)[0]


def fingerprint_pair(text: str, edited: str | None) -> tuple[str, str | None]:
    """Fingerprints of a text and of another; a common beginning is walked once."""
    c, k = codes(text)
    times: list[int] = []
    end = walk(k, 0, times)
    first = sampled(c, np.array(times, np.int64), end)
    if edited is None:
        return first, None
    c2, k2 = codes(edited)
    n = min(len(c), len(c2))
    differ = np.flatnonzero(c[:n] != c2[:n])
    same = int(differ[0]) if len(differ) else n
    start = times[same] if same < len(times) else end
    del times[same:]
    end = walk(k2[same:], start, times)
    return first, sampled(c2, np.array(times, np.int64), end)


def fingerprints(text: Column, edited: Column) -> Column:
    """Struct of both fingerprints, both texts whole."""
    @F.arrow_udf("struct<fingerprint:string,edited:string>")
    def printed(a: pa.Array, b: pa.Array) -> pa.Array:
        got = [fingerprint_pair(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())]
        return pa.StructArray.from_arrays([pa.array([g[i] for g in got], pa.string()) for i in (0, 1)],
                                          ["fingerprint", "edited"])

    return printed(F.coalesce(text, F.lit("")), F.coalesce(edited, F.lit("")))


def at_spacing(digits: np.ndarray, own: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """Rows of digits taken at a coarser spacing; ends where they reach no further."""
    at = np.arange(SAMPLES) << np.minimum(wide - own, 8)[:, None]
    got = np.take_along_axis(digits, np.minimum(at, SAMPLES - 1), 1)
    return np.where(at < SAMPLES, got, ord("-"))


def likenesses(a: list[str], b: list[str]) -> np.ndarray:
    """Share of common sampling times, not past both ends, at which pairs agree."""
    x, y = (np.frombuffer("".join(p).encode(), np.uint8).reshape(len(p), SAMPLES + 1) for p in (a, b))
    ex, ey = x[:, 0].astype(np.int64), y[:, 0].astype(np.int64)
    e = np.maximum(ex, ey)
    u, v = at_spacing(x[:, 1:], ex, e), at_spacing(y[:, 1:], ey, e)
    live = (u != ord("-")) | (v != ord("-"))
    share = ((u == v) & live).sum(1) / np.maximum(live.sum(1), 1)
    return np.where((x == y).all(1), 1.0, share)


def likeness(a: Column, b: Column) -> Column:
    """Likeness (0 to 1) of two columns of fingerprints."""
    @F.arrow_udf("double")
    def compared(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(likenesses(a.to_pylist(), b.to_pylist()) if len(a) else [], pa.float64())

    return compared(a, b)


# ---- successors -----------------------------------------------------------------

def with_range(docs: DataFrame, id_col: str, text_col: str, range_bytes: int) -> DataFrame:
    """``docs`` plus ``_range``: ascending ranges of ids of about ``range_bytes`` of text."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    k = max(1, int(np.ceil(np.sqrt(total / range_bytes))))
    shares = [i / k for i in range(1, k)] or [1.0]
    cuts = [c for c in docs.agg(F.percentile_approx(id_col, shares, 10000)).first()[0] or []]
    level = lambda cuts: F.coalesce(F.size(F.filter(cuts, lambda c: c < F.col(id_col))), F.lit(0))
    outer = level(F.array(*[F.lit(c) for c in cuts])) if cuts else F.lit(0)
    # k rows of k cuts: k is the root of the number of ranges
    inner = (docs.select(id_col, outer.alias("_o")).groupBy("_o").agg(F.percentile_approx(id_col, shares, 10000).alias("_cuts"))
             .select(F.col("_o").alias("_p"), "_cuts"))
    out = docs.withColumn("_o", outer).join(F.broadcast(inner), F.col("_o") == F.col("_p"))
    return out.withColumn("_range", F.col("_o") * (k + 1) + level(F.coalesce("_cuts", F.array().cast("array<bigint>")))).drop("_o", "_p", "_cuts")


def successions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                range_bytes: int | None = None) -> DataFrame:
    """``(id, text, next_text, _range, _guard, _pos)``: a row for each document (``_guard`` 0)
    and, after the documents of a range, the first of the next one (``_guard`` 1)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = with_range(rows, "id", "text", range_bytes or RANGE_BYTES)
    # the first id of each range: a row a range
    w = Window.orderBy("_range")
    firsts = stored(rows.groupBy("_range").agg(F.min(F.struct("id")).alias("f")), "ranges")
    before = firsts.select(F.col("f.id").alias("_first"), F.lag("_range").over(w).alias("_to"))
    last = firsts.agg(F.max("_range").alias("_last"))
    before = before.join(F.broadcast(last)).select("_first", F.coalesce("_to", "_last").alias("_to"))
    seen = rows.join(F.broadcast(before), F.col("id").eqNullSafe(F.col("_first")), "left")
    guard = F.when(F.col("_to").isNotNull(), F.array(
        F.struct(F.col("_range").alias("_range"), F.lit(0).alias("_guard")),
        F.struct(F.col("_to").alias("_range"), F.lit(1).alias("_guard")))).otherwise(
        F.array(F.struct(F.col("_range").alias("_range"), F.lit(0).alias("_guard"))))
    dealt = seen.select("id", "text", F.inline(guard))
    order = Window.partitionBy("_range").orderBy("_guard", F.col("id").asc_nulls_first(), "text")
    return dealt.select("id", "text", "_range", "_guard", F.lead("text").over(order).alias("next_text"),
                        F.row_number().over(order).alias("_pos"))


def edited_text(text: Column, after: Column) -> Column:
    """The last quarter of the characters replaced by as many of the next text's first."""
    k = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - k), F.substring(F.coalesce(after, F.lit("")), F.lit(1), k))


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next)``, a row for each row of ``docs``."""
    s = small_batches(successions(docs, id_col, text_col)).withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    s = s.withColumn("p", fingerprints(F.col("text"), F.col("edited"))).select(
        "id", "_range", "_guard", "_pos", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("p.fingerprint").alias("fingerprint"), F.col("p.edited").alias("edited_fingerprint"))
    w = Window.partitionBy("_range").orderBy("_pos")
    s = s.withColumn("_next", F.lead("fingerprint").over(w)).where("_guard = 0")
    return s.select("id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"))


# ---- bands ----------------------------------------------------------------------

WORDS, TINY = SAMPLES // 16, 8
NIBBLES = np.uint64(0x1111111111111111)


def packed(digits: np.ndarray) -> np.ndarray:
    """Rows of SAMPLES digits 0..15 as WORDS words of 16 digits each."""
    return np.ascontiguousarray((digits[:, ::2] << 4) | digits[:, 1::2]).view(np.uint64)


#: Row n: the first n digits.
FIRST = packed((np.arange(SAMPLES) < np.arange(SAMPLES + 1)[:, None]).astype(np.uint8))


def alike(x: np.ndarray, lx: np.ndarray, y: np.ndarray, ly: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of packed rows of one spacing reach the likeness ``least``. Two words
    come first: most pairs disagree there in more digits than the whole may."""
    x, y = np.broadcast_arrays(x, y)
    shorter, longer = np.minimum(lx, ly), np.maximum(lx, ly)
    differ = np.zeros(len(x), np.int64)
    at = np.arange(len(x))
    for words in (slice(0, 2), slice(2, WORDS)):
        d = x[at, words] ^ y[at, words]
        d |= d >> np.uint64(2)
        d |= d >> np.uint64(1)
        d &= NIBBLES & FIRST[shorter[at], words]
        differ[at] += np.bitwise_count(d).sum(1, dtype=np.int64)
        at = at[(shorter[at] - differ[at]) / np.maximum(longer[at], 1) >= least]
    near = np.zeros(len(x), bool)
    near[at] = True
    return near


def near(i, j, x: np.ndarray, live: np.ndarray, up: np.ndarray, label: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of positions are links between different labels. Of the rows that meet
    another spacing, those of one spacing are compared in buckets of their own."""
    open_ = (label[i] != label[j]) & ((up[i] != up[j]) | (up[i] == 0))
    out = np.zeros(len(open_), bool)
    at = np.flatnonzero(open_)
    i, j = np.broadcast_to(i, len(open_))[at], np.broadcast_to(j, len(open_))[at]
    out[at] = alike(x[i], live[i], x[j], live[j], least)
    return out


def forest(x: np.ndarray, live: np.ndarray, up: np.ndarray, label: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Links (positions) that join the labels of one bucket as all its links would: labels
    grow from the smallest on, and one that is reached joins whole."""
    _, cls, size = np.unique(label, return_inverse=True, return_counts=True)
    members = np.split(np.argsort(cls, kind="stable"), np.cumsum(size)[:-1])
    links, taken = [], np.zeros(len(size), bool)
    for first in np.argsort(size, kind="stable"):
        if taken[first]:
            continue
        taken[first] = True
        queue = [first]
        while queue:
            own = members[queue.pop()]
            rest = np.flatnonzero(~taken[cls])
            # the shorter side is walked, the other compared at once
            walked, turned = (own, False) if len(own) <= len(rest) else (rest, True)
            for i in walked:
                others = own if turned else rest
                others = others if turned or not len(others) else others[~taken[cls[others]]]
                if turned and taken[cls[i]]:
                    continue
                hit = others[near(i, others, x, live, up, label, least)] if len(others) else others
                if turned and len(hit):
                    links.append((int(i), int(hit[0])))
                    taken[cls[i]] = True
                    queue.append(cls[i])
                elif len(hit):
                    reached, at = np.unique(cls[hit], return_index=True)
                    links += [(int(i), int(hit[k])) for k in at]
                    taken[reached] = True
                    queue += reached.tolist()
    return links


def bucket_links(batches, least: float):
    """Batches sorted by ``(gid, e)`` -> links ``(a, b)`` of nodes; holds one bucket at a time."""
    def solve(g, row, x):
        node, live, up, label = row.T
        starts = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]).any(1)])
        size = np.diff(np.r_[starts, len(g)])
        number = np.repeat(np.arange(len(starts)), size)
        found = [np.empty((0, 2), np.int64)]
        tiny = np.flatnonzero(np.repeat(size <= TINY, size))
        for s in range(1, TINY):
            i = np.flatnonzero(number[tiny[s:]] == number[tiny[:-s]]) if s < len(tiny) else []
            if not len(i):
                break
            i, j = tiny[i], tiny[i + s]
            hit = near(i, j, x, live, up, label, least)
            found.append(np.column_stack([i[hit], j[hit]]))
        for at, n in zip(starts[size > TINY], size[size > TINY]):
            part = slice(at, at + n)
            found.append(at + np.array(forest(x[part], live[part], up[part], label[part], least), np.int64).reshape(-1, 2))
        out = np.concatenate(found)
        # one link for two labels is enough
        ends = np.sort(label[out], axis=1)
        out = node[out[np.unique(ends, axis=0, return_index=True)[1]]]
        return pd.DataFrame({"a": out.min(1), "b": out.max(1)})

    rest = None
    for b in batches:
        if not len(b):
            continue
        x = np.frombuffer(b"".join(bytes(d).ljust(SAMPLES // 2, b"\0") for d in b["digits"]), np.uint64).reshape(-1, WORDS)
        new = (b[["gid", "e"]].to_numpy(np.int64), b[["node", "live", "up", "label"]].to_numpy(np.int64), x)
        rest = new if rest is None else tuple(np.concatenate(p) for p in zip(rest, new))
        cut = int(np.flatnonzero((rest[0] != rest[0][-1]).any(1))[-1]) + 1 if (rest[0] != rest[0][-1]).any() else 0
        if cut:
            yield solve(*(r[:cut] for r in rest))
            rest = tuple(r[cut:] for r in rest)
    if rest is not None:
        yield solve(*rest)


def bands_for(width: int, least: float) -> int:
    """Bands that a pair of likeness ``least`` misses with a chance of at most ``MISS``."""
    return int(np.ceil(np.log(MISS) / np.log(1 - least ** width)))


def bands(prints: DataFrame, picks: list[list[int]], *more: str, least: float = LIKE) -> DataFrame:
    """``(node, *more, up, gid)``: the buckets of each print among prints of its own spacing
    (``up`` 0). Prints of neighbouring spacings can only be alike if the finer one is nearly
    full at twice its spacing (``up`` 1) and the coarser one little over half full (``up`` 2);
    these meet in further buckets, of times that are past the end of neither."""
    half = SAMPLES // 2
    e, live = F.ascii("fp") - 97, F.length(F.translate("fp", "-", "")) - 1
    digit = lambda i, up: F.substring("fp", 2 + (i << up), 1)
    def keys(up, step, family, of):
        return F.array(*[F.struct(F.lit(up).alias("up"), F.xxhash64(F.lit(b + family), e + step, *[digit(i, step) for i in pick]).alias("gid"))
                         for b, pick in enumerate(of)])

    beside = [sorted({i % half for i in pick}) for pick in picks]
    none = F.array().cast("array<struct<up:int,gid:bigint>>")
    return prints.select("node", *more, F.inline(F.concat(
        keys(0, 0, 0, picks),
        F.when(F.shiftright(live + 1, 1) >= least * (half + 1), keys(1, 1, len(picks), beside)).otherwise(none),
        F.when((e > 0) & (live <= half / least), keys(2, 0, len(picks), beside)).otherwise(none))))


def orders(n: int, seed: int) -> list[list[int]]:
    """``n`` orders of all sampling times; the halves take turns, as the later one may be past the end."""
    rng, half = np.random.default_rng(seed), SAMPLES // 2
    return [np.column_stack([rng.permutation(half), half + rng.permutation(half)]).ravel().tolist() for _ in range(n)]


def chosen_picks(prints: DataFrame, least: float, seed: int) -> list[list[int]]:
    """Sampling times of each band. The width is the cheapest by counted collisions: every
    print's own spacing enters COUNTED bands of each width; a pair costs a comparison, a
    band row ROW_COST of them."""
    drawn = orders(bands_for(max(WIDTHS), least), seed)
    e = F.ascii("fp") - 97
    keys = [F.struct(F.lit(w).alias("w"), F.xxhash64(F.lit(b), F.lit(w), e, *[F.substring("fp", 2 + i, 1) for i in drawn[b][:w]]).alias("k"))
            for w in WIDTHS for b in range(COUNTED)]
    sizes = prints.select(F.inline(F.array(*keys))).groupBy("w", "k").count()
    n = F.col("count").cast("double")
    cost = {r["w"]: bands_for(r["w"], least) * (ROW_COST * r["n"] + r["pairs"]) for r in
            sizes.groupBy("w").agg(F.sum(n).alias("n"), F.sum(n * (n - 1) / 2).alias("pairs")).collect()}
    width = min(cost, key=lambda w: (cost[w], w)) if cost else WIDTHS[0]
    return [order[:width] for order in drawn[:bands_for(width, least)]]


def star_links(prints: DataFrame, picks: list[list[int]], least: float) -> DataFrame:
    """Links of prints to the least print of their buckets in the first STARS bands."""
    rows = bands(prints, picks[:STARS], least=least)
    pairs = (rows.join(rows.groupBy("gid").agg(F.min("node").alias("pivot")).withColumnRenamed("gid", "g"), F.col("gid") == F.col("g"))
             .where("node <> pivot").select("node", "pivot").distinct())
    a, b = (prints.select(F.col("node").alias(f"n{c}"), F.col("fp").alias(c)) for c in "ab")
    return (pairs.join(a, F.col("node") == F.col("na")).join(b, F.col("pivot") == F.col("nb"))
            .where(likeness(F.col("a"), F.col("b")) >= least).select(F.col("pivot").alias("a"), F.col("node").alias("b")))


def dealt(rows: DataFrame, block: int) -> DataFrame:
    """``rows`` ``(node, up, label, gid, n)`` with buckets of more than ``block`` rows cut up.
    Rows of one label need not meet. The most frequent label of a bucket is cut into blocks,
    the others into chunks; a block meets every chunk, a chunk every chunk: copies follow
    the lesser side, and no pair of different labels is lost."""
    labels = rows.where(F.col("n") > block).groupBy("gid", "label").count()
    hot = labels.groupBy("gid").agg(F.max(F.struct("count", "label")).alias("top"), F.sum("count").alias("all")).select(
        F.col("gid").alias("hot"), F.col("top.label").alias("major"),
        F.ceil(F.col("top.count") / block).cast("int").alias("blocks"),
        F.ceil((F.col("all") - F.col("top.count")) / block).cast("int").alias("chunks"))
    blocks, chunks, major = F.col("blocks"), F.col("chunks"), F.col("label") == F.col("major")
    k = F.pmod(F.xxhash64("node"), F.when(major, blocks).otherwise(chunks)).cast("int")
    each = lambda n: F.sequence(F.lit(0), n - 1)
    met = F.when(F.col("hot").isNull(), F.array("gid")).when(
        major, F.transform(each(chunks), lambda c: F.xxhash64("gid", F.lit("m"), k, c))).otherwise(F.concat(
            F.transform(each(blocks), lambda s: F.xxhash64("gid", F.lit("m"), s, k)),
            F.transform(each(chunks), lambda c: F.xxhash64("gid", F.lit("o"), F.least(k, c), F.greatest(k, c)))))
    return (rows.join(hot, F.col("gid") == F.col("hot"), "left")
            .select("node", "up", "label", F.explode(met).alias("gid")))


def node_links(prints: DataFrame, least: float = LIKE, block: int = BLOCK, seed: int = 3) -> DataFrame:
    """Links ``(a, b)`` of nodes that connect the fingerprints of likeness ``least`` or more
    that share a band, as all their pairs would. ``prints``: distinct ``fp``, each with a
    long ``node``. Stars come first: their components are labels, and only buckets that
    hold several labels are verified."""
    picks = chosen_picks(prints, least, seed)
    stars = stored(star_links(prints, picks, least), "stars", free=True)
    of = components(stars).select(F.col("node").alias("linked"), "component")
    labelled = stored(prints.join(of, F.col("node") == F.col("linked"), "left")
                      .select("node", "fp", F.coalesce("component", "node").alias("label")), "labelled", free=True)
    banded = bands(labelled, picks, "label", least=least)
    mixed = stored(banded.groupBy("gid").agg(
        F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("up").alias("u"), F.max("up").alias("v"))
        .where("lo <> hi and (u = 0 or u <> v)").select(F.col("gid").alias("g"), "n"), "mixed", free=True)
    rows = stored(banded.join(mixed, F.col("gid") == F.col("g"))
                  .select("node", "up", "label", "gid", "n"), "banded", free=True)
    # the digits at either spacing; at twice its own a print has every second one
    digits = F.translate(F.substring("fp", 2, SAMPLES), "-", "0")
    own = prints.select(F.col("node").alias("_node"), (F.ascii("fp") - 97).alias("_e"), F.length(F.translate("fp", "-", "")).alias("_n"),
                        F.unhex(digits).alias("own"), F.unhex(F.regexp_replace(digits, "(.).", "$1")).alias("wide"))
    rows = dealt(rows, block).join(own, F.col("node") == F.col("_node")).select(
        "node", "up", "label", "gid", (F.col("_e") + (F.col("up") == 1).cast("int")).alias("e"),
        F.when(F.col("up") != 1, F.col("_n") - 1).otherwise(F.shiftright("_n", 1)).alias("live"),
        F.when(F.col("up") != 1, F.col("own")).otherwise(F.col("wide")).alias("digits"))
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (rows.repartition(n, "gid").sortWithinPartitions("gid", "e")
             .mapInPandas(lambda it: bucket_links(it, least), "a long, b long").distinct())
    return stars.unionByName(found)


def near_links(prints: DataFrame, least: float = LIKE, block: int = BLOCK, seed: int = 3) -> DataFrame:
    """``node_links`` between the fingerprints themselves. ``prints``: one distinct column ``fp``."""
    named = stored(prints.select("fp", F.monotonically_increasing_id().alias("node")), "prints")
    a, b = (named.select(F.col("fp").alias(c), F.col("node").alias(f"n{c}")) for c in "ab")
    links = node_links(named, least, block, seed).select(F.col("a").alias("na"), F.col("b").alias("nb"))
    return links.join(a, "na").join(b, "nb").select("a", "b")


def with_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``described`` plus ``component_id``: the least id of the documents whose
    fingerprints are linked, directly or through others (null ids only where no other is)."""
    rows = stored(described(docs, id_col, text_col), "editprints", free=True)
    prints = stored(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("id").alias("least"))
                    .withColumn("node", F.monotonically_increasing_id()), "prints")
    comp = components(node_links(prints.select("fp", "node"))).withColumnRenamed("node", "linked")
    merged = stored(prints.join(comp, F.col("node") == F.col("linked"), "left").select(
        "fp", "least", F.coalesce("component", "node").alias("component")), "classes")
    ids = merged.groupBy("component").agg(F.min("least").alias("component_id"))
    named = merged.join(ids, "component").select("fp", "component_id")
    return rows.join(named, F.col("fingerprint") == F.col("fp")).select(*rows.columns, "component_id")
