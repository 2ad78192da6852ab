"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints: XXH64 (seed 42) of every k-word shingle, repeats included; a bit
is set if it is set in over half the hashes. Two fingerprints are linked if
they differ in at most ``max_bits`` bits.

Links are found by the generalised pigeonhole: the 64 bits are dealt to m
parts, bits that vary together to the same part, and part i gets a threshold
t_i >= -1 with sum(t_i) = max_bits - m + 1. Two linked fingerprints then differ
in at most t_i bits on some part i. Thresholds are unequal: a dynamic programme
picks the ones with the fewest estimated candidates and probes, and the
cheapest m wins. The estimate rests on counts over all fingerprints: the pairs
that share a part's bits exactly, times the growth that each bit's own
variability gives for 1, 2, ... differing bits.

Every fingerprint enters the buckets of its own parts and probes those within
t_i bits. A bucket is verified bit by bit inside one task and yields a
spanning forest of its links, never all pairs. Exact copies share one
fingerprint and are one row here. A bucket of more than ``BLOCK`` fingerprints
is cut into blocks by hash and every pair of blocks is verified by itself, so
no task holds more than two blocks; no pair is lost. How many fingerprints lie
close together is bounded by the number of bit patterns, not by the documents.
Components follow from the forests by star contraction (common.components).

Defined cases: a null, empty or blank text has no words, fingerprint zero, and
is linked like any other; fewer than k words are one shingle; equal texts share
fingerprint and component; rows with a null id keep their fingerprint and get
the least id that is reachable (null if none); repeated rows are all returned;
an empty table gives an empty result; further columns, whatever their names,
are not touched by ``with_components`` (only ``fingerprint`` and
``component_id`` are replaced).
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import components, small_batches, stored, text_bytes

BITS = 64
SEED = 42
WORDS = 4
MAX_BITS = 4
BLOCK = 2048
SLICE = 65536


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Unsigned 64-bit SimHash of one text."""
    w = text.lower().split()  # on bytes: A-Z, and \x20 \x09-\x0d
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum([len(x) + 1 for x in w])
    starts = [0, *ends[:-1].tolist()]
    ends = (ends - 1).tolist()
    k = min(words, len(w))
    ones, n = np.zeros(BITS, np.int64), len(w) - k + 1
    digest = xxhash.xxh64_intdigest
    for lo in range(0, n, SLICE):
        hi = min(n, lo + SLICE)
        h = np.array([digest(joined[a:b], SEED) for a, b in
                      zip(starts[lo:hi], ends[lo + k - 1:hi + k - 1])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(text: Column, words: int = WORDS) -> Column:
    """The fingerprint as a signed long."""
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

    return simhash(text_bytes(text))


# ---- parts and thresholds -------------------------------------------------------

def bit_moments(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 counts of bits set together: one
    64 x 64 table a task, summed."""
    def partial(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            x = b["fp"].to_numpy(np.int64)
            bits = columns(x)  # 64 rows of packed bits; counting them needs no matrix of floats
            for i in range(BITS):
                total[i, i:] += np.bitwise_count(bits[i:] & bits[i]).sum(1)
            n += len(x)
        total += np.triu(total, 1).T
        yield pd.DataFrame({"n": [n], "both": [total.ravel().tolist()]})

    rows = fps.select("fp").mapInPandas(partial, "n long, both array<double>")
    cells = (rows.select("n", F.posexplode("both").alias("cell", "v"))
             .groupBy("cell").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).collect())
    both = np.zeros(BITS * BITS)
    for r in cells:
        both[r["cell"]] = r["v"]
    return (int(cells[0]["n"]) if cells else 0), both.reshape(BITS, BITS)


def columns(x: np.ndarray) -> np.ndarray:
    """Row b: bit b of every fingerprint, packed."""
    bits = np.unpackbits(x.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits, axis=0).T


def grouped_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m parts of near equal size; each grows by the bit most correlated with it."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    rho = np.abs(cov / np.outer(sd, sd))
    free, parts = set(range(BITS)), []
    for i in range(m):
        size = BITS // m + (i < BITS % m)
        rest = sorted(free)
        part = [max(rest, key=lambda b: (rho[b, rest].sum(), -b))]
        free.discard(part[0])
        while len(part) < size:
            nxt = max(sorted(free), key=lambda b: (rho[b, part].sum(), -b))
            part.append(nxt)
            free.discard(nxt)
        parts.append(sorted(part))
    return parts


def mask_of(part: list[int]) -> int:
    return int(np.array(sum(1 << b for b in part), np.uint64).view(np.int64))


def spread(differ: np.ndarray, most: int) -> np.ndarray:
    """P(at most t bits differ) / P(none differs), t = 0..most, bits taken one by one."""
    dist = np.zeros(most + 1)
    dist[0] = 1.0
    for q in np.clip(differ, 1e-6, 1 - 1e-6):
        dist[1:] = dist[1:] * (1 - q) + dist[:-1] * q
        dist[0] *= 1 - q
    return np.cumsum(dist) / dist[0]


def thresholds(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Least total cost over t_i in -1..; ``costs[i][t + 1]`` is part i's cost at
    t. Dynamic programme over the parts and the sum spent so far."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for spent, (c, ts) in best.items():
            for t in range(-1, len(cost) - 1):
                cand = (c + cost[t + 1], [*ts, t])
                if spent + t not in nxt or cand < nxt[spent + t]:
                    nxt[spent + t] = cand
        best = nxt
    return best[total]


def plan_parts(fps: DataFrame, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the parts that are probed."""
    n, both = bit_moments(fps)
    choices = {m: grouped_bits(n, both, m) for m in range(max(2, (max_bits + 2) // 2), max_bits + 2)}
    keys = [(m, i, mask_of(part)) for m, parts in choices.items() for i, part in enumerate(parts)]
    sizes = (fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(k)).alias("v"))
        for m, i, k in keys])).alias("x")).groupBy("x").count()
        .groupBy("x.m", "x.i").agg(F.sum((F.col("count") * (F.col("count") - 1) / 2).cast("double")).alias("pairs"))
        .collect())
    same = {(r["m"], r["i"]): r["pairs"] for r in sizes}
    p = np.diag(both) / max(n, 1)
    offers = []
    for m, parts in choices.items():
        total = max_bits - m + 1
        costs = []
        for i, part in enumerate(parts):
            grow = spread(2 * p[part] * (1 - p[part]), max(total, 0))
            probes = np.cumsum([comb(len(part), t) for t in range(max(total, 0) + 1)])
            # a candidate costs one comparison, a probe one shuffled row
            costs.append([0.0] + [float(same.get((m, i), 0.0) * g + 100.0 * n * k) for g, k in zip(grow, probes)])
        cost, ts = thresholds(costs, total)
        offers.append((cost, m, [(part, t) for part, t in zip(parts, ts) if t >= 0]))
    return min(offers)[2]


# ---- buckets and links ----------------------------------------------------------

def forest(x: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning links of one bucket: breadth first, each fingerprint is compared
    with those that no tree has taken yet."""
    links, free = [], np.unique(x)
    while len(free) > 1:
        queue, free = [free[0]], free[1:]
        while queue and len(free):
            node = queue.pop()
            near = np.bitwise_count((free ^ node).view(np.uint64)) <= max_bits
            if near.any():
                links += [(int(node), int(v)) for v in free[near]]
                queue += list(free[near])
                free = free[~near]
    return links


def small_links(gid: np.ndarray, x: np.ndarray, most: int, max_bits: int) -> np.ndarray:
    """Links of many buckets of at most ``most`` rows each, sorted by bucket."""
    found = []
    for s in range(1, most):
        same = gid[s:] == gid[:-s]
        if not same.any():
            break
        a, b = x[:-s][same], x[s:][same]
        near = np.bitwise_count((a ^ b).view(np.uint64)) <= max_bits
        found.append(np.column_stack([a[near], b[near]]))
    return np.concatenate(found) if found else np.empty((0, 2), np.int64)


def bucket_links(batches, max_bits: int = MAX_BITS, small: int = 8):
    """Batches sorted by bucket -> spanning links; holds one bucket at a time."""
    def solve(gid, x):
        starts = np.flatnonzero(np.r_[True, gid[1:] != gid[:-1]])
        size = np.diff(np.r_[starts, len(gid)])
        tiny = np.repeat(size <= small, size)
        links = [small_links(gid[tiny], x[tiny], small, max_bits)]
        for a, n in zip(starts[size > small], size[size > small]):
            links.append(np.array(forest(x[a:a + n], max_bits), np.int64).reshape(-1, 2))
        out = np.unique(np.concatenate(links), axis=0)
        return pd.DataFrame({"a": out[:, 0], "b": out[:, 1]})

    rest_g, rest_x = np.empty(0, np.int64), np.empty(0, np.int64)
    for b in batches:
        g = np.r_[rest_g, b["gid"].to_numpy(np.int64)]
        x = np.r_[rest_x, b["fp"].to_numpy(np.int64)]
        if not len(g):
            continue
        cut = int(np.searchsorted(g, g[-1]))
        if cut:
            yield solve(g[:cut], x[:cut])
        rest_g, rest_x = g[cut:], x[cut:]
    if len(rest_g):
        yield solve(rest_g, rest_x)


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` that connect the same fingerprints as all pairs within
    ``max_bits`` would. ``fps``: one column ``fp``, distinct."""
    def signatures(i: int, part: list[int], t: int) -> Column:
        own = F.col("fp").bitwiseAND(F.lit(mask_of(part)))
        flips = [mask_of(list(c)) for k in range(t + 1) for c in combinations(part, k)]
        return F.transform(F.array(*[F.lit(f) for f in flips]),
                           lambda f: F.struct(F.lit(i).alias("part"), own.bitwiseXOR(f).alias("v")))

    entries = [signatures(i, part, t) for i, (part, t) in enumerate(plan_parts(fps, max_bits))]
    rows = fps.select("fp", F.inline(F.concat(*entries)))
    counts = rows.groupBy("part", "v").count().where("count > 1").select(
        F.col("part").alias("p"), F.col("v").alias("w"), F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    rows = rows.join(counts, (F.col("part") == F.col("p")) & (F.col("v") == F.col("w")))
    # one block: the bucket itself; else each fingerprint meets its own block paired with every block
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    rows = rows.select("fp", "part", "v", mine.alias("s"),
                       F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    rows = rows.select("fp", F.xxhash64("part", "v", F.least("s", "o"), F.greatest("s", "o")).alias("gid"))
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(n, "gid").sortWithinPartitions("gid")
            .mapInPandas(lambda it: bucket_links(it, max_bits), "a long, b long").distinct())


def classes(docs: DataFrame, words: int, max_bits: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Stored rows ``(id, fp)``, and ``(fp, component, component_id)`` of each
    distinct fingerprint."""
    rows = stored(small_batches(docs).select(
        F.col(id_col).alias("id"), fingerprints(F.col(text_col), words).alias("fp")), "simhash")
    fps = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "fingerprints")
    comp = components(links(fps.select("fp"), max_bits))
    merged = fps.join(comp, fps.fp == comp.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    ids = merged.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows, merged.join(ids, "component").select("fp", "component", "component_id")


def with_components(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(id, fingerprint hex, component_id)``, a row for each row of ``docs``."""
    rows, named = classes(docs, words, max_bits, id_col, text_col)
    return rows.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one of least id (a null id only
    where no row of the component has one); of rows with that id, the one of
    least fingerprint; of equal rows, one."""
    rows, named = classes(docs, words, max_bits, id_col, text_col)
    kept = (rows.distinct().join(named, "fp").groupBy("component")
            .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp")).alias("r"))
            .select(F.col("r.id").alias("_id"), F.col("r.fp").alias("_fp")))
    marked = small_batches(docs).withColumn("__simhash", fingerprints(F.col(text_col), words))
    return (marked.join(kept, marked[id_col].eqNullSafe(kept["_id"]) & (marked["__simhash"] == kept["_fp"]), "left_semi")
            .dropDuplicates([id_col, "__simhash"]).drop("__simhash"))
