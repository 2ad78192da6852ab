"""SimHash near-dedup against all pairs, the threshold plan, hot buckets, edge rows."""

import itertools
import re

import numpy as np
import pytest
import xxhash

from barforge.llm import queries
from barforge.llm import simhash as sh
from barforge.llm.common import components
from tests.conftest import MEDIUM

SCHEMA = "doc_id long, text string, fingerprint string, component_id long, fp long"


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", low)
    if not w:
        return 0
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, ids, most=4):
    rep = dict(zip(fps, fps))

    def root(x):
        while rep[x] != x:
            x = rep[x]
        return x
    for a, b in itertools.combinations(sorted(set(fps)), 2):
        if (a ^ b).bit_count() <= most:
            rep[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for f, i in zip(fps, ids):
        if i is not None:
            least[root(f)] = min(least.get(root(f), i), i)
    return [least.get(root(f)) for f in fps]


def test_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()
    fps = [plain_fingerprint(r["text"]) for r in docs]
    comp = plain_components(fps, [r["doc_id"] for r in docs])
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.QUERIES["op1_simhash"](spark, MEDIUM).collect()}
    assert got == {r["doc_id"]: (f"{f:016x}", c) for r, f, c in zip(docs, fps, comp)}
    assert any(c != r["doc_id"] for r, c in zip(docs, comp))


@pytest.mark.parametrize("most", [2, 3, 4, 6])
def test_links_connect_what_all_pairs_connect(spark, most):
    rng = np.random.default_rng(most)
    seeds = rng.integers(0, 2**63, 40, dtype=np.int64)
    noisy = [int(s) ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 8), replace=False))
             for s in seeds for _ in range(12)]
    fps = sorted(set(noisy) | {0, -1})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for block in (2048, 5):  # 5: every larger bucket is cut into block pairs
        comp = {r["node"]: r["component"] for r in components(sh.links(df, most, block)).collect()}
        mine = [comp.get(f, f) for f in fps]
        unsigned = [f % 2**64 for f in fps]
        assert mine == plain_components(unsigned, fps, most)


def test_thresholds_are_the_cheapest_split():
    costs = [[0.0, 5.0, 9.0], [0.0, 1.0, 2.0], [0.0, 50.0, 70.0]]
    best, ts = sh.thresholds(costs, 0)
    plain = min((sum(c[t + 1] for c, t in zip(costs, p)), p) for p in itertools.product((-1, 0, 1), repeat=3) if sum(p) == 0)
    assert (best, tuple(ts)) == plain


def test_edge_rows(spark):
    text = "One two THREE four five six"
    rows = [(5, text, "x", 9, 1), (3, text.lower(), None, None, None), (3, text.lower(), None, None, None),
            (7, None, "", 0, 0), (8, "", None, 0, 0), (9, " \t\n", None, 0, 0), (None, text, None, 0, 0),
            (10, "two words", None, 0, 0), (11, "w " * 200_000, None, 0, 0), (None, "quite other text than all of these", "", 1, 1)]
    out = sh.with_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    by = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in out}
    for (i, t, *_), got in zip(rows, [next(c for (d, f), c in by.items() if d == i and f == f"{plain_fingerprint(t):016x}") for i, t, *_ in rows]):
        want = plain_components([plain_fingerprint(x[1]) for x in rows], [x[0] for x in rows])[[x[:2] for x in rows].index((i, t))]
        assert got == want
    assert by[(7, "0" * 16)] == by[(8, "0" * 16)] == by[(9, "0" * 16)]
    assert sh.with_components(spark.createDataFrame([], SCHEMA)).count() == 0
