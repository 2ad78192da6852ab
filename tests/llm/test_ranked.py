"""Ranked search against SQL, a plain recomputation, and with every kind of bucket."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from barforge.llm import queries, ranked
from tests.conftest import MEDIUM
from tests.oracle_check import compare

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain(docs, items, k=10):
    split = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    split = [(i, c, sum(c.values())) for i, c in split if c]
    texts, words = len(split), sum(n for _, _, n in split)
    df = Counter(t for _, c, _ in split for t in c)
    out = []
    for item, text in items:
        scores = []
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        for i, c, n in split:
            m = 100 - 75 + (75 * n * texts) // words
            s = sum(q * math.floor(1000 * math.log((2 * texts + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t, q in asked.items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def made(rng, n_docs, n_items):
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 4))) for _ in range(300)] + ["It's", "X-1", "Ünder", "中文"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: " ".join(rng.choices(words, weights, k=n))
    docs = [text(rng.randint(0, 60)) for _ in range(n_docs)]
    items = [text(rng.randint(0, 25)) for _ in range(n_items)]
    for t in items[:5]:  # whole items inside documents, and many copies
        docs += [f"{text(9)}\n{t}, {t}"] * 13
    docs += [None, "", " -- ", "a " * 5000]
    return docs, items


def test_query_equals_sql(spark, duck_medium):
    info = compare(spark, duck_medium, "op11_ranked", queries.QUERIES["op11_ranked"], queries.ORACLE["op11_ranked"], MEDIUM)
    assert info["ok"] and info["rows"] > 0, info


def test_equals_the_plain_way_at_any_cut(spark, monkeypatch):
    docs, items = made(random.Random(5), 500, 30)
    items += [None, "", "nowhere zzz"]
    d = spark.createDataFrame([(i if i % 97 else None, t, 1) for i, t in enumerate(docs)], "doc_id long, text string, uid int").repartition(5)
    q = spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(items)], "item_id string, text string")
    want = sorted(plain([(i if i % 97 else None, t) for i, t in enumerate(docs)], [(f"q{i}", t) for i, t in enumerate(items)]), key=str)
    for block, seed, run, bucket in ((1 << 16, 1 << 14, 1 << 15, 1 << 11), (60, 16, 40, 7), (1, 1, 100, 1)):
        for name, value in (("BLOCK", block), ("SEED", seed), ("RUN", run), ("BUCKET", bucket)):
            monkeypatch.setattr(ranked, name, value)
        if block == 1:  # every query a block of its own: a few are enough
            q = q.where("item_id in ('q0', 'q7')")
            want = [r for r in want if r[0] in ("q0", "q7")]
        assert sorted(map(tuple, ranked.rank_documents(d, q).collect()), key=str) == want


def test_bounds_leave_out_most_lists():
    """With thresholds, far fewer entries are read than without, and the result is the same."""
    rng = np.random.default_rng(1)
    term = np.concatenate([rng.choice(400, 20, replace=False) for _ in range(6000)])
    impact = rng.integers(1, 600_000, len(term))
    at, place = np.arange(0, len(term) + 1, 20), rng.permutation(6000)
    names = [f"t{i:03d}" for i in range(400)]
    rows = pa.table({"uid": np.repeat(np.arange(8), 10), "term": [names[t] for q in range(8) for t in range(q * 10, q * 10 + 10)],
                     "times": np.ones(80, np.int64), "w": np.tile(np.r_[[9000, 8000], np.full(8, 100)], 8)})
    block = ranked.Block.of(rows, {})
    code = np.array([block.terms.to_pylist().index(n) if n in block.terms.to_pylist() else -1 for n in names])
    known = code[term] >= 0
    at = np.r_[0, np.cumsum(known)][at]
    whole = ranked.Search(block, 10)
    whole.run(at, code[term][known], impact[known], place)
    dense = np.zeros((6000, len(block.terms)), np.int64)
    dense[np.repeat(np.arange(6000), np.diff(at)), code[term][known]] = impact[known]
    for q in range(8):
        lo, hi = block.first[q], block.first[q + 1]
        score = dense[:, block.term[lo:hi]] @ block.whole[lo:hi]
        by = np.lexsort((place, -score))[:10]
        assert whole.best[q][0].tolist() == score[by].tolist() and whole.best[q][1].tolist() == place[by].tolist()
    everything = sum(int((dense[:, block.term[block.first[q]:block.first[q + 1]]] > 0).sum()) for q in range(8))
    assert whole.read < everything / 2


def test_edge_rows(spark):
    d = spark.createDataFrame([(1, "a b", 5), (1, "a b", 6), (None, "a c", 7), (2, None, 8), (3, "", 9)], "doc_id long, text string, score int")
    q = spark.createDataFrame([("x", "A, a; b"), ("x", "A, a; b"), ("y", None), (None, "c")], "item_id string, text string")
    got = sorted(map(tuple, ranked.rank_documents(d, q).collect()), key=str)
    one = plain([(1, "a b"), (1, "a b"), (None, "a c")], [("x", "A, a; b"), ("x", "A, a; b"), (None, "c")])
    assert got == sorted(one, key=str)
    assert ranked.rank_documents(d.limit(0), q).count() == 0 and ranked.rank_documents(d, q.limit(0)).count() == 0
