"""Edit-embedding fingerprints against a plain walk, plain successions, bands, edge rows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barforge.llm import editprint as ep
from barforge.llm import queries
from tests.conftest import MEDIUM


def plain_like(a, b):
    if a == b:
        return 1.0
    e = max(ord(a[0]), ord(b[0]))
    x, y = ((p[1:][::1 << (e - ord(p[0]))] + "-" * ep.SAMPLES)[:ep.SAMPLES] for p in (a, b))
    both = [(i, j) for i, j in zip(x, y) if (i, j) != ("-", "-")]
    return sum(i == j for i, j in both) / len(both) if both else 0.0


def plain_rows(docs):
    """Rows of the query by the rule, one document after the other."""
    d = sorted(((i, t or "") for i, t in docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for n, (i, t) in enumerate(d):
        nxt, k = d[(n + 1) % len(d)][1], len(t) // 4
        edited = t[:len(t) - k] + nxt[:k]
        f, g = ep.fingerprint(t), ep.fingerprint(edited)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f, g,
                    round(plain_like(f, g), 9), round(plain_like(f, ep.fingerprint(nxt)), 9)))
    return sorted(out, key=repr)


def rounded(rows):
    return sorted((tuple(r)[:5] + (round(r[5], 9), round(r[6], 9)) for r in rows), key=repr)


def test_query_equals_plain_succession(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.QUERIES["op8_editprints"](spark, MEDIUM).collect()
    assert rounded(rows) == plain_rows(docs)
    assert sum(r["near_edited"] for r in rows) / len(rows) > 0.7 > 0.2 > sum(r["near_next"] for r in rows) / len(rows)


def test_walk_is_the_step_by_step_embedding():
    rng = random.Random(1)
    for n in (1, 7, 200, 3000):
        text = "".join(rng.choice("abcdé中 ") for _ in range(n))
        _, k = ep.codes(text)
        times = []
        end = ep.walk(k, 0, times)
        j, i, reached = 0, 0, [0]
        while i < n:  # at each time: stay or move on, as the shared bit says
            moves = ep.STAY[k[i]][j % ep.PERIOD] == 1
            j += 1
            if moves:
                i += 1
                reached.append(j)
        assert times + [end] == reached


def test_common_beginning_changes_nothing_and_edits_keep_likeness():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8)))
    for n in (0, 1, 30, 400, 3000):
        text = " ".join(word() for _ in range(n))
        for other in ("", text, text[: len(text) // 2] + "x" + text[len(text) // 2:], text[3:], "quite " + text):
            assert ep.fingerprint_pair(text, other) == (ep.fingerprint(text), ep.fingerprint(other))
    text = " ".join(word() for _ in range(2000))
    near = text[:2000] + "inserted " + text[2000:4000] + text[4007:]
    far = " ".join(word() for _ in range(2000))
    f = ep.fingerprint
    assert plain_like(f(text), f(near)) > 0.6 > 0.3 > plain_like(f(text), f(far))


@pytest.mark.parametrize("size", [1, 50, 4 << 20])
def test_edge_rows(spark, size):
    rows = [(5, "abcdefgh" * 9), (2, None), (3, ""), (9, "é中🙂x" * 30_000), (7, "seven eight nine"), (7, "seven eight nine"), (7, "another"),
            (None, "no id at all"), (None, "none either"), (-4, "minus four")] + [(100 + i, f"text number {i} " * i) for i in range(30)]
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, fingerprint string, id int, _range int")
    s = ep.successions(docs, range_bytes=size)
    assert s.where("_guard = 0").count() == len(rows)
    old, ep.RANGE_BYTES = ep.RANGE_BYTES, size
    try:
        got = rounded(ep.described(docs).collect())
    finally:
        ep.RANGE_BYTES = old
    assert got == plain_rows(rows)
    assert ep.described(docs.limit(0)).count() == 0
    one = ep.described(docs.where("doc_id = 5")).collect()
    assert rounded(one) == plain_rows([rows[0]])


def test_bands_find_near_fingerprints_and_verify(spark):
    rng = random.Random(6)
    texts = []
    for _ in range(25):
        t = "".join(rng.choice("abcdefghij klm") for _ in range(rng.randint(300, 4000)))
        texts += [t, t[:-9] + "other end", t[:len(t) * 9 // 10]]
    prints = sorted({ep.fingerprint(t) for t in texts} | {ep.fingerprint("")})
    df = spark.createDataFrame([(p,) for p in prints], "fp string")
    want = {(a, b) for i, a in enumerate(prints) for b in prints[i + 1:] if plain_like(a, b) >= ep.LIKE}
    for block in (1024, 2):
        got = {tuple(sorted((r["a"], r["b"]))) for r in ep.near_links(df, block=block).collect()}
        assert got <= want

        def classes(links):
            rep = {p: p for p in prints}

            def root(x):
                while rep[x] != x:
                    x = rep[x]
                return x
            for a, b in links:
                rep[max(root(a), root(b))] = min(root(a), root(b))
            return [root(p) for p in prints]
        same = sum(a == b for a, b in zip(classes(got), classes(want)))
        assert same >= 0.97 * len(prints)


def test_likeness_of_columns(spark):
    texts = ["", "a", "short text", "a longer text " * 30, "a longer text " * 31, "other words " * 500]
    p = [ep.fingerprint(t) for t in texts]
    df = spark.createDataFrame([(a, b) for a in p for b in p], "a string, b string")
    for r in df.select("a", "b", ep.likeness(F.col("a"), F.col("b")).alias("v")).collect():
        assert abs(r["v"] - plain_like(r["a"], r["b"])) < 1e-12


def test_query_links_documents_as_brute_force_does(spark):
    rows = queries.QUERIES["op8_editprints"](spark, MEDIUM).collect()
    prints = sorted({r["fingerprint"] for r in rows})
    rep = list(range(len(prints)))

    def root(i):
        while rep[i] != i:
            i = rep[i]
        return i
    near = [(i, i + 1 + int(j)) for i, p in enumerate(prints[:-1])
            for j in (ep.likenesses([p] * (len(prints) - i - 1), prints[i + 1:]) >= ep.LIKE).nonzero()[0]]
    for i, j in near:
        rep[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for r in rows:
        k = root(prints.index(r["fingerprint"]))
        least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    got = {r["fingerprint"]: r["component_id"] for r in rows}
    assert len(near) > 10 and all(got[r["fingerprint"]] == r["component_id"] for r in rows)
    recall = sum(got[prints[i]] == got[prints[j]] for i, j in near) / len(near)
    print("linked pairs", len(near), "recall", recall)
    assert recall >= 0.99
    # no component holds documents that brute force keeps apart
    whole = {}
    for i, p in enumerate(prints):
        whole.setdefault(got[p], set()).add(root(i))
    assert all(len(v) == 1 for v in whole.values())
    if recall == 1:
        assert all(r["component_id"] == least[root(prints.index(r["fingerprint"]))] for r in rows)


def test_components_of_edge_rows(spark):
    rows = [(5, "abcdefgh" * 9), (2, None), (3, ""), (8, "abcdefgh" * 9), (None, "no id at all"), (None, ""), (7, "q" * 500 + "w" * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["id"], r["component_id"]) for r in ep.with_components(docs).collect()), key=repr)
    assert got == sorted([(5, 5), (2, 2), (3, 2), (8, 5), (None, None), (None, 2), (7, 7)], key=repr)
    assert ep.with_components(docs.limit(0)).count() == 0


def connected(n, links):
    rep = list(range(n))

    def root(i):
        while rep[i] != i:
            i = rep[i]
        return i
    for i, j in links:
        rep[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(n)]


def test_forest_joins_the_labels_that_all_links_join():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(2, 60))
        centres = rng.integers(0, 16, (4, ep.SAMPLES))
        digits = centres[rng.integers(0, 4, n)]
        digits = np.where(rng.random(digits.shape) < rng.choice([0.05, 0.1, 0.2]), rng.integers(0, 16, digits.shape), digits)
        x = ep.packed(digits.astype(np.uint8))
        live, up = rng.integers(100, ep.SAMPLES + 1, n), rng.integers(0, 2, n)
        label = rng.integers(0, rng.choice([2, 8, 60]), n)
        pairs = [(i, j) for i in range(n) for j in range(i) if ep.near(np.array([i]), np.array([j]), x, live, up, label, ep.LIKE)[0]]
        same = [(i, j) for i in range(n) for j in range(i) if label[i] == label[j]]
        links = ep.forest(x, live, up, label, ep.LIKE)
        assert connected(n, links + same) == connected(n, pairs + same)
        assert {tuple(sorted(p, reverse=True)) for p in links} <= set(pairs)
        assert len(links) < len(set(label.tolist()))


def test_hot_buckets_lose_no_pair_of_labels(spark):
    sizes = {1: [300, 5, 3], 2: [40, 40, 40], 3: [6, 2], 4: [1] * 90}  # bucket -> rows of each label
    rows = [(100_000 * g + 1000 * k + i, 0, 1000 * g + k, g, sum(c)) for g, c in sizes.items() for k, m in enumerate(c) for i in range(m)]
    df = spark.createDataFrame(rows, "node long, up int, label long, gid long, n long")
    met, copies = {}, {}
    for r in ep.dealt(df, 10).collect():
        met.setdefault(r["gid"], []).append((r["node"], r["label"]))
        copies[r["node"]] = copies.get(r["node"], 0) + 1
    together = {(a, b) for m in met.values() for a, la in m for b, lb in m if la != lb}
    for g in sizes:
        mine = [(r[0], r[2]) for r in rows if r[3] == g]
        assert all((a, b) in together for a, la in mine for b, lb in mine if la != lb)
    # the frequent label of a bucket with few others is not copied
    assert all(copies[r[0]] == 1 for r in rows if r[2] == 1000)


def test_recall_of_a_group_of_near_copies(spark):
    rng = random.Random(8)
    base = "".join(rng.choice("abcdefghij klm") for _ in range(3000))
    texts = [base[:k] + "#" * rng.randint(1, 30) + base[k:] for k in rng.sample(range(3000), 250)]
    texts += ["".join(rng.choice("nopqrstuv wxy") for _ in range(rng.randint(200, 3000))) for _ in range(250)]
    prints = sorted({ep.fingerprint(t) for t in texts})
    df = spark.createDataFrame([(p,) for p in prints], "fp string")
    want = [(i, j) for i, p in enumerate(prints[:-1])
            for j in (i + 1 + (ep.likenesses([p] * (len(prints) - i - 1), prints[i + 1:]) >= ep.LIKE).nonzero()[0]).tolist()]
    place = {p: i for i, p in enumerate(prints)}
    for block in (1024, 20):
        links = [(place[r["a"]], place[r["b"]]) for r in ep.near_links(df, block=block).collect()]
        assert {tuple(sorted(p)) for p in links} <= set(want)
        got = connected(len(prints), links)
        recall = sum(got[i] == got[j] for i, j in want) / len(want)
        print("pairs", len(want), "recall", recall, "links", len(links))
        assert len(want) >= 200 and recall >= 0.99
