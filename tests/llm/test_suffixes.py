"""Suffix-array dedup against a plain count of all windows, the array itself, edge rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from barforge.llm import queries
from barforge.llm import suffixes as sx
from tests.conftest import SMALL


def plain(texts, length):
    """(bytes, removed, spans, kept) of each text by counting every window."""
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), int((gone[:-1] & ~np.r_[False, gone[:-2]]).sum()) if len(t) else 0, kept))
    return out


def test_query_equals_plain_count(spark):
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    want = {i: (n, r, s, hashlib.sha256(k).hexdigest()) for i, (n, r, s, k) in zip(docs, plain(list(docs.values()), 400))}
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op9_suffixes"](spark, SMALL).collect()}
    assert got == want and any(r[1] for r in got.values())


def test_suffix_array_orders_and_finds_repeats():
    rng = random.Random(1)
    for _ in range(200):
        parts = [bytes(rng.choice(b"ab\xc3\xff"[:3]) for _ in range(rng.randint(1, 50))) for _ in range(rng.randint(1, 8))]
        length = rng.choice([2, 3, 5, 9, 17])
        count = Counter(p[i:i + length] for p in parts for i in range(len(p) - length + 1))
        want = [[i for i in range(len(p) - length + 1) if count[p[i:i + length]] > 1] for p in parts]
        assert [g.tolist() for g in sx.repeated_windows(parts, length)] == want
        text = b"\0".join(bytes(c + 1 for c in p) for p in parts) + b"\0"
        b = np.zeros(len(text) + 64, np.uint8)
        b[:len(text)] = np.frombuffer(text, np.uint8)
        sa = sx.suffix_array(b, len(text), 40)
        assert sorted(sa.tolist()) == list(range(len(text)))
        order = [bytes(b[i:i + 40]) for i in sa]
        assert order == sorted(order)


def test_equal_windows_have_equal_keys():
    rng = random.Random(4)
    shared = bytes(rng.choice(b"abcd ") for _ in range(150))
    seen = {}
    for _ in range(30):
        t = bytes(rng.choice(b"abcd ") for _ in range(rng.randint(0, 90))) + shared + bytes(rng.choice(b"abcd ") for _ in range(60))
        covered = []
        for key, f, last, _ in sx.sides(t, 60):
            covered += list(range(f, last + 1))
            for i in range(f, last + 1):
                assert seen.setdefault(t[i:i + 60], key) == key
        assert covered == list(range(len(t) - 59))


@pytest.mark.parametrize("hot", [sx.HOT, 0, 300])
def test_edge_rows_and_hot_keys(spark, hot):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh é") for _ in range(7))
    passage = " ".join(word() for _ in range(25))
    rows = [(1, None), (2, ""), (3, "short"), (None, "x" * 5000), (4, "y" * 70), (4, "y" * 70), (5, "ab" * 60), (None, passage)]
    rows += [(10 + i, word() * 3 + passage[:i] + "#" + passage[i:] + word()) for i in range(0, 160, 3)]
    rows += [(900, rows[12][1]), (900, rows[12][1]), (901, "z" * 63), (902, passage * 40)]
    docs = spark.createDataFrame([(i, t, "k", 3) for i, t in rows], "doc_id long, text string, key string, lo int")
    got = sorted((tuple(r) for r in sx.dedup(docs, 64, hot=hot).select("id", "n_bytes", "n_removed", "n_spans", "kept").collect()), key=repr)
    want = plain([(t or "").encode() for _, t in rows], 64)
    assert [(i, n, r, s, bytes(k)) for i, n, r, s, k in got] == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=repr)
    assert sx.dedup(docs.limit(0), 64).count() == 0


def test_planted_passages_are_read_by_removed_bytes(spark, tmp_path):
    """Passages of over 50 words in two documents go if they have 400 bytes or more,
    shorter ones and clean documents stay; n_bytes is the whole text's size for all."""
    rng = random.Random(12)
    words = lambda n, size: " ".join("".join(rng.choice("abcdefgh é") for _ in range(size)).replace(" ", "x") for _ in range(n))
    rows, passages = [], {}
    for p in range(40):
        long = p % 2 == 0
        passages[p] = words(60, 8 if long else 4)  # 60 words: 539 characters or 299
        assert (len(passages[p].encode()) >= 400) == long
        rows += [(3 * p + k, f"{words(30 + k, 7)}\n{passages[p]}\n{words(50, 7)}", p) for k in (0, 1)] + [(3 * p + 2, words(140, 7), None)]
    spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.QUERIES["op9_suffixes"](spark, str(tmp_path)).collect()}
    want = {i: w for (i, _, _), w in zip(rows, plain([t.encode() for _, t, _ in rows], 400))}
    for i, text, p in rows:
        planted = p is not None and p % 2 == 0
        assert (got[i]["n_removed"] >= len(passages[p].encode())) if planted else got[i]["n_removed"] == 0
        assert tuple(got[i])[1:4] == want[i][:3] and got[i]["n_bytes"] == len(text.encode())
        assert got[i]["kept_sha256"] == hashlib.sha256(want[i][3]).hexdigest()
