"""Alignment and pair counts against a plain recomputation with both libraries."""

import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from barforge.llm import bytebpe, crossalign, queries
from barforge.llm.bpe import SYMBOLS
from tests.conftest import SMALL

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(texts, libraries):
    """n_a, n_b, n_groups, n_links, groups, n_best, count_sum of each text."""
    a, b = libraries
    byte = {s: i for i, s in enumerate(SYMBOLS)}
    docs, holds = [], Counter()
    for text in texts:
        ids = a.encode(" " + text, add_special_tokens=False) if text else None
        one = [(i, bytes(map(byte.__getitem__, t))) for i, t in zip(ids.ids, ids.tokens)] if text else []
        two = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
               for i in (b.encode(text) if text else [])]
        whole = (" " + text).encode() if text else b""
        if b"".join(t for _, t in one) != whole or b"".join(t for _, t in two) != whole:
            one, two = [], []
        groups, i, j, x, y = [], 0, 0, 0, 0
        while i < len(one):
            left, right = [one[i][0]], [two[j][0]]
            x, y, i, j = x + len(one[i][1]), y + len(two[j][1]), i + 1, j + 1
            while x != y:
                if x < y:
                    left.append(one[i][0])
                    x, i = x + len(one[i][1]), i + 1
                else:
                    right.append(two[j][0])
                    y, j = y + len(two[j][1]), j + 1
            groups.append((left, right))
        links = Counter((p, q) for left, right in groups for p in left for q in right)
        holds.update(links.keys())
        docs.append((len(one), len(two), groups, links))
    most = {}
    for (p, _), n in holds.items():
        most[p] = max(most.get(p, 0), n)
    return [(n, m, len(g), sum(k.values()), ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g),
             sum(c for e, c in k.items() if holds[e] == most[e[0]]), sum(c * holds[e] for e, c in k.items()))
            for n, m, g, k in docs]


SIGNS = [*"ab \n\t1'", "the ", "ing", "é", "中", "🙂", "▁", "<|endoftext|>", "<s>", "</s>", "<0x41>", "\xa0", "½", "  ", "\x00", "  ", "'ll", "가",
         "word ", "İ", "\r\n", "﻿", "ﬁ"]


def test_odd_texts(spark, libraries, monkeypatch):
    rng = random.Random(7)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 16))) for _ in range(600)] + [
        "", "a" * 3000 + " b", "x" * 700 + "\n" + "ab" * 900, "日本" * 800]
    for wide, links, frequent in ((crossalign.WIDE, crossalign.LINKS, crossalign.FREQUENT), (3, 11, 40), (1024, 50, 0)):
        monkeypatch.setattr(crossalign, "WIDE", wide)
        monkeypatch.setattr(crossalign, "LINKS", links)
        vocab, table = crossalign.load_json(A), bytebpe.class_table(crossalign.joins_by_file(A))
        with open(B, "rb") as f:
            pair = crossalign.Pair(vocab, table, f.read())
        want = plain(texts, libraries)
        got = pair.align(pa.array([t for t in texts if t]), False)
        full = [w for t, w in zip(texts, want) if t]
        assert list(zip(*(got[k] if k == "groups" else got[k].tolist() for k in ("n_a", "n_b", "n_groups", "n_links", "groups")))) == [
            w[:5] for w in full]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
        out = crossalign.agreement(docs, A, B, frequent=frequent).collect()
        assert {r["doc_id"]: tuple(r)[1:] for r in out} == dict(enumerate(want))


def test_every_code_point_has_the_librarys_class():
    joins = crossalign.joins_by_file(A)
    table = bytebpe.class_table(joins)
    for c in [*range(1, 0xD800, 7), *range(0xE000, 0x20000, 5), *range(0x20000, 0x110000, 61), *range(0, 0x3100)]:
        if c == 0 or chr(c) in "smtd'":
            continue
        kind = next((k for k, a in ((bytebpe.LETTER, "a"), (bytebpe.NUMBER, "1"), (bytebpe.OTHER, "!")) if joins(a + chr(c))), bytebpe.WHITE)
        assert table[c] == kind, hex(c)


def test_query_equals_the_plain_way(spark, libraries):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = plain([r["text"] or "" for r in rows], libraries)
    want = {r["doc_id"]: (*w[:4], hashlib.sha256(w[4].encode()).hexdigest() if w[0] else "", *w[5:]) for r, w in zip(rows, want)}
    out = queries.QUERIES["op12_crossalign"](spark, SMALL)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert {r["doc_id"]: tuple(r)[1:] for r in out.collect()} == want


def test_edge_rows(spark, libraries):
    texts = [None, "", "same text", "same text", "▁", "word " * 30_000]
    docs = spark.createDataFrame([(i if i != 2 else None, t, "p", i) for i, t in enumerate(texts)],
                                 "doc_id long, text string, pairs string, uid int")
    want = plain([t or "" for t in texts], libraries)
    out = crossalign.agreement(docs, A, B, keep=("doc_id", "pairs", "uid")).collect()
    assert {r["uid"]: tuple(r)[3:] for r in out} == dict(enumerate(want)) and {r["pairs"] for r in out} == {"p"}
    assert crossalign.agreement(docs.limit(0), A, B).count() == 0
