"""Byte-level BPE against the tiktoken library: odd texts, every code point's class,
whole documents, long pieces, edge rows."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from barforge.llm import bytebpe, queries
from tests.conftest import MEDIUM

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SIGNS = [*"ab'’ \n\t1sdtm", "'s", "'ll", "'re", "'ve", "  ", "\n\n", " \n", "é", "中", "½", "²", "\x85", "\xa0", "\x1c",
         "　", "🙂", "!", "''", "'l", "'r", "'v", "S", "̀", "​", " ", "﻿", "x" * 90, "-" * 100, "\x00"]


@pytest.fixture(scope="module")
def table():
    return bytebpe.class_table(bytebpe.joins_by_pattern(public_tokenizers.PATTERN))


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def coded(coder, texts):
    ids, at = coder.encode(*bytebpe.joined(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


def test_odd_texts_equal_the_library(table, library, monkeypatch):
    coder, rng = bytebpe.Coder(bytebpe.load_ranks(PATH), table), random.Random(4)
    for stretch in (bytebpe.STRETCH, 7, 130):  # texts lie end to end, also over several stretches
        monkeypatch.setattr(bytebpe, "STRETCH", stretch)
        for _ in range(60):
            texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 14))) for _ in range(40)]
            assert coded(coder, texts) == [library.encode_ordinary(t) for t in texts]


def test_every_code_point_has_the_librarys_class(table):
    ids = {bytes([i]): i for i in range(256)}
    ids |= {bytes([a, b]): 256 * (1 + n) + b for n, a in enumerate(b"a1!") for b in range(256)}
    probe = tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ids, special_tokens={})
    for c in [*range(1, 0xD800), *range(0xE000, 0x110000)]:
        if chr(c) in "smtd'":
            continue
        joins = [k for k, a in ((bytebpe.LETTER, "a"), (bytebpe.NUMBER, "1"), (bytebpe.OTHER, "!"))
                 if probe.encode_ordinary(a + chr(c))[0] >= 256]
        assert table[c] == (joins[0] if joins else bytebpe.WHITE), hex(c)


def test_long_pieces_and_a_small_cache(table, library, monkeypatch):
    monkeypatch.setattr(bytebpe, "CACHE", 5)
    rng = random.Random(3)
    texts = ["a" * 50_000, "".join(rng.choice("abeinst") for _ in range(20_000)), "ab'" * 9_000, "é" * 5_000, " " * 9_000, "x"]
    coder = bytebpe.Coder(bytebpe.load_ranks(PATH), table)
    assert coded(coder, texts) == coded(coder, texts) == [library.encode_ordinary(t) for t in texts]


def test_query_equals_the_library(spark, library):
    want = {}
    for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect():
        ids = library.encode_ordinary(r["text"] or "")
        want[r["doc_id"]] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                             hashlib.sha256(library.decode_bytes(ids)).hexdigest())
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op13_bytebpe"](spark, MEDIUM).collect()}
    assert got == want


def test_edge_rows(spark, table, library):
    rows = [(1, None, "a", 0), (2, "", None, 1), (None, "It's <|endoftext|> é 12\n\n x", "", 2),
            (3, "word  " * 100_000, None, 3), (3, "word  " * 100_000, None, 3), (4, "\x1c  \xa0", None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bpe string, ids int")
    vocab = bytebpe.load_ranks(PATH)
    out = bytebpe.encode(docs, vocab, table, name="e").select("text", "bpe", "ids", F.col("e.*")).toDF(
        "text", "bpe", "ids", "got", "packed", "decoded", "n").collect()
    assert len(out) == len(rows)
    for r in out:
        want = library.encode_ordinary(r["text"] or "")
        assert r["got"] == want and r["n"] == len(want) and bytes(r["decoded"]) == (r["text"] or "").encode()
        assert bytes(r["packed"]) == np.array(want, "<u4").tobytes()
    assert bytebpe.encode(docs.limit(0), vocab, table, name="e").count() == 0
