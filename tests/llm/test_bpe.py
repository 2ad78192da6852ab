"""BPE against the tokenizers library, exact round trip, the lexicon, edge rows."""

import hashlib
import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barforge.llm import bpe, queries
from tests.conftest import MEDIUM

PATH = public_tokenizers.path("word_bpe_49k.json")
SIGNS = [*"abcde THE 's 'll ", "é", "é", "Σ", "İ", "ß", "\x85", "\x1c", " ", "　", "½", "²", "中", "🙂", "\n",
         "!!", "<|startoftext|>", "<|endoftext|>", "<|", "ﬁ", "﻿", "\u0000", "\xa0", "가", "1", "23", "_", "Ω"]


def library(text):
    t = Tokenizer.from_file(PATH)
    ids = t.encode(text, add_special_tokens=False).ids
    return ids, t.decode(ids, skip_special_tokens=False)


def test_merging_equals_the_library_on_odd_texts():
    vocab, t, rng = bpe.load(PATH), Tokenizer.from_file(PATH), random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 14)))
        ids = [x for w in vocab.words(text) for x in vocab.merged(w)]
        want = t.encode(text, add_special_tokens=False).ids
        assert ids == want and vocab.decode(ids) == t.decode(want, skip_special_tokens=False), repr(text)


def test_lexicon_numbers_words_and_shares_suffixes():
    rng = random.Random(2)
    words = sorted({bytes(rng.choices(b"abc", k=rng.randint(1, 6))) + rng.choice([b"ing", b"tion"]) for _ in range(2000)})
    lex = bpe.compile_lexicon(words)
    assert np.array_equal(bpe.look_up(lex, words), np.arange(len(words)))
    assert set(bpe.look_up(lex, [b"", b"a", b"zzz", words[0] + b"x"])) == {-1}
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    assert len(lex["final"]) < len(prefixes) / 4  # far fewer states than a trie
    # minimal: no two states agree in finality and transitions
    states = {}
    for k, t in zip(lex["key"], lex["target"]):
        states.setdefault(k // 256, []).append((k % 256, t))
    forms = [(lex["final"][s], tuple(states.get(s, ()))) for s in range(len(lex["final"]))]
    assert len(set(forms)) == len(forms)
    assert len(bpe.compile_lexicon([])["key"]) == 0


def test_query_equals_the_library(spark):
    t = Tokenizer.from_file(PATH)
    want = {}
    for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        want[r["doc_id"]] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                             hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op3_bpe"](spark, MEDIUM).collect()}
    assert got == want


def test_any_lexicon_gives_the_same_ids_and_edge_rows(spark):
    rows = [(1, None, "a", 0), (2, "", None, 1), (None, "It's İstanbul <|endoftext|> ΣΑΣ 12", "", 2),
            (3, "word " * 100_000, None, 3), (3, "word " * 100_000, None, 3), (4, "\x1c  \xa0", None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bpe string, ids int")
    for size in (1, 5, 65536):
        out = bpe.encode(docs, bpe.prepare(docs, PATH, size), name="e").select("doc_id", "text", "bpe", "ids", F.col("e.ids").alias("got"), "e.decoded").collect()
        assert len(out) == len(rows)
        for r in out:
            assert (r["got"], r["decoded"]) == library(r["text"] or "")
    none = docs.limit(0)
    assert bpe.encode(none, bpe.prepare(none, PATH), name="e").count() == 0
