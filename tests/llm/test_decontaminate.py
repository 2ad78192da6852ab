"""Benchmark decontamination against a plain scan; proximity; edge rows."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from barforge.llm import decontaminate as de
from barforge.llm import queries
from tests.conftest import SMALL

SCHEMA = "doc_id long, text string, item_id string, n_hit long, words string"
ITEMS = "item_id long, text string, n_words int"


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def plain(docs, items):
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for j, it in items:
            v = words(it)
            for s in range(max(1, len(v) - 9)) if v else ():
                win = v[s:s + 10]
                for p in range(len(w) - len(win) + 1):
                    if w[p:p + len(win)] == win:
                        hit |= set(range(p, p + len(win)))
                        ids |= {str(j)} - {"None"}
        out.append((i, len(w), len(hit), sorted(ids)))
    return sorted(out, key=repr)


def test_query_equals_plain_scan(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    got = {tuple(r) for r in queries.QUERIES["op2_decontaminate"](spark, SMALL).collect()}
    assert got == {(i, n, h, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), h > 0)
                   for i, n, h, ids in plain(docs, items)}
    assert any(r[2] for r in got)


LONG = "one two three four five six seven eight nine ten eleven twelve"
ROWS = [(1, f"Intro. {LONG.upper()}! end", "x", 7, None), (2, None, None, None, None), (3, "", "", 0, ""),
        (None, LONG, None, None, None), (5, LONG, None, 1, None), (5, LONG, None, 1, None),
        (6, "the the the the the the the the the the the the", None, 1, None),
        (7, "short item", None, 1, None), (8, "été déjà vu", None, 1, None),
        (9, ("filler words " * 40_000) + LONG, None, 1, None), (10, "clean text of no item", None, 1, None),
        (11, "one two three four five six seven eight nine", None, 1, None)]
BENCH = [(1, LONG, 0), (2, "the " * 10, 0), (3, "Short, ITEM", 0), (3, "Short, ITEM", 0), (4, None, 0), (5, " .", 0),
         (6, "Été déjà", 0), (None, "été déjà", 0), (12, LONG, 0)]


@pytest.mark.parametrize("block", [4000, 2])
def test_edge_rows(spark, block):
    docs, items = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(BENCH, ITEMS)
    got = de.contamination(docs, items, block=block).collect()
    assert sorted(((r["id"], r["n_words"], r["n_hit"], r["items"]) for r in got), key=repr) == plain([r[:2] for r in ROWS], [b[:2] for b in BENCH])


def test_clean_keeps_what_holds_no_window_and_all_columns(spark):
    docs, items = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(BENCH, ITEMS)
    kept = de.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 10, 11]
    assert de.clean(docs, items.limit(0)).count() == len(ROWS)
    assert de.clean(docs.limit(0), items).count() == 0


def test_proximity_finds_shuffled_words(spark):
    docs = spark.createDataFrame([(1, "two one three four five"), (2, "one x two y three z four five"),
                                  (3, "one two three"), (4, "five four far far far far far far far three two one")],
                                 "doc_id long, text string")
    w = de.item_windows(spark.createDataFrame([(1, "one two three four five")], "item_id long, text string"))
    counts = de.term_counts(docs, w.select(F.explode("words").alias("term")).distinct())
    got = {r["id"] for r in de.proximity_matches(docs, w, counts, slop=3).collect()}
    assert got == {1, 2}


def test_very_long_text_and_no_forced_broadcast(spark):
    """Every word of a text is some window's rarest term; nothing is sent whole by a hint."""
    long = "alpha " * 300_000
    docs = spark.createDataFrame([(1, long), (2, "alpha beta " * 6)], "doc_id long, text string")
    items = spark.createDataFrame([("q", "alpha " * 12), ("r", "beta " * 12)], "item_id string, text string")
    got = {r["id"]: (r["n_words"], r["n_hit"], r["items"]) for r in de.contamination(docs, items).collect()}
    assert got == {1: (300_000, 300_000, ["q"]), 2: (12, 0, [])}
    windows = de.item_windows(items)
    counts = de.term_counts(docs, windows.select(F.explode("words").alias("term")).distinct())
    plan = de.phrase_matches(docs, windows, counts)._jdf.queryExecution().logical().toString()
    assert "strategy=broadcast" not in plan
