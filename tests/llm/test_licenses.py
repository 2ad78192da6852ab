"""License scans against a plain search, altered notices, edge rows."""

import re

import numpy as np

from barforge.llm import licenses as li
from barforge.llm import queries
from tests.conftest import MEDIUM


def test_query_finds_what_a_plain_search_finds(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    rows = queries.QUERIES["op4_licenses"](spark, MEDIUM).collect()
    assert len(rows) == len(docs)
    total = 0
    for r in rows:
        text = docs[r["doc_id"]]
        exact = {f"{n}:{m.start()}:{m.end()}" for n, t in li.TEMPLATES.items() for m in re.finditer(re.escape(t.rstrip(".:")), text)}
        assert exact <= set(filter(None, r["spans"].split(","))), r
        # nothing else is reported as wholly covered, and clean texts have no findings
        if not re.search("licen[sc]e|CC BY", text, re.I):
            assert r["n_findings"] == 0 and r["coverage"] == 0
        total += r["n_findings"]
    assert total > 10


def test_altered_notices_are_covered_in_part():
    index = li.build()
    text = li.TEMPLATES["mit-permission"]
    words = text.split()
    changed = " ".join(w if i not in (5, 17) else "other" for i, w in enumerate(words))
    shorter = " ".join(w for i, w in enumerate(words) if i not in (9, 20))
    longer = " ".join(w if i not in (8,) else w + " newly put" for i, w in enumerate(words))
    for t in (changed, shorter, longer):
        got = [f for f in li.scan("Über alles. " + t + " end", index) if f[0] == "mit-permission"]
        assert len(got) == 1 and 0.9 < got[0][1] <= 1.0 and got[0][2] == 12
    half = " ".join(words[:len(words) // 2])
    assert [f for f in li.scan(half, index) if f[0] == "mit-permission"] == []
    twice = text + "\n filler words stand here \n" + text
    assert [f[2] for f in li.scan(twice, index) if f[0] == "mit-permission"] == [0, twice.rindex("Permission")]


def test_winnowing_guarantee_and_alignment():
    rng = np.random.default_rng(2)
    for _ in range(300):
        shared = rng.integers(1, 30, li.GRAM + li.WINDOW - 1)
        a = np.r_[rng.integers(0, 30, 9), shared, rng.integers(0, 30, 9)]
        b = np.r_[rng.integers(0, 30, 4), shared, rng.integers(0, 30, 6)]
        ha, hb = li.gram_hashes(a), li.gram_hashes(b)
        assert set(ha[li.winnow(ha)].tolist()) & set(hb[li.winnow(hb)].tolist())
    assert li.align((1, 2, 3, 4), np.array([9, 1, 2, 7, 3, 4]), 1) == [(0, 1), (1, 2), (2, 4), (3, 5)]


def test_edge_rows(spark):
    mit = "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, "..."), (None, mit), (4, mit), (4, mit), (5, "words " * 100_000 + mit), (6, "İİ " + mit.upper()),
            (7, "mit license"), (8, "the the the")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, licenses string, start int")
    out = li.findings(docs, name="f").collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: [(f["license"], f["coverage"], f["start"], f["end"]) for f in r["f"]] for r in out}
    assert by[1] == by[2] == by[3] == by[7] == by[8] == []
    assert by[None] == by[4] == [("mit", 1.0, 0, 30)]
    assert by[5] == [("mit", 1.0, 600_000, 600_030)] and by[6] == [("mit", 1.0, 3, 33)]
    assert li.findings(docs.limit(0), name="f").count() == 0
