"""URL filters: rules against a plain reading, held-out ranking, edge rows."""

import re

from pyspark.sql import functions as F

from barforge.llm import queries, urls
from tests.conftest import MEDIUM

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [(r, v) for r, v in RULES for h, p in [r.split("/", 1)]
           if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return host, path, *max(fit, key=lambda x: len(x[0]), default=(None, None))


ODD = [None, "", "no scheme", "http://", "http://ORG/", "http://a.ORG/x", "http://notorg/", "https://Example.org/en/12?q=1",
       "https://example.org/en/1", "https://wwwexample.org/es/", "http://x.com/fr/a://b/c", "http://com/de/#f", "http://a.com?x=/fr/",
       "http://a.com/fr", "x" * 50_000 + "://a.org/" + "y" * 50_000, "http://é.org/\n/z", "a://b://c.org/"]


def test_query_equals_plain_rules(spark):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{MEDIUM}/pages.parquet").collect()}
    rows = queries.QUERIES["op5_urls"](spark, MEDIUM).collect()
    assert len(rows) == len(pages)
    for r in rows:
        host, path, rule, verdict = plain(pages[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict or rule is None and r["verdict"] in ("allow", "block")
    free = [r for r in rows if r["rule"] is None]
    spam = [bool(re.search("casino|pills|bets|ads-", r["host"])) for r in free]
    assert sum((r["verdict"] == "block") == s for r, s in zip(free, spam)) > 0.95 * len(free)


def test_trees_rank_urls_they_have_not_seen(spark):
    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet").select("url")
    labelled = urls.label_by_terms(pages)
    held = F.pmod(F.xxhash64("url"), F.lit(3)) == 0
    model = urls.fit(labelled.where(~held))
    rows = model.judge(urls.with_parts(labelled.where(held))).collect()
    good = [r["spam"] for r in rows if r["label"] == 0]
    bad = [r["spam"] for r in rows if r["label"] == 1]
    assert sum(b > g for b in bad for g in good) > 0.95 * len(good) * len(bad)


def test_odd_urls_extra_columns_and_missing_labels(spark):
    pages = spark.createDataFrame([(i, u, "h", "r", 0.5) for i, u in enumerate(ODD + ODD)],
                                  "page_id long, url string, host string, rule string, spam double")
    none = urls.fit(urls.label_by_terms(pages))
    assert none.trees is None
    some = urls.fit(spark.createDataFrame([(f"http://a{i}.example.net/en/{i}", 0) for i in range(20)]
                                          + [(f"http://casino-win{i}.example.net/x", 1) for i in range(20)], "url string, label int"))
    for model in (none, some):
        out = urls.verdicts(pages, model).collect()
        assert len(out) == 2 * len(ODD)
        for r in out:
            host, path, rule, verdict = plain(r["url"])
            assert (r["host"], r["path"], r["rule"]) == (host, path, rule), r["url"]
            assert r["verdict"] == (verdict or r["verdict"])
        assert {r["verdict"] for r in out if r["rule"] is None} <= {"allow", "block"}
    assert urls.verdicts(pages.limit(0), some).count() == 0
