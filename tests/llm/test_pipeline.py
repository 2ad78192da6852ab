"""The pipeline against a plain recomputation of its stages, and edge rows."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as cp
from barforge.llm import quality, secrets
from tests.conftest import SMALL
from tests.llm.test_decontaminate import plain as plain_hits
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_rows_equal_a_plain_recomputation(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    model = quality.fit(docs, labels)
    rows = docs.collect()
    keep = [r for r, s in zip(rows, model.scores([(r["text"] or "").encode() for r in rows])) if s >= 0.3]
    comp = plain_components([plain_fingerprint(r["text"]) for r in keep], [r["doc_id"] for r in keep])
    keep = [r for r, c in zip(keep, comp) if r["doc_id"] == c]
    hit = {i for i, _, h, _ in plain_hits([(r["doc_id"], r["text"]) for r in keep], items) if h}
    keep = [r for r in keep if r["doc_id"] not in hit]
    net = secrets.fit(spark.createDataFrame(keep, docs.schema))
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for r, (_, spans) in zip(keep, secrets.scan([r["text"] for r in keep], net)):
        ids = t.encode(secrets.redact(r["text"], spans), add_special_tokens=False).ids
        want[r["doc_id"]] = (r["lang"], r["source"], len(ids), ids)
    got = {r["doc_id"]: tuple(r)[1:] for r in cp.run(spark, SMALL).collect()}
    assert got == want
    assert 0 < len(got) < len(rows) and len(hit) > 0


def test_stages_keep_columns_and_stand_odd_rows(spark):
    text = "plain words of some length that stand in one text alone and nowhere else"
    rows = [(1, text, "en", "s", 9, "k"), (1, text, "en", "s", 9, "k"), (None, None, None, None, None, None), (2, "", None, None, 0, ""),
            (3, "token = abcdefgh1234 " + text * 3, None, "s", 3, None), (None, "w " * 100_000, "en", None, 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _key string")
    for table in (docs, docs.limit(0)):
        out = table
        for name, stage in cp.STAGES:
            out = stage(spark, out, SMALL)
            if name != "encode":
                assert out.columns == docs.columns, name
            seen = out.collect()
            if name == "near_dedup" and seen:
                assert sorted(str(r["doc_id"]) for r in seen).count("1") == 1
            if name == "secrets" and seen:
                r = next(r for r in seen if r["doc_id"] == 3)
                assert r["text"].startswith("[secret] ") and r["n_chars"] == len(r["text"])
                assert all(r["n_chars"] == 9 for r in seen if r["doc_id"] == 1)
        assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]
