"""The registered queries of the training-data operators: each applies one
operator, with production parameters, to its whole table and derives the
digest columns of its contract from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import PATTERN
from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm import (bpe, bytebpe, crossalign, decontaminate, editprint, licenses, quality, ranked, secrets, sharding,
                         simhash, suffixes, urls)
from barforge.llm.common import read_table


WORD_BPE = "word_bpe_49k.json"
MULTI_BPE = "byte_bpe_multi_50k.tiktoken"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


@register("op10_quality")
def op10_quality(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", (quality.fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@register("op1_simhash")
def op1_simhash(spark, sf_dir):
    return simhash.with_components(read_table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
iw AS (
  SELECT DISTINCT item, list_slice(w, s, least(s + 9, len(w))) AS words, least(10, len(w)) AS n
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, s, n, list_slice(w, s, s + n - 1) AS words
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, lens WHERE len(w) >= n)),
hits AS (SELECT doc_id, s, dw.n, item FROM dw JOIN iw USING (words)),
pos AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hits),
h AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
      FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""


@register("op2_decontaminate", OP2_SQL)
def op2_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@register("op6_secrets")
def op6_secrets(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    f = F.col("found")
    return secrets.findings(docs, secrets.fit(docs)).select(
        "doc_id", f["n_assign"].alias("n_assign"), f["n_access"].alias("n_access"), f["n_hex"].alias("n_hex"),
        F.sha2(f["base"], 256).alias("base_sha256"), f["spans"].alias("spans"))


@register("op3_bpe")
def op3_bpe(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    b = F.col("bpe")
    coded = bpe.encode(docs, bpe.prepare(docs, tokenizer_path(WORD_BPE)), outputs=("packed", "decoded", "n_tokens"))
    return coded.select("doc_id", b["n_tokens"].alias("n_tokens"), F.sha2(b["packed"], 256).alias("ids_sha256"),
                        F.sha2(b["decoded"], 256).alias("decoded_sha256"))


@register("op5_urls")
def op5_urls(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.verdicts(pages, urls.fit(urls.label_by_terms(pages))).select("page_id", "host", "path", "rule", "verdict")


@register("op7_shards")
def op7_shards(spark, sf_dir):
    return sharding.shards(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@register("op8_editprints")
def op8_editprints(spark, sf_dir):
    return editprint.with_components(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@register("op9_suffixes")
def op9_suffixes(spark, sf_dir):
    kept = suffixes.dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op4_licenses")
def op4_licenses(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    f = F.col("licenses")
    return licenses.findings(docs).select(
        "doc_id", F.size(f).cast("long").alias("n_findings"), F.array_join(F.array_sort(F.array_distinct(f["license"])), ",").alias("licenses"),
        F.array_join(F.transform(f, lambda x: F.concat_ws(":", x["license"], x["start"], x["end"])), ",").alias("spans"),
        F.coalesce(F.round(F.array_max(f["coverage"]), 6), F.lit(0.0)).alias("coverage"))


@register("op13_bytebpe")
def op13_bytebpe(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bytebpe.encode(docs, bytebpe.load_ranks(tokenizer_path(MULTI_BPE)),
                           bytebpe.class_table(bytebpe.joins_by_pattern(PATTERN)), outputs=("packed", "decoded", "n_tokens"))
    b = F.col("bpe")
    return coded.select("doc_id", b["n_tokens"].alias("n_tokens"), F.sha2(b["packed"], 256).alias("ids_sha256"),
                        F.sha2(b["decoded"], 256).alias("decoded_sha256"))


@register("op12_crossalign")
def op12_crossalign(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = crossalign.agreement(docs, tokenizer_path(BYTE_BPE), tokenizer_path(PIECE_BPE), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, row_number() OVER () AS q, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
qf AS (SELECT q, item_id, term, count(*) AS qf FROM (SELECT q, item_id, unnest(w) AS term FROM b) GROUP BY ALL),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
       FROM tf, s WHERE term IN (SELECT term FROM qf) GROUP BY term, n_docs),
scored AS (
  SELECT q, item_id, doc_id,
         CAST(sum(qf * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM qf JOIN wt USING (term) JOIN tf USING (term), s GROUP BY ALL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@register("op11_ranked", OP11_SQL)
def op11_ranked(spark, sf_dir):
    return ranked.rank_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                 read_table(spark, sf_dir, "benchmark").select("item_id", "text"))
