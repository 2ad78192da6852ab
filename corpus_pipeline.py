"""The corpus pipeline: five stages over ``documents``, each one operator of
``barforge.llm`` with its production parameters.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``:

1. ``quality``: documents that the compression classifier rejects go.
2. ``near_dedup``: of each SimHash component the document of least id stays.
3. ``decontaminate``: documents that hold a window of a benchmark item go.
4. ``secrets``: found secrets are replaced by a mark; ``n_chars`` follows.
5. ``encode``: token ids; returns ``doc_id, lang, source, n_tokens, ids``.

All but the last return the columns of their input, whatever extra ones it has.
Null and empty texts are scored, kept or dropped as the operators' docstrings
say; an empty table passes through; repeated rows are one component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm import bpe, decontaminate, quality, secrets, simhash
from barforge.llm.common import read_table, stored
from barforge.llm.queries import WORD_BPE, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, model, score_col="__score").where(F.col("__score") >= quality.THRESHOLD).drop("__score")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.representatives(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = secrets.findings(docs, secrets.fit(docs), name="__found", redacted=True)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__found.spans") == "", F.col("n_chars"))
                             .otherwise(F.length("__found.redacted").cast(docs.schema["n_chars"].dataType)))
    return out.withColumn("text", F.col("__found.redacted")).select(*docs.columns)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoder = bpe.prepare(docs, tokenizer_path(WORD_BPE))
    return bpe.encode(docs, encoder, name="__bpe", outputs=("ids", "n_tokens")).select(
        "doc_id", "lang", "source", F.col("__bpe.n_tokens").alias("n_tokens"), F.col("__bpe.ids").alias("ids"))


STAGES = [("quality", quality_stage), ("near_dedup", near_dedup_stage), ("decontaminate", decontaminate_stage),
          ("secrets", secrets_stage), ("encode", encode_stage)]

#: SQL has neither the trained models nor the tokenizer; tests/llm/test_pipeline.py recomputes the rows
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
