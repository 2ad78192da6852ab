"""URL filters: rules first, gradient-boosted trees for the rest.

DataFrame functions and MLlib only. A url is cut into host and path; the longest
fitting rule decides. Urls without a rule are judged by boosted trees over
lexical features of the url: lengths, path depth, digit ratio, character
entropy of the host, hyphens and labels of the host, parameter counts, and the
smoothed share of blocked urls under the host's last label (a statistic of the
training sample, so bounded by it). The trees are trained on a bounded sample
(``SAMPLE`` urls of either label, those with the smallest hash) of labelled
urls; ``label_by_terms`` labels urls by terms of a short public kind of list.
The features never contain the terms.

Defined cases: a null url, or one without ``://``, has empty host and path, fits
no rule and is judged by its features (all zero); repeated rows and equal urls
get equal verdicts; with one label only, or no labelled url, there are no trees
and urls without a rule are allowed; an empty table gives an empty result; very
long urls are read whole; further columns pass through.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import ascii_lower, evaluated, stored

SAMPLE = 10000
#: fixed values: (rule, verdict)
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))
#: fixed values: host words that mark advertising and spam
TERMS = ("ads", "bet", "bets", "casino", "cheap", "pills", "poker", "spam", "track", "viagra", "win")
FEATURES = ("length", "host_length", "path_length", "depth", "digits", "entropy", "hyphens", "labels",
            "parameters", "fragment", "suffix_rate")


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path)"""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def with_parts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` with ``host`` and ``path`` (replaced where they exist)."""
    host, path = parts(F.col("_url"))
    return pages.withColumn("_url", F.col(url_col)).withColumns({"host": host, "path": path}).drop("_url")


def rule_of(rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits ``host`` and ``path``; of
    equally long ones the first in alphabetical order."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        host, path = text.split("/", 1)
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def label_by_terms(pages: DataFrame) -> DataFrame:
    """``(url, label)``: 1 where a word of the host is a term."""
    words = F.split(F.col("host"), "[.-]")
    return with_parts(pages).where("host <> ''").select(
        "url", F.arrays_overlap(words, F.array(*[F.lit(t) for t in TERMS])).cast("int").alias("label"))


def share(s: Column, pattern: str) -> Column:
    """Share of a string's characters that match (0 if it is empty)."""
    kept = F.length(F.regexp_replace(s, pattern, ""))
    return F.when(F.length(s) > 0, (F.length(s) - kept) / F.length(s)).otherwise(0.0)


def counted(s: Column, sign: str) -> Column:
    return (F.length(s) - F.length(F.replace(s, F.lit(sign), F.lit("")))).cast("double")


def features(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` (with host and path) plus the lexical features."""
    u = F.coalesce(F.col(url_col), F.lit(""))
    df = evaluated(pages.withColumn("_chars", F.filter(F.split("host", ""), lambda c: c != "")), "_chars")
    n = F.size("_chars")
    p = F.transform(F.array_distinct("_chars"), lambda c: F.size(F.filter("_chars", lambda x: x == c)) / n)
    entropy = F.aggregate(p, F.lit(0.0), lambda a, v: a - v * F.log2(v))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    return df.withColumns({
        "length": F.length(u).cast("double"), "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"), "depth": counted(F.col("path"), "/"),
        "digits": share(u, "[0-9]"), "entropy": F.when(n > 0, entropy).otherwise(0.0),
        "hyphens": counted(F.col("host"), "-"), "labels": F.size(F.split("host", r"\.")).cast("double"),
        "parameters": F.when(query == "", 0.0).otherwise(counted(query, "&") + 1),
        "fragment": (F.instr(u, "#") > 0).cast("double"),
        "suffix": F.substring_index("host", ".", -1)}).drop("_chars")


def with_suffix_rate(df: DataFrame, rates: DataFrame, prior: float) -> DataFrame:
    # one row a suffix of the training sample: at most 2 * SAMPLE rows
    return df.join(F.broadcast(rates), "suffix", "left").withColumn(
        "suffix_rate", F.coalesce("suffix_rate", F.lit(prior)))


class UrlModel:
    """Boosted trees with the suffix statistics they were trained with."""

    def __init__(self, trees: Model | None, rates: DataFrame | None, prior: float):
        self.trees, self.rates, self.prior = trees, rates, prior

    def judge(self, pages: DataFrame) -> DataFrame:
        """``pages`` (with host and path) plus ``spam``, the probability of a block."""
        if self.trees is None:
            return pages.withColumn("spam", F.lit(0.0))
        x = with_suffix_rate(features(pages), self.rates, self.prior)
        x = VectorAssembler(inputCols=list(FEATURES), outputCol="_x").transform(x)
        return self.trees.transform(x).withColumn("spam", vector_to_array("_p")[1]).select(*pages.columns, "spam")


def fit(labelled: DataFrame, sample: int = SAMPLE, seed: int = 11) -> UrlModel:
    """Train on ``(url, label)``; equal urls count once."""
    rows = labelled.where("url IS NOT NULL AND label IN (0, 1)").groupBy("url").agg(F.max("label").alias("label"))
    few = [rows.where(F.col("label") == y).orderBy(F.xxhash64("url"), "url").limit(sample) for y in (0, 1)]
    train = stored(features(with_parts(few[0].unionByName(few[1]))), "urls")
    n = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return UrlModel(None, None, 0.0)
    prior = n[1] / (n[0] + n[1])
    rates = train.groupBy("suffix").agg(((F.sum("label") + 10 * prior) / (F.count("*") + 10)).alias("suffix_rate"))
    rates = stored(rates, "suffixes")
    x = VectorAssembler(inputCols=list(FEATURES), outputCol="_x").transform(with_suffix_rate(train, rates, prior))
    # sorted in one partition (at most 2 * sample rows), so that the trees don't depend on the layout
    x = x.select("_x", F.col("label").cast("double").alias("label"), "url").coalesce(1).sortWithinPartitions("url")
    trees = GBTClassifier(featuresCol="_x", labelCol="label", predictionCol="_y", maxIter=10, maxDepth=4,
                          stepSize=0.3, seed=seed).setProbabilityCol("_p").setRawPredictionCol("_r")
    return UrlModel(trees.fit(x), rates, prior)


def verdicts(pages: DataFrame, model: UrlModel, rules=RULES, threshold: float = 0.5) -> DataFrame:
    """``pages`` with ``host, path, rule, spam, verdict``."""
    judged = model.judge(with_parts(pages.drop("host", "path", "rule", "spam", "verdict")))
    rule, decided = rule_of(rules)
    return judged.withColumns({"rule": rule, "verdict": F.coalesce(
        decided, F.when(F.col("spam") >= threshold, "block").otherwise("allow"))})
