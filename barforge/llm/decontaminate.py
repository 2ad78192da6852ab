"""Benchmark decontamination by a positional inverted index of the training text.

DataFrame functions only. Steps:

1. Document frequencies in the corpus (token counts over all documents) rank
   the words of the benchmark. Every window of ``WINDOW`` item words is sought
   by its rarest terms.
2. The index: one posting ``(term, document, position)`` for every occurrence,
   in all documents, of a term that is some window's rarest, with the
   ``WINDOW - 1`` words on either side. It is written to the shared folder,
   clustered by nothing: each task appends what its documents hold.
3. Lists are intersected from the rarest term on: a posting proposes the window
   start ``position - offset``; the second rarest term must stand at its own
   offset from that start, then every other word (exact phrase matches), or
   within ``slop`` of it in any order (``proximity_matches``).

Rows of step 2 grow with the occurrences of rare terms only, and carry no text
beyond their neighbours, so the documents themselves are never shuffled. The
benchmark is handled in blocks of at most ``BLOCK`` sought terms, so what stands in
a plan is bounded whatever its size; postings meet windows in a join on the term,
which Spark splits where a term has very many.

Words: A-Z lower-cased, maximal runs of characters other than ASCII
non-alphanumerics. Defined cases: a null text has no words; an item without
words has no window, one of fewer than ``WINDOW`` words is one window; repeated
items count once, an item with a null id marks words but is not named;
repeated documents get equal rows; two documents are the same one if id and text are equal; an empty benchmark leaves every
document clean; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from barforge.llm.common import ascii_lower, evaluated, stored

WINDOW = 10
BLOCK = 4000
#: what separates words: ASCII other than 0-9 and a-z (A-Z are lower-cased before)
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words in order (null text: none)."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN)
    return F.filter(parts, lambda w: w != "")


def text_key(text: Column) -> Column:
    """With the id it names a document: 64-bit hash of the whole text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def item_windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id",
                 text_col: str = "text") -> DataFrame:
    """``(item, start, words)``: every window of every distinct item."""
    t = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    t = evaluated(t, "w").where(F.size("w") > 0).distinct()
    last = F.greatest(F.size("w") - window, F.lit(0))
    return (t.select("item", "w", F.explode(F.sequence(F.lit(0), last)).alias("start"))
            .select("item", "start", F.expr(f"slice(w, start + 1, {window})").alias("words")))


def term_counts(docs: DataFrame, terms: DataFrame, text_col: str = "text") -> DataFrame:
    """``(term, n)``: occurrences in all documents of the given distinct terms."""
    tokens = docs.select(F.explode(words(F.col(text_col))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    return terms.join(tokens, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def ranked_windows(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``(words, seed, seed_at, second, second_at)`` of each distinct window: its
    rarest and second rarest term and where they stand (ties: by word, then place)."""
    w = windows.select("words").distinct()
    placed = w.select("words", F.posexplode("words").alias("at", "term")).join(counts, "term")
    order = F.sort_array(F.collect_list(F.struct("n", "term", "at")))
    return placed.groupBy("words").agg(order.alias("o")).select(
        "words", F.col("o")[0]["term"].alias("seed"), F.col("o")[0]["at"].alias("seed_at"),
        F.try_element_at("o", F.lit(2))["term"].alias("second"),
        F.try_element_at("o", F.lit(2))["at"].alias("second_at"))


def postings(docs: DataFrame, terms: list[str], reach: int, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``(id, key, term, pos, around, lead)`` for every occurrence of ``terms``:
    ``around`` holds up to ``reach`` words before, the term, up to ``reach``
    after; ``lead`` is how many stand before."""
    d = evaluated(docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"),
                              words(F.col(text_col)).alias("w")), "w")
    # places first, neighbours row by row: a very long text never holds all its snippets at once
    at = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get("w", i).isin(terms))
    d = d.where(F.size("w") > 0).select("id", "key", "w", F.explode(at).alias("pos"))
    return d.select("id", "key", F.get("w", F.col("pos")).alias("term"), "pos",
                    F.slice("w", F.greatest(F.col("pos") - reach, F.lit(0)) + 1, F.least("pos", F.lit(reach)) + 1 + reach).alias("around"),
                    F.least("pos", F.lit(reach)).alias("lead"))


def term_blocks(ranked: DataFrame, block: int) -> list[list[str]]:
    """The distinct sought terms in blocks of at most ``block``; the benchmark's
    vocabulary passes the driver a block at a time."""
    seeds = ranked.select(F.col("seed").alias("t")).distinct()
    n = seeds.count()
    k = max(1, -(-2 * n // block)) if n > block else 1  # twice the blocks: hash blocks are uneven
    out = []
    for i in range(k):
        out.append(sorted(r["t"] for r in seeds.where(F.pmod(F.xxhash64("t"), F.lit(k)) == i).collect()))
    return [b for b in out if b]


def phrase_matches(docs: DataFrame, windows: DataFrame, counts: DataFrame, block: int = BLOCK,
                   window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, start, words)``: every occurrence of every distinct window."""
    ranked = stored(ranked_windows(windows, counts), "windows")
    out = None
    for terms in term_blocks(ranked, block):
        index = stored(postings(docs, terms, window - 1, id_col, text_col), "postings")
        sought = ranked.where(F.col("seed").isin(terms)).select(
            "words", "seed", "seed_at", "second", "second_at", F.size("words").alias("n"))
        # a term may be the rarest of any number of windows: sent whole only where Spark finds it small
        c = index.join(sought, F.col("term") == F.col("seed"))
        at = F.col("lead") - F.col("seed_at")  # where the window starts inside ``around``
        c = c.where((at >= 0) & (at + F.col("n") <= F.size("around")))
        c = c.where(F.col("second").isNull() | (F.get("around", at + F.col("second_at")) == F.col("second")))
        c = c.where(F.slice("around", F.greatest(at, F.lit(0)) + 1, F.col("n")) == F.col("words"))
        c = c.select("id", "key", (F.col("pos") - F.col("seed_at")).alias("start"), "words")
        out = c if out is None else out.unionByName(c)
    if out is None:
        d = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"))
        out = d.join(windows.select("words").limit(0), F.lit(False)).select(
            "id", "key", F.lit(0).alias("start"), "words")
    return out


def proximity_matches(docs: DataFrame, windows: DataFrame, counts: DataFrame, slop: int = 2, block: int = BLOCK,
                      window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, pos, words)``: places of a window's rarest term around which all
    the window's words stand, each as often as in the window and in any order,
    no further from the term than in the window plus ``slop``."""
    ranked = stored(ranked_windows(windows, counts), "windows")
    out = None
    for terms in term_blocks(ranked, block):
        index = stored(postings(docs, terms, window - 1 + slop, id_col, text_col), "postings")
        sought = ranked.where(F.col("seed").isin(terms)).select("words", "seed", "seed_at", F.size("words").alias("n"))
        c = index.join(sought, F.col("term") == F.col("seed"))
        lo = F.greatest(F.col("lead") - F.col("seed_at") - slop, F.lit(0))
        hi = F.least(F.col("lead") - F.col("seed_at") + F.col("n") + slop, F.size("around"))
        c = c.withColumn("near", F.slice("around", lo + 1, hi - lo))
        count = lambda a, w: F.size(F.filter(a, lambda x: x == w))
        c = c.where(F.forall("words", lambda w: count(F.col("near"), w) >= count(F.col("words"), w)))
        c = c.select("id", "key", "pos", "words")
        out = c if out is None else out.unionByName(c)
    return out


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block: int = BLOCK,
                  id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """A row for each row of ``docs``: ``id, key, n_words, n_hit, items`` (the
    sorted ids, as strings, of items with an occurring window)."""
    windows = stored(item_windows(items, window, item_id, item_text), "item-windows")
    terms = windows.select(F.explode("words").alias("term")).distinct()
    counts = stored(term_counts(docs, terms, text_col), "terms")
    found = stored(phrase_matches(docs, windows, counts, block, window, id_col, text_col), "matches")
    # words covered: each start covers up to where a later start or the window's end comes
    spans = found.groupBy("id", "key", "start").agg(F.max(F.size("words")).alias("n"))
    w = Window.partitionBy("id", "key").orderBy("start")
    before = F.max(F.col("start") + F.col("n")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("start") + F.col("n") - F.greatest("start", F.coalesce(before, F.lit(0))))
    hit = spans.select("id", "key", new.cast("long").alias("n")).groupBy("id", "key").agg(F.sum("n").alias("n_hit"))
    named = (found.select("id", "key", "words").distinct().join(windows.select("words", "item").distinct(), "words")
             .groupBy("id", "key").agg(F.sort_array(F.collect_set("item")).alias("items")))
    rows = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"),
                       F.size(words(F.col(text_col))).cast("long").alias("n_words"))
    h = hit.select(F.col("id").alias("hid"), F.col("key").alias("hkey"), "n_hit")
    m = named.select(F.col("id").alias("mid"), F.col("key").alias("mkey"), "items")
    return (rows.join(h, F.col("id").eqNullSafe(F.col("hid")) & (F.col("key") == F.col("hkey")), "left")
            .join(m, F.col("id").eqNullSafe(F.col("mid")) & (F.col("key") == F.col("mkey")), "left")
            .select("id", "key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a window of an item."""
    found = contamination(docs, items, window).where("n_hit > 0").select(
        F.col("id").alias("_id"), F.col("key").alias("_key")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_id"])
                     & (text_key(docs["text"]) == found["_key"]), "left_anti")
