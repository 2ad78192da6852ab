"""BPE encoding and decoding with a word-end vocabulary.

The words of the corpus are counted over all documents; the ``LEXICON`` most
frequent ones are merged once and compiled into a minimal acyclic transducer:
equal suffixes share their states (incremental construction over the sorted
words), every transition carries a number, and the numbers along a word's path
add up to its row in the table of ids. The transducer is stored as flat sorted
arrays in one file that Spark hands to every executor (``addFile``; a new
executor gets it too) and that tasks memory-map, so all workers of a machine
share its pages. A batch's distinct words walk through it together, one
character a step; words that it does not hold are merged exactly, pair by pair
in rank order, and kept in a bounded cache.

The vocabulary file (JSON) is a parameter and read on the driver; its merges
(bounded by the file) are broadcast. Text is treated as the file's normaliser
and splitter say: NFC, characters lower-cased one by one, contractions, runs of
letters, single digits, runs of other signs; special strings in the text
are their own ids. Decoding joins the ids' strings by blanks, special ones
included, as there is no decoder in the file.

Defined cases: null and empty texts have no ids and decode to the empty text;
very long texts are encoded whole; equal texts get equal ids; an empty table
gives an empty result; other columns pass through.
"""

from __future__ import annotations

import json
import os
import re as plain_re
import unicodedata
import uuid
from array import array
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm.common import small_batches, stored

LEXICON = 200_000
CACHE = 300_000
COUNTED = 200_000
END = "</w>"
#: blanks as the splitter sees them; U+001C to U+001F are not among them
BLANK = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                          0x202F, 0x205F, 0x3000]))
#: the file's alternatives; no two of letters, digits and signs start alike, so letters may come first
PIECE = regex.compile(rf"\p{{L}}+|'(?:s|t|re|ve|m|ll|d)|\p{{N}}|[^{BLANK}\p{{L}}\p{{N}}]+")
#: ASCII and the Latin letters up to U+024F, where classes are plain ranges and a quicker matcher gives the same pieces
LATIN = r"a-zA-Z\xc0-\xd6\xd8-\xf6\xf8-" + chr(0x24F)
LATIN_ONLY = plain_re.compile(rf"[\x00-\x7f{LATIN}]*")
LATIN_PIECE = plain_re.compile(rf"[{LATIN}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\t-\r 0-9{LATIN}]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


SYMBOLS = byte_symbols()


@dataclass
class Vocabulary:
    ids: dict[str, int]
    merges: list[tuple[str, str]]
    special: dict[str, int]

    def __post_init__(self):
        self.strings = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        self.by_id = [self.strings.get(i, "") for i in range(max(self.strings) + 1)]
        marks = sorted(self.special, key=len, reverse=True)
        self.marks = plain_re.compile("(" + "|".join(map(plain_re.escape, marks)) + ")") if marks else None
        # a pair of ids as one number -> rank; rank -> id of the merged string
        self.ranks: dict[int, int] = {}
        for r, (a, b) in enumerate(self.merges):
            self.ranks.setdefault(self.ids[a] << 32 | self.ids[b], r)
        self.result = [self.ids[a + b] for a, b in self.merges]
        self.inner = [self.ids.get(c) for c in SYMBOLS]
        self.ending = [self.ids.get(c + END) for c in SYMBOLS]

    def words(self, text: str) -> list[str]:
        """Pieces in order; special strings stand as themselves."""
        if self.marks is None or not self.marks.search(text):
            return pieces(text)
        out = []
        for i, part in enumerate(self.marks.split(text)):
            out += [part] if i % 2 else pieces(part)
        return out

    def merged(self, word: str) -> tuple[int, ...]:
        """The ids of one piece by exact merging: again and again the pair of least
        rank, the leftmost of equal ones; only the pairs beside a merge change."""
        if word in self.special:
            return (self.special[word],)
        raw, none = word.encode("utf-8"), 1 << 60
        s = [self.inner[b] for b in raw[:-1]] + [self.ending[raw[-1]]]
        s = [x for x in s if x is not None]
        rank, result = self.ranks.get, self.result
        r = [rank(a << 32 | b, none) for a, b in zip(s, s[1:])]
        while r:
            best = min(r)
            if best == none:
                break
            i = r.index(best)
            s[i:i + 2] = [result[best]]
            del r[i]
            if i:
                r[i - 1] = rank(s[i - 1] << 32 | s[i], none)
            if i < len(r):
                r[i] = rank(s[i] << 32 | s[i + 1], none)
        return tuple(s)

    def decode(self, ids) -> str:
        return " ".join(map(self.by_id.__getitem__, ids))


def load(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    return Vocabulary(spec["model"]["vocab"], merges,
                      {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]})


def pieces(text: str) -> list[str]:
    if not text.isascii():
        # the final-sigma rule of str.lower() looks at neighbours; the vocabulary's normaliser doesn't
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    text = text.lower()
    return (LATIN_PIECE if LATIN_ONLY.fullmatch(text) else PIECE).findall(text)


# ---- the transducer -------------------------------------------------------------

def compile_lexicon(words: list[bytes]) -> dict[str, np.ndarray]:
    """Minimal acyclic automaton of sorted distinct words with additive outputs:
    ``key`` (state * 256 + byte, sorted), ``target``, ``add``, ``final``."""
    register: dict[tuple, int] = {}
    done: list[tuple] = []  # (final, ((byte, target), ...)) of each state
    size: list[int] = []  # words below each state

    def settle(node) -> int:
        sig = (node[0], tuple(node[1]))
        if sig not in register:
            register[sig] = len(done)
            done.append(sig)
            size.append(sig[0] + sum(size[t] for _, t in sig[1]))
        return register[sig]

    path = [[False, []]]  # the open states along the last word
    last = b""
    for w in words:
        common = 0
        while common < min(len(w), len(last)) and w[common] == last[common]:
            common += 1
        while len(path) - 1 > common:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], settle(node)))
        path += [[False, []] for _ in range(len(w) - common)]
        path[-1][0] = True
        last = w
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((last[len(path) - 1], settle(node)))
    root = settle(path[0])
    # the root becomes state 0
    number = {s: (0 if s == root else s + 1 if s < root else s) for s in range(len(done))}
    rows = []
    for s, (final, edges) in enumerate(done):
        below = int(final)
        for byte, t in edges:
            rows.append((number[s] * 256 + byte, number[t], below))
            below += size[t]
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 3).T
    ends = np.zeros(len(done), np.int64)
    for s, (final, _) in enumerate(done):
        ends[number[s]] = final
    return {"key": cols[0], "target": cols[1], "add": cols[2], "final": ends}


def look_up(lexicon: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
    """Row of each word, -1 if the lexicon lacks it; all words step together."""
    size = np.array([len(w) for w in words], np.int64)
    text = np.frombuffer(b"".join(words), np.uint8)
    start = np.cumsum(size) - size
    state, row = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    key, live = lexicon["key"], np.arange(len(words))
    for step in range(int(size.max(initial=0))):
        live = live[(size[live] > step) & (state[live] >= 0)]
        if not len(live):
            break
        want = state[live] * 256 + text[start[live] + step]
        at = np.minimum(np.searchsorted(key, want), len(key) - 1)
        hit = key[at] == want
        row[live] += np.where(hit, lexicon["add"][at], 0)
        state[live] = np.where(hit, lexicon["target"][at], -1)
    found = state >= 0
    found[found] = lexicon["final"][state[found]] == 1
    return np.where(found & (size > 0), row, -1)


PARTS = ("key", "target", "add", "final", "first", "ids")


def ship(spark: SparkSession, vocab: Vocabulary, words: list[str]) -> str:
    """Compile ``words``, write one file, hand it to all executors; its name."""
    ordered = sorted({w.encode("utf-8"): w for w in words}.items())
    lexicon = compile_lexicon([b for b, _ in ordered])
    ids = [vocab.merged(w) for _, w in ordered]
    lexicon["first"] = np.cumsum([0, *map(len, ids)], dtype=np.int64)
    lexicon["ids"] = np.array([x for row in ids for x in row], np.int64)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    # beside the session's other files: they go when the session ends
    folder = os.path.join(SparkFiles.getRootDirectory(), "lexicons")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as f:
        np.array([len(lexicon[p]) for p in PARTS], "<i8").tofile(f)
        for p in PARTS:
            lexicon[p].astype("<i8").tofile(f)
    spark.sparkContext.addFile(os.path.join(folder, name))
    return name


def mapped(path: str) -> dict[str, np.ndarray]:
    whole = np.memmap(path, "<i8", mode="r")
    ends = np.cumsum([len(PARTS), *whole[:len(PARTS)]])
    return {p: whole[a:b] for p, a, b in zip(PARTS, ends, ends[1:])}


# ---- jobs -----------------------------------------------------------------------

def word_counts(docs: DataFrame, vocab, text_col: str = "text") -> DataFrame:
    """``(word, n)`` over all documents; tasks count before the shuffle and pass on
    what they have whenever it exceeds ``COUNTED`` words."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches):
        seen: Counter = Counter()
        for b in batches:
            for t in b.column("text").to_pylist():
                seen.update(vocab.value.words(t))
            if len(seen) > COUNTED:
                yield pa.RecordBatch.from_pydict({"word": list(seen), "n": list(seen.values())}, schema)
                seen.clear()
        yield pa.RecordBatch.from_pydict({"word": list(seen), "n": list(seen.values())}, schema)

    texts = small_batches(docs).select(F.coalesce(text_col, F.lit("")).alias("text"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Known:
    """A task's words so far: word -> row, and the rows' ids end to end. Emptied
    when it would exceed CACHE words."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.ids, self.ends = array("i"), array("q", [0])

    def add(self, word: str, ids) -> None:
        self.rows[word] = len(self.rows)
        self.ids.extend(ids)
        self.ends.append(len(self.ids))


@dataclass
class Encoder:
    """What tasks need: the broadcast vocabulary and the lexicon file's name."""
    vocab: object
    name: str

    def encode(self, texts: list[str], known: Known, lexicon: dict) -> list[np.ndarray]:
        """The ids of each text: words are numbered by the rows of ``known``, and
        all rows of the batch are gathered at once."""
        vocab = self.vocab.value
        split = [vocab.words(t) if t else [] for t in texts]
        seen = set().union(*split)
        new = list(seen.difference(known.rows))
        if len(known.rows) + len(new) > CACHE:
            known.__init__()
            new = list(seen)
        first, ids = lexicon["first"], lexicon["ids"]
        at = look_up(lexicon, [w.encode("utf-8") for w in new]) if new and len(lexicon["key"]) else [-1] * len(new)
        for w, r in zip(new, at):
            known.add(w, ids[first[r]:first[r + 1]].tolist() if r >= 0 else vocab.merged(w))
        count = np.array([len(words) for words in split], np.int64)
        rows = np.fromiter(map(known.rows.__getitem__, chain.from_iterable(split)), np.int64, int(count.sum()))
        ends, flat = np.array(known.ends, np.int64), np.array(known.ids, np.int32)
        size = ends[rows + 1] - ends[rows]
        upto = np.cumsum(size)
        out = flat[np.repeat(ends[rows] - (upto - size), size) + np.arange(int(size.sum()))]
        upto = np.r_[0, upto]
        stop = upto[np.cumsum(count)]
        return [out[a:b] for a, b in zip(np.r_[0, stop[:-1]], stop)]


def frequent(counts: DataFrame, most: int) -> list[str]:
    """The words above the least count that at most ``most`` words reach: a
    histogram of the counts (16 steps an octave) gives that count, so only the
    chosen words travel to the driver."""
    step = F.floor(F.log2("n") * 16).cast("int")
    total, least = 0, None
    for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect():
        total += r["words"]
        if total > most:
            break
        least = r["step"]
    return [] if least is None else [r["word"] for r in counts.where(step >= least).select("word").collect()]


def prepare(docs: DataFrame, path: str, lexicon: int = LEXICON, text_col: str = "text") -> Encoder:
    """Count words over all documents and compile the most frequent ones."""
    spark = docs.sparkSession
    vocab = spark.sparkContext.broadcast(load(path))
    counts = stored(word_counts(docs, vocab, text_col), "words")
    return Encoder(vocab, ship(spark, vocab.value, frequent(counts, lexicon)))


OUTPUTS = {"ids": "array<int>", "packed": "binary", "decoded": "string", "n_tokens": "bigint"}


def encode(docs: DataFrame, encoder: Encoder, text_col: str = "text", name: str = "bpe",
           outputs: tuple[str, ...] = tuple(OUTPUTS)) -> DataFrame:
    """``docs`` with a struct of the wanted ``outputs``: ``ids``, ``packed`` (the ids
    as little-endian unsigned 32-bit integers), ``decoded`` (of these ids),
    ``n_tokens``."""
    held: dict = {}  # a task's own: the mapped file and the cache

    @F.arrow_udf("struct<" + ",".join(f"{o}:{OUTPUTS[o]}" for o in outputs) + ">")
    def coded(texts: pa.Array) -> pa.Array:
        if not held:
            held.update(lexicon=mapped(SparkFiles.get(encoder.name)), known=Known())
        ids = encoder.encode(texts.to_pylist(), held["known"], held["lexicon"])
        made = {"ids": lambda: pa.array(ids, pa.list_(pa.int32())),
                "packed": lambda: pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                "decoded": lambda: pa.array([encoder.vocab.value.decode(x.tolist()) for x in ids], pa.string()),
                "n_tokens": lambda: pa.array([len(x) for x in ids], pa.int64())}
        return pa.StructArray.from_arrays([made[o]() for o in outputs], list(outputs))

    return small_batches(docs).withColumn(name, coded(F.coalesce(text_col, F.lit(""))))
