"""Byte-level BPE encoding and decoding with a vectorised splitter.

Splitting needs no regular expression. Each code point gets a class from one
table (letter, number, white space, other); with its neighbours' classes it
becomes one of eight signs, and every sign is a function from the splitter's
state to the next one. Functions compose associatively, so a whole batch is
scanned at once: blocks of ``BLOCK`` signs are composed side by side, a
doubling scan over the blocks gives the state at each block's start, and one
more pass marks the places where a piece begins. A text's first sign ignores the
state before it, so texts are simply laid end to end. The places become the
offsets of an Arrow array over the texts' own bytes; its dictionary holds each
distinct piece once. Pieces are merged by rank, the leftmost of equal ranks
first, and kept in a bounded cache of a task; long pieces are merged with a heap.
Decoding gathers the tokens' bytes by id; the tokens' offsets are kept and cut the
joined bytes into texts.

The vocabulary file is a parameter, read on the driver and broadcast (bounded by
the file); the class table has one byte a code point.

Defined cases: null and empty texts have no tokens and decode to nothing;
very long texts are scanned in stretches of ``STRETCH`` code points with the state
carried on, and their pieces are encoded as a whole; equal texts get equal ids; an
empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import small_batches

CACHE = 300_000
BLOCK = 128
STRETCH = 1 << 22
LONG = 64
NEVER = 1 << 60

# ---- the splitter -----------------------------------------------------------------

OTHER, LETTER, NUMBER, WHITE = range(4)
#: signs: a letter, a number, another sign; white space before white space or the
#: end, white space before something else, a blank before something else; an
#: apostrophe that begins a contraction of two or of three code points. +8: the
#: first of a text. 16: a filler that changes nothing.
L, N, O, W_INNER, W_LAST, BLANK, SHORT, LONGER = range(8)
FIRST, FILLER = 8, 16
#: states: nothing open; inside letters, numbers, others, white space; after a blank
#: that begins the next piece; one or two signs of a contraction still to come
FREE, IN_L, IN_N, IN_O, IN_W, GLUED, ONE_MORE, TWO_MORE = range(8)


def automaton() -> tuple[np.ndarray, np.ndarray]:
    """``(step, begins)``: by sign and state, the next state and whether a piece begins."""
    fresh = {L: IN_L, N: IN_N, O: IN_O, W_INNER: IN_W, W_LAST: FREE, BLANK: GLUED, SHORT: ONE_MORE, LONGER: TWO_MORE}
    glued = {L: IN_L, N: IN_N, O: IN_O, SHORT: IN_O, LONGER: IN_O}
    going = {(IN_L, L): IN_L, (IN_N, N): IN_N, (IN_O, O): IN_O, (IN_O, SHORT): IN_O, (IN_O, LONGER): IN_O,
             (IN_W, W_INNER): IN_W, **{(GLUED, s): t for s, t in glued.items()},
             **{(ONE_MORE, s): FREE for s in fresh}, **{(TWO_MORE, s): ONE_MORE for s in fresh}}
    step, begins = np.zeros((17, 8), np.uint8), np.zeros((17, 8), bool)
    for sign, target in fresh.items():
        for state in range(8):
            step[sign, state] = going.get((state, sign), target)
            begins[sign, state] = (state, sign) not in going
            step[sign + FIRST, state], begins[sign + FIRST, state] = target, True
    step[FILLER] = np.arange(8)
    return step, begins


STEP, BEGINS = automaton()


def class_table(joins: Callable[[str], bool]) -> np.ndarray:
    """The class of every code point. ``joins``: whether a library takes a text of
    two code points as one piece; it is asked about the code points on which two
    versions of Unicode disagree."""
    table = np.zeros(0x110000, np.uint8)
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    everything = "".join(map(chr, points))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, everything):
            table[np.frombuffer(m.group().encode("utf-32-le"), "<u4")] = kind
    kinds = {"L": LETTER, "N": NUMBER}
    for c in points:
        other = kinds.get(unicodedata.category(chr(c))[0], OTHER)
        if table[c] != other and table[c] != WHITE:
            table[c] = LETTER if joins("a" + chr(c)) else NUMBER if joins("1" + chr(c)) else OTHER
    return table


def joins_by_pattern(pattern: str) -> Callable[[str], bool]:
    """``joins`` of the tiktoken library under ``pattern``: a vocabulary of the bytes
    and of "a" or "1" with a following first byte shows where it splits."""
    import tiktoken
    ids = {bytes([i]): i for i in range(256)}
    ids |= {bytes([a, b]): 256 * (1 + n) + b for n, a in enumerate(b"a1") for b in range(256)}
    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ids, special_tokens={})
    return lambda text: probe.encode_ordinary(text)[0] >= 256


def signs_of(cp: np.ndarray, first: np.ndarray, table: np.ndarray, a: int, b: int) -> np.ndarray:
    """The signs of code points ``a`` to ``b``; ``first`` marks where texts begin."""
    n = len(cp)
    kind = table[cp[a:min(b + 1, n)]]
    own = kind[:b - a]
    ends = np.ones(b - a, bool)  # the next one is white space, or there is none in this text
    upto = min(b + 1, n) - a - 1
    ends[:upto] = (kind[1:upto + 1] == WHITE) | first[a + 1:a + 1 + upto]
    sign = np.array([O, L, N, W_INNER], np.uint8)[own]
    last = (own == WHITE) & ~ends
    sign[last] = np.where(cp[a:b][last] == 0x20, BLANK, W_LAST)
    quote = a + np.flatnonzero(cp[a:b] == 0x27)

    def after(k: int) -> np.ndarray:
        """The k-th code point after each apostrophe, 0 beyond its text."""
        at = np.minimum(quote + k, n - 1)
        inside = quote + k < n
        for j in range(1, k + 1):
            inside &= ~first[np.minimum(quote + j, n - 1)]
        return np.where(inside, cp[at], 0)

    one, two = after(1), after(2)
    sign[quote[np.isin(one, [ord(x) for x in "stmd"])] - a] = SHORT
    pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    sign[quote[pair] - a] = LONGER
    sign[first[a:b]] += FIRST
    return sign


def scan(sign: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Where pieces begin, and the state after the last sign."""
    rows = -(-len(sign) // BLOCK)
    grid = np.full(rows * BLOCK, FILLER, np.uint8)
    grid[:len(sign)] = sign
    grid = np.ascontiguousarray(grid.reshape(rows, BLOCK).T)
    flat = STEP.ravel()
    # each block as one function: its signs composed, all blocks side by side
    made = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for line in grid:
        made = flat.take((line * np.uint8(8))[:, None] + made)
    # the functions of all blocks up to each one, by doubling
    d = 1
    while d < rows:
        made[d:] = np.take_along_axis(made[d:], made[:-d].copy(), 1)
        d *= 2
    now = np.empty(rows, np.uint8)
    now[0], now[1:] = state, made[:-1, state]
    starts, begins = np.empty((BLOCK, rows), bool), BEGINS.ravel()
    for line, out in zip(grid, starts):
        at = line * np.uint8(8) + now
        out[:] = begins.take(at)
        now = flat.take(at)
    return starts.T.ravel()[:len(sign)], int(now[-1])


def piece_starts(cp: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
    out, state = np.empty(len(cp), bool), FREE
    for a in range(0, len(cp), STRETCH):
        b = min(a + STRETCH, len(cp))
        out[a:b], state = scan(signs_of(cp, first, table, a, b), state)
    return out


# ---- vocabulary and merging -------------------------------------------------------

@dataclass
class Vocabulary:
    """``ids`` of the tokens' bytes; for every two tokens that merge, ``key`` (the left
    id in the high half, the right one in the low half, sorted), ``order`` (least
    first) and ``result``. With ``whole`` a piece that is a token is not merged."""
    ids: dict[bytes, int]
    key: np.ndarray
    order: np.ndarray
    result: np.ndarray
    whole: bool

    @classmethod
    def of(cls, ids: dict[bytes, int], merges, whole: bool) -> Vocabulary:
        """``merges``: rows (left id, right id, order, result)."""
        rows = np.array(sorted((a << 32 | b, o, r) for a, b, o, r in merges), np.int64).reshape(-1, 3)
        return cls(ids, rows[:, 0].copy(), rows[:, 1].copy(), rows[:, 2].copy(), whole)

    def __post_init__(self):
        self.single = np.array([self.ids[bytes([i])] for i in range(256)], np.int64)
        self.pairs: dict[int, tuple[int, int]] = {}

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order (NEVER without one) and result of each pair."""
        want = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where(self.key[at] == want, self.order[at], NEVER), self.result[at]

    def merge_all(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of each piece. Short pieces are merged side by side, one merge a
        round in each: the pair of least order, the leftmost of equal ones."""
        out: list = [None] * len(pieces)
        todo = []
        for i, p in enumerate(pieces):
            if self.whole and p in self.ids:
                out[i] = (self.ids[p],)
            elif len(p) > LONG:
                out[i] = self.merge_long(p)
            elif p:
                todo.append(i)
            else:
                out[i] = ()
        if not todo or not len(self.key):
            return [self.single[list(p)].tolist() if o is None else o for o, p in zip(out, pieces)]
        todo.sort(key=lambda i: len(pieces[i]))
        s = self.single[np.frombuffer(b"".join(pieces[i] for i in todo), np.uint8)]
        piece = np.repeat(np.arange(len(todo)), [len(pieces[i]) for i in todo])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(s):
            same = piece[:-1] == piece[1:]
            order, result = np.full(len(s), NEVER), np.zeros(len(s), np.int64)
            order[:-1][same], result[:-1][same] = self.find(s[:-1][same], s[1:][same])
            start = np.flatnonzero(np.r_[True, ~same])
            least = np.minimum.reduceat(order, start)
            count = np.diff(np.r_[start, len(s)])
            live = least < NEVER
            if not live.all():  # pieces without a pair to merge leave
                stay = np.repeat(live, count)
                done.append((piece[~stay], s[~stay]))
                s, piece, order, result = s[stay], piece[stay], order[stay], result[stay]
                count, least = count[live], least[live]
                if not len(s):
                    break
                start = np.cumsum(count) - count
            hit = np.flatnonzero(order == np.repeat(least, count))
            hit = hit[np.r_[True, piece[hit][1:] != piece[hit][:-1]]]  # the leftmost of each piece
            s[hit] = result[hit]
            keep = np.ones(len(s), bool)
            keep[hit + 1] = False
            s, piece = s[keep], piece[keep]
        piece, s = np.concatenate([x for x, _ in done]), np.concatenate([x for _, x in done])
        by = np.argsort(piece, kind="stable")
        ends = np.cumsum(np.bincount(piece, minlength=len(todo)))
        ids = s[by].tolist()
        for i, a, b in zip(todo, np.r_[0, ends[:-1]].tolist(), ends.tolist()):
            out[i] = tuple(ids[a:b])
        return out

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same order of merges through a heap: least order, then leftmost."""
        if not self.pairs:
            self.pairs = dict(zip(self.key.tolist(), zip(self.order.tolist(), self.result.tolist())))
        s = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(s)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(m[0], i, s[i], s[i + 1], m[1]) for i in range(n - 1) if (m := self.pairs.get(s[i] << 32 | s[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if s[i] != a or j >= n or s[j] != b:
                continue  # one of the two has been merged since
            s[i], s[j] = made, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right < n and (m := self.pairs.get(s[left] << 32 | s[right])):
                    heapq.heappush(heap, (m[0], left, s[left], s[right], m[1]))
        return tuple(x for x in s if x >= 0)


def load_ranks(path: str) -> Vocabulary:
    """A file of lines: the token's bytes in base 64, a blank, its rank. Two tokens
    merge if their joined bytes are a token; its rank is the order and the id."""
    with open(path, "rb") as f:
        ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    merges = ((ids[t[:k]], ids[t[k:]], i, i) for t, i in ids.items() for k in range(1, len(t))
              if t[:k] in ids and t[k:] in ids)
    return Vocabulary.of(ids, merges, True)


@dataclass
class Coder:
    """Encodes and decodes batches; one a task."""
    vocab: Vocabulary
    table: np.ndarray
    cache: dict = field(default_factory=dict)

    def __post_init__(self):
        tokens: list[bytes] = [b""] * (max(self.vocab.ids.values(), default=-1) + 1)
        for raw, i in self.vocab.ids.items():
            tokens[i] = raw
        self.tokens = pa.array(tokens, pa.binary())

    def split(self, raw: bytes, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts end to end (``size`` bytes each): the byte offsets of the pieces and
        the number of pieces before each text."""
        lead = (np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) if not raw.isascii()
                else np.arange(len(raw)))
        cp = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), "<u4")
        begin = np.cumsum(size) - size
        first = np.zeros(len(cp), bool)
        first[np.searchsorted(lead, begin[size > 0])] = True
        at = lead[piece_starts(cp, first, self.table)]
        return np.r_[at, len(raw)], np.searchsorted(at, np.r_[begin, len(raw)])

    def encode(self, raw: bytes, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's ids begin (one more
        for the end)."""
        if not raw:
            return np.zeros(0, np.int32), np.zeros(len(size) + 1, np.int64)
        offsets, upto = self.split(raw, size)
        pieces = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
            None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)]).dictionary_encode()
        known, rows = self.cache, pieces.dictionary.to_pylist()
        if len(known) + len(rows) > CACHE:
            known.clear()
        new = [p for p in rows if p not in known]
        known.update(zip(new, self.vocab.merge_all(new)))
        rows = [known[p] for p in rows]
        flat = np.fromiter(chain.from_iterable(rows), np.int32)
        count = np.array([len(r) for r in rows], np.int64)
        start = np.cumsum(count) - count
        which = pieces.indices.to_numpy(zero_copy_only=False)
        size_of = count[which]
        end = np.cumsum(size_of)
        ids = flat[np.repeat(start[which] - (end - size_of), size_of) + np.arange(int(end[-1]))]
        return ids, np.r_[0, end][upto]

    def decode(self, ids: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
        """The tokens' bytes joined, and the offset of each token (one more for the end)."""
        taken = self.tokens.take(pa.array(ids, pa.int32()))
        _, offsets, data = taken.buffers()
        return data or pa.py_buffer(b""), np.frombuffer(offsets, np.int32)[:len(ids) + 1]


def joined(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """The texts' bytes end to end, and their sizes; no nulls."""
    if not len(texts):
        return b"", np.zeros(0, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(texts.type) else np.int32)
    at = at[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    return (bytes(data[at[0]:at[-1]]) if data is not None else b""), np.diff(at)


# ---- jobs -------------------------------------------------------------------------

OUTPUTS = {"ids": "array<int>", "packed": "binary", "decoded": "binary", "n_tokens": "bigint"}


def encode(docs: DataFrame, vocab: Vocabulary, table: np.ndarray, text_col: str = "text", name: str = "bpe",
           outputs: tuple[str, ...] = tuple(OUTPUTS)) -> DataFrame:
    """``docs`` with a struct of the wanted ``outputs``: ``ids``, ``packed`` (the ids
    as little-endian unsigned 32-bit integers), ``decoded`` (the bytes of these
    ids), ``n_tokens``."""
    sent = docs.sparkSession.sparkContext.broadcast((vocab, table))
    held: list[Coder] = []  # a task's own

    @F.arrow_udf("struct<" + ",".join(f"{o}:{OUTPUTS[o]}" for o in outputs) + ">")
    def coded(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Coder(*sent.value))
        ids, at = held[0].encode(*joined(texts))

        def cut(offsets: np.ndarray, data) -> pa.Array:
            return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), data])

        def decoded() -> pa.Array:
            data, offsets = held[0].decode(ids)
            return cut(offsets[at], data)

        made = {"ids": lambda: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())),
                "packed": lambda: cut(at * 4, pa.py_buffer(ids.astype("<u4"))),
                "decoded": decoded, "n_tokens": lambda: pa.array(np.diff(at), pa.int64())}
        return pa.StructArray.from_arrays([made[o]() for o in outputs], list(outputs))

    return small_batches(docs).withColumn(name, coded(F.coalesce(text_col, F.lit(""))))
