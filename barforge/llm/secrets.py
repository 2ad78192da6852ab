"""Secret scans: fixed patterns, and a small character convolutional network.

Base findings are three patterns (``assign``, ``access``, ``hex``), leftmost
and non-overlapping per kind, in code points. The network then judges every
candidate of a text: each run of ``MIN_TOKEN`` or more token characters (so
every base finding's value among them), whole, in windows of ``WIDTH``
characters with ``CONTEXT`` characters of text before it. A candidate that
scores at or above the threshold and is not covered by a base finding is
added under the kind ``model``; base findings always stay.

Training: labelled findings are the candidates inside base findings (1) and
candidates that overlap none (0), of all documents, plus the same values with
their keyword or quotes taken away, so that the network has to look at the
value: all distinct ones, each with all its rows. A candidate's score is the greatest over
all its rows, in training, in calibration and in the scan. The classes are weighted equally.
Every other finding (by hash) teaches: these are dealt into blocks of about ``BLOCK_ROWS``,
Spark trains each block from the common state by gradient descent in numpy, and the blocks'
states are averaged, ``ROUNDS`` times. The scores of all the others, which the network has not
seen, give the calibrating logistic curve and the threshold, by aggregates. The threshold lies
between the unseen negatives and the highest value that keeps a recall of ``RECALL`` there:
half way in log odds, at least ``FLOOR`` (calibrated probability) so that clean text is left
alone, at most that highest value.

Defined cases: null and empty texts have no findings; repeated rows and equal
texts get equal findings; with fewer than 8 distinct positives or
negatives in all documents there is no network and only base findings remain; very long texts are scanned whole;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import small_batches, stored
from barforge.operators.folds import key_cuts, key_ranks

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX_RUN = re.compile(rb"[0-9a-f]{32,}")
KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
TOKEN = bytes(chr(i) in "+/_=-" or chr(i).isascii() and chr(i).isalnum() for i in range(256))
MIN_TOKEN = 16
LONG = b"\1" * MIN_TOKEN
WIDTH, CONTEXT = 48, 16
BLOCK_ROWS, BLOCK_BYTES = 4096, 32 << 20
ROUNDS, PASSES = 10, 3
RECALL, FLOOR = 0.98, 0.9

Span = tuple[str, int, int]


def flat(text: str) -> bytes:
    """A byte a code point, so that places stay. All patterns are of ASCII signs: what is past
    Latin-1 becomes a question mark, which like all that is not ASCII is in none of them."""
    return text.encode("latin-1", "replace")


def token_runs(signs: bytes) -> list[tuple[int, int]]:
    """The maximal runs of MIN_TOKEN or more token characters, in order."""
    mask, out = signs.translate(TOKEN), []
    a = mask.find(LONG)
    while a >= 0:
        b = mask.find(b"\0", a + MIN_TOKEN)
        out.append((a, b if b >= 0 else len(mask)))
        a = mask.find(LONG, out[-1][1])
    return out


def sought(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """(base findings, candidates) of a text, both in order."""
    signs = flat(text)
    runs, out = token_runs(signs), []
    # a pattern is only tried where a necessary part of it stands
    small, starts = signs.lower(), []
    for word in KEYWORDS:
        at = small.find(word)
        while at >= 0:
            starts.append(at)
            at = small.find(word, at + 1)
    end = 0
    for at in sorted(starts):
        if at >= end and (m := ASSIGN.match(signs, at)):
            end = m.end()
            if len(m[2]) >= 8:
                out.append(("assign", at, end))
    if b"AKIA" in signs:
        out += [("access", *m.span()) for m in ACCESS.finditer(signs) if m.end() - m.start() >= 16]
    # a run of 32 or more hex digits is a whole match of the pattern: matches are maximal runs, each within a token's
    out += [("hex", *m.span()) for a, b in runs if b - a >= 32 for m in HEX_RUN.finditer(signs, a, b)]
    return ordered(out), runs


def base_spans(text: str) -> list[Span]:
    return sought(text)[0]


def beside(base: list[Span], runs: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Each candidate with the stretches of the base findings that overlap it, in one walk over both."""
    at, near = 0, []
    for a, b in runs:
        while at < len(base) and base[at][1] < b:
            near.append(base[at][1:])
            at += 1
        near = [(s, e) for s, e in near if e > a]
        yield a, b, near


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# ---- the network ----------------------------------------------------------------

def char_class(c: str) -> int:
    """Ten symbols: pad, lower, upper, digit a-f or not, token signs, quotes, spaces, the rest."""
    if "a" <= c <= "f":
        return 1
    if "g" <= c <= "z":
        return 2
    if "A" <= c <= "Z":
        return 3
    if "0" <= c <= "9":
        return 4
    if c in "+/_=-.":
        return 5
    if c in "\"'":
        return 6
    if c in ":=":
        return 7
    return 8 if c.isspace() else 9


CLASSES = 10
SYMBOLS = bytes(char_class(chr(i)) if i < 128 else 9 for i in range(256))


def encode(text: str, start: int, end: int) -> np.ndarray:
    """Rows of WIDTH symbols that cover the whole candidate with its context; the
    symbols of the candidate itself carry CLASSES more. Consecutive rows share KERNEL - 1
    symbols, so that every position of a filter lies whole in a row."""
    lo = max(0, start - CONTEXT)
    sym = np.frombuffer(flat(text[lo:end + CONTEXT]).translate(SYMBOLS), np.uint8).astype(np.int16)
    sym[start - lo:end - lo] += CLASSES
    step = WIDTH - Network.KERNEL + 1
    rows = 1 + max(0, -(-(len(sym) - WIDTH) // step))
    out = np.zeros((rows - 1) * step + WIDTH, np.int16)
    out[:len(sym)] = sym
    return np.ndarray((rows, WIDTH), out.dtype, out, 0, (step * out.itemsize, out.itemsize))


@dataclass(frozen=True)
class Network:
    """Embedding-free convolution: one-hot symbols, KERNEL wide filters, rectified,
    mean and maximum over the width, one logistic unit; then a calibrating curve."""
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 0.5

    KERNEL = 5

    def hidden(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Filters over (position, row), and a row's mean and maximum."""
        f, x = self.filters, rows.T.astype(np.intp)
        n, width = len(f[0]), len(x) - self.KERNEL + 1
        # a filter's first two symbols are looked up as one
        act = (f[0][:, None] + f[1]).reshape(n * n, -1).take(x[:width] * n + x[1:width + 1], axis=0)
        more = np.empty_like(act)
        for j in range(2, self.KERNEL):
            act += f[j].take(x[j:width + j], axis=0, out=more, mode="clip")
        act += self.bias
        np.maximum(act, 0, out=act)
        return act, np.concatenate([act.mean(0), act.max(0)], axis=1)

    def logits(self, rows: np.ndarray) -> np.ndarray:
        return self.hidden(rows)[1] @ self.out + self.out_bias

    def greatest(self, candidates: list[np.ndarray], block: int = 512) -> np.ndarray:
        """Of each candidate the greatest logit over its rows."""
        best = np.full(len(candidates), -np.inf)
        owner = np.repeat(np.arange(len(candidates)), [len(c) for c in candidates])
        rows = np.concatenate(candidates) if candidates else np.zeros((0, WIDTH), np.int16)
        for k in range(0, len(rows), block):
            np.maximum.at(best, owner[k:k + block], self.logits(rows[k:k + block]))
        return np.round(best, 9)        # alike whichever candidates are judged together

    def leading(self, rows: np.ndarray, ends: np.ndarray, block: int = 512) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each candidate (its rows end at ``ends``) the row of the greatest logit, and its ``hidden``."""
        logits = []
        for k in range(0, len(rows), block):
            act, h = self.hidden(rows[k:k + block])
            logits.append(h @ self.out + self.out_bias)
        logits, starts = np.concatenate(logits), np.concatenate([[0], ends[:-1]])
        first = np.flatnonzero(logits == np.repeat(np.maximum.reduceat(logits, starts), ends - starts))
        best = first[np.searchsorted(first, starts)]
        if len(rows) > block:
            return rows[best], *self.hidden(rows[best])
        return rows[best], act[:, best], h[best]

    def calibrated(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.offset, -40, 40)))

    def probabilities(self, candidates: list[np.ndarray]) -> np.ndarray:
        return self.calibrated(self.greatest(candidates))


FILTERS = 16
SHAPES = ((Network.KERNEL, 2 * CLASSES, FILTERS), (FILTERS,), (2 * FILTERS,), (1,))
SIZE = sum(int(np.prod(x)) for x in SHAPES)


def untrained(seed: int = 7) -> np.ndarray:
    """The state before training: weights, their two running moments, number of steps."""
    rng = np.random.default_rng(seed)
    p = [rng.normal(0, 0.2, SHAPES[0]), np.zeros(SHAPES[1]), rng.normal(0, 0.2, SHAPES[2]), np.zeros(SHAPES[3])]
    return np.concatenate([*map(np.ravel, p), np.zeros(2 * SIZE + 1)])


def arrays(flat: np.ndarray) -> list[np.ndarray]:
    ends = np.cumsum([int(np.prod(x)) for x in SHAPES])
    return [part.reshape(x) for part, x in zip(np.split(flat, ends[:-1]), SHAPES)]


def network(state: np.ndarray) -> Network:
    p = arrays(state[:SIZE])
    return Network(p[0], p[1], p[2], float(p[3][0]))


def trained(state: np.ndarray, candidates: list[np.ndarray], y: np.ndarray, share: float, seed: list[int],
            rate: float = 0.01) -> np.ndarray:
    """``state`` after PASSES passes over the candidates: Adam on the class-weighted logistic
    loss of each candidate's greatest logit over its rows, as a scan judges it; deterministic.
    ``share``: of label 1 among all that is learnt from."""
    rng = np.random.default_rng(seed)
    k, width = Network.KERNEL, WIDTH - Network.KERNEL + 1
    cells = np.arange(2 * CLASSES * FILTERS).reshape(-1, FILTERS)
    steps, places = np.empty((128, width, FILTERS)), np.empty((128, width, FILTERS), np.intp)
    state = state.copy()
    p, (flat_p, m, v) = arrays(state[:SIZE]), state[:3 * SIZE].reshape(3, SIZE)      # views: steps change the state
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    for _ in range(PASSES):
        order = rng.permutation(len(candidates))
        for b in range(0, len(candidates), 128):
            i = order[b:b + 128]
            taken = [candidates[j] for j in i]
            x, act, h = network(state).leading(np.concatenate(taken), np.cumsum([len(c) for c in taken]))
            d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3][0], -40, 40))) - y[i]) * weight[i] / len(i)
            dh = d[:, None] * p[2]
            mean, most, on = dh[:, :FILTERS] / width, h[:, FILTERS:].copy(), act > 0
            da, place = steps[:len(i)], places[:len(i)]
            np.multiply(on, mean, out=da.transpose(1, 0, 2))
            # of the greatest of a row and filter the first, if it is above 0; the last value put into a cell stays
            at, cell = np.divmod(np.flatnonzero((act == most) & on)[::-1], mean.size)
            first = np.full(mean.size, -1)
            first[cell] = at
            row, filt = np.nonzero(first.reshape(mean.shape) >= 0)
            da[row, first.reshape(mean.shape)[row, filt], filt] = mean[row, filt] + dh[row, FILTERS + filt]
            # a filter's gradient: sums by symbol, in the order of the rows
            gf = [np.bincount(cells.take(x[:, j:width + j], axis=0, out=place, mode="clip").ravel(), da.ravel(), cells.size)
                  for j in range(k)]
            g = np.concatenate([*gf, da.sum((0, 1)), h.T @ d, [d.sum()]])
            state[-1] += 1
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            flat_p -= rate * (m / (1 - 0.9 ** state[-1])) / (np.sqrt(v / (1 - 0.999 ** state[-1])) + 1e-8)
    return state


def examples(text: str) -> list[tuple[int, np.ndarray]]:
    """Labelled findings of one text: (label, rows)."""
    (base, runs), out = sought(text), []
    for a, b, near in beside(base, runs):
        cover = [(s, e) for s, e in near if s <= a and b <= e]
        if cover or not near:
            out.append((int(bool(cover)), encode(text, a, b)))
            if cover:  # the bare value, amid the words around the finding
                s, e = min(s for s, _ in cover), max(e for _, e in cover)
                before = text[max(0, s - CONTEXT):s]
                out.append((1, encode(before + text[a:b] + " " + text[e:e + CONTEXT].lstrip("\"'"), len(before),
                                      len(before) + b - a)))
    return out


def packed(rows: np.ndarray) -> bytes:
    """The distinct rows of a candidate; the greatest logit depends on no more."""
    x = rows.astype(np.int8).tobytes()
    return x if len(rows) == 1 else b"".join(sorted({x[k:k + WIDTH] for k in range(0, len(x), WIDTH)}))


def unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(bytes(x), np.int8).reshape(-1, WIDTH).astype(np.int16)


def exact_sum(value: Column) -> Column:
    """Sum of doubles as decimals: the same whatever the order of the rows."""
    return F.sum(value.cast("decimal(38,18)")).cast("double")


def fit(docs: DataFrame, text_col: str = "text") -> Network | None:
    """Train on all distinct findings of all documents, each with all its rows. Blocks of
    findings are trained in tasks and their states (``3 * SIZE + 1`` numbers) averaged in
    Spark; the unseen half is scored, and the curve and threshold found, in Spark too."""
    def found(batches):
        for b in batches:
            got = [(y, packed(rows)) for t in b["text"] if t for y, rows in examples(t)]
            yield pd.DataFrame({"y": [g[0] for g in got], "x": [g[1] for g in got]}, columns=["y", "x"])

    texts = small_batches(docs).select(F.col(text_col).alias("text"))
    rows = stored(texts.mapInPandas(found, "y int, x binary").distinct()
                  .select("y", F.sha2("x", 256).alias("key"), "x"), "findings")
    size = {r["y"]: r for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("x")).alias("bytes")).collect()}
    if len(size) < 2 or min(r["n"] for r in size.values()) < 8:
        return None
    # place: of a finding among those of its label, by hash; even places teach
    ranked, _ = key_ranks(rows, ["y", "key"], per_key=True, keys_per_part=100_000)
    placed = ranked.withColumn("place", F.col("_rank") - F.when(F.col("y") == 1, F.lit(size[0]["n"])).otherwise(0))
    learnt, unseen = {y: -(-size[y]["n"] // 2) for y in (0, 1)}, {y: size[y]["n"] // 2 for y in (0, 1)}
    n_blocks = max(1, -(-sum(learnt.values()) // BLOCK_ROWS), -(-sum(r["bytes"] for r in size.values()) // (2 * BLOCK_BYTES)))
    state = learn(placed.where("place % 2 = 0").withColumn("block", F.expr(f"(place div 2) % {n_blocks}")), n_blocks,
                  learnt[1] / sum(learnt.values()))
    net = network(state)

    def scored(batches):
        for b in batches:
            yield pd.DataFrame({"y": b["y"], "raw": net.greatest([unpacked(x) for x in b["x"]])})

    held = stored(placed.where("place % 2 = 1").select("y", "x").mapInPandas(scored, "y int, raw double"), "unseen")
    slope, offset = curve(held, unseen)
    net = replace(net, slope=slope, offset=offset)
    # the lowest positive that the recall keeps, and the highest negative, in order of probability
    drop = int((1 - RECALL) * unseen[1])
    _, (keep,) = key_cuts(held.where("y = 1").select("raw"), lambda n: [drop if slope >= 0 else n - 1 - drop], "raw", per_key=True)
    top = held.where("y = 0").agg((F.max if slope >= 0 else F.min)("raw")).first()[0]
    keep, between = net.calibrated(np.array([keep, (keep + top) / 2]))
    return replace(net, threshold=float(min(keep, max(FLOOR, between))))


def learn(findings: DataFrame, n_blocks: int, share: float) -> np.ndarray:
    """The state after ROUNDS rounds over ``findings`` (y, place, x, block): each round trains
    every block from the state of the last and takes the mean, weighted by their findings."""
    one = (findings.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("y", "place", "x"))).alias("f"))
           .select("block", F.col("f.y").alias("y"), F.col("f.x").alias("x")))
    # a task a block
    blocks = stored(one, "blocks").repartitionByRange(n_blocks, "block").persist()
    total = findings.count()
    state = untrained()
    try:
        for r in range(ROUNDS):
            def taught(batches, state=state, r=r):
                for b in batches:
                    for block, y, x in zip(b["block"], b["y"], b["x"]):
                        new = trained(state, [unpacked(v) for v in x], np.asarray(y), share, [7, r, int(block)])
                        yield pd.DataFrame({"i": np.arange(len(new), dtype=np.int32), "v": new * (len(y) / total)})

            mean = small_batches(blocks).mapInPandas(taught, "i int, v double").groupBy("i").agg(exact_sum(F.col("v")).alias("v"))
            state = np.array([row["v"] for row in sorted(mean.collect(), key=lambda row: row["i"])])
    finally:
        blocks.unpersist()
    return state


def curve(scores: DataFrame, n: dict[int, int], rounds: int = 50) -> tuple[float, float]:
    """Platt's calibration of ``scores`` (y, raw) by Newton steps, ridged; an aggregate a step."""
    raw, w = F.col("raw"), np.zeros(2)
    goal = F.when(F.col("y") == 1, F.lit((n[1] + 1) / (n[1] + 2))).otherwise(F.lit(1 / (n[0] + 2)))
    for _ in range(rounds):
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(raw * float(w[0]) + float(w[1]))))
        s, d = F.col("p") * (F.lit(1.0) - F.col("p")), F.col("p") - F.col("goal")
        sums = scores.select("raw", goal.alias("goal"), p.alias("p")).agg(
            *[exact_sum(v) for v in (s * raw * raw, s * raw, s, d * raw, d)]).first()
        step = np.linalg.solve(np.array([[sums[0], sums[1]], [sums[1], sums[2]]]) + 1e-3 * np.eye(2), np.array(sums[3:]) + 1e-3 * w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


# ---- scanning -------------------------------------------------------------------

def scan(texts: list[str], net: Network | None) -> list[tuple[list[Span], list[Span]]]:
    """(base findings, all findings) of each text; candidates of all the texts are
    judged together."""
    base: list[list[Span]] = []
    extra: list[list[Span]] = [[] for _ in texts]
    place, rows = [], []
    for i, t in enumerate(texts):
        found, runs = sought(t or "")
        base.append(found)
        for a, b, near in beside(found, runs) if net is not None else ():
            if not any(s <= a and b <= e for s, e in near):
                place.append((i, a, b))
                rows.append(encode(t, a, b))
    if net is not None:
        for (i, a, b), p in zip(place, net.probabilities(rows)):
            if p >= net.threshold:
                extra[i].append(("model", a, b))
    return [(b, ordered(b + e)) for b, e in zip(base, extra)]


def redact(text: str, spans: list[Span], mark: str = "[secret]") -> str:
    """``text`` with every covered stretch replaced by one ``mark``."""
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1]):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


RESULT = "struct<base:string,spans:string,n_assign:bigint,n_access:bigint,n_hex:bigint,redacted:string>"


def findings(docs: DataFrame, net: Network | None, text_col: str = "text", name: str = "found",
             redacted: bool = False) -> DataFrame:
    """``docs`` with a struct of the findings (and the redacted text if asked for)."""
    @F.pandas_udf(RESULT)
    def found(texts: pd.Series) -> pd.DataFrame:
        t = texts.tolist()
        got = scan(t, net)
        return pd.DataFrame({
            "base": [joined(b) for b, _ in got], "spans": [joined(s) for _, s in got],
            **{f"n_{k}": [sum(x[0] == k for x in b) for b, _ in got] for k in KINDS[:3]},
            "redacted": [redact(x, s) if redacted and x and s else (x if redacted else None)
                         for x, (_, s) in zip(t, got)]})

    return small_batches(docs).withColumn(name, found(F.col(text_col)))
