"""Splits, walk-forward folds, class balance and weights, undersampling.

Exact global ``ntile`` without a one-task window (WIN-6): fold boundaries
are k-1 rows of the global order (open_time, symbol). We find those rows from
small count tables only (per day, then per time within one day, then the few
symbols at one time), and assign folds with literal comparisons on
(open_time, symbol). The full table is scanned, never sorted or shuffled as a
whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.time import floor_to
from barforge.session import cut_lineage

DAY_MS = 86_400_000
KEYS_PER_PART = 1_000_000


def ntile_starts(n: int, k: int) -> list[int]:
    """0-based first rank of buckets 1..k-1 under SQL ``ntile(k)`` on n rows."""
    q, r = divmod(n, k)
    return [j * (q + 1) if j <= r else r * (q + 1) + (j - r) * q for j in range(1, k)]


def rows_at_ranks(df: DataFrame, ranks_of, time_col: str = "open_time",
                  tie_col: str = "symbol", coarse_ms: int = DAY_MS) -> tuple[int, list]:
    """(row count n, [(time, tie) of the row at each 0-based rank]).

    ``ranks_of(n)`` gives the wanted ranks. Order is (time_col, tie_col), with
    time_col a Long. Ranks past the end give None. All cuts are found at once,
    from counts only: days, then the minutes of the cut days, then the times of
    the cut minutes, then the ties at the cut times. A window sees one row a
    day, at most 1,440 minutes, at most 60,000 times or one sorted block of ties.
    The counts per time are stored, in as few parts as their size asks for: cached they
    would keep all shuffle partitions, whose tasks at every level cost more than the rows.
    """
    per_time = cut_lineage(df.groupBy(time_col).agg(F.count(F.lit(1)).alias("n")))
    total = int(per_time.agg(F.sum("n")).first()[0] or 0)
    ranks = list(ranks_of(total))
    live = [r for r in ranks if r < total]
    if not live:
        return total, [None] * len(ranks)

    def holds(before: str, n: str = "n") -> Column:
        return reduce(lambda a, b: a | b, [(F.col(before) <= r) & (F.lit(r) < F.col(before) + F.col(n)) for r in live])

    cells, inside = {}, per_time.withColumn("_in", F.lit(0).cast("long"))
    for level in (coarse_ms, 60_000, 1):
        unit = floor_to(F.col(time_col), level) if level > 1 else F.col(time_col)
        counts = inside.groupBy("_in", unit.cast("long").alias("_unit")).agg(F.sum("n").alias("n"))
        w = Window.partitionBy("_in").orderBy("_unit").rowsBetween(Window.unboundedPreceding, 0)
        start = F.coalesce(*[F.when(F.col("_in") == c, F.lit(b)) for c, b in cells.items()]) if cells else F.lit(0)
        placed = counts.select("_unit", "n", (start + F.sum("n").over(w) - F.col("n")).alias("_before"))
        hit = placed.filter(holds("_before")).collect()            # at most one row a rank
        cells = {row["_unit"]: row["_before"] for row in hit}
        inside = per_time.withColumn("_in", unit.cast("long")).filter(F.col("_in").isin(list(cells)))
    cut_times = {r: (row["_unit"], r - row["_before"]) for row in hit for r in live
                 if row["_before"] <= r < row["_before"] + row["n"]}
    ties = ties_at(df, set(cut_times.values()), {row["_unit"]: row["n"] for row in hit}, time_col, tie_col)
    out = []
    for r in ranks:
        if r not in cut_times:
            out.append(None)
        else:
            t, i = cut_times[r]
            out.append((t, ties[(t, i)]))
    return total, out


def ties_at(df: DataFrame, wanted: set[tuple[int, int]], sizes: dict[int, int], time_col: str, tie_col: str,
            per_part: int | None = None) -> dict[tuple[int, int], object]:
    """(time, place) -> the tie value at that 0-based place among the rows of that time.

    ``sizes``: rows at each time. However many symbols share a time, no task sorts them
    all: the rows of the wanted times are range partitioned into sorted blocks, frozen
    with a reliable checkpoint, and counted (a row a block and time); the place is then
    looked up inside the one block that holds it."""
    times = sorted({t for t, _ in wanted})
    parts = max(1, -(-sum(sizes[t] for t in times) // (per_part or KEYS_PER_PART)))
    at = df.filter(F.col(time_col).isin(times)).select(F.col(time_col).alias("_t"), F.col(tie_col).alias("_tie"))
    blocks = cut_lineage(at.repartitionByRange(parts, "_t", "_tie").withColumn("_block", F.spark_partition_id()))
    before: dict[int, int] = {}
    inside: dict[tuple[int, int, int], int] = {}     # (time, block, place in the block) -> place
    for row in blocks.groupBy("_t", "_block").agg(F.count(F.lit(1)).alias("n")).orderBy("_t", "_block").collect():
        done = before.get(row["_t"], 0)
        inside.update({(t, row["_block"], i - done): i for t, i in wanted if t == row["_t"] and done <= i < done + row["n"]})
        before[row["_t"]] = done + row["n"]
    if not inside:
        return {}
    held = reduce(lambda a, b: a | b, [(F.col("_t") == t) & (F.col("_block") == b) for t, b, _ in inside])
    place = F.row_number().over(Window.partitionBy("_t", "_block").orderBy("_tie")) - 1
    found = reduce(lambda a, b: a | b, [(F.col("_t") == t) & (F.col("_block") == b) & (F.col("_place") == i) for t, b, i in inside])
    return {(row["_t"], inside[(row["_t"], row["_block"], row["_place"])]): row["_tie"]
            for row in blocks.filter(held).withColumn("_place", place).filter(found).collect()}


def _at_or_after(cut: tuple, time_col: str, tie_col: str) -> Column:
    t, s = cut
    return (F.col(time_col) > F.lit(t)) | ((F.col(time_col) == F.lit(t)) & (F.col(tie_col) >= F.lit(s)))


def walk_forward_folds(df: DataFrame, k: int = 3, time_col: str = "open_time",
                       tie_col: str = "symbol", snap_to_time: bool = False) -> DataFrame:
    """Add ``fold`` = ntile(k) over (time, symbol) - 1, computed exactly.

    ``snap_to_time`` moves each fold edge to the start of its timestamp, so
    all symbols of one moment share a fold (no moment is split across train
    and validation); folds are then only approximately equal in size.
    """
    _, cuts = rows_at_ranks(df, lambda n: ntile_starts(n, k), time_col, tie_col)
    if snap_to_time:
        terms = [(F.col(time_col) >= F.lit(c[0])).cast("int") for c in cuts if c is not None]
    else:
        terms = [_at_or_after(c, time_col, tie_col).cast("int") for c in cuts if c is not None]
    fold = reduce(lambda a, b: a + b, terms) if terms else F.lit(0)
    return df.withColumn("fold", fold.cast("int"))


def fold_summary(folded: DataFrame, time_col: str = "open_time") -> DataFrame:
    """Per fold: first and last time and row count (AGG-4)."""
    return folded.groupBy("fold").agg(
        F.min(time_col).alias("start_time"), F.max(time_col).alias("end_time"),
        F.count(F.lit(1)).alias("count")).orderBy("fold")


def holdout_by_time(df: DataFrame, train_fraction: float = 0.8, time_col: str = "open_time",
                    tie_col: str = "symbol") -> DataFrame:
    """``split`` = 'train' for the first int(f * n) rows in (time, symbol) order."""
    _, (cut,) = rows_at_ranks(df, lambda n: [int(n * train_fraction)], time_col, tie_col)
    split = F.lit("train") if cut is None else F.when(
        _at_or_after(cut, time_col, tie_col), F.lit("test")).otherwise(F.lit("train"))
    return df.withColumn("split", split)


def key_ranks(df: DataFrame, key: str | list[str] = "symbol", per_key: bool = False,
              keys_per_part: int = KEYS_PER_PART) -> tuple[DataFrame, int]:
    """(distinct keys, of one column or several, with ``_rank`` = 0-based position in
    sorted order, count).

    No step sees all keys in one task: the keys are range-partitioned (sorted
    blocks), the layout is frozen with a reliable checkpoint so a recomputation
    cannot re-sample different bounds, and each key's rank is its block's
    offset (one row per block, broadcast) plus its row number inside the block.
    ``per_key``: ``df`` already has one row per key; its other columns are kept.
    """
    names = [key] if isinstance(key, str) else key
    keys = df if per_key else df.select(*names).distinct()
    n = keys.count()
    parts = max(1, -(-n // keys_per_part))
    ranged = cut_lineage(keys.repartitionByRange(parts, *names)
                         .withColumn("_block", F.spark_partition_id()))
    sizes = ranged.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_block").orderBy(*names)
    ranked = (ranged.join(F.broadcast(offsets), "_block")             # <= parts rows
              .withColumn("_rank", F.col("_off") + F.row_number().over(inside) - 1)
              .drop("_block", "_off"))
    return ranked, n


def symbol_ranks(df: DataFrame, train_fraction: float = 0.8, per_symbol: bool = False) -> DataFrame:
    """Distinct symbols with ``split`` (first int(f * n) sorted symbols train),
    ``split_rank`` (0-based rank inside the split) and ``split_size``.

    ``per_symbol``: ``df`` already has one row per symbol (e.g. per-symbol
    counts); its other columns are kept.
    """
    ranked, n = key_ranks(df, "symbol", per_key=per_symbol)
    extra = [c for c in ranked.columns if c not in ("symbol", "_rank")]
    n_train = int(n * train_fraction)
    train = F.col("_rank") < F.lit(n_train)
    return ranked.select(
        "symbol", *extra,
        F.when(train, F.lit("train")).otherwise(F.lit("test")).alias("split"),
        F.when(train, F.col("_rank")).otherwise(F.col("_rank") - F.lit(n_train)).cast("long").alias("split_rank"),
        F.when(train, F.lit(n_train)).otherwise(F.lit(n - n_train)).cast("long").alias("split_size"))


def sample_symbols(ranks: DataFrame, fraction: float = 0.2) -> DataFrame:
    """Keep the leading int(fraction * split size) symbols of each split."""
    return ranks.filter(F.col("split_rank") < F.floor(F.col("split_size") * F.lit(fraction)))


def key_cuts(keys: DataFrame, ranks_of, key: str = "symbol", **kw) -> tuple[int, list]:
    """(number of distinct keys, [the key at each 0-based rank in sorted order]);
    ``ranks_of(n)`` gives the wanted ranks, past the end gives None."""
    ranked, n = key_ranks(keys, key, **kw)
    ranks = list(ranks_of(n))
    rows = ranked.filter(F.col("_rank").isin(sorted(set(ranks)))).collect()      # at most a row a rank
    at = {r["_rank"]: r[key] for r in rows}
    return n, [at.get(r) for r in ranks]


def file_keys(files: DataFrame, key: str = "symbol") -> DataFrame:
    """The distinct symbols of a table laid out by symbol, stored: finding them opens every
    file, which ranking them would otherwise repeat at each of its steps."""
    return cut_lineage(files.select(key).distinct())


def holdout_files(files: DataFrame, train_fraction: float = 0.8, sample: float = 1.0,
                  key: str = "symbol", keys: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` of a table laid out by symbol, without reading the other side.

    The first int(f * n) sorted symbols train, the rest test; ``sample`` keeps the
    leading int(sample * size) symbols of each side. Both sides are ranges of sorted
    symbols, so each is a comparison with one or two literal symbols: on a partition
    column (``symbol=X`` folders) or a symbol from the file's path
    (``sources.tables.read_symbol_files``) Spark leaves out the other files when it
    plans the scan. Only the symbols themselves are looked at to find the cuts: ``keys``
    (``file_keys``, for several holdouts of one table), or read here."""
    def ranks(n: int) -> list[int]:
        n_train = int(n * train_fraction)
        return [int(n_train * sample), n_train, n_train + int((n - n_train) * sample)]

    _, (end, start, last) = key_cuts(file_keys(files, key) if keys is None else keys, ranks, key, per_key=True)
    symbol = F.col(key)
    train = files if end is None else files.filter(symbol < F.lit(end))
    test = files.filter(F.lit(False)) if start is None else files.filter(symbol >= F.lit(start))
    return train, test if last is None else test.filter(symbol < F.lit(last))


def positions(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """``df`` with its 1-based place in the sorted order of ``order`` (which must name a
    row), found in sorted blocks: no task sorts more than a block (SRT-1)."""
    ranked, _ = key_ranks(df, order, per_key=True)
    return ranked.withColumn(name, F.col("_rank") + 1).drop("_rank")


def class_balance(df: DataFrame) -> DataFrame:
    """label, count and percent of rows (AGG-2)."""
    counts = df.groupBy("label").agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn(
        "pct", F.col("count") * F.lit(100.0) / F.sum("count").over(Window.partitionBy())).orderBy("label")


def class_weights(df: DataFrame, downscale: float = 1.0) -> DataFrame:
    """label -> weight = 1 + (total / (2 count) - 1) * downscale (AGG-3).

    When a class is missing every weight is 1.0 (no weighting).
    """
    counts = df.groupBy("label").agg(F.count(F.lit(1)).alias("count"))
    everything = Window.partitionBy()
    total = F.sum("count").over(everything)
    both = (F.sum(F.when(F.col("label") == 0, F.col("count"))).over(everything).isNotNull()
            & F.sum(F.when(F.col("label") == 1, F.col("count"))).over(everything).isNotNull())
    raw = total / (F.lit(2.0) * F.col("count"))
    weight = F.when(both & F.col("label").isin(0, 1), F.lit(1.0) + (raw - F.lit(1.0)) * F.lit(downscale))
    return counts.select("label", "count", F.coalesce(weight, F.lit(1.0)).alias("weight"))


def add_class_weights(df: DataFrame, downscale: float = 1.0) -> DataFrame:
    """Attach ``weight``. The weights table has at most two rows; it is read
    once and applied as literals (no join back into the data)."""
    weights = {r["label"]: r["weight"] for r in class_weights(df, downscale).collect()}
    w = F.lit(1.0)
    for label in sorted(weights, reverse=True):
        if label is not None:
            w = F.when(F.col("label") == F.lit(label), F.lit(float(weights[label]))).otherwise(w)
    return df.withColumn("weight", w)


def key_fraction(seed: int, *cols: str) -> Column:
    """Deterministic uniform [0, 1) from md5 of the key (layout independent)."""
    text = F.concat_ws(":", *[F.col(c).cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def undersample_majority(df: DataFrame, seed: int = 42,
                         key: tuple[str, ...] = ("symbol", "open_time")) -> DataFrame:
    """Keep every minority row and majority rows whose key fraction < ratio.

    ratio = minority / majority count; on a tie label 1 counts as majority
    (ratio 1 keeps everything). One aggregate gives both counts.
    """
    counts = df.agg(F.count(F.when(F.col("label") == 1, 1)).alias("up"),
                    F.count(F.when(F.col("label") == 0, 1)).alias("down")).first()
    up, down = counts["up"], counts["down"]
    if down > up:
        majority, ratio = 0, up / down
    else:
        majority, ratio = 1, (down / up if up else 1.0)
    keep = (F.col("label") != majority) | (key_fraction(seed, *key) < F.lit(ratio))
    return df.filter(keep)
