"""Filling fixed-capacity blocks with items: non-negative least squares over a length histogram.

Only the histogram of item lengths (at most `capacity` bins, whatever the corpus) reaches the
driver. Shallow length combinations that fill the window [capacity - slack, capacity] become the
columns of a sparse non-negative least-squares problem whose solution, rounded down, says how often
each combination is repeated; what is left of the histogram is packed greedily, again by repeated
combinations, so the work depends on the number of distinct lengths and not on the rows. Rows find
their block by their rank among the items of their length.

Defined results: items larger than a block are cut into full blocks and one remainder, and only
those are cut; null and zero sizes are left out; equal rows are items of their own if their
(key, piece) differ, and a repeated key keeps one block position per row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kaghamar.session import cut_lineage

CAPACITY = 2048
#: Items of one length that one task ranks; a more frequent length is cut into buckets by key hash.
BUCKET_ROWS = 100_000


def combinations(counts: np.ndarray, capacity: int, slack: int, per_length: int) -> np.ndarray:
    """Rows of up to four lengths (zero-padded, descending) whose sum fills the window."""
    present = np.flatnonzero(counts)
    if not len(present):
        return np.zeros((0, 4), np.int64)

    def fill(rest: np.ndarray) -> np.ndarray:
        """The largest present length that is at most `rest`, 0 if none."""
        at = np.searchsorted(present, rest, "right") - 1
        return np.where(at >= 0, present[np.maximum(at, 0)], 0)

    weight = np.cumsum(counts[present]) / counts.sum()
    spread = present[np.searchsorted(weight, (np.arange(per_length) + 0.5) / per_length)]
    found = [np.stack([present, fill(capacity - present), 0 * present, 0 * present], 1)]
    for second in np.unique(spread):
        rest = capacity - present - second
        first = present[rest > 0]
        rest = rest[rest > 0]
        third = fill(rest)
        found.append(np.stack([first, 0 * first + second, third, 0 * first], 1))
        found.append(np.stack([first, 0 * first + second, 0 * first + second, fill(rest - second)], 1)[rest > second])
    rows = -np.sort(-np.concatenate(found), axis=1)
    rows = rows[(rows.sum(1) <= capacity) & (rows.sum(1) >= capacity - slack)]
    return np.unique(rows, axis=0)


def nnls(rows: np.ndarray, counts: np.ndarray, steps: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that bring the combinations' lengths nearest to the histogram.

    Accelerated projected gradient; lengths are scaled so that each bin's misfit counts relative to
    the square root of its height.
    """
    used = rows > 0
    scale = 1.0 / np.sqrt(np.maximum(counts, 1.0))

    def ahead(x: np.ndarray) -> np.ndarray:
        return np.bincount(rows[used], np.repeat(x, used.sum(1)), len(counts))

    def back(r: np.ndarray) -> np.ndarray:
        return np.where(used, r[rows], 0.0).sum(1)

    probe = np.ones(len(rows))
    for _ in range(30):
        probe = back(scale**2 * ahead(probe))
        norm = np.linalg.norm(probe)
        probe /= norm
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(steps):
        nxt = np.maximum(0.0, y - back(scale**2 * (ahead(y) - counts)) / (1.05 * norm))
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nxt + (t - 1) / t_next * (nxt - x)
        x, t = nxt, t_next
    return x


def plan(counts: np.ndarray, capacity: int = CAPACITY, slack: int = 24, per_length: int = 24) -> list[tuple[list[int], int]]:
    """[(lengths of one block, repeats)] that use up the histogram `counts` (index = length) exactly."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[list[int], int]] = []
    if left[capacity]:
        out.append(([capacity], int(left[capacity])))
        left[capacity] = 0
    rows = combinations(left, capacity, slack, per_length)
    if len(rows):
        repeats = np.floor(nnls(rows, left.astype(float)) + 1e-6).astype(np.int64)
        for row, times in sorted(zip(rows.tolist(), repeats.tolist()), key=lambda x: -x[1]):
            lengths = [v for v in row if v]
            need = {v: lengths.count(v) for v in lengths}
            times = min([times, *(int(left[v]) // n for v, n in need.items())])
            if times > 0:
                out.append((lengths, times))
                for v, n in need.items():
                    left[v] -= n * times
    present = np.flatnonzero(left)
    while len(present):
        rest, lengths = capacity, []
        while rest > 0:
            at = int(np.searchsorted(present, rest, "right")) - 1
            while at >= 0 and lengths.count(int(present[at])) >= left[present[at]]:
                at -= 1
            if at < 0:
                break
            lengths.append(int(present[at]))
            rest -= lengths[-1]
        need = {v: lengths.count(v) for v in lengths}
        times = min(int(left[v]) // n for v, n in need.items())
        out.append((lengths, times))
        for v, n in need.items():
            left[v] -= n * times
        present = present[left[present] > 0]
    return out


def slots(blocks: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank + 1, first block, repeats of the length in it, offset of the first)."""
    out, taken, block = [], {}, 0
    for lengths, times in blocks:
        lengths = sorted(lengths, reverse=True)
        for v in dict.fromkeys(lengths):
            n = lengths.count(v)
            first = taken.get(v, 0)
            out.append((v, first, first + n * times, block, n, sum(lengths[: lengths.index(v)])))
            taken[v] = first + n * times
        block += times
    return out


def fill_blocks(sizes: DataFrame, key: str = "doc_id", size: str = "n_tokens", capacity: int = CAPACITY, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(key, piece, n_tokens, block_id, block_offset): where each item, or each piece of it, lies.

    piece counts from 0 in an item larger than a block. The rows' ranks within a length come from a
    window per (length, hash bucket) plus the buckets' running counts, with as many buckets as a length's rows need; `sizes` is cut off from its
    lineage once, as both the histogram and the assignment read it.
    """
    spark = sizes.sparkSession
    named = sizes.select(F.col(key).alias("k"), F.col(size).cast("long").alias("n")).filter(F.col("n") > 0)
    pieces = named.select(
        "k",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.ceil(F.col("n") / capacity).cast("int") - 1),
                lambda i: F.least(F.lit(capacity), F.col("n") - i * capacity).cast("int"),
            )
        ).alias("piece", "len"),
    )
    pieces = cut_lineage(pieces)
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("len").agg(F.count("*").alias("c")).collect():  # at most `capacity` rows
        counts[row["len"]] = row["c"]
    share = spark.createDataFrame([(int(v), int(-(-counts[v] // bucket_rows))) for v in np.flatnonzero(counts)] or [(0, 1)], "len int, buckets int")
    pieces = pieces.join(F.broadcast(share), "len").withColumn("bucket", F.pmod(F.xxhash64("k", "piece"), F.col("buckets")).cast("int"))
    per_bucket = pieces.groupBy("len", "bucket").agg(F.count("*").alias("c"))
    table = slots(plan(counts, capacity)) or [(0, 0, 0, 0, 1, 0)]
    where = spark.createDataFrame(table, "len int, lo long, hi long, block long, times int, offset int")
    start = per_bucket.withColumn("start", F.sum("c").over(Window.partitionBy("len").orderBy("bucket")) - F.col("c")).drop("c")
    ranked = pieces.withColumn("r", F.row_number().over(Window.partitionBy("len", "bucket").orderBy("k", "piece")))
    ranked = ranked.join(start, ["len", "bucket"]).withColumn("rank", F.col("start") + F.col("r") - 1)
    inside = F.col("rank") - F.col("lo")
    # A length has a bounded number of slot ranges (they come from the plan, not the rows); the range
    # that holds the rank is picked from a sorted array per length instead of by a range join.
    ranges = where.groupBy("len").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "block", "times", "offset"))).alias("ranges"))
    hit = ranked.join(F.broadcast(ranges), "len")
    hit = hit.withColumn("s", F.filter("ranges", lambda x: (x["lo"] <= F.col("rank")) & (F.col("rank") < x["hi"]))[0])
    hit = hit.select("k", "piece", "len", "rank", "s.*")
    return hit.select(
        F.col("k").alias(key),
        F.col("piece").cast("int").alias("piece"),
        F.col("len").cast("int").alias("n_tokens"),
        (F.col("block") + (inside / F.col("times")).cast("long")).alias("block_id"),
        (F.col("offset") + (inside % F.col("times")).cast("int") * F.col("len")).cast("int").alias("block_offset"),
    )
