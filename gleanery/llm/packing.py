"""Best-fit packing with length patterns and non-negative least squares.

1. Every document becomes pieces of at most ``capacity`` ids (the first piece of a long document takes
   the remainder), and Spark counts pieces per length: at most ``capacity`` counts, whatever the corpus.
2. Patterns are one, two or three lengths that sum to the capacity; all are enumerated. Their repeat
   counts are fitted to the histogram by weighted non-negative least squares, by block coordinate descent
   in which counts rise and fall; then they are rounded and held to what the histogram has, and the rest
   is fitted once more.
3. What the patterns leave is packed best-fit, longest first, on the histogram as well: open sequences
   are grouped by their free space, so the work depends on the capacity and not on the piece count.
4. Both give a layout: (length, first rank, last rank) -> sequence base and offset. Pieces are ranked
   within their length in Spark and look their place up. The layout has a bounded number of rows
   (patterns x slots plus best-fit runs, both set by the capacity), so it may be broadcast.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, salted_rank, slices, stored, text_or_empty, tidy, utf8
from .tokens import encoder

#: Rounds of the fit, the step at which it ends, and how many coordinates a round looks at.
ROUNDS, TOLERANCE, _BLOCK = 40, 0.25, 2048
WEIGHT_POWER = 4
#: Words a worker keeps the ids of.
CACHED_WORDS = 350_000


def patterns_of(capacity: int) -> np.ndarray:
    """All patterns of one, two or three lengths that sum to the capacity: rows of lengths, longest first, 0 for none."""
    rows = [np.array([[capacity, 0, 0]])]
    for a in range(-(-capacity // 3), capacity):
        b = np.arange(-(-(capacity - a) // 2), min(a, capacity - a) + 1)
        rows.append(np.column_stack([np.full(len(b), a), b, capacity - a - b]))
    return np.concatenate(rows)


def solve(histogram: np.ndarray, patterns: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[np.ndarray, int, int]:
    """x >= 0 that minimises the sum over lengths of weight (A x - histogram)^2, and how many steps raised and lowered a count.

    Block coordinate descent: each round takes, of the coordinates whose exact line-search step would gain
    most, those that share no length (their steps don't touch each other), and moves each by its step. A
    step may be negative as long as its count stays at 0 or more, and a length may be overdrawn on the way.
    It ends when no step is as large as the tolerance.
    """
    w = np.append(0.0, weight[1:])
    a, b, c = patterns.T
    ab, bc = a == b, (b == c) & (b > 0)
    norm = w[patterns].sum(1) + 2 * w[a] * ab + 2 * w[b] * bc + 2 * w[a] * (ab & bc)  # equal lengths count squared
    root = np.sqrt(norm)
    residual, x = histogram.astype(np.float64), np.zeros(len(patterns))
    rises = falls = 0
    for _ in range(rounds):
        step = np.maximum((w * residual)[patterns].sum(1) / norm, -x)
        gain = np.abs(step) * root
        top = np.argpartition(gain, -_BLOCK)[-_BLOCK:] if len(gain) > _BLOCK else np.arange(len(gain))
        top = top[np.abs(step[top]) > tolerance]
        if not len(top):
            break
        taken, used = [], set()
        for i in top[np.argsort(-gain[top], kind="stable")].tolist():
            lengths = set(patterns[i].tolist()) - {0}
            if used.isdisjoint(lengths):
                used |= lengths
                taken.append(i)
        moved = step[taken]
        rises, falls = rises + int((moved > 0).sum()), falls + int((moved < 0).sum())
        x[taken] += moved
        np.subtract.at(residual, patterns[taken].ravel(), np.repeat(moved, 3))
        residual[0] = 0
    return x, rises, falls


def fit_patterns(histogram: np.ndarray, fits: int = 2) -> dict[tuple[int, ...], int]:
    """Repeat counts of patterns of up to three lengths that fill the capacity exactly, within the histogram.

    histogram[n] is the number of pieces of length n; its last index is the capacity. The counts are a
    non-negative least-squares fit, rounded; largest first, a count is lowered where it would overdraw a
    length. What that leaves of the histogram is fitted once more. The weight grows with the length: a long
    piece left over costs a sequence, a short one fits somewhere.
    """
    capacity = len(histogram) - 1
    patterns, weight = patterns_of(capacity), (np.arange(capacity + 1) / capacity) ** WEIGHT_POWER + 1e-9
    left = histogram.astype(np.int64).copy()
    counts: dict[tuple[int, ...], int] = {}
    for _ in range(fits):
        x, _, _ = solve(left, patterns, weight)
        some = np.flatnonzero(x >= 0.5)
        for i in some[np.argsort(-x[some], kind="stable")].tolist():
            unique, times = np.unique(patterns[i][patterns[i] > 0], return_counts=True)
            n = int(min(np.floor(x[i] + 0.5), (left[unique] // times).min()))
            if n > 0:
                pattern = tuple(sorted(patterns[i][patterns[i] > 0].tolist()))
                counts[pattern] = counts.get(pattern, 0) + n
                left[unique] -= n * times
    return counts


def layout(histogram: np.ndarray) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rows (length, first rank, ranks, sequence of the first rank, offset), and the number of sequences."""
    capacity = len(histogram) - 1
    used = np.zeros(capacity + 1, np.int64)
    rows: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def place(length: int, n: int, base: int, offset: int) -> None:
        rows.append((length, int(used[length]), n, base, offset))
        used[length] += n

    for pattern, n in fit_patterns(histogram).items():
        offset = 0
        for length in reversed(pattern):
            place(length, n, sequences, offset)
            offset += length
        sequences += n
    # Best fit, longest first: runs of sequences with the same free space take the same number of pieces.
    spaces: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # free space -> (first sequence, count)
    for length in range(capacity, 0, -1):
        n = int(histogram[length] - used[length])
        space = length
        while n and space <= capacity:
            if not spaces[space]:
                space += 1
                continue
            base, count = spaces[space].pop()
            take = min(n, count)
            place(length, take, base, capacity - space)
            spaces[space - length].append((base, take))
            if take < count:
                spaces[space].append((base + take, count - take))
            n -= take
        if n:
            each = capacity // length
            full, over = divmod(n, each)
            for count, pieces in ((full, each), (1 if over else 0, over)):
                if count:
                    for i in range(pieces):
                        place(length, count, sequences, i * length)
                    spaces[capacity - pieces * length].append((sequences, count))
                    sequences += count
    return rows, sequences


def _pieces(path: str, end_id: int, capacity: int):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        enc = encoder(path, CACHED_WORDS)
        try:
            yield from pieces(enc, batches)
        finally:  # workers outlive their tasks; their memory is other stages'
            enc.clear()
            release()

    def pieces(enc, batches):
        for batch in batches:
            _, off = utf8(batch.column("text"))
            for lo, hi in slices(off):
                part = batch.slice(lo, hi - lo)
                ids, at = enc.encode(part.column("text").to_pylist())
                rows = []
                for d, a, b in zip(part.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    own = np.append(ids[a:b], end_id).astype("<u4")
                    raw = memoryview(own.tobytes())
                    start, stop = 0, len(own) % capacity or capacity
                    piece = 0
                    while start < len(own):
                        rows.append((d, piece, start, stop - start, zlib.crc32(raw[4 * start : 4 * stop])))
                        start, stop, piece = stop, stop + capacity, piece + 1
                yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    return run


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for every whole text; a null text has the end id alone."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(tidy(_pieces(tokenizer_path, end_id, capacity)), "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int = 2048, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` from 1 to the capacity.

    Sequences are filled without gaps from offset 0. Rows of one length take its places in the order of
    a salted rank, so one length may hold any share of the rows. Rows alike in every order column (a
    repeated document) get a place each. No rows give no rows.
    """
    spark = pieces.sparkSession
    counts = {r.length: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        histogram[length] = n
    places, _ = layout(histogram)
    # A row per length, with its runs in order of their first ranks; a rank finds its run by binary search.
    runs: dict[int, list[tuple[int, int, int]]] = {}
    for length, low, _, sequence, offset in sorted(places):
        runs.setdefault(int(length), []).append((int(low), int(sequence - low), int(offset)))
    schema = "length long, runs array<struct<low:long,shift:long,offset:long>>"
    plan = spark.createDataFrame(list(runs.items()), schema)
    ranked = salted_rank(pieces, ["length"], list(order), list(order), 64, "rank")
    halves = F.array(*(F.lit(1 << k) for k in range(max(map(len, runs.values()), default=1).bit_length() - 1, -1, -1)))
    reaches = lambda at: (at < F.size("runs")) & (F.get("runs", at)["low"] <= F.col("rank"))
    run = F.aggregate(halves, F.lit(0), lambda at, half: F.when(reaches(at + half), at + half).otherwise(at))
    found = ranked.join(F.broadcast(plan), "length").withColumn("run", F.get("runs", run))
    return found.withColumns({"sequence_id": F.col("rank") + F.col("run.shift"), "offset": F.col("run.offset")}).drop("runs", "run", "rank")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Every document's pieces with their sequence and place in it."""
    return pack(stored(cut_pieces(docs, tokenizer_path, capacity, end_id), "pieces"), capacity)
