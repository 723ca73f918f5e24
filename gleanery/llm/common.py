"""Shared helpers: tables in the shared folder, word segmentation over Arrow buffers, hashing.

Everything here that runs inside tasks works on UTF-8 bytes with numpy, a few megabytes at a
time, so memory does not depend on how many rows or how long a text a task gets (one text is
always handled whole).
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass handles; a longer single text is a pass of its own.
SLICE_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; only where that is unset, one beside the warehouse."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


_stored: list[str] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends there, whoever is lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _stored.append(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_count() -> int:
    """How many stored tables this driver holds: a mark for ``discard_stored``."""
    return len(_stored)


def discard_stored(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Delete the tables stored since a mark, less the last ``keep``, once no result that reads them is needed any more; how many there were."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    end = len(_stored) - keep
    paths = _stored[since:end]
    del _stored[since:end]
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(hadoop).delete(at, True)
    return len(paths)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str = "text"):
    return F.coalesce(F.col(text), F.lit(""))


def fold(column, modulus: int):
    """crc32 of the value written as text, modulo."""
    return F.crc32(column.cast("string").cast("binary")) % modulus


def salted_rank(df: DataFrame, key: list[str], order: list[str], salt_of: list[str], salts: int, out: str) -> DataFrame:
    """A gapless rank from 0 within key, without putting one key's rows into one task.

    Rows are numbered within (key, salt); what the earlier salts of a key hold is added from a
    count table of at most keys x salts rows.
    """
    from pyspark.sql import Window as W

    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_of), F.lit(salts)))
    counts = salted.groupBy(*key, "_salt").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*key).orderBy("_salt").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select(*key, "_salt", F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.row_number().over(W.partitionBy(*key, "_salt").orderBy(*order))
    ranked = salted.withColumn("_rn", within)
    return ranked.join(starts, [*key, "_salt"]).withColumn(out, (F.col("_before") + F.col("_rn") - 1).cast("long")).drop("_salt", "_rn", "_before")


# --- inside tasks -----------------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2**64, kept until the next release."""
    key = str(base)
    if key not in _powers or len(_powers[key]) <= n:
        full = np.full(max(n + 1, SLICE_BYTES + 1), base, np.uint64)
        full[0] = 1
        _powers[key] = np.cumprod(full, dtype=np.uint64)
    return _powers[key]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty texts."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buf = column.buffers()[2]
    return (np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)), off


def slices(off: np.ndarray, most: int = SLICE_BYTES):
    """Row ranges of at most so many bytes, one row at least."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes other than space and 0x09-0x0D: starts, ends, and each text's first word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    ink = ~_SPACE[data]
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    full = off[1:] > off[:-1]
    head, tail = off[:-1][full], off[1:][full] - 1
    first[head] = ink[head]
    last[tail] = ink[tail]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands."""
    n = len(data)
    cum = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_BASE, n)[:n], dtype=np.uint64, out=cum[1:])
    h = (cum[ends] - cum[starts]) * _power(_BASE_INVERSE, n)[starts]
    return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def ngram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive values of h."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= np.uint64(0xC2B2AE3D27D4EB4F)
        out += h[j : j + n]
    return mix64(out)


def release() -> None:
    """Gives what this worker has freed back to the system, Arrow's own pool included; workers outlive their tasks."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """A function for mapInArrow whose worker is left with nothing of its task: idle workers count as an executor's memory too."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            release()

    return whole


def each_slice(batch: pa.RecordBatch, text: str = "text"):
    """(first row, last row + 1, bytes, offsets from 0) for slices of a batch."""
    release()
    data, off = utf8(batch.column(text))
    for lo, hi in slices(off):
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]


# --- texts of a few documents ------------------------------------------------------------------

FILTER_BITS = 23


def possible_rows(docs: DataFrame, ids: DataFrame, id_column: str = "doc_id", wanted: bool = True) -> DataFrame:
    """Rows of docs whose id may be in ids: all that are, and a few others. wanted=False: all other rows.

    A bitmap of 2**FILTER_BITS hash places (1 MB, whatever the corpus) is aggregated in Spark and
    broadcast, so that a following join shuffles the texts it needs rather than all. A crowded bitmap
    only lets more rows through.
    """
    place = F.pmod(F.xxhash64(id_column), F.lit(1 << FILTER_BITS))
    marks = ids.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket"))
    rows = marks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect()
    bits = np.zeros((1 << FILTER_BITS) // 8 + 4096, np.uint8)
    for r in rows:  # bucket 1 has places 1 .. 32768, bucket 0 place 0
        bits[r.bucket * 4096 : r.bucket * 4096 + len(r.bits)] = np.frombuffer(bytes(r.bits), np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        known = shared.value
        for batch in batches:
            spot, bit = (batch.column(batch.num_columns - i).to_numpy() for i in (2, 1))
            found = ((known[spot * 4096 + (bit >> 3)] >> (bit & 7).astype(np.uint8)) & 1).astype(bool)
            yield batch.select(range(batch.num_columns - 2)).filter(pa.array(found == wanted))

    placed = docs.select("*", F.bitmap_bucket_number(place).alias("_spot"), F.bitmap_bit_position(place).alias("_bit"))
    return placed.mapInArrow(tidy(run), docs.schema)


def one_text_each(rows: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text) rows with one row per id: the least text where several share an id. Only such rows are shuffled."""
    repeated = stored(rows.groupBy(id_column).agg(F.count("*").alias("n")).where("n > 1").select(id_column), "repeated-ids")
    if repeated.isEmpty():
        return rows
    some = possible_rows(rows, repeated, id_column).groupBy(id_column).agg(F.min(text).alias(text))
    return possible_rows(rows, repeated, id_column, wanted=False).unionByName(some)
