"""Token-id files with bit-plane shuffling.

A file holds whole documents in ascending id order. Its ids are cut into blocks of a fixed number of
ids; a block is transposed into bit planes (plane b has bit b of every id) or byte planes, each plane
is compressed with zstandard, and a chunk index says where each block's planes are. A file is one
record of a Parquet table (``range``, ``file``, ``payload``) that Spark's own committer writes, so a
lost executor leaves no half-written file and any store that Spark reaches will do.

Payload, little-endian: 4 bytes magic, uint32 block size, uint8 plane bits (1 or 8), uint64 ids,
uint32 documents, then per document int64 id and uint64 ids (a flag byte tells null ids), uint32
blocks, then per block uint32 ids, uint8 planes and uint32 compressed length of each plane, then the
planes.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import shared_dir, slices, text_or_empty, tidy, utf8
from .tokens import encoder

MAGIC = b"GLBP"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 20
#: Words a worker keeps the ids of.
CACHED_WORDS = 500_000
#: Text that one range of documents may hold, the unit of the sort.
RANGE_BYTES = 128 << 20


def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """Planes of one block: as many as its largest id needs."""
    ids = ids.astype("<u4")
    octets = ids.view(np.uint8).reshape(-1, 4)
    top = int(ids.max()).bit_length() if len(ids) else 0
    if bits == 8:
        return [np.ascontiguousarray(octets[:, p]).tobytes() for p in range(-(-top // 8))]
    planes = []
    for p in range(-(-top // 8)):
        column = np.ascontiguousarray(octets[:, p])
        planes += [np.packbits(column >> b & 1, bitorder="little").tobytes() for b in range(min(8, top - 8 * p))]
    return planes


def from_planes(planes: list[bytes], n: int, bits: int) -> np.ndarray:
    octets = np.zeros((4, n), np.uint8)
    if bits == 8:
        for p, raw in enumerate(planes):
            octets[p] = np.frombuffer(raw, np.uint8)
    else:
        for p, raw in enumerate(planes):
            octets[p >> 3] |= np.unpackbits(np.frombuffer(raw, np.uint8), count=n, bitorder="little") << (p & 7)
    return np.ascontiguousarray(octets.T).view("<u4").ravel()


def pack_file(doc_ids: list, lengths: list[int], ids: np.ndarray, bits: int = 1, block: int = BLOCK_IDS) -> bytes:
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=1).compress
    index, body = [], []
    for lo in range(0, len(ids), block):
        planes = [squeeze(p) for p in to_planes(ids[lo : lo + block], bits)]
        index.append(struct.pack(f"<IB{len(planes)}I", min(block, len(ids) - lo), len(planes), *map(len, planes)))
        body += planes
    docs = b"".join(struct.pack("<BqQ", d is None, d or 0, n) for d, n in zip(doc_ids, lengths))
    head = struct.pack("<4sIBQI", MAGIC, block, bits, len(ids), len(doc_ids))
    return b"".join([head, docs, struct.pack("<I", len(index)), *index, *body])


def _index(payload: bytes):
    """(plane bits, block size, ids, documents, blocks (ids, plane lengths), place of the first plane)"""
    magic, block, bits, total, n_docs = struct.unpack_from("<4sIBQI", payload)
    if magic != MAGIC:
        raise ValueError("not a token-id file")
    at = struct.calcsize("<4sIBQI")
    docs = list(struct.iter_unpack("<BqQ", payload[at : at + 17 * n_docs]))
    at += 17 * n_docs
    (n_blocks,) = struct.unpack_from("<I", payload, at)
    at += 4
    blocks = []
    for _ in range(n_blocks):
        n, planes = struct.unpack_from("<IB", payload, at)
        blocks.append((n, struct.unpack_from(f"<{planes}I", payload, at + 5)))
        at += 5 + 4 * planes
    return bits, block, total, docs, blocks, at


def read_ids(payload: bytes, start: int = 0, count: int | None = None) -> np.ndarray:
    """Ids from ``start`` on, as many as asked for and there: only the blocks that hold them are expanded."""
    import zstandard

    expand = zstandard.ZstdDecompressor().decompress
    bits, block, total, _, blocks, at = _index(payload)
    stop = total if count is None else min(total, start + count)
    parts, low = [np.zeros(0, np.uint32)], 0
    for n, sizes in blocks:
        if low < stop and low + n > start:
            ends = np.cumsum((at, *sizes)).tolist()
            ids = from_planes([expand(payload[a:b]) for a, b in zip(ends[:-1], ends[1:])], n, bits)
            parts.append(ids[max(0, start - low) : stop - low])
        low, at = low + n, at + sum(sizes)
    if low != total:
        raise ValueError("token-id file is cut short")
    return np.concatenate(parts)


def unpack_file(payload: bytes) -> tuple[list, list[int], np.ndarray]:
    """(document ids, id counts, all ids)"""
    docs = _index(payload)[3]
    return [None if null else d for null, d, _ in docs], [n for *_, n in docs], read_ids(payload)


def _encode(path: str, end_id: int, borders: list[int]):
    """Tasks: (doc_id, text) -> (range, doc_id, ids as little-endian bytes of two or four bytes each)."""
    wide = 2
    edges = np.array(borders, np.int64)
    schema = pa.schema([("range", pa.int32()), ("doc_id", pa.int64()), ("width", pa.int8()), ("ids", pa.binary())])

    def run(batches):
        enc = encoder(path, CACHED_WORDS)
        try:
            yield from encoded(enc, batches)
        finally:  # workers outlive their tasks
            enc.clear()

    def encoded(enc, batches):
        for batch in batches:
            _, off = utf8(batch.column("text"))
            for lo, hi in slices(off, 1 << 21):
                part = batch.slice(lo, hi - lo)
                docs = part.column("doc_id").to_pylist()
                ids, at = enc.encode(part.column("text").to_pylist())
                width = wide if not len(ids) or max(int(ids.max()), end_id) < 1 << 16 else 4
                narrow = ids.astype("<u2" if width == 2 else "<u4")
                end = np.array([end_id], narrow.dtype).tobytes()
                blobs = [narrow[a:b].tobytes() + end for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                ranges = np.searchsorted(edges, [x if x is not None else -(1 << 63) for x in docs], "right").astype(np.int32)
                yield pa.record_batch([pa.array(ranges), pa.array(docs, pa.int64()), pa.array([width] * len(docs), pa.int8()), pa.array(blobs, pa.binary())], schema=schema)

    return run


def _files(bits: int):
    """Tasks: rows sorted by (range, doc_id) -> files of about FILE_IDS ids."""
    schema = pa.schema([("range", pa.int32()), ("file", pa.int32()), ("n_ids", pa.int64()), ("payload", pa.binary())])

    def run(batches):
        held: list = []
        size, place, number = 0, None, 0

        def flush():
            nonlocal held, size, number
            ids = np.concatenate([x for _, x in held])
            blob = pack_file([d for d, _ in held], [len(x) for _, x in held], ids, bits)
            out = pa.record_batch([pa.array([place], pa.int32()), pa.array([number], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([blob], pa.binary())], schema=schema)
            held, size, number = [], 0, number + 1
            return out

        for batch in batches:
            for r, d, w, raw in zip(*(batch.column(c).to_pylist() for c in ("range", "doc_id", "width", "ids"))):
                if held and (r != place or size >= FILE_IDS):
                    yield flush()
                if r != place:
                    place, number = r, 0
                ids = np.frombuffer(raw, f"<u{w}")
                held.append((d, ids))
                size += len(ids)
        if held:
            yield flush()

    return run


def _read(batches):
    schema = pa.schema([("range", pa.int32()), ("file", pa.int32()), ("doc_id", pa.int64()), ("place", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for r, f, blob in zip(batch.column("range").to_pylist(), batch.column("file").to_pylist(), batch.column("payload")):
            docs, lengths, ids = unpack_file(blob.as_py())
            at = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            n = len(docs)
            yield pa.record_batch([pa.array([r] * n, pa.int32()), pa.array([f] * n, pa.int32()), pa.array(docs, pa.int64()), pa.array(at[:-1]), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())], schema=schema)


def write_token_files(docs: DataFrame, tokenizer_path: str, out: str, end_id: int = 2, bits: int = 1, id_column: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, append end_id, and write files in ascending id order under ``out``.

    Null texts are empty (they hold the end id alone). A null document id stands first; rows that share
    an id stand together in any order. An empty table writes an empty table.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    n = max(4 * parts, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // RANGE_BYTES))
    # The ids alone are dealt out by ranges; what comes to the driver is the last id of each, one per RANGE_BYTES of text.
    ends = rows.where("doc_id IS NOT NULL").select("doc_id").repartitionByRange(n, "doc_id").groupBy(F.spark_partition_id().alias("part")).agg(F.max("doc_id").alias("last")).collect()
    borders = [r["last"] + 1 for r in ends if r["last"] < (1 << 63) - 1]
    encoded = rows.mapInArrow(tidy(_encode(tokenizer_path, end_id, sorted(set(borders or [])))), "range int, doc_id long, width byte, ids binary")
    ordered = encoded.repartition(max(parts, n // 4), "range").sortWithinPartitions("range", F.asc_nulls_first("doc_id"))
    ordered.mapInArrow(tidy(_files(bits)), "range int, file int, n_ids long, payload binary").write.parquet(out)


def read_token_files(spark, path: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    files = spark.read.parquet(path)
    found = files.select("range", "file", "payload").mapInArrow(tidy(_read), "range int, file int, doc_id long, place long, n_tokens long, ids_crc32 long")
    sizes = files.select("range", "file", "n_ids")
    # One row per range of documents (RANGE_BYTES of text) meets in the one window that has no key.
    whole = sizes.groupBy("range").agg(F.sum("n_ids").alias("n"))
    upto = whole.select("range", (F.sum("n").over(W.orderBy("range")) - F.col("n")).alias("before"))
    within = F.sum("n_ids").over(W.partitionBy("range").orderBy("file")) - F.col("n_ids")
    starts = sizes.withColumn("inside", within).join(upto, "range").select("range", "file", (F.col("before") + F.col("inside")).alias("base"))
    return found.join(starts, ["range", "file"]).select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def token_file_digest(docs: DataFrame, tokenizer_path: str, end_id: int = 2, bits: int = 1) -> DataFrame:
    """Write the files in the shared folder and read them back."""
    import uuid

    out = f"{shared_dir(docs.sparkSession)}/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, tokenizer_path, out, end_id, bits)
    return read_token_files(docs.sparkSession, out)
