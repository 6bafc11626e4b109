"""Operator 6: token ids as fixed-width packed blocks.

Documents are ordered by id (a range shuffle), encoded, closed with an end id,
and stored in blocks: each id takes ``width`` bits, the fewest that hold the
vocabulary, least significant bit first.  A block also holds its documents'
ids and running ends, so any document's ids are read by offset, without its
neighbours, by vectorised numpy arithmetic.  Blocks are rows of a Parquet
table: Spark's writer commits them whole, on any file system.

Table: ``part, block, first_id`` (ids of this part before the block),
``doc_ids, ends`` (arrays), ``width, n_ids, payload``.

Edge cases: a null or empty text is the end id alone; null document ids come
first; repeated rows and ties in the id are all stored, ordered by text hash;
extra columns are ignored; an empty table gives no blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import CHUNK_BYTES, keyed, real_id, utf8
from .vocab import Encoder, vocabulary

BLOCK_IDS = 1 << 20
BLOCKS = ("part int, block int, first_id long, doc_ids array<long>, ends array<long>, "
          "width int, n_ids long, payload binary")
#: Parts whose totals are broadcast; beyond it they are joined by shuffle.
MAX_BROADCAST_PARTS = 200_000


def width_for(vocab_size: int) -> int:
    return max(1, (vocab_size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``width`` bits an id, least significant bit first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, width: int, start: int, count: int) -> np.ndarray:
    """Ids ``[start, start + count)``; touches only their bytes."""
    if width in (8, 16, 32):
        return np.frombuffer(payload, f"<u{width // 8}", count, start * (width // 8)).astype(np.uint32)
    bit = (start + np.arange(count, dtype=np.int64)) * width
    body = np.frombuffer(payload, np.uint8)
    lo, hi = (start * width) >> 3, -(-(start + count) * width // 8)
    body = np.concatenate([body[lo:hi], np.zeros(8, np.uint8)]).astype(np.uint64)
    at = (bit >> 3) - lo
    word = np.zeros(count, np.uint64)
    for k in range(5):
        word |= body[at + k] << np.uint64(8 * k)
    return ((word >> (bit & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.uint32)


def text_groups(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[str]]]:
    """Texts in runs of about ``CHUNK_BYTES``, with the first row's index."""
    col = batch.column(batch.schema.get_field_index(column))
    off, _ = utf8(col)
    i, n = 0, len(col)
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + CHUNK_BYTES, "right")) - 1)
        yield i, col.slice(i, j - i).to_pylist()
        i = j


def write_ids(docs: DataFrame, path: str, vocab: str = "byte_bpe_50k.json", folder: str | None = None,
              cut: str = "byte", end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
              parts: int | None = None, remembered: int | None = None) -> None:
    """Encode ``docs`` and write the block table at ``path``; ``remembered``
    bounds the encoder's memory (``vocab``)."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    file = vocabulary(vocab, folder)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder.load(file, cut, remembered)
        width = width_for(max(enc.tok.get_vocab_size(), end_id + 1))
        end = np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        held: list[bytes] = []
        ids: list[int] = []
        block = first = size = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, first, size
            ends = np.cumsum([len(h) // 4 for h in held])
            all_ids = np.frombuffer(b"".join(held), "<u4")
            row = {"part": [part], "block": [block], "first_id": [first], "doc_ids": [list(ids)],
                   "ends": [ends.tolist()], "width": [width], "n_ids": [len(all_ids)],
                   "payload": [pack(all_ids, width)]}
            block, first, size = block + 1, first + len(all_ids), 0
            held.clear()
            ids.clear()
            return pa.RecordBatch.from_pydict(row, schema=SCHEMA)

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for i, texts in text_groups(batch, "_text"):
                for k, b in enumerate(enc(texts)):
                    held.append(b + end)
                    ids.append(doc_ids[i + k])
                    size += len(b) // 4 + 1
                    if size >= BLOCK_IDS:
                        yield flush()
        if held:
            yield flush()

    ordered = keyed(docs, id_col, text_col).repartitionByRange(parts, "_d").sortWithinPartitions("_d", "_u")
    ordered.select("_d", "_text").mapInArrow(encode, BLOCKS).write.parquet(path)


SCHEMA = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
                    ("width", pa.int32()), ("n_ids", pa.int64()), ("payload", pa.binary())])


def read_blocks(spark, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def part_starts(blocks: DataFrame) -> DataFrame:
    """``part, part_start``: ids in earlier parts.  One row a part."""
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))


def documents_in(blocks: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each stored document, read
    from the packed payloads."""
    starts = part_starts(blocks)
    if starts.count() <= MAX_BROADCAST_PARTS:
        starts = F.broadcast(starts)
    placed = blocks.join(starts, "part").select(
        (F.col("part_start") + F.col("first_id")).alias("first"), "doc_ids", "ends", "width", "payload")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends = np.array(row["ends"], np.int64)
                begins = np.concatenate([[0], ends[:-1]])
                crc = [zlib.crc32(unpack(row["payload"], row["width"], int(b), int(e - b)).astype("<u4").tobytes())
                       for b, e in zip(begins, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(begins + row["first"]),
                     pa.array(ends - begins), pa.array(crc, pa.int64())],
                    names=["_d", "start", "n_tokens", "ids_crc32"])

    out = placed.mapInArrow(digest, "_d long, start long, n_tokens long, ids_crc32 long")
    return out.select(real_id().alias("doc_id"), "start", "n_tokens", "ids_crc32")


def token_table(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` to a new block table in the shared folder; return it."""
    path = scratch_path(docs.sparkSession, "llm", "token-blocks")
    write_ids(docs, path, **options)
    return read_blocks(docs.sparkSession, path)
