"""Operator 9: packing by Karmarkar-Karp multiway differencing.

A document's ids (and an end id) are cut where they fill a window; the rest,
cut once more if it is long, joins a group of about ``GROUP_WINDOWS`` windows'
worth.  Each group is split into near-equal windows: partial partitions start
as one piece each, and the two with the widest spread are merged with opposing
order, until one is left.  If its largest window exceeds the capacity, the
group is split again into more windows.

Groups are formed in scan order inside a task, so no text is shuffled and
memory holds one group.

Edge cases: a null or empty text is the end id alone; repeated rows are packed
each; null ids stay null; extra columns are ignored; an empty table gives no
pieces.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenbin import text_groups
from .vocab import Encoder, vocabulary

CAPACITY = 2048
GROUP_WINDOWS = 96
#: A rest longer than this is cut in equal parts: several pieces a window let
#: the differencing even them out.
LONGEST_REST = 512

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def differencing(sizes: Sequence[int], ways: int) -> list[list[int]]:
    """Split ``sizes`` into ``ways`` near-equal sums; returns item numbers."""
    heap: list[tuple[int, int, np.ndarray, list[list[int]]]] = []
    for i, s in enumerate(sizes):
        sums = np.zeros(ways, np.int64)
        sums[-1] = s
        heap.append((-int(s), i, sums, [[] for _ in range(ways - 1)] + [[i]]))
    if not heap:
        return [[] for _ in range(ways)]
    heapq.heapify(heap)
    tie = len(heap)
    while len(heap) > 1:
        _, _, a, left = heapq.heappop(heap)
        _, _, b, right = heapq.heappop(heap)
        # a ascending meets b descending: the largest sum gets the smallest.
        total = a + b[::-1]
        order = np.argsort(total, kind="stable")
        merged = [x + y if x and y else x or y for x, y in zip(left, reversed(right))]
        total = total[order]
        heapq.heappush(heap, (-int(total[-1] - total[0]), tie, total, [merged[k] for k in order]))
        tie += 1
    return heap[0][3]


def windows(sizes: Sequence[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``; their number rises until
    all fit.  No size may exceed the capacity."""
    total = sum(sizes)
    ways = max(1, -(-total // capacity))
    while True:
        split = differencing(sizes, ways)
        most = max(sum(sizes[i] for i in w) for w in split)
        if most <= capacity:
            return [w for w in split if w]
        # Sums stay near-equal, so the overflow tells how many more it takes.
        ways = max(ways + 1, -(-ways * most // capacity) - max(1, ways // 64))


def cuts(n: int, capacity: int = CAPACITY, longest: int = LONGEST_REST) -> list[tuple[int, int]]:
    """``(start, length)``: whole windows first, then the rest in equal parts."""
    full = n // capacity
    out = [(k * capacity, capacity) for k in range(full)]
    at, rest = full * capacity, n - full * capacity
    parts = -(-rest // longest)
    for k in range(parts):
        step = rest // parts + (k < rest % parts)
        out.append((at, step))
        at += step
    return out


def pack_documents(docs: DataFrame, vocab: str = "word_bpe_49k.json", folder: str | None = None,
                   cut: str = "word", end_id: int = 1, capacity: int = CAPACITY,
                   id_col: str = "doc_id", text_col: str = "text", remembered: int | None = None) -> DataFrame:
    """One row per piece; see ``PIECES``.  ``sequence_id`` is the task's
    number in its upper and a running number in its lower 32 bits.
    ``remembered`` bounds the encoder's memory (``vocab``)."""
    file = vocabulary(vocab, folder)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder.load(file, cut, remembered)
        end = np.array([end_id], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 32
        group: list[tuple] = []
        done: list[tuple] = []
        held = 0

        def close() -> None:
            nonlocal sequence, held
            for window in windows([p[2] for p in group], capacity) if group else ():
                offset = 0
                for i in sorted(window):
                    done.append((*group[i], sequence, offset))
                    offset += group[i][2]
                sequence += 1
            group.clear()
            held = 0

        def rows() -> pa.RecordBatch:
            cols = list(zip(*done)) or [[]] * len(names)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

        names = [c.split()[0] for c in PIECES.split(", ")]
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, texts in text_groups(batch, "_text"):
                for k, body in enumerate(enc(texts)):
                    body += end
                    n = len(body) // 4
                    for start, length in cuts(n, capacity):
                        piece = (ids[i + k], start, length, zlib.crc32(body[4 * start:4 * (start + length)]), n)
                        if length == capacity:
                            done.append((*piece, sequence, 0))
                            sequence += 1
                        else:
                            group.append(piece)
                            held += length
                    if held >= GROUP_WINDOWS * capacity:
                        close()
            if done:
                yield rows()
        close()
        if done:
            yield rows()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return texts.mapInArrow(pack, PIECES)
