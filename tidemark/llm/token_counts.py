"""Operator 2: edit-aware token counts.

Each document keeps a segment tree: its leaves are runs of about ``LEAF``
pre-token pieces, its nodes sums of characters and of tokens.  An edit finds
its leaves by descending the character sums, re-encodes only them (with the
neighbour whose border the edit can move), writes the new sums and adds up
along the path to the root.  The root is the document's token count.

Pieces are cut before a blank between two non-blanks.  Such a border depends on
those three characters alone, so leaves that stay clear of an edit keep
theirs, and counts over leaves equal a count of the whole edited text.

Trees are columns beside the text: arrays of ``2 * n`` sums with the root at 1
and leaf i at ``n + i``.

Edits are ``start, end, text`` in code points of the unedited text; they must
not overlap, and equal starts apply in array order.  Edges past the end mean
the end.

Edge cases: a null or empty text is one empty leaf; null edits are none;
repeated rows are counted each; null ids stay null; extra columns are kept,
and one that is named like a result column is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenbin import text_groups
from .vocab import Encoder, vocabulary

LEAF = 64
EDITS = "array<struct<start: long, end: long, text: string>>"
COUNTS = "n_tokens long, n_edits int, n_tokens_after long, n_leaves int, n_reencoded int"


def tree_of(sums: np.ndarray) -> np.ndarray:
    """Heap of sums over leaves (``len(sums)`` of them, padded to a power of
    two)."""
    n = 1 << max(0, len(sums) - 1).bit_length()
    heap = np.zeros(2 * n, np.int64)
    heap[n:n + len(sums)] = sums
    while n > 1:
        heap[n // 2:n] = heap[n:2 * n:2] + heap[n + 1:2 * n:2]
        n //= 2
    return heap


def find_leaf(heap: np.ndarray, at: int) -> tuple[int, int]:
    """``(leaf, its first character)`` of the leaf that holds character
    ``at``; the last one with any beyond the end."""
    n, i, start = len(heap) // 2, 1, 0
    at = min(at, max(int(heap[1]) - 1, 0))
    while i < n:
        i *= 2
        if at - start >= heap[i]:
            start += int(heap[i])
            i += 1
    return i - n, start


def set_leaf(heap: np.ndarray, leaf: int, value: int) -> None:
    i = len(heap) // 2 + leaf
    change = value - int(heap[i])
    while i:
        heap[i] += change
        i //= 2


def leaves(enc: Encoder, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Characters and tokens of each leaf."""
    pieces = enc.cut(text)
    if not pieces:
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    cut = np.arange(0, len(pieces), LEAF)
    # A piece stands for a blank and itself, the first for itself and a mark.
    size = np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1
    size[0] -= 2
    return (np.add.reduceat(size, cut),
            np.add.reduceat(np.array(enc.counts(pieces), np.int64), cut))


def apply(enc: Encoder, text: str, chars: np.ndarray, tokens: np.ndarray, edits: list[dict]) -> int:
    """Applies ``edits`` to both trees in place; returns the leaves
    re-encoded.  Character sums stay those of the unedited text, in which
    edits are addressed."""
    size = len(text)
    edits = sorted(({"start": min(max(e["start"], 0), size), "end": min(max(e["end"], e["start"], 0), size),
                     "text": e["text"] or ""} for e in edits), key=lambda e: e["start"])
    regions: list[list] = []  # first leaf, end leaf, first character, end character, edits
    for e in edits:
        # A leaf [a, b) is touched if start <= b + 1 and end >= a.
        first, a = find_leaf(chars, max(e["start"] - 2, 0))
        last, b = find_leaf(chars, e["end"])
        b += int(chars[len(chars) // 2 + last])
        if regions and first < regions[-1][1]:
            r = regions[-1]
            r[1], r[3] = max(r[1], last + 1), max(r[3], b)
            r[4].append(e)
        else:
            regions.append([first, last + 1, a, b, [e]])
    done = 0
    for first, end, a, b, some in regions:
        parts, at = [], a
        for e in some:
            parts += [text[at:e["start"]], e["text"]]
            at = e["end"]
        parts.append(text[at:b])
        set_leaf(tokens, first, sum(enc.counts(enc.cut("".join(parts)))))
        for leaf in range(first + 1, end):
            set_leaf(tokens, leaf, 0)
        done += end - first
    return done


def with_trees(docs: DataFrame, vocab: str = "byte_bpe_50k.json", folder: str | None = None,
               text_col: str = "text") -> DataFrame:
    """``docs`` with ``tree_chars, tree_tokens``; a null text becomes empty."""
    file = vocabulary(vocab, folder)
    rows = docs.drop("tree_chars", "tree_tokens").withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder.load(file, "byte")
        for batch in batches:
            for i, texts in text_groups(batch, text_col):
                both = [[tree_of(x).tolist() for x in leaves(enc, t)] for t in texts]
                part = batch.slice(i, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array([b[k] for b in both], pa.list_(pa.int64())) for k in (0, 1))],
                    names=[*part.schema.names, "tree_chars", "tree_tokens"])

    return rows.mapInArrow(build, _ddl(rows) + ", tree_chars array<long>, tree_tokens array<long>")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def attach_edits(rows: DataFrame, edits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``rows`` with the ``edits`` of its document; ``edits`` holds ``id_col,
    start, end, text``, one row each."""
    grouped = edits.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("start", "end", "text"))).alias("edits"))
    return rows.join(grouped, id_col, "left")


def edited_counts(rows: DataFrame, folder: str | None = None, vocab: str = "byte_bpe_50k.json",
                  text_col: str = "text", edits_col: str = "edits") -> DataFrame:
    """``rows`` (with trees and an ``EDITS`` column) with ``COUNTS`` and the
    updated ``tree_tokens``; texts and edits are dropped."""
    file = vocabulary(vocab, folder)
    results = [c.split()[0] for c in COUNTS.split(", ")]
    kept = [c for c in rows.columns if c not in (text_col, edits_col, "tree_chars", "tree_tokens", *results)]
    ordered = rows.select(*kept, text_col, edits_col, "tree_chars", "tree_tokens")

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder.load(file, "byte")
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(len(kept) + k).to_pylist() for k in range(4)]
            for text, edits, chars, tokens in zip(*columns):
                chars, tokens = np.array(chars, np.int64), np.array(tokens, np.int64)
                before = int(tokens[1])
                n = apply(enc, text, chars, tokens, edits or [])
                used = int(np.count_nonzero(chars[len(chars) // 2:])) or 1
                out.append((before, len(edits or []), int(tokens[1]), used, n, tokens.tolist()))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(kept)], *(pa.array(c, t) for c, t in zip(zip(*out), types))],
                    names=[*kept, *results, "tree_tokens"])

    schema = ", ".join([_ddl(rows.select(*kept)), COUNTS, "tree_tokens array<long>"] if kept
                       else [COUNTS, "tree_tokens array<long>"])
    return ordered.mapInArrow(update, schema)
