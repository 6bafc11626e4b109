"""Operator 8: benchmark decontamination by the q-gram lemma.

An item of m bytes that stands in a document with at most e edits shares at
least ``m - q + 1 - q*e`` q-grams with it, on diagonals at most e apart.  So:

1. every q-gram of a document is looked up in an index of all items' q-grams;
2. hits are counted per document, item and diagonal band; bands are two
   budgets wide and overlap by one, so one of them holds all of an occurrence;
3. bands that reach the bound are verified by banded alignment (free ends in
   the document), for many bands at once.

A document may hold a part of an item.  So an item of more than ``PASSAGE``
bytes is searched whole and also as passages of that length, one every
``STRIDE`` bytes and one at its end, each with a budget of its own.  An item is
reported if it, or a passage of it, stands in the document: a run of
``PASSAGE + STRIDE`` bytes that was left unchanged is always found.

Texts are compared in lower case with runs of white space as one blank, as
UTF-8 bytes.  The budget is ``rate`` of the item's bytes.  Items shorter than
``q`` bytes are too short to be evidence and are not searched.

The index of at most ``BLOCK_BYTES`` of items and passages is sent to the tasks; a larger
benchmark is searched block by block.  Documents are never shuffled.

Edge cases: null and empty texts and items match nothing; repeated rows match
each; null document ids stay null, null item ids are reported as null; extra
columns are ignored by ``matches`` and kept by ``clean_documents``.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Prefix, slices

Q, RATE = 12, 0.05
PASSAGE, STRIDE = 200, 50
BLOCK_BYTES = 8 << 20

MATCHES = "doc_id long, item_id long, distance int, start int, end int, item_start int, item_end int"


def plain(text: str | Column) -> Column:
    """The form in which texts are compared."""
    c = F.col(text) if isinstance(text, str) else text
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\s+", " "))


def cuts(size: int, passage: int = PASSAGE, stride: int = STRIDE) -> list[tuple[int, int]]:
    """Where an item of ``size`` bytes is searched: all of it, then its
    passages."""
    if size <= passage:
        return [(0, size)]
    return [(0, size)] + [(i, i + passage) for i in (*range(0, size - passage, stride), size - passage)]


class Index:
    """All q-grams of a block of items, which are also cut into passages:
    ``items`` holds both, ``of`` the item and ``part`` the place of each."""

    def __init__(self, items: list[bytes], q: int, rate: float, passage: int = PASSAGE, stride: int = STRIDE):
        self.q = q
        self.of, self.part, self.items = [], [], []
        for i, t in enumerate(items):
            body = np.frombuffer(t, np.uint8)
            for a, b in cuts(len(t), max(passage, q), stride):
                self.of.append(i)
                self.part.append((a, b))
                self.items.append(body[a:b])
        items = self.items
        self.size = np.array([len(t) for t in items], np.int64)
        self.edits = np.floor(rate * self.size).astype(np.int64)
        #: A short item's budget shrinks until its bound is one q-gram at least.
        self.edits = np.minimum(self.edits, np.maximum(0, (self.size - q) // q))
        self.bound = self.size - q + 1 - q * self.edits
        grams = [Prefix.of_bytes(t).all(q) for t in items]
        key = np.concatenate(grams)
        item = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        at = np.concatenate([np.arange(len(g)) for g in grams])
        order = np.argsort(key, kind="stable")
        self.item, self.at = item[order], at[order]
        self.keys, self.begin, self.count = np.unique(key[order], return_index=True, return_counts=True)
        bits = min(26, max(16, (8 * len(self.keys)).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[self.keys >> self.shift] = True

    def hits(self, off: np.ndarray, body: np.ndarray) -> tuple[np.ndarray, ...]:
        """``(document, diagonal, item)`` of every shared q-gram."""
        grams = Prefix.of_bytes(body).all(self.q)
        pos = np.flatnonzero(self.maybe[grams >> self.shift])
        key = grams[pos]
        slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        doc = np.searchsorted(off, pos, "right") - 1
        ok = (self.keys[slot] == key) & (pos + self.q <= off[doc + 1])
        pos, slot, doc = pos[ok], slot[ok], doc[ok]
        n = self.count[slot]
        entry = np.repeat(self.begin[slot], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        doc, pos = np.repeat(doc, n), np.repeat(pos - off[doc], n)
        return doc, pos - self.at[entry], self.item[entry]

    def candidates(self, off: np.ndarray, body: np.ndarray) -> tuple[np.ndarray, ...]:
        """``(document, item, first diagonal of the band)`` that reach the bound."""
        doc, diagonal, item = self.hits(off, body)
        pair = doc * len(self.items) + item
        _, back, total = np.unique(pair, return_inverse=True, return_counts=True)
        some = total[back] >= self.bound[item]
        doc, diagonal, item = doc[some], diagonal[some], item[some]
        step = self.edits[item] + 1
        band = diagonal // step
        doc, item, step = (np.concatenate([x, x]) for x in (doc, item, step))
        band = np.concatenate([band, band - 1])
        rows, n = np.unique(np.stack([doc, item, band], 1), axis=0, return_counts=True)
        rows = rows[n >= self.bound[rows[:, 1]]]
        doc, item, band = rows.T
        return doc, item, band * (self.edits[item] + 1)

    def search(self, off: np.ndarray, body: np.ndarray) -> list[tuple[int, ...]]:
        """``(document, item, distance, start, end, item start, item end)``:
        the best verified occurrence of each item in each document, or else
        of a passage of it."""
        if len(body) < self.q or not len(self.keys):
            return []
        doc, item, low = self.candidates(off, body)
        best: dict[tuple[int, int], tuple[int, ...]] = {}
        order = np.argsort(self.size[item], kind="stable")
        for i in range(0, len(order), 64):
            some = order[i:i + 64]
            for d, t, found in zip(doc[some], item[some], self.align(off, body, doc[some], item[some], low[some])):
                if found[0] <= self.edits[t]:
                    key, (a, b) = (int(d), self.of[t]), self.part[t]
                    found = (a - b, *found, a, b)  # the longest part first: the whole item
                    best[key] = min(best.get(key, found), found)
        return [(*k, *v[1:]) for k, v in sorted(best.items())]

    def align(self, off, body, doc, item, low) -> list[tuple[int, int, int]]:
        """Banded alignment of items against their bands, row by row: least
        edits, and where the occurrence starts and ends."""
        edits = int(self.edits[item].max())
        width = 2 * (edits + 1) + 2 * edits + 1
        low = low - self.edits[item]
        size = self.size[item]
        rows = int(size.max())
        text = np.full((len(item), rows), -1, np.int16)
        for k, t in enumerate(item):
            text[k, :size[k]] = self.items[t]
        # The document's bytes under the band; -1 outside it equals nothing.
        at = low[:, None] + np.arange(rows + width)
        length = (off[doc + 1] - off[doc])[:, None]
        inside = (at >= 0) & (at < length)
        under = np.where(inside, body[np.clip(at + off[doc][:, None], 0, len(body) - 1)].astype(np.int16), -2)
        # Edits in the upper bits, the diagonal it started on in the lower.
        one = 1 << 20
        k = np.arange(width) * one
        cost = np.broadcast_to(np.arange(width), (len(item), width)).astype(np.int64)
        out: list[tuple[int, int, int]] = [(1 << 30, 0, 0)] * len(item)
        for row in range(rows + 1):
            for c in np.flatnonzero(size == row):
                j = int(np.argmin(cost[c]))
                distance, start = divmod(int(cost[c, j]), one)
                n = int(length[c, 0])
                out[c] = (distance, min(max(int(low[c]) + start, 0), n), min(max(int(low[c]) + row + j, 0), n))
            if row < rows:
                step = cost + one * (text[:, row:row + 1] != under[:, row:row + width])
                step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + one)
                cost = np.minimum.accumulate(step - k, axis=1) + k
        return out


_built: dict[str, Index] = {}


def _index_of(token: str, items: list[bytes], q: int, rate: float) -> Index:
    """One index per worker, of the block at hand."""
    if token not in _built:
        _built.clear()
        _built[token] = Index(items, q, rate)
    return _built[token]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, q: int) -> Iterator[tuple[list, list[bytes]]]:
    """Items in blocks of about ``BLOCK_BYTES``, passages counted, one at a
    time on the driver."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), plain(text_col).alias("text")) \
        .filter(F.octet_length("text") >= q).distinct()
    long = F.octet_length("text")
    searched = F.when(long > PASSAGE, long + ((long - PASSAGE) / STRIDE + 1) * PASSAGE).otherwise(long)
    size = math.ceil(items.agg(F.sum(searched)).first()[0] or 0)
    n = -(-size // BLOCK_BYTES)
    number = F.pmod(F.xxhash64("item", "text"), F.lit(max(n, 1)))
    for b in range(n):
        rows = items.filter(number == b).collect()
        if rows:
            yield [r.item for r in rows], [r.text.encode() for r in rows]


def matches(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE, id_col: str = "doc_id",
            text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and item found in it, whole or in part
    (``MATCHES``; positions are bytes of the compared form, ``distance`` is
    that of the part ``item_start`` to ``item_end``)."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("_d"), plain(text_col).alias("_text"))
    out = None
    for ids, items in _blocks(benchmark, item_col, item_text, q):
        sent, token = spark.sparkContext.broadcast((ids, items)), uuid.uuid4().hex

        def find(batches: Iterator[pa.RecordBatch], sent=sent, token=token) -> Iterator[pa.RecordBatch]:
            item_ids, texts_ = sent.value
            index = _index_of(token, texts_, q, rate)
            for batch in batches:
                doc_ids = batch.column(0).to_pylist()
                rows = [(doc_ids[i + d], item_ids[t], *found) for i, _, off, body in slices(batch, "_text")
                        for d, t, *found in index.search(off, body)]
                if rows:
                    types = (pa.int64(), pa.int64(), *[pa.int32()] * 5)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                     names=[c.split()[0] for c in MATCHES.split(", ")])

        found = texts.mapInArrow(find, MATCHES)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], MATCHES)


def clean_documents(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE,
                    text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents that hold no item and no passage of one, all columns as they were.  The
    decision is each document's own, so rows only pass or not."""
    spark = docs.sparkSession
    out = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(docs.columns)])
    at = out.columns[docs.columns.index(text_col)]
    kept = out.columns
    out = out.withColumn("_plain", plain(at))
    schema = out.schema
    for _, items in _blocks(benchmark, item_col, item_text, q):
        sent, token = spark.sparkContext.broadcast(items), uuid.uuid4().hex

        def drop(batches: Iterator[pa.RecordBatch], sent=sent, token=token) -> Iterator[pa.RecordBatch]:
            index = _index_of(token, sent.value, q, rate)
            for batch in batches:
                stays = np.ones(batch.num_rows, bool)
                for i, _, off, body in slices(batch, "_plain"):
                    stays[[i + m[0] for m in index.search(off, body)]] = False
                yield batch.filter(pa.array(stays))

        out = out.mapInArrow(drop, schema)
    return out.select(*[F.col(k).alias(c) for k, c in zip(kept, docs.columns)])
