"""Helpers shared by the training-data operators.

Rows are addressed inside an operator by ``(_d, _u)``: the document id (null
ids become the smallest long, so they join and sort first) and a 64-bit hash
of the text.  Repeated rows (same id, same text) therefore share an address
and always get the same decision; rows that share an id but not a text are
kept apart.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

NULL_ID = -(2 ** 63)
#: Bytes of text that one numpy pass works on (a longer document is one pass).
CHUNK_BYTES = 1 << 19


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers hold at once, and send this
    package to workers that do not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        _shipped.add(sc.applicationId)
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="tidemark-code-")) / "tidemark.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(archive))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_d, _u, _text`` of every row (null text: empty)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("_d"),
                       F.xxhash64(text).alias("_u"), text.alias("_text"))


def real_id(c: str | Column = "_d") -> Column:
    """The document id behind ``_d``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c != F.lit(NULL_ID), c)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: cuts the lineage,
    survives lost executors, and is computed once."""
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------------- bytes
def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an Arrow text column without nulls."""
    arr = arr.cast(pa.large_string()) if not pa.types.is_large_string(arr.type) else arr
    _, off, data = arr.buffers()
    off = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return off - off[0], body[off[0]:off[-1]] if len(off) else body[:0]


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, offsets, bytes)``: runs of whole documents of
    about ``limit`` bytes."""
    off, body = utf8(batch.column(batch.schema.get_field_index(column)))
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, off[i:j + 1] - off[i], body[off[i]:off[j]]
        i = j


# ------------------------------------------------------------------ hashes
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2 ** 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mix_in_place(x: np.ndarray, spare: np.ndarray) -> None:
    """``mix`` over ``x`` itself; ``spare`` is an array of its shape."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, None)):
        np.right_shift(x, np.uint64(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        if factor:
            np.multiply(x, np.uint64(factor), out=x)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64, for i below ``n``."""
    if len(_powers["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for k, b in (("up", _BASE), ("down", pow(_BASE, -1, 2 ** 64))):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


class Prefix:
    """Prefix polynomial hashes of a sequence: any substring in O(1)."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    @classmethod
    def of_bytes(cls, body: np.ndarray) -> Prefix:
        return cls(_TABLE[body])

    def hash(self, start, end) -> np.ndarray:
        """Mixed hash of ``[start, end)``; equal content, equal hash."""
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, width: int) -> np.ndarray:
        """The hash of each ``width`` consecutive values."""
        n = max(0, len(self.sums) - width)
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n])


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def words(off: np.ndarray, body: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of all
    documents, and the index of each document's first word (and the total)."""
    ink = ~_SPACE[body]
    before = np.empty_like(ink)
    before[:1], before[1:] = False, ink[:-1]
    edge = np.zeros(len(body) + 1, bool)
    edge[off] = True  # a word ends where its document does
    start = np.flatnonzero(ink & (~before | edge[:-1]))
    end = np.flatnonzero(ink & (np.append(~ink[1:], True) | edge[1:])) + 1
    return start, end, np.searchsorted(start, off)


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` consecutive values."""
    n = len(a) - w + 1
    if n <= 0:
        return a[:0]
    pad = -len(a) % w
    blocks = np.concatenate([a, np.full(pad, a.max(), a.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


def anchors(gram: np.ndarray, w: int, first: np.ndarray, span: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimizers.  ``gram`` holds the hash of the k-gram at each position,
    windows are ``span = w + k - 1`` positions long and lie inside a document
    (``first``: document starts and the total).  Each window picks its
    smallest k-gram, the leftmost on ties, so equal windows pick the same one
    wherever they stand.  Windows that stand in a row and share their pick
    form a segment: returns ``(document, first window, last window, pick)``
    of each.
    """
    none = np.zeros(0, np.int64)
    if len(gram) < w:
        return none, none, none, none
    bits = np.uint64(max(1, len(gram).bit_length()))
    order = (gram >> bits << bits) | np.arange(len(gram), dtype=np.uint64)
    low = sliding_min(order, w)
    pick = (low & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    n = len(pick)
    valid = np.zeros(n + 1, np.int32)
    size = np.diff(first)
    has = size >= span
    np.add.at(valid, first[:-1][has], 1)
    stop = first[1:][has] - span + 1
    np.add.at(valid, stop[stop <= n], -1)
    ok = np.cumsum(valid[:n]) > 0
    change = np.empty(n, bool)
    change[0] = True
    change[1:] = (pick[1:] != pick[:-1]) | (ok[1:] & ~ok[:-1])
    starts_doc = first[:-1][has]
    change[starts_doc[starts_doc < n]] = True
    begin = np.flatnonzero(ok & change)
    cut = np.flatnonzero(change | ~ok)
    nxt = np.searchsorted(cut, begin, "right")
    end = np.where(nxt < len(cut), cut[np.minimum(nxt, len(cut) - 1)], n) - 1
    return np.searchsorted(first, begin, "right") - 1, begin, end, pick[begin]
