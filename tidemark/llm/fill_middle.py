"""Operator 13: fill-in-the-middle rearrangement, cut by SWAR rank and select.

A text is a row of *units* (``[A-Za-z]+|[^A-Za-z]`` over code points).  It is
cut at two units drawn from its id, and the three parts are put in the order
prefix-suffix-middle (psm) or suffix-prefix-middle (spm), each behind its
marker; a part of the texts stays plain.

1. The UTF-8 bytes of a run of documents are viewed as little-endian 64-bit
   words.  Word arithmetic on all eight bytes at once sets the high bit of
   each byte that ends a unit: the next byte starts a code point, and the two
   are not both ASCII letters.  A second mask marks bytes that start a code
   point.
2. ``bitwise_count`` per word and its running sum answer *rank* (marks before a
   byte); a binary search of the running sum finds the word of the r-th mark,
   and a multiplication that sums its marks byte by byte resolves the place
   inside the word (*select*).
3. The cuts are byte positions, so the parts are slices of the text.

``restored`` takes the parts out of an output again with string functions: a
text that holds a marker stays plain, and no marker can overlap another, so
the first marker found is always the one that was written.

Edge cases: a null text is empty; empty texts are plain with no units; a null
id draws from ``1:`` alone and stays null; repeated rows give repeated equal
rows; other columns of the input, whatever their names, are left out.  A text
is cut in one piece whatever its length (about twenty bytes of memory a byte).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_CASE = np.uint64(0x2020202020202020)
_FROM_A = _ONES * np.uint64(0x80 - ord("a"))
_PAST_Z = _ONES * np.uint64(0x80 - ord("z") - 1)
_TOP = np.uint64(56)


def _letters(w: np.ndarray) -> np.ndarray:
    """High bit of each byte that is an ASCII letter."""
    low = (w | _CASE) & _LOW7
    return (low + _FROM_A) & ~(low + _PAST_Z) & ~w & _HIGH


def _continues(w: np.ndarray) -> np.ndarray:
    """High bit of each byte inside a code point (``10xxxxxx``)."""
    return w & ~(w << np.uint64(1)) & _HIGH


def _below(n: np.ndarray) -> np.ndarray:
    """Mask of the first ``n`` (0 to 7) bytes of a word."""
    return (np.uint64(1) << (np.uint64(8) * n.astype(np.uint64))) - np.uint64(1)


class Marks:
    """Rank and select over one mark (a high bit) per byte."""

    def __init__(self, mask: np.ndarray):
        self.mask = mask
        self.before = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(np.bitwise_count(mask), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks before byte ``at``."""
        word = at >> 3
        held = np.append(self.mask, np.uint64(0))[word] & _below(at & 7)
        return self.before[word] + np.bitwise_count(held)

    def select(self, r: np.ndarray) -> np.ndarray:
        """The byte of the ``r``-th mark (from 1)."""
        word = np.searchsorted(self.before, r) - 1
        left = (r - self.before[word]).astype(np.uint64)
        upto = (self.mask[word] >> np.uint64(7)) * _ONES  # byte i: marks in bytes 0 to i
        fewer = ((left - np.uint64(1)) * _ONES + _HIGH - upto) & _HIGH
        return (word << 3) + np.bitwise_count(fewer)


def unit_marks(off: np.ndarray, body: np.ndarray) -> tuple[Marks, Marks]:
    """Marks on the last byte of each unit, and on the first byte of each code
    point, of documents that lie one behind the other."""
    size = len(body)
    padded = np.zeros(-(-size // 8) * 8 + 8, np.uint8)
    padded[:size] = body
    w = padded.view("<u8").astype(np.uint64, copy=False)
    w, after = w[:-1], (w[:-1] >> np.uint64(8)) | (w[1:] << _TOP)
    ends = ~_continues(after) & ~(_letters(w) & _letters(after)) & _HIGH
    starts = ~_continues(w) & _HIGH
    if size & 7:  # the padding holds no marks
        tail = _below(np.array([size & 7]))[0]
        ends[-1] &= tail
        starts[-1] &= tail
    last = off[1:][np.diff(off) > 0] - 1  # a document's last byte ends a unit
    np.bitwise_or.at(ends, last >> 3, np.uint64(0x80) << (np.uint64(8) * (last & 7).astype(np.uint64)))
    return Marks(ends), Marks(starts)


def _draws(ids: list) -> np.ndarray:
    """``h1`` to ``h4`` of each id."""
    out = np.empty((len(ids), 4), np.int64)
    for i, d in enumerate(ids):
        digest = hashlib.sha256(b"1:" if d is None else b"1:%d" % d).digest()
        out[i] = np.frombuffer(digest, ">u4", 4)
    return out


def _rearranged(batches: Iterator[pa.RecordBatch], plain_from: int, spm_below: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for i, j, off, body in slices(batch, "__text"):
            ends, starts = unit_marks(off, body)
            h = _draws(ids[i:j])
            before = ends.rank(off)
            n = np.diff(before)
            chars = starts.rank(off)
            cut = np.sort(np.stack([h[:, 0] % (n + 1), h[:, 1] % (n + 1)]), axis=0)
            at = []
            for c in cut:  # a cut after unit c lies behind that unit's last byte
                pos = off[:-1].copy()
                some = c > 0
                pos[some] = ends.select((before[:-1] + c)[some]) + 1
                at.append(pos)
            prefix_chars = starts.rank(at[0]) - chars[:-1]
            middle_chars = starts.rank(at[1]) - starts.rank(at[0])
            raw = body.tobytes()
            form, output = [], []
            for k in range(j - i):
                a, b, c, d = int(off[k]), int(at[0][k]), int(at[1][k]), int(off[k + 1])
                text = raw[a:d]
                if not text or h[k, 2] % 100 >= plain_from or any(m.encode() in text for m in (PREFIX, SUFFIX, MIDDLE)):
                    form.append("plain")
                    output.append(text.decode())
                    continue
                parts = raw[a:b].decode(), raw[b:c].decode(), raw[c:d].decode()
                if h[k, 3] % 100 < spm_below:
                    form.append("spm")
                    output.append(f"{SUFFIX}{parts[2]}{PREFIX}{parts[0]}{MIDDLE}{parts[1]}")
                else:
                    form.append("psm")
                    output.append(f"{PREFIX}{parts[0]}{SUFFIX}{parts[2]}{MIDDLE}{parts[1]}")
            plain = np.array([f == "plain" for f in form])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[i:j], pa.int64()), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 pa.array(output, pa.string()), pa.array(prefix_chars.astype(np.int64), pa.int64(), mask=plain),
                 pa.array(middle_chars.astype(np.int64), pa.int64(), mask=plain)],
                names=["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"])


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """``doc_id, n, form, output, prefix_chars, middle_chars`` of every row.

    ``plain_from``: draws (of 100) from which a text stays plain;
    ``spm_below``: draws below which a rearranged text is spm.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    return rows.mapInArrow(
        lambda it: _rearranged(it, plain_from, spm_below),
        "doc_id long, n long, form string, output string, prefix_chars long, middle_chars long")


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text behind an output and its form."""
    out, kind = (F.col(c) if isinstance(c, str) else c for c in (output, form))

    def split(text: Column, marker: str) -> tuple[Column, Column]:
        head = F.substring_index(text, marker, 1)
        return head, F.substr(text, F.length(head) + F.lit(len(marker) + 1))

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        one, rest = split(F.substr(out, F.lit(len(first) + 1)), second)
        two, three = split(rest, MIDDLE)
        return one, two, three

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    s_suffix, s_prefix, s_middle = parts(SUFFIX, PREFIX)
    return F.when(kind == "psm", F.concat(prefix, middle, suffix)) \
        .when(kind == "spm", F.concat(s_prefix, s_middle, s_suffix)).otherwise(out)


def digest(rows: DataFrame) -> DataFrame:
    """The outputs and the texts rebuilt from them, as hashes."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                       sha(restored()).alias("restored_sha256"))
