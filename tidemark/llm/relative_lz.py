"""Operator 4: substring removal by relative Lempel-Ziv parsing over words.

The reference is the corpus itself, indexed by windows of 20 words: each
window refers to its earliest occurrence (smallest document id, then start).
A document is parsed greedily into factors, the longest runs of windows that
follow one reference along; every factor is 20 words or more.  Since each
window has its own reference, windows across two factors are checked like all
others.  A word goes if a factor covers it.

1. Every window picks its smallest 8-word gram; equal windows pick the same
   (about one pick per 7 words).  A gram picked once in the corpus holds no
   repeat, so only grams picked twice are followed up.  Picks are counted per
   slice of documents first, so a passage of a third of all documents sends
   one entry per slice.
2. The windows of the marked picks are indexed by gram and window hash (128
   bits together).  Again each slice sends the first of equal windows only.
   Grams of a large share of all documents are spread by window hash.
3. Each document gets its windows' references back and is parsed.

Slices meet in buckets as packed arrays: one row per slice and bucket.  A slice
is named by its task and place, so the input should be read in a fixed order:
from files, or from a written table (``common.written``) after a shuffle.

Edge cases: a null or empty text has no words; a document of fewer than 20
words loses none; rows that share an id are one document to the word "earlier"
(no row of them is removed for another row's sake at the same place);
null ids come first and stay null; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, Prefix, anchors, keyed, mix, real_id, slices, words, written

WINDOW, GRAM = 20, 8
#: A gram is spread when this share of the documents (and 200) picks it; at
#: most (grams a document) / share such grams exist.
HOT_SHARE, HOT_LEAST = 0.0005, 200

PACKED = "bucket int, chunk long, kind int, payload binary"
FLAGS = "_d long, _u long, start int, n int, ref_d long, ref_start int"
ENTRIES, DIRECTORY, HOT = 0, 1, 2


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(a) for a in arrays], "<i8").tobytes()
    return head + b"".join(a.tobytes() for a in arrays)


def _unpack(payload: bytes, *types: str) -> list[np.ndarray]:
    sizes = np.frombuffer(payload, "<i8", len(types))
    out, at = [], 8 * len(types)
    for n, t in zip(sizes.tolist(), types):
        out.append(np.frombuffer(payload, t, n, at))
        at += out[-1].nbytes
    return out


def _joined(parts: list[list[np.ndarray]], *types: str) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, t) for t in types]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int32(), pa.binary()))],
        names=["bucket", "chunk", "kind", "payload"])


def _by_bucket(bucket: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
    for i, j in zip(cut, [*cut[1:], len(bucket)]):
        yield int(bucket[i]), [a[order[i:j]] for a in arrays]


class Slice:
    """Word hashes and picks of some whole documents."""

    def __init__(self, off: np.ndarray, body: np.ndarray, window: int, gram: int):
        start, end, self.first = words(off, body)
        self.hashes = Prefix(Prefix.of_bytes(body).hash(start, end))
        grams = self.hashes.all(gram)
        self.doc, self.a, self.b, pick = anchors(grams, window - gram + 1, self.first, window)
        self.key = grams[pick]
        #: Index of each document's first pick, and the total.
        self.picks = np.searchsorted(self.doc, np.arange(len(off)))


# ------------------------------------------------------------ 1. shared grams
def _mark(buckets: int, window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, hashes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for i, j, off, body in slices(batch, "_text"):
                s = Slice(off, body, window, gram)
                if not len(s.key):
                    continue
                uniq, at, back, count = np.unique(s.key, return_index=True, return_inverse=True, return_counts=True)
                at = np.where(count == 1, at, -1).astype(np.int32)
                rows = [(b, chunk, ENTRIES, _pack(*arrays)) for b, arrays in _by_bucket(
                    (uniq % np.uint64(buckets)).astype(np.int32), uniq, at, count.astype(np.uint32))]
                here = np.flatnonzero(count[back] > 1).astype(np.int32)
                rows.append((chunk % buckets, chunk, DIRECTORY,
                             _pack(ids[i:j], hashes[i:j], s.picks.astype(np.int32), here)))
                yield _rows(rows)
                chunk += 1
    return run


def _shared(hot_least: int):
    """Per bucket: which entries of each slice stand in another slice too."""
    def run(t: pa.Table) -> pa.Table:
        rows = t.to_pylist()
        out = [(0, r["chunk"], DIRECTORY, r["payload"]) for r in rows if r["kind"] == DIRECTORY]
        entries = [r for r in rows if r["kind"] == ENTRIES]
        parts = [_unpack(r["payload"], "<u8", "<i4", "<u4") for r in entries]
        key, at, count = _joined(parts, "<u8", "<i4", "<u4")
        if len(key):
            uniq, back, slices_ = np.unique(key, return_inverse=True, return_counts=True)
            told = (slices_[back] > 1) & (at >= 0)
            edge = np.cumsum([0] + [len(p[0]) for p in parts])
            for k, r in enumerate(entries):
                mine = at[edge[k]:edge[k + 1]][told[edge[k]:edge[k + 1]]]
                if len(mine):
                    out.append((0, r["chunk"], ENTRIES, _pack(mine)))
            total = np.bincount(back, weights=count)
            if (total >= hot_least).any():
                out.append((0, -1, HOT, _pack(uniq[total >= hot_least])))
        return pa.Table.from_batches([_rows(out)])
    return run


def _per_document(t: pa.Table) -> pa.Table:
    """Per slice: its documents' marked picks, as numbers within the document."""
    rows = t.to_pylist()
    d, u, picks, here = _unpack(next(r["payload"] for r in rows if r["kind"] == DIRECTORY), "<i8", "<i8", "<i4", "<i4")
    marked = np.sort(np.concatenate([here] + [_unpack(r["payload"], "<i4")[0] for r in rows if r["kind"] == ENTRIES]))
    edge = np.searchsorted(marked, picks)
    has = np.flatnonzero(np.diff(edge))
    return pa.Table.from_arrays(
        [pa.array(d[has]), pa.array(u[has]),
         pa.array([(marked[edge[k]:edge[k + 1]] - picks[k]).astype("<i4").tobytes() for k in has], pa.binary())],
        names=["_d", "_u", "marks"])


# ----------------------------------------------------------- 2. earliest windows
def _earliest(key, hashes, d, pos) -> np.ndarray:
    """For each window the number of its earliest equal one (itself, if none
    is earlier; an equal place is not earlier)."""
    order = np.lexsort((pos, d, hashes, key))
    k, h = key[order], hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (h[1:] != h[:-1])
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    out = np.empty(len(order), np.int64)
    out[order] = head
    same = (d[out] == d) & (pos[out] == pos)
    out[same] = np.flatnonzero(same)
    return out


def _runs(d, u, pos, ref, moved) -> list[np.ndarray]:
    """Moved windows as runs along one reference: the columns of FLAGS."""
    i = np.flatnonzero(moved)
    rd, rp = d[ref[i]], pos[ref[i]]
    d, u, pos = d[i], u[i], pos[i]
    new = np.ones(len(i), bool)
    new[1:] = ((np.diff(i) != 1) | (np.diff(d) != 0) | (np.diff(u) != 0) | (np.diff(pos) != 1)
               | (np.diff(rd) != 0) | (np.diff(rp) != 1))
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(i)))
    return [d[at], u[at], pos[at].astype(np.int32), n.astype(np.int32), rd[at], rp[at].astype(np.int32)]


def _ramp(count: np.ndarray) -> np.ndarray:
    return np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)


def _index(buckets: int, window: int, gram: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for batch in batches:
            ids, texts = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            marks = batch.column(3)
            for i, j, off, body in slices(batch, "_text"):
                s = Slice(off, body, window, gram)
                own = [np.frombuffer(m, "<i4") for m in marks.slice(i, j - i).to_pylist()]
                m = np.concatenate([o + p for o, p in zip(own, s.picks)])
                count = s.b[m] - s.a[m] + 1
                word = np.repeat(s.a[m], count) + _ramp(count)
                hashes = s.hashes.hash(word, word + window)
                entry = np.repeat(np.arange(len(m)), count)
                doc = s.doc[m][entry]
                d, u, key = ids[i + doc], texts[i + doc], s.key[m][entry]
                pos = word - s.first[doc]
                ref = _earliest(key, hashes, d, pos)
                moved = ref != np.arange(len(ref))
                rows = []
                flags = _runs(d, u, pos, ref, moved)
                if len(flags[0]):
                    rows.append((part % buckets, 0, DIRECTORY, _pack(*flags)))
                is_hot = np.isin(key, hot)
                # Whole entries that hold a first window; single windows of hot grams.
                keep = np.zeros(len(m), bool)
                keep[entry[~moved & ~is_hot]] = True
                whole = np.flatnonzero(keep[entry] & ~is_hot)
                lone = np.flatnonzero(~moved & is_hot)
                head = np.concatenate([np.flatnonzero(keep), entry[lone]])
                sizes = np.concatenate([count[keep], np.ones(len(lone), np.int64)])
                at = np.concatenate([(np.cumsum(count) - count)[keep], lone])
                ekey = s.key[m][head]
                spread = np.where(np.arange(len(head)) < int(keep.sum()), ekey, mix(ekey ^ hashes[at]))
                bucket = (spread % np.uint64(buckets)).astype(np.int32)
                flat = np.concatenate([whole, lone])
                begin = np.cumsum(sizes) - sizes
                for b, (e,) in _by_bucket(bucket, np.arange(len(head))):
                    c = sizes[e]
                    w = flat[np.repeat(begin[e], c) + _ramp(c)]
                    rows.append((b, 0, ENTRIES, _pack(ekey[e], d[at[e]], u[at[e]], pos[at[e]].astype(np.int32),
                                                      c.astype(np.int32), hashes[w])))
                if rows:
                    yield _rows(rows)
    return run


def _resolve(t: pa.Table) -> pa.Table:
    types = ("<i8", "<i8", "<i4", "<i4", "<i8", "<i4")
    out = [_unpack(r, *types) for r, k in zip(t["payload"].to_pylist(), t["kind"].to_pylist()) if k == DIRECTORY]
    parts = [_unpack(r, "<u8", "<i8", "<i8", "<i4", "<i4", "<u8")
             for r, k in zip(t["payload"].to_pylist(), t["kind"].to_pylist()) if k == ENTRIES]
    if parts:
        key, d, u, first, count, hashes = _joined(parts)
        _, back, often = np.unique(key, return_inverse=True, return_counts=True)
        entry = np.repeat(np.arange(len(key)), count)
        some = often[back][entry] > 1
        pos = (np.repeat(first, count) + _ramp(count))[some]
        entry, hashes = entry[some], hashes[some]
        ref = _earliest(key[entry], hashes, d[entry], pos)
        out.append(_runs(d[entry], u[entry], pos, ref, ref != np.arange(len(ref))))
    return pa.Table.from_arrays([pa.array(c) for c in _joined(out, *types)],
                                names=[c.split()[0] for c in FLAGS.split(", ")])


def references(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Windows that start earlier elsewhere, as runs along their references
    (``FLAGS``: ``n`` window starts from ``start`` on)."""
    spark = texts.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot_least = max(HOT_LEAST, int(HOT_SHARE * texts.count()))
    replies = written(texts.mapInArrow(_mark(buckets, window, gram), PACKED)
                      .groupBy("bucket").applyInArrow(_shared(hot_least), PACKED), "shared-grams")
    hot = [_unpack(r.payload, "<u8")[0] for r in replies.filter(f"kind = {HOT}").select("payload").collect()]
    hot = np.unique(np.concatenate(hot)) if hot else np.zeros(0, np.uint64)
    marks = replies.filter(f"kind <> {HOT}").groupBy("chunk").applyInArrow(
        _per_document, "_d long, _u long, marks binary").groupBy("_d", "_u").agg(F.max("marks").alias("marks"))
    return texts.join(marks, ["_d", "_u"]).select("_d", "_u", "_text", "marks") \
        .mapInArrow(_index(buckets, window, gram, hot), PACKED) \
        .groupBy("bucket").applyInArrow(_resolve, FLAGS)


# ------------------------------------------------------------------- 3. parse
def parse(runs: list[dict], window: int = WINDOW) -> list[dict]:
    """The greedy factors of one document: runs that go on along the same
    reference are one factor.  ``n_words`` words from ``start`` equal those
    of ``ref_doc`` from ``ref_start``."""
    out: list[dict] = []
    for r in sorted(runs, key=lambda r: (r["start"], -r["n"])):
        r = dict(r)
        last = out[-1] if out else None
        if last:  # a window may be told twice, by its slice and by its bucket
            told = max(0, last["start"] + last["n"] - r["start"])
            r = r | {"start": r["start"] + told, "n": r["n"] - told, "ref_start": r["ref_start"] + told}
        if r["n"] <= 0:
            continue
        if last and last["start"] + last["n"] == r["start"] and last["ref_d"] == r["ref_d"] \
                and last["ref_start"] + last["n"] == r["ref_start"]:
            last["n"] += r["n"]
        else:
            out.append(r)
    return [{"start": r["start"], "n_words": r["n"] + window - 1,
             "ref_doc": None if r["ref_d"] == NULL_ID else r["ref_d"], "ref_start": r["ref_start"]} for r in out]


FACTORS = "array<struct<start: int, n_words: int, ref_doc: long, ref_start: int>>"
OUT = pa.schema([("_d", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                 ("factors", pa.list_(pa.struct([("start", pa.int32()), ("n_words", pa.int32()),
                                                 ("ref_doc", pa.int64()), ("ref_start", pa.int32())])))])


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: word counts, the SHA-256 of the kept words and
    the duplicate ``factors``."""
    texts = keyed(docs, id_col, text_col)
    runs = references(texts, window, gram).groupBy("_d", "_u").agg(
        F.collect_list(F.struct("start", "n", "ref_d", "ref_start")).alias("runs"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for d, text, found in zip(*(batch.column(i).to_pylist() for i in range(3))):
                all_words = text.encode().split()
                factors = parse(found or [], window)
                stays = np.ones(len(all_words), bool)
                for f in factors:
                    stays[f["start"]:f["start"] + f["n_words"]] = False
                kept = compress(all_words, stays) if factors else all_words
                rows.append({"_d": d, "n_words": len(all_words), "n_removed": int((~stays).sum()),
                             "kept_sha256": hashlib.sha256(b" ".join(kept)).hexdigest(), "factors": factors})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=OUT)

    joined = texts.join(runs, ["_d", "_u"], "left").select("_d", "_text", "runs")
    return joined.mapInArrow(finish, f"_d long, n_words long, n_removed long, kept_sha256 string, factors {FACTORS}") \
        .select(real_id().alias("doc_id"), "n_words", "n_removed", "kept_sha256", "factors")
