"""Operator 5: substring removal by a hash-compared suffix sort over UTF-8
bytes.

A byte goes if a ``length``-byte string that covers it also starts anywhere
else, in any document.

1. Every window of ``length`` bytes picks its smallest 128-byte gram (a
   minimizer).  Equal windows pick the same gram at the same place, so two
   occurrences of a window always meet under one gram.  Windows in a row that
   share a pick form a *segment*; about one segment starts per 137 bytes.
2. Segments are counted by gram and content.  A segment that stands twice is
   removed whole.  Contents are told apart by 128 bits of SHA-256, not by the
   polynomial hashes, so that a collision of those cannot remove a byte.
3. What is left are grams whose segments differ: the edges of repeats.  One
   segment per distinct content is compared.  Under each gram, the suffixes
   from the gram on are sorted, and so are the reversed prefixes before it.
   Two suffixes are compared by the binary search of their common extension
   on prefix polynomial hashes, in a merge sort that runs over many grams at
   once.  From the neighbours in both orders follow each segment's longest
   repeated window run; the bytes of each accepted pair are compared.
4. A gram of more than ``HOT_ROWS`` segments is not gathered.  Its segments'
   windows are dealt, by the gram's place in the window, into parts of
   ``length / 25``.  All windows of a part share their middle bytes (the
   *core*, 385 of 400), so equal windows meet under one core.  Cores that stand
   once are done with; a part that is the same wherever its core stands goes
   whole; the windows of all others are counted.  Parts and windows too are
   told apart by SHA-256.

Every step works on one slice of documents, at most ``HOT_ROWS`` contents of
one gram, or one document; whatever is counted is counted map-side first, and
rows meet their count by key and salt (``_repeated``), so that the rows of a
frequent gram, core or window are spread.

Edge cases: a null text is empty; a text shorter than ``length`` loses nothing;
repeated rows repeat each other's text and lose it; extra columns are ignored;
null ids stay null; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Prefix, anchors, keyed, real_id, slices, written

LENGTH, GRAM = 400, 128
#: Contexts compared at once, besides those of the last gram.
COMPARE_ROWS = 4_000
#: A gram of more segments than this is spread by the windows' cores.
HOT_ROWS = 4_000

#: Rows of one key are spread over this many parts where they meet its count.
SALTS = 32

SEGMENTS = "key long, seg long, rest long, _d long, _u long, a int, b int, p int"
CONTEXTS = "key long, hot boolean, single boolean, _d long, _u long, a int, p int, context binary"
PARTS = "key long, part int, core long, hull long, rest long, single boolean, _d long, _u long, p int, first int, last int"
WINDOWS = "key long, window long, rest long, single boolean, _d long, _u long, start int"


def segments(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``texts`` is ``_d, _u, _text``; ``[a, b]`` are window starts, ``p`` the
    gram's place, ``seg`` and ``rest`` the digest of the segment's bytes."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for i, _, off, body in slices(batch, "_text"):
                if len(body) < length:
                    continue
                prefix = Prefix.of_bytes(body)
                grams = prefix.all(gram)
                d, a, b, p = anchors(grams, length - gram + 1, off, length)
                if not len(d):
                    continue
                base = off[d]
                cols = [grams[p].view(np.int64), *_digests(body, a, b + length), ids[i + d], hashes[i + d],
                        *((x - base).astype(np.int32) for x in (a, b, p))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=_names(SEGMENTS))

    return texts.mapInArrow(find, SEGMENTS)


def _digests(body: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the SHA-256 of each ``body[start:end]``, as two longs."""
    view = memoryview(np.ascontiguousarray(body))
    found = b"".join([hashlib.sha256(view[i:j]).digest()[:16] for i, j in zip(start.tolist(), end.tolist())])
    halves = np.frombuffer(found, np.int64).reshape(-1, 2)
    return halves[:, 0], halves[:, 1]


def _repeated(rows: DataFrame, on: list[str], *more: Column) -> DataFrame:
    """The rows whose key ``on`` stands twice or more, with its count ``n``
    and ``more``.  Each key's count goes to the salts that its rows have, so
    no task gathers the rows of one key."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    counts = salted.groupBy(*on).agg(F.count(F.lit(1)).alias("n"), F.expr("bit_or(shiftleft(1L, salt))").alias("salts"),
                                     *more).filter("n > 1")
    spread = counts.withColumn("salt", F.expr(
        f"explode(filter(sequence(0, {SALTS - 1}), x -> shiftright(salts, x) % 2 = 1))")).drop("salts")
    return salted.join(spread, [*on, "salt"]).drop("salt")


def _alike(*columns: str) -> list[Column]:
    """Whether the columns are the same in all rows of a key."""
    return [F.expr(" and ".join(f"min({c}) = max({c})" for c in columns)).alias("alike")]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


class Extensions:
    """Common extensions of contexts around their grams, by hashes."""

    def __init__(self, contexts: list[bytes], place: np.ndarray):
        self.body = np.frombuffer(b"".join(contexts), np.uint8)
        size = np.array([len(c) for c in contexts], np.int64)
        end = np.cumsum(size)
        self.at = end - size + place
        self.ahead, self.behind = size - place, place
        self.prefix = Prefix.of_bytes(self.body)

    def right(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return self._search(x, y, np.minimum(self.ahead[x], self.ahead[y]), lambda q, n: (q, q + n))

    def left(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return self._search(x, y, np.minimum(self.behind[x], self.behind[y]), lambda q, n: (q - n, q))

    def _search(self, x, y, most, span) -> np.ndarray:
        low, high, h = np.zeros(len(x), np.int64), most.astype(np.int64), self.prefix.hash
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = h(*span(self.at[x], mid)) == h(*span(self.at[y], mid))
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def before(self, x: np.ndarray, y: np.ndarray, rightward: bool) -> np.ndarray:
        """Whether suffix ``x`` sorts before ``y`` (or, leftward, the reversed
        prefix); equal ones by number."""
        n = self.right(x, y) if rightward else self.left(x, y)
        room = self.ahead if rightward else self.behind
        ended_x, ended_y = n >= room[x], n >= room[y]
        step = n if rightward else -n - 1
        last = len(self.body) - 1
        bx, by = (self.body[np.clip(self.at[z] + step, 0, last)].astype(np.int64) for z in (x, y))
        bx, by = np.where(ended_x, -1, bx), np.where(ended_y, -1, by)
        return (bx < by) | ((bx == by) & (x < y))

    def sort(self, group: np.ndarray, rightward: bool) -> np.ndarray:
        """Merge sort inside each group (``group`` is non-decreasing)."""
        n = len(group)
        order = np.arange(n)
        first = np.searchsorted(group, group, "left")
        last = np.searchsorted(group, group, "right")
        run, widest = 1, int((last - first).max(initial=0))
        slot = np.arange(n)
        while run < widest:
            local = slot - first
            own = first + local // run * run
            even = (local // run) % 2 == 0
            low = np.minimum(np.where(even, own + run, own - run), last)
            high = np.minimum(low + run, last)
            start = low.copy()
            while (open_ := low < high).any():
                i = np.flatnonzero(open_)
                mid = (low[i] + high[i]) >> 1
                less = self.before(order[mid], order[i], rightward)
                low[i], high[i] = np.where(less, mid + 1, low[i]), np.where(less, high[i], mid)
            to = np.where(even, own, own - run) + (slot - own) + (low - start)
            merged = np.empty_like(order)
            merged[to] = order
            order, run = merged, run * 2
        return order

    def neighbours(self, order: np.ndarray, group: np.ndarray, rightward: bool) -> np.ndarray:
        """Common extension of each sorted slot with the slot before; -1 at a
        group's first."""
        out = np.full(len(order) + 1, -1, np.int64)
        if len(order) > 1:
            out[1:-1] = (self.right if rightward else self.left)(order[:-1], order[1:])
            out[1:-1][group[1:] != group[:-1]] = -1
        return out

    def best(self, want: np.ndarray, order: np.ndarray, near: np.ndarray, other: np.ndarray, length: int,
             rightward: bool) -> tuple[np.ndarray, np.ndarray]:
        """For each wanted context the longest extension, in this direction,
        of a partner with which both directions reach ``length``; walks away
        from it in sorted order, while ``other`` (the longest in the other
        direction) could still make up the rest.  -1: none."""
        slot = np.empty(len(order), np.int64)
        slot[order] = np.arange(len(order))
        found, partner = np.full(len(want), -1, np.int64), np.zeros(len(want), np.int64)
        for step in (-1, 1):
            i = np.arange(len(want))
            at, reach = slot[want], np.full(len(want), 1 << 40, np.int64)
            while len(i):
                reach = np.minimum(reach, near[at if step < 0 else at + 1])
                at = at + step
                keep = (reach >= 0) & (reach + other[want[i]] >= length) & (reach > found[i])
                i, at, reach = i[keep], at[keep], reach[keep]
                if not len(i):
                    break
                x, y = want[i], order[at]
                rest = (self.left if rightward else self.right)(x, y)
                hit = reach + rest >= length
                found[i[hit]], partner[i[hit]] = reach[hit], y[hit]
                i, at, reach = i[~hit], at[~hit], reach[~hit]
        return found, partner

    def same_bytes(self, x: int, y: int, left: int, right: int) -> bool:
        qx, qy = int(self.at[x]), int(self.at[y])
        return self.body[qx - left:qx + right].tobytes() == self.body[qy - left:qy + right].tobytes()


def repeated_parts(group: np.ndarray, contexts: list[bytes], place: np.ndarray, single: np.ndarray,
                   length: int = LENGTH) -> list[tuple[int, int, int]]:
    """``(context, bytes before its gram, bytes from it on)`` of the union of
    each single context's windows that another context of its group holds."""
    e = Extensions(contexts, place)
    by_right, by_left = e.sort(group, True), e.sort(group, False)
    near_r, near_l = e.neighbours(by_right, group, True), e.neighbours(by_left, group, False)
    most_r, most_l = np.empty(len(group), np.int64), np.empty(len(group), np.int64)
    most_r[by_right] = np.maximum(near_r[:-1], near_r[1:])
    most_l[by_left] = np.maximum(near_l[:-1], near_l[1:])
    want = np.flatnonzero(single & (most_l + most_r >= length))
    left, to_l = e.best(want, by_left, near_l, most_r, length, False)
    right, to_r = e.best(want, by_right, near_r, most_l, length, True)
    out = []
    for k in np.flatnonzero(left >= 0):
        x = int(want[k])
        # Collision check: the partners' bytes must agree, not their hashes.
        if e.same_bytes(x, int(to_l[k]), int(left[k]), length - int(left[k])) and \
                e.same_bytes(x, int(to_r[k]), length - int(right[k]) if right[k] < length else 0, int(right[k])):
            out.append((x, int(left[k]), int(right[k])))
        else:
            out += [(x, *pair) for pair in _plainly(e, group, x, length)]
    return out


def _plainly(e: Extensions, group: np.ndarray, x: int, length: int) -> list[tuple[int, int]]:
    """The same by comparing bytes, for the contexts that a collision hit."""
    def common(a: np.ndarray, b: np.ndarray) -> int:
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        return int(differ[0]) if len(differ) else n

    out = []
    for y in np.flatnonzero(group == group[x]).tolist():
        if y != x:
            qx, qy = int(e.at[x]), int(e.at[y])
            r = common(e.body[qx:qx + e.ahead[x]], e.body[qy:qy + e.ahead[y]])
            n = common(e.body[qx - e.behind[x]:qx][::-1], e.body[qy - e.behind[y]:qy][::-1])
            if n + r >= length:
                out.append((n, r))
    return out


def duplicate_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``_d, _u, start, end`` byte spans to remove (they may overlap)."""
    rows = written(segments(texts, length, gram), "segments")
    shared = written(_repeated(rows, ["key"], *_alike("seg", "rest")).withColumn("hot", F.col("n") > HOT_ROWS).drop("n"),
                     "shared-segments")
    span = [F.col("_d"), F.col("_u"), F.col("a").alias("start"), (F.col("b") + length).alias("end")]
    mixed = shared.filter("not alike")
    content = ["key", "seg", "rest"]
    contents = mixed.groupBy(*content, "hot").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("_d", "_u", "a", "b", "p")).alias("one"))
    whole = shared.filter("alike").select(*span).unionByName(
        _repeated(mixed, content).select(*span))
    # One occurrence of each content, with its bytes.
    places = contents.select("one.*", "key", "hot", (F.col("n") == 1).alias("single")).groupBy("_d", "_u").agg(
        F.collect_list(F.struct("key", "hot", "single", "a", "b", "p")).alias("places"))
    contexts = written(texts.join(places, ["_d", "_u"]).mapInArrow(_contexts(length), CONTEXTS), "contexts")
    edges = contexts.filter("not hot").drop("hot").repartition("key").sortWithinPartitions("key").mapInArrow(
        _edges(length), "_d long, _u long, start int, end int")
    return whole.unionByName(edges).unionByName(_hot_spans(contexts.filter("hot"), length))


def _hot_spans(contexts: DataFrame, length: int) -> DataFrame:
    """Spans of the single contexts' windows that another context holds, by
    counting: first the cores of parts, then the windows of parts that differ
    around a shared core.  Cores meet by hash; hulls and windows are told
    apart by SHA-256."""
    parts = written(contexts.mapInArrow(_parts(length), PARTS), "hot-parts")
    met = written(_repeated(parts, ["key", "part", "core"], *_alike("hull", "rest"))
                  .select("_d", "_u", "p", "single", "first", "last", "alike"), "hot-parts-met")
    whole = met.filter("alike and single").select(
        "_d", "_u", F.col("first").alias("start"), (F.col("last") + length).alias("end"))
    differ = met.filter("not alike").groupBy("_d", "_u", "p").agg(
        F.collect_list(F.struct("first", "last")).alias("parts"))
    windows = written(contexts.join(differ, ["_d", "_u", "p"]).select(
        "key", "single", "_d", "_u", "a", "context", "parts").mapInArrow(_windows(length), WINDOWS), "hot-windows")
    return whole.unionByName(_repeated(windows, ["key", "window", "rest"]).filter("single").select(
        "_d", "_u", "start", (F.col("start") + length).alias("end")))


def _bodies(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts end to end, with each one's start and size."""
    contexts = column.to_pylist()
    size = np.array([len(c) for c in contexts], np.int64)
    return np.frombuffer(b"".join(contexts), np.uint8), np.cumsum(size) - size, size


def _parts(length: int):
    step = max(1, length // 25)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            key, _, single, d, u, a, p = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(7))
            body, at, size = _bodies(batch.column(7))
            prefix = Prefix.of_bytes(body)
            # Places in the context: windows start at 0 .. last, the gram at p.
            last, p = size - length, p.astype(np.int64) - a
            low = (p - last) // step
            count = p // step - low + 1
            row = np.repeat(np.arange(len(p)), count)
            part = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            top = p[row] - part * step
            first, last = np.maximum(top - step + 1, 0), np.minimum(top, last[row])
            core = prefix.hash(at[row] + top, at[row] + top - step + 1 + length)
            # Hulls are alike if the same windows stand around the core.
            hull, rest = _digests(body, at[row] + first, at[row] + last + length)
            cols = [key[row], part.astype(np.int32), core.view(np.int64), hull + (top - first), rest,
                    single[row], d[row], u[row], (p + a)[row].astype(np.int32),
                    (first + a[row]).astype(np.int32), (last + a[row]).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=_names(PARTS))
    return deal


def _windows(length: int):
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            key, single, d, u, a = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            body, at, _ = _bodies(batch.column(5))
            starts = [np.concatenate([np.arange(x["first"], x["last"] + 1) for x in r]) for r in batch.column(6).to_pylist()]
            row = np.repeat(np.arange(len(a)), [len(x) for x in starts])
            start = np.concatenate(starts)
            q = at[row] + start - a[row]
            cols = [key[row], *_digests(body, q, q + length), single[row], d[row], u[row], start.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=_names(WINDOWS))
    return spell


def _contexts(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                body = one.column(2)[0].as_py().encode()
                d, u = one.column(0)[0].as_py(), one.column(1)[0].as_py()
                out = [(x["key"], x["hot"], x["single"], d, u, x["a"], x["p"], body[x["a"]:x["b"] + length])
                       for x in one.column(3)[0].as_py()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=_names(CONTEXTS))
    return cut


def _edges(length: int):
    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(t: pa.Table) -> pa.RecordBatch:
            key = t["key"].to_numpy()
            group = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]).astype(np.int64)]))
            d, u, a, p = (t[c].to_numpy() for c in ("_d", "_u", "a", "p"))
            found = repeated_parts(group, t["context"].to_pylist(), (p - a).astype(np.int64),
                                   t["single"].to_numpy(zero_copy_only=False), length)
            x, left, right = (np.array(c, np.int64) for c in (zip(*found) if found else ([], [], [])))
            return pa.RecordBatch.from_arrays(
                [pa.array(d[x]), pa.array(u[x]), pa.array((p[x] - left).astype(np.int32)),
                 pa.array((p[x] + right).astype(np.int32))], names=["_d", "_u", "start", "end"])

        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= COMPARE_ROWS:
                t = pa.Table.from_batches(held).combine_chunks()
                key = t["key"].to_numpy()
                cut = int(np.searchsorted(key, key[-1], "left"))  # the last key may go on
                if cut:
                    yield solve(t.slice(0, cut))
                held, rows = t.slice(cut).to_batches(), len(key) - cut
        if rows:
            yield solve(pa.Table.from_batches(held).combine_chunks())
    return resolve


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["start"], x["end"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


REMOVED = ("_d long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
           "spans array<struct<start: int, end: int>>")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: byte counts, the removed runs (``spans``) and the
    SHA-256 of what is left."""
    texts = keyed(docs, id_col, text_col)
    spans = duplicate_spans(texts, length, gram).groupBy("_d", "_u").agg(
        F.collect_list(F.struct("start", "end")).alias("spans"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = []
            for k in range(batch.num_rows):
                body = (batch.column(1)[k].as_py()).encode()
                cut = merged(batch.column(2)[k].as_py() or [])
                left = hashlib.sha256()
                at = 0
                for s, e in cut:
                    left.update(body[at:s])
                    at = e
                left.update(body[at:])
                rows.append({"_d": ids[k], "n_bytes": len(body), "n_removed": sum(e - s for s, e in cut),
                             "n_spans": len(cut), "kept_sha256": left.hexdigest(),
                             "spans": [{"start": s, "end": e} for s, e in cut]})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=OUT)

    joined = texts.join(spans, ["_d", "_u"], "left").select("_d", "_text", "spans")
    return joined.mapInArrow(finish, REMOVED).select(
        real_id().alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")


OUT = pa.schema([("_d", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                 ("kept_sha256", pa.string()),
                 ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
