"""Operator 11: exact Jaccard self-join of n-gram sets by PartEnum signatures.

A document's set are its distinct five-word shingles (A-Z lower-cased).  Two
sets link when ``|A & B| / |A | B|`` reaches the similarity; the result is the
component of each document.  No link between different sets is lost.

1. Documents of one set are one *node*.
2. Sizes are cut in bands ``[l, l / similarity]``: linked sets lie in one band
   or in neighbours.  *Instance* ``i`` serves the pairs of bands ``i - 1`` and
   ``i``, which differ in at most ``k`` elements, ``k`` following from the
   band's largest size.  A set takes part in its own instance and the next.
3. PartEnum: an instance deals the shingle domain into ``n1`` partitions of
   ``n2`` cells.  Of sets that differ in at most ``k`` elements,
   ``n1 - k // (k2 + 1)`` partitions (the *slack*) differ in at most ``k2`` and
   so agree in some ``n2 - k2`` of their cells.  Every subset of that many
   cells of every partition is a signature: the hash of the set's elements in
   it.  ``plan`` picks the cheapest numbers for each band.
4. A signature without a rare shingle (none at all, or only shingles of very
   many sets) is shared by sets that have nothing to do with each other, so it
   is left out.  A set is *irregular* if as many of its partitions have such a
   signature as the slack has; it goes on to a second round with other
   partitions, and so on, and what is still irregular in the last round (one
   set in a million, and those that consist of common shingles) sends all
   there.  No link is lost: both sets of a pair take part in the first round
   in which one of them is regular, and there this one has a partition that
   agrees and no such signature in it; or both send all in the last.
5. Sets that share a signature are candidates.  They are not paired with each
   other: a signature's *hub* is its member that shares most (the original
   among its copies).  Every node is verified against the hub it shares most
   signatures with, then against its other hubs.  What is still apart among
   the other members of a signature is finished: small groups by their pairs,
   larger ones in blocks, where only pairs pass whose parity sketches (an
   element flips one bit, so sketches never differ more than sets) may link.
   Sketches also sort out most pairs with other hubs and of small groups
   before their texts are shuffled.
6. Links are verified by the sets' sizes and their intersection, from 64-bit
   shingle hashes of whole texts.  Components come from minimum and shortcut
   steps over written tables.

Edge cases: a text of fewer than five words is one shingle; without words, or
null, it is empty and linked with nothing; a null id stays null and names a
component only if no other id is in it (then null); rows that share an id but
not a text are documents of their own; repeated rows give repeated equal rows;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations
from math import comb, exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keyed, mix, real_id, slices, utf8, written
from .near_dup import components
from .near_sketch import SHINGLE, shingles

#: The similarity as a fraction, so that its comparison is exact.
SIMILARITY = (80, 100)
#: Share of sets that may be irregular by bad luck in one round; rounds.
IRREGULAR, ROUNDS = 0.03, 4
#: Shingles are common when this share of all documents holds their cell.
CELLS, COMMON_SHARE, COMMON_LEAST = 1 << 22, 1e-3, 16
#: Members of a signature still apart that are paired at once; members (and
#: their shingles) of one block of the others.
PAIRED, BLOCK, BLOCK_SHINGLES = 16, 512, 1 << 22

_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)


# ------------------------------------------------------------------------ plan
@dataclass(frozen=True)
class Instance:
    """Numbers of one size band: sizes ``low`` to ``high``, the smallest size
    that links with them, and the numbers of step 3."""

    at: int
    low: int
    high: int
    least: int
    n1: int
    n2: int
    k2: int
    slack: int

    @property
    def drops(self) -> list[tuple[int, ...]]:
        """The cells that each subset leaves out."""
        return list(combinations(range(self.n2), self.k2))


def may_differ(sizes: int, similarity: tuple[int, int]) -> int:
    """Elements in which two linked sets of so many elements together may
    differ."""
    num, den = similarity
    return (den - num) * sizes // (den + num)


def _tail(n: int, p: float, least: int) -> float:
    """P(Binomial(n, p) >= least)."""
    if p <= 0 or least > n:
        return 0.0
    if n * p >= least:
        return 1.0
    term = exp(lgamma(n + 1) - lgamma(least + 1) - lgamma(n - least + 1) + least * log(p) + (n - least) * log1p(-p))
    total = 0.0
    for j in range(least, n + 1):  # falling terms
        total += term
        term *= (n - j) / (j + 1) * p / (1 - p)
        if term < total * 1e-6:
            break
    return min(1.0, total)


@lru_cache(maxsize=None)
def _numbers(k: int, size: int) -> tuple[int, int, int, int]:
    """The fewest signatures whose share of irregular sets (of ``size``
    elements) is small enough; if none is, the least irregular."""
    best = None
    for k2, widths in ((1, range(2, 17)), (2, range(3, 9))):
        sure = k // (k2 + 1)
        for n2 in widths:
            for slack in sorted({1, 2, 3, *(1 + sure * x // 40 for x in range(1, 21))}):
                n1 = sure + slack
                empty = comb(n2, k2) * (1 - (n2 - k2) / (n2 * n1)) ** size
                odd = _tail(n1, min(1.0, empty), slack)
                rank = (0, n1 * comb(n2, k2)) if odd <= IRREGULAR else (1, odd)
                if best is None or rank < best[0]:
                    best = rank, (n1, n2, k2, slack)
    return best[1]


@lru_cache(maxsize=None)
def plan(similarity: tuple[int, int], largest: int) -> tuple[Instance | None, ...]:
    """The instance of each size band up to the one above ``largest``; None
    where only equal sets link."""
    num, den = similarity
    out: list[Instance | None] = []
    low = 1
    while not out or low <= largest * den // num + 1:
        high = low * den // num
        least = -(-low * num // den)
        k = may_differ(2 * high, similarity)
        out.append(Instance(len(out), low, high, least, *_numbers(k, (least + low) // 2)) if k else None)
        low = high + 1
    return tuple(out)


def band_of(n: np.ndarray, instances: tuple[Instance | None, ...], similarity: tuple[int, int]) -> np.ndarray:
    """The band of each size."""
    num, den = similarity
    lows, low = [], 1
    for _ in instances:
        lows.append(low)
        low = low * den // num + 1
    return np.searchsorted(np.array(lows), n, "right") - 1


# --------------------------------------------------------------------- shingles
def _lowered(body: np.ndarray) -> np.ndarray:
    return np.where((body >= 65) & (body <= 90), body + np.uint8(32), body)


def sets(off: np.ndarray, body: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """First element of each document's set (and the total), and the elements."""
    first, h, _ = shingles(off, _lowered(body), width)
    return first, h


def _totals(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def _set_rows(rows: DataFrame) -> DataFrame:
    """``doc_id, _d, _u, n, a, b``: each row's set size and 128 bits of its
    content.  Each task adds rows ``cell, df`` (the others null): the hashed
    cells that are frequent among its own sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = np.zeros(CELLS, np.int32), 0
        for batch in batches:
            for i, j, off, body in slices(batch, "_text"):
                first, h = sets(off, body)
                np.add.at(held, _cell(h), 1)
                seen += j - i
                yield _table(j - i, [*(c.slice(i, j - i) for c in batch.columns[:3]),
                                     pa.array(np.diff(first).astype(np.int64)), pa.array(_totals(mix(h), first).view(np.int64)),
                                     pa.array(_totals(mix(h ^ _ODD), first).view(np.int64)), None, None])
        some = np.flatnonzero(held >= max(4, seen * COMMON_SHARE))
        yield _table(len(some), [*[None] * 6, pa.array(some), pa.array(held[some].astype(np.int64))])

    return rows.select("doc_id", "_d", "_u", "_text").mapInArrow(run, ", ".join(f"{c} long" for c in _SET_COLUMNS))


_SET_COLUMNS = ["doc_id", "_d", "_u", "n", "a", "b", "cell", "df"]


def _table(rows: int, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.nulls(rows, pa.int64()) if c is None else c for c in columns], names=_SET_COLUMNS)


def _common(counts: DataFrame, documents: int) -> np.ndarray:
    """Which hashed cells hold a common shingle, as bits; at most ``CELLS``
    numbers reach the driver."""
    least = max(COMMON_LEAST, int(documents * COMMON_SHARE))
    rows = counts.groupBy("cell").agg(F.sum("df").alias("df")).filter(F.col("df") >= least).select("cell")
    out = np.zeros(CELLS, bool)
    out[[r["cell"] for r in rows.toLocalIterator()]] = True
    return np.packbits(out)


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(42)).astype(np.int64)


# -------------------------------------------------------------------- signatures
def signatures(one: Instance, round_: int, owner: np.ndarray, h: np.ndarray, rare: np.ndarray, docs: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, signature)`` of the sets of one instance in one round, and
    which documents are irregular: ``h`` holds the elements, ``owner`` the
    document (0 to ``docs``) of each."""
    salt = np.uint64((one.at + 1) * ROUNDS + round_)
    z = mix(h ^ mix(np.array([salt]) * _ODD))
    part = (z >> np.uint64(32)) % np.uint64(one.n1)
    cell = (z & _LOW) % np.uint64(one.n2)
    at = ((owner * one.n1 + part.astype(np.int64)) * one.n2 + cell.astype(np.int64))
    shape, size = (docs, one.n1, one.n2), docs * one.n1 * one.n2
    v = mix(z ^ _ODD)
    # Sums of 32-bit halves stay exact in doubles.
    halves = [np.bincount(at, (x & _LOW).astype(np.float64), size) for x in (v, v >> np.uint64(32))]
    value = (halves[0].astype(np.uint64) + (halves[1].astype(np.uint64) << np.uint64(32))).reshape(shape)
    scarce = np.bincount(at, rare, size).astype(np.int64).reshape(shape)
    drops = np.array(one.drops)
    left = value.sum(axis=2, dtype=np.uint64)[:, :, None] - value[:, :, drops].sum(axis=3, dtype=np.uint64)
    known = scarce.sum(axis=2)[:, :, None] - scarce[:, :, drops].sum(axis=3) > 0
    irregular = (~known).any(axis=2).sum(axis=1) >= one.slack
    keep = known | irregular[:, None, None] if round_ == ROUNDS - 1 else known
    code = np.arange(one.n1 * len(drops), dtype=np.uint64).reshape(1, one.n1, -1) + (salt << np.uint64(40))
    sig = mix(left ^ mix(code * _ODD))
    doc = np.broadcast_to(np.arange(docs)[:, None, None], keep.shape)
    return doc[keep], sig[keep], irregular


def node_signatures(node: np.ndarray, first: np.ndarray, h: np.ndarray, common: np.ndarray,
                    similarity: tuple[int, int] = SIMILARITY) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(node, signature)`` of nodes in both of their instances."""
    n = np.diff(first)
    if not len(n):
        return
    cells = _cell(h)
    rare = ((common[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1) == 0
    instances = plan(similarity, 1 << int(n.max()).bit_length())
    band = band_of(n, instances, similarity)
    for i in np.unique(np.concatenate([band, band + 1])).tolist():
        one = instances[i] if i < len(instances) else None
        if one is None:
            continue
        docs = np.flatnonzero((n > 0) & ((band == i) | ((band == i - 1) & (n >= one.least))))
        step = max(1, (1 << 20) // (one.n1 * one.n2))  # bounds the cells held at once
        for k in range(0, len(docs), step):
            some = docs[k:k + step]
            for round_ in range(ROUNDS):
                owner = np.repeat(np.arange(len(some)), n[some])
                at = np.repeat(first[some], n[some]) + np.arange(len(owner)) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
                doc, sig, irregular = signatures(one, round_, owner, h[at], rare[at], len(some))
                yield node[some[doc]], sig
                some = some[irregular]
                if not len(some):
                    break


def _signed(texts: DataFrame, common: np.ndarray, similarity: tuple[int, int], elements: int) -> DataFrame:
    """``node, sig``.  Signatures have 24 bits more than it takes to number the
    elements of all sets: few meet by chance, and their rows compress."""
    sent = texts.sparkSession.sparkContext.broadcast(common)
    cut = np.uint64(max(1, 64 - 24 - elements.bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            for i, j, off, body in slices(batch, "_text"):
                first, h = sets(off, body)
                for node, sig in node_signatures(nodes[i:j], first, h, sent.value, similarity):
                    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array((sig >> cut).view(np.int64))], names=["node", "sig"])

    return texts.select("node", "_text").mapInArrow(run, "node long, sig long")


# ------------------------------------------------------------------ verification
def linked(ha: np.ndarray, hb: np.ndarray, similarity: tuple[int, int]) -> bool:
    """Whether two sets (sorted elements) reach the similarity."""
    num, den = similarity
    both = len(np.intersect1d(ha, hb, assume_unique=True))
    return both > 0 and den * both >= num * (len(ha) + len(hb) - both)


def _sized(small: Column, large: Column, similarity: tuple[int, int]) -> Column:
    """Sizes that allow a link."""
    num, den = similarity
    return F.least(small, large) * den >= F.greatest(small, large) * num


def _verified(pairs: DataFrame, texts: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs ``a, b``, a written table, that link."""
    # Candidates grow with the data: never broadcast their texts.  Texts that
    # few pairs ask for are picked before they are shuffled.
    side = lambda x: texts.join(pairs.select(F.col(x).alias("node")).distinct(), "node", "left_semi") \
        .select(F.col("node").alias(x), F.col("_text").alias(f"text_{x}"), F.col("n").alias(f"n_{x}")).hint("merge")
    rows = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b") \
        .filter(_sized(F.col("n_a"), F.col("n_b"), similarity)).select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[int, np.ndarray] = {}
            ids = [c.to_pylist() for c in batch.columns[:2]]
            ok = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                for x in (0, 1):
                    if ids[x][k] not in known:
                        known[ids[x][k]] = sets(*utf8(batch.column(2 + x).slice(k, 1)))[1]
                ok[k] = linked(known[ids[0][k]], known[ids[1][k]], similarity)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(ok))

    return rows.mapInArrow(run, "a long, b long")


# --------------------------------------------------------------------- leftovers
def sketch(h: np.ndarray, times: int = 4) -> np.ndarray:
    """Parity sketch of a set: element ``e`` flips bit ``e mod width``; the
    width is the power of two from ``times`` the size on."""
    width = 1 << max(6, int(times * len(h) - 1).bit_length())
    bits = np.bincount((mix(h) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<u8")


def fold(s: np.ndarray, words: int) -> np.ndarray:
    """Sketches (rows) cut to ``words`` 64-bit words."""
    while s.shape[-1] > words:
        half = s.shape[-1] // 2
        s = s[..., :half] ^ s[..., half:]
    return s


def _sketches(texts: DataFrame, times: int = 4) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, off, body in slices(batch, "_text"):
                first, h = sets(off, body)
                made = [sketch(h[first[k]:first[k + 1]], times).tobytes() for k in range(j - i)]
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns[:2]), pa.array(made, pa.binary())],
                                                 names=["node", "n", "sketch"])

    return texts.select("node", "n", "_text").mapInArrow(run, "node long, n long, sketch binary")


def _possible(pairs: DataFrame, sizes: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs ``a, b`` that ``sizes`` (``node, n, sketch``) leave possible."""
    side = lambda x: sizes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"),
                                  F.col("sketch").alias(f"s_{x}")).hint("merge")
    rows = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b") \
        .filter(_sized(F.col("n_a"), F.col("n_b"), similarity)).select("a", "b", "n_a", "n_b", "s_a", "s_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = [may_differ(n, similarity) for n in (batch.column(2).to_numpy() + batch.column(3).to_numpy()).tolist()]
            ok = np.zeros(batch.num_rows, bool)
            for k, both in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())):
                x, y = (np.frombuffer(b, "<u8") for b in both)
                words = min(len(x), len(y))
                ok[k] = np.bitwise_count(fold(x, words) ^ fold(y, words)).sum(dtype=np.int64) <= most[k]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(ok))

    return rows.mapInArrow(run, "a long, b long")


def _in_blocks(rows: DataFrame, sizes: DataFrame, texts: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs ``a, b`` of large groups that their sketches leave possible."""
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("load") / BLOCK_SHINGLES)).cast("int")
    rows = rows.join(sizes.select("sig", blocks.alias("blocks")), "sig")
    made = written(_sketches(texts.join(rows.select("node").distinct().hint("merge"), "node")).drop("n"), "block-sketches")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .join(made.hint("merge"), "node") \
        .select("sig", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "node", "c", "n", "sketch")
    num, den = similarity

    def compare(t: pa.Table) -> pa.Table:
        node, c, own, p, n = (t[x].to_numpy() for x in ("node", "c", "own", "p", "n"))
        bodies = [np.frombuffer(s, "<u8") for s in t["sketch"].to_pylist()]
        words = np.array([len(s) for s in bodies])
        left = np.flatnonzero(own == p)
        same = bool((p == t["q"].to_numpy()).all())
        right = left if same else np.flatnonzero(own != p)
        found = []
        for wide in np.unique(words[right]).tolist():
            js = right[words[right] == wide]
            held = np.array([bodies[j] for j in js])
            for i in left.tolist():
                least = min(wide, int(words[i]))
                ok = (c[js] != c[i]) & (np.minimum(n[js], n[i]) * den >= np.maximum(n[js], n[i]) * num)
                if same:
                    ok &= node[js] > node[i]
                some = np.flatnonzero(ok)
                apart = np.bitwise_count(fold(held[some], least) ^ fold(bodies[i], least)).sum(axis=1, dtype=np.int64)
                near = js[some[apart <= (den - num) * (n[js[some]] + n[i]) // (den + num)]]
                found.append(np.stack([np.minimum(node[near], node[i]), np.maximum(node[near], node[i])]))
        a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return pa.table({"a": a.astype(np.int64), "b": b.astype(np.int64)})

    return rows.groupBy("sig", "p", "q").applyInArrow(compare, "a long, b long")


def _release(df: DataFrame) -> None:
    """Have Spark's cleaner drop the shuffle files behind a table that has just
    been written; it sees that nothing refers to them when the driver collects
    its garbage.  The last query stays referred to until another has ended, so
    a look at the table comes first."""
    df.isEmpty()
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()  # noqa: SLF001


def _with_class(rows: DataFrame, classes: DataFrame, node: str, out: str) -> DataFrame:
    found = classes.select(F.col("_n").alias(node), F.col("c").alias("_c"))
    return rows.join(found, node, "left").withColumn(out, F.coalesce("_c", node)).drop("_c")


def _leftovers(shared: DataFrame, tried: DataFrame, classes: DataFrame, texts: DataFrame,
               similarity: tuple[int, int]) -> DataFrame:
    """Pairs ``a, b`` of members (hubs aside) of a signature that lie in
    different classes and have not been looked at."""
    rows = _with_class(shared.filter("node <> hub").select("sig", "node"), classes, "node", "c")
    rows = rows.join(texts.select("node", "n"), "node")
    sizes = rows.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("members"),
                                    F.sum("n").alias("load")).filter("lo <> hi").drop("lo", "hi")
    rows = written(rows.join(sizes, "sig"), "open-signatures")
    few = rows.filter(F.col("members") <= PAIRED).select("sig", "node", "c", "n")
    other = few.select("sig", F.col("node").alias("b"), F.col("c").alias("cb"), F.col("n").alias("nb"))
    pairs = few.join(other, "sig").filter((F.col("node") < F.col("b")) & (F.col("c") != F.col("cb"))
                                          & _sized(F.col("n"), F.col("nb"), similarity)) \
        .select(F.col("node").alias("a"), "b")
    many = rows.filter(F.col("members") > PAIRED)
    if not many.isEmpty():
        groups = many.groupBy("sig").agg(F.max("members").alias("members"), F.max("load").alias("load"))
        pairs = pairs.unionByName(_in_blocks(many.select("sig", "node", "c", "n"), groups, texts, similarity))
    return pairs.distinct().join(tried.select("a", "b"), ["a", "b"], "left_anti")


# -------------------------------------------------------------------------- join
def _links(texts: DataFrame, common: np.ndarray, similarity: tuple[int, int], elements: int) -> DataFrame:
    """Components ``_n, c`` of the nodes that link."""
    signed = _signed(texts, common, similarity, elements)
    shared = written(signed.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("sig"))).filter("held > 1"), "shared")
    del signed
    _release(shared)
    renown = shared.groupBy("node").agg(F.sum("held").alias("renown"))
    hubs = shared.join(renown, "node").groupBy("sig").agg(F.max(F.struct("renown", "node"))["node"].alias("hub"))
    shared = written(shared.select("sig", "node").join(hubs, "sig"), "hubs")
    del renown, hubs
    some = written(texts.join(shared.select("node").distinct().hint("merge"), "node"), "candidate-texts")
    _release(some)
    tried = written(shared.filter("node <> hub").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("times"))
                    .select("node", "hub", F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"), "times"),
                    "hub-pairs")
    nearest = tried.groupBy("node").agg(F.max(F.struct("times", "hub"))["hub"].alias("hub")) \
        .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    nearest = written(nearest, "nearest-pairs")
    edges = written(_verified(nearest, some, similarity), "edges")
    _release(edges)
    sizes = written(_sketches(some, 1), "sketches")
    for step in ("hubs", "leftovers"):
        classes = components(edges)
        if step == "hubs":
            rest = tried.select("a", "b").distinct().join(nearest, ["a", "b"], "left_anti")
            rest = _with_class(_with_class(rest, classes, "a", "ca"), classes, "b", "cb").filter("ca <> cb")
        else:
            rest = _leftovers(shared, tried.select("a", "b").distinct(), classes, some, similarity)
        rest = written(_possible(rest, sizes, similarity), "possible-pairs")
        _release(rest)
        edges = edges.unionByName(written(_verified(rest, some, similarity), "edges"))
    return components(edges)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; ``similarity`` is a
    fraction ``(numerator, denominator)`` above one half."""
    rows = keyed(docs, id_col, text_col).withColumn("doc_id", real_id())
    counted = written(_set_rows(rows), "sets")
    of_set = counted.filter("cell is null").drop("cell", "df")
    size = of_set.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("elements")).first()
    common = _common(counted.filter("cell is not null").select("cell", "df"), size["rows"])
    nodes = of_set.filter("n > 0").groupBy("a", "b").agg(
        F.min(F.struct("_d", "_u")).alias("one"), F.max("n").alias("n"), F.min("doc_id").alias("least")) \
        .select("a", "b", "one._d", "one._u", "n", "least")
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    texts = rows.join(nodes.select("node", "n", "_d", "_u").hint("merge"), ["_d", "_u"]) \
        .dropDuplicates(["_d", "_u"]).select("node", "n", "_text")
    texts = written(texts, "node-texts")
    _release(texts)
    classes = _links(texts, common, similarity, size["elements"])
    named = classes.join(nodes.select(F.col("node").alias("_n"), "least"), "_n").groupBy("c").agg(F.min("least").alias("name"))
    named = classes.join(named, "c").select(F.col("_n").alias("node"), "name")
    by_set = nodes.select("a", "b", "node", "least").join(named, "node", "left") \
        .select("a", "b", F.lit(True).alias("in_set"), F.coalesce("name", "least").alias("component"))
    return of_set.join(by_set, ["a", "b"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
        .alias("component_id"))
