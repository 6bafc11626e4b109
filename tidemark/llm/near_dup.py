"""Operator 1: near-duplicate classes by consistent weighted sampling.

1. Document frequencies of five-word shingles are counted in two passes, by
   hashed cells and then exactly in the cells that hold enough;
   the frequent ones (a table of bounded size, see ``near_sketch``) are sent to
   the tasks.
2. Every text gets 60 weighted samples (``near_sketch``), read as 15 bands of
   4.  Copies of a text are one *node*, numbered by a hash of the text; the
   number becomes a document id only in the result.
3. Nodes that share a band are candidates.  They are not paired with each
   other: a band's *hub* is its member that agrees best with the members'
   most common samples (the original among its copies), and each node is
   first compared with the one hub that it agrees with best, then with its
   other hubs.
4. What a hub leaves apart is finished exactly: within a band, members of
   different classes are compared in blocks of a bounded size by their samples
   and 192 more, and pairs that agree often enough are verified on the spot.
   Only links leave a block, and a pair already in one class is skipped.  The
   band's largest class is never compared with itself, so its members are
   copied once for each block of the others.
5. Verified means: the Jaccard similarity of the whole shingle sets, weighted
   by TF-IDF or plain, is at least ``similarity``.  Classes are the connected components, found by
   repeated minimum and shortcut steps over written tables.

Edge cases: equal texts are always one class, empty ones too (a null text is
empty); a text of fewer than five words is one shingle; rows that share an id
belong to one node each by text, and are classed apart; a null id stays null in the result and the
row is classed by its text; repeated rows get repeated result rows; extra
columns are ignored by ``classes`` and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Prefix, slices, utf8, written
from .near_sketch import BANDS, FINE_SAMPLES, SAMPLES, SHARES, SLICE, Rarity, bands, samples, shingles, similarity, weights
from .vocab import forget

SIMILARITY = 0.8
#: Samples that must agree before a pair is verified: of 60, a pair at 0.76 by
#: the samples' weights agrees in fewer with a probability under 0.002.
AGREE = 36
#: The same of all 252 samples, under 0.004.
FINE_AGREE = 172
#: Members compared with each other in one block of step 4, and the number of
#: their shingles, which bounds the block's texts.
BLOCK, BLOCK_SHINGLES = 512, 1 << 19
#: Hashed cells that shingles are first counted by, several to each of the
#: ``SHARES``; cells in one row; shingles that a task counts before it sends.
CELLS, PART, HELD = 1 << 22, 1 << 16, 1 << 20
#: Bands with fewer members take their smallest node as hub.
HUB_VOTES_FROM, VOTES = 8, 16

NODES = "_n long, _u long, _v long, size int, weight float, codes binary"


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_n, _u, _text``; a null id becomes a large number made of the text's
    hash, behind all real ids."""
    return docs.select(*_address(id_col, text_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def _address(id_col: str, text_col: str) -> tuple[Column, Column]:
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    stand_in = text_hash.bitwiseAND(F.lit(2 ** 61 - 1)) + F.lit(2 ** 62)
    return F.coalesce(F.col(id_col).cast("long"), stand_in).alias("_n"), text_hash.alias("_u")


def frequencies(texts: DataFrame) -> Rarity:
    """Exact document frequencies of the shingles that make up ``1 / SHARES``
    of all, at most ``SHARES`` of them.  A first pass counts hashed cells: a
    shingle is at most as frequent as its cell.  A second one counts the
    shingles of the cells that are frequent enough, so the others (nearly all)
    are never shuffled."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        held = np.zeros(CELLS, np.int32)
        for batch in batches:
            for _, _, off, body in slices(batch, "_text", SLICE):
                np.add.at(held, _cell(shingles(off, body)[1]), 1)
        for part, some in enumerate(held.reshape(-1, PART)):
            at = np.flatnonzero(some)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([at.astype(np.uint16).tobytes()], pa.binary()),
                     pa.array([some[at].tobytes()], pa.binary())], names=["part", "at", "n"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, at, n in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(part, np.zeros(PART, np.int64))[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.int32)
        for part, sums in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([sums.tobytes()], pa.binary()), pa.array([int(sums.sum())])],
                names=["part", "sums", "n"])

    counted = texts.select("_text").mapInArrow(cells, "part int, at binary, n binary").repartition("part") \
        .mapInArrow(summed, "part int, sums binary, n long")
    counted = written(counted, "shingle-cells")
    total = counted.agg(F.sum("n")).first()[0] or 0
    least = max(2, -(-total // SHARES))

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(np.frombuffer(x, np.int64) >= least).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], names=["part", "bits"])

    bits = np.zeros((CELLS // PART, PART // 8), np.uint8)
    for r in counted.select("part", "sums").mapInArrow(frequent, "part int, bits binary").collect():
        bits[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    sent = texts.sparkSession.sparkContext.broadcast(bits.ravel())

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, held, size = np.unpackbits(sent.value).astype(bool), [], 0

        def rows() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "df"])

        for batch in batches:
            for _, _, off, body in slices(batch, "_text", SLICE):
                h = shingles(off, body)[1]
                held.append(h[open_[_cell(h)]])
                size += len(held[-1])
                if size >= HELD:
                    yield rows()
                    held, size = [], 0
        if size:
            yield rows()

    some = texts.select("_text").mapInArrow(features, "h long, df long").groupBy("h").agg(F.sum("df").alias("df")) \
        .filter(F.col("df") >= least).toArrow()
    return Rarity(some["h"].to_numpy().view(np.uint64), some["df"].to_numpy(), total)


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(65 - CELLS.bit_length())).astype(np.int64)


def sketches(texts: DataFrame, rarity: Rarity) -> DataFrame:
    """``NODES`` rows, one per document; ``_v`` is a second text hash."""
    sent = texts.sparkSession.sparkContext.broadcast(rarity)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, off, body in slices(batch, "_text", SLICE):
                first, h, n = shingles(off, body)
                w = weights(h, n, sent.value)
                has = np.diff(first) > 0
                size, total = np.diff(first).astype(np.int32), np.zeros(j - i, np.float32)
                total[has] = np.add.reduceat(w, first[:-1][has]) if has.any() else 0
                codes = np.array([None] * (j - i), object)
                codes[has] = [c.tobytes() for c in samples(first, h, w)]
                whole = Prefix.of_bytes(body).hash(off[:-1], off[1:]) ^ np.diff(off).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                     pa.array(whole.view(np.int64)), pa.array(size), pa.array(total), pa.array(codes, pa.binary())],
                    names=["_n", "_u", "_v", "size", "weight", "codes"])

    return texts.mapInArrow(sketch, NODES)


def _banded(nodes: DataFrame) -> DataFrame:
    """``band, at, _n``: one row per node and band, with the band's place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, SAMPLES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bands(codes).ravel().view(np.int64)),
                 pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(codes))),
                 pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS))],
                names=["band", "at", "_n"])

    return nodes.filter("codes is not null").select("_n", "codes").mapInArrow(run, "band long, at int, _n long")


def _hubs(members: DataFrame, sizes: DataFrame, codes: DataFrame) -> DataFrame:
    """``band, hub``.  Votes, their winners and the members' scores are plain
    aggregations, so a band of any size is combined map-side."""
    small = sizes.filter(F.col("size") < HUB_VOTES_FROM).select("band", F.col("least").alias("hub"))
    large = members.join(sizes.filter(F.col("size") >= HUB_VOTES_FROM).select("band"), "band")
    ballots = written(large.join(codes.select("_n", F.substring("codes", 1, 2 * VOTES).alias("c")), "_n"), "ballots")
    ballot = F.expr(f"transform(sequence(0, {VOTES - 1}), i -> struct(i as at, substring(c, 2 * i + 1, 2) as code))")
    votes = ballots.select("band", F.explode(ballot).alias("b")).groupBy("band", "b.at", "b.code").count()
    winners = votes.groupBy("band", "at").agg(F.max(F.struct("count", "code")).alias("top")) \
        .groupBy("band").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", F.hex("top.code").alias("x")))),
                                                      lambda s: s["x"]), "").alias("common"))
    own = F.hex("c")
    score = F.expr(f"aggregate(sequence(0, {VOTES - 1}), 0, (s, i) -> s + "
                   "if(substring(mine, 4 * i + 1, 4) = substring(common, 4 * i + 1, 4), 1, 0))")
    best = ballots.withColumn("mine", own).join(winners, "band").select("band", "_n", score.alias("score")) \
        .groupBy("band").agg((-F.max(F.struct("score", (-F.col("_n")).alias("m")))["m"]).alias("hub"))
    return small.unionByName(best)


def _agreement(pairs: DataFrame, nodes: DataFrame, similarity_: float) -> DataFrame:
    """Pairs ``a, b`` that may reach the similarity, with ``agree``."""
    side = lambda x: nodes.select(F.col("_n").alias(x), F.col("codes").alias(f"codes_{x}"),
                                  F.col("size").alias(f"size_{x}"), F.col("weight").alias(f"weight_{x}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, ca, na, wa, cb, nb, wb = batch.columns
            ca, cb = (np.frombuffer(b"".join(c.to_pylist()), np.uint16).reshape(-1, SAMPLES) for c in (ca, cb))
            agree = (ca == cb).sum(1).astype(np.int32)
            ok = (agree >= AGREE) & _close(na.to_numpy(), wa.to_numpy(), nb.to_numpy(), wb.to_numpy(), similarity_)
            yield pa.RecordBatch.from_arrays([a, b, pa.array(agree)], names=["a", "b", "agree"]).filter(pa.array(ok))

    return rows.select("a", "b", "codes_a", "size_a", "weight_a", "codes_b", "size_b", "weight_b") \
        .mapInArrow(run, "a long, b long, agree int")


def _close(na: np.ndarray, wa: np.ndarray, nb: np.ndarray, wb: np.ndarray, similarity_: float) -> np.ndarray:
    """A similarity is at most the smaller size (or total weight) over the
    larger."""
    least = similarity_ * (1 - 1e-4)
    return (np.minimum(na, nb) >= least * np.maximum(na, nb)) | (np.minimum(wa, wb) >= least * np.maximum(wa, wb))


def _verified(pairs: DataFrame, texts: DataFrame, rarity: Rarity, similarity_: float) -> DataFrame:
    """The pairs ``a, b`` whose whole shingle sets reach the similarity."""
    sent = texts.sparkSession.sparkContext.broadcast(rarity)
    # Candidates grow with the data: never broadcast their texts.
    side = lambda x: texts.select(F.col("_n").alias(x), F.col("_text").alias(f"text_{x}")).hint("merge")
    rows = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            ids = [c.to_pylist() for c in batch.columns[:2]]
            ok = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                for x in (0, 1):
                    if ids[x][k] not in known:
                        off, body = utf8(batch.column(2 + x).slice(k, 1))
                        _, h, n = shingles(off, body)
                        known[ids[x][k]] = h, weights(h, n, sent.value)
                (ha, wa), (hb, wb) = known[ids[0][k]], known[ids[1][k]]
                ok[k] = similarity(ha, wa, hb, wb) >= similarity_ - 1e-6
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(ok))

    return rows.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``_n, c``: the smallest node that each node of ``edges`` (``a, b``) is
    connected to.  Each round takes the smallest class among the neighbours,
    then the class's class; rounds grow with the logarithm of a path."""
    both = written(edges.union(edges.select("b", "a")).toDF("a", "b").distinct(), name)
    now = written(both.groupBy(F.col("a").alias("_n")).agg(F.min("b").alias("m"))
                  .select("_n", F.least("_n", "m").alias("c")), name)
    while True:
        near = both.join(now.select(F.col("_n").alias("b"), F.col("c").alias("cb")), "b") \
            .groupBy(F.col("a").alias("_n")).agg(F.min("cb").alias("m"))
        hooked = now.join(near, "_n").select("_n", F.col("c").alias("was"), F.least("c", "m").alias("c"))
        # A class is a node of the same table: follow it one step further.
        top = now.select(F.col("_n").alias("c"), F.col("c").alias("cc"))
        step = written(hooked.join(top, "c").select("_n", F.least("c", "cc").alias("c"),
                                                    (F.least("c", "cc") != F.col("was")).alias("moved")), name)
        now = step.select("_n", "c")
        if step.filter("moved").isEmpty():
            return now


def _with_class(rows: DataFrame, classes_: DataFrame, node: str, out: str) -> DataFrame:
    c = classes_.select(F.col("_n").alias(node), F.col("c").alias("_c"))
    return rows.join(c, node, "left").withColumn(out, F.coalesce("_c", node)).drop("_c")


def _fine(texts: DataFrame, rarity: Rarity) -> DataFrame:
    """``_n, fine``: further samples of ``_n, _text``."""
    sent = texts.sparkSession.sparkContext.broadcast(rarity)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, off, body in slices(batch, "_text", SLICE):
                first, h, n = shingles(off, body)
                codes = samples(first, h, weights(h, n, sent.value), SAMPLES, FINE_SAMPLES).astype(np.uint8)
                has = np.flatnonzero(np.diff(first))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).take(pa.array(has)),
                     pa.array([c.tobytes() for c in codes], pa.binary())], names=["_n", "fine"])

    return texts.select("_n", "_text").mapInArrow(sketch, "_n long, fine binary")


def _leftovers(members: DataFrame, nodes: DataFrame, texts: DataFrame, classes_: DataFrame, rarity: Rarity,
               similarity_: float) -> DataFrame:
    """Links ``a, b`` between members of a band in different classes.  Bands of
    one class are done; the others are cut in blocks, those of the largest
    class last, and each pair of blocks that holds different classes is one
    bounded group with its members' texts."""
    rows = _with_class(members, classes_, "_n", "c").join(nodes.select("_n", "codes", "size", "weight"), "_n")
    blocks = lambda n, load: F.ceil(F.greatest(n / BLOCK, load / BLOCK_SHINGLES)).cast("int")
    by_class = rows.groupBy("band", "c").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("load"))
    bands_ = by_class.groupBy("band").agg(
        F.max(F.struct("n", "load", "c")).alias("top"), F.sum("n").alias("n"), F.sum("load").alias("load"),
        F.count(F.lit(1)).alias("classes")).filter("classes > 1").select(
        "band", F.col("top.c").alias("top"), blocks(F.col("top.n"), F.col("top.load")).alias("last"),
        blocks(F.col("n") - F.col("top.n"), F.col("load") - F.col("top.load")).alias("others"))
    rows = written(rows.join(bands_, "band"), "open-bands")
    open_texts = texts.join(rows.select("_n").distinct().hint("merge"), "_n")
    both = written(open_texts.join(_fine(open_texts, rarity), "_n"), "open-texts")
    in_top, spread = F.col("c") == F.col("top"), F.xxhash64("_n")
    rows = rows.withColumn("own", F.when(in_top, F.col("others") + F.pmod(spread, F.col("last")))
                           .otherwise(F.pmod(spread, F.col("others"))).cast("int"))
    # Each member goes to all pairs of blocks that hold its own, but for pairs of the largest class.
    until = F.when(in_top, F.col("others")).otherwise(F.col("others") + F.col("last")) - 1
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), until.cast("int"))))
    rows = rows.join(both.hint("merge"), "_n").select(
        "band", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
        "own", "at", "_n", "c", "codes", "fine", "size", "weight", "_text")
    sent = texts.sparkSession.sparkContext.broadcast(rarity)

    def compare(t: pa.Table) -> pa.Table:
        n, c, own, p, size, w = (t[x].to_numpy() for x in ("_n", "c", "own", "p", "size", "weight"))
        codes = np.frombuffer(b"".join(t["codes"].to_pylist()), np.uint16).reshape(-1, SAMPLES)
        fine = np.frombuffer(b"".join(t["fine"].to_pylist()), np.uint8).reshape(-1, FINE_SAMPLES)
        bodies = t["_text"].combine_chunks()
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def features(k: int) -> tuple[np.ndarray, np.ndarray]:
            if k not in known:
                off, body = utf8(bodies.slice(k, 1))
                _, h, count = shingles(off, body)
                known[k] = h, weights(h, count, sent.value)
            return known[k]

        left = np.flatnonzero(own == p)
        same = bool((p == t["q"].to_numpy()).all())
        right = left if same else np.flatnonzero(own != p)
        at, shape = int(t["at"][0].as_py()), (BANDS, SAMPLES // BANDS)
        now = c.copy()  # classes, as links of this group merge them
        links = []
        for i in left.tolist():
            js = right[now[right] != now[i]]
            if same:
                js = js[n[js] > n[i]]
            agree = (codes[js] == codes[i]).sum(1)
            js, agree = js[agree >= AGREE], agree[agree >= AGREE]
            js = js[agree + (fine[js] == fine[i]).sum(1) >= FINE_AGREE]
            js = js[_close(size[js], w[js], size[i], w[i], similarity_)]
            # A pair is looked at in the first band that it shares.
            alike = (codes[js].reshape(-1, *shape) == codes[i].reshape(shape)).all(2)
            for j in js[alike.argmax(1) == at].tolist():
                if now[j] != now[i] and similarity(*features(i), *features(j)) >= similarity_ - 1e-6:
                    links.append((n[i], n[j]))
                    now[now == now[j]] = now[i]
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.table({"a": a, "b": b})

    return rows.groupBy("band", "p", "q").applyInArrow(compare, "a long, b long")


def document_classes(texts: DataFrame, similarity_: float = SIMILARITY) -> DataFrame:
    """``_n, _u, class_id, names``: one row per document, and whether it is
    the one that names its class."""
    rarity = frequencies(texts)
    rows = written(sketches(texts, rarity), "sketches")
    first = rows.groupBy("_u", "_v").agg(F.min(F.struct("_n", "codes", "size", "weight")).alias("one"))
    # Different texts may share a document id: nodes go by a number of the text.
    number = F.xxhash64("_u", "_v").bitwiseAND(F.lit(2 ** 63 - 1))
    nodes = written(first.select("_u", "_v", number.alias("_n"), F.col("one._n").alias("_least"), "one.codes", "one.size", "one.weight"),
                    "nodes")
    members = _banded(nodes)
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("_n").alias("least")).filter("size > 1")
    members = written(members.join(sizes.select("band"), "band"), "members")
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("_n").alias("least"))
    linked = members.select("_n").distinct()
    codes = written(nodes.join(linked, "_n"), "candidates")
    bodies = written(texts.withColumnRenamed("_n", "_least")
                     .join(codes.select("_n", "_least", "_u").hint("merge"), ["_least", "_u"])
                     .dropDuplicates(["_least", "_u"]).select("_n", "_text"), "candidate-texts")
    hubs = _hubs(members, sizes, codes)
    pairs = members.drop("at").join(hubs, "band").filter("_n <> hub").select(F.col("_n").alias("a"), F.col("hub").alias("b"))
    pairs = written(_agreement(pairs.distinct(), codes, similarity_), "pairs")
    nearest = pairs.groupBy("a").agg((-F.max(F.struct("agree", (-F.col("b")).alias("m")))["m"]).alias("b"))
    edges = written(_verified(nearest, bodies, rarity, similarity_), "edges")
    classes_ = components(edges)
    other_hubs = _with_class(_with_class(pairs, classes_, "a", "ca"), classes_, "b", "cb").filter("ca <> cb")
    edges = edges.unionByName(written(_verified(other_hubs, bodies, rarity, similarity_), "edges"))
    classes_ = components(edges)
    rest = _leftovers(members, codes, bodies, classes_, rarity, similarity_)
    edges = edges.unionByName(written(rest, "edges"))
    classes_ = components(edges)
    # A class takes the smallest document id of its nodes; one node names it.
    named = classes_.join(nodes.select("_n", "_least"), "_n").groupBy("c").agg(
        F.min(F.struct("_least", "_n")).alias("name"))
    classes_ = classes_.join(named, "c").select(F.col("_n").alias("node"), "name")
    by_text = nodes.select("_u", "_v", F.col("_n").alias("node"), "_least").join(classes_, "node", "left").select(
        "_u", "_v", "_least", F.coalesce("name", F.struct("_least", F.col("node").alias("_n"))).alias("name"),
        F.coalesce(F.col("name._n") == F.col("node"), F.lit(True)).alias("names"))
    return rows.select("_n", "_u", "_v").join(by_text, ["_u", "_v"]).select(
        "_n", "_u", F.col("name._least").alias("class_id"), (F.col("names") & (F.col("_n") == F.col("_least"))).alias("names"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            similarity_: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id``: one row per document; the class is named by its
    smallest document id."""
    named = document_classes(_texts(docs, id_col, text_col), similarity_)
    return named.select(F.when(F.col("_n") < 2 ** 62, F.col("_n")).alias("doc_id"), "class_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                similarity_: float = SIMILARITY) -> DataFrame:
    """The document that names each class, all columns as they were.  Of rows
    that repeat it, one stays."""
    out = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(docs.columns)])
    at = dict(zip(docs.columns, out.columns))
    texts = _texts(out, at[id_col], at[text_col])
    stays = document_classes(texts, similarity_).filter("names").select("_n", "_u").distinct()
    keyed = out.select("*", *_address(at[id_col], at[text_col]))
    kept = keyed.join(stays, ["_n", "_u"], "left_semi").dropDuplicates(["_n", "_u"])
    return kept.select(*[F.col(c).alias(k) for k, c in at.items()])
