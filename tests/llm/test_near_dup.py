"""Operator 1 against brute force over all pairs."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import near_dup
from tidemark.llm import near_sketch as ns
from tidemark.llm.common import prepare


def features(texts_):
    out = []
    for t in texts_:
        body = np.frombuffer((t or "").encode(), np.uint8)
        out.append(ns.shingles(np.array([0, len(body)]), body)[1:])
    return out


def rarity(feats):
    keys, df = np.unique(np.concatenate([h for h, _ in feats]), return_counts=True)
    return ns.Rarity(keys, df, int(df.sum()))


def brute(rows):
    """Document ids by class, from every pair of texts."""
    feats = features([t for _, t in rows])
    idf = rarity(feats)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (hi, ni) in enumerate(feats):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "")
            if same or ns.similarity(hi, ns.weights(hi, ni, idf), feats[j][0], ns.weights(*feats[j], idf)) >= 0.8 - 1e-6:
                parent[root(i)] = root(j)
    classes = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        classes[root(i)].append(d)
    return sorted(sorted(c, key=str) for c in classes.values())


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
    return words


def corpus(seed, groups=6, size=14):
    """Groups of copies around an original: most are near it, not all are
    near each other."""
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(60, 200))]
        rows.append(" ".join(base))
        for _ in range(size):
            rows.append(" ".join(edited(rng, base, rng.choice([0, 1, 1, 2, 3, 6, 30]))))
    rows += [" ".join(f"w{rng.randrange(400)}" for _ in range(80)) for _ in range(20)]
    rows += ["", None, "one two", "one two", "one three"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, block, votes", [(1, 512, 8), (2, 3, 3)])
def test_classes_equal_all_pairs(spark, monkeypatch, seed, block, votes):
    prepare(spark)
    monkeypatch.setattr(near_dup, "BLOCK", block)
    monkeypatch.setattr(near_dup, "HUB_VOTES_FROM", votes)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = defaultdict(list)
    for r in near_dup.classes(df).collect():
        got[r.class_id].append(r.doc_id)
    assert all(min(c) == k for k, c in got.items())
    assert sorted(sorted(c, key=str) for c in got.values()) == brute(rows)


def test_samples_agree_as_often_as_texts_are_alike():
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    texts_ = [" ".join(base), " ".join(edited(rng, base, 8)), " ".join(edited(rng, base, 30)), " ".join(base[:150])]
    feats = features(texts_)
    idf = rarity(feats)
    codes = [ns.samples(np.array([0, len(h)]), h, ns.weights(h, n, idf), 0, 252)[0] for h, n in feats]
    for i in range(4):
        for j in range(i):
            wi, wj = (dict(zip(feats[k][0].tolist(), ns.weights(*feats[k], idf) ** ns.ROOT)) for k in (i, j))
            want = sum(min(wi[h], wj[h]) for h in wi.keys() & wj.keys()) / sum(
                max(wi.get(h, 0), wj.get(h, 0)) for h in wi.keys() | wj.keys())
            assert abs(float((codes[i] == codes[j]).mean()) - want) < 0.13


def test_frequencies_are_exact_and_follow_shares(spark, monkeypatch):
    """Counted over documents, copies included; a shingle rarer than one share
    weighs like one of that share; twice the corpus, the same weights."""
    prepare(spark)
    rows = corpus(3)
    feats = features([t for _, t in rows])
    keys, df = np.unique(np.concatenate([h for h, _ in feats]), return_counts=True)
    total = int(df.sum())
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = near_dup.frequencies(near_dup._texts(docs, "doc_id", "text"))
    assert np.allclose(got.of(keys), np.log2(1 + total / df), atol=1e-5)
    for module in (ns, near_dup):
        monkeypatch.setattr(module, "SHARES", total // 5)
    once = near_dup.frequencies(near_dup._texts(docs, "doc_id", "text"))
    assert set(once.keys.tolist()) == set(keys[df * (total // 5) >= total].tolist()) and 0 < len(once.keys) < len(keys)
    assert np.allclose(once.of(keys), np.log2(1 + total / np.maximum(df, total / (total // 5))), atol=1e-5)
    twice = near_dup.frequencies(near_dup._texts(docs.unionAll(docs), "doc_id", "text"))
    assert np.allclose(twice.of(keys), once.of(keys), atol=1e-5)


def test_copies_of_a_large_group_stay_with_it(spark):
    """By weight alone a copy's new shingles, which are rare, would take it
    out of a group whose shingles are frequent."""
    prepare(spark)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    rows = [" ".join(base) + f" tail{i}" for i in range(150)] + [" ".join(edited(rng, base, 3)) for _ in range(8)]
    rows += [" ".join(f"v{rng.randrange(10 ** 6)}" for _ in range(150)) for _ in range(60)]
    rows = list(enumerate(rows))
    feats = features([t for _, t in rows])
    idf = rarity(feats)
    plain, apart = 0, 0
    for i in range(150, 158):
        (ha, na), (hb, nb) = feats[0], feats[i]
        low = len(np.intersect1d(ha, hb))
        if low / (len(ha) + len(hb) - low) >= 0.8:
            plain += 1
            wa, wb = dict(zip(ha.tolist(), ns.weights(ha, na, idf))), dict(zip(hb.tolist(), ns.weights(hb, nb, idf)))
            shared = sum(wa[h] for h in wa.keys() & wb.keys())
            apart += shared / (sum(wa.values()) + sum(wb.values()) - shared) < 0.8
    assert plain >= 5 and apart
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = defaultdict(list)
    for r in near_dup.classes(docs).collect():
        got[r.class_id].append(r.doc_id)
    assert sorted(sorted(c, key=str) for c in got.values()) == brute(rows)


def test_leftover_blocks_do_not_pair_the_largest_class_with_itself(spark, monkeypatch):
    """One large class, others beside it in its bands: every link between
    classes is found, and groups grow with the others only."""
    prepare(spark)
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(160)]
    texts_ = [" ".join(edited(rng, base, 1)) for _ in range(40)] + [" ".join(edited(rng, base, 4)) for _ in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts_)), "_n long, _text string").withColumn("_u", F.xxhash64("_text"))
    texts = docs.select("_n", "_u", "_text")
    idf = near_dup.frequencies(texts)
    nodes = near_dup.sketches(texts, idf)
    members = near_dup._banded(nodes)
    # The first 40 are one class; the others are each apart.
    apart = spark.createDataFrame([(i, 0) for i in range(40)], "_n long, c long")
    links = near_dup._leftovers(members, nodes, texts.select("_n", "_text"), apart, idf, 0.8)
    got = {(r.a, r.b) for r in links.collect()}
    feats = features(texts_)
    w = [ns.weights(*f, idf) for f in feats]
    alike = {(i, j) for i in range(46) for j in range(40, 46) if i != j
             and ns.similarity(feats[i][0], w[i], feats[j][0], w[j]) >= 0.8 - 1e-6}
    assert got and got <= alike | {(b, a) for a, b in alike}

    def classes_of(edges):
        return dict(near_dup.components(spark.createDataFrame(sorted(edges) + [(0, i) for i in range(1, 40)],
                                                              "a long, b long")).collect())
    assert classes_of(got) == classes_of(alike)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (103, 101)], "a long, b long")
    got = dict(near_dup.components(edges).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}


def test_odd_rows(spark):
    """Null ids and texts, repeated rows, one id with two texts, clashing
    column names, an empty table."""
    prepare(spark)
    text = "a b c d e f g h i j k l m n o p"
    rows = [(5, text), (3, text), (3, text), (None, text), (None, "other text of no copy"), (None, None), (8, ""),
            (9, "one"), (9, "two words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(map(tuple, near_dup.classes(df).collect()))
    assert got[3, 3] == 2 and got[5, 3] == got[None, 3] == got[None, 8] == got[8, 8] == 1 and got[9, 9] == 2
    extra = df.withColumns({"_n": F.lit(1), "codes": F.lit("x"), "class_id": F.lit(None).cast("int")})
    kept = near_dup.one_of_each(extra)
    assert kept.columns == extra.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        [(3, text), (None, "other text of no copy"), (8, ""), (9, "one"), (9, "two words")])
    assert near_dup.classes(df.limit(0)).count() == 0 and near_dup.one_of_each(df.limit(0)).count() == 0


def test_texts_that_share_an_id_are_classed_apart(spark):
    """One id on a near copy of another document, on a clean text and on a
    near copy of that: each class keeps one row, and no clean text goes."""
    prepare(spark)
    rng = random.Random(11)
    first, clean, third = (" ".join(f"{c}{rng.randrange(10 ** 6)}" for _ in range(150)) for c in "abc")
    rows = [(3, first), (9, first + " end"), (9, clean), (12, clean + " end"),
            (20, third), (20, third + " end"), (20, "a short text of its own")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(map(tuple, near_dup.classes(df).collect()))
    assert got == Counter([(3, 3), (9, 3), (9, 9), (12, 9), (20, 20), (20, 20), (20, 20)])
    kept = [(r.doc_id, r.text) for r in near_dup.one_of_each(df).collect()]
    assert {(3, first), (9, clean), (20, "a short text of its own")} < set(kept)
    assert len(kept) == 4 and {t for _, t in kept} & {third, third + " end"}


def test_frequencies_are_exact_and_rare_shingles_are_not_gathered(spark, monkeypatch):
    from collections import Counter

    import numpy as np
    import pyarrow as pa

    from tidemark.llm import near_dup
    from tidemark.llm.common import prepare, utf8
    from tidemark.llm.near_sketch import shingles

    prepare(spark)
    texts = [f"shared words of every text {i % 7} " + " ".join(f"w{i}x{j}" for j in range(300)) for i in range(200)] + ["", "a b"]
    held, real = [], near_dup.written
    monkeypatch.setattr(near_dup, "written", lambda df, name: held.append(real(df, name)) or held[-1])
    got = near_dup.frequencies(spark.createDataFrame([(t,) for t in texts], "_text string"))
    assert all(t.count() <= near_dup.CELLS // near_dup.PART for t in held)
    want = Counter(h for t in texts for h in shingles(*utf8(pa.array([t])))[1].tolist())
    assert got.keys.tolist() == sorted(h for h, n in want.items() if n > 1)
    total = sum(want.values())
    assert np.allclose(got.idf, [np.log2(1 + total / want[h]) for h in got.keys.tolist()])
