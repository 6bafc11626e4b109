"""Operator 11 against all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join as jj
from tidemark.llm.common import prepare
from tidemark.llm.jaccard_join import SIMILARITY, fold, jaccard_components, may_differ, node_signatures, plan, sketch


def shingle_set(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0D]+", low)
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Per row: set size and the smallest id of its component."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[root(i)] = min(d, ids.get(root(i), d))
    return [(d, len(s), ids.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def corpus(seed, groups=25, lengths=(1, 5, 9, 12, 16, 24, 40, 80, 160, 300)):
    """Groups round an original, most members near 0.8 of it; every length,
    a line that many share, one that is most of some texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    line = [f"l{i}" for i in range(14)]
    rows = []
    for g in range(groups):
        base = [word() for _ in range(lengths[g % len(lengths)])]
        for _ in range(rng.randint(1, 9)):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                at = rng.randrange(len(words))
                edit = rng.random()
                if edit < 0.4:
                    words[at] = word()
                elif edit < 0.7:
                    del words[at:at + 1]
                    words = words or ["x"]
                else:
                    words[at:at] = [word()]
            if rng.random() < 0.4:
                words += line
            rows.append(" ".join(words))
    for _ in range(40):
        rows.append(" ".join(line + [word() for _ in range(rng.randint(0, 6))]))
    rows += ["", " \t\n", None, "One", "one", "A b  c\td", "a B c d", "é È e", "a b c d e f", "A B C D E F"]
    rng.shuffle(rows)
    out = [(3 * i + 1, t) for i, t in enumerate(rows)]
    return out + [(4, out[9][1]), (7, out[2][1]), (None, out[0][1]), (None, "no id, alone, five words"), (None, "")]


def key(r):
    return tuple((x is None, x or 0) for x in r)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_match_all_pairs(spark, seed, monkeypatch):
    prepare(spark)
    if seed == 2:  # few pairs at once, small blocks
        monkeypatch.setattr(jj, "PAIRED", 2)
        monkeypatch.setattr(jj, "BLOCK", 3)
    if seed == 3:  # every shared shingle is common
        monkeypatch.setattr(jj, "COMMON_LEAST", 2)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3) \
        .withColumns({"n": F.lit("x"), "node": F.lit(1), "_text": F.lit(0), "component_id": F.lit(2.5)})
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df).collect()]
    want = brute(rows)
    assert sorted(got, key=key) == sorted(want, key=key)
    sizes = {}
    for _, _, c in want:
        sizes[c] = sizes.get(c, 0) + 1
    assert max(sizes.values()) > 5 and len(sizes) > 20


def test_empty_tables(spark):
    prepare(spark)
    for rows in ([], [(1, None)], [(2, "a b c d e"), (1, "v w x y z")]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert sorted((r.doc_id, r.component_id) for r in jaccard_components(df).collect()) == sorted((d, d) for d, _ in rows)


@pytest.mark.parametrize("size", [4, 5, 6, 8, 11, 14, 18, 24, 33, 47, 60, 93, 150, 290, 700, 1500])
@pytest.mark.parametrize("common", [False, True])
def test_every_linked_pair_shares_a_signature(size, common):
    """Pairs at the very bound, sizes of one band and of neighbours."""
    rng = np.random.default_rng(size)
    flags = np.packbits(rng.random(jj.CELLS) < (0.5 if common else 0))
    for trial in range(120):
        other = int(rng.integers(size, size * 5 // 4 + 1))
        both = -(-4 * (size + other) // 9)
        if both > size:
            continue
        h = np.unique(rng.integers(0, 2 ** 63, size + other - both, dtype=np.uint64))
        rng.shuffle(h)
        a, b = np.sort(h[:size]), np.sort(np.concatenate([h[:both], h[size:]]))
        assert len(b) == other and jj.linked(a, b, SIMILARITY)
        sent = {0: set(), 1: set()}
        for node, sig in node_signatures(np.array([0, 1]), np.array([0, size, size + other]), np.concatenate([a, b]), flags):
            for x, s in zip(node.tolist(), sig.tolist()):
                sent[x].add(s)
        assert sent[0] & sent[1]


def test_plan_covers_all_sizes():
    instances = plan(SIMILARITY, 5000)
    for at, one in enumerate(instances):
        if one is None:
            continue
        assert one.at == at and one.slack == one.n1 - may_differ(2 * one.high, SIMILARITY) // (one.k2 + 1) >= 1
        assert one.least * 100 >= 80 * one.low > (one.least - 1) * 100
        assert jj.band_of(np.array([one.low, one.high]), instances, SIMILARITY).tolist() == [at, at]


def test_sketches_never_differ_more_than_sets():
    rng = np.random.default_rng(0)
    for _ in range(100):
        h = np.unique(rng.integers(0, 2 ** 63, int(rng.integers(2, 400)), dtype=np.uint64))
        a, b = np.sort(h[:len(h) * 2 // 3]), np.sort(h[len(h) // 3:])
        sa, sb = sketch(a), sketch(b)
        least = min(len(sa), len(sb))
        assert np.bitwise_count(fold(sa, least) ^ fold(sb, least)).sum() <= len(np.setxor1d(a, b))


def test_words_that_only_differ_in_case_are_equal():
    body = "Ab É x Y z AB é X y Z".encode()
    first, h = jj.sets(np.array([0, len(body)]), np.frombuffer(body, np.uint8))
    assert first.tolist() == [0, len(h)] and len(h) == 6  # É and é differ


def test_released_tables_leave_no_shuffle_files(spark):
    import time

    from tidemark.llm.common import written
    from tidemark.llm.jaccard_join import _release

    def held():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName().split("_")[1] for i in range(files.size())
                if files.apply(i).getName().startswith("shuffle_")}

    before = held()
    rows = spark.range(5000).withColumn("g", F.col("id") % 7)
    table = written(rows.repartition(3, "g"), "released")
    new = held() - before
    assert new
    _release(table)
    for _ in range(50):
        if not held() & new:
            break
        time.sleep(0.2)
    assert not held() & new
    assert table.count() == 5000


def test_sketches_sort_out_unlike_pairs_before_texts_move(spark, monkeypatch):
    prepare(spark)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(40):  # pairs at 0.6, and each with a copy at 0.9
        at = rng.randrange(0, 260)
        own = base[:at] + [f"x{i}_{k}" for k in range(35)] + base[at + 35:]
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join([*own, *(f"y{i}_{k}" for k in range(9))]))]
    asked = []
    verified = jj._verified

    def counted(pairs, texts, similarity):
        asked.append([(r.a, r.b) for r in pairs.select("a", "b").collect()])
        return verified(pairs, texts, similarity)

    monkeypatch.setattr(jj, "_verified", counted)
    tables = []
    written = jj.written
    monkeypatch.setattr(jj, "written", lambda df, name: tables.append((name, written(df, name))) or tables[-1][1])
    got = {r.doc_id: r.component_id for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows) and all(got[2 * i + 1] == got[2 * i] for i in range(40))
    tried = dict(tables)["hub-pairs"].select("a", "b").distinct().count()
    assert tried > 200 and sum(map(len, asked[1:])) < 0.3 * (tried - len(asked[0]))


def test_texts_few_pairs_ask_for_are_picked_before_the_shuffle(spark):
    prepare(spark)
    texts = jj.written(spark.range(200).selectExpr("id as node", "repeat(concat('w', id, ' '), 20) as _text", "1L as n"), "texts")
    pairs = jj.written(spark.createDataFrame([(1, 2), (3, 4)], "a long, b long"), "pairs")
    plan_ = jj._verified(pairs, texts, SIMILARITY)._jdf.queryExecution().executedPlan().toString()
    assert plan_.count("LeftSemi") == 2 and plan_.count("BroadcastHashJoin") == 2


@pytest.mark.parametrize("size", [1, 3, 40, 900])
def test_sketches_leave_all_links_possible(spark, size):
    prepare(spark)
    rng = np.random.default_rng(size)
    made, pairs, links = [], [], []
    for i in range(60):
        a = rng.integers(0, 2 ** 63, size, dtype=np.uint64)
        gone = rng.integers(0, max(1, size // 4) + 1)
        b = np.concatenate([a[gone:], rng.integers(0, 2 ** 63, rng.integers(0, size // 4 + 1), dtype=np.uint64)])
        for k, h in ((2 * i, a), (2 * i + 1, b)):
            made.append((k, len(h), bytearray(sketch(h, 1).tobytes())))
        pairs.append((2 * i, 2 * i + 1))
        links += [pairs[-1]] * bool(jj.linked(np.sort(a), np.sort(b), SIMILARITY))
    sizes = spark.createDataFrame(made, "node long, n long, sketch binary")
    others = [(2 * i, 2 * i + 2) for i in range(59)]
    got = {(r.a, r.b) for r in jj._possible(spark.createDataFrame(pairs + others, "a long, b long"), sizes, SIMILARITY).collect()}
    assert links and got >= set(links)
    assert size < 900 or not got & set(others)
