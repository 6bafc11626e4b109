"""The registered queries on the smallest tables, and the pipeline's stages
against brute force."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF0001
from oracle_check import compare, duck
from tidemark.llm import near_sketch, quality
from tidemark.llm.common import prepare
from tidemark.llm.oracle import ORACLE_SQL
from tidemark.llm.queries import QUERIES


def test_every_operator_is_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    ok, message = compare(spark, SF0001, name, E.queries()[name], ORACLE_SQL[name], duck(SF0001))
    assert ok, message


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_covers_its_table(spark, name):
    table, key = {"op10": ("pages", "page_id"), "op12": ("embeddings", "vec_id")}.get(name.split("_")[0], ("documents", "doc_id"))
    got = E.queries()[name](spark, SF0001).select(key).distinct()
    every = spark.read.parquet(f"{SF0001}/{table}.parquet")
    if name.startswith("op8"):
        bench = spark.read.parquet(f"{SF0001}/benchmark.parquet").select(F.col("text").alias("item"))
        leaks = every.join(bench, F.col("text").contains(F.col("item"))).select(key).distinct()
        assert leaks.join(got, key, "left_anti").count() == 0
    else:
        assert got.count() == every.count()


def documents(spark):
    rng = random.Random(7)
    # Words of letters: the references are those of prose, whatever the table holds.
    vocabulary = [*quality.COMMON_WORDS[:12], *("word" + "".join("abcdefghij"[int(d)] for d in str(i)) for i in range(300))]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = text(150)
    item = text(25)
    rows = [(i, text(rng.randint(60, 200)), "en", "s", 1) for i in range(30)]
    rows += [(100, base, "en", "s", 2), (101, base, "en", "s", 2), (102, base + " tail", "fr", None, None),
             (103, "too short", "en", "s", 3), (104, "same words again " * 60, "en", "s", 4), (105, None, None, None, None),
             (106, text(40) + " " + item + " " + text(30), "en", "s", 5),
             (107, text(50) + " password = hunter2secret " + text(20), "en", "s", 6), (None, text(90), None, "s", 7),
             (30, rows[0][1] + " x", "en", "s", 8)]
    rows.append(rows[3])
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return rows, item, docs.repartition(4)


def test_stages_take_effect_and_keep_clean_documents(spark, tmp_path):
    prepare(spark)
    rows, item, docs = documents(spark)
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    left = {}
    now = spark.read.parquet(f"{sf}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, sf)
        out.write.parquet(f"{sf}/{k}")
        before, now = now, spark.read.parquet(f"{sf}/{k}")
        left[name] = now
        if name != "packing":
            assert now.schema == before.schema
    ids = lambda n: sorted((r.doc_id for r in left[n].select("doc_id").collect()), key=str)
    clean = [*range(30), None]
    assert ids("quality_rules") == sorted([*clean, 3, 30, 100, 101, 102, 106, 107], key=str)
    assert ids("near_dedup") == sorted([*clean, 100, 106, 107], key=str)
    assert ids("decontamination") == sorted([*clean, 100, 107], key=str) == ids("secret_scan")
    texts = {r.doc_id: (r.text, r.n_chars) for r in left["secret_scan"].collect()}
    for d, text, _, _, n in rows:
        if d in texts and d != 107:
            assert texts[d] == (text, n)
    masked = rows[-4][1].replace("password = hunter2secret", "[SECRET]")
    assert texts[107] == (masked, len(masked))
    packed = left["packing"]
    assert {r.doc_id for r in packed.collect()} == set(texts)
    pieces = lambda df: sorted(df.select("doc_id", "start", "length", "ids_crc32").collect(), key=str)
    assert pieces(corpus_pipeline.run(spark, sf)) == pieces(packed)


def test_stages_take_empty_tables_and_clashing_names(spark, tmp_path):
    prepare(spark)
    spark.createDataFrame([(1, "a benchmark item of some length")], "item_id long, text string") \
        .write.parquet(f"{tmp_path}/benchmark.parquet")
    _, _, docs = documents(spark)
    extra = docs.withColumns({c: F.lit(None).cast("string") for c in (
        "_c0", "_u", "__f", "__blob", "_plain", "class_id", "kept", "a.b", "n_chars_before", "item_id")})
    for name, stage in corpus_pipeline.STAGES:
        for df in (extra, extra.limit(0)):
            out = stage(spark, df, str(tmp_path))
            assert (out.count() > 0) == (df is extra)
            if name != "packing":
                assert out.schema.names == extra.schema.names


def test_the_rest_works_without_the_subpackage():
    """The entry module offers the library's own queries alone."""
    import subprocess
    import sys

    code = ("import sys\nclass Gone:\n  def find_spec(self, name, *a):\n"
            "    if name.startswith(('tidemark.llm', 'corpus_pipeline')): raise ModuleNotFoundError(name)\n"
            "sys.meta_path.insert(0, Gone())\nimport __spark_entry__ as E\n"
            "assert E.queries() and not [q for q in E.queries() if q.startswith('op') or q == 'pipeline']\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=E.__file__.rsplit("/", 1)[0])


def test_fewer_words_than_a_shingle_are_one_feature():
    import numpy as np

    body = np.frombuffer(b"one two", np.uint8)
    first, h, n = near_sketch.shingles(np.array([0, 7]), body)
    assert first.tolist() == [0, 1] and len(h) == 1 and n.tolist() == [1]
