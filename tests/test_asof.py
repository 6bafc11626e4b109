"""As-of join against a nested loop, type inference, sketches, array sizes."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.asof import as_of_join
from tidemark.operators.dedupe import distinct_sketches, estimated_keys, merge_sketches, sketch_error
from tidemark.operators.nested import array_sizes, larger_than, nest_items
from tidemark.operators.scd2 import Validity
from tidemark.session import scratch_path
from tidemark.sources.csv import inferred_types, read_csv, read_csv_inferred, type_counts, typed

V = Validity("t0", "t1", "live")


def _versions(rng, keys):
    """Versions of each key that do not overlap; some with gaps, some open."""
    rows = []
    for k in keys:
        t = rng.randint(0, 10)
        for i in range(rng.randint(0, 6)):
            end = t + rng.randint(1, 12)
            open_ = i == 5
            rows.append((k, f"{k}-{i}", t, None if open_ else end, open_))
            t = end + rng.choice([0, 0, 3])
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("segment", [None, 1, 7, 1000])
def test_as_of_join_matches_a_nested_loop(spark, seed, segment):
    rng = random.Random(seed)
    versions = _versions(rng, [1, 2, 3, None, 5])
    events = [(i, rng.choice([1, 1, 1, 2, 3, 4, None]), rng.choice([None, *range(-2, 60)])) for i in range(150)]
    events += events[:5]  # repeated rows
    h = spark.createDataFrame(versions, "k int, attr string, t0 int, t1 int, live boolean").repartition(3)
    e = spark.createDataFrame(events, "id int, k int, at int").repartition(3)
    bucket = None if segment is None else (lambda t: F.floor(t / segment))
    got = as_of_join(e, h, ["k"], "at", ["attr", "t0"], V, bucket)
    want = []
    for i, k, at in events:
        hit = [(a, t0) for kk, a, t0, t1, _ in versions
               if k is not None and at is not None and kk == k and t0 <= at and (t1 is None or at < t1)]
        want.append((i, k, at, *(hit[0] if hit else (None, None))))
    assert got.columns == ["id", "k", "at", "attr", "t0"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    inner = as_of_join(e, h, ["k"], "at", ["attr"], V, bucket, how="inner")
    assert inner.count() == sum(r[3] is not None for r in want) > 10


def test_as_of_join_of_empty_sides_and_errors(spark):
    h = spark.createDataFrame([], "k int, attr string, t0 int, t1 int, live boolean")
    e = spark.createDataFrame([(1, 5)], "k int, at int")
    assert [tuple(r) for r in as_of_join(e, h, ["k"], "at", ["attr"], V, lambda t: t).collect()] == [(1, 5, None)]
    assert as_of_join(e.limit(0), h, ["k"], "at", ["attr"], V).collect() == []
    with pytest.raises(ValueError):
        as_of_join(e, h.withColumnRenamed("attr", "at"), ["k"], "at", ["at"], V)
    with pytest.raises(ValueError):
        as_of_join(e, h, ["k"], "at", ["attr"], V, how="outer")


def test_as_of_join_spreads_a_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        h = spark.range(200).select(F.lit(1).alias("k"), F.col("id").alias("attr"), (F.col("id") * 5).cast("int").alias("t0"),
                                    ((F.col("id") + 1) * 5).cast("int").alias("t1"), F.lit(False).alias("live"))
        e = spark.range(1000).select(F.col("id"), F.lit(1).alias("k"), F.col("id").cast("int").alias("at"))
        out = as_of_join(e, h, ["k"], "at", ["attr"], V, lambda t: F.floor(t / 50))
        rows = out.withColumn("pid", F.spark_partition_id()).collect()
        assert len({r.pid for r in rows}) >= 3 and all(r.attr == r.at // 5 for r in rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_types_out_of_one_counting_pass(spark):
    rows = [("1", "2147483648", "99999999999999999999", "1.5", "true", "2024-01-31", "2024-01-31 10:00:00", "x", None, "7"),
            ("-2", " 5 ", "1", "2", "FALSE", "2023-12-01", "2024-01-31T10:00:00.5", "1", "", "oops"),
            (None, "7", "2", "1e3", "true", "2024-02-30", "2024-01-31", "2", None, "8"),
            ("+3", "", "3", ".5", "True", "2024-01-01", "2024-01-31 10:00", "3", "", "9")]
    names = "i l d f b day at s none dirty".split()
    raw = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    got = {r.column_name: (r.type, r.filled, r.misfit) for r in inferred_types(type_counts(raw)).collect()}
    assert got == {"i": ("int", 3, 0), "l": ("bigint", 3, 0), "d": ("decimal(38,0)", 4, 0), "f": ("double", 4, 0),
                   "b": ("boolean", 4, 0), "day": ("string", 4, 0), "at": ("timestamp_ntz", 4, 0), "s": ("string", 4, 0),
                   "none": ("string", 0, 0), "dirty": ("string", 4, 0)}
    lax = {r.column_name: (r.type, r.misfit) for r in inferred_types(type_counts(raw), 0.25).collect()}
    assert lax["day"] == ("date", 1) and lax["dirty"] == ("int", 1) and lax["s"] == ("int", 1)
    out = typed(raw, {k: t for k, (t, _) in lax.items()}).collect()
    assert [r.misfits for r in out] == [["s"], ["dirty"], ["day"], []]
    assert [r.i for r in out] == [1, -2, None, 3] and out[0].l == 2147483648 and out[3].l is None and out[1].dirty is None
    # the same counts whatever the order of rows and partitions
    again = {r.column_name: r.type for r in inferred_types(type_counts(raw.orderBy(F.desc("s")).repartition(4))).collect()}
    assert again == {k: t for k, (t, *_) in got.items()}


def test_inferred_read_of_files_and_empty_tables(spark):
    path = scratch_path(spark, "t", "csv-infer")
    spark.createDataFrame([(1, "a,b"), (2, 'q"x')], "id long, s string").write.option("header", True).csv(path)
    df = read_csv_inferred(spark, path)
    assert dict(df.dtypes) == {"id": "int", "s": "string", "misfits": "array<string>"}
    assert sorted(r.s for r in df.collect()) == ["a,b", 'q"x']
    none = spark.createDataFrame([], "a string, b string")
    assert [(r.type, r.filled) for r in inferred_types(type_counts(none)).collect()] == [("string", 0)] * 2
    assert read_csv(spark, path, infer=True).dtypes[0] == ("id", "int")


def test_merged_sketches_stay_within_their_bound(spark):
    df = spark.range(60_000).select((F.col("id") % 6).alias("day"), (F.col("id") % 20_011).alias("key"),
                                    F.when(F.col("id") % 3 > 0, F.col("id") % 101).alias("few"))
    for key, lg in (("key", 14), ("key", 10), ("few", 14)):
        daily = distinct_sketches(df, ["day"], key, lg)
        all_ = estimated_keys(merge_sketches(daily)).first()
        exact = df.agg(F.count_distinct(key).alias("n")).first().n
        assert all_.row_count == 60_000 and abs(all_.key_estimate - exact) <= max(1, 3 * sketch_error(lg) * exact)
        whole = estimated_keys(distinct_sketches(df, [], key, lg)).first()
        assert whole.key_estimate == pytest.approx(all_.key_estimate, rel=3 * sketch_error(lg))
        for r in estimated_keys(daily).collect():
            n = df.filter(F.col("day") == r.day).agg(F.count_distinct(key).alias("n")).first().n
            assert abs(r.key_estimate - n) <= max(1, 3 * sketch_error(lg) * n)
    nulls = estimated_keys(distinct_sketches(spark.createDataFrame([(1, None)], "day int, key long"), ["day"], "key")).first()
    assert (nulls.row_count, nulls.keyed_rows, nulls.key_estimate) == (1, 0, 0)
    assert estimated_keys(merge_sketches(distinct_sketches(df.limit(0), ["day"], "key"), ["day"])).collect() == []


def test_sizes_are_per_parent_whatever_the_chunks(spark):
    parent = spark.createDataFrame([(0, "hot"), (1, "one"), (2, "three"), (3, "none")], "k int, name string")
    items = spark.range(900).select(F.lit(0).alias("k"), F.col("id").alias("x")) \
        .unionByName(spark.createDataFrame([(1, 5), (2, 5), (2, 5), (2, 6), (9, 1)], "k int, x long"))
    for size in (5, 100, 10_000):
        fact = nest_items(parent, items, "k", ["x"], max_items=size)
        assert {r.k: r["items"] for r in array_sizes(fact, "k").collect()} == {0: 900, 1: 1, 2: 3, 3: 0}
        big = larger_than(fact, "k", 2)
        assert {r.k for r in big.collect()} == {0, 2}
        assert sum(len(r.line_items) for r in big.collect()) == 903
