"""Catalog tables and snapshots in plain Parquet."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from tidemark.operators.scd2 import compat_batch_merge, scd2_apply
from tidemark.plans import catalogue, snapshots, tables
from tidemark.plans.queries import change_set, dim_initial
from tidemark.session import scratch_path, stage


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _files(spark, name):
    return set(spark.table(name).inputFiles())


def test_replace_touches_only_its_partitions(spark):
    name = "tm_t_parts"
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", None)], "id int, s string, p int")
    tables.create_or_replace(df, name, ["p"], scratch_path(spark, "t", name))
    before = _files(spark, name)
    own = spark.table(name).filter("p = 2").withColumn("s", F.lit("new"))  # reads the table it replaces
    tables.replace_partitions(own, name)
    assert _rows(spark.table(name)) == _rows(spark.createDataFrame([(1, "a", 1), (2, "new", 2), (3, "c", None)], "id int, s string, p int"))
    after = _files(spark, name)
    assert {f for f in before if "p=2/" not in f} <= after and not {f for f in before if "p=2/" in f} & after
    tables.replace_partitions(spark.createDataFrame([(9, "z", None), (8, "y", 5)], "id int, s string, p int"), name)
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 2, 8, 9]
    tables.replace_partitions(spark.table(name).limit(0), name)  # no rows, no partition
    assert spark.table(name).count() == 4
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    catalogue.drop_table(spark, name)


def test_create_replace_and_ensure(spark):
    name = "tm_t_ddl"
    schema = spark.createDataFrame([], "id int, name string, p date").schema
    assert tables.ensure_table(spark, name, schema, ["p"], scratch_path(spark, "t", name)).count() == 0
    tables.replace_partitions(spark.createDataFrame([(1, "x", dt.date(2024, 1, 1))], schema), name)
    assert tables.ensure_table(spark, name, schema).count() == 1  # it is there: nothing happens
    tables.create_or_replace(spark.createDataFrame([(1.5,)], "w double"), name)
    assert spark.table(name).columns == ["w"]
    catalogue.drop_table(spark, name)
    with pytest.raises(ValueError):
        tables.ensure_table(spark, "bad name; drop", schema)


@pytest.mark.parametrize("buckets", [1, 8])
def test_merge_into_equals_scd2_apply(spark, buckets):
    dim = stage(dim_initial(spark, SF0001))
    ch = stage(change_set(spark, SF0001))
    for k, (rules, want) in enumerate((
            (dict(), scd2_apply(dim, ch, ["customer_id"], ["city"], "2024-06-01")),
            (dict(close_rule="any_match", insert_rule="always", null_safe=False),
             compat_batch_merge(dim, ch, ["customer_id"], ["city"], "2024-06-01")))):
        name = f"tm_t_merge_{buckets}_{k}"
        tables.create_keyed(dim, name, ["customer_id"], buckets, scratch_path(spark, "t", name))
        before = _files(spark, name)
        touched = tables.merge_into(name, ch, ["customer_id"], ["city"], "2024-06-01", buckets, **rules)
        assert _rows(spark.table(name).drop(tables.BUCKET)) == _rows(want)
        kept = {f for f in before if not any(f"{tables.BUCKET}={b}/" in f for b in touched)}
        assert kept <= _files(spark, name)  # buckets without a changed key keep their files
        assert tables.merge_into(name, ch.limit(0), ["customer_id"], ["city"], "2024-06-01", buckets) == []
        catalogue.drop_table(spark, name)


def test_snapshots_read_as_they_were(spark):
    root = scratch_path(spark, "t", "snapshots")
    snapshots.publish(spark.createDataFrame([(1, "a"), (2, "b")], "id int, attr string"), root, 1)
    snapshots.publish(spark.createDataFrame([(1, 1.0)], "id int, w double"), root, 2)
    assert snapshots.read(spark, root, 1).columns == ["id", "attr"] and snapshots.read(spark, root, 2).columns == ["id", "w"]
    wide = snapshots.read_evolved(spark, root, 1)
    assert set(wide.columns) == {"id", "attr", "w"} and wide.filter("w is not null").count() == 0 and wide.count() == 2
    listed = snapshots.snapshots(spark, root).orderBy("snapshot_id").collect()
    assert [(r.snapshot_id, r.rows) for r in listed] == [(1, 2), (2, 1)] and listed[0].committed_at <= listed[1].committed_at
    with pytest.raises(Exception, match="(?i)exist"):  # of two writers of a number the second fails
        snapshots.publish(spark.createDataFrame([(7,)], "id int"), root, 2)
    with pytest.raises(Exception, match="(?i)not_found|not exist"):
        snapshots.read(spark, root, 9)


def test_diff_counts_copies(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (2, "b"), (None, None)], "id int, attr string")
    b = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, None), (None, None)], "id int, attr string")
    assert _rows(snapshots.diff(a, b)) == sorted(
        [(2, "b", "removed"), (2, "b", "removed"), (3, "c", "added"), (None, None, "added")], key=str)
    assert snapshots.diff(a, a).count() == 0
    grown = snapshots.diff(spark.createDataFrame([(1,)], "id int"), spark.createDataFrame([(1, None), (2, "x")], "id int, s string"))
    assert _rows(grown) == [(2, "x", "added")]


def test_data_files_name_sizes_and_rows(spark):
    path = scratch_path(spark, "t", "files")
    spark.range(1000).repartition(3).write.parquet(path)
    got = tables.data_files(spark, path, f"{SF0001}/nation.parquet").collect()
    assert len(got) == 4 and sum(r.rows for r in got) == 1000 + spark.read.parquet(f"{SF0001}/nation.parquet").count()
    assert all(r.file_size > 0 and r.file_name.endswith(".parquet") for r in got)


def test_sql_with_bound_values(spark):
    df = spark.createDataFrame([(1, "it's", dt.date(2024, 1, 1)), (2, "x' OR '1'='1", dt.date(2024, 2, 1)), (3, None, None)],
                               "id int, s string, d date")
    run = lambda text, **args: sorted(r.id for r in catalogue.run_sql(spark, text, args, {"tm_bound": df}).collect())
    assert run("SELECT id FROM tm_bound WHERE s = :s", s="it's") == [1]
    assert run("SELECT id FROM tm_bound WHERE s = :s", s="x' OR '1'='1") == [2]
    assert run("SELECT id FROM tm_bound WHERE d >= :since", since=dt.date(2024, 1, 15)) == [2]
    assert run("SELECT id FROM tm_bound WHERE s <=> :s", s=None) == [3]
    assert run("SELECT id FROM IDENTIFIER(:t) WHERE id < :n", t="tm_bound", n=3) == [1, 2]
    with pytest.raises(Exception, match="(?i)unbound"):
        run("SELECT id FROM tm_bound WHERE s = :missing")


def test_bound_values_are_pushed_to_the_scan(spark):
    orders = spark.read.parquet(f"{SF0001}/orders.parquet")
    q = catalogue.run_sql(spark, "SELECT o_orderkey FROM tm_o WHERE o_custkey = :c", {"c": 7}, {"tm_o": orders})
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(o_custkey,7)" in plan
