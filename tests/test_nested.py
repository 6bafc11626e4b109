"""Nested fact (FIXTURES §4 'Nested') and the hot-parent split."""

from pyspark.sql import functions as F

from conftest import SF001
from tidemark.operators.nested import childless, flatten_items, nest_items, parents, with_many_items, without_items

PARENT = "order_id string, status string"
ITEMS = "order_id string, line int, product_id string, price_text string"


def _fixture(spark):
    parents = spark.createDataFrame(
        [("none", "p"), ("one", "p"), ("many", "f"), ("twins", "f"), ("nullprice", "f"), ("badprice", "f")],
        PARENT)
    items = spark.createDataFrame([
        ("one", 1, "x", "1.5"),
        ("many", 2, "y", "2.0"), ("many", 1, "x", "1.0"), ("many", 3, "z", "3.0"),
        ("twins", 1, "x", "9.9"), ("twins", 1, "x", "9.9"),
        ("orphan", 1, "q", "1.0"),
        ("nullprice", 1, "x", None),
        ("badprice", 1, "x", "not a number"),
    ], ITEMS)
    return parents, items


def _fields():
    return [F.col("line"), F.col("product_id"), F.expr("try_cast(price_text AS double)").alias("price")]


def test_nested_shapes(spark):
    parents, items = _fixture(spark)
    fact = {r.order_id: r for r in nest_items(parents, items, "order_id", _fields()).collect()}
    assert set(fact) == {"none", "one", "many", "twins", "nullprice", "badprice"}  # orphan dropped
    assert fact["none"].line_items is None and fact["none"].item_count == 0
    assert [i.line for i in fact["many"].line_items] == [1, 2, 3]  # fixed order
    assert fact["twins"].item_count == 2 and len(fact["twins"].line_items) == 2  # repeats kept
    assert fact["nullprice"].line_items[0].price is None
    assert fact["badprice"].line_items[0].price is None  # try_cast, not an ANSI error
    assert all(r.chunk == 0 for r in fact.values())


def test_filters(spark):
    orders, items = _fixture(spark)
    fact = nest_items(orders, items, "order_id", _fields())
    assert {r.order_id for r in with_many_items(fact).collect()} == {"many", "twins"}
    assert {r.order_id for r in without_items(fact).collect()} == {"none"}
    assert {r.order_id for r in childless(orders, items, "order_id").collect()} == {"none"}
    flat = flatten_items(fact)
    assert flat.count() == 8 + 1  # items with a parent + one null row for 'none'


def test_answers_do_not_depend_on_the_chunk_size(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    items = spark.read.parquet(f"{SF001}/lineitem.parquet").withColumnRenamed("l_orderkey", "o_orderkey")
    fields = [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_quantity")]
    whole = nest_items(orders, items, "o_orderkey", fields)
    split = nest_items(orders, items, "o_orderkey", fields, max_items=3)
    assert whole.filter("chunk > 0").count() == 0 and split.filter("chunk > 0").count() > 0
    for read in (flatten_items, parents, lambda f: parents(with_many_items(f)), lambda f: parents(without_items(f))):
        a, b = read(whole), read(split)
        assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert parents(split).count() == orders.count()


def test_hot_parent_of_identical_items_is_spread(spark):
    parents_ = spark.createDataFrame([("hot", "p"), ("cold", "p")], PARENT)
    items = spark.createDataFrame([("hot", 1, "x", "1.0")] * 400 + [("cold", 1, "y", "2.0")], ITEMS)
    fact = nest_items(parents_, items.repartition(4), "order_id", _fields(), max_items=20)
    hot = fact.filter("order_id = 'hot'").collect()
    assert len(hot) >= 8 and all(r.item_count == 400 for r in hot)
    assert sum(len(r.line_items) for r in hot) == 400
    assert max(len(r.line_items) for r in hot) <= 100
    cold = fact.filter("order_id = 'cold'").collect()
    assert len(cold) == 1 and cold[0].chunk == 0 and cold[0].item_count == 1


def test_building_the_plan_runs_no_job(spark):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    orders, items = _fixture(spark)
    nest_items(orders, items, "order_id", _fields())
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == list(before)
