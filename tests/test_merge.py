"""The hand-made merge table (FIXTURES §4) in both rule sets, and merge
invariants."""

from pyspark.sql import functions as F

from tidemark.operators.scd2 import Validity, compat_batch_merge, compat_stream_merge, scd2_apply

V = Validity("t0", "t1", "live")
SCHEMA = "id string, attr string, t0 int, t1 int, live boolean"
TARGET = [
    ("same", "A", 0, None, True),
    ("chg", "A", 0, None, True),
    ("dup", "A", 0, None, True),
    ("dup", "B", 0, None, True),
    ("nullattr", None, 0, None, True),
    ("old", "A", 0, 1, False),
]
CHANGES = [("same", "A"), ("chg", "Z"), ("dup", "Z"), ("nullattr", "Q"), ("new", "N"),
           ("old", "A"), (None, "X")]


def _frames(spark):
    target = spark.createDataFrame(TARGET, SCHEMA)
    changes = spark.createDataFrame(CHANGES, "id string, attr string")
    return target, changes


def _rows(df):
    return sorted((r.id or "~null", r.attr or "~null", r.live, r.t0, r.t1) for r in df.collect())


def test_compat_stream_rules(spark):
    target, changes = _frames(spark)
    out = compat_stream_merge(target, changes, ["id"], ["attr"], 9, V)
    assert _rows(out) == sorted([
        ("chg", "A", False, 0, 9), ("chg", "Z", True, 9, None),
        ("dup", "A", False, 0, 9), ("dup", "B", False, 0, 9), ("dup", "Z", True, 9, None),
        ("new", "N", True, 9, None),
        ("nullattr", "~null", True, 0, None), ("nullattr", "Q", True, 9, None),
        ("old", "A", False, 0, 1), ("old", "A", True, 9, None),
        ("same", "A", True, 0, None), ("same", "A", True, 9, None),
        ("~null", "X", True, 9, None),
    ])


def test_sound_rules(spark):
    target, changes = _frames(spark)
    out = scd2_apply(target, changes, ["id"], ["attr"], 9, V)
    assert _rows(out) == sorted([
        ("chg", "A", False, 0, 9), ("chg", "Z", True, 9, None),
        ("dup", "A", False, 0, 9), ("dup", "B", False, 0, 9), ("dup", "Z", True, 9, None),
        ("new", "N", True, 9, None),
        ("nullattr", "~null", False, 0, 9), ("nullattr", "Q", True, 9, None),
        ("old", "A", False, 0, 1), ("old", "A", True, 9, None),
        ("same", "A", True, 0, None),
        ("~null", "X", True, 9, None),
    ])


def test_batch_compat_closes_every_match(spark):
    target, changes = _frames(spark)
    out = compat_batch_merge(target, changes, ["id"], ["attr"], 9, V)
    rows = _rows(out)
    # L15: an unchanged city is closed and inserted again.
    assert ("same", "A", False, 0, 9) in rows and ("same", "A", True, 9, None) in rows
    # a null attribute is closed too (any match)
    assert ("nullattr", "~null", False, 0, 9) in rows
    assert len(rows) == 13


def test_sound_merge_is_idempotent(spark):
    target, changes = _frames(spark)
    once = scd2_apply(target, changes, ["id"], ["attr"], 9, V)
    twice = scd2_apply(once, changes.filter(F.col("id").isNotNull()), ["id"], ["attr"], 9, V)
    assert _rows(once) == _rows(twice)


def test_sound_merge_repairs_stale_open_rows(spark):
    # A key with one stale and one right open row keeps the right one.
    target = spark.createDataFrame([("k", "A", 0, None, True), ("k", "Z", 5, None, True)], SCHEMA)
    changes = spark.createDataFrame([("k", "Z")], "id string, attr string")
    out = _rows(scd2_apply(target, changes, ["id"], ["attr"], 9, V))
    assert out == [("k", "A", False, 0, 9), ("k", "Z", True, 5, None)]


def test_duplicate_changes_deduped_by_order(spark):
    target = spark.createDataFrame([("k", "A", 0, None, True)], SCHEMA)
    changes = spark.createDataFrame([("k", "B", 1), ("k", "C", 2)], "id string, attr string, seq int")
    got = _rows(scd2_apply(target, changes, ["id"], ["attr"], 9, V, dedupe_by=["seq"]))
    assert got == [("k", "A", False, 0, 9), ("k", "C", True, 9, None)]


def test_latest_per_key_with_map_payload(spark):
    from tidemark.operators.dedupe import latest_per_key
    df = spark.createDataFrame([(1, 1, {"a": 1}, [{"x": 1}]), (1, 2, {"b": 2}, [{"y": 2}])],
                               "k int, t int, m map<string,int>, am array<map<string,int>>")
    got = latest_per_key(df, ["k"], ["t"]).first()
    assert got.m == {"b": 2} and got.am == [{"y": 2}]


def test_several_tracked_columns_and_rule_errors(spark):
    import pytest
    from tidemark.operators.scd2 import history_from_log
    schema = "id string, a string, b string, t0 int, t1 int, live boolean"
    target = spark.createDataFrame([("k", "x", "y", 0, None, True), ("m", "x", "y", 0, None, True)], schema)
    changes = spark.createDataFrame([("k", "x", "z"), ("m", "x", "y")], "id string, a string, b string")
    out = sorted(tuple(r) for r in scd2_apply(target, changes, ["id"], ["a", "b"], 9, V).collect())
    # only k changed (in b); m is unchanged in both tracked columns
    assert out == [("k", "x", "y", 0, 9, False), ("k", "x", "z", 9, None, True), ("m", "x", "y", 0, None, True)]
    with pytest.raises(ValueError):
        scd2_apply(target, changes, ["id"], ["a"], 9, V, close_rule="sometimes")
    log = spark.createDataFrame([("k", 1, "x", "y")], "id string, ts int, a string, b string")
    with pytest.raises(ValueError):
        history_from_log(log, ["id"], ["a", "b"], "ts", mode="compat")


def test_key_history_as_of_and_semi_join(spark):
    from tidemark.operators.scd2 import as_of, history_of_keys, key_history
    h = spark.createDataFrame([("k", "A", 0, 5, False), ("k", "B", 5, None, True), ("m", "A", 0, None, True)],
                              SCHEMA)
    assert [r.attr for r in key_history(h, "id", "k", V).collect()] == ["A", "B"]
    keys = spark.createDataFrame([("m",), ("m",)], "id string")
    assert [(r.id, r.attr) for r in history_of_keys(h, keys, ["id"], V).collect()] == [("m", "A")]
    assert sorted((r.id, r.attr) for r in as_of(h, 3, V).collect()) == [("k", "A"), ("m", "A")]
    assert sorted((r.id, r.attr) for r in as_of(h, 5, V).collect()) == [("k", "B"), ("m", "A")]


def test_rows_with_a_null_flag_stay(spark):
    target = spark.createDataFrame([(1, "a", 0, None, True), (2, "b", 0, None, None), (3, "c", 0, 5, False)],
                                   "id int, attr string, t0 int, t1 int, live boolean")
    changes = spark.createDataFrame([(1, "z"), (2, "y")], "id int, attr string")
    got = {(r.id, r.attr, r.t1, r.live) for r in scd2_apply(target, changes, ["id"], ["attr"], 9, V).collect()}
    assert got == {(1, "a", 9, False), (1, "z", None, True), (2, "b", None, None), (2, "y", None, True), (3, "c", 5, False)}


def test_several_changes_for_one_open_row_raise(spark):
    import pytest
    target = spark.createDataFrame([("x", "a", 0, None, True)], "id string, attr string, t0 int, t1 int, live boolean")
    twice = spark.createDataFrame([("x", "b"), ("x", "c")], "id string, attr string")
    for rules in ({}, {"close_rule": "any_match", "insert_rule": "always", "null_safe": False}):
        with pytest.raises(Exception, match="several changes"):
            scd2_apply(target, twice, ["id"], ["attr"], 9, V, **rules).collect()
    # Unmatched and null keys may repeat: nothing is closed twice.
    new = spark.createDataFrame([("n", "b"), ("n", "c"), (None, "d"), (None, "e")], "id string, attr string")
    assert scd2_apply(target, new, ["id"], ["attr"], 9, V, insert_rule="always").count() == 5


def test_insert_arm_follows_the_close_rule(spark):
    """Several open rows, null keys, repeated unmatched keys, in every rule set:
    a change is inserted unless a row of its key stays open."""
    import itertools
    target = spark.createDataFrame([("a", "x", 0, None, True), ("a", "y", 1, None, True), ("b", None, 0, None, True),
                                    ("c", "x", 0, 3, False), (None, "x", 0, None, True)], SCHEMA)
    changes = [("a", "y"), ("b", None), ("c", "x"), (None, "x"), ("n", "q"), ("n", "r")]
    df = spark.createDataFrame(changes, "id string, attr string")
    for close, insert, safe in itertools.product(("changed", "any_match"), ("new_or_changed", "always"), (True, False)):
        rows = scd2_apply(target, df, ["id"], ["attr"], 9, V, close, insert, safe).collect()
        old = [(r.id, r.attr, r.live) for r in rows if r.t0 != 9]
        open_ = {k for k, _, live in old if live}
        new = sorted(((r.id, r.attr) for r in rows if r.t0 == 9), key=str)
        want = [c for c in changes if insert == "always" or c[0] is None or c[0] not in open_]
        assert new == sorted(want, key=str), (close, insert, safe)
