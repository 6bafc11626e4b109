"""JSON parse contract, quarantine split, encode."""

from pyspark.sql import types as T

from tidemark.functions.json import parse_json, parse_json_split, to_json_value

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("zip", T.IntegerType()),
                       T.StructField("city", T.StringType())])
CASES = [
    ('{"id":"a","zip":1409,"city":"x"}', ("a", 1409, "x")),
    ('{"id":"b","zip":"01409","city":"y"}', ("b", None, "y")),
    ('{"id":"c","city":"z"}', ("c", None, "z")),
    ('{"id":"d","zip":3.0,"city":"w","extra":1}', ("d", None, "w")),
    ('{"id":"e","zip":NaN}', ("e", None, None)),
    ('{"id":7,"zip":99999999999}', ("7", None, None)),
    ("not json", (None, None, None)),
    ("", (None, None, None)),
    (None, (None, None, None)),
    ('[{"id":"f"},{"id":"g"}]', (None, None, None)),
]


def _frame(spark):
    return spark.createDataFrame([(i, v) for i, (v, _) in enumerate(CASES)], "n int, value string")


def test_permissive_contract(spark):
    out = {r.n: (r.id, r.zip, r.city) for r in parse_json(_frame(spark), "value", SCHEMA, keep=["n"]).collect()}
    for i, (_, want) in enumerate(CASES):
        assert out[i] == want, (i, CASES[i][0])


def test_quarantine_split(spark):
    good, bad = parse_json_split(_frame(spark), "value", SCHEMA, required=["id"], keep=["n"])
    g = {r.n for r in good.collect()}
    b = {r.n: r.reason for r in bad.collect()}
    assert g | set(b) == set(range(len(CASES))) and not (g & set(b))
    assert b[6] == "malformed" and b[8] == "null value" and b[7].startswith("missing") or b[7] == "malformed"
    assert 1 in b  # a quoted number flags the record though other fields parsed
    assert 0 in g and 2 in g


def test_encode_leaves_out_nulls_and_round_trips(spark):
    df = spark.createDataFrame([("a", None, "x")], SCHEMA)
    v = to_json_value(df).first().value
    assert v == '{"id":"a","city":"x"}'
    back = parse_json(to_json_value(df), "value", SCHEMA).first()
    assert tuple(back) == ("a", None, "x")


def test_binary_value_is_cast(spark):
    df = spark.createDataFrame([(bytearray(b'{"id":"k","zip":5}'),)], "value binary")
    assert tuple(parse_json(df, "value", SCHEMA).first()) == ("k", 5, None)
