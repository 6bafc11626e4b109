"""Operator 13 against a per-row version, and its round trip."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, utf8
from tidemark.llm.fill_middle import digest, fill_in_middle, restored, unit_marks

ODD = ["", "a", " ", "ab cd", "é", "日本語 テキスト", "😀x😀yz", "@[`{AZaz09", "word\x00end", "a\nb\r\n\tc", "<P>", "x<S>y",
       "<M", "<<<<P", "ÀbcÀ", "z" * 5000, "a-" * 3000, "end<", "<"]


def expected(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = hashlib.sha256(("1:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def rows():
    rng = random.Random(5)
    chars = ["a", "Z", "b", " ", "é", "日", "😀", "<", ">", "P", "\n", "1", "~", "\x7f", "\x80"]
    texts = ODD + ["".join(rng.choice(chars) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    out = list(enumerate(texts)) + [(None, "no id at all"), (None, None), (7, ODD[6]), (3, "another text"), (-5, "negative id")]
    return out


def test_marks_are_unit_and_code_point_ends():
    import pyarrow as pa
    texts = [t for _, t in rows() if t is not None]
    off, body = utf8(pa.array(texts))
    ends, starts = unit_marks(off, body)
    got = np.diff(ends.rank(off)).tolist()
    assert got == [len(re.findall("[A-Za-z]+|[^A-Za-z]", t)) for t in texts]
    assert np.diff(starts.rank(off)).tolist() == [len(t) for t in texts]
    every = np.arange(1, ends.before[-1] + 1)
    assert (ends.rank(ends.select(every)) == every - 1).all() and (ends.rank(ends.select(every) + 1) == every).all()


def test_matches_a_per_row_version_and_round_trips(spark):
    prepare(spark)
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3) \
        .withColumns({"n": F.lit("x"), "form": F.lit(1), "output": F.lit(2.5), "__text": F.lit(0)})
    out = fill_in_middle(df).withColumn("back", restored())
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in out.collect()]
    want = [(d, *expected(d, t), t or "") for d, t in data]
    key = lambda r: (r[0] is None, r[0] or 0, r[-1])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    d = digest(fill_in_middle(df)).filter("doc_id = 3 and form <> 'x'").collect()
    assert all(len(r.output_sha256) == 64 for r in d)


def test_empty_table(spark):
    prepare(spark)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert digest(fill_in_middle(empty)).collect() == []


@pytest.mark.parametrize("spm", [0, 100])
def test_parameters(spark, spm):
    prepare(spark)
    df = spark.createDataFrame([(i, "some words here") for i in range(20)], "doc_id long, text string")
    forms = {r.form for r in fill_in_middle(df, plain_from=100, spm_below=spm).collect()}
    assert forms == {"spm" if spm else "psm"}
