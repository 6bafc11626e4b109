"""Operator 3: secret scans over an incremental blob ledger.  DataFrame
functions only.

A document version is a *path* (its id) and a *blob* (its text, addressed by
its SHA-256).  The ledger holds one row per blob and rule version with that
pair's findings.  A scan takes the distinct blobs of the given versions,
drops the pairs the ledger holds already, scans each remaining text once, and
joins all findings back to every path that holds the blob, in any version.

Findings are ``kind:start:end`` in code points, end exclusive, of the whole
match; matches of one kind never overlap (leftmost first), and a match that
fails its kind's length is dropped with the text it covers.

Edge cases: a null text is the empty blob and has no findings; repeated rows
give repeated result rows; extra columns are ignored; null ids stay null.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """``checked`` is the group that must hold ``least`` characters."""

    kind: str
    pattern: str
    checked: int
    least: int
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}/{self.version}"


# The base rules, and two rules of our own after them.
KEYWORD = "(" + "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token")) \
    + "|" + _any_case("api") + "_?" + _any_case("key") + ")"
ASSIGN = Rule("assign", KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6)
ACCESS = Rule("access", "AKIA[A-Z0-9]+", 0, 20)
HEX = Rule("hex", "[0-9a-f]+", 0, 24)
PEM = Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1)
JWT = Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30)
BASE_RULES = (ASSIGN, ACCESS, HEX)
RULES = (*BASE_RULES, PEM, JWT)

#: For a rule that most texts match somewhere: a cheaper pattern that each
#: passing match contains.
_GATE = {"hex": "[0-9a-f]{24}", "access": "AKIA[A-Z0-9]{16}"}

#: Code points of the pieces that a redacted text is rebuilt from.
PIECE = 4096

FINDINGS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("rank", T.IntegerType()),
                                     T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())]))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _scanned(items: Column, start: Column, after: Callable[[Column], Column], joined: Callable[[Column, Column], Column],
             step: Callable[[Column, Column], Column], out: str) -> Column:
    """A running scan over an array of any length: ``step`` folds an item into
    ``{at, out}`` and adds to the array ``out`` (of SQL type ``out``).

    Adding to an array copies it, so the items are cut into about as many
    blocks as each holds.  ``after`` gives a block's own effect on ``at`` and
    ``joined`` adds it up; so each block knows where it starts, is scanned
    alone, and the blocks' outputs are put together once.
    """
    none = F.array().cast(out)

    def run(a: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(a))), F.lit(1)).cast("int")
        last = F.greatest(F.ceil(F.size(a) / width) - 1, F.lit(0)).cast("int")
        return _bound(F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(a, b * width + 1, width)), scan_blocks)

    def scan_blocks(blocks_: Column) -> Column:
        begins = F.aggregate(
            F.transform(blocks_, after), F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("begins")),
            lambda s, t: F.struct(joined(s["at"], t).alias("at"), F.concat(s["begins"], F.array(s["at"])).alias("begins")),
            lambda s: s["begins"])
        return F.flatten(F.zip_with(blocks_, begins, lambda block, at: F.aggregate(
            block, F.struct(at.alias("at"), none.alias("out")), step, lambda s: s["out"])))

    return _bound(items, run)


def matches(text: str, rule: Rule, rank: int = 0) -> Column:
    """Passing matches as ``start, rank, end, kind``.

    The text split at the matches gives the gaps between them, so positions
    are running sums of gap and match lengths.
    """
    pat = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pat, F.lit(0))
    checked = whole if rule.checked == 0 else F.regexp_extract_all(text, pat, F.lit(rule.checked))
    steps = F.zip_with(F.split(text, rule.pattern, -1), F.arrays_zip(whole.alias("w"), checked.alias("c")),
                       lambda gap, m: F.struct(F.length(gap).cast("long").alias("gap"),
                                               F.coalesce(F.length(m["w"]), F.lit(0)).cast("long").alias("len"),
                                               F.length(m["c"]).alias("chk")))

    def step(s: Column, x: Column) -> Column:
        start, end = s["at"] + x["gap"], s["at"] + x["gap"] + x["len"]
        found = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"),
                                 F.lit(rule.kind).alias("kind")))
        return F.struct(end.alias("at"), F.when(x["chk"] >= rule.least, F.concat(s["out"], found))
                        .otherwise(s["out"]).alias("out"))

    gate = F.col(text).rlike(_GATE.get(rule.kind, rule.pattern))
    length = lambda block: F.aggregate(block, F.lit(0).cast("long"), lambda n, x: n + x["gap"] + x["len"])
    found = _scanned(steps, F.lit(0).cast("long"), length, lambda a, b: a + b, step, FINDINGS.simpleString())
    return F.when(gate, found).otherwise(F.array().cast(FINDINGS))


def blobs(versions: DataFrame, text_col: str = "text") -> DataFrame:
    """``blob, __text``: one row per distinct text.  Copies collapse in every
    map task before the shuffle."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return versions.select(F.sha2(text, 256).alias("blob"), text.alias("__text")) \
        .groupBy("blob").agg(F.first("__text").alias("__text"))


def scan(blobs_df: DataFrame, rules: Sequence[Rule] = RULES, ledger: DataFrame | None = None) -> DataFrame:
    """New ledger rows ``blob, rule, findings`` for the unseen pairs.

    A pair with no findings gets a row too: that is what marks it as seen.
    Pairs are decided by one anti-join on the blob; a rule that a blob has
    seen is not evaluated on it.
    """
    names = F.array(*[F.lit(r.name) for r in rules])
    if ledger is None:
        todo = blobs_df.withColumn("__todo", names)
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set("rule").alias("__seen"))
        todo = blobs_df.join(seen, "blob", "left").withColumn(
            "__todo", F.array_except(names, F.coalesce("__seen", F.array().cast("array<string>")))) \
            .filter(F.size("__todo") > 0)
    found = [F.when(F.array_contains("__todo", r.name), F.struct(
        F.lit(r.name).alias("rule"), matches("__text", r, i).alias("findings"))) for i, r in enumerate(rules)]
    rows = todo.select("blob", F.filter(F.array(*found), lambda x: x.isNotNull()).alias("__rows"))
    return rows.select("blob", F.explode("__rows").alias("r")).select("blob", "r.rule", "r.findings")


def join_paths(versions: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, blob, findings``: every path with all findings of its blob,
    ordered by start, then rule."""
    want = [r.name for r in rules]
    by_blob = ledger.filter(F.col("rule").isin(want) & (F.size("findings") > 0)).groupBy("blob").agg(
        F.array_sort(F.flatten(F.collect_list("findings"))).alias("findings"))
    paths = versions.select(F.col(id_col).alias("doc_id"),
                            F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("blob"))
    return paths.join(by_blob, "blob", "left").select(
        "doc_id", "blob", F.coalesce("findings", F.array().cast(FINDINGS)).alias("findings"))


def scan_secrets(versions: DataFrame, rules: Sequence[Rule] = RULES, ledger: DataFrame | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Scan ``versions`` against ``ledger``; returns ``(paths with findings,
    new ledger rows)``.  The new rows are written to the shared folder;
    append them to the ledger before the next scan."""
    new = written(scan(blobs(versions, text_col), rules, ledger), "secret-ledger")
    whole = new if ledger is None else ledger.select("blob", "rule", "findings").unionByName(new)
    return join_paths(versions, whole, rules, id_col, text_col), new


def span_digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the base spans' SHA-256 and all spans."""
    kinds = [r.kind for r in BASE_RULES]
    spans = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("findings", lambda x: x["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in kinds],
                        F.sha2(spans(F.filter("findings", lambda x: x["kind"].isin(kinds))), 256).alias("base_sha256"),
                        spans(F.col("findings")).alias("spans"))


def redact_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text",
                   mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every finding in its text replaced by ``mask``; overlapping
    findings of several kinds become one mask.  All rows and columns stay.

    Texts without findings are left alone; the others are rebuilt from the
    gaps between the merged spans, which are taken from pieces of ``PIECE``
    code points, so that no gap costs a walk through the whole text.
    """
    at = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    d = docs.select(*[F.col(f"`{c}`").alias(at[c]) for c in docs.columns])
    text = at[text_col]
    _, new = scan_secrets(d, rules, None, text, text)
    hits = new.filter(F.size("findings") > 0).groupBy("blob").agg(
        F.array_sort(F.flatten(F.collect_list("findings"))).alias("__f"))
    d = d.withColumn("__blob", F.sha2(F.coalesce(F.col(text), F.lit("")), 256)) \
        .join(hits.withColumnRenamed("blob", "__blob"), "__blob", "left")

    def step(s: Column, x: Column) -> Column:
        gap = F.array(F.struct(s["at"].alias("start"), x["start"].alias("end")))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"),
                        F.when(x["start"] >= s["at"], F.concat(s["out"], gap)).otherwise(s["out"]).alias("out"))

    furthest = lambda block: F.aggregate(block, F.lit(0).cast("long"), lambda n, x: F.greatest(n, x["end"]))
    gaps = _scanned(F.col("__f"), F.lit(0).cast("long"), furthest, F.greatest, step, "array<struct<start:bigint,end:bigint>>")
    tail = F.struct(furthest(F.col("__f")).alias("start"), F.length(text).cast("long").alias("end"))

    def piece(pieces: Column, g: Column, i: Column) -> Column:
        first = i.cast("long") * PIECE
        begin = F.greatest(g["start"] - first, F.lit(0))
        return F.substring(F.get(pieces, i), (begin + 1).cast("int"), (F.least(g["end"] - first, F.lit(PIECE)) - begin).cast("int"))

    def between(pieces: Column, g: Column) -> Column:
        ends = [F.floor(x / PIECE).cast("int") for x in (g["start"], g["end"] - 1)]
        return F.when(g["end"] <= g["start"], F.lit("")).otherwise(
            F.array_join(F.transform(F.sequence(ends[0], F.greatest(*ends)), lambda i: piece(pieces, g, i)), ""))

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    rebuilt = _bound(pieces, lambda p: F.array_join(F.transform(F.concat(gaps, F.array(tail)), lambda g: between(p, g)), mask))
    masked = F.when(F.col("__f").isNull(), F.col(text)).otherwise(rebuilt)
    return d.select(*[(masked if c == text_col else F.col(at[c])).alias(c) for c in docs.columns])
