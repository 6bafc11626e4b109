"""Operator 7: quality rules by distribution divergence.  DataFrame functions
only.

Each document's histogram of character classes and of common function words is
compared with two references of its language, by the Jensen-Shannon distance
(base 2, in [0, 1]); the greater distance counts.  One reference holds fixed
values of everyday prose.  The other is the table's own: the shares of all
documents of that language that the base rule and the fixed reference keep.
Each of them counts the same, however long, and one below the minimum mass in
proportion; what those reject moves no verdict, whatever its share.  A
histogram is judged only above a minimum mass, so short texts are never
rejected for chance.

The first part of ``lang`` counts (``en-GB`` is ``en``), in any case.  A
language without fixed values (a null or empty one too, which are one) has a
fixed reference of classes, where letters outside ASCII count as lower case,
since its script is not known; its common words are compared with the table's
own alone.

Edge cases: a null or empty text has no words, fails the base rule and has
distance 0; repeated rows are judged one by one; other columns, whatever their
names, pass through ``quality_filter`` and are dropped by ``quality_rules``.
Each text is read once: ``quality_rules`` writes its counts, ``quality_filter``
the rows with their counts.  No text is shuffled, unless a table has more
languages than are broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

WORD_GAP = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MARKS = ".,;:!?"

# Frequent function words of four languages, the bins of the
# word histogram.
COMMON_WORDS = ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "with", "on",
                "der", "die", "und", "das", "ist", "nicht", "ein", "mit", "auf", "für", "zu",
                "le", "la", "les", "des", "et", "une", "est", "que", "dans", "pour", "un", "du",
                "el", "los", "las", "una", "con", "por", "para", "del", "se", "como", "de", "en"]

# Rounded frequencies per thousand words of everyday prose.
COMMON_PER_THOUSAND = {
    "en": {"the": 62, "of": 30, "and": 28, "to": 26, "in": 20, "is": 11, "that": 11, "it": 11, "for": 9, "was": 9,
           "with": 7, "on": 7},
    "de": {"der": 30, "die": 33, "und": 27, "in": 18, "das": 11, "ist": 9, "nicht": 9, "ein": 7, "mit": 8, "auf": 7,
           "für": 6, "zu": 10, "des": 6},
    "fr": {"de": 45, "la": 27, "le": 22, "et": 22, "les": 19, "des": 15, "en": 13, "un": 13, "du": 12, "une": 11,
           "est": 11, "que": 11, "pour": 9, "dans": 9, "on": 3},
    "es": {"de": 52, "la": 38, "que": 29, "el": 28, "en": 26, "los": 17, "se": 12, "del": 12, "las": 11, "un": 11,
           "por": 10, "con": 9, "una": 9, "para": 7, "como": 5},
}
# Rounded shares per thousand of the word characters of everyday
# prose: a-z, A-Z, digits, outside ASCII, symbols, others.
CLASSES_PER_THOUSAND = {
    "en": [945, 25, 3, 1, 0, 26],
    "de": [910, 45, 3, 17, 0, 25],
    "fr": [920, 22, 3, 30, 0, 25],
    "es": [925, 22, 3, 25, 0, 25],
}
#: Any other language, its letters outside ASCII taken as lower case.
OTHER = ""
OTHER_CLASSES = [944, 28, 3, 0, 0, 25]

#: A histogram is judged from this many word characters / common words on.
MIN_CHARS, MIN_COMMON = 200, 40
#: Distances above these reject a document.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.33, 0.75
#: A document's shares are summed as integers of this unit.
SHARE = 1_000_000_000
#: References of more languages than this are joined, not broadcast.
MAX_BROADCAST_LANGUAGES = 10_000


def _words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_GAP, -1), lambda w: w != "")


def _text(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def _computed(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns``, computed once a row: through a generator of one
    row, since the optimizer copies a plain column's expression into each of
    its uses and into filters above."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _without(text: Column, chars: str) -> Column:
    """Code points left when ``chars`` (a Java class body) is taken out."""
    return F.length(F.regexp_replace(text, f"[{chars}]+", ""))


def _window_hashes(words: str, n: int = 5) -> Column:
    """The hash of the n-word window at each word (one entry for fewer words)."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0))), lambda i: F.xxhash64(*[
        F.get(F.col(words), i + k) for k in range(n)]))


def _repeat_words(words: str, hashes: str, n: int = 5) -> Column:
    """Words inside an n-word window that stands in the text twice or more.

    A text whose windows have distinct hashes holds no equal ones.  In others
    the hashes are sorted, each with its position; windows whose hash stands
    alone are done.  The rest become strings ``w1 .. wn\\n<position>`` and are
    sorted; equal windows are then neighbours (words hold neither blank nor
    newline), and the union of the positions they cover is summed from the
    gaps.
    """
    # 33 bits of the hash, 31 of the position: chance meetings cost a string only.
    sorted_ = F.sort_array(F.transform(hashes, lambda h, i: F.shiftleft(h, 31).bitwiseOR(i.cast("long"))))
    key = lambda x: F.shiftright(x, 31)
    met = F.transform(F.array(sorted_), lambda s: F.filter(s, lambda x, i: (key(x) == key(F.get(s, i - 1)))
                                                           | (key(x) == key(F.get(s, i + 1)))))[0]
    place = lambda x: x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    tagged = F.transform(met, lambda x: F.concat(
        F.concat_ws(" ", *[F.get(F.col(words), place(x) + k) for k in range(n)]), F.lit("\n"), place(x).cast("string")))
    ordered = F.sort_array(tagged)
    window = lambda s: F.substring_index(s, "\n", 1)
    at = lambda s: F.substring_index(s, "\n", -1).cast("int")
    pairs = F.transform(F.array(ordered), lambda s: F.flatten(F.filter(F.zip_with(
        F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s)),
        lambda a, b: F.when(window(a) == window(b), F.array(at(a), at(b)))), lambda x: x.isNotNull())))[0]
    starts = F.sort_array(F.array_distinct(pairs))
    covered = F.transform(F.array(starts), lambda p: F.aggregate(
        F.zip_with(p, F.slice(p, 2, F.size(p) + 1), lambda a, b: F.least(F.lit(n), F.coalesce(b - a, F.lit(n)))),
        F.lit(0), lambda acc, x: acc + x))[0]
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when((F.size(words) >= n) & repeats, covered).otherwise(F.lit(0)).cast("long")


def _tag(lang_col: str) -> Column:
    """The first part of a language tag, in lower case."""
    return F.lower(F.split_part(F.regexp_replace(F.coalesce(F.col(lang_col), F.lit("")), "_", "-"), F.lit("-"), F.lit(1)))


def histograms(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs``, the output of ``with_base_counts``, with ``__lang, __tag,
    __classes, __common``: counts per character class (of word characters) and
    per common word.  ``__tag`` is the language, ``__lang`` the one that its
    fixed reference has."""
    t = _text(text_col)
    common = F.filter(F.transform(_words(F.lower(t)), lambda w: F.rtrim(w, F.lit(MARKS))),
                      lambda w: w.isin(COMMON_WORDS))
    d = _computed(docs, __hits=F.sort_array(common))
    n, rest, left = F.col("word_chars"), F.col("__rest"), F.length("__rest")
    d = _computed(d, __parts=F.array(
        n, n - left, left - _without(rest, "A-Z"), left - _without(rest, "0-9"), _without(rest, r"\x00-\x7F"), F.col("n_symbols")))
    p = F.col("__parts")
    tag = _tag(lang_col)
    lang = F.when(tag.isin(*CLASSES_PER_THOUSAND), tag).otherwise(F.lit(OTHER))
    folded = lang == OTHER
    classes = F.array(*[c.cast("double") for c in (
        F.when(folded, p[1] + p[4]).otherwise(p[1]), p[2], p[3], F.when(folded, F.lit(0)).otherwise(p[4]), p[5],
        p[0] - p[1] - p[2] - p[3] - p[4] - p[5])])
    # The sorted hits' runs, as a map from word to run length.
    begins = F.filter(F.transform("__hits", lambda w, i: F.when(
        (i == 0) | (w != F.get(F.col("__hits"), i - 1)), i)), lambda i: i.isNotNull())
    runs = F.transform(F.array(begins), lambda e: F.zip_with(e, F.slice(e, 2, F.greatest(F.size(e), F.lit(1))), lambda a, b: F.struct(
        F.get(F.col("__hits"), a).alias("w"), F.coalesce(b, F.size("__hits")) - a)))[0]
    d = _computed(d, __runs=F.map_from_entries(runs))
    counts = F.array(*[F.coalesce(F.try_element_at("__runs", F.lit(w)), F.lit(0)).cast("double")
                       for w in COMMON_WORDS])
    d = _computed(d, __lang=lang, __tag=tag, __classes=classes, __common=counts)
    return d.drop("__rest", "__parts", "__hits", "__runs")


def references(spark: SparkSession) -> DataFrame:
    """``__lang, __ref_classes, __ref_common``: the fixed values, one row per
    language."""
    rows = [(k, [float(x) for x in c], [float(COMMON_PER_THOUSAND[k].get(w, 0)) for w in COMMON_WORDS])
            for k, c in CLASSES_PER_THOUSAND.items()]
    rows.append((OTHER, [float(x) for x in OTHER_CLASSES], [0.0] * len(COMMON_WORDS)))
    return spark.createDataFrame(rows, "__lang string, __ref_classes array<double>, __ref_common array<double>")


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def own_references(judged: DataFrame) -> DataFrame:
    """``__tag, __own_classes, __own_common``: one row per language, summed over
    its documents that the base rule and the fixed references keep, combined in
    every map task before the shuffle.  ``judged``, the output of
    ``with_fixed_distances``, holds the base counts too.  Sums of integers do
    not depend on their order."""
    least = {"classes": MIN_CHARS, "common": MIN_COMMON}
    d = judged.filter(~base_failed() & within("__fixed_class", "__fixed_word"))
    d = _computed(d, **{f"__n_{c}": F.greatest(_total(F.col(f"__{c}")), F.lit(float(n))).cast("long") for c, n in least.items()})
    share = lambda c, i: F.expr(f"{SHARE}L * cast(__{c}[{i}] as bigint) div __n_{c}")
    sums = lambda c, bins: F.array(*[F.sum(share(c, i)).cast("double") for i in range(bins)]).alias(f"__own_{c}")
    return d.groupBy("__tag").agg(sums("classes", len(OTHER_CLASSES)), sums("common", len(COMMON_WORDS)))


def js_distance(a: str, b: str) -> Column:
    """Jensen-Shannon distance of two count arrays, rounded to 6 places."""
    def term(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    both = F.zip_with(F.col(a), F.col(b), lambda x, y: F.struct(
        (x / F.greatest(F.col(f"{a}_n"), F.lit(1.0))).alias("x"), (y / F.greatest(F.col(f"{b}_n"), F.lit(1.0))).alias("y")))
    div = F.aggregate(both, F.lit(0.0), lambda s, z: s
                      + term(z["x"], (z["x"] + z["y"]) / 2) / 2 + term(z["y"], (z["x"] + z["y"]) / 2) / 2)
    return F.round(F.sqrt(F.greatest(div, F.lit(0.0))), 6)


def _with_distances(hist: DataFrame, kind: str, class_distance: str, word_distance: str) -> DataFrame:
    """``hist`` with both distances from ``__{kind}_classes, __{kind}_common``
    (0 below the minimum mass and where there is no reference)."""
    refs = [f"__{kind}_classes", f"__{kind}_common"]
    names = ["__classes", "__common", *refs]
    d = _computed(hist, **{f"{c}_n": _total(F.col(c)) for c in names})

    def distance(c: str, r: str, least: int) -> Column:
        return F.when((F.col(f"{c}_n") >= least) & (F.col(f"{r}_n") > 0), js_distance(c, r)).otherwise(F.lit(0.0))

    d = _computed(d, **{class_distance: distance("__classes", refs[0], MIN_CHARS), word_distance: distance("__common", refs[1], MIN_COMMON)})
    return d.drop(*refs, *[f"{c}_n" for c in names])


def with_fixed_distances(hist: DataFrame) -> DataFrame:
    """Adds ``__fixed_class, __fixed_word``, the distances from fixed values."""
    refs = F.broadcast(references(hist.sparkSession))  # a row for each language above
    return _with_distances(hist.join(refs, "__lang"), "ref", "__fixed_class", "__fixed_word").drop("__lang")


def with_distances(judged: DataFrame, own: DataFrame) -> DataFrame:
    """Adds ``class_distance, word_distance``, the greater ones of those from
    fixed values and from the table's own references.  ``own`` is broadcast
    after its row count is checked."""
    own = F.broadcast(own) if own.count() <= MAX_BROADCAST_LANGUAGES else own
    d = _with_distances(judged.join(own, "__tag", "left"), "own", "__own_class", "__own_word")
    return d.withColumns({"class_distance": F.greatest("__fixed_class", "__own_class"),
                          "word_distance": F.greatest("__fixed_word", "__own_word")}) \
        .drop("__tag", "__classes", "__common", "__fixed_class", "__fixed_word", "__own_class", "__own_word")


def with_base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base rule's counts, and ``__rest``, the characters of
    words other than a-z, for ``histograms``."""
    t = _text(text_col)
    docs = _computed(docs, __words=_words(t))
    docs = _computed(docs, __ink=F.array_join("__words", ""), __hashes=_window_hashes("__words"))
    # Of what is left without a-z, a small part, symbols and other classes are counted.
    docs = _computed(docs, __rest=F.regexp_replace("__ink", "[a-z]+", ""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.ltrim(x, F.lit(SPACES)) != "")
    return _computed(
        docs,
        n_words=F.size("__words").cast("long"),
        word_chars=F.length("__ink").cast("long"),
        n_symbols=(F.length("__rest") - F.length(F.translate("__rest", SYMBOLS, ""))).cast("long"),
        n_dup_lines=F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("long"),
        n_repeat_words=_repeat_words("__words", "__hashes")).drop("__words", "__ink", "__hashes")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def within(class_distance: str, word_distance: str) -> Column:
    return (F.col(class_distance) <= MAX_CLASS_DISTANCE) & (F.col(word_distance) <= MAX_WORD_DISTANCE)


def kept() -> Column:
    return ~F.col("base_failed") & within("class_distance", "word_distance")


def _judged(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return with_fixed_distances(histograms(with_base_counts(docs, text_col), text_col, lang_col))


def _ruled(judged: DataFrame) -> DataFrame:
    """``judged`` is read twice, for the table's own references and for the
    distances from them."""
    return with_distances(judged, written(own_references(judged), "quality-own")).withColumn("base_failed", base_failed())


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """One row per document: base counts, both distances and the verdict."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__t"), F.col(lang_col).alias("__l"))
    return _ruled(written(_judged(d, "__t", "__l").drop("__t", "__l"), "quality")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept().alias("kept"), "class_distance", "word_distance")


def quality_filter(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that the rules keep, all columns as they were."""
    void = {c for c, kind in docs.dtypes if kind == "void"}  # Parquet has no such columns
    at = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    d = docs.select(*[(F.col(f"`{c}`").cast("string") if c in void else F.col(f"`{c}`")).alias(a) for c, a in at.items()])
    out = _ruled(written(_judged(d, at[text_col], at[lang_col]), "quality-rows")).filter(kept())
    return out.select(*[(F.lit(None) if c in void else F.col(a)).alias(c) for c, a in at.items()])
