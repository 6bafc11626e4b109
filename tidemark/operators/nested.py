"""Nested fact: child rows folded into ``array<struct>`` per parent
(PRJ6, AGG3, JN1, FLT3).

The fact has two levels: a parent, and its items in chunks of about
``max_items``.  A parent of fewer items is one row (``chunk`` 0), the shape of
a plain ``collect_list``; a parent that holds a third of all items is many
rows, each with the parent's columns, its total ``item_count`` and a bounded
array.  The rule is the same at every size, and the readers here
(``flatten_items``, ``with_many_items``, ``without_items``, ``parents``) give
the same answers whatever ``max_items`` is.

1. Equal items of a parent are counted first (map-side), so copies of one item
   cannot make a hot key; a count above ``max_items`` is cut in pieces.
2. Items per parent are summed from those counts.
3. A piece's chunk is a hash of its content: the same on every task attempt.
   Parents of one chunk need no lookup; the others' numbers of chunks are joined
   on the parent and a salt.
4. ``groupBy(parent, chunk)`` folds the chunks, and the parents' rows, one per
   chunk, are joined to them on both, so no task gathers a parent.  Parents
   without items come out of the same joins.

``item_count`` is stored beside the array, since ``size(array)`` is neither
pushed to parquet nor pruned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tasks that share the pieces of a parent of several chunks before these are dealt.
SALTS = 16


def item_struct(fields: Sequence[str | Column], name: str = "item") -> Column:
    """PRJ6: pack columns into a struct; every field keeps a name (L4)."""
    return F.struct(*[F.col(f) if isinstance(f, str) else f for f in fields]).alias(name)


def nest_items(parent: DataFrame, items: DataFrame, on: str | Sequence[str],
               fields: Sequence[str | Column], name: str = "line_items",
               count_col: str = "item_count", max_items: int = 10_000) -> DataFrame:
    """Fold ``items`` into arrays per parent.

    Output: parent columns, ``chunk``, ``count_col`` (all items of the parent;
    0 when none) and ``name`` (null when the parent has no items).  Items
    whose parent is missing vanish, as in a left join from the parent.
    """
    on = [on] if isinstance(on, str) else list(on)
    counted = items.select(*on, item_struct(fields, "__item")).groupBy(*on, "__item") \
        .agg(F.count(F.lit(1)).alias("__copies"))
    sizes = counted.groupBy(*on).agg(F.sum("__copies").alias("__total"))
    chunks = F.ceil(F.col("__total") / max_items).cast("int")
    pieces = counted.withColumn("__piece", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("__copies") - 1) / max_items))))
    pieces = pieces.withColumn("__n", F.least(
        F.lit(max_items).cast("long"), F.col("__copies") - F.col("__piece") * max_items).cast("int"))
    # Only parents of several chunks need their number of chunks; a salt keeps
    # such a parent's pieces from meeting in one task before they are dealt.
    large = sizes.filter(F.col("__total") > max_items).select(
        *on, chunks.alias("__chunks"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    salted = pieces.withColumn("__salt", F.pmod(F.xxhash64("__piece", "__item"), F.lit(SALTS)).cast("int"))
    spread = salted.join(large, [*on, "__salt"], "left").withColumn(
        "chunk", F.coalesce(F.pmod(F.xxhash64("__item", "__piece"), F.col("__chunks")).cast("int"), F.lit(0)))
    # sort_array gives a fixed order (L16): structs sort field by field, so
    # put the item's own ordering fields first.
    folded = spread.groupBy(*on, "chunk").agg(
        F.sort_array(F.flatten(F.collect_list(F.array_repeat("__item", F.col("__n"))))).alias(name))
    # A parent's row goes to each of its chunks, so that the chunks stay where
    # they were folded; one without items keeps one row.  Both sides grow with
    # the data: never broadcast the arrays on a size estimate taken from
    # compressed files.
    rows = parent.join(sizes, on, "left").withColumn("chunk", F.explode(F.sequence(
        F.lit(0), F.coalesce(chunks - 1, F.lit(0)))))
    # A chunk that no piece fell in is no row.
    whole = rows.join(folded.hint("merge"), [*on, "chunk"], "left").filter(F.col(name).isNotNull() | F.col("__total").isNull())
    return whole.select(
        *parent.columns, "chunk", F.coalesce("__total", F.lit(0)).cast("long").alias(count_col), name)


def childless(parent: DataFrame, items: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """FLT4: parents without items, by an anti-join (no array is built)."""
    on = [on] if isinstance(on, str) else list(on)
    return parent.join(items.select(*on).distinct(), on, "left_anti")


def flatten_items(fact: DataFrame, name: str = "line_items", keep_empty: bool = True) -> DataFrame:
    """Back to one row per item (``explode_outer`` keeps parents with no
    items as one row of nulls)."""
    other = [c for c in fact.columns if c not in (name, "chunk")]
    exploded = fact.select(*other, (F.explode_outer if keep_empty else F.explode)(name).alias("__i"))
    item_fields = fact.schema[name].dataType.elementType.fieldNames()
    return exploded.select(*other, *[F.col(f"__i.{f}").alias(f) for f in item_fields])


def parents(fact: DataFrame, name: str = "line_items") -> DataFrame:
    """One row per parent: the fact without its arrays, chunks collapsed."""
    return fact.drop(name, "chunk").distinct()


def array_sizes(fact: DataFrame, on: str | Sequence[str], name: str = "line_items", out: str = "items") -> DataFrame:
    """FN9: ``on, out``: the size of each parent's items, one row per parent
    however its items are cut into chunks.  Chunk sizes are summed map-side
    before the shuffle; a parent without items has 0."""
    on = [on] if isinstance(on, str) else list(on)
    size = F.greatest(F.size(name), F.lit(0)).cast("long")  # a null array: no items
    return fact.groupBy(*on).agg(F.coalesce(F.sum(size), F.lit(0)).alias(out))


def larger_than(fact: DataFrame, on: str | Sequence[str], more_than: int, name: str = "line_items") -> DataFrame:
    """FLT3 as ``size(items) > n``: the chunks of parents that hold more than
    ``more_than`` items together.  A parent in one chunk is decided as by
    its own size; the others by the sum."""
    on = [on] if isinstance(on, str) else list(on)
    keep = array_sizes(fact, on, name, "__items").filter(F.col("__items") > more_than).select(*on)
    return fact.join(keep, on, "left_semi")


def with_many_items(fact: DataFrame, count_col: str = "item_count", more_than: int = 1) -> DataFrame:
    """FLT3 on the stored count (pushed to the scan), not ``size(array)``."""
    return fact.filter(F.col(count_col) > more_than)


def without_items(fact: DataFrame, name: str = "line_items") -> DataFrame:
    return fact.filter(F.col(name).isNull())
