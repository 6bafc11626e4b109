"""Distinct rows, one row per key, key audits (AGG1, AGG2, AGG6, STR7).

``latest_per_key`` is an aggregate, not a window: ``max(struct(order…,
row…))`` combines map-side, so a key that holds a third of all rows is
reduced inside each map task before the shuffle, and no task ever holds a
whole group.  Ordering by the chosen columns first and then by every other
column makes the pick deterministic (ties are broken by the whole row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AGG1: bag → set over ``cols`` (all columns when omitted)."""
    return (df.select(*cols) if cols else df).distinct()


def _orderable_type(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable_type(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable_type(f.dataType) for f in dt.fields)
    return True


def _orderable(name: str, df: DataFrame) -> bool:
    return _orderable_type(df.schema[name].dataType)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                   earliest: bool = False) -> DataFrame:
    """AGG2 (sound form): the row with the greatest ``order_by`` per key.

    Ties on ``order_by`` are broken by the remaining columns, so the result
    does not depend on partitioning.  Null keys form one group, as in
    ``dropDuplicates``.
    """
    keys = list(keys)
    order_by = list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    tie = [c for c in rest if _orderable(c, df)]
    payload = [c for c in rest if c not in tie]
    fields = [F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)]
    fields += [F.col(c).alias(f"t{i}") for i, c in enumerate(tie)]
    best = F.struct(*fields)
    aggs = [(F.min if earliest else F.max)(best).alias("__b")]
    if payload:
        # Unorderable payload (maps) rides along with max_by on the rest.
        pick = F.min_by if earliest else F.max_by
        aggs.append(pick(F.struct(*[F.col(c) for c in payload]), best).alias("__p"))
    cols = [F.col(f"__b.o{i}").alias(c) for i, c in enumerate(order_by)]
    cols += [F.col(f"__b.t{i}").alias(c) for i, c in enumerate(tie)]
    cols += [F.col(f"__p.{c}").alias(c) for c in payload]
    out = df.groupBy(*keys).agg(*aggs)
    return out.select(*[F.col(k) for k in keys], *cols).select(*df.columns)


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG2 (compat form): ``dropDuplicates`` — an arbitrary row per key."""
    return df.dropDuplicates(list(keys))


def key_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG6: rows, distinct keys and keys seen more than once, in one pass
    of partial aggregates (no collect, no second scan)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").cast("long").alias("row_count"),
        F.count(F.lit(1)).cast("long").alias("key_count"),
        F.count(F.when(F.col("n") > 1, True)).cast("long").alias("repeated_keys"),
        F.max("n").cast("long").alias("max_rows_per_key"),
    )


# ------------------------------------------------- distinct keys across batches
def sketch_error(lg: int) -> float:
    """Relative standard error of a HyperLogLog sketch of ``2 ** lg`` registers."""
    return 1.04 / 2 ** (lg / 2)


def distinct_sketches(df: DataFrame, by: Sequence[str], key: str, lg: int = 14) -> DataFrame:
    """AGG6 over batches: per ``by`` group the rows and a mergeable sketch of
    its distinct ``key`` values (nulls are not counted).

    A sketch takes at most ``2 ** lg`` bytes whatever it has seen, so a day's
    (or micro-batch's) rows are read once and later audits merge sketches.
    Estimates have a relative standard error of ``sketch_error(lg)``, 0.8 % at
    ``lg=14``; small counts are exact.
    """
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), F.count(key).alias("keyed_rows"),
                               F.hll_sketch_agg(key, lg).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of several batches (or of finer groups) as those of ``by``."""
    return sketches.groupBy(*by).agg(F.sum("row_count").alias("row_count"), F.sum("keyed_rows").alias("keyed_rows"),
                                     F.hll_union_agg("sketch", True).alias("sketch"))


def estimated_keys(sketches: DataFrame) -> DataFrame:
    """``key_estimate`` in place of each sketch."""
    return sketches.withColumn("key_estimate", F.hll_sketch_estimate("sketch")).drop("sketch")
