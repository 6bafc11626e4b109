"""As-of join of events with type-2 versions (SCD7 for many dates).

Each event gets the version of its key that is valid at the event's time.  A
join on ``key`` and ``start <= at < end`` pairs each event with every version
of its key before it filters; here the two sides are laid in one row of times
instead, and the last version is carried forward over the events:

1. versions and events are united, with the time of each and a *segment* (a
   time bucket that never falls as time grows);
2. inside a key's segment, a running ``last`` carries the version;
3. an event before its segment's first version takes the last version of the
   key's earlier segments, from a table of one row per key and segment, made
   map-side and scanned per key.

Every row goes through one shuffle by key and segment, and no pair is formed,
however many versions a key has; a key with a third of all events is spread
over its segments.  Versions must not overlap: of several that hold at one
time, the latest start wins (then the greatest row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scd2 import DATE_VALIDITY, Validity


def as_of_join(events: DataFrame, history: DataFrame, keys: Sequence[str], at: str | Column,
               columns: Sequence[str], v: Validity = DATE_VALIDITY, segment=None, how: str = "left") -> DataFrame:
    """``events`` with ``columns`` of ``history`` (its validity columns may be
    among them) as of ``at``.

    ``how="left"`` keeps events without a valid version, with nulls (a null
    key, a null time, before the first version, after a closed one);
    ``"inner"`` drops them.  ``segment`` is a function from a time column to
    its bucket, for example ``lambda t: F.date_trunc("month", t)``; without it
    the windows run per key.  Columns of the history must not clash with the
    events' own.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how {how!r}")
    clash = set(columns) & set(events.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    keys = list(keys)
    t_type = history.schema[v.start].dataType
    t = (F.col(at) if isinstance(at, str) else at).cast(t_type)
    bucket = segment or (lambda c: F.lit(0))
    version = F.struct(F.col(v.start).alias("from"), F.col(v.end).alias("to"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    # Rows without a key or a time match nothing and need no shuffle.
    whole = F.col("__t").isNotNull()
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    timed = events.withColumn("__t", t)
    row = F.struct(*[F.col(c).alias(f"e{i}") for i, c in enumerate(events.columns)])
    left = timed.filter(whole).select(*keys, "__t", row.alias("__e"))
    right = history.withColumn("__t", F.col(v.start)).filter(whole).select(*keys, "__t", version.alias("__v"))
    both = right.withColumn("__e", F.lit(None).cast(left.schema["__e"].dataType)).unionByName(
        left.withColumn("__v", F.lit(None).cast(right.schema["__v"].dataType))).withColumn("__s", bucket(F.col("__t")))
    # A version counts from its own start on: it sorts before events of that time.
    order = [F.col("__t"), F.col("__e").isNotNull(), F.col("__v")]
    inside = Window.partitionBy(*keys, "__s").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = F.last("__v", ignorenulls=True).over(inside)
    if segment is None:
        found = both.withColumn("__v", carried)
    else:
        per_segment = both.groupBy(*keys, "__s").agg(F.max("__v").alias("__l"))
        before = Window.partitionBy(*keys).orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
        earlier = per_segment.withColumn("__l", F.last("__l", ignorenulls=True).over(before)).filter("__l is not null")
        found = both.withColumn("__v", carried).join(earlier, [*keys, "__s"], "left") \
            .withColumn("__v", F.coalesce("__v", "__l"))
    valid = F.col("__v").isNotNull() & (F.col("__v.to").isNull() | (F.col("__t") < F.col("__v.to")))
    out = [F.col(f"__e.e{i}").alias(c) for i, c in enumerate(events.columns)]
    out += [F.when(valid, F.col(f"__v.c{i}")).alias(c) for i, c in enumerate(columns)]
    joined = found.filter(F.col("__e").isNotNull())
    if how == "inner":
        return joined.filter(valid).select(*out)
    rest = timed.filter(~F.coalesce(whole, F.lit(False))).select(
        *events.columns, *[F.lit(None).cast(history.schema[c].dataType).alias(c) for c in columns])
    return joined.select(*out).unionByName(rest)
