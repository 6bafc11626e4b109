"""Type-2 history of keyed records (SCD0-SCD8) as DataFrame plans.

A history table holds one row per version of a key with three validity
columns: ``start`` (inclusive), ``end`` (exclusive, null while open) and
``current``.  Two rule sets are offered:

* ``sound`` (default): a change closes the open row only if a tracked column
  differs (null-safe), and a row is inserted only when the key has no open
  row left.  A key never gains a second open row.
* ``compat``: the rules of the MERGE statements this library replaces.  The
  batch merge closes every matched open row (``close_rule="any_match"``);
  the stream merge closes on ``!=`` (null-unsafe) and always inserts.

``scd2_apply`` is the MERGE as a plan: the open rows are left-joined to the
change set (one row per key), all other rows pass through untouched, and the
insert arm is an anti-join of the changes with the open rows that stay open.  ``history_from_log`` builds the whole history
from an ordered change log with window functions.  ``merge_entries`` folds a
batch into the entries (the last event per key and period) that a history is
computed from, so a stream gives the same history no matter how its
micro-batches are cut or ordered.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedupe import latest_per_key


@dataclass(frozen=True)
class Validity:
    """Names of the three validity columns."""

    start: str = "start_date"
    end: str = "end_date"
    current: str = "is_current"

    @property
    def names(self) -> tuple[str, str, str]:
        return (self.start, self.end, self.current)


DATE_VALIDITY = Validity()
TIME_VALIDITY = Validity("effective_time", "end_time", "is_current")


def _lit(v) -> Column:
    """A column, or a Python value (date, datetime, number, text) as a literal."""
    return v if isinstance(v, Column) else F.lit(v)


def _data_cols(df: DataFrame, v: Validity) -> list[str]:
    return [c for c in df.columns if c not in v.names]


# --------------------------------------------------------------------- SCD0
def initial_load(df: DataFrame, start, v: Validity = DATE_VALIDITY,
                 keys: Sequence[str] | None = None,
                 order_by: Sequence[str] | None = None,
                 partition_by: Sequence[str] | None = None) -> DataFrame:
    """SCD0: distinct rows, fixed start, open end, all current.

    With ``keys`` and ``order_by`` the load keeps one row per key (the
    greatest by ``order_by``), repairing L2; without them it keeps every
    distinct row, as the reference does.

    ``partition_by`` (the key) hash-partitions the loaded rows by key, so a
    later per-key change set and the merge join reuse that partitioning
    instead of shuffling the table again.  The distinct runs first, with its
    map-side combine: copies of a row collapse in every map task before any
    shuffle, however many there are.
    """
    if keys:
        # Identical rows collapse in the per-key pick (an aggregate by key,
        # so its output is already partitioned by key).
        base = latest_per_key(df, keys, order_by or [c for c in df.columns if c not in keys])
    else:
        base = df.distinct()
        if partition_by:
            base = base.repartition(*[F.col(c) for c in partition_by])
    with_start = base.withColumn(v.start, _lit(start))
    start_type = with_start.schema[v.start].dataType
    return with_start.withColumns({
        v.end: F.lit(None).cast(start_type),
        v.current: F.lit(True),
    })


# --------------------------------------------------------------- SCD1/SCD2
def _changed(old: Sequence[Column], new: Sequence[Column], null_safe: bool) -> Column:
    if null_safe:
        diffs = [~o.eqNullSafe(n) for o, n in zip(old, new)]
    else:
        diffs = [o != n for o, n in zip(old, new)]
    return reduce(lambda a, b: a | b, diffs)


def scd2_parts(live: DataFrame, changes: DataFrame, keys: Sequence[str],
               tracked: Sequence[str], effective, v: Validity = DATE_VALIDITY,
               close_rule: str = "changed", insert_rule: str = "new_or_changed",
               null_safe: bool = True, dedupe_by: Sequence[str] | None = None
               ) -> tuple[DataFrame, DataFrame]:
    """The two outputs of a merge over the open rows only.

    Returns ``(updated, inserted)``: every open row with its new validity
    (closed or still open), and the rows to insert.  An open row matched by
    several changes makes the job fail, as a MERGE does; pass ``dedupe_by``
    (ordering columns) to keep the latest change per key first.  Null keys
    match nothing and are inserted.
    """
    keys, tracked = list(keys), list(tracked)
    if dedupe_by is not None:
        changes = latest_per_key(changes, keys, list(dedupe_by))
    data = _data_cols(live, v)
    eff = _lit(effective).cast(live.schema[v.start].dataType)
    # One row per key: the join never multiplies open rows.
    hit = changes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__hits"),
        F.max(F.struct(*[F.col(t).alias(f"n{i}") for i, t in enumerate(tracked)])).alias("__new"))
    j = live.join(hit, keys, "left")
    matched = F.when(F.col("__hits") > 1, F.raise_error(F.lit("several changes match one open row")).cast("boolean")) \
        .otherwise(F.col("__hits").isNotNull())
    if close_rule == "any_match":
        close = matched
    elif close_rule == "changed":
        close = matched & _changed([F.col(t) for t in tracked],
                                   [F.col(f"__new.n{i}") for i in range(len(tracked))], null_safe)
    else:
        raise ValueError(f"close_rule {close_rule!r}")
    close = F.coalesce(close, F.lit(False))  # `!=` on null gives null: not a change
    updated = j.select(
        *[F.col(c) for c in data],
        F.col(v.start),
        F.when(close, eff).otherwise(F.col(v.end)).alias(v.end),
        (F.col(v.current) & ~close).alias(v.current),
    )
    new_rows = changes.select(*[F.col(c) for c in data])
    if insert_rule == "new_or_changed":
        # A matched row stays open only if it is not changed, which the change
        # itself tells: the arms share no join.  ``any_match`` leaves none open.
        if close_rule == "changed":
            old = live.select(*[F.col(c).alias(f"__o{i}") for i, c in enumerate([*keys, *tracked])])
            same = [F.col(k) == F.col(f"__o{i}") for i, k in enumerate(keys)]
            differs = _changed([F.col(f"__o{len(keys) + i}") for i in range(len(tracked))],
                               [F.col(t) for t in tracked], null_safe)
            stays = ~F.coalesce(differs, F.lit(False))
            new_rows = new_rows.join(old, reduce(lambda a, b: a & b, [*same, stays]), "left_anti")
    elif insert_rule != "always":
        raise ValueError(f"insert_rule {insert_rule!r}")
    inserted = new_rows.withColumns({
        v.start: eff,
        v.end: F.lit(None).cast(live.schema[v.start].dataType),
        v.current: F.lit(True),
    })
    return updated.select(*live.columns), inserted.select(*live.columns)


def scd2_apply(target: DataFrame, changes: DataFrame, keys: Sequence[str],
               tracked: Sequence[str], effective, v: Validity = DATE_VALIDITY,
               close_rule: str = "changed", insert_rule: str = "new_or_changed",
               null_safe: bool = True, dedupe_by: Sequence[str] | None = None) -> DataFrame:
    """SCD1 / SCD2: the whole table after one merge.

    ``others ∪ updated ∪ inserted``.  Rows that are not open (closed, or with
    a null flag) pass through without being joined.
    """
    others = target.filter(~F.coalesce(F.col(v.current), F.lit(False)))
    live = target.filter(F.col(v.current))
    updated, inserted = scd2_parts(live, changes, keys, tracked, effective, v,
                                   close_rule, insert_rule, null_safe, dedupe_by)
    return others.unionByName(updated).unionByName(inserted)


def compat_batch_merge(target: DataFrame, changes: DataFrame, keys: Sequence[str],
                       tracked: Sequence[str], effective, v: Validity = DATE_VALIDITY) -> DataFrame:
    """The batch one-shot MERGE rules: close every matched open row, insert
    every change (L15)."""
    return scd2_apply(target, changes, keys, tracked, effective, v,
                      close_rule="any_match", insert_rule="always", null_safe=False)


def compat_stream_merge(target: DataFrame, changes: DataFrame, keys: Sequence[str],
                        tracked: Sequence[str], effective, v: Validity = TIME_VALIDITY) -> DataFrame:
    """The per-micro-batch MERGE rules: close on ``!=``, always insert (L1, L6)."""
    return scd2_apply(target, changes, keys, tracked, effective, v,
                      close_rule="changed", insert_rule="always", null_safe=False)


# --------------------------------------------------------------------- SCD3
def history_from_entries(entries: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                         at: str, tiebreak: Sequence[str] = (),
                         v: Validity = DATE_VALIDITY, mode: str = "sound",
                         segment: str | None = None) -> DataFrame:
    """Versions from entries that each say "from ``at`` on, the key looks
    like this row".

    ``sound``: an entry equal (null-safe) in all tracked columns to the
    previous entry of its key is a repeat and dropped; each version ends
    where the next begins.

    ``compat``: no entry is dropped; an entry ends at the first later entry
    whose tracked value is non-null and differs from its own (one tracked
    column, as the rules it mirrors).  Computed from runs of equal values,
    so no pair of entries is ever formed.

    Windows are partitioned by key.  Feed one entry per key and period (see
    ``history_from_log``) so that a key's window holds at most one row per
    period whatever the event volume of a hot key, or name a ``segment``
    column (a time bucket that never decreases as ``at`` grows) to spread
    each key over its segments; see ``_segmented_history``.
    """
    keys, tracked = list(keys), list(tracked)
    if mode == "compat" and len(tracked) != 1:
        raise ValueError("compat history tracks exactly one column")
    if segment is not None:
        return _segmented_history(entries, keys, tracked, at, list(tiebreak), segment, v, mode)
    marked = mark_versions(entries, keys, tracked, at, tiebreak, mode)
    data = [c for c in entries.columns if c not in v.names and c != at and not c.startswith("__")]
    return marked.filter("__version").select(
        *[F.col(c) for c in data],
        F.col(at).alias(v.start),
        F.col("__end").alias(v.end),
        F.col("__end").isNull().alias(v.current),
    )


def mark_versions(entries: DataFrame, keys: Sequence[str], tracked: Sequence[str], at: str,
                  tiebreak: Sequence[str] = (), mode: str = "sound") -> DataFrame:
    """``entries`` with ``__version`` (whether the entry starts a version of
    its own) and ``__end`` (where its version ends)."""
    order = [F.col(at)] + [F.col(c) for c in tiebreak]
    w = Window.partitionBy(*keys).orderBy(*order)
    # The first later start: a running minimum over the reversed order.
    back = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order]) \
        .rowsBetween(Window.unboundedPreceding, -1)
    if mode == "sound":
        cur = F.struct(*[F.col(t) for t in tracked])
        prev = F.lag(cur).over(w)
        return entries.withColumn("__version", prev.isNull() | ~prev.eqNullSafe(cur)) \
            .withColumn("__end", F.min(F.when(F.col("__version"), F.col(at))).over(back))
    if mode != "compat":
        raise ValueError(f"mode {mode!r}")
    t = tracked[0]
    # Null values start no run and end at no later one.
    prev = F.last(F.col(t), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    run = F.col(t).isNotNull() & (prev.isNull() | (prev != F.col(t)))
    return entries.withColumn("__run", run) \
        .withColumn("__end", F.when(F.col(t).isNotNull(), F.min(F.when(F.col("__run"), F.col(at))).over(back))) \
        .drop("__run").withColumn("__version", F.lit(True))


def _segmented_history(entries: DataFrame, keys: list[str], tracked: list[str], at: str,
                       tiebreak: list[str], seg: str, v: Validity, mode: str) -> DataFrame:
    """The same versions as the per-key windows, with windows per key *and*
    segment, so a key with a third of all entries is spread over many tasks.

    Both rule sets reduce to: mark the entries that start a version (sound)
    or a run of equal values (compat), then end each output row at the first
    start strictly after it.  Inside a segment both steps are windows.  At
    segment edges the first entry's mark needs the last value of the
    key's previous segment, and a row whose segment has no later start ends
    at the first start of a later segment; both come from a summary of one
    row per key and segment (small: its size grows with time span, not
    events), scanned per key and joined back on (key, segment), null-safe: null
    keys are one group and null segments one segment, split like all others.
    """
    order = [F.col(at)] + [F.col(c) for c in tiebreak]
    cur = F.struct(*[F.col(t) for t in tracked])
    t_null = F.lit(None).cast(entries.schema[at].dataType)
    if mode == "compat":
        nulls = entries.filter(F.col(tracked[0]).isNull()).withColumn("__end", t_null)
        base = entries.filter(F.col(tracked[0]).isNotNull())
    elif mode == "sound":
        nulls, base = None, entries
    else:
        raise ValueError(f"mode {mode!r}")
    inner = Window.partitionBy(*keys, seg).orderBy(*order)
    x = (base.withColumn("__cur", cur).withColumn("__prev", F.lag("__cur").over(inner))
         .withColumn("__first", F.col("__prev").isNull())
         .withColumn("__inner_start", F.col("__prev").isNotNull()
                     & ~F.col("__prev").eqNullSafe(F.col("__cur"))))
    ordkey = F.struct(*order)
    summary = x.groupBy(*keys, seg).agg(
        F.min_by("__cur", ordkey).alias("__first_t"),
        F.max_by("__cur", ordkey).alias("__last_t"),
        F.min(at).alias("__first_at"),
        F.min(F.when(F.col("__inner_start"), F.col(at))).alias("__first_inner"))
    by_seg = Window.partitionBy(*keys).orderBy(seg)
    later_segs = Window.partitionBy(*keys).orderBy(F.col(seg).desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    prev_last = F.lag("__last_t").over(by_seg)
    summary = (summary
               .withColumn("__first_is_start", prev_last.isNull() | ~prev_last.eqNullSafe(F.col("__first_t")))
               .withColumn("__seg_start", F.when(F.col("__first_is_start"), F.col("__first_at"))
                           .otherwise(F.col("__first_inner")))
               .withColumn("__next_seg_start", F.min("__seg_start").over(later_segs))
               .select(*keys, seg, "__first_is_start", "__next_seg_start"))
    renamed = summary.select(*[F.col(k).alias(f"__j{i}") for i, k in enumerate([*keys, seg])],
                             "__first_is_start", "__next_seg_start")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__j{i}")) for i, k in enumerate([*keys, seg])])
    y = x.join(renamed, same).withColumn(
        "__start", F.when(F.col("__first"), F.col("__first_is_start")).otherwise(F.col("__inner_start")))
    later_rows = Window.partitionBy(*keys, seg).orderBy(*[c.desc() for c in order]) \
        .rowsBetween(Window.unboundedPreceding, -1)
    y = y.withColumn("__end", F.coalesce(F.min(F.when(F.col("__start"), F.col(at))).over(later_rows),
                                         F.col("__next_seg_start")))
    out = y.filter("__start") if mode == "sound" else y
    data = [c for c in entries.columns if c not in v.names and c != at and not c.startswith("__")]
    cols = [*[F.col(c) for c in data], F.col(at).alias(v.start), F.col("__end").alias(v.end),
            F.col("__end").isNull().alias(v.current)]
    res = out.select(*cols)
    return res if nulls is None else res.unionByName(nulls.select(*cols))


def history_from_log(log: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                     ts: str, tiebreak: Sequence[str] = (), period: Column | None = None,
                     v: Validity = DATE_VALIDITY, mode: str = "sound",
                     payload: Sequence[str] | None = None,
                     segment: Column | None = None) -> DataFrame:
    """SCD3: the full history as a pure query over a change log.

    With ``period`` (a column expression, e.g. the event day) the log is
    first cut to the last event per key and period; that aggregate combines
    map-side, so hot keys shrink before any shuffle.  Versions then start
    at the period value.  Without ``period`` every event is an entry at
    ``ts``; give ``segment`` (a time bucket of ``ts``, e.g. the hour) so that
    the windows run per key and segment and a hot key is spread over many
    tasks.  The result does not depend on the segment chosen.
    """
    keys, tracked = list(keys), list(tracked)
    keep = list(payload) if payload is not None else \
        [c for c in log.columns if c not in keys and c not in tracked]
    cols = keys + tracked + [c for c in keep if c not in keys + tracked]
    sel = list(dict.fromkeys(cols + [ts] + list(tiebreak)))
    if period is not None:
        stamped = log.select(*sel, period.alias("__at"))
        entries = latest_per_key(stamped, keys + ["__at"], [ts, *tiebreak])
        tb: list[str] = []
    else:
        extra = [segment.alias("__seg")] if segment is not None else []
        entries = log.select(*sel, F.col(ts).alias("__at"), *extra)
        tb = list(tiebreak)
    seg = ["__seg"] if segment is not None and period is None else []
    entries = entries.select(*list(dict.fromkeys(cols + tb)), "__at", *seg)
    hist = history_from_entries(entries, keys, tracked, "__at", tb, v, mode,
                                segment="__seg" if seg else None)
    return hist.select(*cols, *v.names)


def merge_entries(entries: DataFrame, batch: DataFrame, keys: Sequence[str], at: str,
                  order_by: Sequence[str]) -> DataFrame:
    """One entry per key and ``at`` out of the entries held and a batch: the
    greatest by ``order_by``, whichever came first.  Null keys form one group."""
    both = entries.unionByName(batch.select(*entries.columns))
    return latest_per_key(both, [*keys, at], list(order_by))


# --------------------------------------------------------------------- SCD4
def hash_sample(df: DataFrame, fraction: float, seed: int, cols: Sequence[str]) -> DataFrame:
    """Seeded Bernoulli sample that does not depend on partitioning (SMP1).

    A row is kept when the first 32 bits of ``md5(seed|cols…)`` fall below
    ``fraction``.  Comparing fixed-width lowercase hex text is the same as
    comparing the numbers, and md5 is spelled alike in most SQL engines, so
    the sample can be re-derived outside Spark.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    threshold = format(min(int(round(fraction * 16 ** 8)), 16 ** 8 - 1), "08x")
    if fraction >= 1.0:
        return df
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))
    return df.filter(F.substring(digest, 1, 8) < F.lit(threshold))


def rewrite_when(col: str, match, then, otherwise) -> Column:
    """PRJ3: two-way conditional rewrite; a null input takes ``otherwise``."""
    return F.when(F.col(col) == F.lit(match), F.lit(then)).otherwise(F.lit(otherwise))


def build_change_set(current: DataFrame, keys: Sequence[str], fraction: float, seed: int,
                     rewrites: dict[str, Column], stamp: dict[str, Column] | None = None,
                     method: str = "hash", order_by: Sequence[str] | None = None,
                     staged: bool = False) -> DataFrame:
    """SCD4: sample open rows, keep one per key, rewrite, stamp.

    ``method="hash"`` samples by key hash (repeatable); ``"bernoulli"`` is
    Spark's ``sample`` (depends on partitioning, like the reference).
    ``staged=True`` writes the change set to the shared folder and reads it
    back (SCD5), so a merge that reads it twice sees the same rows.
    """
    if method == "hash":
        picked = hash_sample(current, fraction, seed, keys)
    elif method == "bernoulli":
        picked = current.sample(withReplacement=False, fraction=fraction, seed=seed)
    else:
        raise ValueError(f"method {method!r}")
    rest = [c for c in picked.columns if c not in keys]
    one = latest_per_key(picked, keys, order_by or rest)
    out = one.withColumns({**rewrites, **(stamp or {})})
    if staged:
        from ..session import stage
        out = stage(out, "change_set")
    return out


# --------------------------------------------------------------- SCD6/SCD7
def key_history(history: DataFrame, key: str, value, v: Validity = DATE_VALIDITY) -> DataFrame:
    """SCD6: one key's versions in order (the value is bound, never spliced
    into SQL text)."""
    return history.filter(F.col(key) == F.lit(value)).orderBy(v.start, v.end)


def history_of_keys(history: DataFrame, keys_df: DataFrame, keys: Sequence[str],
                    v: Validity = DATE_VALIDITY) -> DataFrame:
    """SCD6 for a set of keys given as a DataFrame (semi-join)."""
    return history.join(keys_df.select(*keys).distinct(), list(keys), "left_semi") \
        .orderBy(*keys, v.start)


def as_of(history: DataFrame, at, v: Validity = DATE_VALIDITY) -> DataFrame:
    """SCD7: rows valid at ``at``: ``start <= at < end`` (open end = +inf)."""
    t = _lit(at).cast(history.schema[v.start].dataType)
    return history.filter((F.col(v.start) <= t) & (F.col(v.end).isNull() | (t < F.col(v.end))))


def current_rows(history: DataFrame, v: Validity = DATE_VALIDITY) -> DataFrame:
    """FLT1: open rows; the predicate reaches the parquet scan."""
    return history.filter(F.col(v.current))
