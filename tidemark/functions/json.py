"""JSON value encode / decode (FN10, FN11, STR1, SNK5).

``from_json`` in permissive mode turns a bad record into nulls (L8).  With
``quarantine=True`` a ``_corrupt_record`` field is added to the schema and
rows are split: a row is bad when the parser flagged it or a required field
(the key) is null.  Both tests are needed: a quoted number sets the flag
though other fields parsed, and SQL null, the empty string or a missing key
do not set it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
# Full microsecond precision both ways (the defaults keep milliseconds).
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def to_json_value(df: DataFrame, name: str = "value") -> DataFrame:
    """SNK5: each row as one JSON object; null fields are left out."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTIONS).alias(name))


def as_text(col: str | Column) -> Column:
    """PRJ4: binary (a Kafka value) or text to string."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def parse_json(df: DataFrame, col: str, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """STR1: text → struct → columns (``data.*``), permissive."""
    parsed = df.select(*keep, F.from_json(as_text(col), schema, JSON_OPTIONS).alias("__data"))
    return parsed.select(*keep, "__data.*")


def parse_json_split(df: DataFrame, col: str, schema: T.StructType,
                     required: Sequence[str] = (), keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Parse and split into ``(good, quarantine)``.

    ``quarantine`` keeps the raw text in ``raw`` and a ``reason``.
    """
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    parsed = df.select(*keep, as_text(col).alias("__raw"),
                       F.from_json(as_text(col), with_corrupt,
                                   {**JSON_OPTIONS, "columnNameOfCorruptRecord": CORRUPT})
                       .alias("__data"))
    missing = [F.col(f"__data.{r}").isNull() for r in required]
    reason = F.when(F.col("__raw").isNull(), F.lit("null value")) \
        .when(F.col(f"__data.{CORRUPT}").isNotNull(), F.lit("malformed"))
    for r, m in zip(required, missing):
        reason = reason.when(m, F.lit(f"missing {r}"))
    flagged = parsed.withColumn("__reason", reason)
    good = flagged.filter(F.col("__reason").isNull()).select(
        *keep, *[F.col(f"__data.{f.name}").alias(f.name) for f in schema.fields])
    bad = flagged.filter(F.col("__reason").isNotNull()).select(
        *keep, F.col("__raw").alias("raw"), F.col("__reason").alias("reason"))
    return good, bad
