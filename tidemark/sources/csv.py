"""CSV scans (SRC1, SRC8), one-pass type inference, and a CSV writer for
staging raw files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types tried, narrowest first; a column that no other fits is a string.
LATTICE = ("boolean", "int", "bigint", "decimal(38,0)", "double", "date", "timestamp_ntz")
_SHAPES = {
    "boolean": r"^(?i:true|false)$",
    "int": r"^[+-]?[0-9]{1,10}$",
    "bigint": r"^[+-]?[0-9]{1,19}$",
    "decimal(38,0)": r"^[+-]?[0-9]{1,38}$",
    "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp_ntz": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?$",
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             infer: bool = False, mode: str = "PERMISSIVE") -> DataFrame:
    """SRC1 / SRC8.

    * no schema, ``infer=False``: every column a string, named by the header
      (the reference's batch reads);
    * ``schema``: typed read, no inference pass (preferred at scale);
    * ``infer=True``: types guessed by Spark in an extra pass over the data
      (SRC8).  One odd value turns a column into text; ``infer_types`` says
      how many do not fit, and what to do about them.
    """
    reader = spark.read.option("header", True).option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def _fits(c: Column, kind: str) -> Column:
    """Whether a text is written as a ``kind`` and in its range."""
    text = F.trim(c)
    cast = text.try_cast(kind)
    return text.rlike(_SHAPES[kind]) & cast.isNotNull()


def type_counts(raw: DataFrame, kinds: tuple[str, ...] = LATTICE, nulls: tuple[str, ...] = ("",)) -> DataFrame:
    """``position, column_name, filled, <kind>…``: for each text column the
    values that are there (not null, and not one of ``nulls`` when trimmed)
    and how many of them fit each type.

    One scan and one aggregation with a row per task: counts do not depend on
    the order of rows or files, so neither do the types they lead to.
    """
    there = {c: F.when(~F.trim(F.col(c)).isin(*nulls), F.col(c)) for c in raw.columns}
    counts = [F.struct(F.count(there[c]).alias("filled"),
                       *[F.count(F.when(_fits(there[c], k), True)).alias(f"k{i}") for i, k in enumerate(kinds)])
              .alias(f"__{n}") for n, c in enumerate(raw.columns)]
    one = raw.agg(*counts)
    rows = F.array(*[F.struct(F.lit(n).alias("position"), F.lit(c).alias("column_name"), F.col(f"__{n}.filled").alias("filled"),
                              *[F.col(f"__{n}.k{i}").alias(k) for i, k in enumerate(kinds)])
                     for n, c in enumerate(raw.columns)])
    return one.select(F.inline(rows))


def inferred_types(counts: DataFrame, misfits: float = 0.0, kinds: tuple[str, ...] = LATTICE) -> DataFrame:
    """``position, column_name, type, filled, misfit`` out of ``type_counts``:
    the type that most values fit, the narrowest of several, if all but a share
    of ``misfits`` do, else (and for an empty column) a string; and how many
    do not fit.  So a few long numbers widen a column, and a few words do not."""
    least = F.col("filled") - F.floor(F.col("filled") * F.lit(misfits))
    fitting = F.array(*[F.struct(F.lit(k).alias("type"), F.col(f"`{k}`").alias("n")) for k in kinds])
    most = F.array_max(F.transform(fitting, lambda x: x["n"]))
    first = F.get(F.filter(fitting, lambda x: (x["n"] == most) & (x["n"] >= least) & (x["n"] > 0)), F.lit(0))
    return counts.select("position", "column_name", F.coalesce(first["type"], F.lit("string")).alias("type"), "filled",
                         F.coalesce(F.col("filled") - first["n"], F.lit(0)).alias("misfit"))


def typed(raw: DataFrame, types: dict[str, str], nulls: tuple[str, ...] = ("",)) -> DataFrame:
    """Text columns as the given types; what does not fit becomes null, and
    ``misfits`` lists the columns where that happened."""
    out, wrong = [], []
    for c in raw.columns:
        kind = types.get(c, "string")
        there = F.when(~F.trim(F.col(c)).isin(*nulls), F.col(c))
        if kind == "string":
            out.append(there.alias(c))
            continue
        ok = F.coalesce(_fits(there, kind), F.lit(False))
        out.append(F.when(ok, F.trim(there).try_cast(kind)).alias(c))
        wrong.append(F.when(there.isNotNull() & ~ok, F.lit(c)))
    listed = F.array_compact(F.array(*wrong)) if wrong else F.array().cast("array<string>")
    return raw.select(*out, listed.alias("misfits"))


def read_csv_inferred(spark: SparkSession, path: str, misfits: float = 0.0, nulls: tuple[str, ...] = ("",)) -> DataFrame:
    """SRC8 with types that are stable between runs: one counting pass, then a
    typed scan.  One row per column reaches the driver."""
    raw = read_csv(spark, path)
    rows = inferred_types(type_counts(raw, nulls=nulls), misfits).collect()
    return typed(raw, {r["column_name"]: r["type"] for r in rows}, nulls)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write ``df`` as headed CSV files (one directory)."""
    df.write.mode(mode).option("header", True).csv(path)
    return path
