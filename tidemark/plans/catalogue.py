"""Views, namespaces and free SQL (QRY1, QRY5, SRC7, DDL1, DDL3, DDL4).

Views are registered on the session that owns the DataFrame (L3), and free
SQL runs through ``spark.sql`` and comes back as a DataFrame: the caller
limits what it brings to the driver.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def register(views: dict[str, DataFrame]) -> None:
    """DDL4: name each DataFrame for SQL on its own session."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def ensure_namespace(spark: SparkSession, ns: str) -> None:
    """DDL1."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quoted(ns)}")


def drop_table(spark: SparkSession, name: str) -> None:
    """DDL3."""
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")


def show_tables(spark: SparkSession, ns: str | None = None) -> DataFrame:
    """SRC7 / QRY1."""
    return spark.sql(f"SHOW TABLES IN {quoted(ns)}" if ns else "SHOW TABLES")


def run_sql(spark: SparkSession, text: str, args: dict[str, Any] | None = None,
            views: dict[str, DataFrame] | None = None) -> DataFrame:
    """QRY5: free SQL over the catalog and registered views.

    ``args`` binds named markers (``:city``): values (dates, numbers, text,
    null) reach the plan as typed literals and are never spliced into the
    text, so a quote in a value is a quote and filters on it are pushed down.
    ``IDENTIFIER(:name)`` takes a bound name.  ``views`` are registered first,
    on the session of each DataFrame.
    """
    register(views or {})
    return spark.sql(text.strip(), args=args or {})


def quoted(name: str) -> str:
    """A name as SQL text, its parts quoted; anything but letters, digits and
    underscores is an error."""
    parts = name.split(".")
    for p in parts:
        if not p.replace("_", "").isalnum():
            raise ValueError(f"bad identifier {name!r}")
    return ".".join(f"`{p}`" for p in parts)
