"""Derive a larger copy of the test tables, for scaling runs.

    python tools/derive_scaled.py SRC_SF_DIR OUT_DIR [COPIES]

Writes ``COPIES`` (default 10) copies of customer, orders, lineitem and
events with their keys offset per copy, so that the copies are distinct
entities; nation and region are copied as they are.  Every table is derived
by Spark from the given ones.  Use a fresh OUT_DIR (``mktemp -d``).
"""

from __future__ import annotations

import os
import sys
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Key offsets per copy: larger than any key in the given tables.
OFFSETS = {
    "customer": {"c_custkey": 10**7},
    "orders": {"o_orderkey": 10**8, "o_custkey": 10**7},
    "lineitem": {"l_orderkey": 10**8},
    "events": {"event_id": 10**8, "user_id": 10**6},
}


def main(argv: list[str]) -> None:
    from pyspark.sql import DataFrame
    from pyspark.sql import functions as F

    from tidemark.session import get_session

    src, out = argv[0], argv[1]
    copies = int(argv[2]) if len(argv) > 2 else 10
    spark = get_session("local[8]", 8)
    for name, offsets in OFFSETS.items():
        df = spark.read.parquet(os.path.join(src, f"{name}.parquet"))
        parts = [df.withColumns({c: F.col(c) + F.lit(i * step).cast(df.schema[c].dataType)
                                 for c, step in offsets.items()}) for i in range(copies)]
        reduce(DataFrame.unionByName, parts).write.parquet(os.path.join(out, f"{name}.parquet"))
    for name in ("nation", "region"):
        spark.read.parquet(os.path.join(src, f"{name}.parquet")).write.parquet(
            os.path.join(out, f"{name}.parquet"))


if __name__ == "__main__":
    main(sys.argv[1:])
