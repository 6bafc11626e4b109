"""The driver contract: bench names, query/oracle pairing, entry schema."""

import bench
import __spark_entry__ as E


def test_bench_runs_registered_queries():
    assert set(bench.HEADLINE) <= set(E.queries())


def test_every_query_has_sql():
    from tidemark.plans.queries import QUERIES

    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())
    assert all(isinstance(q, str) and q.strip() for q in E.oracle_sql().values())

