"""Menu SQL over registered views equals the DataFrame queries; DDL."""

from conftest import SF0001
from tidemark.plans import catalogue as C
from tidemark.plans import queries as Q
from tidemark.sources.csv import read_csv, write_csv
from tidemark.session import scratch_path


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_views_and_free_sql(spark):
    dim = Q.merged_dim(spark, SF0001)
    C.register({"dim_now": dim})
    got = C.run_sql(spark, "SELECT city, count(1) AS cnt FROM dim_now WHERE is_current GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
    assert _rows(got) == _rows(Q.q_menu_top_cities(spark, SF0001))
    assert "dim_now" in {r.tableName for r in C.show_tables(spark).collect()}


def test_free_sql_and_ddl(spark):
    C.ensure_namespace(spark, "tm_demo")
    assert "tm_demo" in {r[0] for r in spark.sql("SHOW NAMESPACES").collect()}
    spark.sql("CREATE TABLE IF NOT EXISTS tm_demo.t (id INT) USING parquet")
    def tables():  # temp views are listed too; keep the namespace's own
        return [r.tableName for r in C.show_tables(spark, "tm_demo").collect() if not r.isTemporary]
    assert tables() == ["t"]
    C.drop_table(spark, "tm_demo.t")
    assert tables() == []
    assert C.run_sql(spark, "  SELECT 1 AS one  ").first().one == 1


def test_csv_all_string_and_typed(spark):
    cust = spark.read.parquet(f"{SF0001}/customer.parquet")
    path = write_csv(cust, scratch_path(spark, "t", "csv"))
    strings = read_csv(spark, path)
    assert all(t == "string" for _, t in strings.dtypes)
    typed = read_csv(spark, path, schema=cust.schema)
    assert typed.exceptAll(cust).count() == 0 and cust.exceptAll(typed).count() == 0
    inferred = read_csv(spark, path, infer=True)
    assert dict(inferred.dtypes)["c_acctbal"] == "double"
