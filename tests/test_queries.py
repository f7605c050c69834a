"""Every registered query runs; those with SQL give the rows that DuckDB gives."""

import pytest

from gridloom import plans

from .conftest import SF

plans.load()


def same_rows(con, frame, sql):
    con.register("spark_rows", frame.toArrow())
    con.execute("create or replace temp table got as select * from spark_rows")
    con.execute(f"create or replace temp table want as {sql}")
    names = [sorted(x[0] for x in con.execute(f"describe {t}").fetchall()) for t in ("got", "want")]
    assert names[0] == names[1]
    cols = ", ".join(f'"{c}"' for c in names[0])
    for a, b in (("got", "want"), ("want", "got")):
        assert con.execute(f"select {cols} from {a} except all select {cols} from {b} limit 3").fetchall() == []
    return con.execute("select count(*) from got").fetchall()[0][0]


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_against_sql(spark, duck, name):
    assert same_rows(duck, plans.QUERIES[name](spark, SF), plans.SQL[name]) > 0 or name == "interval_overlap"


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.SQL)))
def test_rows_only(spark, name):
    assert plans.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["l_suppkey", "nb_cells", "mean_b0", "var_b0", "mean_b1", "var_b1"]


def test_filters_and_columns_reach_the_scan(spark):
    from pyspark.sql import functions as F

    t = plans.table(spark, SF, "lineitem").where(F.col("l_discount") > 0.05).select("l_orderkey")
    plan = t._jdf.queryExecution().toString()
    assert "GreaterThan(l_discount,0.05)" in plan and "ReadSchema: struct<l_orderkey:bigint,l_discount:double>" in plan
