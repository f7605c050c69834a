"""Queries of what a table needs besides: rollups, semi and anti joins, set operations, JSON and maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import query, table


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity, GROUPING_ID(l_returnflag, l_linestatus)::BIGINT AS gid FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def class_rollup(spark, sf):
    t = table(spark, sf, "lineitem").rollup("l_returnflag", "l_linestatus")
    return t.agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"), F.grouping_id().alias("gid"))


@query("SELECT l_returnflag, l_linenumber, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linenumber), ())")
def class_grouping_sets(spark, sf):
    t = table(spark, sf, "lineitem")
    return t.groupingSets([["l_returnflag"], ["l_linenumber"], []], "l_returnflag", "l_linenumber").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 150000)")
def semi_join(spark, sf):
    big = table(spark, sf, "orders").where("o_totalprice > 150000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").join(big, "c_custkey", "left_semi").select("c_custkey", "c_nationkey")


@query("SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity = 50)")
def anti_join(spark, sf):
    whole = table(spark, sf, "lineitem").where("l_quantity = 50").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf, "part").join(whole, "p_partkey", "left_anti").select("p_partkey")


@query("""SELECT 'both' AS kind, k FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'customers', k FROM (SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier)""")
def set_operations(spark, sf):
    a, b = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"))
    return a.intersect(b).select(F.lit("both").alias("kind"), "k").union(a.subtract(b).select(F.lit("customers"), "k"))


@query("""SELECT n_nationkey, n_nationkey::BIGINT AS region_id, 'zone ' || n_nationkey AS name, (n_nationkey * 1.5)::DOUBLE AS x, 2::BIGINT AS corners, CASE WHEN n_nationkey % 2 = 0 THEN 'even' END AS parity FROM nation""")
def json_features(spark, sf):
    """Features written as JSON and read back: by schema, by path, and the size of an array."""
    k = F.col("n_nationkey")
    parity = F.when(k % 2 == 0, F.lit("even"))
    feature = F.to_json(F.struct(F.struct(k.cast("long").alias("id"), F.concat(F.lit("zone "), k.cast("string")).alias("name"), parity.alias("parity")).alias("properties"), F.array(k * 1.5, k * 2.5).alias("at")))
    t = table(spark, sf, "nation").select("n_nationkey", feature.alias("j"))
    read = F.from_json("j", "properties struct<id: bigint, name: string>, at array<double>")
    return t.select("n_nationkey", read["properties"]["id"].alias("region_id"), read["properties"]["name"].alias("name"), read["at"][0].alias("x"), F.json_array_length(F.get_json_object("j", "$.at")).cast("long").alias("corners"), F.get_json_object("j", "$.properties.parity").alias("parity"))


@query("""SELECT l_suppkey, count(DISTINCT l_returnflag) AS n_keys, count(*) FILTER (l_returnflag = 'R') AS returned, coalesce(max(l_quantity) FILTER (l_returnflag = 'A'), -1) AS most_a FROM lineitem GROUP BY 1""")
def map_attributes(spark, sf):
    """Attributes of an object in a map: built from pairs, filtered, looked up with a default."""
    per = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("n"), F.max("l_quantity").alias("most"))
    m = per.groupBy("l_suppkey").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", F.struct("n", "most")))).alias("m"))
    known = F.map_filter("m", lambda k, v: v["n"] > 0)
    return m.select("l_suppkey", F.size(F.map_keys(known)).cast("long").alias("n_keys"), F.coalesce(F.try_element_at("m", F.lit("R"))["n"], F.lit(0)).cast("long").alias("returned"), F.coalesce(F.try_element_at("m", F.lit("A"))["most"], F.lit(-1.0)).alias("most_a"))


@query("""SELECT event_id, CASE WHEN value - 50 > 0 THEN round(ln(value - 50), 6) END AS log_value, CASE WHEN value - 50 >= 0 THEN round(sqrt(value - 50), 6) END AS root_value FROM events""")
def safe_functions(spark, sf):
    """Logarithms and roots outside their range are null, neither NaN nor an error."""
    x = F.col("value") - 50
    return table(spark, sf, "events").select("event_id", F.when(x > 0, F.round(F.ln(F.when(x > 0, x)), 6)).alias("log_value"), F.when(x >= 0, F.round(F.sqrt(F.when(x >= 0, x)), 6)).alias("root_value"))
