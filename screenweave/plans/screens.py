"""Selections, conversions, audits, reports and work lists over the star schema, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenweave.operators import screen
from screenweave.plans.registry import _P, _points, long, query, r


@query("SELECT event_id, event_type FROM events WHERE value / 500 >= 0.25")
def confident_reads(t):
    return screen.confident(t.events.withColumn("confidence", F.col("value") / 500), 0.25).select("event_id", "event_type")


@query("SELECT l_orderkey, l_linenumber::BIGINT AS line FROM lineitem WHERE l_suppkey IN (1, 10)")
def rows_of_wells(t):
    rows = t.lineitem.withColumn("position", F.concat(F.lit("A/"), F.col("l_suppkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string")))
    return screen.of_wells(rows, ["A/1/0", "A/10"]).select("l_orderkey", long("l_linenumber").alias("line"))


@query("""
WITH n AS (SELECT max(c_custkey) AS k FROM customer)
SELECT c_custkey FROM customer, n WHERE floor(round(c_custkey * 23 / nullif(k, 0)::DOUBLE) * k / 23.0) = c_custkey OR k < 24""")
def completeness_sample(t):
    return screen.evenly_spaced(t.customer.select("c_custkey"), 24, "c_custkey").select("c_custkey")


@query("SELECT l_suppkey AS store, count(*) AS samples, count_if(l_tax = 0)::BIGINT AS blank FROM lineitem GROUP BY 1 HAVING count_if(l_tax = 0) > 0")
def blank_stores(t):
    return screen.blank(t.lineitem.withColumnRenamed("l_suppkey", "store"), ["store"], "l_tax")


@query("""
WITH w AS (SELECT DISTINCT l_suppkey AS experiment, l_linenumber AS round FROM lineitem), a AS (SELECT s_suppkey AS experiment, s_nationkey % 8 AS n FROM supplier WHERE s_acctbal > 0)
SELECT experiment, round::BIGINT AS round FROM w LEFT JOIN a USING (experiment) WHERE round >= coalesce(n, 0)""")
def missing_rounds(t):
    w = t.lineitem.select(F.col("l_suppkey").alias("experiment"), long("l_linenumber").alias("round")).distinct()
    return screen.missing_rounds(w, t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("experiment"), (F.col("s_nationkey") % 8).alias("n_rounds")))


@query("SELECT p_partkey, round(2 * sqrt(p_size / pi()) * 0.325, 6) AS diameter, round(p_retailprice * 0.325, 4) AS p_retailprice_um, round(p_size * (0.325 * 0.325), 4) AS p_size_um2 FROM part")
def micrometres(t):
    o = screen.in_units(t.part, ["p_retailprice"], ["p_size"], 0.325)
    return o.select("p_partkey", r(screen.equivalent_diameter(F.col("p_size"), 0.325), 6).alias("diameter"), r("p_retailprice_um").alias("p_retailprice_um"), r("p_size_um2").alias("p_size_um2"))


@query("SELECT s_suppkey, CASE WHEN s_nationkey < 20 THEN s_suppkey END::INT AS number FROM supplier")
def experiment_numbers(t):
    prefix = F.when(F.col("s_nationkey") < 10, "ops").when(F.col("s_nationkey") < 20, "op").otherwise("exp")
    return t.supplier.select("s_suppkey", screen.experiment_number(F.concat(prefix, F.lpad(F.col("s_suppkey").cast("string"), 6, "0"), F.lit("_x"))).alias("number"))


@query("""
WITH c AS (SELECT p_brand || p_name AS code FROM part), k AS (SELECT substring(code, 1, 10) AS key, min(code) AS code FROM c GROUP BY 1), n AS (SELECT substring(p_brand || p_name, 1, 10) AS b, count(*) AS n FROM part GROUP BY 1 UNION ALL SELECT o_orderpriority, count(*) FROM orders GROUP BY 1)
SELECT coalesce(substring(code, 4, 10), b) AS barcode, n FROM n LEFT JOIN k ON key = b""")
def remapped_barcodes(t):
    code = F.concat("p_brand", "p_name")
    n = t.part.groupBy(F.substring(code, 1, 10).alias("barcode")).agg(F.count("*").alias("n")).unionByName(t.orders.groupBy(F.col("o_orderpriority").alias("barcode")).agg(F.count("*").alias("n")))
    return screen.remapped(n, t.part.select(code.alias("sgRNA")), 10, 3)


@query("""
WITH a AS (SELECT s_nationkey % 5 AS store, s_suppkey % 6 AS i, min('c' || (s_suppkey % 4)) AS channel FROM supplier GROUP BY 1, 2), b AS (SELECT n_regionkey AS store, n_nationkey % 7 AS i, min('c' || (n_nationkey % 4)) AS expected FROM nation GROUP BY 1, 2)
SELECT coalesce(a.store, b.store)::BIGINT AS store, coalesce(a.i, b.i)::BIGINT AS index, channel, expected, CASE WHEN expected IS NULL THEN 'extra' WHEN channel IS NULL THEN 'missing' WHEN channel <> expected THEN 'renamed' ELSE 'ok' END AS finding FROM a FULL JOIN b ON a.store = b.store AND a.i = b.i""")
def channel_audit(t):
    of = lambda df, store, key, n: df.groupBy(long(store).alias("store"), long(F.col(key) % n).alias("index")).agg(F.min(F.concat(F.lit("c"), (F.col(key) % 4).cast("string"))).alias("channel"))
    return screen.channel_audit(of(t.supplier, F.col("s_nationkey") % 5, "s_suppkey", 6), of(t.nation, "n_regionkey", "n_nationkey", 7), ["store"])


@query("""
SELECT c_nationkey::BIGINT AS pair, round(sum(CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal END), 2) AS "BUILDING", round(sum(CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal END), 2) AS "MACHINERY" FROM customer GROUP BY 1""")
def combined_metrics(t):
    m = t.customer.groupBy(long("c_nationkey").alias("pair"), F.col("c_mktsegment").alias("metric")).agg(r(F.sum("c_acctbal"), 2).alias("value"))
    return screen.combined_metrics(m, ["pair"], ["BUILDING", "MACHINERY"])


@query("SELECT s_nationkey::BIGINT AS well, round(max(CASE WHEN s_acctbal > 0 THEN s_acctbal END), 2) AS overlap FROM supplier GROUP BY 1 HAVING max(CASE WHEN s_acctbal > 0 THEN s_acctbal END) IS NULL OR max(CASE WHEN s_acctbal > 0 THEN s_acctbal END) < 6000")
def wells_below_threshold(t):
    s = t.supplier.select(long("s_nationkey").alias("well"), F.when(F.col("s_acctbal") > 0, r("s_acctbal", 2)).alias("overlap"))
    return screen.below_threshold(s, ["well"], "overlap", 6000.0)


@query(f"WITH p AS ({_P}) SELECT id FROM p WHERE (label % 3 = 0 OR label < 2) AND size > 1")
def control_cells(t):
    p = _points(t).withColumn("gene", F.when(F.col("label") % 3 == 0, None).when(F.col("label") < 2, F.lit("NTC_1")).otherwise(F.lit("G")))
    return screen.control_pool(p.withColumn("segmentation_id", F.col("size") - 1)).select("id")


@query("""
WITH u AS (SELECT c_nationkey AS well, c_custkey AS k, a.k AS iss, s.s_suppkey AS paint, CASE WHEN c_acctbal > 5000 THEN c_mktsegment ELSE '0' END AS b FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') a ON a.k = c_custkey LEFT JOIN supplier s ON s.s_suppkey = c_custkey)
SELECT well::BIGINT AS well, count(*) AS cells, count(iss) AS with_iss, count(paint) AS with_paint, count_if(b <> '0')::BIGINT AS with_barcode, count_if(iss IS NOT NULL AND paint IS NOT NULL)::BIGINT AS with_all,
  round(100.0 * count(iss) / count(*), 2) AS pct_iss, round(100.0 * count(paint) / count(*), 2) AS pct_paint, round(100.0 * count_if(b <> '0') / count(*), 2) AS pct_barcode, round(100.0 * count_if(iss IS NOT NULL AND paint IS NOT NULL) / count(*), 2) AS pct_all FROM u GROUP BY 1""")
def linking_report(t):
    c = t.customer.select(long("c_nationkey").alias("well"), F.col("c_custkey").alias("k"), F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment")).otherwise("0").alias("barcode"))
    a = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"), F.col("o_custkey").alias("iss")).distinct()
    u = c.join(a, "k", "left").join(t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_suppkey").alias("paint")), "k", "left")
    return screen.linking_report(u, ["well"], {"iss": "iss", "paint": "paint"})


@query("""
WITH k AS (SELECT n_regionkey AS g, n_name AS i, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) - 1 AS k FROM nation)
SELECT g::BIGINT AS region, (k // 2)::BIGINT AS batch, string_agg(i, ',' ORDER BY i) AS items FROM k GROUP BY 1, 2""")
def work_batches(t):
    o = screen.batches(t.nation.select(long("n_regionkey").alias("region"), F.col("n_name").alias("item")), ["region"], "item", 2)
    return o.select("region", "batch", F.array_join("item", ",").alias("items"))


@query("SELECT n_name, r_name, CASE WHEN n_regionkey > 3 THEN 20 * ceil(n_regionkey / 3.0) ELSE 20 END::BIGINT AS limit_minutes FROM nation, region WHERE r_name <> 'ASIA'")
def work_list(t):
    steps = t.nation.select("n_name", long("n_regionkey").alias("n_wells"), F.lit(20).cast("long").alias("minutes"))
    return screen.time_limits(screen.combined(steps, t.region.where("r_name <> 'ASIA'").select("r_name"))).select("n_name", "r_name", long("limit_minutes").alias("limit_minutes"))
