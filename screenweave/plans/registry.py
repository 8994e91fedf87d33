"""Registered queries by name, with the SQL that gives the same rows.

The screen's tables are stood in for by the star schema: orders are cells, parts are guides and their brands genes,
suppliers are wells, users' events are tracks, embeddings are feature vectors with the first two dimensions as a place.
Doubles are rounded, as sums depend on their order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenweave.functions import expressions as X
from screenweave.operators import barcodes, keyed, labels, rasters, spatial, stats, tracks

FLAGSHIP = "plate_statistics"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Tables of a folder by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def r(c: Column | str, places: int = 4) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, places)


def long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


# Plate statistics and counts


@query("""
SELECT CASE WHEN grouping(l_suppkey) = 1 THEN 'ALL' ELSE l_suppkey::VARCHAR END AS well, count(*) AS reads, count(DISTINCT l_orderkey) AS cells, count(DISTINCT l_partkey) AS guides,
  round(avg(l_quantity), 4) AS mean_quantity, round(100.0 * count_if(l_returnflag = 'R') / count(*), 4) AS returned_pct
FROM lineitem GROUP BY GROUPING SETS ((l_suppkey), ())""")
def plate_statistics(t):
    aggs = [F.count("*").alias("reads"), F.countDistinct("l_orderkey").alias("cells"), F.countDistinct("l_partkey").alias("guides"), r(F.avg("l_quantity")).alias("mean_quantity"), r(100.0 * F.count_if(F.col("l_returnflag") == "R") / F.count("*")).alias("returned_pct")]
    return keyed.with_pooled(t.lineitem, "l_suppkey", aggs).select(F.col("l_suppkey").alias("well"), "reads", "cells", "guides", "mean_quantity", "returned_pct")


@query("""
WITH n AS (SELECT p_brand, count(DISTINCT l_orderkey) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT round(avg(n), 4) AS mean, median(n)::DOUBLE AS median, min(n) AS min, max(n) AS max, count(*) AS groups FROM n""")
def cells_per_gene(t):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return keyed.per_group_summary(lines, "p_brand", "l_orderkey").withColumn("mean", r("mean"))


@query("SELECT event_type, count(*) AS count FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def value_counts(t):
    return keyed.value_counts(t.events, "event_type")


@query("SELECT p_brand, count(DISTINCT l_orderkey) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 10")
def top_genes(t):
    return keyed.top_values(t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")), "p_brand", "l_orderkey", 10)


@query("SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) = 2 AND count(DISTINCT l_suppkey) = 2")
def doublets(t):
    return keyed.doublets(t.lineitem, "l_orderkey", "l_suppkey")


@query("""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_suppkey FROM lineitem
QUALIFY min(l_suppkey) OVER (PARTITION BY l_orderkey) = max(l_suppkey) OVER (PARTITION BY l_orderkey) AND row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) = 1""")
def multiplet_removal(t):
    return keyed.singlets(t.lineitem, ["l_orderkey"], "l_suppkey", ["l_linenumber", "l_partkey"]).select("l_orderkey", long("l_linenumber").alias("l_linenumber"), "l_suppkey")


@query("""
WITH c AS (SELECT o_custkey, count(DISTINCT o_orderpriority) AS guides, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS genes FROM orders GROUP BY 1)
SELECT count_if(guides = 1)::BIGINT AS singlets, count_if(guides > 1)::BIGINT AS multiplets, count_if(guides = 0)::BIGINT AS no_guide, count_if(guides > 0 AND genes = 0)::BIGINT AS control_only FROM c""")
def dedupe_report(t):
    return keyed.dedupe_report(t.orders.withColumn("gene", F.when(F.col("o_orderstatus") == "F", "g")), "o_custkey", "o_orderpriority", "gene")


@query("""
WITH v AS (SELECT user_id, event_type, count(*) AS votes FROM events GROUP BY 1, 2)
SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY votes DESC, event_type) = 1""")
def majority_vote(t):
    return keyed.majority_vote(t.events, "user_id", "event_type")


@query("""
WITH v AS (SELECT user_id, event_type, count(*) AS votes FROM events GROUP BY 1, 2),
m AS (SELECT event_type FROM v QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY votes DESC, event_type) = 1)
SELECT event_type, count(*) AS cells FROM m GROUP BY 1""")
def majority_recount(t):
    return keyed.majority_vote(t.events, "user_id", "event_type").groupBy("event_type").agg(F.count("*").alias("cells"))


@query("SELECT o_custkey, o_orderkey, round(o_totalprice, 4) AS price FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
def keep_best(t):
    return keyed.keep_first(t.orders, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"]).select("o_custkey", "o_orderkey", r("o_totalprice").alias("price"))


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
def last_wins_lookup(t):
    return keyed.last_wins(t.events, "user_id", "event_type", "event_id")


@query("""
SELECT CASE WHEN l.doc_id IS NULL THEN 'right_only' WHEN d.doc_id IS NULL THEN 'left_only' ELSE 'both' END AS side, count(*) AS n
FROM (SELECT doc_id FROM labels WHERE quality = 1) l FULL OUTER JOIN (SELECT doc_id FROM documents WHERE lang = 'en') d USING (doc_id) GROUP BY 1""")
def outer_join_indicator(t):
    return keyed.outer_indicator(t.labels.where("quality = 1").select("doc_id"), t.documents.where("lang = 'en'").select("doc_id"), ["doc_id"])


@query("SELECT n_name, coalesce(n, 0) AS n FROM nation LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey")
def left_join_fill(t):
    n = t.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    return keyed.left_fill(t.nation.select("n_nationkey", "n_name"), n, ["n_nationkey"], {"n": 0}).select("n_name", "n")


@query("SELECT c_custkey FROM customer ANTI JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON c_custkey = o_custkey")
def anti_join(t):
    return keyed.missing(t.customer.select("c_custkey"), t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("SELECT c_nationkey::BIGINT AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def key_intersection(t):
    return t.customer.select(long("c_nationkey").alias("k")).intersect(t.supplier.select(long("s_nationkey")))


@query("SELECT c_nationkey::BIGINT AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def key_difference(t):
    return t.customer.select(long("c_nationkey").alias("k")).subtract(t.supplier.where("s_acctbal > 5000").select(long("s_nationkey")))


@query("SELECT 'o' AS side, o_custkey AS k, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'c', c_custkey, 1 FROM customer")
def union_of_wells(t):
    return t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n")).select(F.lit("o").alias("side"), "k", "n").unionAll(t.customer.select(F.lit("c"), "c_custkey", F.lit(1).cast("long")))


@query("SELECT d.doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM benchmark b WHERE len(string_split(b.text, ' ')) = len(string_split(d.text, ' ')))")
def semi_join_projected(t):
    size = F.size(F.split("text", " ", -1)).alias("k")
    return t.documents.where("text is not null").select("doc_id", size).join(t.benchmark.where("text is not null").select(size).distinct(), "k", "left_semi").select("doc_id")


@query("""
SELECT event_type, user_id, round(value, 4) AS value FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) <= 3""")
def top_per_channel(t):
    return keyed.top_per_key(t.events, ["event_type"], [F.desc("value"), "event_id"], 3).select("event_type", "user_id", r("value").alias("value"))


@query("""
WITH h AS (SELECT doc_id, lang, md5(doc_id::VARCHAR) AS h, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR)) AS k, count(*) OVER (PARTITION BY lang) AS n, count(*) OVER () AS a FROM documents)
SELECT doc_id, lang FROM h ORDER BY CASE WHEN k > floor(50.0 * n / a) THEN 1 ELSE 0 END, h LIMIT 50""")
def stratified_sample(t):
    return keyed.stratified_sample(t.documents.select("doc_id", "lang"), "lang", F.md5(F.col("doc_id").cast("string")), 50)


@query("SELECT doc_id FROM documents ORDER BY md5(doc_id::VARCHAR) LIMIT 25")
def seeded_sample(t):
    return keyed.sample(t.documents.select("doc_id"), F.md5(F.col("doc_id").cast("string")), 25)


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR)) <= 5")
def capped_sample(t):
    return keyed.capped_sample(t.documents.select("doc_id", "source"), ["source"], F.md5(F.col("doc_id").cast("string")), 5)


@query("""
WITH s AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2), g AS (SELECT source, min(n) AS least FROM s GROUP BY 1 HAVING count(*) = 4)
SELECT doc_id, source, lang FROM documents JOIN g USING (source) QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY md5(doc_id::VARCHAR)) <= least""")
def equal_downsample(t):
    return keyed.equal_downsample(t.documents.select("doc_id", "source", "lang"), "source", "lang", F.md5(F.col("doc_id").cast("string")), 4)


@query("""
WITH c AS (SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT p_brand, n, round(100.0 * sum(n) OVER (ORDER BY n DESC, p_brand ROWS UNBOUNDED PRECEDING) / sum(n) OVER (), 4) AS cumulative_share FROM c""")
def cumulative_share(t):
    c = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.count("*").alias("n"))
    return keyed.cumulative_share(c, "n", [F.desc("n"), "p_brand"]).withColumn("cumulative_share", r("cumulative_share"))


@query("""
WITH c AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1), k AS (SELECT n, row_number() OVER (ORDER BY n DESC) AS k FROM c)
SELECT round(100.0 * sum(CASE WHEN k <= 10 THEN n ELSE 0 END) / sum(n), 4) AS share FROM k""")
def top_ten_share(t):
    return keyed.top_share(t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("n")), "n", 10).withColumn("share", r("share"))


@query("""
WITH m AS (SELECT o_orderstatus AS s, year(o_orderdate)::BIGINT * 12 + month(o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT s, m, n, n - lag(n, 1, 0) OVER (PARTITION BY s ORDER BY m) AS d_n FROM m""")
def lag_difference(t):
    m = t.orders.groupBy(F.col("o_orderstatus").alias("s"), (F.year("o_orderdate").cast("long") * 12 + F.month("o_orderdate")).alias("m")).agg(F.count("*").alias("n"))
    return keyed.lag_difference(m, ["s"], "m", ["n"])


@query("""
WITH d AS (SELECT DISTINCT c_nationkey AS g, c_custkey AS k FROM customer), i AS (SELECT g, k, k - row_number() OVER (PARTITION BY g ORDER BY k) AS isle FROM d),
s AS (SELECT g, isle, min(k) AS lo, max(k) AS hi FROM i GROUP BY 1, 2)
SELECT g::BIGINT AS g, string_agg(CASE WHEN lo = hi THEN lo::VARCHAR ELSE lo || '-' || hi END, ',' ORDER BY lo) AS ranges FROM s GROUP BY 1""")
def number_ranges(t):
    return keyed.number_ranges(t.customer.select(long("c_nationkey").alias("g"), F.col("c_custkey").alias("k")), ["g"], "k")


@query("""
WITH s AS (SELECT 0 AS step, 'customers' AS stage, count(DISTINCT c_custkey) AS n FROM customer UNION ALL SELECT 1, 'ordering', count(DISTINCT o_custkey) FROM orders
  UNION ALL SELECT 2, 'finished', count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus = 'F')
SELECT step::BIGINT AS step, stage, n, round(100.0 * n / lag(n) OVER (ORDER BY step), 4) AS kept_pct FROM s""")
def funnel(t):
    o = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    out = keyed.funnel([("customers", t.customer), ("ordering", o), ("finished", o.where("o_orderstatus = 'F'"))], "c_custkey")
    return out.select(long("step").alias("step"), "stage", "n", r("kept_pct").alias("kept_pct"))


# Statistics

_ITEM = "SELECT p_brand AS g, l_orderkey, l_linenumber, l_extendedprice AS v, l_quantity AS q FROM lineitem JOIN part ON l_partkey = p_partkey"


def _items(t):
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("g"), "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("v"), F.col("l_quantity").alias("q"))


@query(f"""
WITH i AS ({_ITEM}) SELECT g, l_orderkey, l_linenumber::BIGINT AS line, round(coalesce((v - avg(v) OVER w) / nullif(stddev_samp(v) OVER w, 0), 0), 3) AS z FROM i WINDOW w AS (PARTITION BY g)""")
def group_zscore(t):
    return stats.group_zscore(_items(t), ["g"], "v").select("g", "l_orderkey", long("l_linenumber").alias("line"), r("z", 3).alias("z"))


@query(f"""
WITH i AS ({_ITEM}), s AS (SELECT *, avg(v) OVER w AS m, stddev_samp(v) OVER w AS sd, quantile_cont(v, 0.5) OVER w AS md, quantile_cont(v, 0.25) OVER w AS q1, quantile_cont(v, 0.75) OVER w AS q3 FROM i WINDOW w AS (PARTITION BY g)),
d AS (SELECT *, quantile_cont(abs(v - md), 0.5) OVER w AS mad FROM s WINDOW w AS (PARTITION BY g)),
o AS (SELECT *, (abs(v - m) > 2.0 * sd)::BIGINT + (abs(0.6745 * (v - md) / mad) > 1.2)::BIGINT + (v < q1 - 0.5 * (q3 - q1) OR v > q3 + 0.5 * (q3 - q1))::BIGINT AS votes FROM d)
SELECT g, votes, CASE WHEN votes < 2 THEN 'NONE' WHEN v > md THEN 'HIGH' ELSE 'LOW' END AS direction, count(*) AS n FROM o GROUP BY ALL""")
def outlier_consensus(t):
    items = _items(t).groupBy("g", "v").agg(F.count("*").alias("rows"))  # equal prices of a brand as one row
    o = stats.outliers(items, ["g"], "v", z=2.0, modified=1.2, fence=0.5, count="rows")
    return o.groupBy("g", long("votes").alias("votes"), "direction").agg(F.sum("rows").alias("n"))


@query("""
WITH e AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
b AS (SELECT greatest(0, least(9, ceil((l_quantity - lo) / ((hi - lo) / 10)) - 1))::BIGINT AS bin, l_quantity AS x, l_extendedprice AS y FROM lineitem, e)
SELECT bin, count(*) AS n, round(median(x), 3) AS x_median, round(median(y), 3) AS y_median, round(quantile_cont(y, 0.25), 3) AS y_q25, round(quantile_cont(y, 0.75), 3) AS y_q75, round(avg(y), 3) AS y_mean, round(stddev_samp(y), 3) AS y_std FROM b GROUP BY 1""")
def binned_medians(t):
    b = stats.binned(t.lineitem, "l_quantity", "l_extendedprice", 10)
    return b.select(long("bin").alias("bin"), "n", *[r(c, 3).alias(c) for c in ("x_median", "y_median", "y_q25", "y_q75", "y_mean", "y_std")])


@query(f"""
WITH i AS ({_ITEM}) SELECT g, count(*) AS n, round(regr_slope(v, q), 3) AS slope, round(regr_intercept(v, q), 3) AS intercept, round(corr(v, q), 4) AS r, round(regr_r2(v, q), 4) AS r2 FROM i GROUP BY 1""")
def growth_regression(t):
    o = stats.regression(_items(t), "q", "v", ["g"])
    return o.select("g", "n", r("slope", 3).alias("slope"), r("intercept", 3).alias("intercept"), r("r").alias("r"), r("r2").alias("r2"))


@query(f"""
WITH i AS ({_ITEM}), k AS (SELECT g, rank() OVER (PARTITION BY g ORDER BY v) + (count(*) OVER (PARTITION BY g, v) - 1) / 2.0 AS rv, rank() OVER (PARTITION BY g ORDER BY q) + (count(*) OVER (PARTITION BY g, q) - 1) / 2.0 AS rq FROM i)
SELECT g, round(corr(rv, rq), 4) AS rho FROM k GROUP BY 1""")
def spearman(t):
    return stats.spearman(_items(t), "v", "q", ["g"]).select("g", r("rho").alias("rho"))


@query("""
WITH c AS (SELECT corr(l_extendedprice, l_quantity) AS xy, corr(l_extendedprice, l_discount) AS xg, corr(l_quantity, l_discount) AS yg FROM lineitem)
SELECT round((xy - xg * yg) / sqrt((1 - xg * xg) * (1 - yg * yg)), 5) AS partial_r FROM c""")
def partial_correlation(t):
    return stats.partial_correlation(t.lineitem, "l_extendedprice", "l_quantity", "l_discount").withColumn("partial_r", r("partial_r", 5))


@query("""
WITH m AS (SELECT l_returnflag || l_linestatus AS g, l_suppkey AS i, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2)
SELECT a.g AS a, b.g AS b, round(corr(a.v, b.v), 4) AS r, count(*) AS common FROM m a JOIN m b ON a.i = b.i AND a.g < b.g GROUP BY 1, 2""")
def experiment_correlations(t):
    m = t.lineitem.groupBy(F.concat("l_returnflag", "l_linestatus").alias("g"), F.col("l_suppkey").alias("i")).agg(F.sum("l_quantity").alias("v"))
    return stats.correlation_matrix(m, "i", "g", "v").select("a", "b", r("r").alias("r"), "common")


@query("""
SELECT 'l_quantity' AS metric, round(corr(l_quantity, l_extendedprice), 5) AS r FROM lineitem UNION ALL SELECT 'l_discount', round(corr(l_discount, l_extendedprice), 5) FROM lineitem UNION ALL SELECT 'l_tax', round(corr(l_tax, l_extendedprice), 5) FROM lineitem""")
def metric_ranking(t):
    return stats.rank_by_correlation(t.lineitem, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice").select("metric", r("r", 5).alias("r"))


@query("""
WITH k AS (SELECT o_orderstatus = 'F' AS f, rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2.0 AS k FROM orders),
s AS (SELECT sum(CASE WHEN f THEN k END) AS s, count_if(f) AS n1, count_if(NOT f) AS n2 FROM k)
SELECT n1::BIGINT AS n1, n2::BIGINT AS n2, round(s - n1 * (n1 + 1) / 2.0, 1) AS u, round((s - n1 * (n1 + 1) / 2.0 - n1 * n2 / 2.0) / sqrt(n1::DOUBLE * n2 * (n1 + n2 + 1) / 12.0), 4) AS z FROM s""")
def mann_whitney(t):
    return stats.mann_whitney(t.orders, "o_totalprice", "o_orderstatus", "F").select("n1", "n2", r("u", 1).alias("u"), r("z").alias("z"))


@query("""
WITH d AS (SELECT round(l_discount - l_tax, 6) AS d FROM lineitem WHERE l_discount <> l_tax), k AS (SELECT d, rank() OVER (ORDER BY abs(d)) + (count(*) OVER (PARTITION BY abs(d)) - 1) / 2.0 AS k FROM d)
SELECT count(*) AS n, round(sum(CASE WHEN d > 0 THEN k ELSE 0 END), 1) AS w_plus, round(sum(CASE WHEN d < 0 THEN k ELSE 0 END), 1) AS w_minus FROM k""")
def wilcoxon(t):
    d = t.lineitem.select(F.round(F.col("l_discount") - F.col("l_tax"), 6).alias("d"), F.lit(0.0).alias("o"))
    return stats.wilcoxon(d, "d", "o").select("n", r("w_plus", 1).alias("w_plus"), r("w_minus", 1).alias("w_minus"))


@query("""
WITH s AS (SELECT l_shipdate::DATE AS day, l_returnflag, CASE WHEN l_linestatus = 'O' THEN 'Signal' ELSE 'Background' END AS kind, l_extendedprice AS v FROM lineitem),
g AS (SELECT l_returnflag, year(day)::BIGINT % 3 AS cycle, kind, avg(v) AS m, stddev_pop(v) AS sd FROM s GROUP BY 1, 2, 3),
w AS (SELECT a.l_returnflag, a.cycle, a.m AS s, b.m AS b, a.sd AS ss, b.sd AS bs FROM g a JOIN g b ON a.l_returnflag = b.l_returnflag AND a.cycle = b.cycle AND a.kind = 'Signal' AND b.kind = 'Background')
SELECT l_returnflag, cycle, round((s - b) / (bs + 1e-9), 4) AS snr, round(s / (b + 1e-9), 4) AS sbr, round(3 * bs / ((s - b) + 1e-9), 2) AS lld, round(1 - 3 * (ss + bs) / (abs(s - b) + 1e-9), 2) AS z_prime FROM w""")
def signal_noise(t):
    kind = F.when(F.col("l_linestatus") == "O", "Signal").otherwise("Background")
    g = t.lineitem.groupBy("l_returnflag", (F.year("l_shipdate") % 3).cast("long").alias("cycle"), kind.alias("kind")).agg(F.avg("l_extendedprice").alias("m"), F.stddev_pop("l_extendedprice").alias("sd"))
    n = stats.two_level_noise(g, ["l_returnflag", "cycle"], "kind", "m", "sd")
    return n.select("l_returnflag", "cycle", r("snr").alias("snr"), r("sbr").alias("sbr"), r("lld", 2).alias("lld"), r("z_prime", 2).alias("z_prime"))


@query(f"""
WITH i AS ({_ITEM}), k AS (SELECT g, v, row_number() OVER (PARTITION BY g ORDER BY v DESC) AS k, count(*) OVER (PARTITION BY g) AS n FROM i)
SELECT g, round(median(v), 4) AS median_top FROM k WHERE k <= greatest(1, floor(0.1 * n)) GROUP BY 1""")
def top_decile_median(t):
    return stats.top_decile_median(_items(t), ["g"], "v").withColumn("median_top", r("median_top"))


@query("""
WITH c AS (SELECT user_id, event_type, max(value) AS v FROM events GROUP BY 1, 2), names AS (SELECT unnest(['click', 'purchase', 'signup', 'view']) AS event_type),
f AS (SELECT u.user_id, n.event_type, coalesce(c.v, 0) AS v FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN names n LEFT JOIN c USING (user_id, event_type)),
b AS (SELECT user_id, event_type AS brightest FROM f QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY v DESC, event_type) = 1),
m AS (SELECT brightest, event_type, median(v) AS m FROM f JOIN b USING (user_id) GROUP BY 1, 2)
SELECT brightest, event_type, round(coalesce(m / nullif(sum(m) OVER (PARTITION BY brightest), 0), 0), 4) AS share FROM m""")
def crosstalk_matrix(t):
    names = ["click", "purchase", "signup", "view"]
    best = t.events.groupBy("user_id", "event_type").agg(F.max("value").alias("v"))
    out = stats.crosstalk(best, ["user_id"], "event_type", "v", names)
    return out.unpivot(["brightest"], names, "event_type", "share").withColumn("share", r("share"))


@query("""
WITH x AS (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings), c AS (SELECT dim, avg(v) AS m, stddev_samp(v) AS s FROM x WHERE label = 0 GROUP BY 1),
g AS (SELECT label, dim, avg(v) AS m, count(*) AS n FROM x WHERE label <> 0 GROUP BY 1, 2 HAVING count(*) >= 3)
SELECT label::BIGINT AS label, max(g.n) AS n, round(sqrt(avg(((g.m - c.m) / coalesce(nullif(c.s, 0), 1)) ** 2)), 4) AS effect, round(1 - sum(g.m * c.m) / sqrt(sum(g.m * g.m) * sum(c.m * c.m)), 4) AS cosine_distance FROM g JOIN c USING (dim) GROUP BY 1""")
def effect_sizes(t):
    o = stats.effect_sizes(t.embeddings.select(long("label").alias("label"), "embedding"), "label", "embedding", F.col("label") == 0)
    return o.select("label", "n", r("effect").alias("effect"), r("cosine_distance").alias("cosine_distance"))


@query("""
WITH x AS (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)
SELECT label::BIGINT AS label, dim::BIGINT AS dim, round(avg(v), 4) AS mean, count(*) AS n FROM x GROUP BY 1, 2 HAVING count(*) >= 3""")
def guide_mean_vectors(t):
    o = stats.vector_means(t.embeddings, ["label"], "embedding")
    return o.select(long("label").alias("label"), long("dim").alias("dim"), r("mean").alias("mean"), "n")


@query("""
WITH m AS (SELECT l_suppkey AS s, year(l_shipdate)::BIGINT * 12 + month(l_shipdate) AS t, count(*) AS n FROM lineitem GROUP BY 1, 2), b AS (SELECT *, max(n) OVER (PARTITION BY s ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM m)
SELECT *, best_before IS NULL OR n >= 0.85 * best_before AS valid FROM b""")
def timepoint_gate(t):
    m = t.lineitem.groupBy(F.col("l_suppkey").alias("s"), (F.year("l_shipdate").cast("long") * 12 + F.month("l_shipdate")).alias("t")).agg(F.count("*").alias("n"))
    return stats.running_gate(m, ["s"], "t", "n")


@query("""
WITH a AS (SELECT o_orderstatus AS metric, o_custkey % 20 AS well, sum(o_totalprice) AS v FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1, 2), b AS (SELECT o_orderstatus AS metric, o_custkey % 20 AS well, sum(o_totalprice) AS v FROM orders WHERE o_orderkey % 2 = 1 AND o_orderstatus <> 'P' GROUP BY 1, 2)
SELECT a.metric, a.well, CASE WHEN b.v IS NULL THEN 'cand_nan' WHEN abs(b.v - a.v) / abs(a.v) <= 0.1 THEN 'pass' ELSE 'fail' END AS status FROM a LEFT JOIN b USING (metric, well) WHERE a.well IN (SELECT well FROM b)""")
def plate_comparison(t):
    o = t.orders.groupBy(F.col("o_orderstatus").alias("metric"), (F.col("o_custkey") % 20).alias("well"), (F.col("o_orderkey") % 2).alias("k")).agg(F.sum("o_totalprice").alias("value"))
    return stats.compare_metrics(o.where("k = 0").drop("k"), o.where("k = 1 AND metric <> 'P'").drop("k"), 0.1).select("metric", "well", "status")


# Barcodes and scalar expressions

_MISS = "list_sum([CASE WHEN substring(a, i, 1) <> substring(b, i, 1) THEN 1 ELSE 0 END FOR i IN range(1, least(length(a), length(b)) + 1)])::BIGINT"


@query("""
WITH c AS (SELECT DISTINCT p_type AS s FROM part), x AS (SELECT s, unnest(string_split(s, '')) AS ch FROM c WHERE s <> ''), n AS (SELECT s, ch, count(*) / length(s)::DOUBLE AS p FROM x WHERE ch <> '' GROUP BY s, ch)
SELECT s, round(sum(-p * log2(p + 1e-9)), 5) AS h FROM n GROUP BY 1""")
def string_entropy(t):
    return t.part.select(F.col("p_type").alias("s")).distinct().select("s", r(X.entropy(F.col("s")), 5).alias("h"))


@query(f"""
WITH a AS (SELECT p_type AS a, count(*) AS rows FROM part GROUP BY 1), b AS (SELECT DISTINCT o_orderpriority AS b FROM orders)
SELECT a AS read, rows, min({_MISS}) AS distance FROM a, b GROUP BY 1, 2""")
def least_hamming(t):
    o = barcodes.least_hamming(t.part, t.orders, "p_type", "o_orderpriority")
    return o.select(F.col("p_type").alias("read"), "rows", long("distance").alias("distance"))


_PLACES = barcodes.mapping(list(range(8)), {"shift": [2]}, 8)


@query("""
WITH c AS (SELECT DISTINCT concat(substring(p_name, 1, 2), substring(p_name, 4, 5)) AS k FROM part WHERE p_type < 'M')
SELECT p_partkey, substring(p_name, 1, 7) IN (SELECT k FROM c) AS matched FROM part""")
def shifted_match(t):
    o = barcodes.matched(t.part, t.part.where("p_type < 'M'"), _PLACES, "p_name", "p_name")
    return o.select("p_partkey", "matched")


@query("""
WITH k AS (SELECT unnest(range(1, 13)) AS length), c AS (SELECT DISTINCT length, substring(p_name, 1, length::INT) AS p FROM part, k WHERE p_type = 'PROMO')
SELECT k.length, round(avg(CASE WHEN c.p IS NULL THEN 0.0 ELSE 1.0 END), 5) AS accuracy FROM part CROSS JOIN k LEFT JOIN c ON c.length = k.length AND c.p = substring(p_name, 1, k.length::INT) GROUP BY 1""")
def prefix_accuracy(t):
    o = barcodes.prefix_accuracy(t.part, t.part.where("p_type = 'PROMO'"), 12, "p_name", "p_name")
    return o.select(long("length").alias("length"), r("accuracy", 5).alias("accuracy"))


@query("""
WITH x AS (SELECT unnest(string_split(p_brand, '')) AS base, generate_subscripts(string_split(p_brand, ''), 1) - 1 AS round FROM part), n AS (SELECT round, base, count(*) AS n FROM x GROUP BY 1, 2)
SELECT round::BIGINT AS round, base, n, round(n / (SELECT sum(n) FROM n WHERE round = 0)::DOUBLE, 5) AS share, n / sum(n) OVER (PARTITION BY round) > 0.4 AS dominant FROM n""")
def base_composition(t):
    o = barcodes.composition(t.part, "p_brand")
    return o.select(long("round").alias("round"), "base", "n", r("share", 5).alias("share"), "dominant")


_CONFIGS = {"none": barcodes.mapping(list(range(6)), None, 6), "drop2": barcodes.mapping(list(range(6)), [2], 6), "shift1": barcodes.mapping(list(range(6)), {"shift": [1]}, 6), "offset1": barcodes.mapping(list(range(6)), {"offset": 1}, 6)}
_PICK = lambda c, at: "concat(" + ", ".join(f"substring({c}, {p + 1}, 1)" for p in at) + ")"


@query(" UNION ALL ".join(f"""
SELECT '{k}' AS config, round(avg(CASE WHEN {_PICK('a.p_name', m.read)} IN (SELECT {_PICK('p_name', m.code)} FROM part WHERE p_type = 'LARGE') THEN 1.0 ELSE 0 END), 5) AS rate, (SELECT count(DISTINCT {_PICK('p_name', m.code)}) FROM part WHERE p_type = 'LARGE') AS unique_codes FROM part a""" for k, m in _CONFIGS.items()))
def failed_round_search(t):
    return barcodes.search(t.part, t.part.where("p_type = 'LARGE'"), _CONFIGS, "p_name", "p_name").withColumn("rate", r("rate", 5))


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def json_properties(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("""
WITH b AS (SELECT '(' || l_linenumber || ', ' || (l_partkey % 50) || ', ' || (l_linenumber + l_quantity::INT) || ', ' || (l_partkey % 50 + l_suppkey % 30) || ')' AS s, * FROM lineitem),
x AS (SELECT l_orderkey, l_linenumber, (regexp_extract_all(s, '(\\d+)', 1))[1]::BIGINT AS a, (regexp_extract_all(s, '(\\d+)', 1))[2]::BIGINT AS b, (regexp_extract_all(s, '(\\d+)', 1))[3]::BIGINT AS c, (regexp_extract_all(s, '(\\d+)', 1))[4]::BIGINT AS d FROM b)
SELECT l_orderkey, l_linenumber::BIGINT AS line, c - a AS height, d - b AS width, (c - a) * (d - b) AS area, round(CASE WHEN d <> b THEN (c - a) / (d - b)::DOUBLE END, 5) AS aspect, c - a >= 20 AND d - b >= 20 AS is_large FROM x""")
def box_shapes(t):
    li = t.lineitem
    text = F.concat(F.lit("("), F.col("l_linenumber").cast("string"), F.lit(", "), (F.col("l_partkey") % 50).cast("string"), F.lit(", "), (F.col("l_linenumber") + F.col("l_quantity").cast("int")).cast("string"), F.lit(", "), (F.col("l_partkey") % 50 + F.col("l_suppkey") % 30).cast("string"), F.lit(")"))
    o = li.select("l_orderkey", long("l_linenumber").alias("line"), X.bounding_box(text).alias("b")).select("l_orderkey", "line", X.box_shape(F.col("b"), 20).alias("s"))
    return o.select("l_orderkey", "line", long("s.height").alias("height"), long("s.width").alias("width"), long("s.area").alias("area"), r("s.aspect", 5).alias("aspect"), "s.is_large")


# Spatial joins: embeddings as points

_P = "SELECT vec_id AS id, 100 * embedding[1]::DOUBLE AS y, 100 * embedding[2]::DOUBLE AS x, label::BIGINT AS label, 1 + vec_id % 7 AS size FROM embeddings"


def _points(t):
    e = F.col("embedding")
    return t.embeddings.select(F.col("vec_id").alias("id"), (100 * e[0].cast("double")).alias("y"), (100 * e[1].cast("double")).alias("x"), long("label").alias("label"), (1 + F.col("vec_id") % 7).alias("size"))


@query(f"""
WITH p AS ({_P}), g AS (SELECT i * 8 + j AS tile, -400.0 + 100 * i AS y0, -400.0 + 100 * j AS x0, -280.0 + 100 * i AS y1, -280.0 + 100 * j AS x1 FROM range(8) a(i), range(8) b(j))
SELECT id, min(tile)::BIGINT AS tile, count(*) AS tiles FROM p JOIN g ON y >= y0 AND y < y1 AND x >= x0 AND x < x1 GROUP BY 1""")
def points_in_tiles(t):
    g = t.spark.range(64).select(F.col("id").alias("tile"), (F.floor(F.col("id") / 8) * 100 - 400).cast("double").alias("y0"), (F.col("id") % 8 * 100 - 400).cast("double").alias("x0"))
    g = g.withColumns({"y1": F.col("y0") + 120, "x1": F.col("x0") + 120})
    found = spatial.points_in_boxes(_points(t), g, [], 60.0)
    return found.groupBy("id").agg(F.min("tile").alias("tile"), F.count("*").alias("tiles"))


@query(f"""
WITH p AS ({_P}), a AS (SELECT * FROM p WHERE id % 2 = 0), b AS (SELECT * FROM p WHERE id % 2 = 1),
d AS (SELECT a.id AS id_a, b.id AS id_b, sqrt((a.y - b.y) ** 2 + (a.x - b.x) ** 2) AS distance FROM a, b WHERE (a.y - b.y) ** 2 + (a.x - b.x) ** 2 <= 625)
SELECT id_a, id_b, round(distance, 4) AS distance FROM d QUALIFY row_number() OVER (PARTITION BY id_a ORDER BY distance, id_b) = 1""")
def nearest_neighbour(t):
    p = _points(t)
    o = spatial.nearest(p.where("id % 2 = 0").select("id", "y", "x"), p.where("id % 2 = 1").select("id", "y", "x"), 25.0)
    return o.select("id_a", "id_b", r("distance").alias("distance"))


@query(f"""
WITH p AS ({_P}), a AS (SELECT * FROM p WHERE id % 2 = 0), b AS (SELECT * FROM p WHERE id % 2 = 1),
d AS (SELECT a.id AS id_a, b.id AS id_b, sqrt((a.y - b.y) ** 2 + (a.x - b.x) ** 2) AS distance FROM a, b WHERE (a.y - b.y) ** 2 + (a.x - b.x) ** 2 < 625)
SELECT id_a, id_b, round(distance, 4) AS distance FROM d QUALIFY row_number() OVER (PARTITION BY id_a ORDER BY distance, id_b) = 1 AND row_number() OVER (PARTITION BY id_b ORDER BY distance, id_a) = 1""")
def mutual_nearest(t):
    p = _points(t)
    o = spatial.mutual_nearest(p.where("id % 2 = 0").select("id", "y", "x"), p.where("id % 2 = 1").select("id", "y", "x"), 25.0)
    return o.select("id_a", "id_b", r("distance").alias("distance"))


@query(f"""
WITH p AS ({_P}), a AS (SELECT * FROM p WHERE id % 2 = 0), b AS (SELECT * FROM p WHERE id % 2 = 1),
d AS (SELECT a.id AS id_a, b.id AS id_b, sqrt((a.y - b.y) ** 2 + (a.x - b.x) ** 2) AS d, a.size AS sa, b.size AS sb FROM a, b WHERE (a.y - b.y) ** 2 + (a.x - b.x) ** 2 <= 900),
k AS (SELECT *, 0.6 * (1 - d / 30) + 0.4 * least(sa, sb) / greatest(sa, sb) AS score FROM d QUALIFY row_number() OVER (PARTITION BY id_a ORDER BY d, id_b) <= 5),
s AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY id_a ORDER BY score DESC, id_b) = 1)
SELECT id_a, id_b, round(score, 4) AS score FROM s QUALIFY row_number() OVER (PARTITION BY id_b ORDER BY score DESC, id_a) = 1""")
def scored_match(t):
    p = _points(t).select("id", "y", "x", "size")
    return spatial.scored_match(p.where("id % 2 = 0"), p.where("id % 2 = 1"), 30.0, "size").select("id_a", "id_b", r("score").alias("score"))


@query(f"""
WITH p AS ({_P}), q AS (SELECT a.id, a.label AS la, b.label AS lb FROM p a JOIN p b ON a.id <> b.id AND (a.y - b.y) ** 2 + (a.x - b.x) ** 2 <= 400),
l AS (SELECT id, lb, count(*) AS n, count_if(la = lb) AS s FROM q GROUP BY 1, 2), c AS (SELECT id, sum(n)::BIGINT AS neighbours, sum(s)::BIGINT AS sisters, max(n) AS dominant FROM l GROUP BY 1)
SELECT p.id, label, coalesce(neighbours, 0) AS neighbours, coalesce(sisters, 0) AS sisters, coalesce(dominant, 0) AS dominant, round(coalesce(sisters / neighbours::DOUBLE, 0), 5) AS sister_ratio FROM p LEFT JOIN c USING (id)""")
def sister_counts(t):
    return spatial.neighbour_counts(_points(t), 20.0, "label").withColumn("sister_ratio", r("sister_ratio", 5))


@query(f"WITH p AS ({_P}) SELECT id FROM p a WHERE NOT EXISTS (SELECT 1 FROM p b WHERE b.id < a.id AND (a.y - b.y) ** 2 + (a.x - b.x) ** 2 <= 100)")
def close_pair_suppression(t):
    return spatial.suppressed(_points(t).withColumn("ord", F.col("id")), 10.0, "ord").select("id")


@query(f"""
WITH p AS ({_P}), q AS (SELECT floor(y / 60)::BIGINT AS row, floor(x / 60)::BIGINT AS col, count(DISTINCT id) AS n FROM p GROUP BY 1, 2), g AS (SELECT i AS row, j AS col FROM range(-3, 3) a(i), range(-3, 3) b(j))
SELECT g.row, g.col AS "column", coalesce(n, 0) AS n FROM g LEFT JOIN q USING (row, col)""")
def tile_heatmap(t):
    g = t.spark.range(36).select((F.floor(F.col("id") / 6) - 3).cast("int").alias("row"), (F.col("id") % 6 - 3).cast("int").alias("column"))
    o = spatial.grid_counts(_points(t), g, 60.0, "id")
    return o.select(long("row").alias("row"), long("column").alias("column"), "n")


_PX = "SELECT l_suppkey AS label, l_partkey % 60 AS y, l_orderkey % 60 AS x, l_linenumber FROM lineitem"


def _raster(t, status=None):
    li = t.lineitem if status is None else t.lineitem.where(F.col("l_linestatus") == status)
    pixels = li.groupBy((F.col("l_partkey") % 60).alias("y"), (F.col("l_orderkey") % 60).alias("x")).agg(F.min(F.col("l_suppkey") % 40).alias("label"))
    return rasters.packed(pixels, size=32)


_RA, _RB, _RC = (f"SELECT l_partkey % 60 AS y, l_orderkey % 60 AS x, min(l_suppkey % 40) AS label FROM lineitem{k} GROUP BY 1, 2" for k in (" WHERE l_linestatus = 'F'", " WHERE l_linestatus = 'O'", ""))


@query(f"""
WITH a AS ({_RA}), b AS ({_RB}), s AS (SELECT a.label AS label_a, b.label AS label_b, count(*) AS shared FROM a JOIN b USING (y, x) WHERE a.label > 0 AND b.label > 0 GROUP BY 1, 2),
na AS (SELECT label, count(*) AS n FROM a GROUP BY 1), nb AS (SELECT label, count(*) AS n FROM b GROUP BY 1)
SELECT label_a, label_b, shared, round(shared / (na.n + nb.n - shared)::DOUBLE, 5) AS iou FROM s JOIN na ON na.label = label_a JOIN nb ON nb.label = label_b WHERE shared / (na.n + nb.n - shared)::DOUBLE > 0.01""")
def label_overlap(t):
    return rasters.overlaps(_raster(t, "F"), _raster(t, "O"), 0.01).withColumn("iou", r("iou", 5))


@query(f"WITH a AS ({_RC}) SELECT label, round(avg(y), 4) AS y, round(avg(x), 4) AS x, count(*) AS area, min(y) AS min_row, min(x) AS min_col, max(y) + 1 AS max_row, max(x) + 1 AS max_col FROM a WHERE label > 0 GROUP BY 1")
def label_centroids(t):
    return rasters.label_stats(_raster(t)).withColumns({"y": r("y"), "x": r("x")})


@query(f"WITH a AS ({_RC}) SELECT floor(y / 20)::BIGINT AS row, floor(x / 20)::BIGINT AS \"column\", count(DISTINCT CASE WHEN label > 0 THEN label END) AS labels FROM a GROUP BY 1, 2")
def confluency(t):
    o = rasters.confluency(_raster(t), 20)
    return o.select(long("row").alias("row"), long("column").alias("column"), "labels")


@query(f"""
WITH RECURSIVE p AS ({_P}), e AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.id <> b.id AND (a.y - b.y) ** 2 + (a.x - b.x) ** 2 <= 36),
w(id, root) AS (SELECT a, a FROM e UNION SELECT e.b, w.root FROM w JOIN e ON e.a = w.id WHERE w.root < e.b)
SELECT id AS label, min(root) AS root FROM w GROUP BY 1""")
def merged_labels(t):
    p = _points(t).select("id", "y", "x")
    return labels.merged(spatial.connections(p, 6.0))


# Track graphs: a user's events are a track, frames are the days of the week

_N = "SELECT event_id AS id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS t, value AS y, (event_id % 97)::DOUBLE AS x, user_id AS tracklet_id, event_type FROM events"


def _graph(t):
    n = t.events.select(F.col("event_id").alias("id"), F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).cast("long").alias("t"), F.col("value").alias("y"), (F.col("event_id") % 97).cast("double").alias("x"), F.col("user_id").alias("tracklet_id"), "event_type")
    nxt = n.select(F.col("id").alias("dst"), (F.col("t") - 1).alias("t"), "tracklet_id", F.col("id").alias("_d"))
    edges = n.join(nxt, ["tracklet_id", "t"]).where("event_type <> 'error'").select(F.col("id").alias("src"), "dst")
    return n.drop("event_type"), edges


_G = f"WITH n AS ({_N}), e AS (SELECT a.id AS src, b.id AS dst FROM n a JOIN n b ON a.tracklet_id = b.tracklet_id AND b.t = a.t + 1 WHERE a.event_type <> 'error')"


@query(f"""{_G}, d AS (SELECT n.*, (SELECT count(*) FROM e WHERE src = n.id) AS o, (SELECT count(*) FROM e WHERE dst = n.id) AS i FROM n)
SELECT count(*) AS nodes, sum(o)::BIGINT AS edges, count_if(o >= 2)::BIGINT AS divisions, count_if(i = 0 AND t > (SELECT min(t) FROM n))::BIGINT AS appearances, count_if(o = 0 AND t < (SELECT max(t) FROM n))::BIGINT AS disappearances FROM d""")
def track_graph_stats(t):
    return tracks.graph_stats(*_graph(t))


@query(f"""{_G}, m AS (SELECT a.t, sqrt((b.y - a.y) ** 2 + (b.x - a.x) ** 2) AS d FROM e JOIN n a ON a.id = src JOIN n b ON b.id = dst)
SELECT t, round(avg(d), 4) AS mean, round(median(d), 4) AS median, round(stddev_pop(d), 4) AS std, round(min(d), 4) AS min, round(max(d), 4) AS max, count(*) AS n FROM m GROUP BY 1""")
def track_movement(t):
    o = tracks.movement_stats(tracks.movement(*_graph(t)), ["t"])
    return o.select("t", *[r(c).alias(c) for c in ("mean", "median", "std", "min", "max")], "n")


@query(f"""{_G}, m AS (SELECT a.tracklet_id, sqrt((b.y - a.y) ** 2 + (b.x - a.x) ** 2) AS d FROM e JOIN n a ON a.id = src JOIN n b ON b.id = dst)
SELECT tracklet_id, round(sum(d), 3) AS distance, count(*) AS steps FROM m GROUP BY 1""")
def track_lengths(t):
    return tracks.track_lengths(tracks.movement(*_graph(t))).withColumn("distance", r("distance", 3))


@query(f"{_G} SELECT n.id AS id_0, a.dst AS id_1, b.dst AS id_2, c.dst AS id_3 FROM n JOIN e a ON a.src = n.id JOIN e b ON b.src = a.dst JOIN e c ON c.src = b.dst WHERE n.t = 1")
def full_length_tracks(t):
    return tracks.full_length(*_graph(t), 4)


@query("""
WITH k AS (SELECT o_custkey, count(*) AS rows, count(DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END) AS codes FROM orders GROUP BY 1 HAVING count(*) > 1)
SELECT count(*) AS shared, count_if(codes = 1)::BIGINT AS matching FROM k""")
def lineage_agreement(t):
    return tracks.lineage_agreement(t.orders.withColumn("code", F.when(F.col("o_orderstatus") == "P", "0").otherwise(F.col("o_orderstatus"))), "o_custkey", "code")


@query("""
WITH a AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1), b AS (SELECT c_nationkey AS k, count(*) AS tracked FROM customer WHERE c_acctbal > 3000 GROUP BY 1),
l AS (SELECT k, n, coalesce(tracked, 0) AS tracked, 100.0 * (n - coalesce(tracked, 0)) / n AS loss FROM a LEFT JOIN b USING (k))
SELECT k::BIGINT AS k, n, tracked, round(loss, 4) AS loss_pct, round(coalesce((loss - min(loss) OVER ()) / nullif(max(loss) OVER () - min(loss) OVER (), 0), 0), 4) AS rescaled FROM l""")
def tracking_loss(t):
    by = lambda df: df.groupBy(long("c_nationkey").alias("k")).agg(F.count("*").alias("n"))
    o = tracks.tracked_loss(by(t.customer), by(t.customer.where("c_acctbal > 3000")), ["k"])
    return o.withColumns({"loss_pct": r("loss_pct"), "rescaled": r("rescaled")})


@query("""
SELECT user_id, {cols} FROM (SELECT *, dayofweek(ts) AS t FROM events) GROUP BY 1""".format(cols=", ".join(f"max(CASE WHEN t = {k} THEN event_type END) AS event_type_t{k}" for k in range(7))))
def widened_tracks(t):
    e = t.events.withColumn("t", F.dayofweek("ts") - 1)
    return tracks.widened(e, "user_id", list(range(7)), ["event_type"])


@query("""
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS begin, event_type, count(*) AS n, round(sum(value), 3) AS total FROM events GROUP BY 1, 2""")
def tumbling_windows(t):
    e = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    o = e.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("s"))
    return o.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("begin"), "event_type", "n", r("s", 3).alias("total"))


_CODE8 = "translate(lpad(({0} * 7919 % 65536)::INT::VARCHAR, 5, '0'), '0123456789', 'ACGTACGTAC')"


@query(f"""
WITH a AS (SELECT {_CODE8.format('o_custkey')} AS a, count(*) AS rows FROM orders GROUP BY 1), b AS (SELECT DISTINCT {_CODE8.format('p_partkey')} AS b FROM part),
d AS (SELECT a, len([1 FOR i IN range(1, 6) IF a[i] <> b[i]]) AS d FROM a, b), m AS (SELECT a, min(d) AS distance FROM d GROUP BY 1)
SELECT a AS barcode, rows, CASE WHEN distance <= 1 THEN distance::INT END AS distance, CASE WHEN distance <= 1 THEN (SELECT count(*) FROM d WHERE d.a = m.a AND d.d = m.distance) ELSE 0 END AS codes FROM a JOIN m USING (a)""")
def near_codes(t):
    code = lambda c: F.translate(F.lpad((F.col(c) * 7919 % 65536).cast("string"), 5, "0"), "0123456789", "ACGTACGTAC")
    return barcodes.near_codes(t.orders.select(code("o_custkey").alias("barcode")), t.part.select(code("p_partkey").alias("sgRNA")), 1)


@query("SELECT l_orderkey, l_linenumber::BIGINT AS line FROM lineitem WHERE l_partkey || '_' || l_returnflag IN (SELECT l_partkey || '_' || l_returnflag FROM lineitem WHERE l_quantity >= 49)")
def members_of_pairs(t):
    li = t.lineitem.select("l_orderkey", long("l_linenumber").alias("line"), "l_partkey", "l_returnflag", "l_quantity")
    return keyed.members(li, li.where("l_quantity >= 49"), ["l_partkey", "l_returnflag"]).select("l_orderkey", "line")
