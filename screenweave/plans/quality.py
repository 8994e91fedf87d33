"""Quality reports over the star schema: growth effects, spatial and drift summaries, gates, audits, status and funnels over time."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenweave.functions import expressions as X
from screenweave.operators import barcodes, keyed, spatial, stats
from screenweave.plans.registry import _P, _points, long, query, r


@query("""
WITH c AS (SELECT l_partkey AS k, count(*) AS n FROM lineitem GROUP BY 1), j AS (SELECT p_partkey AS k, coalesce(n, 0)::DOUBLE AS y, p_retailprice AS x, p_brand = 'Brand#11' AS ntc FROM part LEFT JOIN c ON k = p_partkey),
e AS (SELECT min(x) AS lo, max(x) AS hi FROM j), b AS (SELECT greatest(0, least(7, ceil((x - lo) / ((hi - lo) / 8)) - 1))::BIGINT AS bin, x, y FROM j, e), m AS (SELECT bin, count(*) AS n, median(x) AS mx, median(y) AS my FROM b GROUP BY 1)
SELECT count(*) AS bins, sum(n)::BIGINT AS guides, round(regr_slope(my, mx), 5) AS slope, round(corr(my, mx), 4) AS r FROM m""")
def growth_effect(t):
    n = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    j = keyed.left_fill(t.part, n, ["p_partkey"], {"n": 0}).select(F.col("p_retailprice").alias("x"), F.col("n").cast("double").alias("y"))
    m = stats.binned(j, "x", "y", 8)
    return m.agg(F.count("*").alias("bins"), F.sum("n").alias("guides"), r(F.regr_slope("y_median", "x_median"), 5).alias("slope"), r(stats.corr("y_median", "x_median")).alias("r"))


@query("""
WITH c AS (SELECT p_brand, p_partkey, count(l_orderkey) AS n FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1, 2), q AS (SELECT quantile_cont(n, 0.1) AS low FROM c WHERE p_brand LIKE 'Brand#1%')
SELECT p_brand, count_if(n < low)::BIGINT AS below, count(*) AS guides FROM c, q GROUP BY 1""")
def below_control_percentile(t):
    n = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    c = keyed.left_fill(t.part.select("p_brand", "p_partkey"), n, ["p_partkey"], {"n": 0})
    low = c.where(F.col("p_brand").like("Brand#1%")).agg(F.percentile("n", F.lit(0.1)).alias("low"))
    return c.crossJoin(F.broadcast(low)).groupBy("p_brand").agg(F.count_if(F.col("n") < F.col("low")).alias("below"), F.count("*").alias("guides"))


@query("""
WITH c AS (SELECT p_type AS s, count(*) AS n FROM part GROUP BY 1), x AS (SELECT s, n, unnest(string_split(s, '')) AS ch FROM c), p AS (SELECT s, n, count(*) / length(s)::DOUBLE AS p FROM x GROUP BY s, n, ch), h AS (SELECT s, n, sum(-p * log2(p + 1e-9)) AS h FROM p GROUP BY 1, 2)
SELECT count(*) AS n, CASE WHEN count(*) >= 5 THEN round(regr_slope(n, h), 4) END AS slope, CASE WHEN count(*) >= 5 THEN round(corr(n, h), 4) END AS r FROM h""")
def entropy_bias(t):
    return barcodes.entropy_bias(t.part, "p_type").select("n", r("slope").alias("slope"), r("r").alias("r"))


@query("""
WITH a AS (SELECT l_partkey % 60 AS b, count(*) / sum(count(*)) OVER () AS f FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1), c AS (SELECT l_partkey % 60 AS b, count(*) / sum(count(*)) OVER () AS f FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
SELECT count(*) AS common, CASE WHEN count(*) < 50 THEN 0.0 ELSE round(corr(log2(a.f + 1e-9), log2(c.f + 1e-9)), 4) END AS r FROM a JOIN c USING (b)""")
def reference_correlation(t):
    def share(status, name):
        n = t.lineitem.where(F.col("l_linestatus") == status).groupBy((F.col("l_partkey") % 60).alias("b")).agg(F.count("*").alias("n"))
        return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("all")))).select("b", F.log2(F.col("n") / F.col("all") + 1e-9).alias(name))

    both = share("O", "x").join(share("F", "y"), "b")
    return both.agg(F.count("*").alias("common"), stats.corr("x", "y").alias("r")).select("common", F.when(F.col("common") < 50, 0.0).otherwise(r("r")).alias("r"))


@query(f"""
WITH p AS ({_P}), q AS (SELECT a.id, a.label AS la, count_if(a.label = b.label) / count(*)::DOUBLE AS s FROM p a JOIN p b ON a.id <> b.id AND (a.y - b.y) ** 2 + (a.x - b.x) ** 2 <= 900 GROUP BY 1, 2),
s AS (SELECT p.id % 4 AS well, coalesce(q.s, 0) AS s, q.s IS NULL AS alone FROM p LEFT JOIN q USING (id))
SELECT well, round(avg(s), 4) AS mean, round(median(s), 4) AS median, round(stddev_samp(s), 4) AS std, round(quantile_cont(s, 0.9), 4) AS p90, round(100.0 * count_if(alone) / count(*), 4) AS isolated_pct, round(100.0 * count_if(s >= 0.3) / count(*), 4) AS over_3_pct FROM s GROUP BY 1""")
def spatial_summary(t):
    s = spatial.neighbour_counts(_points(t), 30.0, "label").withColumn("well", F.col("id") % 4)
    v = F.col("sister_ratio")
    return s.groupBy("well").agg(
        r(F.avg(v)).alias("mean"), r(F.percentile(v, F.lit(0.5))).alias("median"), r(F.stddev_samp(v)).alias("std"), r(F.percentile(v, F.lit(0.9))).alias("p90"),
        r(100.0 * F.count_if(F.col("neighbours") == 0) / F.count("*")).alias("isolated_pct"), r(100.0 * F.count_if(v >= 0.3) / F.count("*")).alias("over_3_pct"),
    )


@query("""
WITH d AS (SELECT l_suppkey AS well, l_linenumber::BIGINT AS round, avg(l_discount) AS dx, avg(l_tax) AS dy FROM lineitem GROUP BY 1, 2),
o AS (SELECT * FROM d UNION ALL SELECT DISTINCT well, 0, 0.0, 0.0 FROM d), l AS (SELECT *, dx - lag(dx) OVER w AS ddx, dy - lag(dy) OVER w AS ddy FROM o WINDOW w AS (PARTITION BY well ORDER BY round))
SELECT round, count(*) AS n, round(avg(sqrt(ddx ** 2 + ddy ** 2)), 5) AS mean, round(max(sqrt(ddx ** 2 + ddy ** 2)), 5) AS max, round(stddev_samp(sqrt(ddx ** 2 + ddy ** 2)), 5) AS std FROM l WHERE round > 0 GROUP BY 1""")
def drift_summary(t):
    d = t.lineitem.groupBy(F.col("l_suppkey").alias("well"), long("l_linenumber").alias("round")).agg(F.avg("l_discount").alias("dx"), F.avg("l_tax").alias("dy"))
    origin = d.select("well").distinct().select("well", F.lit(0).cast("long").alias("round"), F.lit(0.0).alias("dx"), F.lit(0.0).alias("dy"))
    step = keyed.lag_difference(d.unionByName(origin), ["well"], "round", ["dx", "dy"], origin=False).where("round > 0").withColumn("m", X.drift(F.col("d_dy"), F.col("d_dx"))["magnitude"])
    return step.groupBy("round").agg(F.count("*").alias("n"), r(F.avg("m"), 5).alias("mean"), r(F.max("m"), 5).alias("max"), r(F.stddev_samp("m"), 5).alias("std"))


@query("""
WITH d AS (SELECT event_type, user_id, ts, date_diff('second', lag(ts) OVER w, ts) / 3600.0 AS h FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (SELECT event_type, count(h) AS n, sum(coalesce(h, 0)) AS hours FROM d GROUP BY 1)
SELECT event_type, n, round(hours, 3) AS hours, round(sum(hours) OVER (ORDER BY event_type), 3) AS cumulative FROM s""")
def step_timing(t):
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    sec = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / 1000000)
    d = t.events.withColumn("h", (sec(F.col("ts")) - sec(F.lag("ts").over(w))) / 3600.0)
    s = d.groupBy("event_type").agg(F.count("h").alias("n"), F.sum(F.coalesce("h", F.lit(0.0))).alias("s"))
    run = F.sum("s").over(W.orderBy("event_type").rowsBetween(W.unboundedPreceding, 0))
    return s.select("event_type", "n", r("s", 3).alias("hours"), r(run, 3).alias("cumulative"))


@query("""
SELECT n_name AS experiment, coalesce(max(CASE WHEN o_orderstatus = 'F' THEN 'done' END), 'missing') AS "F", coalesce(max(CASE WHEN o_orderstatus = 'O' THEN 'done' END), 'missing') AS "O", coalesce(max(CASE WHEN o_orderstatus = 'P' AND o_totalprice > 300000 THEN 'done' END), 'missing') AS "P"
FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def status_matrix(t):
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    done = F.max(F.when((F.col("o_orderstatus") != "P") | (F.col("o_totalprice") > 300000), "done"))
    return o.groupBy(F.col("n_name").alias("experiment")).pivot("o_orderstatus", ["F", "O", "P"]).agg(done).fillna("missing")


@query("""
SELECT p_partkey, CASE WHEN p_size < 10 THEN 'rebuild' WHEN p_retailprice > 1500 AND p_size > 40 THEN 'check' ELSE 'ok' END AS finding, CASE WHEN p_size < 10 THEN 'build ' || p_name END AS fix FROM part""")
def store_audit(t):
    p = t.part
    return p.select("p_partkey", F.when(p.p_size < 10, "rebuild").when((p.p_retailprice > 1500) & (p.p_size > 40), "check").otherwise("ok").alias("finding"), F.when(p.p_size < 10, F.concat(F.lit("build "), "p_name")).alias("fix"))


@query("""
WITH m AS (SELECT l_suppkey AS well, round(100.0 * count_if(l_discount > 0.05) / count(*), 4) AS centroid, round(100.0 * count_if(l_tax > 0.02) / count(*), 4) AS mask FROM lineitem GROUP BY 1)
SELECT well, CASE WHEN mask < 62 THEN 'fail' WHEN centroid >= 46 OR mask >= 68 THEN 'pass' ELSE 'review' END AS gate FROM m""")
def registration_gate(t):
    m = t.lineitem.groupBy(F.col("l_suppkey").alias("well")).agg(r(100.0 * F.count_if(F.col("l_discount") > 0.05) / F.count("*")).alias("centroid"), r(100.0 * F.count_if(F.col("l_tax") > 0.02) / F.count("*")).alias("mask"))
    return m.select("well", F.when(F.col("mask") < 62, "fail").when((F.col("centroid") >= 46) | (F.col("mask") >= 68), "pass").otherwise("review").alias("gate"))


@query("""
WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings), n AS (SELECT vec_id, sqrt(sum(v * v)) AS n FROM x GROUP BY 1),
s AS (SELECT label, vec_id % 3 AS bin, dim, sum(v / n.n) AS s, count(*) AS k FROM x JOIN n USING (vec_id) GROUP BY 1, 2, 3), c AS (SELECT dim, sum(s) / sum(k) AS m FROM s WHERE label = 0 GROUP BY 1)
SELECT label::BIGINT AS label, bin, max(k) AS cells, round(1 - sum(s.s / k * c.m) / sqrt(sum((s.s / k) ** 2) * sum(c.m ** 2)), 4) AS distance FROM s JOIN c USING (dim) WHERE label <> 0 GROUP BY 1, 2""")
def pooled_effects(t):
    e = t.embeddings.select(long("label").alias("label"), (F.col("vec_id") % 3).alias("bin"), F.transform("embedding", lambda v: v.cast("double")).alias("v"))
    unit = e.withColumn("n", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).select("label", "bin", F.posexplode(F.transform("v", lambda x: x / F.col("n"))).alias("dim", "x"))
    sums = unit.groupBy("label", "bin", "dim").agg(F.sum("x").alias("s"), F.count("*").alias("k"))
    control = sums.where("label = 0").groupBy("dim").agg((F.sum("s") / F.sum("k")).alias("m"))
    both = sums.where("label <> 0").join(control, "dim").withColumn("g", F.col("s") / F.col("k"))
    cosine = F.sum(F.col("g") * F.col("m")) / F.sqrt(F.sum(F.col("g") ** 2) * F.sum(F.col("m") ** 2))
    return both.groupBy("label", "bin").agg(F.max("k").alias("cells"), r(1 - cosine).alias("distance"))


@query("""
WITH g AS (SELECT p_brand, year(l_shipdate)::BIGINT AS y, count(DISTINCT l_orderkey) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2), b AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY y ORDER BY n DESC, p_brand) = 1)
SELECT y, p_brand, n, (SELECT count(DISTINCT l_suppkey) FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand = b.p_brand AND year(l_shipdate) = b.y) AS wells FROM b""")
def top_gene_over_time(t):
    x = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumn("y", F.year("l_shipdate").cast("long"))
    n = x.groupBy("p_brand", "y").agg(F.countDistinct("l_orderkey").alias("n"), F.countDistinct("l_suppkey").alias("wells"))
    return keyed.keep_first(n, ["y"], [F.desc("n"), "p_brand"]).select("y", "p_brand", "n", "wells")


@query(f"""
WITH p AS ({_P}), s AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY label, round_even(y, 0) ORDER BY id) = 1)
SELECT id FROM s QUALIFY row_number() OVER (PARTITION BY round_even(y / 10, 0), round_even(x / 10, 0) ORDER BY id) = 1""")
def place_dedupe(t):
    s = keyed.keep_first(_points(t).withColumn("segment", F.bround("y")), ["label", "segment"], ["id"])
    at = s.withColumns({"by": F.bround(F.col("y") / 10), "bx": F.bround(F.col("x") / 10)})
    return keyed.keep_first(at, ["by", "bx"], ["id"]).select("id")


@query("""
WITH c AS (SELECT p_size % 5 AS level, p_brand AS config, avg(p_retailprice) / 20 AS rate FROM part GROUP BY 1, 2), b AS (SELECT level, max(rate) AS best FROM c GROUP BY 1)
SELECT c.level::BIGINT AS level, config, c.rate - coalesce(b.best, 0) > CASE WHEN c.level <= 1 THEN 1 WHEN c.level = 2 THEN 5 ELSE 10 END AS better FROM c LEFT JOIN b ON b.level = c.level - 1""")
def improvement_by_level(t):
    c = t.part.groupBy((F.col("p_size") % 5).alias("level"), F.col("p_brand").alias("config")).agg((F.avg("p_retailprice") / 20).alias("rate"))
    b = c.groupBy((F.col("level") + 1).alias("level")).agg(F.max("rate").alias("best"))
    return c.join(b, "level", "left").select(long("level").alias("level"), "config", (F.col("rate") - F.coalesce("best", F.lit(0.0)) > barcodes.improvement_needed(F.col("level"))).alias("better"))


@query("""
WITH c AS (SELECT count(*) AS n, min(n_regionkey) AS least FROM nation)
SELECT n_name FROM nation, c WHERE n_regionkey <= least""")
def spike_in_exclusion(t):
    return barcodes.spiked_out(t.nation, "n_regionkey").select("n_name")


@query("""
SELECT strftime(b, '%Y-%m-%d %H:%M') AS begin, count(*) AS n, round(sum(value), 3) AS total
FROM (SELECT value, time_bucket(INTERVAL 15 MINUTES, ts) - INTERVAL (15 * k) MINUTES AS b FROM events, range(4) g(k)) GROUP BY 1""")
def sliding_windows(t):
    e = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy(F.window("ts", "1 hour", "15 minutes")).agg(F.count("*").alias("n"), r(F.sum("value"), 3).alias("total")).select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("begin"), "n", "total")


@query("""
WITH g AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 6 HOURS OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL THEN 1 ELSE 0 END AS new FROM events),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS begin, count(*) AS n FROM s GROUP BY user_id, s.s""")
def session_windows(t):
    e = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy(F.session_window("ts", "6 hours"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss").alias("begin"), "n")


@query("""
SELECT coalesce(r_name, 'ALL') AS region, coalesce(n_name, 'ALL') AS nation, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def rollup_totals(t):
    c = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    return c.rollup("r_name", "n_name").agg(F.count("*").alias("customers"), r(F.sum("c_acctbal"), 2).alias("balance")).select(F.coalesce("r_name", F.lit("ALL")).alias("region"), F.coalesce("n_name", F.lit("ALL")).alias("nation"), "customers", "balance")


@query("""
WITH b AS (SELECT l_suppkey % 10 AS bin, l_returnflag AS g, avg(l_extendedprice) AS m FROM lineitem GROUP BY 1, 2), c AS (SELECT bin, m AS base FROM b WHERE g = 'N')
SELECT g, count(*) AS bins, round(avg(m - coalesce(base, 0)), 3) AS shift FROM b LEFT JOIN c USING (bin) WHERE g <> 'N' GROUP BY 1""")
def control_baseline(t):
    b = t.lineitem.groupBy((F.col("l_suppkey") % 10).alias("bin"), F.col("l_returnflag").alias("g")).agg(F.avg("l_extendedprice").alias("m"))
    base = b.where("g = 'N'").select("bin", F.col("m").alias("base"))
    return b.where("g <> 'N'").join(base, "bin", "left").groupBy("g").agg(F.count("*").alias("bins"), r(F.avg(F.col("m") - F.coalesce("base", F.lit(0.0))), 3).alias("shift"))


@query("""
WITH p AS (SELECT h, d FROM (SELECT unnest([100000, 200000, 300000]) AS h), (SELECT unnest(['1-URGENT', '5-LOW']) AS d))
SELECT h::BIGINT AS threshold, d AS priority, round(100.0 * count_if(o_totalprice > h) / count(*), 4) AS pct FROM p JOIN orders ON o_orderpriority = d GROUP BY 1, 2""")
def parameter_sweep(t):
    grid = t.spark.createDataFrame([(h, d) for h in (100000, 200000, 300000) for d in ("1-URGENT", "5-LOW")], "threshold long, priority string")
    return t.orders.join(F.broadcast(grid), F.col("o_orderpriority") == F.col("priority")).groupBy("threshold", "priority").agg(r(100.0 * F.count_if(F.col("o_totalprice") > F.col("threshold")) / F.count("*")).alias("pct"))
