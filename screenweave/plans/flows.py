"""Registered queries of numbering by place, sketches, table functions and stateful streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from screenweave.functions import tables as table_functions
from screenweave.operators import labels, ordered, plate, sketches
from screenweave.operators.scratch import shared
from screenweave.plans.registry import long, query, r
from screenweave.streaming import completeness


@query("""
WITH d AS (SELECT row_number() OVER () - 1 AS position, doc_id, lang FROM documents), e AS (SELECT row_number() OVER () - 1 AS position, label::BIGINT AS label FROM embeddings)
SELECT d.position, doc_id, lang, label FROM d LEFT JOIN e USING (position)""")
def join_by_position(t):
    return ordered.joined_by_position(t.documents.select("doc_id", "lang"), t.embeddings.select(long("label").alias("label")))


@query("SELECT o_orderkey, o_custkey, dense_rank() OVER (ORDER BY o_custkey) AS compact FROM orders")
def compact_labels(t):
    return labels.compact(t.orders.select("o_orderkey", "o_custkey"), "o_custkey").select("o_orderkey", "o_custkey", long("compact").alias("compact"))


_WELLS = "SELECT l_suppkey AS well, year(l_shipdate)::BIGINT AS y, l_orderkey AS cell, l_partkey AS guide FROM lineitem"


@query(f"WITH l AS ({_WELLS}) SELECT y, count(*) AS rows, true AS cells_close, true AS guides_close FROM l GROUP BY 1 UNION ALL SELECT NULL, count(*), true, true FROM l")
def sketched_counts(t):
    """Distinct cells and guides by year and over all, from one table of sketches by well and year: within 5 % of the exact counts."""
    rows = t.lineitem.select(F.col("l_suppkey").alias("well"), F.year("l_shipdate").cast("long").alias("y"), F.col("l_orderkey").alias("cell"), F.col("l_partkey").alias("guide"))
    table = sketches.sketched(rows, ["well", "y"], ["cell", "guide"])
    exact = rows.groupBy("y").agg(F.countDistinct("cell").alias("c"), F.countDistinct("guide").alias("g")).unionByName(rows.agg(F.lit(None).cast("long").alias("y"), F.countDistinct("cell").alias("c"), F.countDistinct("guide").alias("g")))
    found = sketches.estimated(table, ["y"], ["cell", "guide"]).unionByName(sketches.estimated(table, [], ["cell", "guide"]).withColumn("y", F.lit(None).cast("long")))
    both = found.join(exact.withColumnRenamed("y", "_y"), F.col("y").eqNullSafe(F.col("_y")))
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 0.05 * F.col(b)
    return both.select("y", "rows", close("cell", "c").alias("cells_close"), close("guide", "g").alias("guides_close"))


@query("""
WITH d AS (SELECT DISTINCT user_id AS key, epoch(date_trunc('day', ts))::BIGINT // 86400 AS day FROM events), g AS (SELECT *, day - row_number() OVER (PARTITION BY key ORDER BY day) AS g FROM d)
SELECT key, min(day) AS first, max(day) AS last, count(*) AS n FROM g GROUP BY key, g""")
def active_stretches(t):
    """Stretches of days on which a user is active, by a table function over each user's sorted days."""
    table_functions.register(t.spark)
    days = t.events.select(F.col("user_id").alias("key"), F.unix_date(F.to_date("ts")).cast("long").alias("at")).distinct()
    return t.spark.sql("SELECT * FROM islands(TABLE({days}) PARTITION BY (key) ORDER BY (at), 1)", days=days)


_ARRIVALS = "SELECT user_id::VARCHAR AS well, event_type AS tile, ts, 4 AS expected, TIMESTAMP '2024-01-01 12:00:00' + INTERVAL 1 DAY * (user_id % 5) AS due FROM events"
_TOLD = f"WITH a AS ({_ARRIVALS}), g AS (SELECT well, count(DISTINCT CASE WHEN ts <= due THEN tile END) AS n FROM a GROUP BY 1) SELECT well, least(n, 4) AS tiles, 4::BIGINT AS expected, n >= 4 AS complete FROM g"


def _arrivals(events):
    due = F.expr("TIMESTAMP '2024-01-01 12:00:00' + make_dt_interval(cast(user_id % 5 AS int))")
    return events.select(F.col("user_id").cast("string").alias("well"), F.col("event_type").alias("tile"), F.col("ts").cast("timestamp").alias("ts"), F.lit(4).cast("long").alias("expected"), due.cast("timestamp").alias("due"))


@query(_TOLD)
def completed_wells(t):
    return completeness.batch(_arrivals(t.events))


@query(f"{_TOLD.replace('FROM g', 'FROM g WHERE n >= 4 OR (SELECT max(ts) FROM a) > TIMESTAMP ' + chr(39) + '2024-01-07 00:00:00' + chr(39))}")
def told_wells(t):
    """The same told by a stateful stream over the table's file, the users whose time isn't up yet left open."""
    source = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)
    path = f"{shared(t.spark)}/told-{uuid.uuid4().hex}"
    completeness.run(t.spark, _arrivals(source), "1 hour", f"{path}/out", f"{path}/checkpoint")
    return t.spark.read.schema(completeness.TOLD).parquet(f"{path}/out")


@query("""
WITH s AS (SELECT 'ops' || lpad(month(o_orderdate)::VARCHAR, 4, '0') || '_' || strftime(max(o_orderdate) OVER (PARTITION BY year(o_orderdate), month(o_orderdate)), '%Y%m%d') AS experiment, o_orderpriority AS well, o_totalprice, o_custkey FROM orders),
a AS (SELECT experiment, well, count(*)::DOUBLE AS cells, sum(o_totalprice) AS price, count(DISTINCT o_custkey)::DOUBLE AS guides FROM s GROUP BY 1, 2)
SELECT experiment, strftime(strptime(right(experiment, 8), '%Y%m%d'), '%Y-%m-%d') AS date, well, metric, round(value, 2) AS value FROM a UNPIVOT (value FOR metric IN (cells, price, guides))""")
def metrics_over_time(t):
    """All experiments' metrics, long, with the date in the experiment's name."""
    month = [F.year("o_orderdate"), F.month("o_orderdate")]
    last = t.orders.groupBy(*[c.alias(n) for c, n in zip(month, "ym")]).agg(F.max("o_orderdate").alias("last"))
    name = F.concat(F.lit("ops"), F.lpad(F.col("m").cast("string"), 4, "0"), F.lit("_"), F.date_format("last", "yyyyMMdd"))
    o = t.orders.withColumns(dict(zip("ym", month))).join(F.broadcast(last), ["y", "m"]).withColumn("experiment", name)
    stats = o.groupBy("experiment", F.col("o_orderpriority").alias("well")).agg(F.count("*").alias("cells"), F.sum("o_totalprice").alias("price"), F.countDistinct("o_custkey").alias("guides"))
    return plate.over_time(stats, ["cells", "price", "guides"]).withColumns({"date": F.col("date").cast("string"), "value": r("value", 2)})
