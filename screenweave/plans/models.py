"""Registered queries of fitted models: mixtures, positions, assignments."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenweave.operators import assignment, mixtures, pooled, positions, relaxation
from screenweave.plans.registry import long, query, r

# Lines are spots, return flags channels, line numbers cycles, prices intensities

_ROUNDS, _TOLERANCE = 16, 1e-4


def _em(rounds: int) -> str:
    """The same steps in SQL, one after the other."""
    out = ["d AS (SELECT l_linenumber::BIGINT AS c, l_returnflag AS h, l_extendedprice AS x, count(*) AS n FROM lineitem GROUP BY ALL)", "o AS (SELECT c, h, sum(n) AS total, sum(n * x) / sum(n) AS center FROM d GROUP BY 1, 2)", "z AS MATERIALIZED (SELECT d.c, d.h, x - center AS z, n FROM d JOIN o USING (c, h))"]
    out.append("p0 AS MATERIALIZED (SELECT c, h, 0.5 AS w, -s AS m0, sqrt(s * s + 1e-6) AS s0, s AS m1, sqrt(s * s + 1e-6) AS s1, NULL::DOUBLE AS ll, 0 AS rounds, false AS done FROM (SELECT c, h, sqrt(sum(n * z * z) / sum(n)) AS s FROM z GROUP BY 1, 2))")
    for k in range(rounds):
        out.append(f"a{k} AS (SELECT c, h, z, n, p.*, ln(w) - ln(s0) - (z - m0) ** 2 / (2 * s0 ** 2) AS a, ln(1 - w) - ln(s1) - (z - m1) ** 2 / (2 * s1 ** 2) AS b FROM z JOIN (SELECT c, h, w, m0, s0, m1, s1 FROM p{k} WHERE NOT done) AS p USING (c, h))")
        out.append(f"r{k} AS (SELECT *, 1 / (1 + exp(b - a)) AS p, greatest(a, b) + ln(1 + exp(-abs(a - b))) - 0.5 * ln(2 * pi()) AS l FROM a{k})")
        out.append(f"g{k} AS (SELECT c, h, sum(n) AS n, sum(n * p) AS p, sum(n * p * z) AS pz, sum(n * p * z * z) AS pzz, sum(n * z) AS sz, sum(n * z * z) AS szz, sum(n * l) / sum(n) AS nl FROM r{k} GROUP BY 1, 2)")
        out.append(
            f"p{k + 1} AS MATERIALIZED (SELECT * FROM p{k} WHERE done UNION ALL SELECT g.c, g.h, g.p / g.n, g.pz / g.p, sqrt(greatest(g.pzz / g.p - (g.pz / g.p) ** 2, 0) + 1e-6), (g.sz - g.pz) / (g.n - g.p), sqrt(greatest((g.szz - g.pzz) / (g.n - g.p) - ((g.sz - g.pz) / (g.n - g.p)) ** 2, 0) + 1e-6), g.nl, o.rounds + 1, coalesce(abs(g.nl - o.ll) < {_TOLERANCE}, false) FROM g{k} AS g JOIN p{k} AS o USING (c, h) WHERE NOT o.done)"
        )
    return f"""WITH {", ".join(out)}, f AS (SELECT p.c, p.h, total, rounds, done, CASE WHEN m0 > m1 THEN 1 - w ELSE w END AS w, center + least(m0, m1) AS lo, center + greatest(m0, m1) AS hi, CASE WHEN m0 > m1 THEN s1 ELSE s0 END AS sl, CASE WHEN m0 > m1 THEN s0 ELSE s1 END AS sh FROM p{rounds} AS p JOIN o USING (c, h))"""


_F = _em(_ROUNDS)


def _fits(t):
    rows = t.lineitem.select(long("l_linenumber").alias("cycle"), F.col("l_returnflag").alias("channel"), "l_extendedprice")
    return mixtures.fit(rows, ["cycle", "channel"], "l_extendedprice", _TOLERANCE, _ROUNDS)


@query(f"{_F} SELECT c AS cycle, h AS channel, total::BIGINT AS n, round(w, 4) AS low_weight, round(lo, 1) AS low_mean, round(sl, 1) AS low_sd, round(hi, 1) AS high_mean, round(sh, 1) AS high_sd, rounds::BIGINT AS rounds, done AS converged FROM f")
def mixture_fit(t):
    return _fits(t).select("cycle", "channel", "n", r("low_weight").alias("low_weight"), *[r(c, 1).alias(c) for c in ("low_mean", "low_sd", "high_mean", "high_sd")], long("rounds").alias("rounds"), "converged")


@query(f"{_F} SELECT c AS cycle, h AS channel, round(greatest((hi - lo) / sl, 0), 3) AS snr, round(hi / (lo + 1e-9), 3) AS sbr, round(3 * sl / (hi - lo + 1e-9), 3) AS lld, round(1 - 3 * (sh + sl) / (abs(hi - lo) + 1e-9), 3) AS z_prime FROM f")
def mixture_signal(t):
    keys = ["cycle", "channel"]
    return mixtures.separation(_fits(t), keys).select(*keys, *[r(c, 3).alias(c) for c in ("snr", "sbr", "lld", "z_prime")])


# Tiles are customers on a plane, neighbouring tiles' shifts have noise; spots of two sides; embeddings are cells


def _grid(t):
    """Edges between grid neighbours: a tile for each customer, 100 apart, with noise from the balance and a bad edge now and then."""
    wide = max(2, int(t.customer.count() ** 0.5))
    place = t.customer.select(F.col("c_custkey").alias("k"), "c_acctbal")
    noise = F.col("c_acctbal") % 3 - 1
    bad = F.when(F.col("k") % 29 == 0, 40.0).otherwise(0.0)
    right = place.where(F.col("k") % wide < wide - 1).select(F.col("k").alias("a"), (F.col("k") + 1).alias("b"), noise.alias("dy"), (100 + noise + bad).alias("dx"))
    down = place.select(F.col("k").alias("a"), (F.col("k") + wide).alias("b"), (100 - noise).alias("dy"), noise.alias("dx"))
    last = place.agg(F.max("k").alias("m"))
    return right.unionByName(down).crossJoin(F.broadcast(last)).where("b <= m").drop("m").withColumn("weight", F.lit(1.0))


@query()
def tile_positions(t):
    """Global places of tiles from pairwise shifts; bad shifts are down-weighted."""
    return positions.solved(_grid(t), 5.0).select("component", "tile", r("y", 3).alias("y"), r("x", 3).alias("x"))


def _candidates(t):
    """Candidate links between two frames: events of a user on a day and on the next with values under 5 apart, the nearer the cheaper."""
    day = t.events.select("event_id", "user_id", "value", F.to_date("ts").alias("d"))
    off = F.abs(F.col("a.value") - F.col("b.value"))
    near = (F.col("a.user_id") == F.col("b.user_id")) & (F.date_add("a.d", 1) == F.col("b.d")) & (off < 5)
    return day.alias("a").join(day.alias("b"), near).select(F.col("a.event_id").alias("src"), F.col("b.event_id").alias("dst"), F.round(off / 5, 2).alias("cost"))


@query()
def track_assignment(t):
    """Links of tracks that save most, one for each event on either side."""
    return assignment.linked(_candidates(t)).select("src", "dst", r("cost").alias("cost"), r("gain").alias("gain"))


@query()
def relaxed_matches(t):
    """Points of orders matched with their moved copies among others, by their neighbourhoods."""
    p = t.orders.select(F.floor(F.col("o_orderkey") / 20_000).alias("well"), F.col("o_orderkey").alias("id"), (F.xxhash64("o_orderkey") % 40000 / 10).alias("y"), (F.xxhash64("o_orderkey", F.lit(1)) % 40000 / 10).alias("x"))
    moved = p.withColumns({"y": F.col("y") + 4 + F.col("id") % 3 * 0.3, "x": F.col("x") - 3})
    other = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10)) < 3
    b = moved.where(~other).unionByName(moved.where(other).withColumns({"y": F.col("y") + F.xxhash64("id", F.lit(3)) % 300 / 10, "x": F.col("x") + F.xxhash64("id", F.lit(4)) % 300 / 10}))
    return relaxation.matched(p, b, 12.0, 150.0, k=6, tolerance=2.0, keys=["well"]).select("well", "id_a", "id_b", r("distance").alias("distance"), r("score").alias("score"))


def _cells(t):
    return t.embeddings.select((F.col("vec_id") % 3).alias("experiment"), long("label").alias("guide"), long("label").alias("gene"), (F.col("vec_id") % 10 / 10).alias("ratio"), (F.col("label") == 0).alias("control"), "embedding")


@query("""
WITH e AS (SELECT vec_id, vec_id % 3 AS x, label::BIGINT AS guide, vec_id % 10 / 10 AS m, embedding::DOUBLE[] AS v FROM embeddings),
u AS (SELECT vec_id, x, guide, (m >= 0.25)::INT + (m >= 0.5)::INT + (m >= 0.75)::INT AS b, unnest(range(len(v))) AS i, unnest(v) AS v, sqrt(list_sum([y * y FOR y IN v])) AS n FROM e),
c AS (SELECT x, i, avg(v) AS m, coalesce(nullif(stddev_samp(v), 0), 1) AS s, avg(v / n) AS q, count(*) AS k FROM u WHERE guide = 0 GROUP BY 1, 2),
l AS (SELECT x, sqrt(sum(q * q)) AS l FROM c GROUP BY 1), h AS (SELECT i, sum(q / l * k) / sum(k) AS h FROM c JOIN l USING (x) GROUP BY 1), g AS (SELECT i, h / (SELECT sqrt(sum(h * h)) FROM h) AS g FROM h),
p AS (SELECT guide, b, i, sum((v - m) / s) AS z, sum(v / n) AS w, count(*) AS k FROM u JOIN c USING (x, i) WHERE guide <> 0 GROUP BY 1, 2, 3),
t AS (SELECT guide FROM p WHERE i = 0 GROUP BY 1 HAVING count(*) >= 2)
SELECT guide, b::INT AS bin, max(k) AS n, round(sqrt(avg((z / k) ** 2)), 4) AS cohens_d, round(1 - sum(w * g) / sqrt(sum(w * w)), 5) AS cosine_distance FROM p JOIN g USING (i) JOIN t USING (guide) GROUP BY 1, 2""")
def two_pass_effects(t):
    """Effect sizes of guides by bins of a ratio, from each experiment's partial results."""
    cells = _cells(t)
    used = pooled.edges(pooled.metric_counts(cells, "ratio"), "fixed", 4)
    out = pooled.effects(pooled.partials(cells, "ratio", "embedding", "fixed", 4), pooled.controls(cells, "embedding"), used, "fixed", 4)
    return out.select("guide", "bin", "n", r("cohens_d").alias("cohens_d"), r("cosine_distance", 5).alias("cosine_distance"))


@query()
def two_pass_downsampled(t):
    """The same with all bins of a guide cut to the rows of its least one."""
    cells = _cells(t)
    used = pooled.edges(pooled.metric_counts(cells, "ratio"), "fixed", 4)
    out = pooled.effects(pooled.partials(cells, "ratio", "embedding", "fixed", 4), pooled.controls(cells, "embedding"), used, "fixed", 4, least=3, downsample=True)
    return out.select("guide", "bin", "n", "taken", r("cohens_d").alias("cohens_d"), r("cosine_distance", 5).alias("cosine_distance"))
