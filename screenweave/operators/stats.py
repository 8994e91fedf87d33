"""Statistics by group: outliers, bins, regressions, correlations, rank tests, effect sizes, signal tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenweave.operators.scratch import saved

Keys = list[str]
#: Up to so many buckets are sent to the rows.
SENT = 20_000


def corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation of the rows that have both values; null where either side is constant (Spark's own raises there)."""
    X, Y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    both = X.isNotNull() & Y.isNotNull()
    deviation = F.stddev_pop(F.when(both, X)) * F.stddev_pop(F.when(both, Y))
    return F.covar_pop(X, Y) / F.nullif(deviation, F.lit(0.0))


# Tail probabilities as column expressions, for tables of results (a row for each group)


def _log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function of positive values, by Stirling's series at x + 8."""
    y = x + 8
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return series - sum((F.log(x + k) for k in range(1, 8)), F.log(x))


def incomplete_beta(a: Column, b: Column, x: Column, terms: int = 200) -> Column:
    """The regularised incomplete beta function I_x(a, b), by its continued fraction (evaluated from the last term)."""

    def fraction(a: Column, b: Column, x: Column) -> Column:
        def term(m: Column) -> Column:
            k = F.floor(m / 2)
            even = k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k))
            odd = -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))
            return F.when(m % 2 == 0, even).otherwise(odd)

        down = F.sequence(F.lit(float(terms)).cast("int"), F.lit(1), F.lit(-1))
        return F.aggregate(down, F.lit(1.0), lambda f, m: 1 + term(m.cast("double")) / f)

    front = F.exp(_log_gamma(a + b) - _log_gamma(a) - _log_gamma(b) + a * F.log(x) + b * F.log(1 - x))
    low = front / (a * fraction(a, b, x))
    high = 1 - front / (b * fraction(b, a, 1 - x))
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).when(x < (a + 1) / (a + b + 2), low).otherwise(high)


def student_p(t: Column, df: Column) -> Column:
    """Two-sided p of Student's t."""
    n = df.cast("double")
    return F.when(n > 0, incomplete_beta(n / 2, F.lit(0.5), n / (n + t * t)))


def correlation_p(r: Column, n: Column) -> Column:
    """Two-sided p of a correlation of n pairs under normality (also the usual one of Spearman's rho); 0 for a perfect one, null under three pairs."""
    df = n.cast("double") - 2
    return F.when(r.isNotNull() & (df > 0), F.when(F.abs(r) >= 1, 0.0).otherwise(incomplete_beta(df / 2, F.lit(0.5), F.greatest(1 - r * r, F.lit(0.0)))))


def normal_p(z: Column) -> Column:
    """Two-sided p of a standard normal value: a power series for small values, a continued fraction for large ones."""
    x = F.abs(z.cast("double"))
    h = x * x / 2
    steps = lambda n: F.sequence(F.lit(1), F.lit(n))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))
    series = F.aggregate(steps(60), start, lambda s, k: F.struct((s["term"] * 2 * h / (2 * k + 1)).alias("term"), (s["sum"] + s["term"] * 2 * h / (2 * k + 1)).alias("sum")), lambda s: s["sum"])
    small = 1 - math.sqrt(2 / math.pi) * x * F.exp(-h) * series
    fraction = F.aggregate(F.reverse(steps(80)), x, lambda f, k: x + k / f)
    large = math.sqrt(2 / math.pi) * F.exp(-h) / fraction
    return F.when(x < 3, small).otherwise(large)


def group_zscore(df: DataFrame, keys: Keys, value: str) -> DataFrame:
    """(value - mean) / sample deviation by key; 0 where the deviation is 0 or there is one row."""
    both = _by(df, keys, [F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s")])
    return both.withColumn("z", F.coalesce((F.col(value) - F.col("_m")) / F.nullif(F.col("_s"), F.lit(0.0)), F.lit(0.0))).drop("_m", "_s")


def _by(df: DataFrame, keys: Keys, aggs: list[Column]) -> DataFrame:
    """Group aggregates joined back to their rows; a null key is a key. No window holds a group this way."""
    if not keys:
        return df.crossJoin(F.broadcast(df.agg(*aggs)))
    found = df.groupBy(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)]).agg(*aggs)
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & df[k].eqNullSafe(found[f"_g{i}"])
    return df.join(found, on).drop(*[f"_g{i}" for i in range(len(keys))])


def outliers(df: DataFrame, keys: Keys, value: str, z: float = 2.5, modified: float = 3.5, fence: float = 1.5, count: str | None = None) -> DataFrame:
    """Votes of three methods (z-score, modified z-score by median deviation, quartile fences), consensus of two, and direction. count: a column with how many rows a row stands for."""
    v = F.col(value)
    n = F.when(v.isNotNull(), F.col(count) if count else F.lit(1))
    half = lambda c, q: F.percentile(c, F.lit(q), F.col(count)) if count else F.percentile(c, F.lit(q))
    one = _by(df, keys, [(F.sum(n * v) / F.sum(n)).alias("_m"), half(value, 0.5).alias("_md"), half(value, 0.25).alias("_q1"), half(value, 0.75).alias("_q3")])
    one = one.withColumn("_dev", F.abs(v - F.col("_md")))
    two = _by(one, keys, [F.sqrt(F.sum(n * (v - F.col("_m")) ** 2) / F.nullif(F.sum(n) - 1, F.lit(0))).alias("_s"), half("_dev", 0.5).alias("_mad"), (F.sum(n * F.col("_dev")) / F.sum(n)).alias("_aad")])
    score = F.when(F.col("_mad") > 0, 0.6745 * (v - F.col("_md")) / F.col("_mad")).when(F.col("_aad") > 0, (v - F.col("_md")) / (1.253314 * F.col("_aad"))).otherwise(0.0)
    iqr = F.col("_q3") - F.col("_q1")
    votes = {"by_z": F.coalesce(F.abs(v - F.col("_m")) > z * F.nullif(F.col("_s"), F.lit(0.0)), F.lit(False)), "by_mad": F.abs(score) > modified, "by_iqr": (v < F.col("_q1") - fence * iqr) | (v > F.col("_q3") + fence * iqr)}
    out = two.withColumns(votes).withColumn("votes", F.col("by_z").cast("int") + F.col("by_mad").cast("int") + F.col("by_iqr").cast("int"))
    out = out.withColumns({"is_outlier": F.col("votes") >= 2, "direction": F.when(F.col("votes") < 2, "NONE").when(v > F.col("_md"), "HIGH").otherwise("LOW")})
    return out.drop("_m", "_s", "_md", "_q1", "_q3", "_dev", "_mad", "_aad")


def right_closed_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Index from 0 of the bin (lo, hi] of `bins` equal ones; the lowest value belongs to the first, values outside have null."""
    at = F.ceil((value - low) / ((high - low) / bins)) - 1
    return F.when((value < low) | (value > high), None).otherwise(F.greatest(F.lit(0), F.least(F.lit(bins - 1), at))).cast("int")


def binned(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """Bins of x between its extremes: count, median of x and y, quartiles, mean and deviation of y."""
    edges = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    at = df.crossJoin(F.broadcast(edges)).withColumn("bin", right_closed_bin(F.col(x), F.col("_lo"), F.col("_hi"), bins))
    q = lambda p, c: F.percentile(c, F.lit(p))
    return at.groupBy("bin").agg(F.count("*").alias("n"), q(0.5, x).alias("x_median"), q(0.5, y).alias("y_median"), q(0.25, y).alias("y_q25"), q(0.75, y).alias("y_q75"), F.avg(y).alias("y_mean"), F.stddev_samp(y).alias("y_std"))


def regression(df: DataFrame, x: str, y: str, keys: Keys = ()) -> DataFrame:
    """Slope, intercept, r, r squared, n and the two-sided p of a slope of 0; groups of fewer than five rows have nulls, and so has r of a constant side."""
    X, Y = F.col(x).cast("double"), F.col(y).cast("double")
    aggs = [F.count(F.when(X.isNotNull() & Y.isNotNull(), 1)).alias("n"), F.regr_slope(Y, X).alias("slope"), F.regr_intercept(Y, X).alias("intercept"), corr(X, Y).alias("r"), F.regr_r2(Y, X).alias("r2")]
    out = df.groupBy(*keys).agg(*aggs)
    out = out.select(*keys, "n", *[F.when(F.col("n") >= 5, F.col(c)).alias(c) for c in ("slope", "intercept", "r", "r2")])
    return out.withColumn("p_value", correlation_p(F.col("r"), F.col("n")))


def average_ranks(df: DataFrame, value: str, keys: Keys = (), name: str = "rank") -> DataFrame:
    """Ranks with ties averaged: the number of smaller values + (ties + 1) / 2. Null values have null ranks.

    No task ranks the rows of a key: values are counted, counts are summed up within ranges of values and over the
    ranges, and the ranks are joined back by value.
    """
    counts = _positions(df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n")), value, keys)
    ranks = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(value).alias("_v"), (F.col("_before") + (F.col("_n") + 1) / 2).alias(name))
    on = df[value].eqNullSafe(ranks["_v"])
    for i, k in enumerate(keys):
        on = on & df[k].eqNullSafe(ranks[f"_k{i}"])
    return df.join(ranks, on, "left").drop("_v", *[f"_k{i}" for i in range(len(keys))])


def _bucket(value: Column, buckets: int = 256) -> Column:
    """A whole number that never falls as the value rises: so many buckets for each power of two, on both sides of 0."""
    x = value.cast("double")
    at = F.floor(F.least(F.log2(F.abs(x)), F.lit(1025.0)) * buckets) + 400_000
    return F.when(F.isnan(x), 1_000_000).when(x == 0, 0).otherwise(F.signum(x) * at).cast("int")


def _positions(counts: DataFrame, value: str, keys: Keys) -> DataFrame:
    """With `_before`: the sum of `_n` over the key's smaller values (counts: a row for each key and value).

    Values are summed up within buckets, and the sums of the buckets are carried on. The bucket depends on the value
    alone, so that both readings agree.
    """
    own = counts.withColumn("_b", _bucket(F.col(value)))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    local = own.withColumn("_local", before(W.partitionBy(*keys, "_b").orderBy(value)))
    sums = own.groupBy(*keys, "_b").agg(F.sum("_n").alias("_n"))
    carried = sums.withColumn("_carried", before(W.partitionBy(*keys).orderBy("_b"))).select(*[F.col(k).alias(f"_c{i}") for i, k in enumerate(keys)], F.col("_b").alias("_r"), "_carried")
    on = F.col("_b") == F.col("_r")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_c{i}"))
    return local.join(carried, on).withColumn("_before", F.col("_local") + F.col("_carried")).drop("_local", "_carried", "_b", "_r", *[f"_c{i}" for i in range(len(keys))])


def spearman(df: DataFrame, x: str, y: str, keys: Keys = ()) -> DataFrame:
    ranked = average_ranks(average_ranks(df.dropna(subset=[x, y]), x, keys, "_rx"), y, keys, "_ry")
    out = ranked.groupBy(*keys).agg(corr("_rx", "_ry").alias("rho"), F.count("*").alias("n"))
    return out.withColumn("p_value", correlation_p(F.col("rho"), F.col("n")))


def partial_correlation(df: DataFrame, x: str, y: str, given: str) -> DataFrame:
    """Correlation of x and y with the linear effect of `given` taken out, from three plain correlations."""
    c = df.agg(corr(x, y).alias("xy"), corr(x, given).alias("xg"), corr(y, given).alias("yg"))
    left = F.sqrt(F.greatest((1 - F.col("xg") ** 2) * (1 - F.col("yg") ** 2), F.lit(0.0)))
    return c.select(((F.col("xy") - F.col("xg") * F.col("yg")) / F.nullif(left, F.lit(0.0))).alias("partial_r"))


def correlation_matrix(df: DataFrame, item: str, group: str, value: str) -> DataFrame:
    """Pearson correlation of two groups' values over their common items, for each pair of groups, with the number of items."""
    a, b = df.select(F.col(item), F.col(group).alias("a"), F.col(value).alias("x")), df.select(F.col(item), F.col(group).alias("b"), F.col(value).alias("y"))
    return a.join(b, item).where("a < b").groupBy("a", "b").agg(corr("x", "y").alias("r"), F.count("*").alias("common")).withColumn("p_value", correlation_p(F.col("r"), F.col("common")))


def rank_by_correlation(df: DataFrame, metrics: Keys, effect: str) -> DataFrame:
    """(metric, r) of each metric with the effect, strongest first."""
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])).alias("m"), effect)
    return rows.groupBy(F.col("m.metric").alias("metric")).agg(corr("m.v", effect).alias("r"), F.count(F.when(F.col("m.v").isNotNull() & F.col(effect).isNotNull(), 1)).alias("n")).withColumn("p_value", correlation_p(F.col("r"), F.col("n"))).orderBy(F.desc(F.abs("r")), "metric")


def _ties(counts: DataFrame) -> Column:
    """Sum of t^3 - t over the groups of t tied values."""
    n = F.col("_n").cast("double")
    return F.coalesce(F.sum(n**3 - n), F.lit(0.0))


def mann_whitney(df: DataFrame, value: str, group: str, first) -> DataFrame:
    """U of the rows with group = first against all others, its normal approximation z without tie correction, and the two-sided p with tie and continuity correction (null if all values are equal or a side is empty).

    Works on the counts of the different values, so that no task ranks all rows.
    """
    mine = F.col(group) == first
    counts = df.dropna(subset=[value, group]).groupBy(value).agg(F.count("*").alias("_n"), F.count_if(mine).alias("_n1"))
    ranked = _positions(counts, value, [])
    s = ranked.agg(F.sum(F.col("_n1") * (F.col("_before") + (F.col("_n") + 1) / 2)).alias("r"), F.coalesce(F.sum("_n1"), F.lit(0)).alias("n1"), F.coalesce(F.sum(F.col("_n") - F.col("_n1")), F.lit(0)).alias("n2"), _ties(ranked).alias("t"))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n, u = n1 + n2, F.col("r") - n1 * (n1 + 1) / 2
    plain = F.sqrt(n1 * n2 * (n + 1) / 12)
    tied = F.sqrt(F.greatest(n1 * n2 / 12 * ((n + 1) - F.col("t") / F.nullif(n * (n - 1), F.lit(0.0))), F.lit(0.0)))
    corrected = F.greatest(F.abs(u - n1 * n2 / 2) - 0.5, F.lit(0.0)) / F.nullif(tied, F.lit(0.0))
    return s.select("n1", "n2", u.alias("u"), ((u - n1 * n2 / 2) / F.nullif(plain, F.lit(0.0))).alias("z"), normal_p(corrected).alias("p_value"))


def wilcoxon(df: DataFrame, a: str, b: str) -> DataFrame:
    """Signed-rank sums of paired values (zero differences are left out), and the two-sided p of the normal approximation with tie correction."""
    d = df.withColumn("_d", F.col(a) - F.col(b)).where("_d <> 0").withColumn("_m", F.abs("_d"))
    counts = d.groupBy("_m").agg(F.count("*").alias("_n"), F.count_if(F.col("_d") > 0).alias("_up"))
    ranked = _positions(counts, "_m", []).withColumn("_r", F.col("_before") + (F.col("_n") + 1) / 2)
    s = lambda c: F.coalesce(F.sum(F.col("_r") * c), F.lit(0.0))
    out = ranked.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), s(F.col("_up")).alias("w_plus"), s(F.col("_n") - F.col("_up")).alias("w_minus"), _ties(ranked).alias("_t"))
    n = F.col("n").cast("double")
    deviation = F.sqrt(F.greatest(n * (n + 1) * (2 * n + 1) / 24 - F.col("_t") / 48, F.lit(0.0)))
    z = (F.least("w_plus", "w_minus") - n * (n + 1) / 4) / F.nullif(deviation, F.lit(0.0))
    return out.withColumn("p_value", normal_p(z)).drop("_t")


def two_level_noise(df: DataFrame, keys: Keys, kind: str, mean: str, std: str) -> DataFrame:
    """Signal and Background rows of a key side by side, with their snr, sbr, lld and z-prime."""
    from screenweave.functions.expressions import signal_metrics

    pick = lambda k, c: F.max(F.when(F.col(kind) == k, F.col(c)))
    wide = df.groupBy(*keys).agg(pick("Signal", mean).alias("s"), pick("Background", mean).alias("b"), pick("Signal", std).alias("ss"), pick("Background", std).alias("bs"))
    return wide.where("s IS NOT NULL AND b IS NOT NULL").withColumn("m", signal_metrics(F.col("s"), F.col("b"), F.col("ss"), F.col("bs"))).select(*keys, "m.*")


def top_decile_median(df: DataFrame, keys: Keys, value: str, share: float = 0.1) -> DataFrame:
    """Median of the largest max(1, floor(share n)) values of a key.

    Rows are counted by buckets of values first; only those in the bucket or two that hold the median are counted by value.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"), _bucket(F.col(value), 32).alias("_b"))
    above = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = rows.groupBy(*keys, "_b").agg(F.count("*").alias("_n")).withColumns({"_larger": above(W.partitionBy(*keys).orderBy(F.desc("_b"))), "_all": F.sum("_n").over(W.partitionBy(*keys))})
    # the places of the two middle values, from above
    top = F.greatest(F.lit(1).cast("long"), F.floor(share * F.col("_all")))
    middle = sums.withColumns({"_i": F.floor((top - 1) / 2), "_j": F.ceil((top - 1) / 2)}).where("_larger <= _j AND _larger + _n > _i")
    names = {k: f"_g{i}" for i, k in enumerate(keys)} | {"_b": "_h"}
    middle = saved(middle.select(*[F.col(k).alias(n) for k, n in names.items()], "_larger", "_i", "_j"), "middle")
    on = F.lit(True)
    for k, n in names.items():
        on = on & F.col(k).eqNullSafe(F.col(n))
    # few buckets go to the rows; many are met by a shuffle
    inside = rows.join(F.broadcast(middle) if middle.count() <= SENT else middle, on)
    counts = inside.groupBy(*keys, "_b", "_larger", "_i", "_j", "_v").agg(F.count("*").alias("_n"))
    larger = F.col("_larger") + above(W.partitionBy(*keys, "_b").orderBy(F.desc("_v")))
    at = lambda place: F.max(F.when((F.col("_before") <= F.col(place)) & (F.col("_before") + F.col("_n") > F.col(place)), F.col("_v")))
    return counts.withColumn("_before", larger).groupBy(*keys).agg((0.5 * at("_i") + 0.5 * at("_j")).alias("median_top"))


def crosstalk(df: DataFrame, read: Keys, channel: str, value: str, channels: list[str]) -> DataFrame:
    """Rows: the brightest channel of a read; columns: medians of all channels, each row divided by its sum, missing 0."""
    wide = df.groupBy(*read).pivot(channel, channels).agg(F.first(value)).fillna(0.0, subset=channels)
    order = F.array(*[F.struct(F.col(c).alias("v"), F.lit(-k).alias("k"), F.lit(c).alias("c")) for k, c in enumerate(channels)])
    named = wide.withColumn("brightest", F.array_max(order)["c"])
    med = named.groupBy("brightest").agg(*[F.percentile(c, F.lit(0.5)).alias(c) for c in channels])
    total = sum((F.col(c) for c in channels), F.lit(0.0))
    return med.select("brightest", *[F.coalesce(F.col(c) / F.nullif(total, F.lit(0.0)), F.lit(0.0)).alias(c) for c in channels])


def vector_means(df: DataFrame, keys: Keys, vector: str, least: int = 3) -> DataFrame:
    """Element-wise means (key, dim, mean, n), groups with fewer rows than `least` left out. Partial sums combine before the shuffle."""
    return df.select(*keys, F.posexplode(vector).alias("dim", "v")).groupBy(*keys, "dim").agg(F.avg("v").alias("mean"), F.count("*").alias("n")).where(F.col("n") >= least)


def effect_sizes(df: DataFrame, group: str, vector: str, control: Column, least: int = 3) -> DataFrame:
    """For each group, root mean square over the dimensions of (mean - control mean) / control deviation, and the cosine distance of the means.

    Control deviations are sample deviations; zero ones count as 1.
    """
    long = df.select(F.col(group), control.alias("_c"), F.posexplode(vector).alias("dim", "v"))
    base = long.where("_c").groupBy("dim").agg(F.avg("v").alias("_m"), F.stddev_samp("v").alias("_s"))
    mean = long.where(~F.col("_c")).groupBy(group, "dim").agg(F.avg("v").alias("m"), F.count("*").alias("n")).where(F.col("n") >= least)
    sd = F.coalesce(F.nullif(F.col("_s"), F.lit(0.0)), F.lit(1.0))
    both = mean.join(base, "dim")
    dot = F.sum(F.col("m") * F.col("_m")) / F.sqrt(F.sum(F.col("m") ** 2) * F.sum(F.col("_m") ** 2))
    return both.groupBy(group).agg(F.max("n").alias("n"), F.sqrt(F.avg(((F.col("m") - F.col("_m")) / sd) ** 2)).alias("effect"), (1 - dot).alias("cosine_distance"))


def block_variation(df: DataFrame, keys: Keys, value: str) -> DataFrame:
    """Coefficient of variation of block means."""
    return df.groupBy(*keys).agg((F.stddev_pop(value) / F.nullif(F.avg(value), F.lit(0.0))).alias("cv"))


def running_gate(df: DataFrame, keys: Keys, order: str, count: str, drop: float = 0.15) -> DataFrame:
    """Whether a count is valid: the first always, later ones unless they fall more than `drop` below the running maximum before."""
    before = F.max(count).over(W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    return df.withColumns({"best_before": before, "valid": before.isNull() | (F.col(count) >= (1 - drop) * before)})


def low_entropy_bias(slope: Column, p_value: Column, barcodes: Column) -> Column:
    """Biased with a slope under -50, or a negative one with p < 0.05; null with fewer than ten barcodes."""
    return F.when(barcodes >= 10, (slope < -50) | ((slope < 0) & (p_value < 0.05)))


def compare_metrics(reference: DataFrame, candidate: DataFrame, tolerance: float) -> DataFrame:
    """Every reference metric of the wells that both have (metric, well, value), with status; a metric that the candidate lacks is cand_nan."""
    from screenweave.functions.expressions import relative_status

    wells = candidate.select("well").distinct()
    both = reference.join(wells, "well", "left_semi").join(candidate.withColumnRenamed("value", "candidate"), ["metric", "well"], "left")
    return both.withColumn("status", relative_status(F.col("value").cast("double"), F.col("candidate").cast("double"), tolerance))
