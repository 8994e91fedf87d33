"""Selection and counting by key: keep-first, votes, multiplets, samples, grouping sets, outer joins with indicator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenweave.operators.ordered import first_by_hash

Keys = list[str]


def keep_first(df: DataFrame, keys: Keys, order: list) -> DataFrame:
    """The first row of each key in the given order. The order should be total, else a choice among ties is Spark's."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def top_per_key(df: DataFrame, keys: Keys, order: list, n: int | Column) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def value_counts(df: DataFrame, *cols: str) -> DataFrame:
    """Rows by value; nulls don't count."""
    return df.dropna(subset=list(cols)).groupBy(*cols).agg(F.count("*").alias("count"))


def top_values(df: DataFrame, key: str, counted: str, n: int) -> DataFrame:
    """The n keys with the most distinct values of `counted`; ties by key."""
    return df.dropna(subset=[key]).groupBy(key).agg(F.countDistinct(counted).alias("n")).orderBy(F.desc("n"), key).limit(n)


def with_pooled(df: DataFrame, key: str, aggs: list[Column], pooled: str = "ALL") -> DataFrame:
    """Aggregates by key, and over all rows as the key `pooled`, in one pass."""
    return df.groupingSets([[F.col(key)], []], key).agg(*aggs, F.grouping(key).alias("_all")).withColumn(key, F.when(F.col("_all") == 1, F.lit(pooled)).otherwise(F.col(key).cast("string"))).drop("_all")


def per_group_summary(df: DataFrame, group: str, member: str) -> DataFrame:
    """Mean, median, least and most distinct members of a group."""
    n = df.groupBy(group).agg(F.countDistinct(member).alias("n"))
    return n.agg(F.avg("n").alias("mean"), F.expr("percentile(n, 0.5)").alias("median"), F.min("n").alias("min"), F.max("n").alias("max"), F.count("*").alias("groups"))


def doublets(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys of exactly two rows with two different values."""
    return df.groupBy(key).agg(F.count("*").alias("rows"), F.countDistinct(value).alias("values")).where("rows = 2 AND values = 2").select(key)


def singlets(df: DataFrame, keys: Keys, value: str, order: list) -> DataFrame:
    """The first row of each key whose non-null values are all the same. min = max tells so without a distinct."""
    w = W.partitionBy(*keys)
    one = df.dropna(subset=[value]).withColumns({"_lo": F.min(value).over(w), "_hi": F.max(value).over(w), "_n": F.row_number().over(w.orderBy(*order))})
    return one.where("_lo = _hi AND _n = 1").drop("_lo", "_hi", "_n")


def dedupe_report(df: DataFrame, key: str, guide: str, gene: str) -> DataFrame:
    """Counts of keys that are singlets, multiplets, without guide, and controls only (no gene)."""
    by = df.dropna(subset=[key]).groupBy(key).agg(F.countDistinct(guide).alias("guides"), F.count(gene).alias("genes"))
    return by.agg(F.count_if(F.col("guides") == 1).alias("singlets"), F.count_if(F.col("guides") > 1).alias("multiplets"), F.count_if(F.col("guides") == 0).alias("no_guide"), F.count_if((F.col("guides") > 0) & (F.col("genes") == 0)).alias("control_only"))


def majority_vote(df: DataFrame, key: str, value: str) -> DataFrame:
    """Each key's most frequent value (ties: the smallest), with its votes."""
    votes = df.dropna(subset=[value]).groupBy(key, value).agg(F.count("*").alias("votes"))
    return keep_first(votes, [key], [F.desc("votes"), value])


def last_wins(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Key to value, from the row with the largest order."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def outer_indicator(a: DataFrame, b: DataFrame, keys: Keys) -> DataFrame:
    """Counts of a full outer join's rows that are left only, right only and in both."""
    joined = a.withColumn("_l", F.lit(1)).join(b.withColumn("_r", F.lit(1)), keys, "full_outer")
    side = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").otherwise("both")
    return joined.groupBy(side.alias("side")).agg(F.count("*").alias("n"))


def left_fill(a: DataFrame, b: DataFrame, keys: Keys, fill: dict) -> DataFrame:
    return a.join(b, keys, "left").fillna(fill)


def sample(df: DataFrame, order: Column, n: int) -> DataFrame:
    """n rows in the order of a hash column: repeatable, whatever the partitioning."""
    return df.withColumn("_h", order).orderBy("_h").limit(n).drop("_h")


def stratified_sample(df: DataFrame, stratum: str, order: Column, n: int) -> DataFrame:
    """n rows in proportion to the strata (quotas rounded down), topped up to n from the rest in hash order.

    The rows are ranked by (over quota, hash), and the first n taken.
    """
    # only a stratum's first n rows can be taken; each part of it sends no more than n, so that no task sorts a stratum
    parts = 64
    h = df.withColumn("_h", order).withColumn("_p", F.pmod(F.xxhash64("_h"), F.lit(parts)))
    first = top_per_key(h, [stratum, "_p"], ["_h"], n).drop("_p").withColumn("_k", F.row_number().over(W.partitionBy(stratum).orderBy("_h"))).where(F.col("_k") <= n)
    sizes = df.groupBy(F.col(stratum).alias("_s")).agg(F.count("*").alias("_in"))
    total = df.agg(F.count("*").alias("_all"))
    ranked = first.join(sizes, F.col(stratum).eqNullSafe(F.col("_s"))).crossJoin(F.broadcast(total))
    quota = F.floor(F.lit(n) * F.col("_in") / F.col("_all"))
    return ranked.withColumn("_rest", (F.col("_k") > quota).cast("int")).orderBy("_rest", "_h").limit(n).drop("_h", "_k", "_in", "_all", "_rest", "_s")


def capped_sample(df: DataFrame, keys: Keys, order: Column, n: int) -> DataFrame:
    return top_per_key(df, keys, [order], n)


def equal_downsample(df: DataFrame, group: str, bin_: str, order: Column, bins: int) -> DataFrame:
    """As many rows of each of a group's bins as its smallest one has, the first by `order`, a hash as hexadecimal text; groups that lack a bin are left out."""
    sizes = df.groupBy(group, bin_).agg(F.count("*").alias("_n")).groupBy(group).agg(F.min("_n").alias("_least"), F.count("*").alias("_bins")).where(F.col("_bins") == bins)
    return first_by_hash(df.withColumn("_o", order).join(sizes.drop("_bins"), group), [group, bin_], F.col("_o"), "_least").drop("_least", "_o")


def cumulative_share(df: DataFrame, value: str, order: list) -> DataFrame:
    """Running share of the total in percent. Meant for tables of counts: the running sum goes through one task."""
    w = W.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("cumulative_share", 100 * F.sum(value).over(w) / F.sum(value).over(W.partitionBy()))


def top_share(df: DataFrame, value: str, n: int) -> DataFrame:
    """Share in percent of the n largest values (null if the total is 0): a top-n, which each task cuts to n rows, over the total."""
    top = df.select(value).orderBy(F.desc(value)).limit(n).agg(F.sum(value).alias("_top"))
    return top.crossJoin(F.broadcast(df.agg(F.sum(value).alias("_all")))).select((100 * F.col("_top") / F.nullif(F.col("_all"), F.lit(0))).alias("share"))


def lag_difference(df: DataFrame, keys: Keys, order: str, values: Keys, origin: bool = True) -> DataFrame:
    """value - previous value by key, the first against 0 if `origin`, else null."""
    w = W.partitionBy(*keys).orderBy(order)
    return df.withColumns({f"d_{v}": F.col(v) - (F.lag(v, 1, 0).over(w) if origin else F.lag(v).over(w)) for v in values})


def number_ranges(df: DataFrame, keys: Keys, number: str) -> DataFrame:
    """Consecutive integers as ranges `1-3,7` by key: gaps and islands."""
    own = df.select(*keys, number).distinct().withColumn("_g", F.col(number) - F.row_number().over(W.partitionBy(*keys).orderBy(number)))
    spans = own.groupBy(*keys, "_g").agg(F.min(number).alias("lo"), F.max(number).alias("hi"))
    text = F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).otherwise(F.concat(F.col("lo").cast("string"), F.lit("-"), F.col("hi").cast("string")))
    return spans.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("lo", text.alias("t")))), lambda x: x["t"]), ",").alias("ranges"))


def missing(expected: DataFrame, existing: DataFrame, keys: Keys) -> DataFrame:
    return expected.join(existing, keys, "left_anti")


def funnel(stages: list[tuple[str, DataFrame]], counted: str) -> DataFrame:
    """Distinct items at each stage, in order, and the share of the stage before in percent."""
    out = None
    for k, (name, df) in enumerate(stages):
        row = df.agg(F.countDistinct(counted).alias("n")).select(F.lit(k).alias("step"), F.lit(name).alias("stage"), "n")
        out = row if out is None else out.unionAll(row)
    return out.withColumn("kept_pct", 100 * F.col("n") / F.lag("n").over(W.orderBy("step")))


def members(df: DataFrame, among: DataFrame, columns: Keys, among_columns: Keys | None = None) -> DataFrame:
    """The rows whose columns together are a row's of another table: a semi-join on a digest of the columns, so that long keys don't move.

    The columns are joined as texts by a character that ends them, and told apart by SHA-256. A null matches nothing.
    """
    digest = lambda cs: F.unhex(F.sha2(F.concat(*[x for c in cs for x in (F.regexp_replace(F.col(c).cast("string"), "[\\\\\\x00]", "\\\\\\\\$0"), F.lit("\x00"))]), 256))
    keys = among.select(digest(among_columns or columns).alias("_key")).dropna().distinct()
    return df.withColumn("_key", digest(columns)).join(keys, "_key", "left_semi").drop("_key")
