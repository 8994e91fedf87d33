"""Temperature mixing of sources.

A source's share p of all tokens becomes the weight p^a / sum(p^a). Smaller exponents a flatten the mixture. The
exponent is the smallest one in [0, 1] with which the mixture's entropy is no more than `entropy` times the greatest
possible (or 1 if the natural mixture is flatter already) and no source is repeated more than `repeats` times. It is
bisected by aggregations over the table of sources, GRID values at once, so the sources are never collected.

The budget in tokens goes to the sources by weight; by default it is the least with which every source is used once at
least. A source with quota q and t tokens gets q // t whole epochs and a last one in part. Documents are dealt into
blocks of about BLOCK_TOKENS tokens by a hash; an epoch is a permutation of the blocks and within each of its
documents, both by hashes of seed and epoch. The last epoch takes blocks while their running total fits the rest of the
quota, and of the next block documents while theirs does, so quotas are never exceeded and fall short by less than one
document. No step holds a source in one task: totals are by block, and windows span the blocks' table or one block.

The draws depend on the rows alone, not on their order or files: the same table in another layout gives the same mixture.

Defined results: null texts have no tokens. A source without tokens has weight 0 and no rows. A null source is a source
of its own. Documents without tokens go with their block. Repeated rows are documents of their own. No rows: no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenweave.llm.common import table, written

ENTROPY, REPEATS, SEED = 0.95, 4.0, 2027
#: Blocks have so many tokens at least; with more than MAX_BLOCKS x BLOCK_TOKENS tokens, blocks grow instead of their number.
BLOCK_TOKENS, MAX_BLOCKS = 100_000, 200_000
GRID, ROUNDS = 64, 6


def tokens(text: Column) -> Column:
    """Number of words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def exponent(sources: DataFrame, entropy: float | None = ENTROPY, repeats: float | None = REPEATS, budget: float | None = None) -> float:
    """The exponent for a table of sources (t: tokens, over 0)."""
    total = sources.agg(F.sum("t").alias("t"), F.max("t").alias("most"), F.count("*").alias("n")).first()
    if not total["t"]:
        return 1.0
    p = F.col("t") / F.lit(float(total["t"]))
    top, n = total["most"] / total["t"], total["n"]

    def bad(rows: list) -> dict[float, bool]:
        """Of each exponent, whether the mixture is flatter than asked for or repeats a source too often."""
        out = {}
        for r in rows:
            z = r["z"]
            h = math.log(z) - r["a"] * r["l"] / z
            given = budget if budget is not None else total["t"] * top ** (1 - r["a"]) * z
            flat = entropy is not None and n > 1 and h > entropy * math.log(n) + 1e-12
            often = repeats is not None and r["q"] / z * given / total["t"] > repeats * (1 + 1e-12)
            out[r["a"]] = flat or often
        return out

    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        at = [lo + (hi - lo) * k / GRID for k in range(GRID + 1)]
        a = sources.select("t", F.explode(F.array(*[F.lit(x) for x in at])).alias("a"))
        rows = a.groupBy("a").agg(F.sum(F.pow(p, F.col("a"))).alias("z"), F.sum(F.pow(p, F.col("a")) * F.log(p)).alias("l"), F.max(F.pow(p, F.col("a") - 1)).alias("q")).collect()
        found = bad(rows)
        good = next((k for k, x in enumerate(at) if not found[x]), GRID)
        if good == 0:
            return at[0]
        lo, hi = at[good - 1], at[good]
    return hi


def _order(*parts) -> Column:
    return F.xxhash64(F.lit(SEED), *parts)


def mixed(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", entropy: float | None = ENTROPY, repeats: float | None = REPEATS, budget: int | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, source, n_tokens, weight, epoch, slot, place): each draw of a document; slot is the block's place in its epoch, place the document's in the block."""
    body = F.col(text).cast("string")
    rows = docs.select(F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"), tokens(body).alias("n_tokens"), F.xxhash64(body).alias("hash"))
    # equal rows are told apart by a number, so that the draws don't depend on how the table lies in files
    rows = rows.groupBy("doc_id", "source", "n_tokens", "hash").agg(F.count("*").cast("int").alias("of")).withColumn("row", F.explode(F.sequence(F.lit(1), F.col("of")))).drop("of")
    rows = written(rows.withColumn("name", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))), "tokens")
    sources = written(rows.groupBy("name").agg(F.sum("n_tokens").alias("t")).where("t > 0"), "sources")
    a = exponent(sources, entropy, repeats, budget)
    total = sources.agg(F.sum("t").alias("t"), F.max("t").alias("most")).first()
    all_, most = float(total["t"] or 1), float(total["most"] or 1)
    p = F.col("t") / F.lit(all_)
    z = sources.agg(F.sum(F.pow(p, F.lit(a))).alias("z")).first()["z"] or 1.0
    given = float(budget) if budget is not None else all_ * (most / all_) ** (1 - a) * z
    per_block = max(block_tokens, -(-int(all_) // MAX_BLOCKS))
    plan = sources.select("name", "t", (F.pow(p, F.lit(a)) / F.lit(z)).alias("weight"))
    # a rounding of the quota keeps the largest source's one whole epoch whole
    plan = plan.withColumn("quota", F.round(F.col("weight") * F.lit(given)).cast("long")).withColumns({"whole": F.floor(F.col("quota") / F.col("t")).cast("int"), "blocks": F.ceil(F.col("t") / F.lit(per_block)).cast("int")})
    plan = plan.withColumn("rest", F.col("quota") - F.col("whole") * F.col("t"))
    placed = rows.join(plan.select("name", "blocks"), "name").withColumn("block", F.pmod(_order("doc_id", "hash", "row"), F.col("blocks")).cast("int")).drop("blocks")
    totals = placed.groupBy("name", "block").agg(F.sum("n_tokens").alias("tokens"))
    epochs = totals.join(plan.drop("t", "quota", "blocks"), "name").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole"))))
    by = W.partitionBy("name", "epoch").orderBy(_order("epoch", "name", "block"), "block")
    epochs = epochs.withColumns({"slot": F.row_number().over(by) - 1, "before": F.coalesce(F.sum("tokens").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))})
    # tokens that an epoch may take of a block: all, or in the last epoch what is left of the quota
    left = F.when(F.col("epoch") < F.col("whole"), F.col("tokens")).otherwise(F.least(F.col("tokens"), F.col("rest") - F.col("before")))
    epochs = epochs.withColumn("left", left).where((F.col("left") > 0) | ((F.col("epoch") < F.col("whole")) & (F.col("left") == 0)))
    draws = placed.join(epochs.select("name", "block", "epoch", "slot", "left", "weight"), ["name", "block"])
    within = W.partitionBy("name", "block", "epoch").orderBy(_order("epoch", "doc_id", "hash", "row"), "doc_id", "hash", "row")
    draws = draws.withColumns({"place": F.row_number().over(within) - 1, "used": F.sum("n_tokens").over(within.rowsBetween(W.unboundedPreceding, 0))}).where("used <= left")
    return draws.select("doc_id", "source", "n_tokens", "weight", "epoch", "slot", "place")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture's draws; every document is drawn once at least, and those of small sources more often."""
    return mixed(docs)
