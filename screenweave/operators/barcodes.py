"""Reads against codebooks: round mapping, projection, matching, accuracy, entropy, composition, search over configurations."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenweave.functions.expressions import characters, entropy, mismatches, project_positions
from screenweave.operators.stats import regression


@dataclass(frozen=True)
class Failures:
    """Failed rounds of a well: left out on both sides, left out of the read only, and an offset between both."""

    dropout: tuple[int, ...] = ()
    shift: tuple[int, ...] = ()
    offset: int = 0


@dataclass(frozen=True)
class Mapping:
    """Places of the read and of the code that belong together."""

    read: tuple[int, ...] = field(default=())
    code: tuple[int, ...] = field(default=())


def failures(spec: list | dict | None) -> Failures:
    """From a list of rounds (dropouts), a list of {round, mode}, or {dropout, shift, offset}."""
    if not spec:
        return Failures()
    if isinstance(spec, dict):
        return Failures(tuple(spec.get("dropout") or ()), tuple(spec.get("shift") or ()), int(spec.get("offset") or 0))
    by: dict[str, list[int]] = {"dropout": [], "shift": []}
    for x in spec:
        by[x.get("mode", "dropout") if isinstance(x, dict) else "dropout"].append(int(x["round"] if isinstance(x, dict) else x))
    return Failures(tuple(by["dropout"]), tuple(by["shift"]))


def mapping(rounds: list[int], spec: list | dict | None, code_length: int) -> Mapping:
    """Places for the rounds under a well's failures.

    An offset pairs read place i with code place i - offset. A shifted round has no base in the read's string, so later
    read places move up while code places don't. A dropped round is skipped on both sides.
    """
    f = failures(spec)
    if f.offset and not f.shift:  # a well with both goes by its shifts
        pairs = [(r, r - f.offset) for r in rounds if 0 <= r - f.offset < code_length and r not in f.dropout]
    else:
        shift, pairs, place = set(f.shift), [], 0
        for r in rounds:
            if r in shift:
                continue
            at = place if shift else r
            place += 1
            if r not in f.dropout and r < code_length:
                pairs.append((at, r))
    return Mapping(tuple(a for a, _ in pairs), tuple(b for _, b in pairs))


def effective_rounds(rounds: list[int], spec: list | dict | None) -> list[int]:
    return [r for r in rounds if r not in failures(spec).dropout]


def matched(reads: DataFrame, codes: DataFrame, places: Mapping, read: str = "barcode", code: str = "sgRNA") -> DataFrame:
    """Reads with a flag whether the projected read is among the projected codes. The code side is reduced to distinct keys first."""
    keys = codes.select(project_positions(F.col(code), list(places.code)).alias("_key")).dropna().distinct().withColumn("matched", F.lit(True))
    out = reads.withColumn("_key", project_positions(F.col(read), list(places.read))).join(keys, "_key", "left").drop("_key")
    return out.withColumn("matched", F.coalesce("matched", F.lit(False)))


def annotated(reads: DataFrame, codes: DataFrame, places: Mapping, read: str = "barcode", code: str = "sgRNA") -> DataFrame:
    """Inner join of reads and codes on their projections; codes that collide after projection fan out."""
    keyed = codes.withColumn("_key", project_positions(F.col(code), list(places.code)))
    return reads.where(F.col(read).isNotNull() & (F.col(read) != "0")).withColumn("_key", project_positions(F.col(read), list(places.read))).join(keyed, "_key").drop("_key")


def prefix_accuracy(reads: DataFrame, codes: DataFrame, length: int, read: str = "barcode", code: str = "sgRNA") -> DataFrame:
    """(length, accuracy): share of reads whose first k bases begin a code, for every k up to length. One join for all lengths."""
    ks = F.sequence(F.lit(1), F.lit(length))
    keys = codes.select(F.explode(ks).alias("length"), F.col(code).alias("_c")).select("length", F.expr("substring(_c, 1, length)").alias("_p")).distinct().withColumn("_hit", F.lit(1))
    rows = reads.dropna(subset=[read]).groupBy(F.col(read).alias("_c")).agg(F.count("*").alias("_w"))
    rows = rows.select(F.explode(ks).alias("length"), "_c", "_w").select("length", F.expr("substring(_c, 1, length)").alias("_p"), "_w").groupBy("length", "_p").agg(F.sum("_w").alias("_w"))
    return rows.join(keys, ["length", "_p"], "left").groupBy("length").agg((F.sum(F.when(F.col("_hit") == 1, F.col("_w")).otherwise(0)) / F.sum("_w")).alias("accuracy"))


def least_hamming(reads: DataFrame, codes: DataFrame, read: str = "barcode", code: str = "sgRNA", limit: int = 200_000) -> DataFrame:
    """Each distinct read with its least number of mismatches to any code and the rows that have it.

    A codebook is a stated query set; its distinct codes are sent to all tasks as one array, checked against `limit`.
    """
    own = codes.select(F.col(code).alias("c")).dropna().distinct()
    n = own.count()
    if n > limit:
        raise ValueError(f"{n} codes are more than {limit}")
    book = own.agg(F.sort_array(F.collect_list("c")).alias("_codes"))
    distinct = reads.dropna(subset=[read]).groupBy(read).agg(F.count("*").alias("rows")).crossJoin(F.broadcast(book))
    return distinct.select(read, "rows", F.array_min(F.transform("_codes", lambda c: mismatches(F.col(read), c))).alias("distance"))


def composition(reads: DataFrame, read: str = "barcode") -> DataFrame:
    """(round, base, n, share, dominant): counts by place and base, the share of round 0's total, and whether it is over 40 % of its round."""
    rows = reads.groupBy(read).agg(F.count("*").alias("_w")).select(F.posexplode(characters(F.col(read))).alias("round", "base"), "_w")
    counts = rows.groupBy("round", "base").agg(F.sum("_w").alias("n"))
    totals = counts.groupBy("round").agg(F.sum("n").alias("_total"))
    first = totals.where("round = 0").select(F.col("_total").alias("_first"))
    out = counts.join(totals, "round").crossJoin(F.broadcast(first))
    return out.select("round", "base", "n", (F.col("n") / F.col("_first")).alias("share"), (F.col("n") / F.col("_total") > 0.4).alias("dominant"))


def uniqueness(codes: DataFrame, places: Mapping, code: str = "sgRNA") -> DataFrame:
    return codes.agg(F.countDistinct(project_positions(F.col(code), list(places.code))).alias("unique_codes"), F.count("*").alias("codes"))


def entropy_bias(reads: DataFrame, read: str = "barcode") -> DataFrame:
    """Regression of a barcode's count on its entropy."""
    by = reads.dropna(subset=[read]).groupBy(read).agg(F.count("*").alias("n")).withColumn("h", entropy(F.col(read)))
    return regression(by, "h", "n")


def search(reads: DataFrame, codes: DataFrame, configs: dict[str, Mapping], read: str = "barcode", code: str = "sgRNA") -> DataFrame:
    """(config, rate, unique_codes) of all configurations, best first. Reads are reduced to distinct strings before they meet the configurations."""
    own = reads.dropna(subset=[read]).groupBy(F.col(read).alias("_r")).agg(F.count("*").alias("_w"))
    side = lambda col, which: F.explode(F.array(*[F.struct(F.lit(k).alias("config"), project_positions(col, list(getattr(m, which))).alias("key")) for k, m in configs.items()])).alias("x")
    keys = codes.select(side(F.col(code), "code")).select("x.config", "x.key").dropna().distinct().withColumn("_hit", F.lit(1))
    rows = own.select(side(F.col("_r"), "read"), "_w").select("x.config", "x.key", "_w").groupBy("config", "key").agg(F.sum("_w").alias("_w"))
    rate = rows.join(keys, ["config", "key"], "left").groupBy("config").agg((F.sum(F.when(F.col("_hit") == 1, F.col("_w")).otherwise(0)) / F.sum("_w")).alias("rate"))
    return rate.join(keys.groupBy("config").agg(F.count("*").alias("unique_codes")), "config", "left").orderBy(F.desc("rate"), "config")


def improvement_needed(level: Column) -> Column:
    """Points by which a configuration of a complexity level has to beat the best one of the level before: over 1, 5, 10."""
    return F.when(level <= 1, 1.0).when(level == 2, 5.0).otherwise(10.0)


def spiked_out(codes: DataFrame, ratio: str = "ratio") -> DataFrame:
    """Codes without spike-ins: those at the least ratio."""
    least = codes.agg(F.min(ratio).alias("_least"))
    return codes.crossJoin(F.broadcast(least)).where(~(F.col(ratio) > F.col("_least"))).drop("_least")


def near_codes(reads: DataFrame, codes: DataFrame, most: int, read: str = "barcode", code: str = "sgRNA") -> DataFrame:
    """Each distinct read, its rows, the least number of mismatches to a code of its length (null over `most`), and how many codes have it.

    A codebook of any size: of `most` + 1 segments of a read that has no more mismatches one is the code's at its place, so
    reads and codes meet by (length, segment, its bases) and only these pairs are compared. Each pair counts at its first
    common segment.
    """
    parts = most + 1
    begin = lambda k, n: F.floor(n * k / parts)

    def cut(text: Column) -> Column:
        n = F.length(text)
        return F.transform(F.sequence(F.lit(0), F.lit(most)), lambda k: F.substring(text, (begin(k, n) + 1).cast("int"), (begin(k + 1, n) - begin(k, n)).cast("int")))

    own = reads.dropna(subset=[read]).groupBy(F.col(read).alias("_read")).agg(F.count("*").alias("rows"))
    book = codes.select(F.col(code).alias("_code")).dropna().distinct()
    left = own.select("_read", F.length("_read").alias("_len"), cut(F.col("_read")).alias("_all")).select("_read", "_len", "_all", F.posexplode("_all").alias("_at", "_part"))
    right = book.select("_code", F.length("_code").alias("_len"), cut(F.col("_code")).alias("_other")).select("_code", "_len", "_other", F.posexplode("_other").alias("_at", "_part"))
    first = F.array_position(F.zip_with("_all", "_other", lambda a, b: a == b), True) == F.col("_at") + 1
    pairs = left.join(right, ["_len", "_at", "_part"]).where(first).select("_read", mismatches(F.col("_read"), F.col("_code")).alias("distance")).where(F.col("distance") <= most)
    least = pairs.groupBy("_read").agg(F.min("distance").alias("distance"), F.count_if(F.col("distance") == 0).alias("_c0"), *[F.count_if(F.col("distance") == k).alias(f"_c{k}") for k in range(1, parts)])
    many = F.element_at(F.array(*[F.col(f"_c{k}") for k in range(parts)]), F.col("distance") + 1)
    return own.join(least, "_read", "left").select(F.col("_read").alias(read), "rows", "distance", F.coalesce(many, F.lit(0)).alias("codes"))
