"""Plate statistics, linking of reads, tracks and cells, and the reports over them.

Wells, cells, barcodes and genes are columns of the names given here. Every function is a plan of aggregates and
equi-joins: a well or a gene may hold any share of the rows. Shares of nothing are 0, as the screen's tables have them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenweave.functions.expressions import drift, entropy, signal_metrics
from screenweave.operators.stats import corr, correlation_p, low_entropy_bias, regression

Keys = list[str]


def _half(column: str) -> Column:
    return F.percentile(column, F.lit(0.5))


def _share(part: Column, all_: Column, places: int = 1) -> Column:
    """Percentage, 0 of nothing."""
    return F.coalesce(F.round(100.0 * part / F.nullif(all_, F.lit(0)), places), F.lit(0.0))


def _joined(parts: list[DataFrame], keys: Keys, base: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.join(b, keys, "left"), parts, base)


# Plate statistics


def well_statistics(reads: DataFrame, codebook: DataFrame, cells: DataFrame, spots: DataFrame | None = None, extras: tuple[DataFrame, ...] = ()) -> DataFrame:
    """One row for each well of `cells` (well, num_cells).

    reads: well, cell, barcode; codebook: barcode, gene (the first of a barcode's genes counts; a null gene is a control);
    spots: well, num_spots. A read matches if its barcode is in the codebook; cells have positive numbers. `extras` are
    further tables with a row for each well, joined as they are.
    """
    codes = codebook.groupBy("barcode").agg(F.min("gene").alias("gene"), F.lit(True).alias("_hit"))
    rows = reads.join(codes, "barcode", "left").withColumn("hit", F.col("_hit").isNotNull())
    return coded_statistics(rows, code_counts(rows), codebook.agg(F.count("*").alias("num_codes")), cells, spots, extras)


def code_counts(rows: DataFrame) -> DataFrame:
    """(well, barcode, count) of the rows (well, barcode, hit) that match."""
    return rows.where("hit").groupBy("well", "barcode").agg(F.count("*").alias("count"))


def coded_statistics(rows: DataFrame, by_code: DataFrame, n_codes: DataFrame, cells: DataFrame, spots: DataFrame | None = None, extras: tuple[DataFrame, ...] = ()) -> DataFrame:
    """`well_statistics` of reads that know their code: rows: well, cell, barcode, gene, hit; by_code: their `code_counts`; n_codes: one row, num_codes. Barcodes may be numbers, which are faster than texts."""
    hit, code = F.col("hit"), F.when(F.col("hit"), F.col("barcode"))
    by_cell = rows.groupBy("well", "cell").agg(F.count_if(hit).alias("_hits"), F.min(code).alias("_lo"), F.max(code).alias("_hi"), F.count("*").alias("_n"))
    real = F.col("cell") > 0
    # a group of exactly two matched rows with two barcodes
    cell_stats = by_cell.groupBy("well").agg(F.count_if(real).alias("cells_with_reads"), F.count_if(real & (F.col("_hits") > 0)).alias("cells_with_matched_reads"), F.count_if((F.col("_hits") == 2) & (F.col("_lo") != F.col("_hi"))).alias("_doublets"), F.sum("_n").alias("num_reads"), F.sum("_hits").alias("num_reads_matched"))
    code_stats = by_code.groupBy("well").agg(F.count("*").alias("num_unique_reads"), F.avg("count").alias("_coverage"), F.sum("count").alias("_sum"))
    by_gene = rows.where(hit & F.col("gene").isNotNull()).select("well", "gene", "cell").distinct().groupBy("well", "gene").agg(F.count("cell").alias("_c"))
    gene_stats = by_gene.groupBy("well").agg(F.round(F.avg("_c"), 2).alias("iss_mean_cells_per_gene"), F.round(_half("_c"), 2).alias("iss_median_cells_per_gene"), F.max("_c").alias("iss_max_cells_per_gene"), F.min("_c").alias("iss_min_cells_per_gene"))
    out = _joined([cell_stats, code_stats, gene_stats, *([spots] if spots is not None else [])], ["well"], cells).crossJoin(F.broadcast(n_codes))
    counts = ["cells_with_reads", "cells_with_matched_reads", "num_reads", "num_reads_matched", "num_unique_reads", "iss_max_cells_per_gene", "iss_min_cells_per_gene", *(["num_spots"] if spots is not None else [])]
    out = out.fillna(0, subset=[*counts, "_doublets", "_sum", "_coverage", "iss_mean_cells_per_gene", "iss_median_cells_per_gene"])
    c = F.col
    out = out.withColumns({
        "percent_cells_with_reads": _share(c("cells_with_reads"), c("num_cells")),
        "percent_cells_with_matched_reads": _share(c("cells_with_matched_reads"), c("num_cells")),
        "percent_matched_cells_of_cells_with_reads": _share(c("cells_with_matched_reads"), c("cells_with_reads")),
        "avg_guide_coverage": F.bround("_coverage", 0),
        "avg_guide_coverage_inc_dropouts": F.coalesce(F.bround(c("_sum") / F.nullif(c("num_codes"), F.lit(0)), 0), F.lit(0.0)),
        "percent_codes_found": _share(c("num_unique_reads"), c("num_codes"), 3),
        "percent_reads_matched": _share(c("num_reads_matched"), c("num_reads")),
        "fraction_doublets": F.coalesce(F.round(c("_doublets") / F.nullif(c("num_cells"), F.lit(0)), 3), F.lit(0.0)),
    })
    return _joined(list(extras), ["well"], out.drop("_doublets", "_coverage", "_sum"))


def _counted(matched: DataFrame, keys: Keys, barcode: str, count: str | None) -> DataFrame:
    rows = matched.dropna(subset=[barcode])
    return rows.select(*keys, barcode, F.col(count).alias("_n")) if count else rows.groupBy(*keys, barcode).agg(F.count("*").alias("_n"))


def entropy_stats(matched: DataFrame, keys: Keys, barcode: str = "barcode", count: str | None = None, texts: DataFrame | None = None) -> DataFrame:
    """By key: regression of a barcode's count on its entropy (slope, r2, p_value), the largest count over the median one, mean entropy, unique barcodes. Keys of fewer than three barcodes are left out.

    count: a column with the rows of a key and barcode, which are then one row. texts (barcode, text): what barcodes that are
    numbers stand for; a text's entropy is then worked out once, not for each key.
    """
    n = _counted(matched, keys, barcode, count)
    n = n.withColumn("_h", entropy(F.col(barcode))) if texts is None else n.join(texts.select(F.col("barcode").alias(barcode), entropy(F.col("text")).alias("_h")), barcode)
    n = n.withColumns({"_n": F.col("_n").cast("double")})
    aggs = [F.count("*").alias("unique_barcodes"), F.regr_slope("_n", "_h").alias("_slope"), corr("_n", "_h").alias("_r"), F.max("_n").alias("_top"), _half("_n").alias("_median"), F.avg("_h").alias("_mean")]
    s = n.groupBy(*keys).agg(*aggs).where("unique_barcodes >= 3")
    return s.select(
        *keys, F.round("_slope", 2).alias("entropy_slope"), F.round(F.col("_r") ** 2, 4).alias("entropy_r2"), correlation_p(F.col("_r"), F.col("unique_barcodes")).alias("entropy_pvalue"),
        F.round(F.col("_top") / F.greatest(F.col("_median"), F.lit(1.0)), 2).alias("top_guide_ratio"), F.round("_mean", 4).alias("mean_entropy"), "unique_barcodes",
    )


def reference_stats(matched: DataFrame, reference: DataFrame, keys: Keys, barcode: str = "barcode", least: int = 50, count: str | None = None) -> DataFrame:
    """By key: correlation of log2 frequencies with a reference (barcode, median_freq), 0 under `least` common barcodes; the number and the share in percent of the reference's barcodes that are common. count: as in `entropy_stats`."""
    n = _counted(matched, keys, barcode, count).withColumnRenamed(barcode, "_b")
    totals = n.groupBy(*keys).agg(F.sum("_n").alias("_all"))
    own = n.join(totals, keys) if keys else n.crossJoin(F.broadcast(totals))
    ref = reference.groupBy(F.col("barcode").alias("_b")).agg(F.sum("median_freq").alias("_f"))
    size = reference.agg(F.count("*").alias("_size"))
    log = lambda c: F.log2(c + 1e-9)
    both = own.join(ref, "_b", "left").groupBy(*keys).agg(F.count("_f").alias("common_barcodes"), corr(F.when(F.col("_f").isNotNull(), log(F.col("_n") / F.col("_all"))), log(F.col("_f"))).alias("_r"))
    return both.crossJoin(F.broadcast(size)).select(
        *keys, F.when(F.col("common_barcodes") < least, 0.0).otherwise(F.round("_r", 4)).alias("correlation_to_ref"), "common_barcodes", _share(F.col("common_barcodes"), F.col("_size"), 2).alias("pct_common_with_ref"),
    )


def quality_stats(matched: DataFrame, reference: DataFrame, keys: Keys, barcode: str = "barcode") -> DataFrame:
    """Entropy and reference statistics side by side: a row for each key that has matched reads."""
    a, b = entropy_stats(matched, keys, barcode), reference_stats(matched, reference, keys, barcode)
    return b.join(a, keys, "left") if keys else b.crossJoin(F.broadcast(a))


def growth_effect(df: DataFrame, keys: Keys, effect: str, count: str, edges: int = 10, highest: float = 0.5) -> DataFrame:
    """By key: medians of `count` in `edges` - 1 right-closed bins between the effect's extremes (the lowest value itself is in none), regressed on the bins' centres up to `highest`: slope, r2 and the fold change over the line. All 0 with fewer than two bins."""
    x = F.col(effect).cast("double")
    rows = df.where(x.isNotNull()).select(*keys, x.alias("_x"), F.col(count).cast("double").alias("_y"))
    ends = rows.groupBy(*keys).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    both = rows.join(ends, keys) if keys else rows.crossJoin(F.broadcast(ends))
    width = F.nullif((F.col("_hi") - F.col("_lo")) / (edges - 1), F.lit(0.0))
    bin_ = F.least(F.lit(edges - 2), F.ceil((F.col("_x") - F.col("_lo")) / width) - 1)
    placed = both.where("_x > _lo").withColumns({"_bin": bin_, "_c": F.col("_lo") + (bin_ + 0.5) * width})
    medians = placed.groupBy(*keys, "_bin").agg(F.first("_c").alias("_c"), _half("_y").alias("_m")).where(F.col("_c") <= highest)
    fit = medians.groupBy(*keys).agg(F.count("*").alias("_n"), F.regr_slope("_m", "_c").alias("_s"), F.regr_intercept("_m", "_c").alias("_i"), F.regr_r2("_m", "_c").alias("_r2"), F.min("_c").alias("_a"), F.max("_c").alias("_b"))
    out = ends.join(fit, keys, "left") if keys else ends.crossJoin(F.broadcast(fit))
    line = lambda at: F.col("_i") + F.col("_s") * F.col(at)
    two = F.coalesce(F.col("_n") > 1, F.lit(False))
    value = lambda v, places: F.coalesce(F.round(F.when(two, v), places), F.lit(0.0))
    return out.select(*keys, value(F.col("_s"), 1).alias("growth_effect_slope"), value(F.col("_r2"), 2).alias("growth_effect_r2"), value(line("_b") / F.nullif(line("_a"), F.lit(0.0)), 2).alias("growth_effect_fold_change"))


def gene_cells(linked: DataFrame, keys: Keys, gene: str) -> DataFrame:
    """By key, over linked cells with a gene: their number, the genes, and mean and median cells of a gene."""
    n = linked.dropna(subset=[gene]).groupBy(*keys, gene).agg(F.count("*").alias("_n"))
    return n.groupBy(*keys).agg(F.sum("_n").alias("post_track_total_tracked_cells"), F.count("*").alias("post_track_genes_detected"), F.round(F.avg("_n"), 2).alias("post_track_mean_cells_per_gene"), F.round(_half("_n"), 2).alias("post_track_median_cells_per_gene"))


def track_doublets(linked: DataFrame, keys: Keys, cell: str, barcode: str) -> DataFrame:
    """By key: cells that several tracks link to, their share, and how many of them agree on their valid barcode (neither null, `0` nor blank)."""
    b = F.col(barcode).cast("string")
    valid = F.when((b != "0") & (F.trim(b) != ""), b)
    per = linked.dropna(subset=[cell]).groupBy(*keys, cell).agg(F.count("*").alias("_n"), F.min(valid).alias("_lo"), F.max(valid).alias("_hi"))
    many = F.col("_n") > 1
    out = per.groupBy(*keys).agg(F.count("*").alias("total_unique_cells"), F.count_if(many).alias("doublet_count"), F.count_if(many & F.col("_lo").isNotNull()).alias("divisions_with_barcodes"), F.count_if(many & (F.col("_lo") == F.col("_hi"))).alias("matching_barcode_pairs"))
    return out.withColumns({"doublet_pct": _share(F.col("doublet_count"), F.col("total_unique_cells"), 2), "pct_matching": _share(F.col("matching_barcode_pairs"), F.col("divisions_with_barcodes"), 2)})


# Signal and noise


def signal_table(stats: DataFrame, keys: Keys) -> DataFrame:
    """Signal and background rows (kind: Signal or Background; mean, std, median_top) of a key side by side, with snr, sbr, lld and z_prime. Keys that lack a kind are left out."""
    pick = lambda k, c: F.max(F.when(F.col("kind") == k, F.col(c)))
    wide = stats.groupBy(*keys).agg(pick("Signal", "mean").alias("signal_mean"), pick("Signal", "std").alias("signal_std"), pick("Signal", "median_top").alias("median_top"), pick("Background", "mean").alias("background_mean"), pick("Background", "std").alias("background_std"))
    m = signal_metrics(F.col("signal_mean"), F.col("background_mean"), F.col("signal_std"), F.col("background_std"))
    return wide.where("signal_mean IS NOT NULL AND background_mean IS NOT NULL").withColumn("_m", m).select(*wide.columns, "_m.*")


def signal_summary(table: DataFrame, keys: Keys, cycle: str = "cycle", middle: str = "mean") -> DataFrame:
    """By key: means (or medians, for bimodal tables) of a signal table's metrics, and the slopes of the cycles' mean snr and sbr, 0 for one cycle."""
    of = {"mean": F.avg, "median": _half}[middle]
    names = {"snr": 1, "sbr": 1, "lld": 3, "z_prime": 3, "signal_mean": 1, "median_top": 1, "background_mean": 1, "background_std": 1}
    # one reading of the table: a cycle's mean snr and sbr stand in its first row
    w = W.partitionBy(*keys, cycle)
    first = F.row_number().over(w.orderBy(cycle)) == 1
    rows = (table.dropna(subset=keys) if keys else table).withColumns({f"_{c}": F.when(first, F.avg(c).over(w)) for c in ("snr", "sbr")})
    slopes = [F.coalesce(F.round(F.regr_slope(f"_{c}", cycle), 2), F.lit(0.0)).alias(f"{c}_slope") for c in ("snr", "sbr")]
    return rows.groupBy(*keys).agg(*[F.round(of(c), p).alias(f"{middle}_{c}") for c, p in names.items()], *slopes)


def channel_summary(table: DataFrame, channel: str = "channel", channels: tuple[str, ...] = ()) -> DataFrame:
    """Means of a signal table's metrics by channel; channels of the list that have no rows are 0 throughout."""
    names = {"snr": 2, "sbr": 2, "lld": 3, "z_prime": 3, "signal_mean": 1, "median_top": 1, "background_mean": 1, "background_std": 1}
    out = table.groupBy(channel).agg(*[F.round(F.avg(c), p).alias(c) for c, p in names.items()])
    if not channels:
        return out
    all_ = table.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in channels])).alias(channel))
    return all_.join(out, channel, "left").fillna(0.0, subset=list(names))


# Reference and optimiser reports


def reference_distribution(frequencies: DataFrame, ranking: DataFrame, top: int = 10) -> DataFrame:
    """(barcode, median_freq): median frequency over the `top` experiments of a ranking (experiment, correlation) among those of frequencies (experiment, barcode, freq)."""
    best = ranking.orderBy(F.desc("correlation"), "experiment").limit(top).select("experiment")
    return frequencies.join(best, "experiment", "left_semi").groupBy("barcode").agg(_half("freq").alias("median_freq"))


def match_validation(matched: DataFrame, codebook: DataFrame, keys: Keys, total_guides: int, control: str = "-1") -> DataFrame:
    """By key, the report on matched reads (barcode) against a codebook (barcode, gene): is there a bias that tells false matches?

    Barcodes and genes found, gene coverage, the five largest genes' share, mean and read-weighted entropy, the largest
    barcode with its entropy and count, slope and p of count on entropy, the largest gene and the five largest guides
    over the median, and whether all checks pass: no entropy slope bias, no low-entropy barcode (under 1 bit) with over
    15 % of more than 500 reads, and no more than 5 % of more than 1,000 reads in low-entropy barcodes.
    """
    genes = codebook.groupBy("barcode").agg(F.max(F.col("gene").cast("string")).alias("_gene"))
    n = matched.dropna(subset=["barcode"]).groupBy(*keys, "barcode").agg(F.count("*").alias("_n")).withColumn("_h", entropy(F.col("barcode")))
    c = F.col
    rank = W.partitionBy(*keys).orderBy(F.desc("_n"), "barcode")
    # five rows a key; a window over distinct barcodes, not over reads
    top = n.withColumn("_k", F.row_number().over(rank)).where("_k <= 5").groupBy(*keys).agg(F.max(F.when(c("_k") == 1, c("barcode"))).alias("top_barcode"), F.sum("_n").alias("_top5"))
    own = n.groupBy(*keys).agg(
        F.count("*").alias("unique_barcodes"), F.sum("_n").alias("reads"), F.avg("_h").alias("avg_entropy"), (F.sum(c("_n") * c("_h")) / F.sum("_n")).alias("weighted_entropy"), F.max("_n").alias("top_barcode_count"),
        _half("_n").alias("_median"), F.regr_slope(c("_n").cast("double"), c("_h")).alias("entropy_slope"), corr(c("_n").cast("double"), c("_h")).alias("_r"), F.coalesce(F.sum(F.when(c("_h") < 1.0, c("_n"))), F.lit(0)).alias("_low"),
    )
    g = n.join(genes, "barcode").where(c("_gene") != control).groupBy(*keys, "_gene").agg(F.sum("_n").alias("_n"))
    g5 = g.withColumn("_k", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("_n"), "_gene")))
    by_gene = g5.groupBy(*keys).agg(F.count("*").alias("unique_genes"), F.sum("_n").alias("_greads"), F.sum(F.when(c("_k") <= 5, c("_n"))).alias("_g5"), F.max("_n").alias("_gtop"), _half("_n").alias("_gmedian"))
    out = _joined([top, by_gene], keys, own) if keys else own.crossJoin(F.broadcast(top)).crossJoin(F.broadcast(by_gene))
    out = out.fillna(0, subset=["unique_genes"]).withColumns({"top_barcode_entropy": entropy(c("top_barcode")), "entropy_pvalue": F.when(c("unique_barcodes") >= 10, correlation_p(c("_r"), c("unique_barcodes"))), "entropy_slope": F.when(c("unique_barcodes") >= 10, c("entropy_slope"))})
    biased = F.coalesce(low_entropy_bias(c("entropy_slope"), c("entropy_pvalue"), c("unique_barcodes")), F.lit(False))
    single = (c("reads") > 500) & (100.0 * c("top_barcode_count") / c("reads") > 15) & (c("top_barcode_entropy") < 1.0)
    low = (c("reads") > 1000) & (100.0 * c("_low") / c("reads") > 5)
    return out.select(
        *keys, "unique_barcodes", "unique_genes", (F.lit(100.0) * c("unique_genes") / total_guides if total_guides else F.lit(0.0)).alias("gene_coverage_pct"), _share(c("_g5"), c("_greads"), 6).alias("top5_concentration"),
        "avg_entropy", "weighted_entropy", "top_barcode", "top_barcode_entropy", "top_barcode_count", F.coalesce("entropy_slope", F.lit(0.0)).alias("entropy_slope"), F.coalesce("entropy_pvalue", F.lit(1.0)).alias("entropy_pvalue"),
        F.when(c("unique_genes") > 1, c("_gtop") / F.greatest(c("_gmedian"), F.lit(1.0))).otherwise(0.0).alias("top_gene_vs_median"), F.when(c("unique_barcodes") >= 5, c("_top5") / F.greatest(c("_median"), F.lit(1.0))).otherwise(0.0).alias("top_guide_vs_median"),
        (~(biased | single | low)).alias("is_valid"),
    )


def best_configurations(results: DataFrame) -> DataFrame:
    """Of result rows (experiment, well, config, match_rate, is_valid, level): for each well the valid row with the best rate (ties: the lower level, then the name), the rate of the level 0 row, and the gain."""
    order = W.partitionBy("experiment", "well").orderBy(F.desc("match_rate"), "level", "config")
    best = results.where("is_valid").withColumn("_k", F.row_number().over(order)).where("_k = 1").select("experiment", "well", "config", F.col("match_rate").alias("best_rate"))
    base = results.where("level = 0").groupBy("experiment", "well").agg(F.max("match_rate").alias("baseline_rate"))
    return base.join(best, ["experiment", "well"], "full_outer").withColumn("gain", F.col("best_rate") - F.col("baseline_rate"))


# Linking


def linked(tracks: DataFrame, iss: DataFrame, pheno: DataFrame, genes: DataFrame, read_at: list[int], code_at: list[int]) -> DataFrame:
    """Tracks that both other modalities and the gene index know: tracks, iss (with barcode) and pheno by well and og_index, then genes by the barcode's projection.

    A barcode of null or `0` is none. Codes that are equal after projection give a row each.
    """
    from screenweave.functions.expressions import project_positions

    coded = genes.withColumn("_key", project_positions(F.col("barcode"), code_at)).drop("barcode")
    b = F.col("barcode").cast("string")
    read = F.when(b.isNull() | (b == "0"), "0").otherwise(project_positions(b, read_at))
    both = iss.join(pheno, ["well", "og_index"]).join(tracks, ["well", "og_index"]).withColumn("barcode", read)
    return both.join(coded, both["barcode"] == coded["_key"]).drop("_key")


def link_metrics(tracks: DataFrame, iss: DataFrame, pheno: DataFrame, final: DataFrame, segmentation: str = "segmentation_id") -> DataFrame:
    """By well, how many tracks each step of linking keeps: full length, linked, with barcode, in both modalities, with a gene, with a cell of their own, and with a box only."""
    by = lambda df, *aggs: df.groupBy("well").agg(*aggs)
    some = F.col("barcode").cast("string")
    both = iss.select("well", "og_index", F.lit(1).alias("_i")).join(pheno.select("well", "og_index", F.lit(1).alias("_p")), ["well", "og_index"], "full_outer")
    parts = [
        by(iss, F.count("*").alias("iss_linked"), F.count_if(some.isNotNull() & (some != "0")).alias("iss_linked_with_barcode")),
        by(pheno, F.count("*").alias("pheno_linked")),
        by(both, F.count_if(F.col("_p").isNull()).alias("iss_only"), F.count_if(F.col("_i").isNull()).alias("pheno_only"), F.count_if(F.col("_i").isNotNull() & F.col("_p").isNotNull()).alias("iss_pheno_matched")),
        by(final, F.count("*").alias("tracks_with_gene_matched"), F.count(segmentation).alias("valid_segmentation"), F.count_if(F.col(segmentation).isNull()).alias("fallback_bbox")),
    ]
    return _joined(parts, ["well"], by(tracks, F.count("*").alias("full_length_tracks"))).fillna(0)


def link_summary(metrics: DataFrame) -> DataFrame:
    """Sums of link_metrics over the wells."""
    names = {"full_length_tracks": "link_full_length_tracks", "iss_linked_with_barcode": "link_with_barcode", "tracks_with_gene_matched": "link_iss_pheno_matched", "fallback_bbox": "link_fallback_bbox"}
    return metrics.agg(*[F.sum(a).alias(b) for a, b in names.items()])


def composite_link(base: DataFrame, sides: dict[str, DataFrame], key: str, barcode: str = "barcode") -> DataFrame:
    """The base table with each side left-joined by the key, the side's columns suffixed by its name; the barcode is that of the base or else of the first side that has one."""
    out = base
    for name, side in sides.items():
        out = out.join(side.select(key, *[F.col(c).alias(f"{c}_{name}") for c in side.columns if c != key]), key, "left")
    options = [barcode, *[f"{barcode}_{name}" for name, side in sides.items() if barcode in side.columns]]
    return out.withColumn(barcode, F.coalesce(*[F.nullif(F.col(c).cast("string"), F.lit("0")) for c in options if c in out.columns]))


# Registration and reconstruction


def cycle_registration(rows: DataFrame, keys: Keys) -> DataFrame:
    """By key over the pairs of rounds (round_pair begins with `round`): mean and least inlier ratio, mean and largest residual, pairs."""
    r = rows.where(F.col("round_pair").startswith("round")).groupBy(*keys)
    return r.agg(F.round(F.avg("inlier_ratio"), 4).alias("mean_inlier_ratio"), F.round(F.min("inlier_ratio"), 4).alias("min_inlier_ratio"), F.round(F.avg("residual_mean"), 4).alias("mean_residual"), F.round(F.max("residual_max"), 4).alias("max_residual"), F.count("*").alias("n_rounds"))


def well_drift(moves: DataFrame, keys: Keys) -> DataFrame:
    """By key, of cumulative translations (round, dy, dx): mean and largest change of magnitude from round to round (the first against 0), the largest magnitude, rounds."""
    m = moves.withColumn("_m", drift(F.col("dy"), F.col("dx"))["magnitude"])
    step = m.withColumn("_d", F.round(F.abs(F.col("_m") - F.lag("_m", 1, 0.0).over(W.partitionBy(*keys).orderBy("round"))), 2))
    return step.groupBy(*keys).agg(F.round(F.avg("_d"), 2).alias("mean_per_round_drift"), F.round(F.max("_d"), 2).alias("max_per_round_drift"), F.round(F.max("_m"), 2).alias("cumulative_drift"), F.count("*").alias("n_rounds"))


def picked_metrics(rows: DataFrame, keys: Keys, wanted: dict[str, str], metric: str = "metric", value: str = "value") -> DataFrame:
    """By key, metrics of a long table as columns; 0 for one that is missing beside another. Keys with none of them are left out."""
    out = rows.where(F.col(metric).isin(list(wanted))).groupBy(*keys).pivot(metric, list(wanted)).agg(F.max(value))
    return out.select(*keys, *[F.coalesce(F.col(f"`{m}`"), F.lit(0.0)).alias(n) for m, n in wanted.items()])


def spread(rows: DataFrame, keys: Keys, values: dict[str, int]) -> DataFrame:
    """By key: mean, median, population deviation, least and largest of each value (rounded to so many places), and rows."""
    aggs = {"mean": F.avg, "median": _half, "std": F.stddev_pop, "min": F.min, "max": F.max}
    return rows.groupBy(*keys).agg(*[F.round(f(v), p).alias(f"{v}_{n}") for v, p in values.items() for n, f in aggs.items()], F.count("*").alias("n"))


def named_summary(rows: DataFrame, key: str, values: Keys) -> DataFrame:
    """By key: cells, and mean, median, sample deviation, min, max and sum of each value."""
    aggs = {"mean": F.avg, "median": _half, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum}
    return rows.groupBy(key).agg(F.count(values[0]).alias("n_cells"), *[f(v).alias(f"{v}_{n}") for v in values for n, f in aggs.items()])


def registration_passed(centroid: Column, mask: Column, good_centroid: float = 9.0, good_mask: float = 30.0, bad_mask: float = 15.0) -> Column:
    """Whether a registration is good: enough centroids or enough of the mask, and never under `bad_mask` of it. Without a mask the centroids decide."""
    m = F.coalesce(mask, F.lit(float("inf")))
    return F.when(m < bad_mask, False).otherwise(F.coalesce((centroid >= good_centroid) | (mask >= good_mask), centroid >= good_centroid, F.lit(False)))


# Reports over experiments


def match_rates(statistics: DataFrame, metric: str = "percent_reads_matched") -> DataFrame:
    """(experiment, well, match_rate) from long plate statistics (experiment, metric, well, value)."""
    return statistics.where(F.col("metric") == metric).select("experiment", "well", F.col("value").cast("double").alias("match_rate")).dropna(subset=["match_rate"])


def final_drift_against_matching(moves: DataFrame, rates: DataFrame) -> DataFrame:
    """(experiment, well, magnitude, match_rate): the last round's drift of each well that has a match rate."""
    last = moves.groupBy("experiment", "well").agg(F.max_by(F.struct("dy", "dx"), "round").alias("_l"))
    return last.select("experiment", "well", drift(F.col("_l.dy"), F.col("_l.dx"))["magnitude"].alias("magnitude")).join(rates, ["experiment", "well"])


def by_date(experiments: DataFrame, name: str = "experiment") -> DataFrame:
    """Experiments with the date of eight digits that ends their name (the greatest possible where there is none), in that order."""
    date = F.regexp_extract(F.col(name), r"(\d{8})$", 1)
    return experiments.withColumn("date", F.when(date == "", "99999999").otherwise(date)).orderBy("date", name)


def edge_shares(rows: DataFrame, keys: Keys, value: str, low: float, high: float) -> DataFrame:
    """By key: rows, mean, median, deviation, and the share in percent of values at or beyond either edge (an out-of-focus test)."""
    v = F.col(value)
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(v).alias("mean"), _half(value).alias("median"), F.stddev_samp(v).alias("std"), (100.0 * F.count_if(v <= low) / F.count("*")).alias("pct_low_edge"), (100.0 * F.count_if(v >= high) / F.count("*")).alias("pct_high_edge"))


def pooled_direction(partials: DataFrame, size: str = "n", vector: str = "mean") -> DataFrame:
    """(dim, direction): the count-weighted mean of experiments' control vectors, of the most common length only (ties: the longer), scaled to length 1."""
    sized = partials.withColumn("_len", F.size(vector))
    common = sized.groupBy("_len").agg(F.count("*").alias("_c")).orderBy(F.desc("_c"), F.desc("_len")).limit(1).select("_len")
    long = sized.join(F.broadcast(common), "_len", "left_semi").select(size, F.posexplode(vector).alias("dim", "_v"))
    mean = long.groupBy("dim").agg((F.sum(F.col("_v") * F.col(size)) / F.nullif(F.sum(size), F.lit(0))).alias("_m"))
    norm = mean.agg(F.sqrt(F.sum(F.col("_m") ** 2)).alias("_norm"))
    return mean.crossJoin(F.broadcast(norm)).select("dim", (F.col("_m") / F.nullif(F.col("_norm"), F.lit(0.0))).alias("direction"))


def merged_by_row(points: DataFrame, observations: DataFrame, row: str = "row") -> DataFrame:
    """An embedding joined to its observations by an explicit row number: rows that only one side has drop out of the points, and stay in the observations with null points."""
    return observations.join(points, row, "left")


def effect_against_growth(effects: DataFrame, growth: DataFrame, keys: Keys, marker: str) -> DataFrame:
    """By key, the regression of effect sizes (marker, effect) on growth rates (marker, growth) over common markers."""
    return regression(effects.join(growth, marker), "growth", "effect", keys)


# Links of tracks to reads, tiles and time points


def track_reads(tracks: DataFrame, matrix: list[list[float]], pixels: DataFrame, reads: DataFrame, order: str) -> DataFrame:
    """(well, og_index, y_iss, x_iss, barcode): tracks (well, og_index, y, x) moved by a matrix (y, x order), the label (well, y, x, label) under them, and the barcode of that cell's last read by `order`; `0` where there is no cell or no read."""
    from screenweave.functions.expressions import affine_point
    from screenweave.operators.spatial import label_at

    at = tracks.withColumn("_p", affine_point(matrix, F.col("y"), F.col("x"))).select("well", "og_index", F.col("_p.y").alias("y"), F.col("_p.x").alias("x"))
    cells = label_at(at, pixels, ["well"])
    last = reads.where(F.col("cell") != 0).groupBy("well", F.col("cell").alias("label")).agg(F.max_by("barcode", order).alias("barcode"))
    out = cells.join(last, ["well", "label"], "left")
    return out.select("well", "og_index", F.col("y").alias("y_iss"), F.col("x").alias("x_iss"), F.coalesce(F.col("barcode").cast("string"), F.lit("0")).alias("barcode"))


def track_tiles(points: DataFrame, matrix: list[list[float]], boxes: DataFrame, cell: float, name: str) -> DataFrame:
    """Points (well, og_index, y, x) moved by a matrix, with the first tile of boxes (well, tile, y0, x0, y1, x1) that holds them and the place in it: columns y_, x_, tile_, y_local_ and x_local_ with the name. Points outside of all tiles have null there."""
    from screenweave.functions.expressions import affine_point
    from screenweave.operators.spatial import first_box

    at = points.withColumn("_p", affine_point(matrix, F.col("y"), F.col("x"))).select("well", "og_index", F.col("_p.y").alias("y"), F.col("_p.x").alias("x"))
    found = first_box(at, boxes, ["well"], "og_index", "tile", cell).select("well", "og_index", F.col("tile").alias(f"tile_{name}"), (F.col("y") - F.col("y0")).alias(f"y_local_{name}"), (F.col("x") - F.col("x0")).alias(f"x_local_{name}"))
    return at.select("well", "og_index", F.col("y").alias(f"y_{name}"), F.col("x").alias(f"x_{name}")).join(found, ["well", "og_index"], "left")


def track_times(tracks: DataFrame, boxes: DataFrame, times: list[int], cell: float, name: str = "tracking") -> DataFrame:
    """One row for each track (well, og_index) with its tile and its place in the unturned tile at each time, from long rows (well, og_index, t, y, x). The stitched plane shows tiles turned by a quarter and mirrored, which together swap the axes."""
    from screenweave.operators.spatial import first_box

    found = first_box(tracks.withColumn("_id", F.struct("og_index", "t")), boxes, ["well"], "_id", "tile", cell)
    local = found.select("well", "og_index", "t", "tile", F.floor(F.col("x") - F.col("x0")).cast("int").alias("y_local"), F.floor(F.col("y") - F.col("y0")).cast("int").alias("x_local"))
    pick = [F.max(F.when(F.col("t") == t, F.col(c))).alias(f"{c}_{name}_t{t}") for t in times for c in ("tile", "y_local", "x_local")]
    return tracks.select("well", "og_index").distinct().join(local.groupBy("well", "og_index").agg(*pick), ["well", "og_index"], "left")


def over_time(stats: DataFrame, metrics: list[str], experiment: str = "experiment", well: str = "well") -> DataFrame:
    """(experiment, date, well, metric, value): plate statistics of all experiments, long; the date is the eight digits at the end of the experiment's name, null without. Null metrics are left out."""
    date = F.to_date(F.nullif(F.regexp_extract(experiment, r"_(\d{8})$", 1), F.lit("")), "yyyyMMdd")
    wide = stats.select(F.col(experiment).alias("experiment"), date.alias("date"), F.col(well).alias("well"), *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(["experiment", "date", "well"], metrics, "metric", "value").where("value IS NOT NULL")


def spiked(codebook: DataFrame, ratio: str = "ratio", barcode: str = "barcode") -> DataFrame:
    """(barcode): codes with a ratio above the codebook's least one: controls that are frequent by design. None without ratios."""
    least = codebook.agg(F.min(ratio).alias("_least"))
    return codebook.crossJoin(F.broadcast(least)).where(F.col(ratio) > F.col("_least")).select(F.col(barcode).alias("barcode")).distinct()


def validated(matched: DataFrame, codebook: DataFrame, keys: Keys, total_guides: int, spikes: DataFrame | None = None, reference: DataFrame | None = None, baseline: DataFrame | None = None, control: str = "-1") -> DataFrame:
    """By key, the whole report on matched reads (barcode) against a codebook (barcode, gene): 16 values.

    The columns of `match_validation`, with `correlation` and `notes`. Designed controls (`spikes`: barcode) count for barcodes, genes and
    thresholds, but are left out of all bias checks. Without a reference, a key is valid if none of these holds: a round whose
    bases have under 0.8 bits (over 500 reads), a barcode under 1 bit with over 15 % of more than 500 reads, over 5 % of more than
    1,000 reads in barcodes under 1 bit, an entropy slope bias. With one (barcode, median_freq), none of these: a correlation
    under the baseline's, a slope under -50 or negative with p < 0.05, a largest barcode over 10 times the median or over 1.2 times the
    baseline's ratio. baseline: keys, correlation, top_guide_vs_median; 0 or missing checks nothing. Keys without reads have no row.
    """
    c = F.col
    n_all = matched.dropna(subset=["barcode"]).groupBy(*keys, "barcode").agg(F.count("*").alias("_n"))
    marked = n_all.withColumn("_spike", F.lit(False)) if spikes is None else n_all.join(spikes.select("barcode").distinct().withColumn("_s", F.lit(True)), "barcode", "left").withColumn("_spike", c("_s").isNotNull()).drop("_s")
    total = marked.groupBy(*keys).agg(F.count("*").alias("unique_barcodes"), F.sum("_n").alias("reads"), F.coalesce(F.sum(F.when(c("_spike"), c("_n"))), F.lit(0)).alias("_excluded"), F.count_if("_spike").alias("_spikes"))
    genes = codebook.groupBy("barcode").agg(F.max(c("gene").cast("string")).alias("_gene"))
    g = n_all.join(genes, "barcode").where(c("_gene") != control).groupBy(*keys, "_gene").agg(F.sum("_n").alias("_n"))
    g5 = g.withColumn("_k", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("_n"), "_gene")))
    by_gene = g5.groupBy(*keys).agg(F.count("*").alias("unique_genes"), F.sum("_n").alias("_greads"), F.sum(F.when(c("_k") <= 5, c("_n"))).alias("_g5"), F.max("_n").alias("_gtop"), _half("_n").alias("_gmedian"))
    n = marked.where(~c("_spike")).drop("_spike").withColumn("_h", entropy(c("barcode")))
    top = n.withColumn("_k", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("_n"), "barcode"))).where("_k <= 5").groupBy(*keys).agg(F.max(F.when(c("_k") == 1, c("barcode"))).alias("top_barcode"), F.sum("_n").alias("_top5"))
    own = n.groupBy(*keys).agg(
        F.count("*").alias("_codes"), F.avg("_h").alias("avg_entropy"), (F.sum(c("_n") * c("_h")) / F.sum("_n")).alias("weighted_entropy"), F.max("_n").alias("top_barcode_count"), _half("_n").alias("_median"),
        F.regr_slope(c("_n").cast("double"), c("_h")).alias("_slope"), corr(c("_n").cast("double"), c("_h")).alias("_r"), F.coalesce(F.sum(F.when(c("_h") < 1.0, c("_n"))), F.lit(0)).alias("_low"),
    )
    # bases by round: sums over barcodes
    bases = n.select(*keys, "_n", F.posexplode(F.split("barcode", "")).alias("_round", "_base")).groupBy(*keys, "_round", "_base").agg(F.sum("_n").alias("_n"))
    sums = bases.groupBy(*keys, "_round").agg(F.sum("_n").alias("_all"))
    share = bases.join(sums, [*keys, "_round"]).withColumn("_p", c("_n") / c("_all"))
    rounds = share.groupBy(*keys, "_round").agg(F.sum(-c("_p") * F.log2(c("_p") + 1e-9)).alias("_bits"))
    collapse = rounds.where("_bits < 0.8").groupBy(*keys).agg(F.min("_round").alias("_collapsed"))
    parts = [by_gene, top, own, collapse]
    if reference is not None:
        parts.append(reference_stats(matched, reference, keys).select(*keys, c("correlation_to_ref").alias("correlation")))
    if baseline is not None:
        parts.append(baseline.select(*keys, c("correlation").alias("_base_r"), c("top_guide_vs_median").alias("_base_ratio")))
    out = _joined(parts, keys, total)
    for name in ("correlation", "_base_r", "_base_ratio"):
        if name not in out.columns:
            out = out.withColumn(name, F.lit(0.0))
    zero = lambda name: F.coalesce(c(name), F.lit(0.0))
    enough = c("_codes") >= 10
    out = out.fillna(0, subset=["unique_genes", "top_barcode_count", "_codes"]).withColumns({
        "top_barcode": F.coalesce("top_barcode", F.lit("")), "top_barcode_entropy": F.coalesce(entropy(c("top_barcode")), F.lit(0.0)), "avg_entropy": zero("avg_entropy"), "weighted_entropy": zero("weighted_entropy"), "correlation": zero("correlation"),
        "entropy_slope": F.when(enough, zero("_slope")).otherwise(0.0), "entropy_pvalue": F.when(enough, F.coalesce(correlation_p(c("_r"), c("_codes")), F.lit(1.0))).otherwise(1.0), "_ratio": F.coalesce(c("top_barcode_count") / F.greatest(c("_median"), F.lit(1.0)), F.lit(0.0)),
    })
    slope, p = c("entropy_slope"), c("entropy_pvalue")
    if reference is None:
        checks = [
            ("round of low entropy", (c("reads") > 500) & c("_collapsed").isNotNull()),
            ("low-entropy barcode dominates", (c("reads") > 500) & (100.0 * c("top_barcode_count") / c("reads") > 15) & (c("top_barcode_entropy") < 1.0)),
            ("low-entropy barcodes", (c("reads") > 1000) & (100.0 * c("_low") / c("reads") > 5)),
            ("entropy bias", F.coalesce(low_entropy_bias(slope, p, c("_codes")), F.lit(False))),
        ]
    else:
        checks = [
            ("correlation below baseline", (zero("_base_r") > 0) & (c("correlation") < c("_base_r"))), ("extreme entropy bias", slope < -50), ("entropy bias", (slope >= -50) & (slope < 0) & (p < 0.05)),
            ("largest barcode over 10 times the median", c("_ratio") > 10), ("largest barcode over the baseline", (c("_ratio") <= 10) & (zero("_base_ratio") > 0) & (c("_ratio") > 1.2 * c("_base_ratio"))),
        ]
    distinct = codebook.agg(F.countDistinct("barcode").alias("_distinct"))
    out = out.crossJoin(F.broadcast(distinct))
    told = [F.when(c("_distinct") < total_guides, F.format_string("codebook collisions: %.1f %%", F.round(100.0 * (total_guides - c("_distinct")) / max(total_guides, 1), 1))), F.when(c("_excluded") > 0, F.format_string("left out: %d reads of %d spike-ins", c("_excluded"), c("_spikes")))]
    told += [F.when(F.coalesce(bad, F.lit(False)), name) for name, bad in checks]
    valid = F.lit(True)
    for _, bad in checks:
        valid = valid & ~F.coalesce(bad, F.lit(False))
    return out.select(
        *keys, "unique_barcodes", "unique_genes", (F.lit(100.0) * c("unique_genes") / total_guides if total_guides else F.lit(0.0)).alias("gene_coverage_pct"), _share(c("_g5"), c("_greads"), 6).alias("top5_concentration"),
        "avg_entropy", "weighted_entropy", "top_barcode", "top_barcode_entropy", "top_barcode_count", "correlation", "entropy_slope", "entropy_pvalue",
        F.when(c("unique_genes") > 1, c("_gtop") / F.greatest(c("_gmedian"), F.lit(1.0))).otherwise(0.0).alias("top_gene_vs_median"), F.when(c("_codes") >= 5, c("_top5") / F.greatest(c("_median"), F.lit(1.0))).otherwise(0.0).alias("top_guide_vs_median"),
        valid.alias("is_valid"), F.array_join(F.array_compact(F.array(*told)), "; ").alias("notes"),
    )


# Cell sizes

#: Pixels of either side from which a cell is large.
LARGE = 300


def cell_sizes(linked: DataFrame, box: str = "bbox", keep: Keys = (), large: float = LARGE) -> DataFrame:
    """Linked cells with bbox_height, bbox_width, bbox_area, bbox_aspect_ratio and is_large, from the text of their bounding box; cells without four numbers are left out."""
    from screenweave.functions.expressions import box_shape, numbers

    # a generator, so that a text is read once: a filter on the box, and each of its sides, would read it again
    sides = F.struct(*[F.element_at("_p", k + 1).cast("int").alias(n) for k, n in enumerate(("min_row", "min_col", "max_row", "max_col"))])
    boxes = linked.select(*keep, numbers(F.col(box)).alias("_p")).select(*keep, F.explode(F.when(F.size("_p") == 4, F.array(sides))).alias("_b"))
    rows = boxes.withColumn("_s", box_shape(F.col("_b"), large))
    return rows.select(*keep, F.col("_s.height").alias("bbox_height"), F.col("_s.width").alias("bbox_width"), F.col("_s.area").cast("long").alias("bbox_area"), F.col("_s.aspect").alias("bbox_aspect_ratio"), F.col("_s.is_large").alias("is_large"))


def cell_size_summary(cells: DataFrame, well: str = "well", pooled: bool = True) -> DataFrame:
    """By well, and pooled as `ALL`: the number of cells, mean, median, least, largest and deviation of each shape, and the number and share in percent of large cells."""
    from screenweave.operators.keyed import with_pooled

    aggs = [F.count("*").alias("cell_count")]
    for c in ("bbox_height", "bbox_width", "bbox_area", "bbox_aspect_ratio"):
        v = F.col(c).cast("double")
        aggs += [F.avg(v).alias(f"{c}_mean"), F.percentile(v, F.lit(0.5)).alias(f"{c}_median"), F.min(v).alias(f"{c}_min"), F.max(v).alias(f"{c}_max"), F.stddev_samp(v).alias(f"{c}_std")]
    aggs += [F.count_if("is_large").alias("large_cell_count"), (100.0 * F.count_if("is_large") / F.count("*")).alias("large_cell_pct")]
    return with_pooled(cells, well, aggs) if pooled else cells.groupBy(well).agg(*aggs)


def report(base: DataFrame, parts: list[DataFrame], key: str = "well") -> DataFrame:
    """One row for each well with all parts' columns side by side: the plate's whole statistics."""
    return _joined(parts, [key], base)


def slope_bias(slope: Column, p: Column) -> Column:
    """`strong negative` (slope under -50), `negative`, `positive` (over 50) or `weak` with p < 0.05, else `none`; null without p. NaN counts as larger than any number."""
    clear = p < 0.05
    return F.when(clear & (slope < -50), "strong negative").when(clear & (slope < 0), "negative").when(clear & (slope > 50), "positive").when(clear, "weak").when(p.isNotNull(), "none")


def entropy_report(matched: DataFrame, codebook: DataFrame, keys: Keys, spikes: DataFrame | None = None, control: str = "-1", least: int = 3) -> DataFrame:
    """By key, how a barcode's count depends on its entropy, designed controls (`spikes`) left out: reads, barcodes, slope, r2, p_value, bias, the largest barcode and gene (ties: the first by name) with their counts over the mean.

    bias: see `slope_bias`; null with fewer than `least` barcodes, as are slope, r2 and p. Each of the three is null, too, where it isn't
    defined: a slope of one place, the r2 of one count, p of under three barcodes. codebook: barcode, gene.
    """
    c = F.col
    n = matched.dropna(subset=["barcode"]).groupBy(*keys, "barcode").agg(F.count("*").alias("_n"))
    if spikes is not None:
        n = n.join(spikes.select("barcode").distinct(), "barcode", "left_anti")
    n = n.withColumns({"_n": c("_n").cast("double"), "_h": entropy(c("barcode"))})
    own = n.groupBy(*keys).agg(F.sum("_n").cast("long").alias("reads"), F.count("*").alias("unique_barcodes"), F.regr_slope("_n", "_h").alias("_slope"), corr("_n", "_h").alias("_r"), F.avg("_n").alias("_mean"), F.min(F.struct((-c("_n")).alias("_n"), "barcode")).alias("_top"))
    genes = codebook.groupBy("barcode").agg(F.max(c("gene").cast("string")).alias("_gene"))
    g = n.join(genes, "barcode").where(c("_gene") != control).groupBy(*keys, "_gene").agg(F.sum("_n").alias("_n"))
    by_gene = g.groupBy(*keys).agg(F.min(F.struct((-c("_n")).alias("_n"), "_gene")).alias("_gtop"), F.avg("_n").alias("_gmean"))
    some = c("unique_barcodes") >= least
    out = _joined([by_gene], keys, own).withColumns({"slope": F.when(some, c("_slope")), "r2": F.when(some, c("_r") ** 2), "p_value": F.when(some, correlation_p(c("_r"), c("unique_barcodes")))})
    ratio = lambda top, mean: -c(top) / F.greatest(c(mean), F.lit(1.0))
    return out.select(
        *keys, "reads", "unique_barcodes", "slope", "r2", "p_value", slope_bias(c("slope"), c("p_value")).alias("bias"), c("_top.barcode").alias("top_barcode"), (-c("_top._n")).cast("long").alias("top_count"), ratio("_top._n", "_mean").alias("top_guide_ratio"),
        c("_gtop._gene").alias("top_gene"), ratio("_gtop._n", "_gmean").alias("top_gene_ratio"),
    )
