"""Confidence scores: components, combinations and what compares them."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.functions.formulas import clip, normal_cdf, once, sigmoid


def rank_disparity(df: DataFrame, group: str, value: str, tie: str, solo: float = 1.0) -> DataFrame:
    """Adds disparity (1 for the group's largest down to 0 for its smallest), share and top_ratio."""
    w = Window.partitionBy(group)
    order = Window.partitionBy(group).orderBy(F.desc(value), tie)
    n, at = F.count("*").over(w), F.row_number().over(order)
    return df.withColumns({
        "disparity": F.when(n > 1, 1 - (at - 1) / (n - 1)).otherwise(F.lit(solo)),
        "share": F.col(value) / F.sum(value).over(w), "top_ratio": F.col(value) / F.max(value).over(w)})


def lead_margin(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, top, second, margin): how far the largest leads the runner-up, in shares of the group."""
    order = Window.partitionBy(group).orderBy(F.desc(value))
    x = df.withColumn("_no", F.row_number().over(order))
    a = x.groupBy(group).agg(F.max(value).alias("top"), F.max(F.when(F.col("_no") == 2, F.col(value))).alias("second"), F.sum(value).alias("_sum"))
    return a.select(group, "top", "second", ((F.col("top") - F.coalesce("second", F.lit(0))) / F.col("_sum")).alias("margin"))


def breadth_score(breadth: Column, hmf: Column, middle: float = 0.01, steep: float = 12_000.0, power: float = 0.3) -> Column:
    """Sigmoid of breadth times a power of the share of well-mapped reads.

    The power is 0.3 where a sample is scored and 2 where groups are summarised without other settings.
    """
    return sigmoid(breadth, middle, steep) * F.pow(hmf, power)


def gini_score(gini: Column, length: Column, dispersion: Column, alpha: float = 1.8, reward: float = 2.0, beta: float = 0.5, baseline: float = 5e5, longest: float = 1e9) -> Column:
    """Evenness of coverage, more for long references and for spread positions, at most 1.

    A Gini coefficient outside [0, 1] counts as no evenness at all.
    """
    base = F.when(gini.between(0, 1), clip(alpha * F.sqrt(1 - gini))).otherwise(F.lit(0.0))
    size = 1 + reward * F.log10(F.greatest(F.lit(1.0), F.least(length, F.lit(longest)) / baseline))
    return F.least(F.lit(1.0), base * size * (1 + beta * dispersion))


def gini_component(score: Column, contig_pen: Column, hmf: Column, depth_pen: Column, power: float = 1.0) -> Column:
    """The evenness score as it enters the total: less for few contigs, poor mapping and piled-up reads."""
    return score * contig_pen * F.pow(hmf, power) * depth_pen


def contig_penalty(covered: Column, total: Column) -> Column:
    return F.when(total > 1, F.pow(covered / total, 0.3)).otherwise(F.lit(1.0))


def depth_penalty(breadth: Column, reads: Column, read_length: Column, length: Column) -> Column:
    """Breadth against what random placement of the reads would cover, to the power 0.3."""
    expected = 1 - F.exp(-F.least(reads * read_length / length, F.lit(5.0)))
    return F.when(expected > 0, F.pow(F.least(F.lit(1.0), breadth / expected), 0.3)).otherwise(F.lit(1.0))


def minhash_score(before: Column, after: Column, retention: Column, fallback: Column) -> Column:
    """Kept breadth and kept reads after removal; the fallback's half where nothing was compared."""
    kept = F.when(before > 0, F.least(F.lit(1.0), 0.3 * after / before + 0.7 * retention))  # least() skips nulls
    return F.coalesce(kept, 0.5 * fallback)


def record_gate(confidence: Column, mapq01: Column, dominance: Column, rpm_weight: Column) -> Column:
    floor = F.greatest(confidence, 0.3 * mapq01 * (1 + dominance))
    w = 0.35 * (1 - F.least(F.lit(1.0), confidence + 0.2 * mapq01))
    return floor * ((1 - w) + w * rpm_weight)


def abundance_confidence(reads: Column, total: Column, middle: float = 5.0, steep: float = 2.0) -> Column:
    """Sigmoid of log10 reads per million around log10 of the middle; 0 without reads."""
    rpm = F.greatest(reads / total * 1e6, F.lit(1e-3))
    return F.when((reads > 0) & (total > 0), sigmoid(F.log10(rpm), math.log10(max(middle, 1e-3)), steep)).otherwise(F.lit(0.0))


def group_gate(depth_pen: Column, contig_pen: Column, confidence: Column, removal: Column, mapq: Column) -> Column:
    return F.greatest(depth_pen * contig_pen * confidence, 0.7 * (1 - removal) * mapq)


def mapq_relief(hmf: Column, minhash: Column, n: Column) -> Column:
    return hmf + (1 - hmf) * clip(minhash * (1 - 1 / n))


def normalized_weights(weights: Mapping[str, float]) -> dict[str, float]:
    """Weights that sum to one; all zero where their sum is zero."""
    total = sum(weights.values())
    return {k: v / total if total else 0.0 for k, v in weights.items()}


#: The parts of the score whose weighted sum decides how much of a plasmid bonus counts, and all others.
CORE_PARTS = ("breadth", "minhash", "gini", "disparity", "population")
MINOR_PARTS = ("mapq", "k2_disparity", "protein_identity")


def additive_score(
    parts: Mapping[str, Column], weights: Mapping[str, float], plasmid: Column, bonus: float = 0.0, abundance: Column | None = None,
    abundance_weight: float = 0.0, gate: bool = False, power: float = 0.7, scale: Column | None = None,
) -> Column:
    """Weighted sum of up to eight parts and the abundance confidence, with a plasmid bonus outside the
    weights, an optional abundance gate and a power that `scale` (1 if absent) softens."""
    total, none = F.lit(0.0), F.lit(0.0)
    for name in (*CORE_PARTS, *MINOR_PARTS):
        if weights.get(name):
            total = total + F.coalesce(parts[name], none) * weights[name]
    a = none if abundance is None else F.coalesce(abundance, none)
    total = total + a * abundance_weight + F.greatest(plasmid, none) * bonus
    total = total * a if gate else total
    if power != 1 and power > 0:
        total = F.pow(clip(total), 1 - (1 - F.lit(power)) * (F.lit(1.0) if scale is None else scale))
    return clip(total)


def penalized_score(
    parts: Mapping[str, Column], weights: Mapping[str, float], plasmid: Column, bonus: float = 0.0, abundance: Column | None = None,
    abundance_weight: float = 0.0, gate: bool = False,
) -> Column:
    """0.5 plus weighted distances of up to eight parts from 0.5.

    The abundance confidence a scales the distance by (1 - w) + w a. A plasmid bonus counts in full from a
    plain weighted sum of the core parts of 0.15 on, and in proportion below it.
    """
    none = F.lit(0.0)
    away, quality = none, none
    for name in (*CORE_PARTS, *MINOR_PARTS):
        if weights.get(name):
            value = F.coalesce(parts[name], none)
            away = away + (value - 0.5) * weights[name]
            quality = quality + value * weights[name] if name in CORE_PARTS else quality
    a = none if abundance is None else F.coalesce(abundance, none)
    if abundance_weight > 0:
        away = away * ((1 - abundance_weight) + abundance_weight * a)
    total = 0.5 + away + F.greatest(plasmid, none) * bonus * F.least(F.lit(1.0), quality / 0.15)
    return clip(0.5 + (total - 0.5) * a if gate else total)


def plasmid_score(df: DataFrame, group: str, breadth: Column, gini: Column, covered: str, reads: str) -> Column:
    w = Window.partitionBy(group)
    ratio = lambda c: F.when(F.max(c).over(w) > 0, F.col(c) / F.max(c).over(w)).otherwise(F.lit(0.0))
    return F.sqrt(breadth * gini) * F.least(F.lit(1.0), 0.7 * ratio(covered) + 0.3 * ratio(reads))


def population_percentile(value: Column, mean: Column, sd: Column) -> Column:
    """Where a value stands in a normal population; three deviations out where the population has none.

    Low percentiles are squared, those above one deviation are raised towards 1.
    """
    z = F.when(sd > 0, (value - mean) / sd).otherwise(F.lit(3.0))
    zp = F.struct(z.alias("z"), normal_cdf(z).alias("p"))
    return once(zp, lambda v: (
        F.when(v["z"] < -1, v["p"] * v["p"]).when(v["z"] <= 1, v["p"]).when(v["z"] <= 2, 1 - F.pow(1 - v["p"], 1.5)).otherwise(1 - F.pow(1 - v["p"], 2.0))))


def conflict_bucket(df: DataFrame, cluster: str, parent: str, most: int = 50) -> Column:
    """A column for grouping: the conflict cluster, or cluster and parent in clusters of more than `most`."""
    n = F.count("*").over(Window.partitionBy(cluster))
    return F.when(n > most, F.concat_ws("/", F.col(cluster).cast("string"), F.col(parent).cast("string"))).otherwise(F.col(cluster).cast("string"))


def share_minhash(
    df: DataFrame, bucket: str, rpm: str, tie: str, minhash: str, ceiling: Column, coverage: Column, confidence: Column, removal: Column, partners: Column,
) -> DataFrame:
    """Adds rpm_share, factor and minhash_shared: what members of a bucket keep or gain of their minhash.

    A bucket's only member closes 0.9 of its gap to the ceiling, times its confidence. The winner (most
    reads per million) closes the gap by its share and its lead. The others keep a part by share and by
    coverage relative to the winner's, less the more members there are and the more of their reads were
    removed among conflict partners (removal or partners null: no such penalty), but near-equals of the
    winner with coverage of their own are kept nearer to 0.8. None keeps less than 0.2.
    """
    w = Window.partitionBy(bucket)
    order = Window.partitionBy(bucket).orderBy(F.desc(rpm), tie)
    x = df.withColumns({"_n": F.count("*").over(w), "_at": F.row_number().over(order), "_sum": F.sum(rpm).over(w), "_max": F.max(rpm).over(w), "_cov": coverage})
    x = x.withColumns({"_second": F.max(F.when(F.col("_at") == 2, F.col(rpm))).over(w), "_topcov": F.max(F.when(F.col("_at") == 1, F.col("_cov"))).over(w)})
    one, none, n = F.lit(1.0), F.lit(0.0), F.col("_n")
    share = F.try_divide(rpm, "_sum")
    gap = F.greatest(none, ceiling - F.col(minhash))
    lead = share - F.coalesce(F.try_divide("_second", "_sum"), none)
    won = F.least(ceiling, F.col(minhash) + gap * F.least(one, share + 0.75 * lead))
    solo = F.least(ceiling, F.col(minhash) + 0.9 * gap * confidence)

    by_cover = F.when(F.col("_topcov") > 0, F.least(one, F.try_divide("_cov", "_topcov"))).otherwise(one)
    kept = 0.65 * (0.2 + 0.8 * share) + 0.35 * (0.35 + 0.65 * by_cover)
    kept = kept * F.when(n > 2, F.greatest(F.lit(0.35), 1 / (1 + 0.3 * (n - 2)))).otherwise(one)
    kept = kept * F.greatest(F.lit(0.3), 1 - 0.5 * F.coalesce(removal * F.least(one, partners / 5), none))
    parity = clip((F.try_divide(rpm, "_max") - 0.4) / 0.4) * clip((F.col("_cov") - 0.1) / 0.15)
    parity = parity * F.when(n > 2, F.greatest(F.lit(0.1), 2 / n)).otherwise(one)
    kept = F.greatest(F.lit(0.2), kept + parity * F.greatest(none, 0.8 - kept))

    bare = F.col("_sum") <= 0  # nothing to share
    factor = F.when((n == 1) | bare, one).when(F.col("_at") == 1, F.coalesce(F.try_divide(won, minhash), one)).otherwise(kept)
    shared = F.when(n == 1, solo).when(bare, F.col(minhash)).when(F.col("_at") == 1, won).otherwise(F.col(minhash) * kept)
    return x.withColumns({"rpm_share": F.when(n == 1, one).otherwise(share), "factor": factor, "minhash_shared": shared}).drop("_n", "_at", "_sum", "_max", "_cov", "_second", "_topcov")


def control_flags(sample: DataFrame, negatives: DataFrame, positives: DataFrame, key: str, value: str, bound: float = 2.0) -> DataFrame:
    """Sample rows with neg_max, pos_min, fold_neg (infinite over a zero control), fold_pos and neg_flag."""
    neg = negatives.groupBy(key).agg(F.max(value).alias("neg_max"))
    pos = positives.groupBy(key).agg(F.min(value).alias("pos_min"))
    x = sample.join(neg, key, "left").join(pos, key, "left")
    fold = lambda c: F.when(c > 0, F.col(value) / c).when((c == 0) & (F.col(value) > 0), F.lit(float("inf")))
    x = x.withColumns({"fold_neg": fold(F.col("neg_max")), "fold_pos": fold(F.col("pos_min"))})
    flag = F.when(F.col("neg_max").isNull(), "no_control").when(F.col("fold_neg") < bound, "within_negative").otherwise("above_negative")
    return x.withColumn("neg_flag", flag)


def missing_controls(sample: DataFrame, positives: DataFrame, key: str, value: str, *keep: str) -> DataFrame:
    """Best replicate of each positive control that the sample lacks."""
    best = positives.groupBy(key).agg(F.max_by(F.struct(value, *keep), F.struct(value, *keep)).alias("b"))
    return best.join(sample.select(key).distinct(), key, "left_anti").select(key, "b.*")


def novelty(counts: DataFrame, dark: Column, high: Column, low: Column, baseline: Column) -> DataFrame:
    """Adds z-scores against baseline rows, their weighted sum and a flag from 2 on."""
    x = counts.withColumns({"dark": dark, "high": high, "low": low, "_base": baseline})
    cols = ("dark", "high", "low")
    base = x.where("_base").agg(*[F.avg(c).alias(f"{c}_m") for c in cols], *[F.stddev_pop(c).alias(f"{c}_s") for c in cols])
    x = x.crossJoin(F.broadcast(base))  # one row
    for c in cols:
        z = F.when(F.col(f"{c}_s") > 1e-9, (F.col(c) - F.col(f"{c}_m")) / F.col(f"{c}_s")).otherwise(10 * (F.col(c) - F.coalesce(f"{c}_m", F.lit(0.0))))
        x = x.withColumn(f"z_{c}", z)
    return x.withColumn("novelty", 0.5 * F.col("z_dark") + 0.3 * F.col("z_high") + 0.2 * F.col("z_low")).withColumn("flagged", F.col("novelty") >= 2.0).drop("_base", *[f"{c}_{k}" for c in cols for k in "ms"])


def first_match(df: DataFrame, dim: DataFrame, keys: list[list[tuple[str, str]]], value: str, name: str) -> DataFrame:
    """Adds name: value of dim by the first of several keys that matches. Each key pairs columns of df with
    columns of dim; dim columns that a key leaves out must be 'all'."""
    dims = [c for c in dim.columns if c != value]
    found = []
    for i, key in enumerate(keys):
        fixed = dict((b, a) for a, b in key)
        side = dim
        for c in dims:
            if c not in fixed:
                side = side.where(F.col(c) == "all")
        side = side.select(*[F.col(b).alias(f"_k{i}_{j}") for j, (_, b) in enumerate(key)], F.col(value).alias(f"_v{i}"))
        if key:
            on = [F.col(a) == F.col(f"_k{i}_{j}") for j, (a, _) in enumerate(key)]
            df = df.join(side, on, "left").drop(*[f"_k{i}_{j}" for j in range(len(key))])
        else:  # one default row, or none
            df = df.join(F.broadcast(side.limit(1)), F.lit(True), "left")
        found.append(f"_v{i}")
    return df.withColumn(name, F.coalesce(*found)).drop(*found)
