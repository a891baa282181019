"""Cross-sample analytics: collapse, rescue, prevalence, similarity, enrichment and grouping."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def collapse(df: DataFrame, keys: list[str], sums: list[str], maxes: list[str], weighted: list[str], weight: str, value: str, how: str) -> DataFrame:
    """Merge the libraries of a specimen: sums, maxima, weighted means, and `value` by max, min, mean,
    median or detection (mean over rows where it is positive)."""
    v = F.col(value)
    agg = {"max": F.max(v), "min": F.min(v), "mean": F.avg(v), "median": F.median(v), "detection": F.avg(F.when(v > 0, v))}[how]
    w = F.sum(weight)
    means = [F.when(w > 0, F.sum(F.col(c) * F.col(weight)) / w).alias(c) for c in weighted]
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in maxes], *means, agg.alias(value), F.count("*").alias("n_merged"))


def rollup_rescue(df: DataFrame, own: Column, species: Column, genus: Column) -> DataFrame:
    """Adds passes, rescued and rescue_level: a row passes by itself, its species or its genus."""
    level = F.when(~own & species, "species").when(~own & ~species & genus, "genus")
    return df.withColumns({"passes": own | species | genus, "rescued": ~own & (species | genus), "rescue_level": level})


def inject_species(strains: DataFrame, species: DataFrame, keys: list[str], passes: str) -> DataFrame:
    """Passing strains, and where none of a passing species' strains pass, the species row with their number.

    Both inputs have `keys` and passes; output has keys, level and n_rescued.
    """
    state = strains.groupBy(*keys).agg(F.bool_or(passes).alias("_any"), F.count("*").alias("n_rescued"))
    kept = strains.where(passes).select(*keys, F.lit("strain").alias("level"), F.lit(0).cast("bigint").alias("n_rescued"))
    up = species.where(passes).join(state.where("not _any"), keys).select(*keys, F.lit("species").alias("level"), "n_rescued")
    return kept.unionByName(up)


def prevalence(det: DataFrame, organism: str, sample: str, value: str, cutoff: float, n_samples: int) -> DataFrame:
    """Per organism: detected, passing and below samples, prevalence, and value statistics with absent
    samples as zeros. Zeros aren't materialised: they enter the mean by the count, the median by rank."""
    per = det.groupBy(organism, sample).agg(F.max(value).alias("v"))
    order = Window.partitionBy(organism).orderBy("v", sample)
    x = per.withColumns({"_at": F.row_number().over(order), "_n": F.count("*").over(Window.partitionBy(organism))})
    zeros = F.lit(n_samples) - F.col("_n")
    low, high = (n_samples + 1) // 2, n_samples // 2 + 1
    at = F.col("_at") + zeros
    mid = (F.coalesce(F.max(F.when(at == low, F.col("v"))), F.lit(0.0)) + F.coalesce(F.max(F.when(at == high, F.col("v"))), F.lit(0.0))) / 2
    return x.groupBy(organism).agg(
        F.count("*").alias("detected"), F.count_if(F.col("v") >= cutoff).alias("passing"), F.count_if(F.col("v") < cutoff).alias("below"),
        (F.count("*") * 100.0 / n_samples).alias("prevalence_pct"), (F.sum("v") / n_samples).alias("mean_value"), mid.alias("median_value"), F.max("v").alias("max_value"))


def cooccurrence(det: DataFrame, item: str, sample: str) -> DataFrame:
    """(a, b, both, jaccard) of items present in common samples, a < b; one row per sample's items first."""
    seen = det.select(F.col(item).alias("i"), F.col(sample).alias("s")).distinct()
    n = seen.groupBy("i").agg(F.count("*").alias("n"))
    pairs = seen.withColumnRenamed("i", "a").join(seen.withColumnRenamed("i", "b"), "s").where("a < b").groupBy("a", "b").agg(F.count("*").alias("both"))
    x = pairs.join(n.select(F.col("i").alias("a"), F.col("n").alias("na")), "a").join(n.select(F.col("i").alias("b"), F.col("n").alias("nb")), "b")
    return x.select("a", "b", "both", (F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))).alias("jaccard"))


def profile_similarity(profile: DataFrame, entry: str, taxon: str, value: Column) -> DataFrame:
    """(a, b, cosine, jaccard, shared) between entries by their taxa, from one join on the taxon."""
    p = profile.select(F.col(entry).alias("e"), F.col(taxon).alias("t"), value.alias("v")).where("v > 0")
    size = p.groupBy("e").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"), F.count("*").alias("n"))
    x = p.select(F.col("e").alias("a"), "t", F.col("v").alias("va")).join(p.select(F.col("e").alias("b"), "t", F.col("v").alias("vb")), "t").where("a < b")
    x = x.groupBy("a", "b").agg(F.sum(F.col("va") * F.col("vb")).alias("dot"), F.count("*").alias("shared"))
    x = x.join(size.select(F.col("e").alias("a"), F.col("norm").alias("x"), F.col("n").alias("na")), "a").join(size.select(F.col("e").alias("b"), F.col("norm").alias("y"), F.col("n").alias("nb")), "b")
    return x.select("a", "b", (F.col("dot") / (F.col("x") * F.col("y"))).alias("cosine"), (F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))).alias("jaccard"), "shared")


def enrichment(profile: DataFrame, group: str, taxon: str, value: str, n_groups: int, top: int) -> DataFrame:
    """(group, taxon, log2_fc): value against the mean of the other groups (absent: 0), the `top` taxa by
    their largest absolute change."""
    w = Window.partitionBy(taxon)
    others = (F.sum(value).over(w) - F.col(value)) / (n_groups - 1)
    x = profile.withColumn("log2_fc", F.log2((F.col(value) + 1e-6) / (others + 1e-6)))
    best = x.groupBy(taxon).agg(F.max(F.abs("log2_fc")).alias("_m")).orderBy(F.desc(F.round("_m", 6)), taxon).limit(top)
    return x.join(F.broadcast(best), taxon).select(group, taxon, "log2_fc")


def composite_groups(df: DataFrame, sample: str, fields: Mapping[str, str], sep: str = ";", most: int = 400) -> DataFrame:
    """(sample, group): the product of a sample's values over multi-valued text fields; a field that would
    take the product beyond `most` stays whole."""
    x = df.withColumn("_g", F.array(F.lit("")))
    for i, (col, _) in enumerate(fields.items()):
        values = F.filter(F.transform(F.split(F.coalesce(F.col(col), F.lit("")), sep), lambda v: F.trim(v)), lambda v: v != "")
        values = F.when(F.size(values) * F.size("_g") > most, F.array(F.col(col))).when(F.size(values) == 0, F.array(F.lit("Unknown"))).otherwise(values)
        x = x.withColumn("_g", F.flatten(F.transform("_g", lambda g: F.transform(values, lambda v: v if i == 0 else F.concat(g, F.lit(" | "), v)))))
    return x.select(sample, F.explode(F.array_distinct("_g")).alias("group"))


def pairwise_correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x, y, r, n) of all column pairs in one pass; null with fewer than three rows or no variance."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    both = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull()
    aggs = [e for i, (a, b) in enumerate(pairs) for e in (F.corr(a, b).alias(f"r{i}"), F.count_if(both(a, b)).alias(f"n{i}"))]
    rows = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.when((F.col(f"n{i}") >= 3) & ~F.isnan(f"r{i}"), F.col(f"r{i}")).alias("r"), F.col(f"n{i}").alias("n")) for i, (a, b) in enumerate(pairs)]
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def profile_columns(df: DataFrame, key: str, value: str) -> DataFrame:
    """Per key of a long (key, value) table: rows filled, distinct values, numeric share and mean length."""
    filled = F.when(F.trim(value) != "", F.trim(value))
    return df.groupBy(key).agg(
        F.count("*").alias("n"), F.count(filled).alias("filled"), F.countDistinct(filled).alias("n_distinct"),
        (F.count_if(filled.try_cast("double").isNotNull()) / F.count(filled)).alias("numeric_share"), F.avg(F.length(filled)).alias("mean_chars"))


def network_edges(similar: DataFrame, column: str, cut: float) -> DataFrame:
    return similar.where(F.col(column) >= cut).select("a", "b", F.col(column).alias("weight"))
