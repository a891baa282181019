"""Lookups with fallbacks: versions, priorities, cascades, prefixes and cluster expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.functions.formulas import strip_version


def with_version_fallback(df: DataFrame, dim: DataFrame, key: str, value: str) -> DataFrame:
    """Adds value by the exact key, else by the key without its version (of several the smallest value)."""
    exact = dim.groupBy(key).agg(F.min(value).alias("_exact"))
    bare = dim.groupBy(strip_version(F.col(key)).alias("_bare")).agg(F.min(value).alias("_loose"))
    x = df.join(exact, key, "left").withColumn("_bare", strip_version(F.col(key))).join(bare, "_bare", "left")
    return x.withColumn(value, F.coalesce("_exact", "_loose")).drop("_exact", "_loose", "_bare")


def backfill(df: DataFrame, dim: DataFrame, key: str, value: str) -> DataFrame:
    """Fills value from dim where it is null or blank."""
    x = df.join(dim.groupBy(key).agg(F.min(value).alias("_new")), key, "left")
    return x.withColumn(value, F.coalesce(F.when(F.trim(F.col(value).cast("string")) != "", F.col(value)), "_new")).drop("_new")


def cascade(df: DataFrame, steps: list[tuple[DataFrame, list[str]]], value: str) -> DataFrame:
    """Adds value and matched_by (number of the first step that hits) from dims tried in turn."""
    names = []
    for i, (dim, keys) in enumerate(steps):
        df = df.join(dim.groupBy(*keys).agg(F.min(value).alias(f"_v{i}")), keys, "left")
        names.append(f"_v{i}")
    hit = F.coalesce(*[F.when(F.col(n).isNotNull(), F.lit(i)) for i, n in enumerate(names)])
    return df.withColumns({value: F.coalesce(*names), "matched_by": hit}).drop(*names)


def longest_prefix(df: DataFrame, dim: DataFrame, text: str, prefix: str, bound: str = r"[ ,]") -> DataFrame:
    """Adds the longest prefix from dim that ends at a bound (or the end) of the text: texts are exploded
    into their prefixes at bounds, so the join is by equality."""
    ends = F.filter(F.sequence(F.lit(1), F.length(text)), lambda i: (i == F.length(text)) | F.substr(F.col(text), i + 1, F.lit(1)).rlike(bound))
    cut = df.select(text).distinct().where(F.length(text) > 0).select(text, F.explode(F.transform(ends, lambda i: F.substr(F.col(text), F.lit(1), i))).alias(prefix))
    best = cut.join(dim.select(prefix).distinct(), prefix).groupBy(text).agg(F.max_by(prefix, F.length(prefix)).alias(prefix))
    return df.join(best, text, "left")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_no", F.row_number().over(w)).where("_no = 1").drop("_no")


def expand_clusters(rows: DataFrame, clusters: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The best row of each representative, once per member under the member's key."""
    best = first_per_key(rows, [key], order).withColumnRenamed(key, "representative")
    return best.join(clusters, "representative").withColumnRenamed("member", key).drop("representative")


def top_hits(df: DataFrame, forced: Column, parent: str, rank: str, value: str, tie: str, per_parent: int, per_rank: int) -> DataFrame:
    """Forced rows, then the best of each parent, then each rank filled to its limit; adds reason."""
    order = [F.desc(value), F.col(tie)]
    x = df.withColumn("_forced", forced).withColumn("_p", F.row_number().over(Window.partitionBy(parent).orderBy(*order)))
    early = F.col("_forced") | (F.col("_p") <= per_parent)
    x = x.withColumn("_early", early)
    w = Window.partitionBy(rank).orderBy(F.desc("_early"), *order)
    x = x.withColumn("_r", F.row_number().over(w))
    reason = F.when(F.col("_forced"), "forced").when(F.col("_p") <= per_parent, "parent").when(F.col("_r") <= per_rank, "rank")
    return x.withColumn("reason", reason).where("reason is not null").drop("_forced", "_p", "_r", "_early")
