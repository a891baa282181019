"""Annotations over three levels, model probabilities by accession, presence of what is expected, and pools of
candidates for novelty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.operators.fit import dirichlet

#: Ranks above species, and ranks of a species or below.
HIGH_RANKS = ("genus", "family", "order", "class", "phylum", "superkingdom", "domain", "kingdom")
SPECIES_RANKS = ("species", "subspecies", "strain", "serotype", "no rank")
LEVELS = ("genus", "species", "strain")


def flatten_annotations(rows: DataFrame, order: str) -> DataFrame:
    """One row per gene and scope of (level, gene, hit, genus, species, strain, ...): the first by level, then
    `order`, with scope and taxid.

    A row without a gene's name goes by its hit. The scope of genus rows is the genus; species and strain rows
    share the species, so a strain repeats nothing that its species has. taxid is that of the row's own level.
    """
    level = F.array_position(F.array(*[F.lit(x) for x in LEVELS]), F.col("level"))
    named = F.when(F.coalesce("gene", F.lit("")) != "", F.col("gene")).otherwise(F.coalesce("hit", F.lit("")))
    scope = F.when(F.col("level") == "genus", F.col("genus")).otherwise(F.col("species"))
    own = F.when(F.col("level") == "genus", F.col("genus")).when(F.col("level") == "species", F.col("species")).otherwise(F.col("strain"))
    x = rows.withColumns({"gene": named, "scope": scope, "taxid": own})
    first = Window.partitionBy("gene", "scope").orderBy(level, order)
    return x.withColumn("_no", F.row_number().over(first)).where("_no = 1").drop("_no")


def model_probability(members: DataFrame, profile: DataFrame, group: str, accession: str, fallback: DataFrame) -> DataFrame:
    """(group, probability, model): the mean of its accessions' probabilities weighted by their reads (none or
    0 count as 1), and the first accession's model that there is; groups without any take what `fallback`
    (group, avg, model) says. profile: (accession, avg, n, model)."""
    w = F.when(F.coalesce("n", F.lit(0)) != 0, F.col("n")).otherwise(1)
    hit = members.join(profile.select(accession, "avg", "n", "model").where("avg is not null"), accession)
    own = hit.groupBy(group).agg(
        (F.sum(F.col("avg") * w) / F.sum(w)).alias("_p"), F.min_by("model", F.when(F.col("model").isNotNull(), F.col(accession))).alias("_m"), F.lit(True).alias("_own"))
    out = members.select(group).distinct().join(own, group, "left").join(fallback.select(group, "avg", "model"), group, "left")
    mine = F.coalesce("_own", F.lit(False))
    return out.select(group, F.when(mine, F.col("_p")).otherwise(F.col("avg")).alias("probability"), F.when(mine, F.col("_m")).otherwise(F.col("model")).alias("model"))


def presence(expected: DataFrame, found: DataFrame, key: str, item: str) -> DataFrame:
    """(key, expected, missing, pct, items): of the expected items, how many are missing from each key of
    `found`, the percentage that is there, and the missing ones in order. expected: (key, item)."""
    want, have = expected.select(key, item).distinct(), found.select(key, item).distinct().withColumn("_there", F.lit(True))
    both = want.join(have, [key, item], "left")
    gone = F.col("_there").isNull()
    return both.groupBy(key).agg(
        F.count("*").alias("expected"), F.count_if(gone).alias("missing"), (F.count_if(~gone) / F.count("*") * 100).alias("pct"), F.array_join(F.sort_array(F.collect_list(F.when(gone, F.col(item)))), ",").alias("items"))


def taxon_pools(hits: DataFrame, weight: Column | None = None, least: int = 2, share: float = 0.002) -> tuple[DataFrame, DataFrame]:
    """((assigned, highrank), (pool, taxid, rank, name, n)): what protein hits (taxid, rank, name) place.

    Each hit counts once, or by `weight` (whole part; unreadable ones once; none at 0 or less). Hits without a
    taxid and a rank aren't assigned. Candidates of ranks above species need `least` hits and the share of
    all such hits, rounded up; those of species `least` hits.
    """
    rank = F.lower(F.trim("rank"))
    n = F.lit(1) if weight is None else F.coalesce(weight.try_cast("double").cast("bigint"), F.lit(1))
    x = hits.withColumns({"rank": rank, "_n": n}).where("_n > 0").where(~(F.col("taxid").isin("0", "", "no rank") & F.col("rank").isin("", "no rank")))
    high = F.col("rank").isin(*HIGH_RANKS)
    totals = x.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("assigned"), F.coalesce(F.sum(F.when(high, F.col("_n"))), F.lit(0)).alias("highrank"))
    pool = F.when(high, "highrank").when(F.col("rank").isin(*SPECIES_RANKS) & ~F.col("taxid").isin("0", ""), "species")
    counts = x.withColumn("pool", pool).where("pool is not null").groupBy("pool", "taxid", "rank", "name").agg(F.sum("_n").alias("n"))
    cut = F.when(F.col("pool") == "highrank", F.greatest(F.lit(least), F.ceil(F.col("highrank") * share))).otherwise(least)
    return totals, counts.crossJoin(F.broadcast(totals.select("highrank"))).where(F.col("n") >= cut).drop("highrank")


def synthetic_abundance(values: DataFrame, accessions: DataFrame, taxid: str, value: str, accession: str, seed: int) -> DataFrame:
    """(accession, abundance): a taxon's share of all values split over its accessions by a flat Dirichlet
    draw; taxa without accessions have no part, and the rest sums to 1."""
    total = values.agg(F.sum(value).alias("_all"))
    split = dirichlet(accessions.join(values.select(taxid), taxid, "left_semi"), accession, taxid, seed)
    x = split.join(values.select(taxid, value), taxid).crossJoin(F.broadcast(total))
    x = x.withColumn("_a", F.when(F.col("_all") > 0, F.col(value) / F.col("_all")).otherwise(0.0) * F.col("weight"))
    placed = x.agg(F.sum("_a").alias("_sum"))
    return x.crossJoin(F.broadcast(placed)).select(accession, F.when(F.col("_sum") > 0, F.col("_a") / F.col("_sum")).otherwise(F.col("_a")).alias("abundance"))
