"""Group summaries with all kinds of fields, and the flat projection of organism records for tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of a flat row that are copied as they are, by what stands in where they are missing.
COPIED = {"name": "Unknown", "category": "Unknown", "ann_class": "", "mol_type": "", "status": "", "kingdom": "", "domain": "", "superkingdom": "", "phylum": "", "class": "", "order": "", "family": "", "genus": ""}
#: Measures that are rounded only, and to how many places.
ROUNDED = {"mean_depth": 2, "gini": 3, "mapq": 1, "baseq": 1, "minhash": 3, "breadth_score": 3, "mapq_score": 3, "disparity": 3, "protein_identity": 1, "rpm": 2, "rpkm": 4}


def summarise(
    rows: DataFrame, keys: Sequence[str], weight: str, order: str, sums: Sequence[str] = (), means: Sequence[str] = (), firsts: Sequence[str] = (), anys: Sequence[str] = (), spreads: Sequence[str] = (),
) -> DataFrame:
    """Groups with summed fields, means weighted by `weight`, first values that there are (by `order`), flags of
    any member, and mean, largest and sum of spreads (as name_mean, name_max, name_sum).

    A mean counts members with a weight above 0 and a value; without any it is the plain mean of what values
    there are. Fields keep their names.
    """
    w = F.col(weight)

    def mean(c: str) -> Column:
        heavy = F.col(c).isNotNull() & (w > 0)
        return F.coalesce(F.try_divide(F.sum(F.when(heavy, F.col(c) * w)), F.sum(F.when(heavy, w))), F.avg(c)).alias(c)

    aggs = [F.sum(c).alias(c) for c in sums] + [mean(c) for c in means] + [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in firsts] + [F.bool_or(c).alias(c) for c in anys]
    aggs += [f(c).alias(f"{c}_{name}") for c in spreads for name, f in (("mean", F.avg), ("max", F.max), ("sum", F.sum))]
    return rows.groupBy(*keys).agg(*aggs)


def flat_rows(rows: DataFrame, sample: str, totals: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """One flat row an organism of any level, with measures in the units and places of a table.

    rows: sample, level, key, subkey, toplevelkey and measures, of which missing columns count as null; totals:
    (sample, total_reads); parents: for `species` and `genus`, (sample, key, tass, name) of that level's records.
    Shares are of the sample's reads (1 at least), coverage a part of 1 shown in percent, breadth from covered
    bases; none is above 100. A row without a parent is its own species, and its species stands for its genus.
    """
    have = lambda c: F.col(c) if c in rows.columns else F.lit(None)
    number = lambda c: F.coalesce(have(c).cast("double"), F.lit(0.0))
    x = rows.join(totals.select(sample, "total_reads"), sample, "left")
    for level, on in (("species", "subkey"), ("genus", "toplevelkey")):
        p = parents[level].select(F.col(sample), F.col("key").alias(on), F.col("tass").alias(f"_{level}_tass"), F.col("name").alias(f"_{level}_name"), F.lit(True).alias(f"_{level}"))
        x = x.join(p, [sample, on], "left")
    reads, length = number("reads"), number("length").cast("bigint")
    covered, tass = number("covered_bases").cast("bigint"), number("tass")
    species = F.when(F.col("_species"), F.col("_species_tass")).otherwise(tass)
    genus = F.when(F.col("_genus"), F.col("_genus_tass")).otherwise(species)
    own = F.coalesce(have("name"), F.lit(""))
    species_name = F.when(F.col("_species"), F.coalesce("_species_name", F.lit(""))).otherwise(own)
    genus_name = F.when(F.col("_genus"), F.coalesce("_genus_name", F.lit(""))).otherwise(F.when(F.col("_species"), species_name).otherwise(own))
    copied = [F.coalesce(have(c).cast("string"), F.lit(v)).alias(c) for c, v in COPIED.items()]
    rounded = [F.round(number(c), n).alias(c) for c, n in ROUNDED.items()]
    return x.select(
        sample, F.coalesce(have("sample_type").cast("string"), F.lit("")).alias("sample_type"), "level", F.col("key").cast("string").alias("taxid"), F.coalesce(have("subkey"), F.col("key")).cast("string").alias("subkey"), *copied, *rounded,
        tass.alias("tass"), F.coalesce(have("is_annotated") == "Yes", F.lit(False)).alias("is_annotated"), F.coalesce(have("high_consequence").cast("boolean"), F.lit(False)).alias("high_consequence"),
        reads.cast("bigint").alias("reads"), F.round(reads / F.greatest(F.lit(1), F.coalesce("total_reads", F.lit(0))) * 100, 4).alias("pct_reads"), F.round(F.least(F.lit(100.0), number("coverage") * 100), 1).alias("coverage"),
        covered.alias("covered_bases"), length.alias("genome_length"), F.when(length > 0, F.round(F.least(F.lit(100.0), covered / length * 100), 2)).otherwise(0.0).alias("breadth_pct"),
        F.round(have("model_probability").cast("double") * 100, 2).alias("model_pct"), F.coalesce(have("model").cast("string"), F.lit("")).alias("model"), number("k2_reads").cast("bigint").alias("k2_reads"),
        F.coalesce(have("passes_threshold").cast("boolean"), F.lit(False)).alias("passes_threshold"), F.lit("ani_matches" in rows.columns).alias("ani_annotated"),
        (F.coalesce(F.size("ani_matches"), F.lit(0)) if "ani_matches" in rows.columns else F.lit(0)).alias("n_ani_matches"),
        F.round(species, 4).alias("species_tass"), F.round(genus, 4).alias("genus_tass"), species_name.alias("species_name"), genus_name.alias("genus_name"))
