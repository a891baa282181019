"""Truth from read names: four naming rules, and counts of right and wrong alignments at every level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: An accession before its version, an accession with a dash before a number, the two numbers
#: that simulators append to an accession.
ACCESSION = r"([A-Z]{1,4}_[A-Z0-9]{3,}|[A-Z]{1,4}[0-9]{5,})\.\d+"
DASHED = r"([A-Z]{1,4}-[A-Z0-9]{3,}|[A-Z]{1,4}[0-9]{5,})_\d+"
APPENDED = r"^(.*)_\d+_\d+$"


def canonical_accession(name: Column) -> Column:
    """The accession, without its version, in a read's or reference's name; else what stands before the first
    underscore; null without a name. Null and empty names are null."""
    bare = F.trim(name)
    bare = F.when(bare.startswith("@"), F.substr(bare, F.lit(2))).otherwise(bare)
    found, dashed = F.regexp_extract(bare, ACCESSION, 1), F.regexp_extract(bare, DASHED, 1)
    return F.when(name == "", None).when(found != "", found).when(dashed != "", F.replace(dashed, F.lit("-"), F.lit("_"))).otherwise(F.split_part(bare, F.lit("_"), F.lit(1)))


def truth_of(name: Column, rule: str) -> Column:
    """The reference that a read was taken from, by one of four rules on its name.

    first: up to the first underscore. appended: without two trailing numbers; other names are themselves.
    parts: all parts between underscores but the last two; null for fewer than three parts. canonical: its
    canonical accession. Null names are null, but empty by the rule `appended`.
    """
    parts = F.split(name, "_", -1)
    rules = {
        "first": F.split_part(name, F.lit("_"), F.lit(1)),
        "appended": F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), APPENDED, "$1")),
        "parts": F.when(F.size(parts) >= 3, F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 2, F.lit(0))), "_")),
        "canonical": canonical_accession(name),
    }
    return rules[rule]


def ratios(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """precision, recall and f1; empty ones are 0."""
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return {"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)}


def taxon_counts(aln: DataFrame, truth: Column, aligned: Column, taxa: DataFrame) -> DataFrame:
    """(taxon, tp, fp) of alignments by the taxon they are aligned to; taxa: (accession, taxon).

    An alignment is right if its truth has the same taxon; a truth without a taxon makes it wrong. Those
    without a truth, or whose reference has no taxon, don't count.
    """
    rows = aln.select(truth.alias("_t"), aligned.alias("_a")).where("_t <> '' and _a <> ''").groupBy("_t", "_a").agg(F.count("*").alias("n"))
    rows = rows.join(taxa.select(F.col("accession").alias("_a"), "taxon"), "_a").join(taxa.select(F.col("accession").alias("_t"), F.col("taxon").alias("own")), "_t", "left")
    right = F.coalesce(F.col("own") == F.col("taxon"), F.lit(False))
    return rows.groupBy("taxon").agg(F.sum(F.when(right, F.col("n")).otherwise(0)).alias("tp"), F.sum(F.when(right, 0).otherwise(F.col("n"))).alias("fp"))


def read_cases(reads: DataFrame, aln: DataFrame, read: str, ref: str, truth: Column) -> DataFrame:
    """(read, truth, n_refs, right) of all reads: how many references a read is aligned to, and whether its own
    is among them. Rows of reads that aren't listed don't count."""
    seen = aln.select(F.col(read).alias("_r"), F.col(ref).alias("_ref")).distinct()
    own = reads.select(F.col(read).alias("_r")).distinct().withColumn("truth", truth)
    both = own.join(seen, "_r", "left")
    return both.groupBy(F.col("_r").alias(read), "truth").agg(F.count("_ref").alias("n_refs"), F.coalesce(F.bool_or(F.col("_ref") == F.col("truth")), F.lit(False)).alias("right"))


def global_confusion(cases: DataFrame) -> DataFrame:
    """One row of tp, fp, fn, precision, recall and f1 over reads: right if aligned to its own reference at
    least once, wrong if only to others, missed if to none."""
    c = cases.agg(F.count_if("right").alias("tp"), F.count_if(~F.col("right") & (F.col("n_refs") > 0)).alias("fp"), F.count_if(F.col("n_refs") == 0).alias("fn"))
    return c.withColumns(ratios(F.col("tp"), F.col("fp"), F.col("fn")))


def reference_confusion(cases: DataFrame, aln: DataFrame, read: str, ref: str) -> DataFrame:
    """(ref, tp, fp, fn, tn, precision, recall, f1, truth_support, pred_support) of every reference that is some
    read's truth or is aligned to. Counts by reference from either side meet once, so no pair of a reference
    and a read that has nothing to do with it is looked at."""
    total = cases.agg(F.count("*").alias("_all"))
    truth = cases.groupBy(F.col("truth").alias("ref")).agg(F.count("*").alias("truth_support"), F.count_if("right").alias("tp"))
    seen = aln.join(cases.select(read), read, "left_semi").select(read, F.col(ref).alias("ref")).distinct().groupBy("ref").agg(F.count("*").alias("pred_support"))
    c = truth.join(seen, "ref", "full").crossJoin(F.broadcast(total))
    zero = lambda x: F.coalesce(F.col(x), F.lit(0))
    c = c.select("ref", "_all", zero("truth_support").alias("truth_support"), zero("pred_support").alias("pred_support"), zero("tp").alias("tp"))
    c = c.withColumns({"fp": F.col("pred_support") - F.col("tp"), "fn": F.col("truth_support") - F.col("tp")})
    c = c.withColumn("tn", F.col("_all") - F.col("tp") - F.col("fp") - F.col("fn")).drop("_all")
    return c.withColumns(ratios(F.col("tp"), F.col("fp"), F.col("fn")))


def level_metrics(members: DataFrame, counts: DataFrame, level: str, group: str) -> DataFrame:
    """(level, tp, fp, fn, precision, recall, f1, tp_reads, fp_reads): groups at each level.

    members: (level, group, ...) of what is reported; counts: (level, group, tp, fp) reads of truth. A reported
    group is right if any of its reads is; reported groups without reads don't count. A group with right
    reads that isn't reported is missed. Read totals are those of reported groups.
    """
    held = members.select(level, group).distinct().withColumn("_in", F.lit(True))
    both = counts.select(level, group, F.col("tp").alias("_tp"), F.col("fp").alias("_fp")).join(held, [level, group], "left")
    on, hit = F.coalesce("_in", F.lit(False)), F.col("_tp") > 0
    c = both.where("_tp + _fp > 0").groupBy(level).agg(
        F.count_if(on & hit).alias("tp"), F.count_if(on & ~hit).alias("fp"), F.count_if(~on & hit).alias("fn"),
        F.coalesce(F.sum(F.when(on, F.col("_tp"))), F.lit(0)).alias("tp_reads"), F.coalesce(F.sum(F.when(on, F.col("_fp"))), F.lit(0)).alias("fp_reads"))
    return c.withColumns(ratios(F.col("tp"), F.col("fp"), F.col("fn")))


def keep_masks(aln: DataFrame, read: str, ref: str, levels: list[str], score: Column) -> DataFrame:
    """All rows with `mask`: bit 0 is set, bit i if the alignment stays when reads are removed across the
    groups of levels[i - 1].

    An alignment stays if its group holds the read's best score; a reference without a group is one of its
    own, as is every reference at the level `ref` itself. All levels come from one shuffle by read. Rows
    without a read compete with none and stay.
    """
    top = F.max("_score").over(Window.partitionBy(read))
    mask = F.lit(1)
    for i, level in enumerate(levels, 1):
        own = F.max("_score").over(Window.partitionBy(read, level) if level == ref else Window.partitionBy(read, level, F.when(F.col(level).isNull(), F.col(ref))))
        mask = mask + F.when(own == top, 1 << i).otherwise(0)
    rows = aln.withColumn("_score", score)
    return rows.withColumn("mask", F.when(F.col(read).isNull(), (1 << len(levels) + 1) - 1).otherwise(mask)).drop("_score")
