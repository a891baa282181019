"""Ambiguous reads: sharing between references, best alignments and read removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.operators.graph import connected_components
from tallyseq.session import dealt


def shared_read_pairs(aln: DataFrame, read: str = "read_id", ref: str = "ref_id", floor: float = 0.0) -> DataFrame:
    """(ref1, ref2, shared, n1, n2, jaccard) of references with common reads, ref1 < ref2.

    A read's references are distinct first; reads on one reference can't make a pair and don't travel.
    """
    seen = aln.select(F.col(read).alias("r"), F.col(ref).alias("ref")).distinct()
    n = seen.groupBy("ref").agg(F.count("*").alias("n"))
    shared = shared_read_counts(aln, read, ref)
    both = shared.join(n.select(F.col("ref").alias("ref1"), F.col("n").alias("n1")), "ref1").join(n.select(F.col("ref").alias("ref2"), F.col("n").alias("n2")), "ref2")
    both = both.withColumn("jaccard", F.col("shared") / (F.col("n1") + F.col("n2") - F.col("shared")))
    return both.where(F.col("jaccard") >= floor)


def shared_read_counts(aln: DataFrame, read: str = "read_id", ref: str = "ref_id") -> DataFrame:
    """(ref1, ref2, shared) of references with common reads, ref1 < ref2, for what needs no sizes."""
    seen = aln.select(F.col(read).alias("r"), F.col(ref).alias("ref")).distinct()
    sets = seen.groupBy("r").agg(F.sort_array(F.collect_list("ref")).alias("refs")).where(F.size("refs") > 1)
    first = sets.select(F.posexplode("refs").alias("i", "ref1"), "refs")
    pairs = first.select("ref1", F.explode(F.slice("refs", F.col("i") + 2, F.size("refs"))).alias("ref2"))
    return pairs.groupBy("ref1", "ref2").agg(F.count("*").alias("shared"))


def read_clusters(aln: DataFrame, read: str = "read_id", ref: str = "ref_id", min_shared: int = 1) -> DataFrame:
    """(node, component) of references that share at least `min_shared` reads with another.

    Where one read links, a read's references are linked to the least of them and its pairs aren't made: the
    components are the same, and a read gives a row for each reference instead of one for each pair.
    """
    if min_shared <= 1:
        low = F.min("ref2").over(Window.partitionBy("r"))
        links = aln.select(F.col(read).alias("r"), F.col(ref).alias("ref2")).withColumn("ref1", low).where("ref1 <> ref2").select("ref1", "ref2")
    else:
        links = shared_read_counts(aln, read, ref).where(F.col("shared") >= min_shared)
    return connected_components(links, "ref1", "ref2")


def supplement_pairs(known: DataFrame, more: DataFrame, a: str = "ref1", b: str = "ref2") -> DataFrame:
    """Pairs of `more` that `known` lacks in either orientation."""
    norm = lambda d: d.select(F.least(a, b).alias("_a"), F.greatest(a, b).alias("_b")).distinct()
    keyed = more.withColumn("_a", F.least(a, b)).withColumn("_b", F.greatest(a, b))
    return keyed.join(norm(known), ["_a", "_b"], "left_anti").drop("_a", "_b")


def best_alignments(aln: DataFrame, read: str, score: Column) -> DataFrame:
    """All rows with `best`: whether the row has its read's highest score; ties all keep it."""
    top = F.max(score).over(Window.partitionBy(read))
    return aln.withColumn("best", score == top)


def best_groups(aln: DataFrame, read: str, group: str, score: Column) -> DataFrame:
    """All rows with `kept`: whether their group holds the read's best score (all of the group stays)."""
    in_group = F.max(score).over(Window.partitionBy(read, group))
    overall = F.max(score).over(Window.partitionBy(read))
    return aln.withColumn("kept", in_group == overall)


def read_scores(
    aln: DataFrame, read: str, ref: str, mapq: str, own: str, pairs: DataFrame, score_weight: float = 1.0, penalty: float = 0.5, boost: float = 10.0, default_jaccard: float = 0.5,
) -> DataFrame:
    """(read, ref, read_score): mapq + weight * own - penalty * alternatives + boost * dominance.

    Alternatives of an alignment are the references that share a window with its own; `pairs` holds them
    as (ref, alt, jaccard), both ways. Dominance sums over them jaccard * log2(own reads / alternative's
    reads), so it is a value of the reference alone and no read's alternatives are expanded; a missing
    jaccard counts as `default_jaccard`, and references without reads as one read.
    """
    n = aln.groupBy(ref).agg(F.countDistinct(read).alias("_n"))
    count = lambda c: F.greatest(F.lit(1), F.coalesce(F.col(c), F.lit(1)))
    of = pairs.select(F.col("ref").alias(ref), "alt", F.coalesce("jaccard", F.lit(default_jaccard)).alias("_j"))
    of = of.join(n, ref, "left").join(n.select(F.col(ref).alias("alt"), F.col("_n").alias("_m")), "alt", "left")
    gain = of.groupBy(ref).agg(F.count("*").alias("_alt"), F.sum(F.col("_j") * F.log2(count("_n") / count("_m"))).alias("_gain"))
    score = F.col(mapq) + score_weight * F.col(own) - penalty * F.coalesce("_alt", F.lit(0)) + boost * F.coalesce("_gain", F.lit(0.0))
    return aln.join(gain, ref, "left").select(read, ref, score.alias("read_score"))


def removal_budget(counts: DataFrame, group: str, ref: str, n: str, protect: float = 3.0) -> DataFrame:
    """(group, ref, n, budget): how many reads each reference of a conflict group loses.

    With fewest = the smallest member, the largest is protected as far as it leads the second (fully from
    `protect` times on); others lose `fewest` plus the share 1 - n/max of what they have beyond it.
    """
    w = Window.partitionBy(group)
    order = Window.partitionBy(group).orderBy(F.desc(n), ref)
    x = counts.withColumns({"_min": F.min(n).over(w), "_max": F.max(n).over(w), "_rank": F.row_number().over(order), "_size": F.count("*").over(w)})
    x = x.withColumn("_second", F.max(F.when(F.col("_rank") == 2, F.col(n))).over(w))
    lead = F.least(F.greatest((F.col("_max") / F.col("_second") - 1) / (protect - 1), F.lit(0.0)), F.lit(1.0))
    base = F.when(F.col("_rank") == 1, F.col("_min") * (1 - lead)).otherwise(F.col("_min").cast("double"))
    frac = 1 - F.col(n) / F.col("_max")
    cut = F.least(F.col(n), F.floor(base + 1e-9) + F.floor(frac * F.greatest(F.lit(0.0), F.col(n) - base) + 1e-9))
    return x.where("_size > 1").select(group, ref, n, cut.cast("bigint").alias("budget"))


def drop_removed(aln: DataFrame, removed: DataFrame, read: str, ref: str, rows: int | None = None) -> DataFrame:
    """Alignments whose (reference, read) isn't on the removal list; null reads and references stay. With
    `rows`, the number of alignments, the number of tasks grows with it."""
    deal = lambda d: dealt(d, rows, ref, read) if rows is not None else d
    return deal(aln).join(deal(removed.select(read, ref)).distinct(), [ref, read], "left_anti").select(*aln.columns)


def removed_reads(aln: DataFrame, budget: DataFrame, read: str, ref: str, seed: int = 1, rows: int | None = None) -> DataFrame:
    """(ref, read): the reads to remove, `budget` of each reference in the order of a seeded hash. `rows` as in
    drop_removed."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(ref).cast("string"), F.col(read).cast("string")))
    pairs = aln.select(ref, read).distinct() if rows is None else dealt(aln.select(ref, read), rows, ref).distinct()
    pairs = pairs.join(budget.where("budget > 0").select(ref, "budget"), ref).withColumn("_draw", draw)
    order = Window.partitionBy(ref).orderBy("_draw", read)
    return pairs.withColumn("_no", F.row_number().over(order)).where("_no <= budget").select(ref, read)
