"""Records of references for scoring, from alignments alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.operators import conflict as cf
from tallyseq.operators import intervals as iv
from tallyseq.session import materialize

#: Bases of a stretch that counts as a contig, and the mapping quality that counts as high.
STRETCH, HIGH = 5_000, 20


def reference_records(aln: DataFrame, refs: DataFrame) -> DataFrame:
    """One row a reference with alignments, written once: its columns and what scores are made of.

    reads (distinct), share of all reads, mapq01 (mean, of 60), breadth before and after ambiguous reads go,
    gini of log10(1 + depth) over all its bases, disp (spread of the middles of depth runs against an even
    one's), hmf (share of high mapping quality), retention and removal of reads, minhash, read_length,
    contigs_covered of contigs. aln: read_id, ref_id, s, e, mapq, score; an alignment stays if mapq + score is
    its read's best.
    """
    score = F.col("mapq") + F.col("score")
    # rows of a read come by reference, best first: the first of each tells of the read there, so reads are not made distinct
    each = Window.partitionBy("read_id", "ref_id").orderBy(F.desc("_score"))
    rows = aln.select("ref_id", "read_id", "s", "e", "mapq", score.alias("_score")).withColumn("_no", F.row_number().over(each))
    rows = cf.best_alignments(rows, "read_id", F.col("_score"))
    rows = materialize(rows.select(
        "ref_id", "s", "e", "mapq", F.when(F.col("best"), 3).otherwise(1).alias("mask"), ((F.col("_no") == 1) & F.col("read_id").isNotNull()).alias("first")), "alignments-by-best")
    # by depth: bases, runs and the sums of their middles, and bases covered before and after
    w, middle, deep = F.col("end") - F.col("start"), (F.col("start") + F.col("end")) / 2, F.col("d0") > 0
    covered = lambda i: F.sum(F.when((F.col(f"d{i}") > 0) | F.col(f"j{i}"), w).otherwise(0))
    hist = materialize(iv.masked_runs(rows, "ref_id", "mask", 2).groupBy("ref_id", F.col("d0").alias("depth")).agg(
        F.sum(w).alias("w"), F.count_if(deep).alias("n"), F.sum(F.when(deep, middle)).alias("m"), F.sum(F.when(deep, middle * middle)).alias("mm"), covered(0).alias("bp0"), covered(1).alias("bp1")), "depth-histogram")
    mean = F.sum("m") / F.sum("n")
    whole = hist.groupBy("ref_id").agg(F.sum("bp0").alias("bp0"), F.sum("bp1").alias("bp1"), (F.sum("mm") / F.sum("n") - mean * mean).alias("spread"), F.sum(F.when(F.col("depth") > 0, F.col("w"))).alias("w"))
    bare = whole.join(refs.select("ref_id", "length"), "ref_id").select("ref_id", F.lit(0).cast("bigint").alias("depth"), (F.col("length") - F.col("w")).alias("w"))
    gini = iv.lorenz_gini(hist.where("depth > 0").select("ref_id", F.col("depth").cast("bigint").alias("depth"), "w").unionByName(bare), "ref_id", F.log10(1 + F.col("depth")), F.col("w").cast("double"))
    first, best = F.col("first"), F.col("mask") == 3
    parts = rows.groupBy("ref_id", F.floor(F.col("s") / STRETCH).alias("no")).agg(
        F.sum("mapq").alias("mapq"), F.count_if(F.col("mapq") >= HIGH).alias("high"), F.sum(F.col("e") - F.col("s")).alias("bp"), F.count("*").alias("n"),
        F.count_if(first).alias("reads"), F.count_if(first & best).alias("reads_kept"))
    parts = materialize(parts.groupBy("ref_id").agg(
        (F.sum("mapq") / F.sum("n")).alias("mapq"), (F.sum("high") / F.sum("n")).alias("hmf"), (F.sum("bp") / F.sum("n")).alias("read_length"), F.count("*").alias("contigs_covered"),
        F.sum("reads").alias("reads"), F.sum("reads_kept").alias("reads_kept")), "reference-parts")
    x = refs.join(parts, "ref_id").join(whole.drop("w"), "ref_id").join(gini, "ref_id")
    x = x.crossJoin(F.broadcast(parts.agg(F.sum("reads").alias("_all"))))
    kept = F.col("reads_kept") / F.col("reads")
    out = x.select(
        "ref_id", "species", "genus", "length", "is_plasmid", "reads", (F.col("reads") / F.col("_all")).alias("share"), (F.col("mapq") / 60).alias("mapq01"),
        (F.col("bp0") / F.col("length")).alias("breadth"), (F.col("bp1") / F.col("length")).alias("breadth_new"), "gini", F.sqrt(F.col("spread") / (F.col("length").cast("double") * F.col("length") / 12)).alias("disp"),
        "hmf", kept.alias("retention"), (1 - kept).alias("removal"), F.least(F.lit(1.0), 0.3 * (F.col("bp1") / F.col("bp0")) + 0.7 * kept).alias("minhash"), "read_length", "contigs_covered", F.lit(25).alias("contigs"))
    return materialize(out, "records")
