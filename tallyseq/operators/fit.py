"""Truth against calls: confusion, retention, cut-offs, weights and parameter sweeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.operators import setjoin as sj
from tallyseq.operators import sketch as sk
from tallyseq.session import materialize


def confusion(df: DataFrame, keys: list[str], truth: Column, called: Column) -> DataFrame:
    """tp, fp, fn, tn, precision, recall and f1 per key in one pass; empty ratios are 0."""
    n = lambda c, name: F.count_if(c).alias(name)
    c = df.groupBy(*keys).agg(n(truth & called, "tp"), n(~truth & called, "fp"), n(truth & ~called, "fn"), n(~truth & ~called, "tn"))
    ratio = lambda a, b: F.round(F.when(b > 0, a / b).otherwise(F.lit(0.0)), 6)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)})


def retention(df: DataFrame, truth: Column, score: str, low: int, high: int) -> DataFrame:
    """(cutoff, tp, fp) of rows that score at least each whole cutoff.

    Rows are counted by whole score first; the cut-offs then sum that short histogram from above.
    """
    spark = df.sparkSession
    hist = df.groupBy(F.least(F.floor(score), F.lit(high)).alias("cutoff")).agg(F.count_if(truth).alias("p"), F.count_if(~truth).alias("n"))
    cuts = spark.range(low, high + 1).select(F.col("id").alias("cutoff"))
    w = Window.orderBy(F.desc("cutoff")).rowsBetween(Window.unboundedPreceding, 0)
    full = cuts.join(hist, "cutoff", "left")
    return full.select("cutoff", F.coalesce(F.sum("p").over(w), F.lit(0)).alias("tp"), F.coalesce(F.sum("n").over(w), F.lit(0)).alias("fp"))


def youden(df: DataFrame, group: str, truth: Column, score: str) -> DataFrame:
    """(group, cutoff, youden): the cut-off with the largest TPR - FPR; of equal ones the lowest."""
    hist = df.groupBy(group, score).agg(F.count_if(truth).alias("p"), F.count_if(~truth).alias("n"))
    w, whole = Window.partitionBy(group).orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(group)
    c = hist.withColumns({"tp": F.sum("p").over(w), "fp": F.sum("n").over(w), "pp": F.sum("p").over(whole), "nn": F.sum("n").over(whole)}).where("pp > 0 and nn > 0")
    j = F.round(F.col("tp") / F.col("pp") - F.col("fp") / F.col("nn"), 6)
    best = F.max(F.struct(j.alias("j"), (-F.col(score)).alias("s"))).alias("b")
    return c.groupBy(group).agg(best).select(group, (-F.col("b.s")).alias("cutoff"), F.col("b.j").alias("youden"))


def grid_loss(df: DataFrame, parts: list[str], truth: Column, steps: int, ridge: float = 0.01) -> DataFrame:
    """(w1, w2, ..., loss) over the simplex grid: mean log loss plus a ridge, one pass over the rows.

    Each weighting is one aggregate expression, so rows aren't multiplied by the size of the grid.
    """
    def grid(left: int, n: int):
        if n == 1:
            yield (left,)
        else:
            for a in range(left + 1):
                for rest in grid(left - a, n - 1):
                    yield (a, *rest)

    weights = [[x / steps for x in g] for g in grid(steps, len(parts))]
    aggs = []
    for i, ws in enumerate(weights):
        p = sum((F.col(c) * w for c, w in zip(parts, ws)), F.lit(0.0))
        p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
        aggs.append(F.avg(F.when(truth, -F.log(p)).otherwise(-F.log(1 - p))).alias(f"l{i}"))
    rows = [F.struct(*[F.lit(w).alias(f"w{j}") for j, w in enumerate(ws, 1)], (F.col(f"l{i}") + ridge * sum(w * w for w in ws)).alias("loss")) for i, ws in enumerate(weights)]
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def sketch_sweep(df: DataFrame, key: str, group: str, text: str, sizes: tuple[int, ...], scaled: tuple[int, ...], threshold: float) -> DataFrame:
    """(size, scaled, n_pairs, n_rows) for every sketch setting: pairs found and rows they would remove.

    Texts are hashed once, in the finest sample: a coarser one is a filter on the hash. Pairs are only counted.
    """
    cells = materialize(sk.shingle_cells(df, [key, group], text, list(sizes), min(scaled)), "sweep-hashes")
    out = None
    for size in sizes:
        for s in scaled:
            sets = cells.where((F.col("size") == size) & (F.col("hash") < (1 << 60) // s)).select(key, group, "hash")
            row = sj.pair_counts(sets, key, group, threshold).select(F.lit(size).alias("size"), F.lit(s).alias("scaled"), "n_pairs", "n_rows")
            out = row if out is None else out.unionByName(row)
    return out


def dirichlet(df: DataFrame, key: str, group: str, seed: int) -> DataFrame:
    """Adds weight: shares of a flat Dirichlet draw per group, from exponentials of a seeded hash."""
    u = (sk.md5_hash(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 8) + 1) / 4294967297.0
    return df.withColumn("_g", -F.log(u)).withColumn("weight", F.col("_g") / F.sum("_g").over(Window.partitionBy(group))).drop("_g")
