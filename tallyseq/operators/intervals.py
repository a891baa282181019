"""Half-open intervals on references: merging, depth, bins and overlap.

A reference may hold a large part of all rows. Sorted passes are therefore cut into position bins: what
a bin gives is combined over bins from one row per bin or per island.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.session import dealt

BIN = 1 << 14


def _islands(df: DataFrame, keys: list[str], s: str, e: str, gap: int, extra: list[str]) -> DataFrame:
    order = Window.partitionBy(*keys, *extra).orderBy(s, e)
    reach = F.max(e).over(order.rowsBetween(Window.unboundedPreceding, -1))
    tagged = df.withColumn("_new", (reach.isNull() | (F.col(s) > reach + gap)).cast("int"))
    tagged = tagged.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return tagged.groupBy(*keys, *extra, "_island").agg(F.min(s).alias(s), F.max(e).alias(e)).select(*keys, s, e)


def merge_intervals(df: DataFrame, keys: list[str], s: str = "s", e: str = "e", gap: int = 1, width: int = BIN, rows: int | None = None) -> DataFrame:
    """Merged intervals per key; two join if the later starts at most `gap` after the earlier's end.

    Merging is associative: bins are merged in parallel, then their few islands once more per key. With `rows`,
    the number of intervals, there are so many tasks that each sorts about TASK_ROWS of them.
    """
    deal = lambda d, *by: dealt(d, rows, *by) if rows is not None else d
    binned = df.select(*keys, s, e).where(F.col(s).isNotNull() & F.col(e).isNotNull()).withColumn("_bin", F.floor(F.col(s) / width))
    return _islands(deal(_islands(deal(binned, *keys, "_bin"), keys, s, e, gap, ["_bin"]), *keys), keys, s, e, gap, [])


def covered_length(df: DataFrame, keys: list[str], s: str = "s", e: str = "e", gap: int = 1, rows: int | None = None) -> DataFrame:
    """(keys, covered): bases under merged intervals."""
    return merge_intervals(df, keys, s, e, gap, rows=rows).groupBy(*keys).agg(F.sum(F.col(e) - F.col(s)).alias("covered"))


def _binned(ends: DataFrame, key: str, width: int) -> GroupedData:
    """ends by key, bin and position, for the sums that are read twice: by bin and by position.

    A join of both by key and bin asks for neither to be null; said here, the two readers have one plan, and
    the sums are made and shuffled once.
    """
    rows = ends.withColumn("bin", F.floor(F.col("pos") / width)).where(F.col(key).isNotNull() & F.col("bin").isNotNull())
    return rows.groupBy(key, "bin", "pos")


def masked_coverage(df: DataFrame, key: str, mask: str, bits: int, s: str = "s", e: str = "e", gap: int = 1, width: int = BIN) -> DataFrame:
    """(key, bp0, bp1, ...): bases under merged intervals of each bit's rows, from one sweep over all ends.

    A merged stretch begins where a bit's depth leaves zero and ends where it returns to it, with every
    interval open for `gap` more bases (starts come before ends at a position). What is covered is then the
    sum of the ends less the sum of the starts, so no stretch is numbered or gathered. Rows are summed per
    position first; a bin's depth comes from one row per (key, bin). Empty intervals cover nothing.
    """
    bit = lambda i, sign: F.sum(F.when((F.col("sign") == sign) & (F.col("mask").bitwiseAND(F.lit(1 << i)) != 0), 1).otherwise(0))
    ends = df.where(F.col(s) < F.col(e)).select(key, F.col(mask).alias("mask"), F.explode(F.array(
        F.struct(F.col(s).alias("pos"), F.lit(1).alias("sign")), F.struct((F.col(e) + gap).alias("pos"), F.lit(-1).alias("sign")))).alias("x")).select(key, "mask", "x.*")
    steps = _binned(ends, key, width).agg(*[bit(i, 1).alias(f"on{i}") for i in range(bits)], *[bit(i, -1).alias(f"off{i}") for i in range(bits)])
    before = Window.partitionBy(key).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = steps.groupBy(key, "bin").agg(*[F.sum(F.col(f"on{i}") - F.col(f"off{i}")).alias(f"d{i}") for i in range(bits)])
    sums = sums.select(key, "bin", *[F.coalesce(F.sum(f"d{i}").over(before), F.lit(0)).alias(f"d{i}") for i in range(bits)])
    inside = Window.partitionBy(key, "bin").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    runs = steps.withColumns({f"r{i}": F.sum(F.col(f"on{i}") - F.col(f"off{i}")).over(inside) for i in range(bits)}).join(sums, [key, "bin"])

    def covered(i: int) -> Column:
        after = F.col(f"d{i}") + F.col(f"r{i}")
        opened = (after - F.col(f"on{i}") + F.col(f"off{i}") == 0) & (F.col(f"on{i}") > 0)
        closed = (after == 0) & (F.col(f"off{i}") > 0)
        return F.sum(F.when(closed, F.col("pos") - gap).otherwise(0) - F.when(opened, F.col("pos")).otherwise(0))

    return runs.groupBy(key).agg(*[covered(i).alias(f"bp{i}") for i in range(bits)])


def masked_runs(df: DataFrame, key: str, mask: str, bits: int, s: str = "s", e: str = "e", width: int = BIN) -> DataFrame:
    """(key, start, end, d0, d1, ..., j0, j1, ...): all stretches between neighbouring starts and ends, with the
    depth of each bit's rows and whether the stretch is one base without depth between two with.

    One sweep as in depth_runs: ends are summed per position first, a bin's depth and what follows it come from
    one row per (key, bin).
    """
    one = lambda i, sign: F.sum(F.when((F.col("sign") == sign) & (F.col("mask").bitwiseAND(F.lit(1 << i)) != 0), 1).otherwise(0))
    ends = df.where(F.col(s) < F.col(e)).select(key, F.col(mask).alias("mask"), F.explode(F.array(
        F.struct(F.col(s).alias("pos"), F.lit(1).alias("sign")), F.struct(F.col(e).alias("pos"), F.lit(-1).alias("sign")))).alias("x")).select(key, "mask", "x.*")
    each = range(bits)
    steps = _binned(ends, key, width).agg(*[one(i, 1).alias(f"on{i}") for i in each], *[one(i, -1).alias(f"off{i}") for i in each])
    by_bin = Window.partitionBy(key).orderBy("bin")
    ons = F.struct("pos", *[f"on{i}" for i in each])
    bins = steps.groupBy(key, "bin").agg(*[F.sum(F.col(f"on{i}") - F.col(f"off{i}")).alias(f"n{i}") for i in each], F.min(ons).alias("first"))
    bins = bins.select(
        key, "bin", *[F.coalesce(F.sum(f"n{i}").over(by_bin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"b{i}") for i in each], F.lead("first").over(by_bin).alias("after"))
    inside = Window.partitionBy(key, "bin").orderBy("pos")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    runs = steps.withColumns({f"r{i}": F.sum(F.col(f"on{i}") - F.col(f"off{i}")).over(upto) for i in each} | {"next": F.lead(ons).over(inside)}).join(bins, [key, "bin"])
    runs = runs.withColumn("next", F.coalesce("next", "after")).where("next is not null")
    depth = lambda i: F.col(f"b{i}") + F.col(f"r{i}")
    short = F.col("next.pos") - F.col("pos") == 1
    return runs.select(
        key, F.col("pos").alias("start"), F.col("next.pos").alias("end"), *[depth(i).alias(f"d{i}") for i in each],
        *[(short & (depth(i) == 0) & (F.col(f"off{i}") > 0) & (F.col(f"next.on{i}") > 0)).alias(f"j{i}") for i in each])


def depth_runs(df: DataFrame, key: str, s: str = "s", e: str = "e", width: int = BIN, every: bool = False) -> DataFrame:
    """Runs (key, start, end, depth) of equal positive depth; touching runs of one depth are one, but with
    `every`, which ends a run wherever an interval starts or ends.

    Starts and ends are summed per position before the shuffle. A bin's first depth is the sum of all
    bins before it, taken from one row per (key, bin).
    """
    ends = df.select(key, F.explode(F.array(F.struct(F.col(s).alias("pos"), F.lit(1).alias("d")), F.struct(F.col(e).alias("pos"), F.lit(-1).alias("d")))).alias("x")).select(key, "x.*")
    steps = _binned(ends, key, width).agg(F.sum("d").alias("d")).where("d <> 0" if not every else "true")
    bins = steps.groupBy(key, "bin").agg(F.sum("d").alias("d"), F.min("pos").alias("first"))
    by_bin = Window.partitionBy(key).orderBy("bin")
    bins = bins.select(
        key, "bin", F.coalesce(F.sum("d").over(by_bin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.lead("first").over(by_bin).alias("after"))
    inside = Window.partitionBy(key, "bin").orderBy("pos")
    runs = steps.withColumn("run", F.sum("d").over(inside.rowsBetween(Window.unboundedPreceding, 0))).withColumn("next", F.lead("pos").over(inside))
    runs = runs.join(bins, [key, "bin"]).select(
        key, F.col("pos").alias("start"), F.coalesce("next", "after").alias("end"), (F.col("before") + F.col("run")).alias("depth"))
    return runs.where("depth > 0 and end is not null")


def explode_bins(df: DataFrame, s: str, e: str, width: int, name: str = "bin") -> DataFrame:
    """One row per bin that [s, e) touches; empty intervals touch none."""
    return df.where(F.col(e) > F.col(s)).withColumn(name, F.explode(F.sequence(F.floor(F.col(s) / width), F.floor((F.col(e) - 1) / width))))


def bin_coverage(merged: DataFrame, key: str, length: str, bins: int, s: str = "s", e: str = "e") -> DataFrame:
    """(key, bin, pct): percent of each of `bins` equal bins under merged intervals; the last bin is short."""
    width = F.ceil(F.col(length) / bins)
    rows = merged.withColumn("_w", width).withColumn("_e", F.least(F.col(e), F.col(length))).where(f"_e > {s}")
    rows = rows.withColumn("bin", F.explode(F.sequence(F.floor(F.col(s) / F.col("_w")), F.floor((F.col("_e") - 1) / F.col("_w")))))
    low = F.greatest(F.col(s), F.col("bin") * F.col("_w"))
    high = F.least(F.col("_e"), (F.col("bin") + 1) * F.col("_w"))
    own = F.least(F.col("_w"), F.col(length) - F.col("bin") * F.col("_w"))
    return rows.groupBy(key, "bin", own.alias("width")).agg(F.sum(high - low).alias("bp")).select(key, "bin", "width", (F.col("bp") * 100.0 / F.col("width")).alias("pct"))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], width: int = BIN, s1: str = "s", e1: str = "e", s2: str = "w_start", e2: str = "w_end") -> DataFrame:
    """Pairs of intervals that overlap (s2 < e1 and e2 > s1) with equal keys.

    Both sides go to the bins they touch and meet by equality of key and bin; a pair that shares several
    bins counts in the first of them only, so nothing is made twice and no distinct is needed.
    """
    a, b = explode_bins(left, s1, e1, width, "_bin"), explode_bins(right, s2, e2, width, "_bin")
    both = a.join(b, [*keys, "_bin"]).where((F.col(s2) < F.col(e1)) & (F.col(e2) > F.col(s1)))
    return both.where(F.col("_bin") == F.floor(F.greatest(F.col(s1), F.col(s2)) / width)).drop("_bin")


def assign_region(reads: DataFrame, regions: DataFrame, key: str, s: str = "s", e: str = "e") -> DataFrame:
    """Each read with the first region (by start) of its reference that it overlaps; regions are disjoint.

    A region is a read's first if the one before it ends at or before the read's start, so pairs are
    decided one by one and equal reads stay apart.
    """
    before = F.lag("r_end").over(Window.partitionBy(key).orderBy("r_start"))
    pairs = overlap_join(reads, regions.select(key, "r_start", "r_end", before.alias("_before")), [key], s1=s, e1=e, s2="r_start", e2="r_end")
    return pairs.where(F.col("_before").isNull() | (F.col("_before") <= F.col(s))).select(*reads.columns, "r_start", "r_end")


def gini(df: DataFrame, key: str, value: str) -> DataFrame:
    """Gini coefficient of values per key from their sorted order; equal values may stand in any order.

    Values are counted first, so the sorted pass has one row per distinct value.
    """
    counts = df.groupBy(key, F.col(value).alias("v")).agg(F.count("*").alias("m"))
    order = Window.partitionBy(key).orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("before", F.coalesce(F.sum("m").over(order), F.lit(0)))
    weighted = F.col("v") * (F.col("m") * F.col("before") + F.col("m") * (F.col("m") + 1) / 2)
    n, total = F.sum("m"), F.sum(F.col("v") * F.col("m"))
    return ranked.groupBy(key).agg(F.when(total > 0, 2 * F.sum(weighted) / (n * total) - (n + 1) / n).otherwise(F.lit(0.0)).alias("gini"))


def lorenz_gini(runs: DataFrame, key: str, depth: Column, weight: Column) -> DataFrame:
    """Gini coefficient of a weighted histogram by trapezoids under the Lorenz curve."""
    hist = runs.groupBy(key, depth.alias("v")).agg(F.sum(weight).alias("w"))
    order = Window.partitionBy(key).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(key)
    mass = F.col("v") * F.col("w")
    cum = hist.select(key, "v", "w", mass.alias("x"), F.sum(mass).over(order).alias("cx"), F.sum(mass).over(whole).alias("tx"), F.sum("w").over(whole).alias("tw"))
    area = F.sum(F.when(F.col("tx") > 0, F.col("w") / F.col("tw") * (2 * F.col("cx") - F.col("x")) / (2 * F.col("tx"))))
    return cum.groupBy(key).agg(F.coalesce(1 - 2 * area, F.lit(0.0)).alias("gini"))


def jump_segments(df: DataFrame, key: str, order: list[str], value: str, jump: float) -> DataFrame:
    """A segment number per row: a new one starts where the value moves by more than `jump`."""
    w = Window.partitionBy(key).orderBy(*order)
    flag = (F.abs(F.col(value) - F.lag(value).over(w)) > jump).cast("int")
    return df.withColumn("_flag", F.coalesce(flag, F.lit(0))).withColumn("segment", F.sum("_flag").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_flag")


def sequence_windows(df: DataFrame, length: str, width: int, step: int, least: int = 1) -> DataFrame:
    """(…, w_start, w_end): full windows every `step`; a sequence shorter than `width` is one window of its
    own length, and one shorter than `least` gives none."""
    starts = F.when(F.col(length) >= width, F.sequence(F.lit(0).cast("bigint"), (F.col(length) - width).cast("bigint"), F.lit(step).cast("bigint")))
    starts = F.when(F.col(length) < least, F.array().cast("array<bigint>")).otherwise(F.coalesce(starts, F.array(F.lit(0).cast("bigint"))))
    return df.withColumn("w_start", F.explode(starts)).withColumn("w_end", F.least(F.col("w_start") + width, F.col(length)))


def drop_unknown(windows: DataFrame, sequence: str, most: float = 0.05) -> DataFrame:
    """Windows in whose part of the sequence at most the share `most` is N."""
    part = F.substring(F.col(sequence), (F.col("w_start") + 1).cast("int"), (F.col("w_end") - F.col("w_start")).cast("int"))
    return windows.where(F.length(F.regexp_replace(part, "[^Nn]", "")) <= most * F.length(part))


def split_parts(df: DataFrame, length: str, most: int) -> DataFrame:
    """(…, part, p_start, p_end): as few near-equal parts as keep each within `most`."""
    n = F.greatest(F.lit(1), F.ceil(F.col(length) / most))
    rows = df.withColumn("_n", n).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n").cast("bigint") - 1)))
    return rows.withColumn("p_start", F.floor(F.col("part") * F.col(length) / F.col("_n"))).withColumn("p_end", F.floor((F.col("part") + 1) * F.col(length) / F.col("_n"))).drop("_n")
