"""Merging of adjacent depth intervals while a spread stays low.

Where a segment ends depends on all of its rows, but on none before it: from a given start there is one
way on. A key's sorted rows are therefore cut into chunks that are run at the same time, each from its first
row as a guess. A chunk's true first start is where the segment that reaches into it ends, by the run of the
chunk before. Runs from a wrong and a true start mostly meet at a common start soon and are one from there, so
only chunks whose true start doesn't meet the guess change what comes after them. Rounds over the changed
chunks go on until nothing changes. Chunks hold whole multiples of the longest segment, so a stretch that
only the row limit cuts is guessed right.
"""

from __future__ import annotations

from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyseq.session import materialize, scratch
from tallyseq.sources.readers import numbered

#: Rows of a chunk, about.
CHUNK = 1 << 17


def default_jump(df: DataFrame, key: str, depth: str) -> float:
    """The depth step that still merges: one above the mean over keys of their 97.5 % quantile, rounded up."""
    q = df.groupBy(key).agg(F.percentile(F.coalesce(depth, F.lit(0.0)), 0.975).alias("q")).agg(F.ceil(F.avg("q")).alias("q")).first().q
    return float(200 if q is None else q + 1)


def allowed_gap(length: Column, share: float = 0.1, least: int = 1_000) -> Column:
    """The widest gap inside a segment: a share of the reference, or `least`, if that is more or it has no length."""
    return F.greatest(F.lit(least), F.floor(F.coalesce(length, F.lit(0)) * share))


class _Sums:
    """Counts and sums of the values up to any of a sorted list, under insertion (a Fenwick tree)."""

    def __init__(self, values: list[float]):
        self.values = sorted(set(values))
        self.count, self.total, self.touched = [0] * (len(self.values) + 1), [0.0] * (len(self.values) + 1), set()

    def upto(self, value: float) -> tuple[int, float]:
        i, n, t = bisect_left(self.values, value) + 1, 0, 0.0
        while i:
            n, t = n + self.count[i], t + self.total[i]
            i &= i - 1
        return n, t

    def add(self, value: float) -> None:
        i = bisect_left(self.values, value) + 1
        while i < len(self.count):
            self.count[i] += 1
            self.total[i] += value
            self.touched.add(i)
            i += i & -i

    def clear(self) -> None:
        for i in self.touched:
            self.count[i], self.total[i] = 0, 0.0
        self.touched.clear()


class _Segment:
    """The open segment: its extent, its count, sum and squared deviations of depths; for Gini, also the sum
    of its values times their ranks."""

    def __init__(self, start: int, end: int, depth: float, sums: _Sums | None):
        self.start, self.end, self.last = start, end, depth
        self.n, self.total, self.mean, self.m2 = 1, depth, depth, 0.0
        self.sums, self.ranked = sums, depth
        if sums is not None:
            sums.clear()
            sums.add(depth)

    def _ranked_with(self, depth: float) -> float:
        n, below = self.sums.upto(depth)
        return self.ranked + (n + 1) * depth + self.total - below  # larger values move up by one rank

    def spread_with(self, depth: float, method: str) -> float:
        if method == "jump":
            return abs(depth - self.last)
        if method == "gini":
            n, total = self.n + 1, self.total + depth
            return 0.0 if total == 0 else 2 * self._ranked_with(depth) / (n * total) - (n + 1) / n
        d = depth - self.mean
        return (self.m2 + d * (d - d / (self.n + 1))) / (self.n + 1)

    def add(self, end: int, depth: float) -> None:
        if self.sums is not None:
            self.ranked = self._ranked_with(depth)
            self.sums.add(depth)
        d = depth - self.mean
        self.n, self.total, self.end, self.last = self.n + 1, self.total + depth, end, depth
        self.mean += d / self.n
        self.m2 += d * (depth - self.mean)


def merged_runs(
    df: DataFrame, key: str, method: str, threshold: float | None, start: str = "start", end: str = "end", depth: str = "depth",
    gap: float | Column | None = None, most_rows: int = 20000, most_length: int | None = None, tolerance: float | None = None,
) -> DataFrame:
    """(key, start, end, mean_depth, n): neighbours merge while the step of depth ("jump"), their variance or
    their Gini coefficient, the new interval included, is at most `threshold`.

    A gap wider than `gap` (a number, or a column such as allowed_gap gives), a segment of `most_rows` intervals
    or longer than `most_length`, and, but for jumps, a depth further than `tolerance` from the segment's mean
    end it too. Null depths count as 0; rows without a key or position go; equal rows stand one after the
    other. An empty table gives no segments.
    """
    if method not in ("jump", "variance", "gini"):
        raise ValueError(f"unknown method {method}")
    size = most_rows * max(1, round(CHUNK / most_rows))
    kind = dict(df.dtypes)[key]
    widest = F.lit(None).cast("double") if gap is None else F.lit(gap).cast("double") if not isinstance(gap, Column) else gap.cast("double")
    names = ["key", "start", "end", "mean_depth", "n", "at", "after", "chunk", "meets"]
    out_kind = f"key {kind}, start long, end long, mean_depth double, n long, at long, after long, chunk long, meets boolean"

    def follow(rows: list[tuple], first: int, entry: int, known: set[int]) -> tuple[list[tuple], bool]:
        """Segments from `entry` on that start in the chunk, up to one of `known` starts, and whether one was met."""
        out, seg, k = [], None, None
        sums = _Sums([r[3] for r in rows]) if method == "gini" else None
        for i in range(entry - first, len(rows)):
            key_, s, e, d, g = rows[i]
            fits = seg is not None and k == key_ and seg.n < most_rows
            fits = fits and (most_length is None or e - seg.start <= most_length) and (g is None or s - seg.end <= g)
            fits = fits and (threshold is None or seg.spread_with(d, method) <= threshold)
            if fits and tolerance is not None and method != "jump":
                fits = abs(d - seg.total / seg.n) <= tolerance
            if fits:
                seg.add(e, d)
                continue
            if seg is not None:
                out.append((k, seg.start, seg.end, seg.total / seg.n, seg.n, at, first + i))
            if first + i in known:
                return out, True
            if i >= size:
                return out, False
            seg, k, at = _Segment(s, e, d, sums), key_, first + i
        if seg is not None:
            out.append((k, seg.start, seg.end, seg.total / seg.n, seg.n, at, first + len(rows)))
        return out, False

    def run(group: pd.DataFrame) -> pd.DataFrame:
        """A chunk's segments from its first row or, with another entry, those before they meet the first ones."""
        group = group.sort_values("index")
        chunk = int(group["chunk"].iloc[0])
        gaps = [None if x != x else x for x in group["g"].tolist()]
        rows = list(zip(group["k"].tolist(), group["s"].tolist(), group["e"].tolist(), group["d"].tolist(), gaps))
        entry = int(group["entry"].iloc[0])
        found, met = follow(rows, chunk * size, chunk * size, set())
        if entry != chunk * size:
            known = {x[5] for x in found}
            last = found[-1][6]
            found, met = follow(rows, chunk * size, entry, known)
            after = last if met else found[-1][6] if found else entry
            # where the guess takes over is the last segment's end; a row without a segment says it if there is none
            found = [(*x, chunk, met) for x in found] + [(None, None, None, None, None, found[-1][6] if found else entry, after, chunk, met)]
            return pd.DataFrame(found, columns=names, dtype=object)
        return pd.DataFrame([(*x, chunk, False) for x in found], columns=names, dtype=object)

    rows = df.where(F.col(key).isNotNull() & F.col(start).isNotNull() & F.col(end).isNotNull()).select(
        F.col(key).alias("k"), F.col(start).cast("long").alias("s"), F.col(end).cast("long").alias("e"), F.coalesce(F.col(depth).cast("double"), F.lit(0.0)).alias("d"), widest.alias("g"))
    with scratch(df.sparkSession) as keep:
        placed = numbered(rows, [F.col(c) for c in ("k", "s", "e", "d")])
        chunk, offset = F.floor(F.col("index") / size), F.col("index") % size
        # a segment that starts in a chunk ends in the next one's first `most_rows` rows at the latest, and one more tells so
        both = F.when((offset <= most_rows) & (chunk > 0), F.array(chunk, chunk - 1)).otherwise(F.array(chunk))
        placed = materialize(placed.withColumn("chunk", F.explode(both)), "segment-rows")
        first = materialize(placed.withColumn("entry", F.col("chunk") * size).groupBy("chunk").applyInPandas(run, out_kind), "segments")
        exits = first.groupBy("chunk").agg(F.max("after").alias("after"))
        entries = exits.select(F.col("chunk").alias("c"), (F.col("chunk") * size).alias("entry"))
        done = None
        while True:
            # the entry that the chunk before leads to; the first chunk and chunks without rows have none
            leads = exits.select((F.col("chunk") + 1).alias("chunk"), F.col("after").alias("entry"))
            wanted = leads.join(entries.withColumnRenamed("entry", "was"), F.col("chunk") == F.col("c")).where("entry <> was").select("chunk", "entry")
            wanted = materialize(wanted, "segment-entries")
            if wanted.isEmpty():
                break
            new = materialize(placed.join(wanted.where(F.col("entry") != F.col("chunk") * size), "chunk").groupBy("chunk").applyInPandas(run, out_kind), "segment-repairs")
            entries = materialize(entries.join(wanted.withColumnRenamed("chunk", "c").withColumnRenamed("entry", "_new"), "c", "left").select("c", F.coalesce("_new", "entry").alias("entry")), "segment-starts")
            last = new.where("n is null").select("chunk", F.col("after").alias("_after"))
            guess = wanted.where(F.col("entry") == F.col("chunk") * size).select("chunk").join(first.groupBy("chunk").agg(F.max("after").alias("_after")), "chunk")
            exits = materialize(exits.join(last.unionByName(guess), "chunk", "left").select("chunk", F.coalesce("_after", "after").alias("after")), "segment-exits")
            done = new if done is None else materialize(done.join(wanted.select("chunk"), "chunk", "left_anti").unionByName(new), "segment-repaired")
        if done is not None:
            # of a repaired chunk's guess, what comes after the meeting stays
            met = done.groupBy("chunk").agg(F.max(F.when(F.col("n").isNull() & F.col("meets"), F.col("at"))).alias("_from"), F.bool_or(F.col("n").isNull()).alias("_fixed"))
            old = first.join(met, "chunk", "left").where("_fixed is null or not _fixed or at >= _from").drop("_from", "_fixed")
            first = old.unionByName(done.where("n is not null"))
        out = first.select(F.col("key").alias(key), "start", "end", "mean_depth", "n")
        return keep(materialize(out, "merged-runs"))
