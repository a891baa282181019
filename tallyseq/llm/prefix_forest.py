"""Approximate nearest neighbours by inner product with a hash-prefix forest.

Every tree is a sorted array of long hash strings: signs of projections against thresholds at a sample's
medians. A query descends to its longest prefix matches and ascends in all trees at once, one bit at a
time, until the ranges that share its prefix hold `reach` times the number of distinct vectors, counted
over all trees, and k + 1 vectors in one tree at least. All vectors in those ranges are ranked by their exact inner product. Inner products
become angles by one more coordinate, which gives all indexed vectors the same length.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.llm.sampling import hash_sample
from tallyseq.session import materialize

#: Distinct vectors that projections' medians are taken from, about, and aimed at in a shard.
SAMPLE, SHARD = 4_096, 8_192
BITS = 32


def usable(vectors: DataFrame, key: str, vec: str, query: Column) -> DataFrame:
    """(id, v, q) of rows with a key and a finite vector that isn't zero; float components stay float."""
    kind = vectors.schema[vec].dataType.simpleString()
    v = F.col(vec) if kind in ("array<float>", "array<double>") else F.col(vec).cast("array<double>")
    rows = vectors.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"), v.alias("v"), query.alias("q"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return rows.where(F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def distinct_vectors(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(vid, ids, v) of distinct vectors of (id, v, q) with the k+1 smallest keys each, and (qid, vid) of queries.

    More than k+1 equal vectors can't all be near: they tie, and the smallest keys win. The ranking
    limit works within map tasks first, so a vector that fills a third of the table travels k+1 times a
    task.
    """
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    kept = rows.select("id", "v").withColumn("no", first).where(F.col("no") <= k + 1)
    nodes = kept.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.element_at("ids", 1).alias("vid"), "ids", "v")
    nodes = materialize(nodes, "forest-vectors")
    asked = materialize(rows.where("q").select(F.col("id").alias("qid"), "v").join(nodes.select("vid", "v"), "v").select("qid", "vid"), "forest-queries")
    return nodes, asked


class Hasher:
    """Projections and thresholds of all trees, fitted to a bounded sample."""

    def __init__(self, sample: np.ndarray, longest: float, trees: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.longest, self.trees = longest, trees
        self.planes = rng.standard_normal((trees * BITS, sample.shape[1] + 1))
        self.cut = np.median(self._index(sample) @ self.planes.T, axis=0)

    def _index(self, x: np.ndarray) -> np.ndarray:
        x = x / self.longest
        return np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, keepdims=True)))], axis=1)

    def hashes(self, x: np.ndarray, query: bool) -> np.ndarray:
        """trees x rows."""
        x = np.concatenate([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros((len(x), 1))], axis=1) if query else self._index(x)
        bits = (x @ self.planes.T > self.cut).reshape(len(x), self.trees, BITS)
        return (bits @ (np.int64(1) << np.arange(BITS - 1, -1, -1))).T


def hashed(rows: DataFrame, hasher: Hasher, query: bool, shard_bits: int, with_vector: bool) -> DataFrame:
    """(tree, shard, h, vid[, v]) for every tree."""
    import pyarrow as pa

    names = ["tree", "shard", "h", "vid"] + ["v"] * with_vector

    def batches(it):
        for b in it:
            x = np.array(b.column(1).flatten().to_numpy(zero_copy_only=False), float).reshape(b.num_rows, -1)
            if not len(x):
                continue
            for t, h in enumerate(hasher.hashes(x, query)):
                cols = [pa.array(np.full(len(h), t, np.int32)), pa.array(h >> (BITS - shard_bits)), pa.array(h), b.column(0)]
                yield pa.RecordBatch.from_arrays(cols + [b.column(1)] * with_vector, names)

    kind = "tree int, shard long, h long, vid long" + f", v {rows.schema['v'].dataType.simpleString()}" * with_vector
    return rows.select("vid", "v").mapInArrow(batches, kind)


def choose_levels(index: DataFrame, asked: DataFrame, shard_bits: int, target: int) -> DataFrame:
    """(vid, level): the longest prefix at which all trees together hold the target; 0 if none does."""
    import pyarrow as pa

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        h, q, vid = np.sort(left.column("h").to_numpy()), right.column("h").to_numpy(), right.column("vid").to_numpy()
        out = []
        for level in range(shard_bits, BITS + 1):
            low = (q >> (BITS - level)) << (BITS - level)
            n = np.searchsorted(h, low + (1 << (BITS - level))) - np.searchsorted(h, low)
            live = n > 0
            q, vid, n = q[live], vid[live], n[live]
            if not len(q):
                break
            out.append((vid, np.full(len(q), level), n))
        cols = [np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out) if out else [[]] * 3)]
        return pa.table({n: pa.array(c.astype(np.int64)) for n, c in zip(("vid", "level", "n"), cols)})

    own = index.groupBy("tree", "shard").cogroup(asked.groupBy("tree", "shard")).applyInArrow(count, "vid long, level long, n long")
    if shard_bits:
        levels = F.explode(F.sequence(F.lit(0), F.lit(shard_bits - 1))).alias("level")
        prefix = lambda: F.expr(f"shiftright(shard, {shard_bits} - level)").alias("prefix")
        held = index.groupBy("tree", "shard").agg(F.count("*").alias("n")).select("tree", "shard", "n", levels)
        held = held.groupBy("tree", "level", prefix()).agg(F.sum("n").alias("n"))
        above = asked.select("tree", "shard", "vid", levels).select("tree", "level", prefix(), "vid").join(held, ["tree", "level", "prefix"])
        own = own.unionByName(above.select("vid", F.col("level").cast("bigint").alias("level"), "n"))
    total = own.groupBy("vid", "level").agg(F.sum("n").alias("n"))
    return total.groupBy("vid").agg(F.coalesce(F.max(F.when(F.col("n") >= target, F.col("level"))), F.lit(0)).alias("level"))


def rank_ranges(index: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(q, c, score): per query and shard, the k+1 best vectors of the query's range."""
    import pyarrow as pa

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        h = left.column("h").to_numpy()
        order = np.argsort(h, kind="stable")
        h, vid = h[order], left.column("vid").to_numpy()[order]
        grid = lambda t: t.column("v").combine_chunks().flatten().to_numpy().astype(float).reshape(t.num_rows, -1)
        x = grid(left)[order] if len(h) else np.zeros((0, 1))
        q, qh, qid, level = grid(right) if right.num_rows else None, right.column("h").to_numpy(), right.column("vid").to_numpy(), right.column("level").to_numpy()
        low = (qh >> (BITS - level)) << (BITS - level)
        a, b = np.searchsorted(h, low), np.searchsorted(h, low + (1 << (BITS - level)))
        out = []
        by = np.lexsort((b, a))  # queries with the same range share one product
        edges = np.flatnonzero(np.diff(a[by], prepend=-1) | np.diff(b[by], prepend=-1)) if len(by) else []
        for s, e in zip(edges, [*edges[1:], len(by)]):
            for at in np.array_split(by[s:e], -(-(e - s) // 256)):
                lo, hi = a[at[0]], b[at[0]]
                if lo == hi:
                    continue
                found = x[lo:hi] @ q[at].T
                if hi - lo > k + 1:
                    best = np.argpartition(-found, k, axis=0)[: k + 1]
                    worst = np.take_along_axis(found, best, axis=0).min(axis=0)
                    c, j = np.nonzero(found >= worst - 1e-9 * np.abs(worst) - 1e-300)
                else:
                    c, j = map(np.ravel, np.indices(found.shape))
                score = (x[lo + c] * q[at[j]]).sum(axis=1)
                # ties of the last place are cut by the smaller vector, so a query sends k + 1 rows at most
                order = np.lexsort((vid[lo + c], -score, j))
                c, j, score = c[order], j[order], score[order]
                start = np.flatnonzero(np.diff(j, prepend=-1))
                top = np.arange(len(j)) - np.repeat(start, np.diff(np.append(start, len(j)))) <= k
                c, j, score = c[top], j[top], score[top]
                out.append((qid[at[j]], vid[lo + c], score))
        cols = [np.concatenate(y) for y in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("q", "c", "score"), map(pa.array, cols))))

    return index.groupBy("tree", "shard").cogroup(asked.groupBy("tree", "shard")).applyInArrow(rank, "q long, c long, score double")


def nearest_neighbours(
    vectors: DataFrame, query: Column, key: str = "vec_id", vec: str = "embedding", k: int = 20, trees: int = 16, reach: float = 0.7,
) -> DataFrame:
    """(query_id, rank, key, score): the k nearest found for every row where `query` holds, itself excluded.

    Nearness is the largest inner product in double precision, ties go to the smaller key; with fewer
    than k other rows all of them. Rows with a null key, and vectors null, empty, zero or holding null
    or non-finite components, take no part. Vectors of another dimension have no product with a query;
    every dimension is searched by itself. Repeated rows count as equal vectors; a key that occurs twice
    is left out of its own result both times. Empty input: empty result; other columns are not read. With
    reach >= 1 * trees the search is exhaustive; `reach` 0.7 found over 0.9 of the true neighbours on
    vectors without any structure, where no index can do with few candidates (see README).
    """
    rows = usable(vectors, key, vec, query)
    sizes = sorted(r[0] for r in rows.select(F.size("v")).distinct().collect())
    parts = [_search(rows.where(F.size("v") == d), key, k, trees, reach) for d in sizes or [0]]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _search(rows: DataFrame, key: str, k: int, trees: int, reach: float) -> DataFrame:
    nodes, asked = distinct_vectors(rows, k)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    n, longest = nodes.agg(F.count("*"), F.max(norm)).first()
    if not n:
        return asked.select(F.col("qid").alias("query_id"), F.lit(1).alias("rank"), F.col("vid").alias(key), F.lit(0.0).alias("score")).where("false")
    sample = np.array([r[0] for r in hash_sample(nodes, F.col("vid"), SAMPLE, n).select("v").collect()])
    hasher = Hasher(sample, longest, trees)
    bits = max(0, min(BITS, math.floor(math.log2(n / SHARD)))) if n > SHARD else 0
    queries = asked.select("vid").distinct().join(nodes, "vid")
    q_hash = materialize(hashed(queries, hasher, True, bits, True), "forest-asked")
    levels = choose_levels(hashed(nodes, hasher, False, bits, False), q_hash.drop("v"), bits, max(math.ceil(reach * n), trees * min(n, k + 1)))
    upto = F.expr(f"shiftleft(1L, cast({bits} - least(level, {bits}) as int))")
    base = F.expr(f"shiftleft(shiftright(shard, cast({bits} - least(level, {bits}) as int)), cast({bits} - least(level, {bits}) as int))")
    sent = q_hash.join(levels, "vid").withColumn("shard", F.explode(F.sequence(base, base + upto - 1)))
    found = rank_ranges(hashed(nodes, hasher, False, bits, True), sent, k)
    found = found.groupBy("q", "c").agg(F.max("score").alias("score"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    found = found.withColumn("no", F.row_number().over(best)).where(F.col("no") <= k + 1)
    found = found.join(nodes.select(F.col("vid").alias("c"), "ids"), "c").select("q", "score", F.explode("ids").alias("id"))
    pairs = asked.withColumnRenamed("vid", "q").join(found, "q").where("id <> qid")
    final = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
    return (
        pairs.dropDuplicates(["qid", "id"]).withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
        .select(F.col("qid").alias("query_id"), "rank", F.col("id").alias(key), "score")
    )
