"""Connected components by alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyseq.session import delete, materialize

#: A node with more edges than this share of all is a hub; its edges stay where they are.
HUB_SHARE, HUB_LEAST = 1 / 2_000, 500


def _with_low(edges: DataFrame, low: DataFrame, n_edges: int) -> DataFrame:
    """edges with `m`, the value that `low` has for u.

    A hub's edges would all meet in one task of a shuffled join, so hubs join by broadcast: at most
    2 / HUB_SHARE rows, as every edge counts for two nodes. All other nodes join by shuffle.
    """
    least = max(HUB_LEAST, int(n_edges * HUB_SHARE))
    hubs = F.broadcast(low.where(F.col("n") > least).select("u", F.col("m").alias("hub_m")))
    tagged = edges.join(hubs, "u", "left")
    rest = tagged.where("hub_m is null").drop("hub_m").join(low.where(F.col("n") <= least).select("u", "m"), "u")
    return tagged.where("hub_m is not null").withColumnRenamed("hub_m", "m").unionByName(rest)


def _large_star(edges: DataFrame, n_edges: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    return _with_low(both.where("v > u"), low, n_edges).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, n_edges: int) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = _with_low(edges, low, n_edges).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Undirected edges -> (node, component): component is the smallest node reachable.

    Works on any orderable node type. Self loops give a component of one node; rows with a null end are
    dropped, repeated edges count once, an empty input gives an empty result. Every round writes its
    edges to the shared folder and deletes the round before; rounds grow with the logarithm of the graph's
    size. Only a count and a checksum reach the driver.
    """
    raw = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    loops = raw.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    now = materialize(raw.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    mark = _mark(now)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        large = materialize(_large_star(now, mark[0]).where("u <> v").distinct(), "cc-large")
        delete(now.sparkSession, now.shared_path)
        now = materialize(_small_star(large, mark[0]).where("u <> v").distinct(), "cc")
        delete(large.sparkSession, large.shared_path)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    joined = members.unionByName(roots).unionByName(loops)
    return joined.groupBy("node").agg(F.min("component").alias("component"))
