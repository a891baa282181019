"""Trees by parent links: closure, ancestors at a rank, subtrees and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.session import materialize


def closure(nodes: DataFrame, key: str = "taxid", parent: str = "parent", depth: int = 40) -> DataFrame:
    """(node, ancestor, distance) with the node itself at 0, by doubling: each round joins paths to paths,
    so a tree of depth d takes log2(d) rounds. Links beyond `depth` raise, as a cycle would."""
    links = nodes.where(F.col(parent).isNotNull() & (F.col(parent) != F.col(key))).select(F.col(key).alias("node"), F.col(parent).alias("ancestor"))
    known = nodes.select(F.col(key).alias("node"))
    known = known.unionByName(links.select(F.col("ancestor").alias("node"))).distinct()
    paths = materialize(known.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("distance")).unionByName(links.withColumn("distance", F.lit(1))), "closure")
    reach = 1
    while True:
        ends = paths.where(f"distance = {reach}").select("node", F.col("ancestor").alias("mid"))
        if ends.isEmpty():
            return paths
        if reach > depth:
            raise ValueError(f"a path is longer than {depth}; the links may hold a cycle")
        more = ends.join(paths.where("distance > 0").select(F.col("node").alias("mid"), "ancestor", "distance"), "mid")
        more = more.select("node", "ancestor", (F.col("distance") + reach).alias("distance"))
        paths, reach = materialize(paths.unionByName(more), "closure"), reach * 2


def at_rank(paths: DataFrame, nodes: DataFrame, rank: str, strict: bool = True, key: str = "taxid") -> DataFrame:
    """(node, at): the ancestor of that rank; when missing null if strict, else the farthest ancestor."""
    ranked = paths.join(nodes.select(F.col(key).alias("ancestor"), "rank"), "ancestor", "left")
    hit = F.min(F.when(F.col("rank") == rank, F.struct("distance", "ancestor")))["ancestor"]
    last = F.max(F.struct("distance", "ancestor"))["ancestor"]
    return ranked.groupBy("node").agg((hit if strict else F.coalesce(hit, last)).alias("at"))


def nearest_annotated(paths: DataFrame, notes: DataFrame, key: str) -> DataFrame:
    """(node, key, distance, …): the note of the nearest ancestor that has one, the node itself included."""
    cols = [c for c in notes.columns if c != key]
    hits = paths.join(notes.withColumnRenamed(key, "ancestor"), "ancestor")
    best = hits.groupBy("node").agg(F.min(F.struct("distance", "ancestor", *cols)).alias("b"))
    return best.select("node", F.col("b.ancestor").alias(key), "b.distance", *[f"b.{c}" for c in cols])


def remove_subtrees(nodes: DataFrame, paths: DataFrame, removed: DataFrame, key: str, own: str, clade: str) -> DataFrame:
    """nodes without the removed taxa and their descendants; ancestors' clade counts lose what went."""
    gone = paths.join(removed.select(F.col(key).alias("ancestor")), "ancestor").select("node").distinct()
    lost = paths.join(nodes.select(F.col(key).alias("node"), F.col(own).alias("_own")).join(gone, "node"), "node").groupBy("ancestor").agg(F.sum("_own").alias("_lost"))
    kept = nodes.join(gone.withColumnRenamed("node", key), key, "left_anti").join(lost.withColumnRenamed("ancestor", key), key, "left")
    return kept.withColumn(clade, F.col(clade) - F.coalesce("_lost", F.lit(0))).drop("_lost")


def parents_by_indent(rows: DataFrame, line: str, order: str, name: str, report: str | None = None) -> DataFrame:
    """Adds depth and parent: the line of the nearest earlier row one level up, from two-space indents.

    A row stands once as a child of its depth and once as a parent for the next, so a sorted pass is one per
    report and depth, and any depth does. A row without an earlier one a level up has a null parent.
    """
    rows = rows.withColumn("depth", (F.length(F.regexp_extract(F.col(name), "^( *)", 1)) / 2).cast("int"))
    roles = F.array(F.struct(F.col("depth").alias("at"), F.lit(False).alias("above")), F.struct((F.col("depth") + 1).alias("at"), F.lit(True).alias("above")))
    both = rows.withColumn("_role", F.explode(roles))
    so_far = Window.partitionBy(*([report] if report else []), "_role.at").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    parent = F.last(F.when(F.col("_role.above"), F.col(line)), ignorenulls=True).over(so_far)
    return both.withColumn("parent", parent).where("not _role.above").drop("_role")
