"""Mixing sources to target weights by capped water-filling and seeded repetition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.llm.words import WORD
from tallyseq.session import materialize

#: Up to this many sources (under 20 MB of rows) the plan is broadcast; beyond it, joined by shuffle.
MAX_BROADCAST_SOURCES = 100_000


def water_fill(sizes: DataFrame, share: float, epochs: float) -> DataFrame:
    """(source_no, weight, source_size) -> the same with `target`.

    share * total words are dealt out in proportion to weight; a source never gets more than epochs
    times its size, and what it can't take is dealt again among the others. The fixed point has every
    source below its cap at weight * level. Sources sorted by cap / weight fill up in that order, so the
    level follows from running sums: a source is capped when the level that would hold if it and all
    later ones were open reaches its cap. One row a source; sums of whole words are exact.
    """
    order = Window.orderBy((F.col("source_size") / F.col("weight")), "source_no")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    run = sizes.withColumns({
        "total": F.sum("source_size").over(whole),
        "weights": F.sum("weight").over(whole),
        "full_before": F.coalesce(F.sum("source_size").over(upto), F.lit(0)),
        "weight_before": F.coalesce(F.sum("weight").over(upto), F.lit(0)),
    })
    level = (F.lit(share) * F.col("total") - F.lit(epochs) * F.col("full_before")) / (F.col("weights") - F.col("weight_before"))
    run = run.withColumn("level", level)
    capped = F.col("level") * F.col("weight") >= F.lit(epochs) * F.col("source_size")
    run = run.withColumn("capped", capped)
    final = F.min(F.when(~F.col("capped"), F.struct("full_before", "weight_before", "level"))).over(whole)
    run = run.withColumn("open", final)
    return run.select(
        "source_no", "weight", "source_size",
        F.when(F.col("capped"), F.lit(epochs) * F.col("source_size")).otherwise(F.col("open.level") * F.col("weight")).alias("target"),
    )


def draw_key(seed: int, key: Column, text: Column) -> Column:
    """A seeded 128-bit draw per row in hex; rows without a key draw by their text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.md5(F.coalesce(text, F.lit(""))))))


def _source_key(source: str) -> Column:
    """One non-null key in code-point order with null last, so that plain equality joins serve."""
    return F.coalesce(F.concat(F.lit("a"), F.col(source)), F.lit("b"))


def _plan(docs: DataFrame, key: str, text: str, source: str, weights: tuple[int, ...], share: float, epochs: float, seed: int) -> tuple:
    """(narrow rows, one row per source with its target, whole repetitions and last draw taken once more, broadcast or not)."""
    rows = docs.select(
        F.col(key).alias("k"),
        _source_key(source).alias("sk"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        draw_key(seed, F.col(key), F.col(text)).alias("draw"),
    ).withColumn("bucket", F.substring("draw", 1, 3))
    rows = materialize(rows, "mix")
    parts = rows.groupBy("sk", "bucket").agg(F.sum("size").alias("words"))
    turn = F.row_number().over(Window.orderBy("sk")) - 1
    ws = F.array(*[F.lit(int(w)).cast("bigint") for w in weights])
    sources = parts.groupBy("sk").agg(F.sum("words").alias("source_size")).withColumn("source_no", turn)
    sources = materialize(sources.withColumn("weight", F.element_at(ws, (F.col("source_no") % len(weights) + 1).cast("int"))), "mix-sources")
    small = sources.count() <= MAX_BROADCAST_SOURCES
    hint = F.broadcast if small else lambda df: df
    plan = water_fill(sources.drop("sk"), share, epochs).join(sources.select("sk", "source_no"), "source_no")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = plan.withColumn("whole", F.floor(ratio)).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = materialize(plan.select("sk", "source_size", "target", "whole", "rest"), "mix-plan")

    # The bucket that holds the cut: the last one that starts before `rest` words are taken.
    upto = Window.partitionBy("sk").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("start", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    held = starts.join(plan.select("sk", "rest"), "sk").where("start < rest")
    held = held.groupBy("sk", "rest").agg(F.max(F.struct("bucket", "start")).alias("at")).select("sk", "rest", "at.bucket", "at.start")
    held = materialize(held, "mix-held")
    inside = rows.join(hint(held), ["sk", "bucket"])
    ties = inside.groupBy("sk", "draw", "rest", "start").agg(F.sum("size").alias("words"))
    run = F.sum("words").over(Window.partitionBy("sk").orderBy("draw"))
    cut = (
        ties.withColumn("end", F.col("start") + run).where("2 * end - words <= 2 * rest")
        .groupBy("sk").agg(F.max("draw").alias("last"))
    )
    low = held.select("sk", "bucket").join(cut, "sk", "left").select("sk", F.coalesce("last", "bucket").alias("cut"))
    decided = plan.join(low, "sk", "left").select("sk", "source_size", "target", "whole", "cut")
    return rows, hint(decided)


def _times() -> Column:
    return (F.col("whole") + F.coalesce((F.col("draw") <= F.col("cut")).cast("bigint"), F.lit(0))).cast("bigint")


def mix_sources(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: float = 2.0, seed: int = 17,
) -> DataFrame:
    """How many times the mix takes every row: (key, source, size, source_size, target, times).

    Sources in code-point order, null last, take the weights in turn. A source whose target is r times
    its size takes each of its rows floor(r) times; for the rest, rows in the order of a seeded draw are
    taken once more until their words come nearest to it, so the error is at most half of one text.
    Rows with the same key and source share a draw and its fate. A source without words has target 0.
    An empty input gives an empty result; null texts have size 0; other columns are not read.

    Only one row per source, and the rows of the one draw bucket in each source that holds the cut, meet
    in a window; all other rows are decided where they are read.
    """
    rows, decided = _plan(docs, key, text, source, weights, share, epochs, seed)
    return rows.join(decided, "sk").select(
        F.col("k").alias(key), F.when(F.col("sk") != "b", F.substring("sk", 2, 2147483647)).alias(source),
        "size", "source_size", "target", _times().alias("times"),
    )


def repeat_rows(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: float = 2.0, seed: int = 17,
) -> DataFrame:
    """The mixture itself: every row of docs, with its own columns, as often as mix_sources says."""
    _, decided = _plan(docs, key, text, source, weights, share, epochs, seed)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    tagged = docs.select(row.alias("row"), _source_key(source).alias("sk"), draw_key(seed, F.col(key), F.col(text)).alias("draw"))
    times = tagged.join(decided, "sk").select("row", _times().alias("times")).where("times > 0")
    return times.select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("row.*")
