"""Faceted search: counts of every facet under all filters but its own, from one pass.

Each row gets a mask of the facets whose selection it fails. A row that fails none counts for every facet; a row
that fails one counts for that one alone, as a facet's own selection doesn't filter its counts; a row that
fails more counts for none. So one aggregate gives what a query for each facet would.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def _values(rows: DataFrame, column: str) -> Column:
    """A facet's values of a row, as text; null is the empty one."""
    if isinstance(rows.schema[column].dataType, T.ArrayType):
        return F.transform(F.coalesce(F.col(column), F.array()), lambda v: F.coalesce(v.cast("string"), F.lit("")))
    return F.array(F.coalesce(F.col(column).cast("string"), F.lit("")))


def tagged(rows: DataFrame, facets: list[str], selected: Mapping[str, list[str]], terms: str = "", searched: list[str] = ()) -> DataFrame:
    """All columns and `failed` of rows that hold every search term.

    Terms are words of `terms`; each must occur, in any case, in one text of the `searched` columns, list values
    joined by commas, columns by spaces. Bit i of `failed` is set if facet i has a selection and none of the
    row's values is in it.
    """
    shown = lambda c: F.array_join(_values(rows, c), ", ")
    blob = F.lower(F.concat_ws(" ", *[shown(c) for c in searched])) if searched else F.lit("")
    hit = F.lit(True)
    for term in terms.lower().split():
        hit = hit & blob.contains(term)
    mask = F.lit(0).cast("bigint")
    for i, name in enumerate(facets):
        if selected.get(name):
            ok = F.arrays_overlap(_values(rows, name), F.array(*[F.lit(v) for v in selected[name]]))
            mask = mask + F.when(ok, 0).otherwise(1 << i)
    return rows.where(hit).withColumn("failed", mask)


def facet_counts(rows: DataFrame, facets: list[str], selected: Mapping[str, list[str]], terms: str = "", searched: list[str] = ()) -> DataFrame:
    """(facet, value, n, selected, place): how many rows have each value, under the terms and all selections but
    the facet's own; by count, then value. Empty values don't count; a list counts each of its values, repeats
    included. At most 62 facets. A facet without counts has no rows.
    """
    found = tagged(rows, facets, selected, terms, searched)
    each = []
    for i, name in enumerate(facets):
        own = F.col("failed").bitwiseAND(F.lit(~(1 << i))) == 0
        label = F.lit(name).alias("facet")
        pairs = F.transform(_values(rows, name), lambda v: F.struct(label, v.alias("value")))  # made at once, so with this label
        each.append(F.when(own, pairs).otherwise(F.array().cast("array<struct<facet:string,value:string>>")))
    counts = found.select(F.explode(F.concat(*each)).alias("x")).where("x.value <> ''").groupBy("x.facet", "x.value").agg(F.count("*").alias("n"))
    chosen = F.lit(False)
    for name, values in selected.items():
        if values:
            chosen = chosen | ((F.col("facet") == name) & F.col("value").isin(*values))
    return counts.withColumns({"selected": chosen, "place": F.row_number().over(Window.partitionBy("facet").orderBy(F.desc("n"), "value"))})


def matches(rows: DataFrame, facets: list[str], selected: Mapping[str, list[str]], terms: str = "", searched: list[str] = ()) -> DataFrame:
    """The rows that pass all terms and selections."""
    return tagged(rows, facets, selected, terms, searched).where("failed = 0").drop("failed")
