"""Comparisons across samples: value co-occurrence, joint coverage, views, rescues and column profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyseq.operators import intervals as iv

#: Cells that count as empty in metadata.
EMPTY_CELLS = ("", "null", "na", "nan")
#: Metadata fields that name a sample's specimen, first match wins.
SPECIMEN_FIELDS = ("specimen", "specimen_id", "specimen id", "specimenid", "specimen_group", "specimen group")
#: Domain names and words in kingdom names, with the bucket that they mean.
DOMAINS = {"Bacteria": "Bacteria", "Archaea": "Archaea", "Viruses": "Viruses", "Virus": "Viruses"}
EUKARYOTES = {"Fungi": ("fung", "mycota"), "Plantae": ("plant", "viridiplant", "streptophyt"), "Animalia": ("animal", "metazoa")}
KINGDOMS = {
    "Bacteria": ("bacteri",), "Viruses": ("virus", "virae"), "Archaea": ("archae",), "Fungi": ("fung",),
    "Plantae": ("plant", "viridiplant"), "Animalia": ("animal", "metazoa"),
}


def value_cooccurrence(df: DataFrame, item: str, sample: str, value: str, top: int) -> DataFrame:
    """(a, b, shared, mean_value) over the `top` items found in most samples (ties by name), a <= b.

    Off the diagonal the mean, over samples with both, of the two values' mean; on it the item's own mean.
    A sample gives at most top * (top + 1) / 2 pairs, however many items it holds.
    """
    rows = df.groupBy(item, sample).agg(F.max(value).alias("v"))
    most = rows.groupBy(item).agg(F.count("*").alias("n")).orderBy(F.desc("n"), item).limit(top).select(item)
    rows = rows.join(F.broadcast(most), item)
    a, b = rows.select(F.col(item).alias("a"), sample, F.col("v").alias("va")), rows.select(F.col(item).alias("b"), sample, F.col("v").alias("vb"))
    both = a.join(b, sample).where("a <= b")
    return both.groupBy("a", "b").agg(F.count("*").alias("shared"), F.avg((F.col("va") + F.col("vb")) / 2).alias("mean_value"))


def coverage_bins(df: DataFrame, keys: list[str], length: str, width: int, s: str = "s", e: str = "e", rows: int | None = None) -> DataFrame:
    """(keys, bin, pct): percent of each bin of `width` bases, the last one short, under the union of all
    intervals of the key; one decimal. Bins without coverage give no row. `rows` as in merge_intervals."""
    sizes = df.groupBy(*keys).agg(F.max(length).alias("_len"))
    islands = iv.merge_intervals(df, keys, s, e, gap=0, rows=rows).join(sizes, keys).withColumn(e, F.least(e, "_len"))
    touched = iv.explode_bins(islands, s, e, width)
    low, high = F.col("bin") * width, F.least((F.col("bin") + 1) * width, F.col("_len"))
    part = touched.select(*keys, "bin", (F.least(e, high) - F.greatest(s, low)).alias("_bp"), (high - low).alias("_w"))
    pct = F.round(F.least(F.lit(100.0), F.sum("_bp") * 100 / F.max("_w")), 1)
    return part.groupBy(*keys, "bin").agg(pct.alias("pct"))


def combined_coverage(df: DataFrame, key: str, sample: str, length: str, width: int) -> DataFrame:
    """(key, bin, union_pct, max_pct): samples of a key joined exactly, by the union of their intervals, and
    as the largest single sample, which is a lower bound of it."""
    union = coverage_bins(df, [key], length, width).withColumnRenamed("pct", "union_pct")
    top = coverage_bins(df, [key, sample], length, width).groupBy(key, "bin").agg(F.max("pct").alias("max_pct"))
    return union.join(top, [key, "bin"])


def downsampled(bins: DataFrame, keys: list[str], size: str, points: int) -> DataFrame:
    """(keys, point, value): profiles of `size` bins (bin, pct; absent bins are 0) as `points` means; a
    profile of at most `points` bins stays as it is. Bin j falls to the point whose share of the bins ends
    after it."""
    n, j = F.col(size), F.col("bin")
    point = F.when(n <= points, j).otherwise(F.ceil((j + 1) * points / n).cast("bigint") - 1)
    first = lambda p: F.floor(p * n / points)
    count = F.when(n <= points, F.lit(1)).otherwise(first(F.col("point") + 1) - first(F.col("point")))
    rows = bins.select(*keys, size, point.cast("bigint").alias("point"), "pct")
    return rows.groupBy(*keys, size, "point").agg(F.sum("pct").alias("_s")).select(*keys, "point", (F.col("_s") / count).alias("value"))


def specimens(samples: DataFrame, sample: str, fields: list[str], overrides: DataFrame | None = None) -> DataFrame:
    """(sample, specimen, origin): a user's override, else the first filled metadata field, else the sample."""
    text = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    have = {c.lower(): c for c in samples.columns}
    found = [text(have[f]) for f in fields if f in have]
    rows = samples.select(sample, F.coalesce(*found, F.lit(None).cast("string")).alias("_m"))
    if overrides is not None:
        rows = rows.join(overrides.select(sample, F.nullif(F.col("specimen"), F.lit("")).alias("_o")), sample, "left")
    else:
        rows = rows.withColumn("_o", F.lit(None).cast("string"))
    origin = F.when(F.col("_o").isNotNull(), "override").when(F.col("_m").isNotNull(), "metadata").otherwise("sample")
    return rows.select(sample, F.coalesce("_o", "_m", F.col(sample).cast("string")).alias("specimen"), origin.alias("origin"))


def groupable_columns(cells: DataFrame, record: str, key: str, value: str, preferred: list[str]) -> DataFrame:
    """Columns fit for grouping, of long records (record, key, value): (key, n_values, filled, preferred).

    Out go columns with fewer than two values, with over 50 that are also over half of the filled records,
    numbers with over 12 values, and, unless preferred, near-unique ones and prose.
    """
    v = F.trim(F.col(value))
    rows = cells.where(v.isNotNull() & ~F.lower(v).isin(*EMPTY_CELLS)).select(record, F.col(key).alias("key"), v.alias("v"))
    words = F.size(F.split("v", r"\s+"))
    s = rows.groupBy("key").agg(
        F.countDistinct("v").alias("n_values"), F.countDistinct(record).alias("filled"), F.count("*").alias("_cells"),
        F.count_if(F.col("v").try_cast("double").isNotNull()).alias("_numeric"), F.avg(F.length("v")).alias("_chars"), F.avg(words).alias("_words"))
    d, f = F.col("n_values"), F.col("filled")
    s = s.withColumn("preferred", F.lower("key").isin(*preferred))
    few = (d >= 2) & ~((d > 50) & (d > f / 2)) & ~((F.col("_numeric") * 10 >= F.col("_cells") * 9) & (d > 12))
    plain = ~((f >= 4) & (d * 10 >= f * 9)) & (F.col("_words") <= 2.5) & (F.col("_chars") <= 32)
    return s.where(few & (F.col("preferred") | plain)).select("key", "n_values", "filled", "preferred")


def kingdom_bucket(domain: Column, kingdom: Column) -> Column:
    """The filter bucket of a row, null if unknown; domains count before words in the kingdom's name."""
    d, k = F.trim(F.coalesce(domain, F.lit(""))), F.lower(F.trim(F.coalesce(kingdom, F.lit(""))))
    has = lambda words: reduce(lambda a, b: a | b, [F.contains(k, F.lit(w)) for w in words])
    chain = lambda table: reduce(lambda c, kv: c.when(has(kv[1]), kv[0]), list(table.items())[1:], F.when(has(next(iter(table.values()))), next(iter(table))))
    out = reduce(lambda c, kv: c.when(d == kv[0], kv[1]), list(DOMAINS.items())[1:], F.when(d == "Bacteria", "Bacteria"))
    return out.when(d == "Eukaryota", chain(EUKARYOTES).otherwise("OtherEuk")).otherwise(chain(KINGDOMS))


def view_filter(
    df: DataFrame, text: str | None = None, ignore_case: bool = True, scope: str = "both", high_consequence: bool = False,
    categories: list[str] | None = None, kingdoms: list[str] | None = None, mol_types: tuple[str, ...] = ("dna", "rna", "both"),
    watched: DataFrame | None = None, watch: str = "all",
) -> DataFrame:
    """Rows of a view (sample, organism, category, domain, kingdom, mol_type, high_consequence).

    `scope` says where the text pattern is looked for; `watch` keeps ("only") or drops ("hide") rows whose
    (sample, organism) is in `watched`. Absent categories are Unknown; a kingdom filter drops unknown ones.
    """
    if text:
        hit = lambda c: F.coalesce(F.col(c).rlike(("(?i)" if ignore_case else "") + text), F.lit(False))
        df = df.where({"sample": hit("sample"), "organism": hit("organism")}.get(scope, hit("sample") | hit("organism")))
    if high_consequence:
        df = df.where("high_consequence")
    if categories:
        df = df.where(F.coalesce("category", F.lit("Unknown")).isin(*categories))
    if kingdoms:
        df = df.where(kingdom_bucket(F.col("domain"), F.col("kingdom")).isin(*kingdoms))
    m = F.lower(F.coalesce("mol_type", F.lit("")))
    df = df.where(F.when(m.isin("dna", "rna"), m).otherwise("both").isin(*mol_types))
    if watched is not None and watch != "all":
        df = df.join(watched.select("sample", "organism").distinct(), ["sample", "organism"], "left_semi" if watch == "only" else "left_anti")
    return df


def rescues(rows: DataFrame, genes: DataFrame, candidates: DataFrame, cutoff: float) -> DataFrame:
    """Rows that fail the cut-off at strain, species and genus but carry a signal, with the reason.

    rows: (sample, organism, taxid, subkey, species, genus, reads, tass, species_tass, genus_tass); genes:
    (sample, organism); candidates of novelty: (sample, rank, taxid, name). Adds tag (belowCutoffVFAMR,
    belowCutoffAligned or noveltyNoAlign) and novelty ("sp", "gen" or null). Rows with a gene come once.
    """
    failing = rows.where(F.col("tass").isNotNull() & (F.greatest("tass", "species_tass", "genus_tass") < cutoff))
    low = lambda c: F.nullif(F.lower(F.trim(F.col(c))), F.lit(""))
    cand = candidates.select("sample", F.lower("rank").alias("_r"), F.col("taxid").cast("string").alias("_t"), low("name").alias("_n"))
    species, genera = cand.where("_r = 'species'"), cand.where("_r = 'genus'")
    # each key is an equality of its own, so no condition with OR turns into a nested loop
    keys = species.select("sample", F.explode(F.array(F.concat(F.lit("t:"), "_t"), F.concat(F.lit("n:"), "_n"))).alias("_k")).where("_k is not null").distinct()
    own = F.array(F.concat(F.lit("t:"), F.col("taxid").cast("string")), F.concat(F.lit("t:"), F.col("subkey").cast("string")), F.concat(F.lit("n:"), low("species")), F.concat(F.lit("n:"), low("organism")))
    id_ = ["sample", "organism"]
    sp = failing.select(*id_, F.explode(own).alias("_k")).join(keys, ["sample", "_k"], "left_semi").select(*id_).distinct().withColumn("_sp", F.lit(True))
    gen = genera.select("sample", F.col("_n").alias("_g")).where("_g is not null").distinct().withColumn("_gen", F.lit(True))
    gene = genes.select(*id_).distinct().withColumn("_gene", F.lit(True))
    x = failing.withColumn("_g", low("genus")).join(sp, id_, "left").join(gen, ["sample", "_g"], "left").join(gene, id_, "left")
    novelty = F.when(F.col("_sp"), "sp").when(F.col("_gen"), "gen")
    tag = F.when(F.col("_gene"), "belowCutoffVFAMR").when(F.col("reads") > 0, "belowCutoffAligned").when(novelty.isNotNull(), "noveltyNoAlign")
    return x.select(*rows.columns, tag.alias("tag"), F.when(F.col("_gene"), None).otherwise(novelty).alias("novelty")).where("tag is not null")


def method_shares(total: Column, aligned: Column, k2: Column, species: Column, high: Column, dark: Column) -> list[Column]:
    """Shares of all reads by the method that explains them, each within 0 and 1; without reads all are 0."""
    part = lambda x: F.coalesce(F.when(total > 0, x / total), F.lit(0.0))
    clip = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    return [
        clip(part(aligned)).alias("align"), clip(part(k2) - part(aligned)).alias("k2_only"), clip(part(species + high) - part(high)).alias("species"),
        clip(part(high)).alias("high_rank"), clip(dark).alias("dark")]


def sample_vectors(df: DataFrame, item: str, sample: str, values: list[str], cutoff: float, n_samples: int) -> DataFrame:
    """Per item: samples with it, passing and below, prevalence, and for each value its mean, median, least
    and largest over all samples, with a zero for every sample without the item, plus the sorted vector.

    The zeros are added to the sorted values of the item's own samples, so nothing is crossed.
    """
    first = values[0]
    per = df.groupBy(item, sample).agg(*[F.max(v).alias(v) for v in values])
    aggs = [F.sort_array(F.collect_list(v)).alias(f"_{v}") for v in values]
    x = per.groupBy(item).agg(F.count("*").alias("detected"), F.count_if(F.col(first) >= cutoff).alias("passing"), F.count_if(F.col(first) < cutoff).alias("below"), *aggs)
    out = [item, "detected", "passing", "below", (F.col("detected") * 100 / n_samples).alias("prevalence_pct")]
    for v in values:
        zeros = F.array_repeat(F.lit(0.0), (F.lit(n_samples) - F.size(f"_{v}")).cast("int"))
        a = F.sort_array(F.concat(zeros, F.col(f"_{v}").cast("array<double>")))
        out += [
            (F.aggregate(a, F.lit(0.0), lambda s, y: s + y) / n_samples).alias(f"{v}_mean"),
            ((F.get(a, F.lit((n_samples - 1) // 2)) + F.get(a, F.lit(n_samples // 2))) / 2).alias(f"{v}_median"),
            F.array_min(a).alias(f"{v}_least"), F.array_max(a).alias(f"{v}_most"), a.alias(f"{v}_vector")]
    return x.select(*out)


def field_totals(df: DataFrame, field: str, separator: str, sample: str, reads: str, value: str) -> DataFrame:
    """Samples, detections, reads and mean value by each of a metadata field's values; a cell may hold
    several, and counts for each of them once. Empty cells fall to Unknown."""
    parts = F.array_distinct(F.filter(F.transform(F.split(F.coalesce(F.col(field), F.lit("")), separator), lambda x: F.trim(x)), lambda x: x != ""))
    rows = df.withColumn("field_value", F.explode(F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("Unknown")))))
    return rows.groupBy("field_value").agg(F.countDistinct(sample).alias("samples"), F.count("*").alias("detections"), F.sum(reads).alias("reads"), F.avg(value).alias("mean_value"))


def hierarchy_sums(df: DataFrame, levels: list[str], leaf: str, value: str) -> DataFrame:
    """Sums at every level of a hierarchy; a missing rank is `Unknown {rank}`, negative values count as 0,
    and a level above which the sum stands is null. depth: how many levels a row names."""
    named = [F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(f"Unknown {c}")).alias(c) for c in levels]
    rows = df.select(*named, leaf, F.greatest(F.col(value), F.lit(0)).alias("_v"))
    cols = [*levels, leaf]
    grouped = rows.rollup(*cols).agg(F.sum("_v").alias("value"), (F.lit(len(cols)) - reduce(lambda a, b: a + b, [F.grouping(c).cast("int") for c in cols])).alias("depth"))
    return grouped.select(*cols, "depth", "value")


def lacking(samples: DataFrame, sample: str, tests: dict[str, DataFrame]) -> DataFrame:
    """(sample, lacks): every sample that a capability's table does not name, one row per gap."""
    all_ = samples.select(sample).where(F.col(sample).isNotNull()).distinct()
    gaps = [all_.join(have.select(sample).distinct(), sample, "left_anti").withColumn("lacks", F.lit(name)) for name, have in tests.items()]
    return reduce(lambda a, b: a.unionByName(b), gaps)
