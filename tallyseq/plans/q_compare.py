"""Queries that compare samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyseq.operators import compare as cm
from tallyseq.operators import intervals as iv
from tallyseq.operators import segment as sg
from tallyseq.plans.base import query
from tallyseq.session import materialize

R = lambda c, n=6: F.round(c, n).alias(c)
_quoted = lambda words: ", ".join(f"'{w}'" for w in words)


@query("cooccurrence_means", "R4", uses="det", sql="""
WITH r AS (SELECT organism, sample, max(tass) AS v FROM det GROUP BY organism, sample),
m AS (SELECT organism FROM r GROUP BY organism ORDER BY count(*) DESC, organism LIMIT 40), k AS (SELECT * FROM r JOIN m USING (organism))
SELECT a.organism AS a, b.organism AS b, count(*) AS shared, round(avg((a.v + b.v) / 2), 6) AS mean_value FROM k a JOIN k b ON a.sample = b.sample AND a.organism <= b.organism GROUP BY 1, 2""")
def cooccurrence_means(t):
    return cm.value_cooccurrence(t.det, "organism", "sample", "tass", 40).select("a", "b", "shared", R("mean_value"))


_MEMBERS = """mem AS (SELECT ref_id, part_id % 4 AS sample, s, e, length FROM aln JOIN refs USING (ref_id))"""


def _members(t):
    return t.aln.join(F.broadcast(t.refs.select("ref_id", "length")), "ref_id").withColumn("sample", F.col("part_id") % 4)


def _bins_sql(name, keys):
    """Percent of bins of 5000 bases under the union of a key's intervals, by marking every base range."""
    k = ", ".join(keys)
    on = " AND ".join(f"f.{c} = h.{c}" for c in keys)
    return f"""
{name}_o AS (SELECT *, max(e) OVER (PARTITION BY {k} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM mem),
{name}_n AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY {k} ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS no FROM {name}_o),
{name}_i AS (SELECT {k}, min(s) AS s, least(max(e), max(length)) AS e, max(length) AS length FROM {name}_n GROUP BY {k}, no),
{name}_b AS (SELECT {k}, s, e, length, unnest(range(s // 5000, (e - 1) // 5000 + 1)) AS b FROM {name}_i WHERE e > s),
{name} AS (SELECT {k}, b AS bin, max(length) AS length, round(least(100, sum(least(e, (b + 1) * 5000) - greatest(s, b * 5000)) * 100.0 / max(least(5000, length - b * 5000))), 1) AS pct
 FROM {name}_b GROUP BY {k}, b)"""


@query("coverage_union", "R7", uses="aln refs", sql=f"""WITH {_MEMBERS}, {_bins_sql('u', ['ref_id'])}, {_bins_sql('p', ['ref_id', 'sample'])}
SELECT u.ref_id, u.bin, any_value(u.pct) AS union_pct, max(p.pct) AS max_pct FROM u JOIN p ON u.ref_id = p.ref_id AND u.bin = p.bin GROUP BY u.ref_id, u.bin""")
def coverage_union(t):
    return cm.combined_coverage(_members(t), "ref_id", "sample", "length", 5000)


@query("profile_points", "R8", uses="aln refs", sql=f"""WITH {_MEMBERS}, {_bins_sql('p', ['ref_id', 'sample'])},
x AS (SELECT DISTINCT ref_id, sample, CAST(ceil(length / 5000.0) AS BIGINT) AS n FROM mem), pts AS (SELECT ref_id, sample, n, i FROM x, range(0, 8) AS g(i)),
v AS (SELECT pts.ref_id, pts.sample, i, coalesce(sum(pct), 0) / ((i + 1) * any_value(n) // 8 - i * any_value(n) // 8) AS value FROM pts LEFT JOIN p ON p.ref_id = pts.ref_id AND p.sample = pts.sample AND bin >= i * n // 8 AND bin < (i + 1) * n // 8 GROUP BY pts.ref_id, pts.sample, i)
SELECT ref_id, i AS point, round(avg(value), 6) AS mean_value, round(median(value), 6) AS median_value FROM v GROUP BY ref_id, i""")
def profile_points(t):
    m = _members(t).withColumn("n", F.ceil(F.col("length") / 5000))
    sizes = m.groupBy("ref_id", "sample").agg(F.max("n").alias("n"))
    values = cm.downsampled(cm.coverage_bins(m, ["ref_id", "sample"], "length", 5000, rows=t.lineitem.count()).join(sizes, ["ref_id", "sample"]), ["ref_id", "sample"], "n", 8)
    every = sizes.select("ref_id", "sample", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(7).cast("bigint"))).alias("point"))
    x = every.join(values, ["ref_id", "sample", "point"], "left").na.fill(0.0, ["value"])
    return x.groupBy("ref_id", "point").agg(F.round(F.avg("value"), 6).alias("mean_value"), F.round(F.median("value"), 6).alias("median_value"))


@query("method_shares", "R15", uses="det", sql="""
WITH s AS (SELECT segment, sum(reads)::DOUBLE AS n, sum(CASE WHEN tass >= 60 THEN reads ELSE 0 END)::DOUBLE AS a, sum(CASE WHEN mapq >= 20 THEN reads ELSE 0 END)::DOUBLE AS k,
 sum(CASE WHEN coverage > 45 THEN reads ELSE 0 END)::DOUBLE AS sp, sum(CASE WHEN coverage < 20 THEN reads ELSE 0 END)::DOUBLE AS h FROM det GROUP BY segment)
SELECT segment, round(a / n, 6) AS align, round(greatest(0, k / n - a / n), 6) AS k2_only, round(sp / n, 6) AS species, round(h / n, 6) AS high_rank, round(least(1, greatest(0, (n - (greatest(k, a) + sp)) / n)), 6) AS dark FROM s""")
def method_shares(t):
    n = lambda cond: F.sum(F.when(cond, F.col("reads")).otherwise(0)).cast("double")
    c = F.col
    s = t.det.groupBy("segment").agg(F.sum("reads").cast("double").alias("n"), n(c("tass") >= 60).alias("a"), n(c("mapq") >= 20).alias("k"), n(c("coverage") > 45).alias("sp"), n(c("coverage") < 20).alias("h"))
    shares = cm.method_shares(c("n"), c("a"), c("k"), c("sp"), c("h"), (c("n") - (F.greatest("k", "a") + c("sp"))) / c("n"))
    return s.select("segment", *shares).select("segment", *[R(x) for x in ("align", "k2_only", "species", "high_rank", "dark")])


@query("capability_notices", "R18", uses="det", sql="""
WITH s AS (SELECT DISTINCT sample FROM det), ani AS (SELECT sample FROM det WHERE high_consequence AND tass >= 60), hist AS (SELECT sample FROM det WHERE coverage >= 70)
SELECT sample, 'ani' AS lacks FROM s WHERE sample NOT IN (SELECT sample FROM ani) UNION ALL SELECT sample, 'histogram' FROM s WHERE sample NOT IN (SELECT sample FROM hist)""")
def capability_notices(t):
    return cm.lacking(t.det, "sample", {"ani": t.det.where("high_consequence and tass >= 60"), "histogram": t.det.where("coverage >= 70")})


@query("specimen_names", "R16", uses="samples", sql="""
WITH m AS (SELECT sample, CASE site % 3 WHEN 0 THEN ' S' || site || ' ' WHEN 1 THEN '' END AS specimen, CASE WHEN site % 2 = 0 THEN country END AS specimen_group, CASE WHEN site % 7 = 0 THEN 'joined' END AS o FROM samples)
SELECT coalesce(o, nullif(trim(specimen), ''), nullif(trim(specimen_group), ''), sample) AS specimen, CASE WHEN o IS NOT NULL THEN 'override' WHEN coalesce(nullif(trim(specimen), ''), specimen_group) IS NOT NULL THEN 'metadata' ELSE 'sample' END AS origin,
 count(*) AS n, string_agg(sample, ';' ORDER BY sample) AS members FROM m GROUP BY 1, 2""")
def specimen_names(t):
    k = F.col("site")
    meta = t.samples.select("sample", F.when(k % 3 == 0, F.concat(F.lit(" S"), k.cast("string"), F.lit(" "))).when(k % 3 == 1, "").alias("specimen"), F.when(k % 2 == 0, F.col("country")).alias("specimen_group"))
    named = cm.specimens(meta, "sample", cm.SPECIMEN_FIELDS, t.samples.where("site % 7 = 0").select("sample", F.lit("joined").alias("specimen")))
    return named.groupBy("specimen", "origin").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("sample")), ";").alias("members"))


_CELLS = {"country": "n_name", "sites": "CAST(c_nationkey AS STRING)", "latitude_like": "CAST(c_custkey * 3 - 80 AS STRING)", "notes": "concat('seen at ', n_name, ' by day ', CAST(c_custkey AS STRING))", "one": "'x'",
          "platform": "CASE WHEN c_custkey % 3 = 0 THEN 'NA' WHEN c_custkey % 3 = 1 THEN ' ont ' ELSE 'illumina' END", "sampling_site": "concat('site ', CAST(c_custkey % 40 AS STRING), ' of the western field')"}
_CELL_ROWS = " UNION ALL ".join(f"SELECT c_custkey AS record, '{k}' AS key, {v} AS value FROM c" for k, v in _CELLS.items())


@query("groupable_columns", "R21", sql=f"""
WITH c AS (SELECT c_custkey, c_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey), x AS ({_CELL_ROWS}),
r AS (SELECT record, key, trim(value) AS v FROM x WHERE lower(trim(value)) NOT IN ('', 'null', 'na', 'nan')),
s AS (SELECT key, count(DISTINCT v) AS d, count(DISTINCT record) AS f, count(*) AS cells, sum(CASE WHEN try_cast(v AS DOUBLE) IS NOT NULL THEN 1 ELSE 0 END) AS num, avg(length(v)) AS chars, avg(len(string_split(v, ' '))) AS words, key IN ('platform', 'sampling_site') AS preferred FROM r GROUP BY key)
SELECT key, d AS n_values, f AS filled, preferred FROM s WHERE d >= 2 AND NOT (d > 50 AND d > f / 2) AND NOT (num * 10 >= cells * 9 AND d > 12) AND (preferred OR (NOT (f >= 4 AND d * 10 >= f * 9) AND words <= 2.5 AND chars <= 32))""")
def groupable_columns(t):
    # a small file is one task, which would hold the different values of all its cells: rows are dealt out first,
    # to a fixed number of tasks, since few bytes would be joined to one again
    n = int(t.customer.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    c = t.customer.select("c_custkey", "c_nationkey").repartition(n, "c_custkey").join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.expr(v).alias("value")) for k, v in _CELLS.items()]))  # one pass for all columns
    rows = c.select(F.col("c_custkey").alias("record"), cells.alias("c")).select("record", "c.key", "c.value")
    return cm.groupable_columns(rows, "record", "key", "value", ["platform", "sampling_site"])


_HAS = lambda words: " OR ".join(f"contains(lower(kingdom), '{w}')" for w in words)
_BUCKET = f"""CASE WHEN domain IN ('Bacteria', 'Archaea') THEN domain WHEN domain IN ('Viruses', 'Virus') THEN 'Viruses'
 WHEN domain = 'Eukaryota' THEN CASE {' '.join(f"WHEN {_HAS(w)} THEN '{b}'" for b, w in cm.EUKARYOTES.items())} ELSE 'OtherEuk' END {' '.join(f"WHEN {_HAS(w)} THEN '{b}'" for b, w in cm.KINGDOMS.items())} END"""


@query("view_rows", "F5 F10 F11", uses="view", sql=f"""
SELECT sample, organism, category, {_BUCKET} AS bucket FROM view v WHERE (regexp_matches(organism, 'brand#[1-4]', 'i')) AND coalesce(category, 'Unknown') IN ('Primary', 'Potential', 'Unknown') AND {_BUCKET} IN ('Bacteria', 'Viruses', 'Plantae', 'OtherEuk')
 AND lower(coalesce(mol_type, '')) <> 'rna' AND NOT EXISTS (SELECT 1 FROM view w WHERE w.tass < 20 AND w.sample = v.sample AND w.organism = v.organism)""")
def view_rows(t):
    x = cm.view_filter(t.view, "brand#[1-4]", scope="organism", categories=["Primary", "Potential", "Unknown"], kingdoms=["Bacteria", "Viruses", "Plantae", "OtherEuk"],
                       mol_types=("dna", "both"), watched=t.view.where("tass < 20"), watch="hide")
    return x.select("sample", "organism", "category", cm.kingdom_bucket(F.col("domain"), F.col("kingdom")).alias("bucket"))


@query("watched_rows", "F10 F11", uses="view", sql=f"""
SELECT sample, organism, {_BUCKET} AS bucket FROM view v WHERE (regexp_matches(sample, 'BUILD') OR regexp_matches(organism, 'BUILD')) AND high_consequence AND EXISTS (SELECT 1 FROM view w WHERE w.tass >= 50 AND w.sample = v.sample AND w.organism = v.organism)""")
def watched_rows(t):
    x = cm.view_filter(t.view, "BUILD", ignore_case=False, high_consequence=True, watched=t.view.where("tass >= 50"), watch="only")
    return x.select("sample", "organism", cm.kingdom_bucket(F.col("domain"), F.col("kingdom")).alias("bucket"))


_RESCUE = """
g AS (SELECT *, max(tass) OVER (PARTITION BY sample, genus) AS genus_tass FROM view), r AS (SELECT sample, organism, site + 100 AS taxid, site AS subkey, organism AS species, genus, CASE WHEN site % 2 = 0 THEN reads ELSE 0 END AS reads, tass, tass AS species_tass, genus_tass FROM g),
ge AS (SELECT DISTINCT sample, organism FROM view WHERE tass < 40 AND high_consequence),
ca AS (SELECT sample, CASE WHEN site % 3 = 0 THEN 'Species' ELSE 'genus' END AS rank, CASE WHEN site % 6 = 3 THEN site ELSE NULL END AS taxid, CASE WHEN site % 3 = 0 THEN upper(organism) ELSE genus END AS name FROM view WHERE tass > 60)"""


@query("rescued_rows", "F13", uses="view", sql=f"""WITH {_RESCUE},
f AS (SELECT r.*, EXISTS (SELECT 1 FROM ge WHERE ge.sample = r.sample AND ge.organism = r.organism) AS gene,
 EXISTS (SELECT 1 FROM ca WHERE ca.sample = r.sample AND lower(rank) = 'species' AND (ca.taxid = r.taxid OR ca.taxid = r.subkey OR lower(ca.name) IN (lower(r.species), lower(r.organism)))) AS sp,
 EXISTS (SELECT 1 FROM ca WHERE ca.sample = r.sample AND rank = 'genus' AND lower(ca.name) = lower(r.genus)) AS gen FROM r WHERE greatest(tass, species_tass, genus_tass) < 70)
SELECT sample, organism, CASE WHEN gene THEN 'belowCutoffVFAMR' WHEN reads > 0 THEN 'belowCutoffAligned' ELSE 'noveltyNoAlign' END AS tag, CASE WHEN gene THEN NULL WHEN sp THEN 'sp' WHEN gen THEN 'gen' END AS novelty FROM f WHERE gene OR reads > 0 OR sp OR gen""")
def rescued_rows(t):
    v, k = t.view, F.col("site")
    best = v.groupBy("sample", "genus").agg(F.max("tass").alias("genus_tass"))
    rows = v.join(best, ["sample", "genus"]).select(
        "sample", "organism", (k + 100).alias("taxid"), k.alias("subkey"), F.col("organism").alias("species"), "genus", F.when(k % 2 == 0, F.col("reads")).otherwise(0).alias("reads"), "tass", F.col("tass").alias("species_tass"), "genus_tass")
    cand = v.where("tass > 60").select("sample", F.when(k % 3 == 0, "Species").otherwise("genus").alias("rank"), F.when(k % 6 == 3, k).alias("taxid"), F.when(k % 3 == 0, F.upper("organism")).otherwise(F.col("genus")).alias("name"))
    return cm.rescues(rows, v.where("tass < 40 and high_consequence"), cand, 70).select("sample", "organism", "tag", "novelty")


def _vector_sql(c):
    return f"round(avg({c}), 6) AS {c}_mean, round(median({c}), 6) AS {c}_median, min({c}) AS {c}_least, max({c}) AS {c}_most"


@query("sample_vectors", "A42", uses="det", sql=f"""
WITH s AS (SELECT DISTINCT sample FROM det), o AS (SELECT DISTINCT organism FROM det), f AS (SELECT organism, sample, coalesce(tass, 0) AS tass, coalesce(coverage, 0) AS coverage, tass IS NOT NULL AS seen FROM o CROSS JOIN s LEFT JOIN det USING (organism, sample))
SELECT organism, count(*) FILTER (WHERE seen) AS detected, count(*) FILTER (WHERE seen AND tass >= 50) AS passing, count(*) FILTER (WHERE seen AND tass < 50) AS below, round(count(*) FILTER (WHERE seen) * 100.0 / count(*), 6) AS prevalence_pct,
 {_vector_sql('tass')}, {_vector_sql('coverage')}, string_agg(round(tass, 1)::VARCHAR, ',' ORDER BY tass) AS vector FROM f GROUP BY organism""")
def sample_vectors(t):
    n = t.det.select("sample").distinct().count()
    x = cm.sample_vectors(t.det, "organism", "sample", ["tass", "coverage"], 50, n)
    stats = [f"{c}_{s}" for c in ("tass", "coverage") for s in ("mean", "median", "least", "most")]
    return x.select("organism", "detected", "passing", "below", R("prevalence_pct"), *[R(c) if c.endswith(("mean", "median")) else c for c in stats],
                    F.array_join(F.transform("tass_vector", lambda v: F.round(v, 1).cast("string")), ",").alias("vector"))


@query("field_totals", "A44", uses="det", sql="""
WITH h AS (SELECT det.*, unnest(string_split(CASE site % 4 WHEN 0 THEN 'fever;cough' WHEN 1 THEN 'cough' WHEN 2 THEN 'rash;fever' ELSE 'Unknown' END, ';')) AS field_value FROM det)
SELECT field_value, count(DISTINCT sample) AS samples, count(*) AS detections, sum(reads)::BIGINT AS reads, round(avg(tass), 6) AS mean_value FROM h GROUP BY field_value""")
def field_totals(t):
    k = F.col("site")
    d = t.det.withColumn("signs", F.when(k % 4 == 0, "fever; cough;fever").when(k % 4 == 1, "cough").when(k % 4 == 2, "rash;fever"))
    return cm.field_totals(d, "signs", ";", "sample", "reads", "tass").select("field_value", "samples", "detections", "reads", R("mean_value"))


@query("hierarchy_sums", "A48 R19", uses="view", sql="""
WITH n AS (SELECT CASE WHEN domain = '' THEN 'Unknown domain' ELSE domain END AS domain, kingdom AS phylum, coalesce(category, 'Unknown class') AS class, genus, organism, greatest(reads - 20, 0) AS v FROM view)
SELECT domain, phylum, class, genus, organism, (5 - grouping(domain) - grouping(phylum) - grouping(class) - grouping(genus) - grouping(organism))::INT AS depth, sum(v)::BIGINT AS value FROM n GROUP BY ROLLUP (domain, phylum, class, genus, organism)""")
def hierarchy_sums(t):
    v = t.view.withColumns({"phylum": F.col("kingdom"), "class": F.col("category"), "v": F.col("reads") - 20})
    return cm.hierarchy_sums(v, ["domain", "phylum", "class", "genus"], "organism", "v")


@query("spread_segments", "W9", uses="aln", sql=None)
def spread_segments(t):
    """Segments of a reference's depth by the three rules; each depends on all before it, so no SQL."""
    runs = materialize(iv.depth_runs(t.aln, "ref_id"), "depth-runs")  # read four times
    out = [sg.merged_runs(runs, "ref_id", m, limit, gap=1000).withColumn("method", F.lit(m)) for m, limit in (("jump", sg.default_jump(runs, "ref_id", "depth")), ("variance", 2.0), ("gini", 0.2))]
    return out[0].unionByName(out[1]).unionByName(out[2])
