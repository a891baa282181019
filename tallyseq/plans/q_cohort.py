"""Cohort and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.functions import formulas as fx
from tallyseq.operators import cohort as co
from tallyseq.plans.base import query

R = lambda c, n=6: F.round(c, n).alias(c)


@query("specimen_collapse", "A41", uses="det", sql="""SELECT segment, organism, sum(reads)::BIGINT AS reads, max(coverage) AS coverage, round(sum(mapq * reads) / sum(reads), 6) AS mapq, round(median(tass), 6) AS tass, count(*) AS n_merged,
 round(sum(reads) * 1e6 / sum(sum(reads)) OVER (PARTITION BY segment), 4) AS rpm FROM det GROUP BY segment, organism""")
def specimen_collapse(t):
    x = co.collapse(t.det, ["segment", "organism"], ["reads"], ["coverage"], ["mapq"], "reads", "tass", "median")
    return x.select("segment", "organism", "reads", "coverage", R("mapq"), R("tass"), "n_merged", F.round(F.col("reads") * 1e6 / F.sum("reads").over(Window.partitionBy("segment")), 4).alias("rpm"))


@query("specimen_collapse_modes", "A41", uses="det", sql="""SELECT segment, organism, round(avg(tass), 6) AS mean, max(tass) AS max, min(tass) AS min, round(avg(CASE WHEN tass > 0 THEN tass END), 6) AS detection FROM det GROUP BY segment, organism""")
def specimen_collapse_modes(t):
    d = t.det
    return d.groupBy("segment", "organism").agg(F.round(F.avg("tass"), 6).alias("mean"), F.max("tass").alias("max"), F.min("tass").alias("min"), F.round(F.avg(F.when(F.col("tass") > 0, F.col("tass"))), 6).alias("detection"))


_PASS = """
g AS (SELECT *, tass >= 55 AS own, max(tass) OVER (PARTITION BY sample, genus) AS gt, max(tass) OVER (PARTITION BY segment, organism) AS st FROM det)"""


@query("rollup_rescue", "F8", uses="det", sql=f"""WITH {_PASS}
SELECT sample, organism, own OR st >= 95 OR gt >= 85 AS passes, NOT own AND (st >= 95 OR gt >= 85) AS rescued, CASE WHEN NOT own AND st >= 95 THEN 'species' WHEN NOT own AND gt >= 85 THEN 'genus' END AS rescue_level FROM g""")
def rollup_rescue(t):
    x = t.det.withColumns({"gt": F.max("tass").over(Window.partitionBy("sample", "genus")), "st": F.max("tass").over(Window.partitionBy("segment", "organism"))})
    return co.rollup_rescue(x, F.col("tass") >= 55, F.col("st") >= 95, F.col("gt") >= 85).select("sample", "organism", "passes", "rescued", "rescue_level")


@query("species_injection", "F9", uses="det", sql="""
WITH s AS (SELECT sample, genus, tass >= 70 AS p FROM det), u AS (SELECT sample, genus, avg(tass) >= 50 AS p FROM det GROUP BY sample, genus), a AS (SELECT sample, genus, bool_or(p) AS any_p, count(*) AS n FROM s GROUP BY sample, genus)
SELECT sample, genus, 'strain' AS level, 0::BIGINT AS n_rescued FROM s WHERE p UNION ALL SELECT sample, genus, 'species', n FROM a JOIN u USING (sample, genus) WHERE u.p AND NOT any_p""")
def species_injection(t):
    strains = t.det.select("sample", "genus", (F.col("tass") >= 70).alias("p"))
    species = t.det.groupBy("sample", "genus").agg((F.avg("tass") >= 50).alias("p"))
    return co.inject_species(strains, species, ["sample", "genus"], "p")


@query("subkey_promotion", "F12 F4 F5", uses="det", sql="SELECT sample, organism, tass FROM det d WHERE reads >= 30 AND (tass >= 60 OR EXISTS (SELECT 1 FROM det e WHERE e.sample = d.sample AND e.genus = d.genus AND e.tass >= 80))")
def subkey_promotion(t):
    up = t.det.groupBy("sample", "genus").agg(F.max("tass").alias("top")).where("top >= 80").select("sample", "genus", F.lit(True).alias("up"))
    return t.det.where("reads >= 30").join(up, ["sample", "genus"], "left").where("tass >= 60 or up").select("sample", "organism", "tass")


@query("category_inclusion", "F6 F11 E6 E7", uses="det", sql="""
WITH c AS (SELECT *, CASE substr(organism, 8, 1) WHEN '1' THEN 'Primary' WHEN '2' THEN 'Opportunistic' WHEN '3' THEN 'Potential' WHEN '4' THEN 'Commensal' ELSE 'Unknown' END AS category, site % 5 = 0 AS sterile FROM det)
SELECT category, sterile, count(*) AS n, sum((category = 'Primary' OR sterile OR (category = 'Opportunistic') OR high_consequence)::INT)::BIGINT AS included FROM c GROUP BY category, sterile""")
def category_inclusion(t):
    digit = F.substring("organism", 8, 1)
    cat = F.when(digit == "1", "Primary").when(digit == "2", "Opportunistic").when(digit == "3", "Potential").when(digit == "4", "Commensal").otherwise("Unknown")
    c = t.det.withColumns({"category": cat, "sterile": F.col("site") % 5 == 0})
    take = (F.col("category").isin("Primary", "Opportunistic")) | F.col("sterile") | F.col("high_consequence")
    return c.groupBy("category", "sterile").agg(F.count("*").alias("n"), F.count_if(take).alias("included"))


@query("below_cutoff_rescues", "F13", uses="det", sql="""
SELECT sample, organism, CASE WHEN high_consequence THEN 'gene' WHEN reads > 100 THEN 'belowCutoffAligned' WHEN genus = 'Brand#1' THEN 'noveltyNoAlign' END AS tag FROM det WHERE tass < 50 AND (high_consequence OR reads > 100 OR genus = 'Brand#1')""")
def below_cutoff_rescues(t):
    tag = F.when(F.col("high_consequence"), "gene").when(F.col("reads") > 100, "belowCutoffAligned").when(F.col("genus") == "Brand#1", "noveltyNoAlign")
    return t.det.where("tass < 50").select("sample", "organism", tag.alias("tag")).where("tag is not null")


@query("prevalence", "A42 R2 A43 T5", uses="det", sql="""
WITH s AS (SELECT DISTINCT sample FROM det), o AS (SELECT DISTINCT organism FROM det), f AS (SELECT organism, sample, coalesce(tass, 0) AS v, tass IS NOT NULL AS seen FROM o CROSS JOIN s LEFT JOIN det USING (organism, sample))
SELECT organism, sum(seen::INT)::BIGINT AS detected, sum((seen AND v >= 50)::INT)::BIGINT AS passing, sum((seen AND v < 50)::INT)::BIGINT AS below, round(sum(seen::INT) * 100.0 / count(*), 6) AS prevalence_pct, round(avg(v), 6) AS mean_value, round(median(v), 6) AS median_value, max(v) AS max_value FROM f GROUP BY organism""")
def prevalence(t):
    n = t.det.select("sample").distinct().count()
    return co.prevalence(t.det, "organism", "sample", "tass", 50, n).select("organism", "detected", "passing", "below", R("prevalence_pct"), R("mean_value"), R("median_value"), "max_value")


@query("cooccurrence", "R4", uses="det", sql="""
WITH d AS (SELECT organism, sample FROM det WHERE tass >= 60), n AS (SELECT organism, count(*) AS n FROM d GROUP BY organism), p AS (SELECT x.organism AS a, y.organism AS b, count(*) AS both_n FROM d x JOIN d y ON x.sample = y.sample AND x.organism < y.organism GROUP BY 1, 2)
SELECT a, b, both_n AS "both", round(both_n * 1.0 / (na.n + nb.n - both_n), 6) AS jaccard FROM p JOIN n na ON na.organism = a JOIN n nb ON nb.organism = b""")
def cooccurrence(t):
    return co.cooccurrence(t.det.where("tass >= 60"), "organism", "sample").select("a", "b", "both", R("jaccard"))


@query("box_stats", "R3", uses="det", sql="SELECT genus, min(tass) AS low, round(quantile_cont(tass, 0.25), 6) AS q1, round(median(tass), 6) AS mid, round(quantile_cont(tass, 0.75), 6) AS q3, max(tass) AS high FROM det GROUP BY genus")
def box_stats(t):
    q = lambda p, n: F.round(F.percentile("tass", p), 6).alias(n)
    return t.det.groupBy("genus").agg(F.min("tass").alias("low"), q(0.25, "q1"), q(0.5, "mid"), q(0.75, "q3"), F.max("tass").alias("high"))


@query("correlogram", "R5 E30", uses="det", sql="""WITH l AS (SELECT log10(reads + 1) AS reads, tass, coverage, mapq FROM det)
SELECT 'reads' AS x, 'tass' AS y, round(corr(reads, tass), 6) AS r, count(*) AS n FROM l UNION ALL SELECT 'reads', 'coverage', round(corr(reads, coverage), 6), count(*) FROM l UNION ALL SELECT 'reads', 'mapq', round(corr(reads, mapq), 6), count(*) FROM l
UNION ALL SELECT 'tass', 'coverage', round(corr(tass, coverage), 6), count(*) FROM l UNION ALL SELECT 'tass', 'mapq', round(corr(tass, mapq), 6), count(*) FROM l UNION ALL SELECT 'coverage', 'mapq', round(corr(coverage, mapq), 6), count(*) FROM l""")
def correlogram(t):
    d = t.det.select(F.log10(F.col("reads") + 1).alias("reads"), "tass", "coverage", "mapq")
    return co.pairwise_correlation(d, ["reads", "tass", "coverage", "mapq"]).select("x", "y", R("r"), "n")


@query("heatmap", "R1", uses="det", sql="PIVOT (SELECT organism, segment, tass FROM det) ON segment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY') USING max(tass) GROUP BY organism")
def heatmap(t):
    return t.det.groupBy("organism").pivot("segment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]).agg(F.max("tass"))


@query("pca2", "R6", uses="", sql=None)
def pca2(t):
    """Variance along the two main axes of the embeddings: signs are arbitrary, so magnitudes are given."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = t.embeddings.select("label", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    x = PCA(k=2, inputCol="v", outputCol="pc").fit(rows).transform(rows).select("label", vector_to_array("pc").alias("pc"))
    return x.groupBy("label").agg(F.round(F.abs(F.avg(F.col("pc")[0])), 4).alias("abs_pc1"), F.round(F.abs(F.avg(F.col("pc")[1])), 4).alias("abs_pc2"), F.count("*").alias("n"))


_PROF = "p AS (SELECT site AS e, organism AS t, sum(reads) AS v FROM det WHERE tass >= 50 GROUP BY site, organism)"


@query("profile_similarity", "R9", uses="det", sql=f"""WITH {_PROF}, z AS (SELECT e, sqrt(sum(v * v)) AS norm, count(*) AS n FROM p GROUP BY e), x AS (SELECT a.e AS a, b.e AS b, sum(a.v * b.v) AS dot, count(*) AS shared FROM p a JOIN p b ON a.t = b.t AND a.e < b.e GROUP BY 1, 2)
SELECT a, b, round(dot / (za.norm * zb.norm), 6) AS cosine, round(shared * 1.0 / (za.n + zb.n - shared), 6) AS jaccard, shared FROM x JOIN z za ON za.e = a JOIN z zb ON zb.e = b""")
def profile_similarity(t):
    p = t.det.where("tass >= 50").groupBy("site", "organism").agg(F.sum("reads").alias("v"))
    return co.profile_similarity(p, "site", "organism", F.col("v").cast("double")).select("a", "b", R("cosine"), R("jaccard"), "shared")


@query("group_network", "R24 R25", uses="det samples", sql="""
WITH p AS (SELECT segment AS e, organism AS t, ln(1 + sum(reads)) AS v FROM det WHERE tass >= 50 GROUP BY segment, organism), z AS (SELECT e, sqrt(sum(v * v)) AS norm FROM p GROUP BY e), x AS (SELECT a.e AS a, b.e AS b, sum(a.v * b.v) AS dot FROM p a JOIN p b ON a.t = b.t AND a.e < b.e GROUP BY 1, 2)
SELECT a, b, round(dot / (za.norm * zb.norm), 6) AS weight FROM x JOIN z za ON za.e = a JOIN z zb ON zb.e = b WHERE dot / (za.norm * zb.norm) >= 0.5""")
def group_network(t):
    p = t.det.where("tass >= 50").groupBy("segment", "organism").agg(F.sum("reads").alias("v"))
    return co.network_edges(co.profile_similarity(p, "segment", "organism", F.log1p("v")), "cosine", 0.5).select("a", "b", R("weight"))


@query("haversine", "R25", uses="samples", sql="""SELECT a.site AS s1, b.site AS s2, round(2 * 6371.0 * asin(least(1, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))), 3) AS km, a.continent <> b.continent AS crosses
FROM (SELECT DISTINCT site, lat, lon, continent FROM samples) a JOIN (SELECT DISTINCT site, lat, lon, continent FROM samples) b ON a.site < b.site""")
def haversine(t):
    s = t.samples.select("site", "lat", "lon", "continent").distinct()
    a, b = s.toDF("s1", "lat1", "lon1", "c1"), s.toDF("s2", "lat2", "lon2", "c2")
    pairs = a.join(b, F.col("s1") < F.col("s2"))  # the asked-for matrix of few sites
    return pairs.select("s1", "s2", F.round(fx.haversine_km(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2")), 3).alias("km"), (F.col("c1") != F.col("c2")).alias("crosses"))


@query("enrichment", "R10 T5", uses="det", sql="""
WITH p AS (SELECT segment, organism, sum(tass) AS v FROM det WHERE tass >= 60 GROUP BY segment, organism), n AS (SELECT count(DISTINCT segment) AS k FROM p),
f AS (SELECT segment, organism, log2((v + 1e-6) / ((sum(v) OVER (PARTITION BY organism) - v) / (k - 1) + 1e-6)) AS fc FROM p, n), b AS (SELECT organism FROM f GROUP BY organism ORDER BY round(max(abs(fc)), 6) DESC, organism LIMIT 25)
SELECT segment, organism, round(fc, 6) AS log2_fc FROM f JOIN b USING (organism)""")
def enrichment(t):
    p = t.det.where("tass >= 60").groupBy("segment", "organism").agg(F.sum("tass").alias("v"))
    return co.enrichment(p, "segment", "organism", "v", p.select("segment").distinct().count(), 25).select("segment", "organism", R("log2_fc"))


@query("metadata_aggregate", "A44 R12", uses="det samples", sql="SELECT country, count(DISTINCT sample) AS samples, count(*) AS detections, sum(reads)::BIGINT AS reads, round(avg(tass), 6) AS mean_tass FROM det JOIN samples USING (sample) GROUP BY country")
def metadata_aggregate(t):
    return t.det.join(t.samples.select("sample", "country"), "sample").groupBy("country").agg(F.countDistinct("sample").alias("samples"), F.count("*").alias("detections"), F.sum("reads").alias("reads"), F.round(F.avg("tass"), 6).alias("mean_tass"))


@query("metadata_nested", "A45", uses="det samples", sql="SELECT continent, country, count(DISTINCT sample) AS samples, sum(reads)::BIGINT AS reads FROM det JOIN samples USING (sample) GROUP BY ROLLUP (continent, country)")
def metadata_nested(t):
    return t.det.join(t.samples.select("sample", "continent", "country"), "sample").rollup("continent", "country").agg(F.countDistinct("sample").alias("samples"), F.sum("reads").alias("reads"))


@query("host_matrix", "A46 R13", uses="det", sql="""WITH h AS (SELECT sample, organism, unnest(string_split(CASE site % 3 WHEN 0 THEN 'fever;cough' WHEN 1 THEN 'cough' ELSE 'rash;fever' END, ';')) AS symptom FROM det WHERE tass >= 60)
SELECT organism, count(DISTINCT CASE WHEN symptom = 'cough' THEN sample END) AS cough, count(DISTINCT CASE WHEN symptom = 'fever' THEN sample END) AS fever, count(DISTINCT CASE WHEN symptom = 'rash' THEN sample END) AS rash FROM h GROUP BY organism""")
def host_matrix(t):
    s = F.when(F.col("site") % 3 == 0, "fever;cough").when(F.col("site") % 3 == 1, "cough").otherwise("rash;fever")
    h = t.det.where("tass >= 60").select("sample", "organism", F.explode(F.split(s, ";")).alias("symptom")).distinct()
    return h.groupBy("organism").pivot("symptom", ["cough", "fever", "rash"]).agg(F.count("sample")).na.fill(0)


@query("geo_tally", "A47", uses="det samples", sql="""WITH x AS (SELECT continent, organism, count(*) AS n, max(tass) AS tass, sum(reads)::BIGINT AS reads, count(DISTINCT sample) AS samples FROM det JOIN samples USING (sample) GROUP BY continent, organism),
r AS (SELECT *, row_number() OVER (PARTITION BY continent ORDER BY n DESC, organism) AS no FROM x) SELECT * FROM r WHERE no <= 5""")
def geo_tally(t):
    x = t.det.join(t.samples.select("sample", "continent"), "sample").groupBy("continent", "organism").agg(F.count("*").alias("n"), F.max("tass").alias("tass"), F.sum("reads").alias("reads"), F.countDistinct("sample").alias("samples"))
    return x.withColumn("no", F.row_number().over(Window.partitionBy("continent").orderBy(F.desc("n"), "organism"))).where("no <= 5")


@query("sunburst", "A48 R19", uses="det", sql="""SELECT coalesce(genus, 'all') AS genus, coalesce(sub, 'all') AS sub, coalesce(organism, 'all') AS organism, sum(greatest(v, 0))::BIGINT AS value FROM (SELECT genus, coalesce(CASE WHEN site % 2 = 0 THEN substr(organism, 7, 2) END, 'Unknown sub') AS sub, organism, reads - 20 AS v FROM det) GROUP BY ROLLUP (genus, sub, organism)""")
def sunburst(t):
    d = t.det.select("genus", F.coalesce(F.when(F.col("site") % 2 == 0, F.substring("organism", 7, 2)), F.lit("Unknown sub")).alias("sub"), "organism", F.greatest(F.col("reads") - 20, F.lit(0)).alias("v"))
    x = d.rollup("genus", "sub", "organism").agg(F.sum("v").alias("value"))
    return x.select(*[F.coalesce(c, F.lit("all")).alias(c) for c in ("genus", "sub", "organism")], "value")


@query("composite_groups", "R22 R16", uses="samples", sql="""SELECT sample, a || ' | ' || b AS "group" FROM (SELECT sample, unnest(string_split(CASE site % 3 WHEN 0 THEN 'x;y' WHEN 1 THEN 'z' ELSE 'x' END, ';')) AS a, continent AS b FROM samples)""")
def composite_groups(t):
    s = t.samples.withColumn("tags", F.when(F.col("site") % 3 == 0, "x;y").when(F.col("site") % 3 == 1, "z").otherwise("x"))
    return co.composite_groups(s, "sample", {"tags": "tags", "continent": "continent"})


@query("column_profile", "R21", uses="samples", sql="""WITH l AS (SELECT 'country' AS key, country AS v FROM samples UNION ALL SELECT 'site', site::VARCHAR FROM samples UNION ALL SELECT 'blank', '' FROM samples)
SELECT key, count(*) AS n, count(nullif(v, '')) AS filled, count(DISTINCT nullif(v, '')) AS n_distinct, round(sum((try_cast(nullif(v, '') AS DOUBLE) IS NOT NULL)::INT) * 1.0 / nullif(count(nullif(v, '')), 0), 6) AS numeric_share, round(avg(length(nullif(v, ''))), 6) AS mean_chars FROM l GROUP BY key""")
def column_profile(t):
    s = t.samples
    long = s.select(F.explode(F.array(F.struct(F.lit("country").alias("key"), F.col("country").alias("v")), F.struct(F.lit("site").alias("key"), F.col("site").cast("string").alias("v")), F.struct(F.lit("blank").alias("key"), F.lit("").alias("v")))).alias("x")).select("x.*")
    filled = F.when(F.trim("v") != "", F.trim("v"))
    return long.groupBy("key").agg(
        F.count("*").alias("n"), F.count(filled).alias("filled"), F.countDistinct(filled).alias("n_distinct"),
        F.round(F.count_if(filled.try_cast("double").isNotNull()) / F.nullif(F.count(filled), F.lit(0)), 6).alias("numeric_share"), F.round(F.avg(F.length(filled)), 6).alias("mean_chars"))


@query("group_profile", "R23", uses="det samples", sql="""WITH n AS (SELECT continent, count(DISTINCT sample) AS size FROM samples GROUP BY continent)
SELECT continent, organism, sum(reads)::BIGINT AS reads, max(tass) AS tass, round(count(DISTINCT sample) * 100.0 / any_value(size), 6) AS prevalence_pct FROM det JOIN samples USING (sample) JOIN n USING (continent) GROUP BY continent, organism""")
def group_profile(t):
    n = t.samples.groupBy("continent").agg(F.countDistinct("sample").alias("size"))
    x = t.det.join(t.samples.select("sample", "continent"), "sample").groupBy("continent", "organism").agg(F.sum("reads").alias("reads"), F.max("tass").alias("tass"), F.countDistinct("sample").alias("k"))
    return x.join(n, "continent").select("continent", "organism", "reads", "tass", F.round(F.col("k") * 100 / F.col("size"), 6).alias("prevalence_pct"))


@query("run_highlights", "A52 A36", uses="det", sql="SELECT count(DISTINCT sample) AS samples, sum(reads)::BIGINT AS reads, count(DISTINCT organism) AS taxa, count(DISTINCT genus) AS genera, count(DISTINCT CASE WHEN high_consequence AND tass >= 60 THEN organism END) AS high_consequence, round(sum(CASE WHEN tass >= 50 THEN reads ELSE 0 END) * 100.0 / sum(reads), 6) AS classified_pct FROM det")
def run_highlights(t):
    d = t.det
    return d.agg(
        F.countDistinct("sample").alias("samples"), F.sum("reads").alias("reads"), F.countDistinct("organism").alias("taxa"), F.countDistinct("genus").alias("genera"),
        F.countDistinct(F.when(F.col("high_consequence") & (F.col("tass") >= 60), F.col("organism"))).alias("high_consequence"),
        F.round(F.sum(F.when(F.col("tass") >= 50, F.col("reads")).otherwise(0)) * 100 / F.sum("reads"), 6).alias("classified_pct"))


@query("capability_gaps", "R18 A35", uses="det", sql="SELECT sample, NOT bool_or(high_consequence) AS lacks_high, NOT bool_or(tass >= 90) AS lacks_strong FROM det GROUP BY sample HAVING NOT bool_or(high_consequence) OR NOT bool_or(tass >= 90)")
def capability_gaps(t):
    x = t.det.groupBy("sample").agg((~F.bool_or("high_consequence")).alias("lacks_high"), (~F.bool_or(F.col("tass") >= 90)).alias("lacks_strong"))
    return x.where("lacks_high or lacks_strong")


@query("novelty_fractions", "R15", uses="det", sql="""SELECT genus, least(1, greatest(0, round(sum(CASE WHEN tass >= 60 THEN reads ELSE 0 END) * 1.0 / sum(reads), 6))) AS aligned, least(1, greatest(0, round((sum(reads) - 2.0 * sum(CASE WHEN tass >= 60 THEN reads ELSE 0 END)) / sum(reads), 6))) AS only_k2, max(tass) AS max_tass, sum(reads)::BIGINT AS reads FROM det GROUP BY genus""")
def novelty_fractions(t):
    a, n = F.sum(F.when(F.col("tass") >= 60, F.col("reads")).otherwise(0)), F.sum("reads")
    return t.det.groupBy("genus").agg(fx.clip(F.round(a / n, 6)).alias("aligned"), fx.clip(F.round((n - 2 * a) / n, 6)).alias("only_k2"), F.max("tass").alias("max_tass"), n.alias("reads"))


@query("facet_search", "R20 F10", uses="det", sql="SELECT segment, high_consequence, count(*) AS n FROM det WHERE regexp_matches(lower(organism), 'brand#[12]') OR lower(sample) LIKE '%build%' GROUP BY segment, high_consequence")
def facet_search(t):
    hit = F.lower("organism").rlike("brand#[12]") | F.lower("sample").contains("build")
    return t.det.where(hit).groupBy("segment", "high_consequence").agg(F.count("*").alias("n"))


@query("longitudinal", "R11", sql="""SELECT c_mktsegment AS segment, date_trunc('month', o_orderdate) AS month, count(*) AS n, round(avg(o_totalprice), 4) AS mean_price, round(avg(avg(o_totalprice)) OVER (PARTITION BY c_mktsegment ORDER BY date_trunc('month', o_orderdate) ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS rolling
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment, date_trunc('month', o_orderdate)""")
def longitudinal(t):
    x = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_mktsegment").alias("segment"), F.date_trunc("month", F.col("o_orderdate").cast("timestamp")).alias("month")).agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("m"))
    w = Window.partitionBy("segment").orderBy("month").rowsBetween(-2, 0)
    return x.select("segment", F.col("month").cast("timestamp_ntz").alias("month"), "n", F.round("m", 4).alias("mean_price"), F.round(F.avg("m").over(w), 4).alias("rolling"))


@query("flat_report", "F19 A9 W6", uses="det", sql="""SELECT sample, organism, reads, round(tass, 2) AS tass, round(coverage, 4) AS coverage, high_consequence AND tass >= 60 AS alert, round(reads * 100.0 / sum(reads) OVER (PARTITION BY sample), 4) AS pct_reads,
 row_number() OVER (PARTITION BY sample ORDER BY tass DESC, organism) AS rank FROM det""")
def flat_report(t):
    w = Window.partitionBy("sample")
    return t.det.select("sample", "organism", "reads", F.round("tass", 2).alias("tass"), F.round("coverage", 4).alias("coverage"), (F.col("high_consequence") & (F.col("tass") >= 60)).alias("alert"),
                        F.round(F.col("reads") * 100 / F.sum("reads").over(w), 4).alias("pct_reads"), F.row_number().over(w.orderBy(F.desc("tass"), "organism")).alias("rank"))
