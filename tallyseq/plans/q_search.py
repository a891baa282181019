"""Facets, sniffed maps and the rules that pick rows by several columns at once."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.functions import formulas as fx
from tallyseq.operators import facets as fc
from tallyseq.operators import report as rp
from tallyseq.operators import score as sc
from tallyseq.plans.base import query
from tallyseq.plans.q_scores import _SIG, R6
from tallyseq.session import shared_path
from tallyseq.sources import readers

_FACETS = ["category", "domain", "kingdom", "mol_type", "tags"]
_SELECTED = {"category": ["Primary", "Opportunistic"], "kingdom": ["Fungi"], "tags": ["site-1", "hc", "BUILDING"]}
_SHOWN = {"category": "coalesce(category, '')", "domain": "domain", "kingdom": "kingdom", "mol_type": "coalesce(mol_type, '')"}
_PASS = {"category": "category IN ('Primary', 'Opportunistic')", "kingdom": "kingdom = 'Fungi'", "tags": "list_has_any(tags, ['site-1', 'hc', 'BUILDING'])"}


def _facet_sql(name: str) -> str:
    """One query for one facet: all selections but its own."""
    value = "unnest(tags)" if name == "tags" else _SHOWN[name]
    others = " AND ".join(f"coalesce({p}, false)" for k, p in _PASS.items() if k != name)
    return f"SELECT '{name}' AS facet, value, count(*) AS n FROM (SELECT {value} AS value FROM b WHERE {others}) WHERE value <> '' GROUP BY value"


@query("facet_counts", "R20 F10", uses="view", sql=f"""WITH v AS (SELECT *, list_concat(['site-' || (site % 4), segment], CASE WHEN high_consequence THEN ['hc'] ELSE [] END) AS tags FROM view),
b AS (SELECT * FROM v WHERE contains(lower(sample || ' ' || organism), 'brand#') AND contains(lower(sample || ' ' || organism), '1')), c AS ({' UNION ALL '.join(map(_facet_sql, _FACETS))})
SELECT facet, value, n, facet = 'category' AND value IN ('Primary', 'Opportunistic') OR facet = 'kingdom' AND value = 'Fungi' OR facet = 'tags' AND value IN ('site-1', 'hc', 'BUILDING') AS selected, (row_number() OVER (PARTITION BY facet ORDER BY n DESC, value))::INT AS place FROM c""")
def facet_counts(t):
    tags = F.concat(F.array(F.concat(F.lit("site-"), (F.col("site") % 4).cast("string")), "segment"), F.when(F.col("high_consequence"), F.array(F.lit("hc"))).otherwise(F.array().cast("array<string>")))
    return fc.facet_counts(t.view.withColumn("tags", tags), _FACETS, _SELECTED, "Brand# 1", ["sample", "organism"])


@query("sniffed_maps", "S10", sql="""
WITH a AS (SELECT p_partkey, 'A' || p_partkey || '.1' AS accession, p_size::VARCHAR AS taxid, p_name || ', x' AS name FROM part WHERE p_partkey % 3 = 0),
b AS (SELECT p_partkey, 'B' || p_partkey, (p_size + 100)::VARCHAR, p_brand FROM part WHERE p_partkey % 3 = 1), c AS (SELECT p_partkey, 'A' || (p_partkey - 2) || '.1', CASE WHEN p_partkey % 2 = 0 THEN p_size::VARCHAR ELSE '7' END, NULL FROM part WHERE p_partkey % 3 = 2),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c)
SELECT accession, count(*) AS n, array_to_string(list_sort(list(DISTINCT taxid)), ',') AS taxids, min(name) AS name, count(DISTINCT taxid) > 1 AS conflict FROM u GROUP BY accession""")
def sniffed_maps(t):
    """Maps of three dialects in one folder: a header in quotes with commas, tabs by position without a header,
    two columns by other names."""
    spark, path, p = t.part.sparkSession, shared_path(t.part.sparkSession, "maps"), t.part
    text = lambda c: F.col(c).cast("string")
    a = p.where("p_partkey % 3 = 0").select(F.concat(F.lit("A"), text("p_partkey"), F.lit(".1")).alias("RefSeq"), F.lit("-").alias("other"), F.concat("p_name", F.lit(", x")).alias("Desc"), F.col("p_size").alias("Species_TaxID"))
    b = p.where("p_partkey % 3 = 1").select(F.concat(F.lit("B"), text("p_partkey")), F.lit("x"), "p_brand", F.lit("a,b"), F.col("p_size") + 100)
    c = p.where("p_partkey % 3 = 2").select(F.when(F.col("p_partkey") % 2 == 0, text("p_size")).otherwise("7").alias("staxids"), F.concat(F.lit("A"), (F.col("p_partkey") - 2).cast("string"), F.lit(".1")).alias(" Accession.Version "))
    for name, rows, sep, header in (("a", a, ",", True), ("b", b, "\t", False), ("c", c, ",", True)):
        rows.write.csv(f"{path}/{name}", sep=sep, header=header, quoteAll=name == "a", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    rows = readers.read_accession_maps(spark, f"{path}/*", has_header=False)
    found = rows.groupBy("accession").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("taxid")), ",").alias("taxids"), F.min("name").alias("name"))
    clash = readers.map_conflicts(rows).select("accession", F.lit(True).alias("conflict"))
    return found.join(clash, "accession", "left").withColumn("conflict", F.coalesce("conflict", F.lit(False)))


@query("annotation_routes", "F15 A53", sql="""
WITH a AS (SELECT p_partkey, p_brand, CASE p_size % 5 WHEN 0 THEN 'Antibiotic efflux' WHEN 1 THEN ' Drug RESISTANCE' WHEN 2 THEN 'Transporter' WHEN 3 THEN 'Virulence Factor' END AS prop, CASE WHEN p_partkey % 11 = 0 THEN 'beta-lactam' WHEN p_partkey % 11 = 1 THEN ' ' END AS cls,
 CASE WHEN p_partkey % 13 = 0 THEN 'penicillin' END AS drugs, CASE p_partkey % 7 WHEN 0 THEN 'CARD' WHEN 1 THEN 'VFDB' WHEN 2 THEN 'ResFinder 4' END AS src FROM part),
r AS (SELECT *, contains(lower(coalesce(prop, '')), 'resist') OR contains(lower(coalesce(prop, '')), 'antibiotic') OR trim(coalesce(cls, '')) <> '' OR coalesce(drugs, '') <> '' OR coalesce(src, '') IN ('CARD', 'ResFinder 4') AS amr FROM a)
SELECT p_brand, count(*) FILTER (amr) AS n_amr, count(*) FILTER (NOT amr) AS n_other FROM r GROUP BY p_brand""")
def annotation_routes(t):
    k, s = F.col("p_partkey"), F.col("p_size") % 5
    prop = F.when(s == 0, "Antibiotic efflux").when(s == 1, " Drug RESISTANCE").when(s == 2, "Transporter").when(s == 3, "Virulence Factor")
    amr = fx.is_resistance(prop, F.when(k % 11 == 0, "beta-lactam").when(k % 11 == 1, " "), F.when(k % 13 == 0, "penicillin"), F.when(k % 7 == 0, "CARD").when(k % 7 == 1, "VFDB").when(k % 7 == 2, "ResFinder 4"))
    return t.part.withColumn("amr", amr).groupBy("p_brand").agg(F.count_if("amr").alias("n_amr"), F.count_if(~F.col("amr")).alias("n_other"))


_SHARED = f"""
w AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY genus) > 4 THEN genus || '/' || species ELSE genus::VARCHAR END AS bucket FROM rec),
a AS (SELECT *, least(1.0, {_SIG.format(s='12.0', v='breadth', m='0.3')} + 0.3 * mapq01) AS ceil_, count(*) OVER s AS n, row_number() OVER (PARTITION BY bucket ORDER BY share DESC, ref_id) AS no, share / sum(share) OVER s AS mine FROM w WINDOW s AS (PARTITION BY bucket)),
b AS (SELECT *, max(CASE WHEN no = 1 THEN breadth END) OVER s AS top_breadth, max(CASE WHEN no = 1 THEN mine END) OVER s AS first_, coalesce(max(CASE WHEN no = 2 THEN mine END) OVER s, 0) AS second_ FROM a WINDOW s AS (PARTITION BY bucket)),
c AS (SELECT *, (0.65 * (0.2 + 0.8 * mine) + 0.35 * (0.35 + 0.65 * least(1, breadth / top_breadth))) * CASE WHEN n > 2 THEN greatest(0.35, 1 / (1 + 0.3 * (n - 2))) ELSE 1 END * greatest(0.3, 1 - 0.5 * removal * least(1, (n - 1) / 5.0)) AS k0,
 least(1, greatest(0, (mine / first_ - 0.4) / 0.4)) * least(1, greatest(0, (breadth - 0.1) / 0.15)) * CASE WHEN n > 2 THEN greatest(0.1, 2.0 / n) ELSE 1 END AS par FROM b),
d AS (SELECT *, greatest(0.2, k0 + par * greatest(0, 0.8 - k0)) AS kept, least(ceil_, minhash + greatest(0, ceil_ - minhash) * least(1, mine + 0.75 * (mine - second_))) AS won FROM c)"""


@query("winner_loser_clusters", "X8", uses="rec", sql=f"""WITH {_SHARED}
SELECT ref_id, bucket, round(CASE WHEN n = 1 THEN 1 ELSE mine END, 6) AS rpm_share, round(CASE WHEN n = 1 THEN 1 WHEN no = 1 THEN won / minhash ELSE kept END, 6) AS factor,
 round(CASE WHEN n = 1 THEN least(ceil_, minhash + 0.9 * greatest(0, ceil_ - minhash) * mapq01) WHEN no = 1 THEN won ELSE minhash * kept END, 6) AS minhash_shared FROM d""")
def winner_loser_clusters(t):
    """Sharing inside conflict clusters; those with more than four members are told apart by species."""
    x = t.rec.withColumn("bucket", sc.conflict_bucket(t.rec, "genus", "species", most=4))
    partners = F.count("*").over(Window.partitionBy("bucket")) - 1
    ceiling = F.least(F.lit(1.0), fx.sigmoid(F.col("breadth"), 0.3, 12.0) + 0.3 * F.col("mapq01"))
    x = sc.share_minhash(x.withColumn("n_partners", partners), "bucket", "share", "ref_id", "minhash", ceiling, F.col("breadth"), F.col("mapq01"), F.col("removal"), F.col("n_partners"))
    return R6(x, ["ref_id", "bucket"], ["rpm_share", "factor", "minhash_shared"])


_CUTS = """m AS (SELECT segment, site, domain, tass FROM view WHERE domain <> ''), g AS (SELECT coalesce(segment, 'all') AS segment, coalesce(site::VARCHAR, 'all') AS site, domain, max(tass) AS cutoff, count(*) AS n FROM m GROUP BY GROUPING SETS ((segment, site, domain), (segment, domain), (site, domain), (domain))),
k AS (SELECT * FROM g WHERE n >= CASE WHEN segment <> 'all' AND site <> 'all' THEN 30 WHEN site = 'all' AND segment <> 'all' THEN 250 ELSE 1 END)"""


@query("domain_thresholds", "X24 F7", uses="view", sql=f"""WITH {_CUTS}, s AS (SELECT DISTINCT sample, segment, site::VARCHAR AS site, domain FROM view)
SELECT s.sample, s.domain, coalesce(a.cutoff, b.cutoff, c.cutoff, d.cutoff, 50.0)::DOUBLE AS cutoff, CASE WHEN a.cutoff IS NOT NULL THEN 'both' WHEN b.cutoff IS NOT NULL THEN 'segment' WHEN c.cutoff IS NOT NULL THEN 'site' WHEN d.cutoff IS NOT NULL THEN 'domain' ELSE 'default' END AS origin
FROM s LEFT JOIN k a ON a.segment = s.segment AND a.site = s.site AND a.domain = s.domain LEFT JOIN k b ON b.segment = s.segment AND b.site = 'all' AND b.domain = s.domain
 LEFT JOIN k c ON c.segment = 'all' AND c.site = s.site AND c.domain = s.domain LEFT JOIN k d ON d.segment = 'all' AND d.site = 'all' AND d.domain = s.domain""")
def domain_thresholds(t):
    """Cut-offs per domain, by kind of sample and site, then either alone, then neither; else a default."""
    m = t.view.where("domain <> ''")
    g = m.groupingSets([["segment", "site", "domain"], ["segment", "domain"], ["site", "domain"], ["domain"]], "segment", "site", "domain").agg(F.max("tass").alias("cutoff"), F.count("*").alias("n"))
    g = g.select(F.coalesce("segment", F.lit("all")).alias("segment"), F.coalesce(F.col("site").cast("string"), F.lit("all")).alias("site"), "domain", "cutoff", "n")
    both, one = (F.col("segment") != "all") & (F.col("site") != "all"), (F.col("site") == "all") & (F.col("segment") != "all")
    dim = g.where(F.col("n") >= F.when(both, 30).when(one, 250).otherwise(1)).drop("n")
    s = t.view.select("sample", F.col("segment").alias("seg"), F.col("site").cast("string").alias("place"), F.col("domain").alias("dom")).distinct()
    keys = [[("seg", "segment"), ("place", "site"), ("dom", "domain")], [("seg", "segment"), ("dom", "domain")], [("place", "site"), ("dom", "domain")], [("dom", "domain")]]
    names = ("both", "segment", "site", "domain")
    out = s
    for name, pairs in zip(names, keys):  # each step reads only the rows that say `all` where it has no key
        free = [c for c in ("segment", "site") if c not in [k for _, k in pairs]]
        own = dim
        for c in ("segment", "site"):
            own = own.where(F.col(c) == "all" if c in free else F.col(c) != "all")
        own = own.select(*[F.col(k).alias(a) for a, k in pairs], F.col("cutoff").alias(f"_{name}"))
        out = out.join(own, [a for a, _ in pairs], "left")
    origin = None
    for name in names:
        hit = F.col(f"_{name}").isNotNull()
        origin = F.when(hit, name) if origin is None else origin.when(hit, name)
    return out.select("sample", F.col("dom").alias("domain"), F.coalesce(*[f"_{n}" for n in names], F.lit(50.0)).alias("cutoff"), origin.otherwise("default").alias("origin"))


@query("passing_detections", "F5 F6", uses="view", sql="""
SELECT sample, count(*) AS n, count(*) FILTER (high_consequence) AS n_high, round(min(tass), 4) AS least FROM view
WHERE tass >= 45.5 AND (category = 'Primary' OR category IN ('Potential') OR high_consequence AND category IS NOT NULL) GROUP BY sample""")
def passing_detections(t):
    least, wanted = 45.5, ["Primary", "Potential"]
    ok = (F.col("tass") >= least) & (F.col("category").isin(*wanted) | (F.col("high_consequence") & F.col("category").isNotNull()))
    return t.view.where(ok).groupBy("sample").agg(F.count("*").alias("n"), F.count_if("high_consequence").alias("n_high"), F.round(F.min("tass"), 4).alias("least"))


@query("described_references", "F2 F3", sql="""
WITH d AS (SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_name || CASE WHEN p_size % 6 = 0 THEN ' PLASMID p' || p_size WHEN p_size % 6 = 1 THEN ' Phage part' ELSE ' ' || p_type END END AS text FROM part)
SELECT p_partkey, coalesce(contains(lower(text), 'plasmid'), false) AS is_plasmid FROM d WHERE NOT coalesce(regexp_matches(text, '(?i)phage\\s') OR regexp_matches(text, '(?i)^[a-c].*brass$'), false)""")
def described_references(t):
    """References whose description matches none of the excluded patterns, in any case; a missing one stays."""
    text = F.when(F.col("p_partkey") % 9 != 0, F.concat("p_name", F.when(F.col("p_size") % 6 == 0, F.concat(F.lit(" PLASMID p"), F.col("p_size").cast("string"))).when(F.col("p_size") % 6 == 1, " Phage part").otherwise(F.concat(F.lit(" "), "p_type"))))
    excluded = [r"phage\s", "^[a-c].*brass$"]
    out = F.coalesce(F.col("text").rlike("|".join(f"(?i:{p})" for p in excluded)), F.lit(False))
    return t.part.select("p_partkey", text.alias("text")).where(~out).select("p_partkey", F.coalesce(F.lower("text").contains("plasmid"), F.lit(False)).alias("is_plasmid"))


_ORG = """
r AS (SELECT sample, segment, organism, genus AS sp, CASE WHEN substr(organism, 7, 1) <= '2' THEN 'G1' ELSE 'G2' END AS top, reads, tass, coverage / 100 AS cov, (100003 + 1000 * site)::BIGINT AS len, floor(coverage * 1200)::BIGINT AS bases, CASE WHEN reads > 10 THEN coverage / 3 END AS depth, high_consequence AS hc, category, domain, kingdom, mol_type FROM view),
o AS (SELECT sample, 'Strain' AS level, organism AS key, sp, top, organism AS name, segment, reads, tass, cov, len, bases, depth, hc, category, domain, kingdom, mol_type FROM r),
s AS (SELECT sample, 'Species' AS level, sp AS key, sp, any_value(top) AS top, 'species ' || sp AS name, any_value(segment) AS segment, sum(reads) AS reads, sum(tass * reads) / sum(reads) AS tass, sum(cov * reads) / sum(reads) AS cov, sum(len) AS len, sum(bases) AS bases,
 coalesce(sum(depth * reads) FILTER (depth IS NOT NULL) / sum(reads) FILTER (depth IS NOT NULL), avg(depth)) AS depth, bool_or(hc) AS hc, arg_min(category, organism) FILTER (category IS NOT NULL) AS category, arg_min(domain, organism) AS domain, arg_min(kingdom, organism) AS kingdom, arg_min(mol_type, organism) FILTER (mol_type IS NOT NULL) AS mol_type FROM r GROUP BY sample, sp),
g AS (SELECT sample, top AS key, sum(tass * reads) / sum(reads) AS tass FROM r GROUP BY sample, top), t AS (SELECT sample, sum(reads) AS n FROM r GROUP BY sample), u AS (SELECT * FROM o UNION ALL SELECT * FROM s)"""


@query("organism_report", "F19 A9", uses="view", sql=f"""WITH {_ORG}
SELECT u.sample, u.segment AS sample_type, u.level, u.key AS taxid, u.sp AS subkey, u.name, coalesce(u.category, 'Unknown') AS category, coalesce(u.mol_type, '') AS mol_type, u.kingdom, u.domain, round(coalesce(u.depth, 0), 2) AS mean_depth, round(u.tass, 6) AS tass, u.hc AS high_consequence,
 u.reads::BIGINT AS reads, round(u.reads * 100.0 / t.n, 4) AS pct_reads, round(least(100, u.cov * 100), 1) AS coverage, u.bases::BIGINT AS covered_bases, u.len::BIGINT AS genome_length, round(least(100, u.bases * 100.0 / u.len), 2) AS breadth_pct, round(p.tass, 4) AS species_tass,
 round(CASE WHEN g.key = 'G1' THEN g.tass ELSE p.tass END, 4) AS genus_tass, p.name AS species_name, CASE WHEN g.key = 'G1' THEN 'genus G1' ELSE p.name END AS genus_name, u.tass >= 50 AS passes_threshold, '' AS status, '' AS ann_class, '' AS phylum, '' AS model, NULL::DOUBLE AS model_pct, 0::DOUBLE AS gini, 0::BIGINT AS k2_reads, false AS ani_annotated
FROM u JOIN t ON t.sample = u.sample JOIN s p ON p.sample = u.sample AND p.key = u.sp JOIN g ON g.sample = u.sample AND g.key = u.top""")
def organism_report(t):
    """Strain and species rows; records of one of the two genera are missing, so the species stands for it."""
    r = t.view.select(
        "sample", F.col("segment").alias("sample_type"), F.lit("Strain").alias("level"), F.col("organism").alias("key"), F.col("genus").alias("subkey"), F.when(F.substring("organism", 7, 1) <= "2", "G1").otherwise("G2").alias("toplevelkey"),
        F.col("organism").alias("name"), "reads", "tass", (F.col("coverage") / 100).alias("coverage"), (100003 + 1000 * F.col("site")).cast("bigint").alias("length"), F.floor(F.col("coverage") * 1200).alias("covered_bases"),
        F.when(F.col("reads") > 10, F.col("coverage") / 3).alias("mean_depth"), "high_consequence", "category", "domain", "kingdom", "mol_type")
    fields = dict(sums=["reads", "length", "covered_bases"], means=["tass", "coverage", "mean_depth"], firsts=["category", "domain", "kingdom", "mol_type", "sample_type", "toplevelkey"], anys=["high_consequence"])
    weighted = r.withColumn("_w", F.col("reads"))
    species = rp.summarise(weighted, ["sample", "subkey"], "_w", "key", **fields)
    species = species.withColumns({"level": F.lit("Species"), "key": F.col("subkey"), "name": F.concat(F.lit("species "), "subkey")})
    genus = rp.summarise(weighted.where("toplevelkey = 'G1'"), ["sample", "toplevelkey"], "_w", "key", means=["tass"]).select("sample", F.col("toplevelkey").alias("key"), "tass", F.concat(F.lit("genus "), "toplevelkey").alias("name"))
    rows = r.unionByName(species.select(*r.columns)).withColumn("passes_threshold", F.col("tass") >= 50)
    out = rp.flat_rows(rows, "sample", r.groupBy("sample").agg(F.sum("reads").alias("total_reads")), {"species": species, "genus": genus})
    columns = "sample sample_type level taxid subkey name category mol_type kingdom domain mean_depth high_consequence reads pct_reads coverage covered_bases genome_length breadth_pct species_tass genus_tass species_name genus_name passes_threshold status ann_class phylum model model_pct gini k2_reads ani_annotated"
    return out.select(*columns.split(), F.round("tass", 6).alias("tass"))
