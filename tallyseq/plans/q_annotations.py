"""Annotations, places, pools and summaries of shared windows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.functions import formulas as fx
from tallyseq.functions import places as pl
from tallyseq.operators import annotations as an
from tallyseq.operators import intervals as iv
from tallyseq.operators import shared as sh
from tallyseq.operators import sketch as sk
from tallyseq.plans.base import ORACLES, query
from tallyseq.session import materialize, shared_path
from tallyseq.sources import writers

S = lambda c: F.col(c).cast("string")


@query("flattened_annotations", "A53", sql="""
WITH p AS (SELECT p_partkey, CASE WHEN p_size % 4 > 0 THEN p_type WHEN p_size % 8 = 0 THEN '' END AS gene, 'S' || p_size AS hit, substr(p_brand, 1, 7) AS genus, p_brand AS species, p_partkey::VARCHAR AS strain, p_size FROM part),
u AS (SELECT 1 AS l, 'genus' AS level, * FROM p WHERE p_size <= 10 UNION ALL SELECT 2, 'species', * FROM p WHERE p_size BETWEEN 5 AND 30 UNION ALL SELECT 3, 'strain', * FROM p),
k AS (SELECT *, CASE WHEN coalesce(gene, '') <> '' THEN gene ELSE hit END AS g, CASE WHEN l = 1 THEN genus ELSE species END AS scope FROM u)
SELECT g AS gene, scope, level, CASE l WHEN 1 THEN genus WHEN 2 THEN species ELSE strain END AS taxid FROM k QUALIFY row_number() OVER (PARTITION BY g, scope ORDER BY l, p_partkey) = 1""")
def flattened_annotations(t):
    gene = F.when(F.col("p_size") % 4 > 0, F.col("p_type")).when(F.col("p_size") % 8 == 0, "")
    p = t.part.select("p_partkey", gene.alias("gene"), F.concat(F.lit("S"), S("p_size")).alias("hit"), F.substring("p_brand", 1, 7).alias("genus"), F.col("p_brand").alias("species"), S("p_partkey").alias("strain"), "p_size")
    rows = p.where("p_size <= 10").withColumn("level", F.lit("genus")).unionByName(p.where("p_size between 5 and 30").withColumn("level", F.lit("species"))).unionByName(p.withColumn("level", F.lit("strain")))
    return an.flatten_annotations(rows, "p_partkey").select("gene", "scope", "level", "taxid")


@query("model_probabilities", "A24", sql="""
WITH e AS (SELECT s_suppkey AS acc, CASE WHEN s_suppkey % 7 > 0 THEN (abs(s_suppkey * 37) % 100) / 100.0 END AS avg, s_suppkey % 5 AS n, CASE WHEN s_suppkey % 3 > 0 THEN 'm' || s_suppkey % 2 END AS model FROM supplier WHERE s_suppkey % 4 > 0),
m AS (SELECT s_nationkey AS grp, s_suppkey AS acc FROM supplier), f AS (SELECT n_nationkey AS grp, n_nationkey / 100.0 AS avg, 'old' AS model FROM nation WHERE n_nationkey % 2 = 0),
o AS (SELECT grp, sum(avg * greatest(n, 1)) / sum(greatest(n, 1)) AS p, arg_min(model, acc) FILTER (model IS NOT NULL) AS model FROM m JOIN e USING (acc) WHERE avg IS NOT NULL GROUP BY grp)
SELECT g.grp, round(CASE WHEN o.grp IS NOT NULL THEN o.p ELSE f.avg END, 6) AS probability, CASE WHEN o.grp IS NOT NULL THEN o.model ELSE f.model END AS model FROM (SELECT DISTINCT grp FROM m) g LEFT JOIN o ON o.grp = g.grp LEFT JOIN f ON f.grp = g.grp""")
def model_probabilities(t):
    k = F.col("s_suppkey")
    profile = t.supplier.where(k % 4 > 0).select(k.alias("acc"), F.when(k % 7 > 0, (k * 37 % 100) / 100).alias("avg"), (k % 5).alias("n"), F.when(k % 3 > 0, F.concat(F.lit("m"), (k % 2).cast("string"))).alias("model"))
    fallback = t.nation.where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("grp"), (F.col("n_nationkey") / 100).alias("avg"), F.lit("old").alias("model"))
    members = t.supplier.select(F.col("s_nationkey").alias("grp"), k.alias("acc"))
    return an.model_probability(members, profile, "grp", "acc", fallback).withColumn("probability", F.round("probability", 6))


@query("missing_taxa", "A35", uses="det", sql="""
WITH w AS (SELECT DISTINCT segment, organism FROM det WHERE reads > 5), x AS (SELECT s.sample, w.organism FROM (SELECT DISTINCT sample, segment FROM det) s JOIN w USING (segment)), h AS (SELECT DISTINCT sample, organism FROM det)
SELECT x.sample, count(*) AS expected, count(*) FILTER (h.organism IS NULL) AS missing, round(count(h.organism) * 100.0 / count(*), 6) AS pct, coalesce(string_agg(x.organism, ',' ORDER BY x.organism) FILTER (h.organism IS NULL), '') AS items
FROM x LEFT JOIN h ON h.sample = x.sample AND h.organism = x.organism GROUP BY x.sample""")
def missing_taxa(t):
    """Of the organisms that some sample of a segment holds in number, which each of its samples lacks."""
    want = t.det.where("reads > 5").select("segment", "organism").distinct()
    expected = t.det.select("sample", "segment").distinct().join(want, "segment")
    return an.presence(expected, t.det, "sample", "organism").withColumn("pct", F.round("pct", 6))


@query("sample_statistics", "A36", uses="view", sql="SELECT sample, sum(reads)::BIGINT AS alignments, count(*) FILTER (category LIKE '%Primary%') AS n_primary, count(DISTINCT genus) FILTER (category LIKE '%Primary%') AS primary_groups, max(tass) AS max_tass FROM view GROUP BY sample")
def sample_statistics(t):
    primary = F.col("category").contains("Primary")
    return t.view.groupBy("sample").agg(F.sum("reads").alias("alignments"), F.count_if(primary).alias("n_primary"), F.countDistinct(F.when(primary, F.col("genus"))).alias("primary_groups"), F.max("tass").alias("max_tass"))


_HITS = """h AS (SELECT (p_size % 7)::VARCHAR AS taxid, [' Genus', 'family', 'species', 'no rank', ''][p_partkey % 5 + 1] AS rank, p_brand AS name, CASE WHEN p_partkey % 9 = 0 THEN 'x' WHEN p_partkey % 9 = 1 THEN '0.4' ELSE (p_size / 2.0)::VARCHAR END AS w FROM part),
x AS (SELECT taxid, lower(trim(rank)) AS rank, name, coalesce(trunc(try_cast(w AS DOUBLE))::BIGINT, 1) AS n FROM h), a AS (SELECT * FROM x WHERE n > 0 AND NOT (taxid IN ('0', '', 'no rank') AND rank IN ('', 'no rank')))"""


@query("novelty_candidates", "A40 X17", sql=f"""WITH {_HITS}, s AS (SELECT sum(n)::BIGINT AS assigned, sum(n) FILTER (rank IN ('genus', 'family'))::BIGINT AS high FROM a),
c AS (SELECT CASE WHEN rank IN ('genus', 'family') THEN 'highrank' ELSE 'species' END AS pool, taxid, rank, name, sum(n)::BIGINT AS n FROM a WHERE rank IN ('genus', 'family') OR rank IN ('species', 'no rank') AND taxid <> '0' GROUP BY ALL)
SELECT pool, taxid, rank, name, n, assigned, high AS highrank FROM c, s WHERE n >= CASE WHEN pool = 'highrank' THEN greatest(2, ceil(0.002::DOUBLE * high)) ELSE 2 END""")
def novelty_candidates(t):
    k, ranks = F.col("p_partkey"), F.array(*[F.lit(x) for x in (" Genus", "family", "species", "no rank", "")])
    hits = t.part.select((F.col("p_size") % 7).cast("string").alias("taxid"), F.get(ranks, (k % 5).cast("int")).alias("rank"), F.col("p_brand").alias("name"), F.when(k % 9 == 0, "x").when(k % 9 == 1, "0.4").otherwise((F.col("p_size") / 2).cast("string")).alias("w"))
    totals, pools = an.taxon_pools(hits, F.col("w"))
    return pools.crossJoin(F.broadcast(totals))


@query("accession_abundance", "X21", sql="""
WITH v AS (SELECT c_nationkey AS taxid, count(*) AS value FROM customer GROUP BY c_nationkey), s AS (SELECT s_suppkey AS acc, s_nationkey AS taxid, -ln((('0x' || substr(md5('3:' || s_suppkey), 1, 8))::BIGINT + 1) / 4294967297.0) AS g FROM supplier WHERE s_nationkey % 6 > 0),
w AS (SELECT acc, value * 1.0 / (SELECT sum(value) FROM v) * g / sum(g) OVER (PARTITION BY s.taxid) AS a FROM s JOIN v ON v.taxid = s.taxid) SELECT acc, round(a / sum(a) OVER (), 8) AS abundance FROM w""")
def accession_abundance(t):
    values = t.customer.groupBy(F.col("c_nationkey").alias("taxid")).agg(F.count("*").alias("value"))
    accessions = t.supplier.where("s_nationkey % 6 > 0").select(F.col("s_suppkey").alias("acc"), F.col("s_nationkey").alias("taxid"))
    return an.synthetic_abundance(values, accessions, "taxid", "value", "acc", 3).withColumn("abundance", F.round("abundance", 8))


_PLACES = ["The  Côte d'Ivoire", "U.S.", "Ivory Coast", " Trinidad & Tobago ", "ÅLAND", "us", "ny", "New York", "DC", "dc ", "Czech Republic", "São Tomé", "", "the Bahamas", "Łódź"]


@query("place_lookup", "E32", sql=f"""
WITH p AS (SELECT c_custkey, {_PLACES!r}[c_custkey % {len(_PLACES)} + 1] AS text, ['country', 'state', 'city'][c_custkey % 3 + 1] AS field FROM customer WHERE c_custkey % 17 > 0),
n AS (SELECT *, regexp_replace(trim(regexp_replace(replace(regexp_replace(lower(replace(replace(strip_accents(replace(replace(text, 'Ł', '1'), 'ł', '2')), '1', 'Ł'), '2', 'ł')), '[.,''’`]', '', 'g'), '&', 'and'), '\\s+', ' ', 'g')), '^the ', '') AS name FROM p),
k AS (SELECT *, CASE field WHEN 'country' THEN CASE name WHEN 'us' THEN 'united states of america' WHEN 'ivory coast' THEN 'cote divoire' WHEN 'czech republic' THEN 'czechia' ELSE name END ELSE name END AS one,
 CASE WHEN field = 'state' THEN CASE upper(trim(text)) WHEN 'NY' THEN 'new york' WHEN 'DC' THEN 'district of columbia' END END AS two FROM n)
SELECT c_custkey, array_to_string(list_filter([one, two], lambda x: x IS NOT NULL AND x <> ''), '|') AS keys FROM k""".replace('"The  Côte d\'Ivoire"', "'The  Côte d''Ivoire'"))
def place_lookup(t):
    k = F.col("c_custkey")
    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), (k % len(values)).cast("int"))
    rows = t.customer.where("c_custkey % 17 > 0")
    return rows.select("c_custkey", F.array_join(pl.place_keys(pick(["country", "state", "city"]), pick(_PLACES)), "|").alias("keys"))


@query("window_summary", "A13", uses="seqs", sql="SELECT q_contig AS contig, count(*) AS windows, count(DISTINCT m_contig) AS partners, round(avg(jaccard), 5) AS mean_jaccard, max(jaccard) AS max_jaccard, sum(q_end - q_start)::BIGINT AS bp FROM (SHARED) GROUP BY q_contig")
def window_summary(t):
    pairs, _ = sh.pruned_windows(t.seqs, "seq_id", "grp", "text", 5, 4, 60, 30, 0.5, 12)
    mean = F.sum(F.round(F.col("jaccard") * 1e6).cast("bigint")) / (F.count("*") * 1e6)  # whole millionths, so their order doesn't count
    return pairs.groupBy(F.col("q_contig").alias("contig")).agg(
        F.count("*").alias("windows"), F.countDistinct("m_contig").alias("partners"), fx.round_scaled(mean, 5).alias("mean_jaccard"), F.round(F.max("jaccard"), 6).alias("max_jaccard"), F.sum(F.col("q_end") - F.col("q_start")).alias("bp"))


ORACLES["window_summary"] = "SELECT " + ORACLES["window_summary"].partition(" SELECT ")[2].replace("SHARED", ORACLES["pruned_windows"])

_REGIONS = """
h AS (SELECT DISTINCT seq_id, grp, ('0x' || substr(md5(array_to_string(w[i:i+4], ' ')), 1, 15))::BIGINT AS hash FROM (SELECT seq_id, grp, w, unnest(range(1, len(w) - 3)) AS i FROM (SELECT seq_id, grp, string_split_regex(trim(lower(text)), '\\s+') AS w FROM seqs) WHERE len(w) >= 5)),
s AS (SELECT * FROM h WHERE hash < 1152921504606846976 // 16), r AS (SELECT DISTINCT seq_id, hash FROM s), o AS (SELECT DISTINCT grp, hash FROM s), rn AS (SELECT seq_id, count(*) AS n FROM r GROUP BY seq_id), onn AS (SELECT grp, count(*) AS n FROM o GROUP BY grp),
p AS (SELECT seq_id, grp, count(*) AS shared FROM r JOIN o USING (hash) GROUP BY ALL), j AS (SELECT p.*, shared * 1.0 / (rn.n + onn.n - shared) AS jaccard, shared * 1.0 / rn.n AS c1, shared * 1.0 / onn.n AS c2 FROM p JOIN rn USING (seq_id) JOIN onn USING (grp)),
c AS (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY jaccard DESC, grp) AS no FROM j WHERE jaccard >= 0.01)"""


@query("region_candidates", "J8", uses="seqs", sql=f"WITH {_REGIONS} SELECT seq_id, grp, round(jaccard, 6) AS jaccard, round(c1, 6) AS containment_region, round(c2, 6) AS containment_organism, (row_number() OVER (PARTITION BY seq_id ORDER BY round(c1, 6) DESC, grp))::INT AS place FROM c WHERE no <= 3")
def region_candidates(t):
    """Regions against organisms: candidates by Jaccard, then the order by containment. Organisms are few."""
    sets = materialize(sk.shingle_hashes(t.seqs, ["seq_id", "grp"], "text", 5, scaled=16), "region-hashes")  # read four times
    regions, organisms = sets.select("seq_id", "hash").distinct(), sets.select("grp", "hash").distinct().where("grp is not null")
    shared = regions.join(organisms, "hash").groupBy("seq_id", "grp").agg(F.count("*").alias("shared"))
    x = sk.with_sizes(shared, regions, organisms, "seq_id", "grp").where("jaccard >= 0.01")
    x = x.withColumn("no", F.row_number().over(Window.partitionBy("seq_id").orderBy(F.desc("jaccard"), "grp"))).where("no <= 3")
    x = x.select("seq_id", "grp", F.round("jaccard", 6).alias("jaccard"), F.round("containment_1_in_2", 6).alias("containment_region"), F.round("containment_2_in_1", 6).alias("containment_organism"))
    return x.withColumn("place", F.row_number().over(Window.partitionBy("seq_id").orderBy(F.desc("containment_region"), "grp")))


@query("ani_matrix", "E17", uses="seqs", sql=f"""WITH {_REGIONS.rpartition(', r AS')[0]}, g AS (SELECT DISTINCT grp, hash FROM s WHERE grp IS NOT NULL AND hash < 1152921504606846976 // 64), n AS (SELECT grp, count(*) AS n FROM g GROUP BY grp),
p AS (SELECT a.grp AS g1, b.grp AS g2, count(*) AS shared FROM g a JOIN g b ON a.hash = b.hash AND a.grp < b.grp GROUP BY ALL), q AS (SELECT g1, g2, pow(shared * 1.0 / x.n, 1 / 21.0) AS a, pow(shared * 1.0 / y.n, 1 / 21.0) AS b FROM p JOIN n x ON x.grp = g1 JOIN n y ON y.grp = g2)
SELECT g1, g2, round((a + b) / 2, 6) AS mean, round(least(a, b), 6) AS min, round(greatest(a, b), 6) AS max FROM q""")
def ani_matrix(t):
    sets = materialize(sk.shingle_hashes(t.seqs, ["grp"], "text", 5, scaled=64).where("grp is not null"), "group-hashes")
    a, b = sets.select(F.col("grp").alias("g1"), "hash"), sets.select(F.col("grp").alias("g2"), "hash")
    p = sk.with_sizes(a.join(b, "hash").where("g1 < g2").groupBy("g1", "g2").agg(F.count("*").alias("shared")), a, b, "g1", "g2")
    x, y = fx.containment_to_ani(F.col("containment_1_in_2"), 21), fx.containment_to_ani(F.col("containment_2_in_1"), 21)
    return p.select("g1", "g2", F.round((x + y) / 2, 6).alias("mean"), F.round(F.least(x, y), 6).alias("min"), F.round(F.greatest(x, y), 6).alias("max"))


@query("coded_bins", "E23", sql="SELECT p_brand, octet_length(encode(string_agg(p_size, ',' ORDER BY p_partkey)))::INT AS n_bytes, sum(p_size)::BIGINT AS total, base64(encode(string_agg(p_size, ',' ORDER BY p_partkey))) AS coded FROM part GROUP BY p_brand")
def coded_bins(t):
    """Bins as base64 text, and what decoding gives back."""
    bins = t.part.groupBy("p_brand").agg(F.sort_array(F.collect_list(F.struct("p_partkey", "p_size"))).alias("b"))
    text = F.array_join(F.transform("b", lambda x: x["p_size"].cast("string")), ",")
    coded = bins.select("p_brand", F.replace(F.base64(text.cast("binary")), F.lit("\r\n"), F.lit("")).alias("coded"))
    back = F.unbase64("coded")
    total = F.aggregate(F.split(back.cast("string"), ","), F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))
    return coded.select("p_brand", F.octet_length(back).alias("n_bytes"), total.alias("total"), "coded")


@query("removal_files", "K3 K5", uses="aln", sql="""WITH k AS (SELECT ref_id, read_id, mapq + score < max(mapq + score) OVER (PARTITION BY read_id) AS gone FROM aln)
SELECT ref_id::VARCHAR AS ref_id, count(*) FILTER (gone) AS removed, count(DISTINCT CASE WHEN gone THEN read_id END) AS listed, count(*) FILTER (NOT gone) AS kept FROM k GROUP BY ref_id HAVING count(*) FILTER (gone) > 0""")
def removal_files(t):
    """The list of removed reads and a workbook of two sheets, written and read back."""
    spark, top = t.aln.sparkSession, shared_path(t.aln.sparkSession, "removal")
    k = t.aln.withColumn("gone", F.col("mapq") + F.col("score") < F.max(F.col("mapq") + F.col("score")).over(Window.partitionBy("read_id")))
    writers.write_removals(k.where("gone").select("ref_id", "read_id").distinct(), f"{top}/list", "ref_id", "read_id")
    ref = S("ref_id").alias("ref_id")
    writers.write_sheets({"removed": k.where("gone").groupBy(ref).agg(F.count("*").alias("removed")), "kept": k.where("not gone").groupBy(ref).agg(F.count("*").alias("kept"))}, f"{top}/book")
    listed = spark.read.csv(f"{top}/list", sep="\t", schema="ref_id string, read_id long").groupBy("ref_id").agg(F.count("*").alias("listed"))
    book = {name: spark.read.parquet(f"{top}/book/{name}") for name in ("removed", "kept")}
    return book["removed"].join(listed, "ref_id").join(book["kept"], "ref_id", "left").withColumn("kept", F.coalesce("kept", F.lit(0)))


@query("running_gini", "E13", sql="""
WITH v AS (SELECT l_suppkey AS k, l_quantity::DOUBLE AS v, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS i FROM lineitem), c AS (SELECT k, v, i, sum(v) OVER (PARTITION BY k ORDER BY i) AS cum FROM v)
SELECT k AS l_suppkey, round(CASE WHEN sum(v) > 0 THEN 2 * sum(cum) / (count(*) * sum(v)) - (count(*) + 1) * 1.0 / count(*) ELSE 0 END, 6) AS gini FROM c GROUP BY k""")
def running_gini(t):
    """The coefficient by sums of running sums, which weigh the smallest values most: the usual one's negative."""
    return iv.gini(t.lineitem, "l_suppkey", "l_quantity").select("l_suppkey", F.round(-F.col("gini"), 6).alias("gini"))


@query("priority_union", "U6", uses="det", sql="""
WITH u AS (SELECT sample, organism, tass, 0 AS p, 'high' AS origin FROM det WHERE tass >= 60 UNION ALL SELECT sample, organism, tass + 1, 1, 'covered' FROM det WHERE coverage >= 45 UNION ALL SELECT sample, organism, tass + 2, 2, 'any' FROM det WHERE reads > 2)
SELECT sample, organism, round(tass, 4) AS tass, origin FROM u QUALIFY row_number() OVER (PARTITION BY sample, organism ORDER BY p) = 1""")
def priority_union(t):
    """Rows of several sources, of which the first that has a key gives its row."""
    d = t.det
    sources = [("high", d.where("tass >= 60"), 0), ("covered", d.where("coverage >= 45"), 1), ("any", d.where("reads > 2"), 2)]
    rows = None
    for no, (name, own, more) in enumerate(sources):
        own = own.select("sample", "organism", F.struct(F.lit(no).alias("no"), (F.col("tass") + more).alias("tass"), F.lit(name).alias("origin")).alias("x"))
        rows = own if rows is None else rows.unionByName(own)
    return rows.groupBy("sample", "organism").agg(F.min("x").alias("x")).select("sample", "organism", F.round("x.tass", 4).alias("tass"), "x.origin")
