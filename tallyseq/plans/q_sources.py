"""Sources and sinks as round trips through the shared folder, and class resolution."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.operators import classify as cl
from tallyseq.operators import intervals as iv
from tallyseq.operators import taxonomy as tx
from tallyseq.plans.base import query
from tallyseq.session import shared_path
from tallyseq.sources import readers, writers


def _text(df, *lines) -> str:
    """Write lines of text and give their folder."""
    path = shared_path(df.sparkSession, "source")
    df.select(F.concat(*lines).alias("value")).write.text(path)
    return path


def _cell(c: str):
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _row(*cols, sep="\t"):
    out = []
    for c in cols:
        out += [c if not isinstance(c, str) else _cell(c), F.lit(sep)]
    return out[:-1]


_RUNS = """
x AS (SELECT ref_id, s AS pos, 1 AS d FROM aln UNION ALL SELECT ref_id, e, -1 FROM aln), y AS (SELECT ref_id, pos, sum(d) AS d FROM x GROUP BY ref_id, pos HAVING sum(d) <> 0),
z AS (SELECT ref_id, pos AS start, lead(pos) OVER w AS stop, sum(d) OVER w AS depth FROM y WINDOW w AS (PARTITION BY ref_id ORDER BY pos))"""


@query("bedgraph_source", "S3 K1", uses="aln", sql=f"WITH {_RUNS} SELECT ref_id::VARCHAR AS chrom, count(*) AS n, sum(stop - start)::BIGINT AS bp, max(depth)::DOUBLE AS top FROM z WHERE depth > 0 AND stop IS NOT NULL GROUP BY ref_id")
def bedgraph_source(t):
    runs = iv.depth_runs(t.aln, "ref_id")
    bg = readers.read_bedgraph(runs.sparkSession, _text(runs, *_row("ref_id", "start", "end", "depth")))
    return bg.groupBy("chrom").agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("bp"), F.max("depth").cast("double").alias("top"))


@query("depth_source", "S4", uses="aln", sql="SELECT ref_id::VARCHAR AS ref, count(*) AS n, sum(score)::BIGINT AS total FROM aln GROUP BY ref_id")
def depth_source(t):
    d = readers.read_depth(t.aln.sparkSession, _text(t.aln, *_row("ref_id", "s", "score", sep="  ")))
    return d.groupBy("ref").agg(F.count("*").alias("n"), F.sum("depth").alias("total"))


@query("fasta_source", "S5 K6", sql="SELECT 'p' || p_partkey AS name, p_brand AS description, length(md5(p_name) || md5(p_type)) AS n, md5(p_name) || md5(p_type) AS sequence FROM part")
def fasta_source(t):
    p = t.part.select(F.concat(F.lit("p"), _cell("p_partkey"), F.lit(" "), "p_brand").alias("name"), F.concat(F.md5("p_name"), F.md5("p_type")).alias("seq"))
    path = shared_path(p.sparkSession, "fasta")
    writers.write_fasta(p, path, "name", "seq", width=20)
    return readers.read_fasta(p.sparkSession, path).select("name", "description", F.length("sequence").cast("bigint").alias("n"), "sequence")


@query("fastq_source", "S6", sql="SELECT 'r' || o_orderkey AS name, substr(md5(o_orderkey::VARCHAR), 1, 10) AS sequence, (7 + o_orderkey % 30)::DOUBLE AS mean_quality FROM orders")
def fastq_source(t):
    q = F.repeat(F.char(40 + F.col("o_orderkey") % 30), F.lit(10))
    path = _text(t.orders, F.lit("@r"), _cell("o_orderkey"), F.lit(" x\n"), F.substring(F.md5(_cell("o_orderkey")), 1, 10), F.lit("\n+\n"), q)
    return readers.read_fastq(t.orders.sparkSession, path).select("name", "sequence", "mean_quality")


@query("read_classes", "S8", sql="SELECT o_orderstatus AS status, o_custkey % 50 AS taxid, count(*) AS n FROM orders GROUP BY 1, 2")
def read_classes(t):
    path = _text(t.orders, *_row("o_orderstatus", "o_orderkey", (F.col("o_custkey") % 50).cast("string")))
    rows = t.orders.sparkSession.read.csv(path, sep="\t", schema="status string, read string, taxid long")
    return rows.groupBy("status", "taxid").agg(F.count("*").alias("n"))


@query("accession_map_source", "S10", sql="SELECT 'A' || p_partkey || '.1' AS accession, 'A' || p_partkey AS acc_nov, p_size::BIGINT AS taxid, p_name || ', x' AS name FROM part")
def accession_map_source(t):
    path = shared_path(t.part.sparkSession, "source")
    rows = t.part.select(F.concat(F.lit("A"), _cell("p_partkey"), F.lit(".1")).alias("Acc"), F.concat("p_name", F.lit(", x")).alias("Organism_Name"), F.col("p_size").alias("TaxID"))
    rows.write.csv(path, header=True)
    return readers.read_accession_map(t.part.sparkSession, path)


@query("protein_hits", "S15 F14", sql="SELECT l_suppkey::VARCHAR AS sseqid, count(*) AS n, round(max(l_extendedprice), 2) AS bits FROM lineitem WHERE l_discount >= 0.05 AND l_tax <= 0.04 GROUP BY l_suppkey")
def protein_hits(t):
    one = F.lit("1")
    path = _text(t.lineitem, *_row("l_orderkey", "l_suppkey", "l_discount", "l_linenumber", one, one, one, one, one, one, "l_tax", "l_extendedprice"))
    hits = readers.read_blast6(t.lineitem.sparkSession, path).where("pident >= 0.05 and evalue <= 0.04")
    return hits.groupBy("sseqid").agg(F.count("*").alias("n"), F.round(F.max("bitscore"), 2).alias("bits"))


@query("ragged_summary", "S19", sql="SELECT p_partkey::VARCHAR AS acc, CASE WHEN p_size % 3 > 0 THEN p_brand END AS taxid, CASE WHEN p_size % 3 = 2 THEN p_type || chr(9) || 'extra' END AS name FROM part")
def ragged_summary(t):
    k = F.col("p_size") % 3
    path = _text(t.part, _cell("p_partkey"), F.when(k > 0, F.concat(F.lit("\t"), "p_brand")).otherwise(""), F.when(k == 2, F.concat(F.lit("\t"), "p_type", F.lit("\textra"))).otherwise(""))
    return readers.read_assembly_summary(t.part.sparkSession, path, ["acc", "taxid", "name"])


@query("population_source", "S12 A37", sql="SELECT p_partkey AS tax_id, round((p_size + p_size / 2.0) / 4, 6) AS normalised FROM part")
def population_source(t):
    half = (F.col("p_size") / 2).cast("string")
    rows = t.part.select(
        F.col("p_partkey").alias("tax_id"), F.lit("gut").alias("body_site"), F.lit("S").alias("rank"), F.col("p_name").alias("name"), F.lit(0.1).alias("mean"), F.lit(0.2).alias("std"),
        F.lit(4).alias("site_count"), F.concat_ws(",", _cell("p_size"), half).alias("abundances"))
    path = shared_path(t.part.sparkSession, "source")
    writers.write_tsv(rows, path)
    return readers.read_distributions(t.part.sparkSession, path).select("tax_id", F.round("normalised", 6).alias("normalised"))


@query("keyed_files", "K5 K7 K3", sql="SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_returnflag")
def keyed_files(t):
    spark = t.lineitem.sparkSession
    path = shared_path(spark, "keyed")
    writers.write_by_key(t.lineitem, path, "l_returnflag")
    rows = spark.read.parquet(path).where("l_returnflag <> 'N'")  # reads the folders of those keys alone
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


_CLOSURE = "c AS (SELECT taxid AS node, taxid AS ancestor, 0 AS distance FROM (SELECT taxid FROM nodes UNION SELECT parent FROM nodes) UNION ALL SELECT c.node, n.parent, distance + 1 FROM c JOIN nodes n ON n.taxid = c.ancestor)"


@query("class_resolution", "X15 S11 E6 E7", uses="nodes", sql=f"""WITH RECURSIVE {_CLOSURE},
sheet AS (SELECT DISTINCT node AS taxid, CASE node % 4 WHEN 0 THEN 'Primary' WHEN 1 THEN 'Potential' WHEN 2 THEN 'Commensal' ELSE 'Opportunistic' END AS category, node % 5 = 0 AS hc FROM c WHERE node % 3 = 0),
m AS (SELECT taxid, parent AS grp FROM nodes WHERE rank = 'strain'),
h AS (SELECT node AS taxid, arg_min(category, distance) AS category, arg_min(hc, distance) AS hc, min(distance) = 0 AS direct FROM c JOIN sheet ON sheet.taxid = ancestor GROUP BY node),
o AS (SELECT grp, coalesce(category, 'Unknown') AS category, coalesce(hc, false) AS hc, CASE WHEN direct THEN 'Direct' WHEN NOT direct THEN 'Derived' END AS origin FROM m LEFT JOIN h USING (taxid))
SELECT grp, arg_min(category, list_position(['Primary', 'Opportunistic', 'Potential', 'Commensal', 'Unknown'], category)) AS category, bool_or(hc) AS high_consequence, CASE WHEN count(DISTINCT origin) > 1 THEN 'Mixed' ELSE max(origin) END AS origin FROM o GROUP BY grp""")
def class_resolution(t):
    paths = tx.closure(t.nodes)
    k = F.col("taxid") % 4
    cat = F.when(k == 0, "Primary").when(k == 1, "Potential").when(k == 2, "Commensal").otherwise("Opportunistic")
    sheet = paths.select(F.col("node").alias("taxid")).distinct().where("taxid % 3 = 0").select("taxid", cat.alias("category"), (F.col("taxid") % 5 == 0).alias("high_consequence"))
    members = t.nodes.where("rank = 'strain'").select("taxid", F.col("parent").alias("grp"))
    return cl.resolve_classes(paths, sheet, members, "taxid", "grp")[1]


@query("site_classes", "E5 E6", sql="""
WITH s AS (SELECT c_custkey % 8 AS k, c_nationkey % 4 AS j FROM customer),
b AS (SELECT j, CASE k WHEN 0 THEN 'blood' WHEN 1 THEN 'gut swab' WHEN 2 THEN 'nasal' WHEN 3 THEN 'skin' WHEN 4 THEN 'stool' WHEN 5 THEN 'gut' WHEN 6 THEN 'sterile' ELSE 'unknown' END AS site FROM s),
a AS (SELECT site, CASE j WHEN 0 THEN 'Opportunistic' WHEN 1 THEN 'Potential' END AS callclass, CASE j WHEN 0 THEN ['gut'] WHEN 1 THEN ['nasal', 'blood'] WHEN 2 THEN [] END AS pathogenic,
 CASE j WHEN 0 THEN ['skin'] WHEN 1 THEN ['stool'] WHEN 2 THEN ['gut', 'skin'] END AS commensal FROM b),
r AS (SELECT *, coalesce(list_contains(pathogenic, site), false) AS p, coalesce(list_contains(commensal, site) OR site = 'stool' AND list_contains(commensal, 'gut') OR site = 'gut' AND list_contains(commensal, 'stool'), false) AS c FROM a)
SELECT site, CASE WHEN site = 'sterile' THEN coalesce(callclass, 'Primary') WHEN p THEN 'Primary' WHEN c THEN 'Commensal' ELSE coalesce(callclass, 'Unknown') END AS category,
 site = 'sterile' OR p OR c AS direct, count(*) AS n FROM r GROUP BY ALL""")
def site_classes(t):
    k, j = F.col("c_custkey") % 8, F.col("c_nationkey") % 4
    place = F.when(k == 0, "Whole BLOOD").when(k == 1, "gut swab").when(k == 2, "Nasopharynx").when(k == 3, "wound").when(k == 4, "Faeces").when(k == 5, "GI").when(k == 6, "ascites ")
    sites = lambda *names: F.array(*[F.lit(x) for x in names])
    s = t.customer.select(cl.body_site(place).alias("site"), F.when(j == 0, "Opportunistic").when(j == 1, "Potential").alias("callclass"),
        F.when(j == 0, sites("intestine")).when(j == 1, sites("nostril", "serum", "")).when(j == 2, sites()).alias("pathogenic"),
        F.when(j == 0, sites("epidermis")).when(j == 1, sites("feces")).when(j == 2, sites("bowel", "Skin")).alias("commensal"))
    c = cl.class_for_site(F.col("callclass"), F.col("pathogenic"), F.col("commensal"), F.col("site"), F.col("site") == "sterile")
    return s.withColumn("c", c).groupBy("site", "c.category", "c.direct").agg(F.count("*").alias("n"))


@query("organism_order", "T6", uses="det", sql="SELECT sample, genus, max(tass) AS top, row_number() OVER (PARTITION BY sample ORDER BY max(tass) DESC, genus) AS place FROM det GROUP BY sample, genus")
def organism_order(t):
    g = t.det.groupBy("sample", "genus").agg(F.max("tass").alias("top"))
    return g.withColumn("place", F.row_number().over(Window.partitionBy("sample").orderBy(F.desc("top"), "genus")))
