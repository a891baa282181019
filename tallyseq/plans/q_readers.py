"""Readers of alignments, taxonomies, sheets and predictions, each on files that a writer made."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyseq.plans.base import query
from tallyseq.plans.q_sources import _cell, _row, _text
from tallyseq.session import shared_path
from tallyseq.sources import bam, readers, writers


def _alignment_text(t) -> str:
    """The alignments as SAM lines; some reads are unmapped or supplementary, and a deletion lengthens some."""
    n, gap = F.col("e") - F.col("s"), F.when(F.col("score") % 3 == 0, "7D").otherwise("2S")
    k = F.col("part_id")
    flag = F.when(k % 10 == 0, 4).otherwise(0) + F.when(F.col("is_reverse"), 16).otherwise(0) + F.when(F.col("is_secondary"), 256).otherwise(0) + F.when(k % 10 == 1, 2048).otherwise(0)
    star = F.lit("*")
    return _text(t.aln, *_row(F.concat(F.lit("q"), _cell("read_id")), flag.cast("string"), F.concat(F.lit("r"), _cell("ref_id")), (F.col("s") + 1).cast("string"), "mapq", F.concat(n.cast("string"), F.lit("M"), gap), star, F.lit("0"), F.lit("0"), star, star, F.concat(F.lit("NM:i:"), (k % 7).cast("string"))))


_SAM = "sam AS (SELECT 'q' || read_id AS read_id, 'r' || ref_id AS ref_id, s, e + CASE WHEN score % 3 = 0 THEN 7 ELSE 0 END AS e, mapq, is_reverse, is_secondary, part_id % 7 AS nm FROM aln WHERE part_id % 10 > 1)"


@query("alignment_source", "S1 F17", uses="aln", sql=f"WITH {_SAM} SELECT ref_id, count(*) AS n, sum(e - s)::BIGINT AS bp, count(*) FILTER (WHERE is_reverse) AS reverse_n, sum(nm)::BIGINT AS mismatches, count(*) FILTER (WHERE nm * 20 <= e - s) AS close_n FROM sam WHERE NOT is_secondary GROUP BY ref_id")
def alignment_source(t):
    a = readers.read_alignments(t.aln.sparkSession, _alignment_text(t), secondary=False, supplementary=False)
    n = F.col("e") - F.col("s")
    return a.groupBy("ref_id").agg(F.count("*").alias("n"), F.sum(n).alias("bp"), F.count_if("is_reverse").alias("reverse_n"), F.sum("mismatches").alias("mismatches"), F.count_if(F.col("mismatches") * 20 <= n).alias("close_n"))


@query("region_fetch", "S2", uses="aln", sql=f"WITH {_SAM} SELECT read_id, s, e, mapq FROM sam WHERE ref_id = 'r3' AND s < 60000 AND e > 40000")
def region_fetch(t):
    spark, path = t.aln.sparkSession, shared_path(t.aln.sparkSession, "alignments")
    writers.write_sorted(readers.read_alignments(spark, _alignment_text(t), supplementary=False), path)
    table = spark.read.parquet(path)
    return readers.fetch(table, "r3", 40000, 60000).select("read_id", "s", "e", "mapq")


def _binary_alignments(t):
    """The same alignments as binary files, read back."""
    n, k = F.col("e") - F.col("s"), F.col("part_id")
    gap = F.when(F.col("score") % 3 == 0, "7D").otherwise("2S")
    flag = F.when(k % 10 == 0, 4).otherwise(0) + F.when(F.col("is_reverse"), 16).otherwise(0) + F.when(F.col("is_secondary"), 256).otherwise(0) + F.when(k % 10 == 1, 2048).otherwise(0)
    none = F.lit(None).cast("string")
    rows = t.aln.select(
        F.concat(F.lit("q"), _cell("read_id")).alias("read_id"), F.concat(F.lit("r"), _cell("ref_id")).alias("ref_id"), "s", "mapq", flag.alias("flag"), F.concat(n.cast("string"), F.lit("M"), gap).alias("cigar"),
        none.alias("sequence"), none.alias("quality"), F.lit(None).cast("int").alias("score"), (k % 7).cast("int").alias("mismatches"))
    refs = sorted((f"r{r.s_suppkey}", 110_000) for r in t.supplier.select("s_suppkey").collect())  # every file's header names all references
    path = shared_path(t.aln.sparkSession, "binary")
    bam.write_bam(rows, path, refs)
    return bam.read_bam(t.aln.sparkSession, path)


@query("binary_alignments", "S1 F17", uses="aln", sql=f"WITH {_SAM} SELECT ref_id, count(*) AS n, sum(e - s)::BIGINT AS bp, count(*) FILTER (WHERE is_reverse) AS reverse_n, sum(nm)::BIGINT AS mismatches, count(*) FILTER (WHERE nm * 20 <= e - s) AS close_n FROM sam WHERE NOT is_secondary GROUP BY ref_id")
def binary_alignments(t):
    a = _binary_alignments(t).where("not is_unmapped and not is_secondary and not is_supplementary")
    n = F.col("e") - F.col("s")
    return a.groupBy("ref_id").agg(F.count("*").alias("n"), F.sum(n).alias("bp"), F.count_if("is_reverse").alias("reverse_n"), F.sum("mismatches").alias("mismatches"), F.count_if(F.col("mismatches") * 20 <= n).alias("close_n"))


@query("binary_region", "S2", uses="aln", sql=f"WITH {_SAM} SELECT read_id, s, e, mapq FROM sam WHERE ref_id = 'r3' AND s < 60000 AND e > 40000")
def binary_region(t):
    return readers.fetch(_binary_alignments(t).where("not is_unmapped and not is_supplementary"), "r3", 40000, 60000).select("read_id", "s", "e", "mapq")


@query("report_source", "S7 W7", sql="""
WITH s AS (SELECT s_suppkey, n_nationkey, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT 100 + r_regionkey AS taxid, 1 AS parent, 1 AS depth, r_name AS name FROM region UNION ALL SELECT 1000 + n_nationkey, 100 + n_regionkey, 2, n_name FROM nation UNION ALL SELECT 10000 + s_suppkey, 1000 + n_nationkey, 3, 'strain ' || s_suppkey FROM s UNION ALL SELECT 1, NULL, 0, 'root'""")
def report_source(t):
    lit = lambda x: F.lit(x).cast("bigint")
    row = lambda df, a, b, c, depth, rank, taxid, name: df.select(a.alias("a"), b.alias("b"), c.alias("c"), F.lit(depth).alias("d"), F.lit(rank).alias("rank"), taxid.cast("bigint").alias("taxid"), name.alias("name"))
    reg, nat = F.col("n_regionkey").cast("bigint"), F.col("n_nationkey").cast("bigint")
    strains = t.supplier.join(F.broadcast(t.nation), F.col("s_nationkey") == nat)
    rows = (
        row(t.region.limit(1), lit(-1), lit(-1), lit(-1), 0, "R", F.lit(1), F.lit("root")).unionByName(row(t.region, F.col("r_regionkey").cast("bigint"), lit(-1), lit(-1), 1, "G", 100 + F.col("r_regionkey"), F.col("r_name")))
        .unionByName(row(t.nation, reg, nat, lit(-1), 2, "S", 1000 + nat, F.col("n_name")))
        .unionByName(row(strains, reg, nat, F.col("s_suppkey").cast("bigint"), 3, "S1", 10000 + F.col("s_suppkey"), F.concat(F.lit("strain "), _cell("s_suppkey")))))
    one = rows.repartition(1).sortWithinPartitions("a", "b", "c")  # a report is one file, in tree order
    path = _text(one, *_row(F.lit(" 1.5"), F.lit("9"), F.lit("3"), "rank", "taxid", F.concat(F.expr("repeat('  ', d)"), "name")))
    return readers.read_classifier_report(t.region.sparkSession, path).select("taxid", "parent", "depth", "name")


@query("dump_source", "S9", uses="nodes", sql="""
WITH m AS (SELECT 50000 + s_suppkey AS old, 10000 + s_suppkey AS new FROM supplier), a AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN 50000 + s_suppkey ELSE 10000 + s_suppkey END AS asked FROM supplier)
SELECT asked, coalesce(new, asked) AS taxid, parent, rank, 'name of ' || coalesce(new, asked) AS name FROM a LEFT JOIN m ON old = asked JOIN nodes ON taxid = coalesce(new, asked)""")
def dump_source(t):
    spark, bar = t.nodes.sparkSession, "\t|\t"
    end = F.lit("\t|")
    nodes = readers.read_dump(spark, _text(t.nodes, *_row("taxid", "parent", "rank", sep=bar), end), ["taxid", "parent", "rank"])
    kinds = t.nodes.select("taxid", F.explode(F.array(F.lit("synonym"), F.lit("scientific name"))).alias("kind"))
    name = F.concat(F.when(F.col("kind") == "synonym", "other of ").otherwise("name of "), _cell("taxid"))
    names = readers.read_dump(spark, _text(kinds, *_row("taxid", name, F.lit(""), "kind", sep=bar), end), ["taxid", "name", "unique_name", "kind"]).where("kind = 'scientific name'")
    k = F.col("s_suppkey")
    merged = readers.read_dump(spark, _text(t.supplier, *_row((50000 + k).cast("string"), (10000 + k).cast("string"), sep=bar), end), ["old", "new"])
    asked = t.supplier.select(F.when(k % 2 == 0, 50000 + k).otherwise(10000 + k).cast("string").alias("asked"))
    now = asked.join(merged, F.col("asked") == F.col("old"), "left").select("asked", F.coalesce("new", "asked").alias("taxid"))
    x = now.join(nodes, "taxid").join(names.select("taxid", "name"), "taxid")
    return x.select(*[F.col(c).cast("bigint").alias(c) for c in ("asked", "taxid", "parent")], "rank", "name")


@query("sheet_source", "S11", sql="""
SELECT p_name || ', "x"' AS name, CASE WHEN p_partkey % 4 > 0 THEN p_partkey END AS taxid, CASE WHEN p_partkey % 2 = 0 THEN 'Primary' ELSE 'Potential' END AS callclass, CASE WHEN p_partkey % 3 = 0 THEN 'blood|skin swab' ELSE '' END AS sites, p_partkey % 5 = 0 AS high_consequence, p_partkey % 7 AS n FROM part""")
def sheet_source(t):
    k, empty = F.col("p_partkey"), F.lit("")
    cells = {
        "Organism": F.concat("p_name", F.lit(', "x"')), "taxid": F.when(k % 4 > 0, k.cast("string")).otherwise("n/a"), "call class": F.when(k % 2 == 0, " Primary ").otherwise("Potential"), "c3": empty,
        "sites": F.when(k % 3 == 0, "Blood, skin swab,").otherwise(""), "commensal": empty, "status": (k % 7).cast("string"), "High Cons": F.when(k % 5 == 0, "true").otherwise("no")}
    path = shared_path(t.part.sparkSession, "sheet")
    t.part.select(*[c.alias(n) for n, c in cells.items()]).write.csv(path, header=True, quote='"', escape='"')
    s = readers.read_pathogen_sheet(t.part.sparkSession, path)
    return s.select("name", "taxid", "callclass", F.array_join("pathogenic_sites", "|").alias("sites"), "high_consequence", F.col("status").cast("bigint").alias("n"))


@query("sample_bundle_source", "S13 K2", uses="det", sql="""
SELECT sample, genus, organism, reads::BIGINT AS reads FROM det""")
def sample_bundle_source(t):
    """Half of the samples as single reports, the rest in one bundle, read back the same way and unnested."""
    spark = t.det.sparkSession
    nested = writers.nest(t.det.select("sample", "genus", F.substring("organism", 1, 8).alias("species"), "organism", "reads"), "sample", "genus", "species", ["organism", "reads"])
    schema = "sample string, organisms array<struct<toplevelkey:string,members:array<struct<subkey:string,members:array<struct<organism:string,reads:bigint>>>>>>"
    one, many = shared_path(spark, "reports"), shared_path(spark, "bundle")
    body = F.to_json(F.struct("sample", "organisms")).alias("value")
    half = F.xxhash64("sample") % 2 == 0
    nested.where(half).select("sample", body).select(F.col("sample").alias("file"), "value").write.partitionBy("file").text(one)  # a report is a file
    nested.where(~half).select(F.struct("sample", "organisms").alias("s")).groupBy().agg(F.to_json(F.struct(F.collect_list("s").alias("samples"))).alias("value")).write.text(many)  # and so is a bundle
    both = readers.read_sample_json(spark, one, schema).select("sample", "organisms").unionByName(readers.read_sample_json(spark, many, schema).select("sample", "organisms"))
    g = both.select("sample", F.inline("organisms")).select("sample", F.col("toplevelkey").alias("genus"), F.explode("members").alias("m"))
    return g.select("sample", "genus", F.inline("m.members"))


@query("cluster_source", "S16 J19", sql="SELECT 'c' || p_size AS representative, count(*) AS n, min('m' || p_partkey) AS first_member FROM part GROUP BY p_size")
def cluster_source(t):
    path = _text(t.part, *_row(F.concat(F.lit("c"), _cell("p_size")), F.concat(F.lit("m"), _cell("p_partkey"))))
    return readers.read_clusters(t.part.sparkSession, path).groupBy("representative").agg(F.count("*").alias("n"), F.min("member").alias("first_member"))


@query("prediction_source", "S17 A23", sql="""
WITH p AS (SELECT 'p' || p_partkey AS id, unnest([p_brand, p_type]) AS label, unnest([(p_size + 50) / 100.0, p_size / 200.0])::DOUBLE AS confidence, unnest([1, 2]) AS rank FROM part)
SELECT label, rank, count(*) AS n, round(avg(confidence), 6) AS mean_confidence, round(coalesce(stddev_samp(confidence), 0), 6) AS sd FROM p GROUP BY label, rank""")
def prediction_source(t):
    spark, path = t.part.sparkSession, shared_path(t.part.sparkSession, "predictions")
    hit = lambda label, c: F.struct(F.col(label).alias("label"), c.alias("confidence"))
    one = F.struct(F.concat(F.lit("p"), _cell("p_partkey")).alias("id"), F.array(hit("p_brand", (F.col("p_size") + 50) / 100), hit("p_type", F.col("p_size") / 200)).alias("topk_predictions"))
    files = t.part.select("p_size", one.alias("p")).groupBy("p_size").agg(F.to_json(F.struct(F.collect_list("p").alias("predictions"))).alias("value"))
    files.write.partitionBy("p_size").text(path)  # a file a model run
    p = readers.read_predictions(spark, path)
    return p.groupBy("label", "rank").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 6).alias("mean_confidence"), F.round(F.coalesce(F.stddev_samp("confidence"), F.lit(0.0)), 6).alias("sd"))


@query("samplesheet_source", "S18 W10", sql="""
WITH r AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE ' run ' || c_nationkey || ' ' END AS sample, CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'a.txt' ELSE c_custkey || '.fq.gz' END AS f1, CASE c_custkey % 3 WHEN 0 THEN c_custkey || '_2.fastq' WHEN 1 THEN '' ELSE CASE WHEN c_custkey % 2 = 0 THEN 'b.doc' ELSE c_custkey || '.fq.gz' END END AS f2 FROM customer),
p AS (SELECT *, replace(trim(sample), ' ', '_') AS nm, CASE WHEN trim(sample) = '' THEN 'no sample name' WHEN f1 = '' THEN 'no first file' WHEN f1 = 'a.txt' THEN 'first file has no read format' WHEN f2 = 'b.doc' THEN 'second file has no read format' WHEN f1 = f2 THEN 'both files are the same' END AS problem FROM r)
SELECT coalesce(problem, 'fine') AS problem, f2 = '' AS single_end, count(*) AS n, count(DISTINCT CASE WHEN nm <> '' THEN nm END) AS names FROM p GROUP BY 1, 2""")
def samplesheet_source(t):
    k = F.col("c_custkey")
    ks = _cell("c_custkey")
    rows = t.customer.select(
        F.when(k % 11 == 0, "").otherwise(F.concat(F.lit(" run "), _cell("c_nationkey"), F.lit(" "))).alias("sample"), F.when(k % 5 == 0, "").when(k % 5 == 1, "a.txt").otherwise(F.concat(ks, F.lit(".fq.gz"))).alias("fastq_1"),
        F.when(k % 3 == 0, F.concat(ks, F.lit("_2.fastq"))).when(k % 3 == 1, "").when(k % 2 == 0, "b.doc").otherwise(F.concat(ks, F.lit(".fq.gz"))).alias("fastq_2"))
    path = shared_path(rows.sparkSession, "samplesheet")
    rows.write.csv(path, header=True)
    sheet = readers.validate_samplesheet(rows.sparkSession.read.csv(path, header=True))
    name = F.nullif(F.regexp_replace("sample_id", r"_T\d+$", ""), F.lit(""))
    return sheet.groupBy(F.coalesce("problem", F.lit("fine")).alias("problem"), "single_end").agg(F.count("*").alias("n"), F.countDistinct(name).alias("names"))


@query("feature_source", "S21 A28", uses="aln", sql="""
WITH g AS (SELECT 'r' || ref_id AS accession, s + 1 AS s, e, CASE WHEN part_id % 3 = 0 THEN 'gene' ELSE 'CDS' END AS kind, 'f' || part_id AS name FROM aln)
SELECT accession, count(*) AS n, sum(e - s)::BIGINT AS bp, min(name) AS first_name, min(s - 1)::BIGINT AS least_start FROM g WHERE kind = 'CDS' GROUP BY accession""")
def feature_source(t):
    """The same features as a feature table and as GFF: lengths from the one, half-open starts from the other."""
    spark, k = t.aln.sparkSession, F.col("part_id")
    acc, name, kind = F.concat(F.lit("r"), _cell("ref_id")), F.concat(F.lit("f"), _cell("part_id")), F.when(k % 3 == 0, "gene").otherwise("CDS")
    path = shared_path(spark, "features")
    t.aln.select(kind.alias("# feature"), acc.alias("genomic_accession"), (F.col("s") + 1).alias("start"), F.col("e").alias("end"), name.alias("name")).write.csv(path, sep="\t", header=True)
    bed = readers.read_feature_table(spark, path).groupBy("accession").agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("bp"), F.min("name").alias("first_name"))
    dot = F.lit(".")
    gff = _text(t.aln, *_row(acc, F.lit("x"), kind, (F.col("s") + 1).cast("string"), "e", dot, F.lit("+"), dot, F.concat(F.lit("ID="), name)))
    low = readers.read_features(spark, gff).where("type = 'CDS'").groupBy(F.col("seqid").alias("accession")).agg(F.min("start").alias("least_start"))
    return bed.join(low, "accession")
