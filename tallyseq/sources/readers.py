"""Readers of the file formats that evidence tables come in. All give typed columns by Spark's readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyseq.operators.taxonomy import parents_by_indent
from tallyseq.session import materialize

#: Column names of tabular protein hits.
BLAST6 = "qseqid string, sseqid string, pident double, length long, mismatch long, gapopen long, qstart long, qend long, sstart long, send long, evalue double, bitscore double"
#: Header names of accession maps, lower case.
SYNONYMS = {
    "accession": ("acc", "accession", "accession_version", "refseq", "accession.version", "ref"),
    "taxid": ("taxid", "tax_id", "mapped_value", "staxids", "taxon_id", "ncbi_taxid", "species_taxid"),
    "name": ("name", "description", "desc", "seqname", "sequence_name", "refseq_name", "organism", "org", "species", "scientific_name", "organism_name"),
}
#: Lines and characters at the start of a map that tell its dialect.
HEAD_LINES, HEAD_CHARS = 64, 8_192


def read_bedgraph(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="chrom string, start int, end int, depth float")


def read_depth(spark: SparkSession, path: str) -> DataFrame:
    """Positions with any white space between the fields."""
    p = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(F.trim("value") != "").select(p[0].alias("ref"), p[1].cast("long").alias("pos"), p[2].cast("long").alias("depth"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(name, description, sequence): records end at the next '>' that starts a line."""
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("v")).where(F.trim("v") != "")
    head = F.regexp_extract("v", r"^([^\r\n]*)", 1)
    return rows.select(
        F.split(head, r"\s+", 2)[0].alias("name"), F.coalesce(F.get(F.split(head, r"\s+", 2), F.lit(1)), F.lit("")).alias("description"),
        F.regexp_replace(F.regexp_replace("v", r"^[^\r\n]*", ""), r"\s+", "").alias("sequence"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, no, v): lines with their number in the file, from 0. A line in the middle of a file doesn't know
    its number, so each split's line count gives the next one's start. Gzip is read by one task a file."""
    lines = spark.read.text(path).select(
        F.input_file_name().alias("file"), F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("id"), F.regexp_replace("value", "\r$", "").alias("v"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("id").alias("low")).select("file", "block", "low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return lines.join(starts, ["file", "block"]).select("file", (F.col("start") + F.col("id") - F.col("low")).alias("no"), "v")


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """(name, sequence, quality, mean_quality). Records are four lines and can't be told apart from the
    middle of a file, so lines are numbered first."""
    rows = numbered_lines(spark, path).select("file", F.floor(F.col("no") / 4).alias("record"), (F.col("no") % 4).alias("at"), "v")
    line = lambda i: F.max(F.when(F.col("at") == i, F.col("v")))
    out = rows.groupBy("file", "record").agg(F.regexp_replace(F.split(line(0), " ")[0], "^@", "").alias("name"), line(1).alias("sequence"), line(3).alias("quality"))
    q = F.aggregate(F.split("quality", ""), F.lit(0), lambda a, c: a + F.when(c != "", F.ascii(c) - 33).otherwise(0))
    return out.where(F.col("quality").isNotNull()).select("name", "sequence", "quality", (q / F.length("quality")).alias("mean_quality"))


def read_alignments(spark: SparkSession, path: str, secondary: bool = True, supplementary: bool = True) -> DataFrame:
    """Alignment text (SAM lines) as half-open intervals; header lines and unmapped reads go, secondary and
    supplementary ones on request.

    The reference length is the sum of the CIGAR's M, D, N, = and X; NM is the tag of that name, or null.
    """
    p = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.startswith("value", F.lit("@")) & (F.size(p) >= 11))
    flag = p[1].cast("int")
    spans = F.regexp_extract_all(p[5], F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    length = F.aggregate(spans, F.lit(0).cast("long"), lambda a, n: a + n.cast("long"))
    has = lambda bit: flag.bitwiseAND(bit) != 0
    out = rows.select(
        p[0].alias("read_id"), p[2].alias("ref_id"), (p[3].cast("long") - 1).alias("s"), (p[3].cast("long") - 1 + length).alias("e"), p[4].cast("int").alias("mapq"),
        has(0x4).alias("_unmapped"), has(0x10).alias("is_reverse"), has(0x100).alias("is_secondary"), has(0x800).alias("is_supplementary"),
        F.nullif(F.regexp_extract("value", r"\tNM:i:(\d+)", 1), F.lit("")).cast("int").alias("mismatches"))
    keep = ~F.col("_unmapped") & (F.col("ref_id") != "*")
    keep = keep if secondary else keep & ~F.col("is_secondary")
    return out.where(keep if supplementary else keep & ~F.col("is_supplementary")).drop("_unmapped")


def fetch(alignments: DataFrame, ref: str, start: int, end: int, longest: int | None = None) -> DataFrame:
    """Alignments that overlap [start, end) of a reference. On a table that `write_sorted` made, row groups of
    other ranges are skipped; with the longest alignment given, the start is bounded from below as well."""
    hit = (F.col("ref_id") == ref) & (F.col("s") < end) & (F.col("e") > start)
    return alignments.where(hit if longest is None else hit & (F.col("s") > start - longest))


def read_classifier_report(spark: SparkSession, path: str) -> DataFrame:
    """Indented classifier report with row numbers, depth and the parent's taxid, per file of any size."""
    p = F.split("v", "\t")
    rows = numbered_lines(spark, path).where(F.size(p) >= 6).select(
        "file", F.col("no").alias("row_id"), F.trim(p[0]).cast("double").alias("abundance"), p[1].cast("long").alias("clade"), p[2].cast("long").alias("own"), F.trim(p[3]).alias("rank"), F.trim(p[4]).cast("long").alias("taxid"), p[5].alias("indented"))
    return parents_by_indent(rows, "taxid", "row_id", "indented", "file").withColumn("name", F.trim("indented")).drop("indented")


def read_dump(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Taxonomy dump with fields between bars; names of the first fields, numbers stay text."""
    p = F.split(F.regexp_replace("value", r"\s*\|\s*$", ""), r"\s*\|\s*")
    return spark.read.text(path).select(*[F.trim(F.get(p, F.lit(i))).alias(n) for i, n in enumerate(names)])


def _cells(line: Column, sep: Column, width: int) -> Column:
    """The first `width` fields of a delimited line, quoted ones without their quotes; missing and empty ones
    are null."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    one = lambda d: F.from_csv(line, schema, {"sep": d, "quote": '"', "escape": '"'})
    fields = lambda x: F.array(*[F.trim(x[f"c{i}"]) for i in range(width)])
    return F.when(sep == "\t", fields(one("\t"))).otherwise(fields(one(",")))


def map_dialects(lines: DataFrame, columns: tuple[int, int, int] = (0, 4, 2), widest: int = 256) -> DataFrame:
    """(file, sep, header, accession, taxid, name) of numbered lines (file, no, v): each file's delimiter,
    whether its first line names columns, and the positions of the columns.

    The delimiter is a tab if the head of the file has one and at least as many as commas, else a comma. A first
    line with any known name is a header, and its known names (the last of a kind) set the positions;
    `columns` are those otherwise. Of each file a bounded head is gathered.
    """
    head = lines.where(F.col("no") < HEAD_LINES).groupBy("file").agg(F.sort_array(F.collect_list(F.struct("no", F.substring("v", 1, HEAD_CHARS).alias("v")))).alias("x"))
    text = F.substring(F.array_join(F.transform("x", lambda r: r["v"]), "\n"), 1, HEAD_CHARS)
    head = head.select("file", text.alias("t"), F.element_at("x", 1)["v"].alias("first"))
    count = lambda c: F.length("t") - F.length(F.replace("t", F.lit(c), F.lit("")))
    head = head.withColumn("sep", F.when((count("\t") > 0) & (count("\t") >= count(",")), "\t").otherwise(","))
    head = head.withColumn("names", F.transform(_cells(F.col("first"), F.col("sep"), widest), lambda c: F.lower(F.coalesce(c, F.lit("")))))
    every = [n for names in SYNONYMS.values() for n in names]
    at = lambda kind, default: F.coalesce(F.array_max(F.transform("names", lambda c, i: F.when(c.isin(*SYNONYMS[kind]), i))), F.lit(default)).alias(kind)
    return head.select("file", "sep", F.exists("names", lambda c: c.isin(*every)).alias("header"), *[at(k, d) for k, d in zip(SYNONYMS, columns)])


def read_accession_maps(spark: SparkSession, path: str, has_header: bool = True, columns: tuple[int, int, int] = (0, 4, 2)) -> DataFrame:
    """(file, no, accession, taxid, name) of all maps at a path, each by its own dialect; texts, names may be
    null.

    A first line that names no known column is skipped if `has_header` says so, and is a row else. Rows
    without an accession or a taxid go, short ones among them; a row without a name stays. A row is one line.
    """
    lines = numbered_lines(spark, path)
    known = materialize(map_dialects(lines, columns), "dialects")
    width = 1 + (known.agg(F.max(F.greatest(*SYNONYMS))).first()[0] or 0)
    rows = lines.join(known, "file").where(~((F.col("no") == 0) & (F.col("header") | F.lit(has_header))))
    rows = rows.withColumn("c", _cells(F.col("v"), F.col("sep"), width))
    out = rows.select("file", "no", *[F.get("c", F.col(k)).alias(k) for k in SYNONYMS])
    return out.where((F.col("accession") != "") & (F.col("taxid") != ""))


def map_conflicts(rows: DataFrame) -> DataFrame:
    """(accession, taxids, files) of accessions with several taxids among rows of read_accession_maps."""
    c = rows.groupBy("accession").agg(F.sort_array(F.collect_set("taxid")).alias("taxids"), F.sort_array(F.collect_set("file")).alias("files"))
    return c.where(F.size("taxids") > 1)


def resolved_map(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((accession, taxid), (taxid, name)): an accession's last row by file and line wins, a taxid's first."""
    order = F.struct("file", "no")
    return rows.groupBy("accession").agg(F.max_by("taxid", order).alias("taxid")), rows.groupBy("taxid").agg(F.min_by(F.coalesce("name", F.lit("")), order).alias("name"))


def read_accession_map(spark: SparkSession, path: str) -> DataFrame:
    """(accession, acc_nov, taxid, name): read_accession_maps with taxids as numbers and bare accessions."""
    rows = read_accession_maps(spark, path)
    return rows.select("accession", F.regexp_replace("accession", r"\.\d+$", "").alias("acc_nov"), F.col("taxid").try_cast("long").alias("taxid"), "name")


def read_pathogen_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Annotation sheet by position: name, taxid, class, sites, status, flags and molecule type."""
    rows = spark.read.csv(path, header=True, quote='"', escape='"', enforceSchema=True)
    at = {0: "name", 1: "taxid", 2: "callclass", 4: "pathogenic_sites", 5: "commensal_sites", 6: "status", 7: "high_consequence", 8: "pathology", 16: "mol_type"}
    cols = []
    for i, n in at.items():
        c = F.trim(F.col(f"`{rows.columns[i]}`")) if i < len(rows.columns) else F.lit(None).cast("string")
        if n.endswith("sites"):
            c = F.filter(F.transform(F.split(F.lower(F.coalesce(c, F.lit(""))), ","), lambda x: F.trim(x)), lambda x: x != "")
        elif n == "high_consequence":
            c = F.coalesce(F.upper(c).isin("TRUE", "1", "YES", "Y"), F.lit(False))
        elif n == "taxid":
            c = c.try_cast("long")
        cols.append(c.alias(n))
    return rows.select(*cols)


def read_distributions(spark: SparkSession, path: str) -> DataFrame:
    """Population abundances by taxon and body site; lists in a cell become arrays of numbers."""
    rows = spark.read.csv(path, sep="\t", header=True)
    values = F.transform(F.split("abundances", ","), lambda x: x.try_cast("double"))
    return rows.select(
        F.col("tax_id").cast("long").alias("tax_id"), "body_site", "rank", "name", F.col("mean").cast("double").alias("mean"), F.col("std").cast("double").alias("std"), F.col("site_count").cast("long").alias("site_count"),
        values.alias("abundances")).withColumn("normalised", F.aggregate("abundances", F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0))) / F.col("site_count"))


def read_sample_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Sample reports, single or bundled under `samples`, one row per sample; schema is that of a sample."""
    one = T._parse_datatype_string(schema)
    both = T.StructType([*one.fields, T.StructField("samples", T.ArrayType(one))])
    rows = spark.read.json(path, multiLine=True, schema=both)
    single = F.array(F.struct(*[F.col(f"`{f.name}`") for f in one.fields]))
    return rows.select(F.explode(F.coalesce("samples", single)).alias("s")).select("s.*")


def read_blast6(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=BLAST6)


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="representative string, member string")


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """(id, label, confidence, rank) of top-k predictions in a JSON file."""
    schema = "predictions array<struct<id:string,topk_predictions:array<struct<label:string,confidence:double>>>>"
    p = spark.read.json(path, multiLine=True, schema=schema).select(F.explode("predictions").alias("p"))
    return p.select("p.id", F.posexplode("p.topk_predictions").alias("rank", "t")).select("id", "t.label", "t.confidence", (F.col("rank") + 1).alias("rank"))


def read_assembly_summary(spark: SparkSession, path: str, names: list[str], sep: str = "\t") -> DataFrame:
    """Ragged table: short rows are padded with nulls, surplus fields fold into the last column; comment
    lines go."""
    n = len(names)
    p = F.split("value", sep, -1)
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    last = F.when(F.size(p) >= n, F.array_join(F.slice(p, n, F.size(p)), sep))
    return rows.select(*[F.get(p, F.lit(i)).alias(c) for i, c in enumerate(names[:-1])], last.alias(names[-1]))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Feature table (GFF columns) as half-open intervals."""
    cols = "seqid string, source string, type string, start long, end long, score string, strand string, phase string, attributes string"
    rows = spark.read.csv(path, sep="\t", comment="#", schema=cols)
    return rows.select("seqid", (F.col("start") - 1).alias("start"), "end", "type", "strand", F.regexp_extract("attributes", r"(?:^|;)(?:ID|Name)=([^;]+)", 1).alias("name"))


def read_feature_table(spark: SparkSession, path: str) -> DataFrame:
    """Feature table with a `# feature` column as (accession, start, end, name) of its coding sequences; its
    positions stay as they are."""
    rows = spark.read.csv(path, sep="\t", header=True).where(F.col("`# feature`") == "CDS")
    return rows.select(F.col("genomic_accession").alias("accession"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "name")


def validate_samplesheet(rows: DataFrame) -> DataFrame:
    """Adds problem (null if a row is fine), single_end and a suffix for samples with several rows."""
    f1, f2 = F.trim(F.coalesce("fastq_1", F.lit(""))), F.trim(F.coalesce("fastq_2", F.lit("")))
    ok = lambda c: c.rlike(r"(?i)\.f(ast)?q(\.gz)?$") | c.rlike(r"^(SRR|ERR|DRR|PRJ)")
    problem = (
        F.when(F.trim(F.coalesce("sample", F.lit(""))) == "", "no sample name").when(f1 == "", "no first file").when(~ok(f1), "first file has no read format")
        .when((f2 != "") & ~ok(f2), "second file has no read format").when(f1 == f2, "both files are the same"))
    name = F.regexp_replace(F.trim("sample"), r"\s+", "_")
    w = Window.partitionBy(name)
    many = F.count("*").over(w)
    no = F.row_number().over(w.orderBy(f1, f2))
    return rows.withColumns({"problem": problem, "single_end": f2 == "", "sample_id": F.when(many > 1, F.concat(name, F.lit("_T"), no)).otherwise(name)})


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows with a gapless index in a global order, by a sorted pass in ranges and per-range counts."""
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id())
    kept = materialize(sorted_rows, "numbered")
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept.groupBy("_p").agg(F.count("*").alias("_n"), F.min("_i").alias("_low")).select("_p", "_low", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return kept.join(F.broadcast(starts), "_p").withColumn("index", F.col("_start") + F.col("_i") - F.col("_low")).drop("_p", "_i", "_low", "_start")
