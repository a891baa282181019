"""Readers on small files worked out by hand."""

from tallyseq.operators.taxonomy import parents_by_indent
from tallyseq.sources import readers, writers


def _file(path, text):
    path.write_text(text)
    return f"file://{path}"


def test_alignments(spark, tmp_path):
    row = lambda *x: "\t".join(map(str, x)) + "\n"
    sam = "@SQ\tSN:r\tLN:9\n" + row("a", 16, "r", 11, 60, "5S10M2D3I4M6H", "*", 0, 0, "*", "*", "NM:i:2") + row("b", 4, "*", 0, 0, "*", "*", 0, 0, "*", "*")
    sam += row("c", 256, "r", 1, 5, "3M", "*", 0, 0, "*", "*") + row("d", 2048, "r", 1, 5, "3=1X2N", "*", 0, 0, "*", "*")
    path = _file(tmp_path / "x.sam", sam)
    got = {r.read_id: (r.s, r.e, r.is_reverse, r.mismatches) for r in readers.read_alignments(spark, path).collect()}
    assert got == {"a": (10, 26, True, 2), "c": (0, 3, False, None), "d": (0, 6, False, None)}
    assert [r.read_id for r in readers.read_alignments(spark, path, secondary=False, supplementary=False).collect()] == ["a"]


def test_fetch_reads_by_range_of_a_sorted_table(spark, tmp_path):
    a = spark.range(1000).selectExpr("concat('r', id % 2) ref_id", "id * 10 as s", "id * 10 + 25 as e")
    path = f"file://{tmp_path}/sorted"
    writers.write_sorted(a, path)
    hit = readers.fetch(spark.read.parquet(path), "r1", 100, 120, longest=25)
    assert sorted((r.s, r.e) for r in hit.collect()) == [(90, 115), (110, 135)]
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = readers.fetch(spark.read.parquet(path), "r1", 100, 120, longest=25)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters" in plan and "LessThan(s,120)" in plan and "GreaterThan(s,75)" in plan
    assert sorted((r.s, r.e) for r in readers.fetch(spark.read.parquet(path), "r1", 100, 120).collect()) == [(90, 115), (110, 135)]


def test_parents_at_any_depth_and_over_splits(spark, tmp_path):
    rows = [(f"n{i}", i, "  " * i + "x") for i in range(60)] + [("m", 60, "  y"), ("odd", 61, "      z")]
    got = {r.line: r.parent for r in parents_by_indent(spark.createDataFrame(rows, "line string, no int, name string"), "line", "no", "name").collect()}
    assert got["n59"] == "n58" and got["n0"] is None and got["m"] == "n0" and got["odd"] == "n2"
    lines = "".join(f"1\t1\t1\tS\t{i}\t{'  ' * (i % 3)}t{i}\n" for i in range(300))
    path = _file(tmp_path / "k.report", lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        r = {x.taxid: (x.row_id, x.parent) for x in readers.read_classifier_report(spark, path).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(r[i] == (i, None if i % 3 == 0 else i - 1) for i in range(300))


def test_feature_table(spark, tmp_path):
    path = _file(tmp_path / "f.tsv", "# feature\tgenomic_accession\tstart\tend\tname\ngene\ta\t1\t5\tx\nCDS\ta\t2\t9\ty\n")
    assert [tuple(r) for r in readers.read_feature_table(spark, path).collect()] == [("a", 2, 9, "y")]


def test_a_hot_key_is_written_by_several_tasks(spark, tmp_path):
    from tallyseq.sources import writers

    rows = spark.range(20_000).selectExpr("id", "if(id % 100 = 0, cast(id % 700 as string), 'hot') AS k", "map('a', id) AS m")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_by_key(rows, str(tmp_path / "k"), "k")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.parquet(str(tmp_path / "k"))
    assert back.where("k = 'hot'").count() == 19_800 and back.count() == 20_000 and back.select("id").distinct().count() == 20_000
    files = [r["count"] for r in back.where("k = 'hot'").groupBy("_metadata.file_path").count().collect()]
    assert len(files) >= 3 and max(files) < 9_000
    assert back.where("k <> 'hot'").select("_metadata.file_path").distinct().count() <= 7 + 4  # small keys aren't scattered
