"""Cross-sample operators on rows worked out by hand."""

from pyspark.sql import functions as F

from tallyseq.operators import compare as cm


def test_joint_coverage_can_exceed_each_sample(spark):
    rows = spark.createDataFrame([("r", 1, 0, 5, 20), ("r", 2, 5, 10, 20), ("r", 2, 12, 40, 20)], "ref string, sample int, s int, e int, len int")
    got = {r.bin: (r.union_pct, r.max_pct) for r in cm.combined_coverage(rows, "ref", "sample", "len", 10).collect()}
    assert got == {0: (100.0, 50.0), 1: (80.0, 80.0)}


def test_downsampling_counts_absent_bins_as_zero(spark):
    rows = spark.createDataFrame([("a", 5, 0, 10.0), ("a", 5, 4, 30.0)], "k string, n int, bin long, pct double")
    got = {r.point: r.value for r in cm.downsampled(rows, ["k"], "n", 2).collect()}
    assert got == {0: 5.0, 1: 10.0}  # bins 0-1 and 2-4
    assert {r.point: r.value for r in cm.downsampled(rows, ["k"], "n", 9).collect()} == {0: 10.0, 4: 30.0}


def test_value_cooccurrence(spark):
    rows = spark.createDataFrame([("x", 1, 4.0), ("y", 1, 8.0), ("x", 2, 2.0), ("z", 9, 1.0), (None, 1, 5.0)], "o string, s int, v double")
    got = {(r.a, r.b): (r.shared, r.mean_value) for r in cm.value_cooccurrence(rows.where("o is not null"), "o", "s", "v", 2).collect()}
    assert got == {("x", "x"): (2, 3.0), ("x", "y"): (1, 6.0), ("y", "y"): (1, 8.0)}


def test_specimens_prefer_overrides_and_need_no_fields(spark):
    s = spark.createDataFrame([("a", " p "), ("b", ""), ("c", None)], "sample string, Specimen string")
    o = spark.createDataFrame([("a", "q"), ("b", "")], "sample string, specimen string")
    got = {r.sample: (r.specimen, r.origin) for r in cm.specimens(s, "sample", cm.SPECIMEN_FIELDS, o).collect()}
    assert got == {"a": ("q", "override"), "b": ("b", "sample"), "c": ("c", "sample")}
    assert cm.specimens(s.select("sample"), "sample", cm.SPECIMEN_FIELDS).where("origin = 'sample'").count() == 3


def test_kingdom_buckets(spark):
    cases = [("Bacteria", "Fungi", "Bacteria"), ("Virus", None, "Viruses"), ("Eukaryota", "Basidiomycota", "Fungi"), ("Eukaryota", "x", "OtherEuk"), (None, "Orthornavirae", "Viruses"), ("", "odd", None)]
    df = spark.createDataFrame(cases, "d string, k string, want string")
    assert df.where(~cm.kingdom_bucket(F.col("d"), F.col("k")).eqNullSafe(F.col("want"))).count() == 0


def test_rescues(spark):
    rows = spark.createDataFrame(
        [("s", "gene", 1, 1, "a", "g", 5, 10.0, 10.0, 10.0), ("s", "reads", 2, 2, "b", "g", 5, 10.0, 10.0, 10.0), ("s", "named", 3, 3, "Sp X", "g", 0, 10.0, 10.0, 10.0),
         ("s", "genus", 4, 4, "d", "Gen", 0, 10.0, 10.0, 10.0), ("s", "nothing", 5, 5, "e", "h", 0, 10.0, 10.0, 10.0), ("s", "genus passes", 6, 6, "f", "g", 9, 10.0, 10.0, 90.0)],
        "sample string, organism string, taxid long, subkey long, species string, genus string, reads long, tass double, species_tass double, genus_tass double")
    genes = spark.createDataFrame([("s", "gene"), ("s", "gene")], "sample string, organism string")
    cand = spark.createDataFrame([("s", "Species", None, " sp x"), ("s", "genus", None, "gen"), ("t", "species", 5, "e")], "sample string, rank string, taxid long, name string")
    got = {r.organism: (r.tag, r.novelty) for r in cm.rescues(rows, genes, cand, 50).collect()}
    assert got == {"gene": ("belowCutoffVFAMR", None), "reads": ("belowCutoffAligned", None), "named": ("noveltyNoAlign", "sp"), "genus": ("noveltyNoAlign", "gen")}
    assert cm.rescues(rows.limit(0), genes.limit(0), cand.limit(0), 50).count() == 0


def test_vectors_are_padded_with_zeros(spark):
    rows = spark.createDataFrame([("x", 1, 60.0), ("x", 2, 40.0)], "o string, s int, v double")
    r = cm.sample_vectors(rows, "o", "s", ["v"], 50, 4).first()
    assert (r.detected, r.passing, r.below, r.prevalence_pct, r.v_mean, r.v_median, r.v_least, r.v_most, r.v_vector) == (2, 1, 1, 50.0, 25.0, 20.0, 0.0, 60.0, [0.0, 0.0, 40.0, 60.0])
