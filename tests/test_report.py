"""Group summaries and flat rows by hand."""

from pyspark.sql import functions as F

from tallyseq.functions import places
from tallyseq.operators import annotations, report


def test_summary(spark):
    rows = [("g", 10, 60.0, None, False, 0.5, 2), ("g", 30, 20.0, "b", True, 0.1, 1), ("g", 0, 99.0, "a", False, None, 3), ("z", 0, 7.0, None, False, 1.0, 1), ("z", 0, 9.0, None, None, 0.0, 2)]
    df = spark.createDataFrame(rows, "k string, reads int, mapq double, cat string, hc boolean, dom double, no int")
    got = {r.k: r.asDict() for r in report.summarise(df.withColumn("w", F.col("reads")), ["k"], "w", "no", sums=["reads"], means=["mapq"], firsts=["cat"], anys=["hc"], spreads=["dom"]).collect()}
    assert got["g"] == {"k": "g", "reads": 40, "mapq": 30.0, "cat": "b", "hc": True, "dom_mean": 0.3, "dom_max": 0.5, "dom_sum": 0.6}
    assert got["z"] == {"k": "z", "reads": 0, "mapq": 8.0, "cat": None, "hc": False, "dom_mean": 0.5, "dom_max": 1.0, "dom_sum": 1.0}


def test_flat_rows(spark):
    kind = "sample string, level string, key string, subkey string, toplevelkey string, name string, reads double, tass double, coverage double, length long, covered_bases long, model_probability double, is_annotated string"
    rows = spark.createDataFrame([("s", "Strain", "k1", "sp", "g", "one", 25.0, 61.23456, 0.4567, 1000, 2000, 0.12345, "Yes"), ("s", "Strain", "k2", None, None, None, None, None, None, None, None, None, None), ("lone", "Strain", "k3", "sp", "g", "three", 1.0, 5.0, 2.0, 0, 9, None, "No")], kind)
    parents = spark.createDataFrame([("s", "sp", 70.0, "species one")], "sample string, key string, tass double, name string")
    out = report.flat_rows(rows, "sample", spark.createDataFrame([("s", 100)], "sample string, total_reads long"), {"species": parents, "genus": parents.where("false")})
    assert len(out.columns) >= 45
    got = {r.taxid: r for r in out.collect()}
    a, b, c = got["k1"], got["k2"], got["k3"]
    assert (a.pct_reads, a.coverage, a.breadth_pct, a.model_pct, a.is_annotated, a.species_tass, a.genus_tass, a.species_name, a.genus_name) == (25.0, 45.7, 100.0, 12.35, True, 70.0, 70.0, "species one", "species one")
    assert (b.name, b.subkey, b.reads, b.breadth_pct, b.model_pct, b.tass, b.species_tass, b.category) == ("Unknown", "k2", 0, 0.0, None, 0.0, 0.0, "Unknown")
    assert (c.pct_reads, c.coverage, c.breadth_pct, c.species_name, c.species_tass) == (100.0, 100.0, 0.0, "three", 5.0)


def test_pools(spark):
    rows = [("5", "Genus", "g", "3"), ("5", "genus ", "g", "x"), ("6", "family", "f", "1"), ("7", "species", "s", "2.9"), ("0", "no rank", "n", "9"), ("0", "species", "s0", "9"), ("8", "strain", "t", "0"), ("9", "tribe", "u", "4")]
    df = spark.createDataFrame(rows, "taxid string, rank string, name string, w string")
    totals, pools = annotations.taxon_pools(df, F.col("w"))
    assert tuple(totals.first()) == (3 + 1 + 1 + 2 + 9 + 4, 5)
    assert {(r.pool, r.taxid, r.n) for r in pools.collect()} == {("highrank", "5", 4), ("species", "7", 2)}
    totals, pools = annotations.taxon_pools(df, least=1, share=0.9)
    assert tuple(totals.first()) == (7, 3) and {r.pool for r in pools.collect()} == {"species"}


def test_places(spark):
    rows = [("country", "The  U.S.A.", ["united states of america"]), ("state", " ca ", ["ca", "california"]), ("state", "São Paulo", ["sao paulo"]), ("city", "us", ["us"]), ("country", None, []), ("state", "dc", ["dc", "district of columbia"])]
    df = spark.createDataFrame(rows, "f string, t string, want array<string>")
    assert [r.k for r in df.select(places.place_keys(F.col("f"), F.col("t")).alias("k")).collect()] == [r[2] for r in rows]


def test_main_axes(spark):
    import numpy as np

    from tallyseq.plans import catalog

    sf_dir = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("label", "embedding").collect()
    x, labels = np.array([r.embedding for r in rows], float), np.array([r.label for r in rows])
    _, axes = np.linalg.eigh(np.cov(x.T))
    along = x @ axes[:, ::-1][:, :2]
    want = {int(k): np.abs(along[labels == k].mean(axis=0)) for k in np.unique(labels)}
    for r in catalog.QUERIES["pca2"](spark, sf_dir).collect():
        assert np.abs(np.array([r.abs_pc1, r.abs_pc2]) - want[r.label]).max() < 2e-4 and r.n == (labels == r.label).sum()
