"""Hand-computed cases and properties of the operators, readers, writers and streams."""

import gzip
import math
import random

import pytest
from pyspark.sql import functions as F

from tallyseq.functions import formulas as fx
from tallyseq.operators import conflict, intervals, lookup, score, setjoin, sketch, taxonomy
from tallyseq.operators.graph import connected_components
from tallyseq.sources import readers, writers
from tallyseq.streaming import windows


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def ivs(spark, rows):
    return spark.createDataFrame([("r", a, b) for a, b in rows], "ref string, s long, e long")


def test_interval_union_and_adjacency(spark):
    assert intervals.covered_length(ivs(spark, [(0, 10), (5, 20), (30, 40)]), ["ref"]).first().covered == 30
    near = ivs(spark, [(0, 10), (11, 20)])
    assert intervals.covered_length(near, ["ref"], gap=1).first().covered == 20
    assert intervals.merge_intervals(near, ["ref"], gap=0).count() == 2


def test_depth_sweep(spark):
    got = sorted(tuple(r)[1:] for r in intervals.depth_runs(ivs(spark, [(0, 4), (2, 6)]), "ref").collect())
    assert got == [(0, 2, 1), (2, 4, 2), (4, 6, 1)]


def test_bins_do_not_change_intervals(spark):
    rng = random.Random(1)
    rows = [(a, a + rng.randint(1, 60)) for a in (rng.randint(0, 900) for _ in range(200))]
    df = ivs(spark, rows)
    wide, fine = (sorted(map(tuple, intervals.merge_intervals(df, ["ref"], width=w).collect())) for w in (1 << 20, 16))
    assert wide == fine
    runs = [sorted(map(tuple, intervals.depth_runs(df, "ref", width=w).collect())) for w in (1 << 20, 16)]
    assert runs[0] == runs[1]
    covered = set().union(*[range(a, b) for a, b in rows])
    assert intervals.covered_length(df, ["ref"], gap=0).first().covered == len(covered)
    assert sum((b - a) * d for _, a, b, d in runs[0]) == sum(b - a for a, b in rows)


def test_overlap_join_matches_brute_force(spark):
    rng = random.Random(2)
    left = [(a, a + rng.randint(0, 90)) for a in (rng.randint(0, 500) for _ in range(60))]
    right = [(a, a + rng.randint(1, 90)) for a in (rng.randint(0, 500) for _ in range(60))]
    df, ws = ivs(spark, left), spark.createDataFrame([("r", a, b) for a, b in right], "ref string, w_start long, w_end long")
    got = intervals.overlap_join(df, ws, ["ref"], width=32).count()
    assert got == sum(c < b and d > a for a, b in left if b > a for c, d in right)


@pytest.mark.parametrize("values,want", [([1, 1, 1, 1], 0.0), ([0, 0, 0, 1], 0.75)])
def test_gini(spark, values, want):
    df = spark.createDataFrame([("k", v) for v in values], "k string, v long")
    assert intervals.gini(df, "k", "v").first().gini == pytest.approx(want)


def test_formulas(spark):
    r = one(spark, a=fx.sigmoid(F.lit(0.01), 0.01, 12000), b=fx.sigmoid(F.lit(0.02), 0.01, 12000), c=fx.mapq_probability(F.lit(10.0)), d=fx.normal_cdf(F.lit(1.0)), e=fx.normal_cdf(F.lit(-2.5)), f=fx.truthy(F.lit(" yes")), g=fx.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)))
    assert (r.a, r.b, r.c, r.f) == (0.5, 1.0, pytest.approx(0.9), True)
    phi = lambda z: (1 + math.erf(z / math.sqrt(2))) / 2
    assert r.d == pytest.approx(phi(1), abs=2e-7) and r.e == pytest.approx(phi(-2.5), abs=2e-7) and r.g == pytest.approx(6371 * math.pi / 2)
    assert fx.ani_to_jaccard(1.0, 21) == 1.0


def test_rank_disparity(spark):
    df = spark.createDataFrame([("g", 10, 1), ("g", 5, 2), ("g", 1, 3), ("h", 4, 4)], "g string, n long, k long")
    assert [r.disparity for r in score.rank_disparity(df, "g", "n", "k").orderBy("k").collect()] == [1.0, 0.5, 0.0, 1.0]


def test_best_alignment_and_groups(spark):
    df = spark.createDataFrame([("r", "A", 60), ("r", "B", 60), ("r", "C", 10)], "read string, ref string, score long")
    assert sorted(r.ref for r in conflict.best_alignments(df, "read", F.col("score")).where("best").collect()) == ["A", "B"]
    df = spark.createDataFrame([("r", "a1", "g1", 60), ("r", "a2", "g1", 50), ("r", "b", "g2", 40)], "read string, ref string, grp string, score long")
    assert sorted(r.ref for r in conflict.best_groups(df, "read", "grp", F.col("score")).where("kept").collect()) == ["a1", "a2"]


def test_shared_pairs_and_budget(spark):
    rows = [(i, "a") for i in range(10)] + [(i, "b") for i in range(6, 12)]
    p = conflict.shared_read_pairs(spark.createDataFrame(rows, "read_id long, ref_id string")).first()
    assert (p.n1, p.n2, p.shared, p.jaccard) == (10, 6, 4, pytest.approx(4 / 12))
    n = spark.createDataFrame([("g", "big", 100), ("g", "small", 10), ("alone", "x", 5)], "g string, ref string, n long")
    assert {r.ref: r.budget for r in conflict.removal_budget(n, "g", "ref", "n").collect()} == {"big": 0, "small": 10}


def test_controls(spark):
    row = lambda v: spark.createDataFrame([("o", v)], "k string, tass double")
    r = score.control_flags(row(50.0), row(40.0), row(10.0), "k", "tass").first()
    assert (r.fold_neg, r.neg_flag, r.fold_pos) == (1.25, "within_negative", 5.0)
    r = score.control_flags(row(50.0), row(0.0), row(10.0), "k", "tass").first()
    assert (r.fold_neg, r.neg_flag) == (float("inf"), "above_negative")


def test_minhash_score_without_comparison(spark):
    r = one(spark, a=score.minhash_score(F.lit(0.0), F.lit(0.0), F.lit(0.9), F.lit(0.4)), b=score.minhash_score(F.lit(0.5), F.lit(0.25), F.lit(1.0), F.lit(0.4)))
    assert (r.a, r.b) == (0.2, pytest.approx(0.85))


def test_components_match_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(200)] + [(5, 5), (None, 3)]
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()))
    assert got == {n: root(n) for n in up}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_closure_finds_cycles_and_depth(spark):
    chain = spark.range(1, 20).select(F.col("id").alias("taxid"), (F.col("id") - 1).alias("parent"))
    assert taxonomy.closure(chain).count() == 20 * 21 // 2
    with pytest.raises(ValueError):
        taxonomy.closure(spark.createDataFrame([(1, 2), (2, 1)], "taxid long, parent long"))


def test_lookup_prefix_and_versions(spark):
    df = spark.createDataFrame([("Aus bus strain 1",), ("Aus busy",), ("",)], "t string")
    dim = spark.createDataFrame([("Aus",), ("Aus bus",)], "p string")
    assert {r.t: r.p for r in lookup.longest_prefix(df, dim, "t", "p").collect()} == {"Aus bus strain 1": "Aus bus", "Aus busy": "Aus", "": None}
    d = spark.createDataFrame([("A.1", 1), ("B.2", 2)], "acc string, taxid long")
    got = lookup.with_version_fallback(spark.createDataFrame([("A.1",), ("A.9",), ("C",)], "acc string"), d, "acc", "taxid").collect()
    assert {r.acc: r.taxid for r in got} == {"A.1": 1, "A.9": 1, "C": None}


def write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_readers(spark, tmp_path):
    assert readers.read_bedgraph(spark, write(tmp_path, "a.bg", "c\t0\t5\t2.5\n")).first().depth == 2.5
    assert readers.read_depth(spark, write(tmp_path, "a.depth", "c  7\t3\n\n")).first().pos == 7
    fa = readers.read_fasta(spark, write(tmp_path, "a.fa", ">s1 first one\nACGT\nAC\n>s2\nTT>T\n")).orderBy("name").collect()
    assert [(r.name, r.description, r.sequence) for r in fa] == [("s1", "first one", "ACGTAC"), ("s2", "", "TT>T")]
    with gzip.open(tmp_path / "a.fq.gz", "wt") as f:
        f.write("@r1 x\nACGT\n+\nIIII\n@r2\nAC\n+\n!I\n")
    fq = readers.read_fastq(spark, str(tmp_path / "a.fq.gz")).orderBy("name").collect()
    assert [(r.name, r.sequence, r.mean_quality) for r in fq] == [("r1", "ACGT", 40.0), ("r2", "AC", 20.0)]
    report = "90.0\t90\t0\tR\t1\troot\n80.0\t80\t5\tG\t10\t  Aus\n60.0\t60\t60\tS\t100\t    Aus bus\n10.0\t10\t10\tG\t11\t  Cus\n"
    k = {r.taxid: (r.parent, r.depth, r.name) for r in readers.read_classifier_report(spark, write(tmp_path, "k2", report)).collect()}
    assert k == {1: (None, 0, "root"), 10: (1, 1, "Aus"), 100: (10, 2, "Aus bus"), 11: (1, 1, "Cus")}
    d = readers.read_dump(spark, write(tmp_path, "nodes", "2\t|\t1\t|\tgenus\t|\n"), ["taxid", "parent", "rank"]).first()
    assert tuple(d) == ("2", "1", "genus")
    m = readers.read_accession_map(spark, write(tmp_path, "m.csv", 'Acc,Organism_Name,Mapped_Value\nA.1,"Aus, bus",7\n')).first()
    assert tuple(m) == ("A.1", "A", 7, "Aus, bus")
    sheet = ",".join(f"c{i}" for i in range(17)) + "\nAus,5,Primary,,\"Gut, skin\",,established,TRUE,x,,,,,,,,dna\n"
    p = readers.read_pathogen_sheet(spark, write(tmp_path, "p.csv", sheet)).first()
    assert (p.taxid, p.pathogenic_sites, p.commensal_sites, p.high_consequence, p.mol_type) == (5, ["gut", "skin"], [], True, "dna")
    h = readers.read_distributions(spark, write(tmp_path, "h.tsv", "tax_id\tbody_site\trank\tname\tmean\tstd\tsite_count\tabundances\n1\tgut\tS\tx\t0.1\t0.2\t4\t1,2,x\n")).first()
    assert h.abundances == [1.0, 2.0, None] and h.normalised == 0.75
    schema = "name string, n long"
    for text in ('{"name": "a", "n": 1}', '{"samples": [{"name": "a", "n": 1}]}'):
        assert tuple(readers.read_sample_json(spark, write(tmp_path, f"{len(text)}.json", text), schema).first()) == ("a", 1)
    assert readers.read_predictions(spark, write(tmp_path, "pr.json", '{"predictions": [{"id": "q", "topk_predictions": [{"label": "x", "confidence": 0.5}]}]}')).first()["rank"] == 1
    a = readers.read_assembly_summary(spark, write(tmp_path, "as.txt", "# c\nA\t1\nB\t2\tx\ty\n"), ["acc", "taxid", "name"]).orderBy("acc").collect()
    assert [tuple(r) for r in a] == [("A", "1", None), ("B", "2", "x\ty")]
    f = readers.read_features(spark, write(tmp_path, "f.gff", "##gff\nc\ts\tgene\t11\t20\t.\t+\t.\tID=g1;x=y\n")).first()
    assert (f.start, f.end, f.name) == (10, 20, "g1")
    assert readers.read_clusters(spark, write(tmp_path, "cl", "a\tb\n")).first().member == "b"
    assert readers.read_blast6(spark, write(tmp_path, "bl", "q\ts\t99.5\t10\t0\t0\t1\t10\t1\t10\t1e-9\t50\n")).first().evalue == 1e-9


def test_samplesheet(spark):
    rows = [("a b", "x.fastq.gz", None), ("a b", "y.fq", "z.fq"), ("c", "SRR1", ""), ("", "x.fq", None), ("d", "x.txt", None), ("e", "x.fq", "x.fq")]
    out = readers.validate_samplesheet(spark.createDataFrame(rows, "sample string, fastq_1 string, fastq_2 string")).collect()
    got = {(r.sample, r.fastq_1): (r.problem, r.sample_id) for r in out}
    assert got["a b", "x.fastq.gz"] == (None, "a_b_T1") and got["a b", "y.fq"] == (None, "a_b_T2") and got["c", "SRR1"] == (None, "c")
    assert got["", "x.fq"][0] == "no sample name" and got["d", "x.txt"][0] == "first file has no read format" and got["e", "x.fq"][0] == "both files are the same"


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("s", "g", "a", 1), ("s", "g", "b", 2), ("s", "h", "c", 3)], "sample string, genus string, sp string, n long")
    writers.write_nested_json(df, str(tmp_path / "j"), "sample", "genus", "sp", ["n"])
    r = spark.read.json(str(tmp_path / "j")).first()
    assert [len(o["members"]) for o in r.organisms] == [2, 1]
    writers.write_by_key(df, str(tmp_path / "k"), "genus")
    assert sorted(p.name for p in (tmp_path / "k").glob("genus=*")) == ["genus=g", "genus=h"]
    writers.write_tsv(df, str(tmp_path / "t"))
    assert spark.read.csv(str(tmp_path / "t"), sep="\t", header=True).count() == 3
    writers.write_sheets({"one": df, "two": df.limit(1)}, str(tmp_path / "w"))
    assert spark.read.parquet(str(tmp_path / "w/two")).count() == 1
    seqs = spark.createDataFrame([("x", "A" * 100)], "name string, seq string")
    writers.write_fasta(seqs, str(tmp_path / "f"), "name", "seq")
    assert readers.read_fasta(spark, str(tmp_path / "f")).first().sequence == "A" * 100
    writers.write_removals(df, str(tmp_path / "r"), "genus", "sp")
    assert spark.read.csv(str(tmp_path / "r"), sep="\t").count() == 3


def test_stream_gives_the_same_windows(spark, tmp_path):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    ev.orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ev.schema).parquet(str(tmp_path / "in"))
    q = windows.windowed_counts(stream, "ts", ["event_type"], "value", "1 day").writeStream.format("memory").queryName("daily").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    want = windows.windowed_counts(ev, "ts", ["event_type"], "value", "1 day")
    key = lambda d: sorted((r.window_start, r.event_type, r.n) for r in d.collect())
    assert key(spark.table("daily")) == key(want)


def test_nothing_else_imports_the_optional_part():
    import pathlib
    import re

    root = pathlib.Path(__file__).parent.parent / "tallyseq"
    for p in root.rglob("*.py"):
        if "llm" not in p.parts:
            assert not re.search(r"tallyseq\.llm|import llm", p.read_text()), p


def test_top_k_grows_with_the_sets(spark):
    sets = spark.createDataFrame([(i, i % 2, h) for i in range(240) for h in (1, 2, 3)], "id long, g int, hash long")
    n = setjoin.similar_pairs(sets, "id", "g", 0.1, top=10, share=0.1).groupBy("q").count().collect()
    assert len(n) == 240 and {r["count"] for r in n} == {24}
    assert setjoin.similar_pairs(sets.where("id < 60"), "id", "g", 0.1, top=10, share=0.1).count() == 600


def test_shingles_with_equal_32_bits_differ(spark):
    rows = [(1, "k15231"), (2, "k25525")]
    assert sketch.shingle_hashes(spark.createDataFrame(rows, "id long, t string"), ["id"], "t", 1).select("hash").distinct().count() == 2


def test_clusters_take_every_shared_read(spark):
    rng = random.Random(5)
    rows = [(r, rng.randrange(60)) for r in range(25) for _ in range(2)] + [(90, 70), (91, 71)]
    rows += [(100 + i, ref) for i in range(50) for ref in (80, 81)]  # one strong pair doesn't hide weak ones
    group = {ref: {ref} for _, ref in rows}
    for r, a in rows:
        for q, b in rows:
            if r == q and group[a] is not group[b]:
                group[a] |= group[b]
                for x in group[b]:
                    group[x] = group[a]
    df = spark.createDataFrame(rows, "read_id long, ref_id long")
    got = {r.node: r.component for r in conflict.read_clusters(df).collect()}
    assert got == {ref: min(g) for ref, g in group.items() if len(g) > 1}


def test_components_of_reads_without_their_pairs(spark):
    """A read on 3,000 references links them by as many rows; its pairs would be 4.5 million."""
    from tallyseq.operators import conflict

    wide = spark.range(3_000).selectExpr("1L as read_id", "id as ref_id")
    rest = spark.createDataFrame([(2, 5_000), (2, 5_000), (3, 6_000), (3, 6_001), (4, 6_001), (4, 7_000), (None, 8_000), (None, 8_001), (5, None), (5, 2)], "read_id long, ref_id long")
    aln = wide.unionByName(rest)
    links = conflict.read_clusters(aln)
    want = {x: 0 for x in range(3_000)} | {6_000: 6_000, 6_001: 6_000, 7_000: 6_000, 8_000: 8_000, 8_001: 8_000}
    assert {r.node: r.component for r in links.collect()} == want
    pairs = conflict.read_clusters(rest, min_shared=2)
    assert pairs.count() == 0


def test_sums_of_ends_are_shuffled_once(spark):
    from tallyseq.operators import intervals

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.createDataFrame([("a", 1, 9, 3)], "k string, s long, e long, m int")
        for out in (intervals.masked_coverage(df, "k", "m", 2), intervals.masked_runs(df, "k", "m", 2), intervals.depth_runs(df, "k")):
            assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
