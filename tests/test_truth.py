"""Naming rules, removal masks and the sweep over all of them, by hand and against separate runs."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyseq.operators import conflict, intervals, records, truth
from tallyseq.plans import catalog


@pytest.mark.parametrize("name, first, appended, parts, canonical", [
    ("NC_003310.1_3323_4", "NC", "NC_003310.1", "NC_003310.1", "NC_003310"),
    ("@NC_003310.1_3323_4", "@NC", "@NC_003310.1", "@NC_003310.1", "NC_003310"),
    ("NC_003310.1|Some virus", "NC", "NC_003310.1|Some virus", None, "NC_003310"),
    ("NC-003310_77_8", "NC-003310", "NC-003310", "NC-003310", "NC_003310"),
    (" AB12345.2 x", " AB12345.2 x", "AB12345.2 x", None, "AB12345"),
    ("plain7", "plain7", "plain7", None, "plain7"),
    ("a_b", "a", "a_b", None, "a"),
    ("a_b_c_d", "a", "a_b_c_d", "a_b", "a"),
    ("", "", "", None, None),
    (None, None, "", None, None),
])
def test_names(spark, name, first, appended, parts, canonical):
    row = spark.createDataFrame([(name,)], "n string").select(*[truth.truth_of(F.col("n"), r).alias(r) for r in ("first", "appended", "parts", "canonical")]).first()
    assert tuple(row) == (first, appended, parts, canonical)


def test_masks(spark):
    rows = [("r", "a1", "g1", "h", 60), ("r", "a2", "g1", "h", 50), ("r", "b", "g2", "h", 40), ("r", "c", None, None, 10), ("q", "a1", "g1", "h", 5), ("t", "x", None, "h", 7), ("t", "y", None, "h", 6), (None, "a1", "g1", "h", 0)]
    df = spark.createDataFrame(rows, "read string, ref string, species string, genus string, score int")
    got = {(r.read, r.ref): r.mask for r in truth.keep_masks(df, "read", "ref", ["ref", "species", "genus"], F.col("score")).collect()}
    assert got == {("r", "a1"): 15, ("r", "a2"): 13, ("r", "b"): 9, ("r", "c"): 1, ("q", "a1"): 15, ("t", "x"): 15, ("t", "y"): 9, (None, "a1"): 15}


def test_sweep_equals_separate_runs(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(900):
        s = rng.choice([rng.randrange(60_000), rng.randrange(40)])
        rows.append((rng.choice("aaab"), s, s + rng.choice([0, 1, 2, 30, 9_000]), rng.randrange(16)))
    rows += [("edge", 0, 10, 1), ("edge", 11, 20, 1), ("edge", 22, 23, 3), ("edge", 23, 24, 2), ("none", 5, 5, 15)]
    df = spark.createDataFrame(rows, "k string, s long, e long, m int")
    got = {r.k: tuple(r)[1:] for r in intervals.masked_coverage(df, "k", "m", 4, width=1 << 10).collect()}
    want = {k: [0] * 4 for k in got}
    for i in range(4):
        for r in intervals.covered_length(df.where(f"m & {1 << i} <> 0 and s < e"), ["k"]).collect():
            want[r.k][i] = r.covered
    assert got == {k: tuple(v) for k, v in want.items()}
    assert got["edge"] == (21, 2, 0, 0) and "none" not in got


def test_runs_of_masks(spark):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), s := rng.randrange(9_000), s + rng.choice([0, 1, 2, 30, 700]), rng.randrange(1, 4)) for _ in range(300)]
    rows += [("edge", 0, 10, 1), ("edge", 11, 20, 3), ("edge", 22, 23, 3), ("edge", 1024, 1030, 1), ("edge", 1031, 1040, 2)]
    df = spark.createDataFrame(rows, "k string, s long, e long, m int")
    runs = intervals.masked_runs(df, "k", "m", 2, width=1 << 10)
    for i in range(2):
        w = F.sum(F.when((F.col(f"d{i}") > 0) | F.col(f"j{i}"), F.col("end") - F.col("start")).otherwise(0))
        own = df.where(f"m & {1 << i} <> 0 and s < e")
        assert {r.k: r.w for r in runs.groupBy("k").agg(w.alias("w")).collect()} == {r.k: r.covered for r in intervals.covered_length(own, ["k"]).collect()}
        got = {(r.k, r.start, r.end, r.depth) for r in runs.where(f"d{i} > 0").select("k", "start", "end", F.col(f"d{i}").alias("depth")).collect()}
        area = lambda x: sorted((k, p, d) for k, a, b, d in x for p in range(a, b))
        assert area(got) == area({tuple(r) for r in intervals.depth_runs(own, "k").collect()})


def test_confusion_of_few_reads(spark):
    reads = spark.createDataFrame([("A_1_1",), ("A_2_2",), ("B_1_1",), ("C_9_9",), ("C_9_9",)], "q string")
    aln = spark.createDataFrame([("A_1_1", "A"), ("A_1_1", "B"), ("A_2_2", "B"), ("B_1_1", "B"), ("B_1_1", "B"), ("other", "A")], "q string, ref string")
    cases = truth.read_cases(reads, aln, "q", "ref", truth.truth_of(F.col("_r"), "appended"))
    g = truth.global_confusion(cases).first()
    assert (g.tp, g.fp, g.fn) == (2, 1, 1) and g.precision == 2 / 3 and g.recall == 2 / 3
    by = {r.ref: (r.tp, r.fp, r.fn, r.tn, r.truth_support, r.pred_support) for r in truth.reference_confusion(cases, aln, "q", "ref").collect()}
    assert by == {"A": (1, 0, 1, 2, 2, 1), "B": (1, 2, 0, 1, 1, 3), "C": (0, 0, 1, 3, 1, 0)}


def test_levels_and_taxa(spark):
    taxa = spark.createDataFrame([("a1", "s1"), ("a2", "s1"), ("b", "s2")], "accession string, taxon string")
    aln = spark.createDataFrame([("a1", "a1"), ("a2", "a1"), ("b", "a1"), ("?", "b"), ("b", "nowhere"), (None, "b"), ("b", "b")], "t string, a string")
    counts = {r.taxon: (r.tp, r.fp) for r in truth.taxon_counts(aln, F.col("t"), F.col("a"), taxa).collect()}
    assert counts == {"s1": (2, 1), "s2": (1, 1)}
    members = spark.createDataFrame([("k", "s1"), ("k", "s1"), ("k", "s3"), ("k", "zero")], "level string, grp string")
    c = spark.createDataFrame([("k", "s1", 2, 1), ("k", "s2", 1, 1), ("k", "s3", 0, 4), ("k", "zero", 0, 0), ("k", "s4", 0, 9)], "level string, grp string, tp long, fp long")
    r = truth.level_metrics(members, c, "level", "grp").first()
    assert (r.tp, r.fp, r.fn, r.tp_reads, r.fp_reads, r.precision, r.recall) == (1, 1, 1, 2, 5, 0.5, 0.5)


def test_breadths_round_as_the_twin_does(spark, tmp_path):
    """16,974 of 26,496,000 bases are 0.0640625 %, which is a tie only in its shortest decimal form."""
    con = duckdb.connect()
    tables = {
        "supplier": "SELECT 26396::BIGINT AS s_suppkey, 1 AS s_nationkey", "nation": "SELECT 1 AS n_nationkey, 2 AS n_regionkey",
        # 113 alignments of 150 bases and one of 24 that don't overlap
        "lineitem": """SELECT i::BIGINT AS l_orderkey, 26396::BIGINT AS l_suppkey, 0::BIGINT AS l_partkey, 0 AS l_linenumber, CASE WHEN i < 113 THEN 50.0 ELSE 8.0 END AS l_quantity, 0.05 AS l_discount, 'N' AS l_returnflag, 0.02 AS l_tax FROM range(114) r(i)"""}
    for t, text in tables.items():
        con.execute(f"COPY ({text}) TO '{tmp_path}/{t}.parquet'")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    rows = catalog.QUERIES["removal_levels"](spark, str(tmp_path))
    twin = con.execute(catalog.ORACLES["removal_levels"])
    got, want = rows.select(*[d[0] for d in twin.description]).collect(), twin.fetchall()
    assert got[0].bp0 == 16_974
    assert [tuple(r) for r in got] == want


def test_runs_cross_bins_and_gaps_of_one_base_are_seen_there(spark):
    rows = [("a", 10, 16, 3), ("a", 17, 40, 1), ("a", 33, 48, 2), ("a", 49, 60, 3), ("a", 80, 96, 1), ("a", 97, 99, 3), ("a", 5, 5, 3), (None, 1, 9, 3), ("b", 0, 16, 2), ("b", 17, 20, 2)]
    df = spark.createDataFrame(rows, "k string, s long, e long, m int")
    got = {(r.k, r.start): (r.end, r.d0, r.d1, r.j0, r.j1) for r in intervals.masked_runs(df, "k", "m", 2, width=16).collect()}
    want = {}
    for k in ("a", "b"):
        own = [r for r in rows if r[0] == k and r[1] < r[2]]
        at = sorted({p for r in own for p in r[1:3]})
        for p, q in zip(at, at[1:]):
            d = [sum(r[1] <= p < r[2] and r[3] >> i & 1 for r in own) for i in (0, 1)]
            j = [q - p == 1 and not d[i] and any(r[2] == p and r[3] >> i & 1 for r in own) and any(r[1] == q and r[3] >> i & 1 for r in own) for i in (0, 1)]
            want[k, p] = (q, *d, *j)
    assert got == want and any(x[3] for x in want.values()) and any(x[4] for x in want.values())


def test_records_count_reads_in_one_pass_over_alignments(spark):
    aln = [(1, 1, 0, 50, 10, 5), (1, 1, 60, 99, 20, 9), (2, 1, 10, 70, 20, 9), (1, 2, 5, 30, 1, 1), (2, 2, 6, 30, 2, 2), (2, 3, 0, 90, 0, 0), (1, None, 3, 20, 4, 4), (2, None, 3, 20, 4, 4)]
    df = spark.createDataFrame(aln, "ref_id long, read_id long, s long, e long, mapq int, score long")
    refs = spark.createDataFrame([(1, 100, 1, 1, False), (2, 100, 1, 1, False)], "ref_id long, length long, species int, genus int, is_plasmid boolean")
    got = {r.ref_id: (r.reads, r.share, r.retention) for r in records.reference_records(df, refs).collect()}
    assert got == {1: (2, 0.4, 0.5), 2: (3, 0.6, 1.0)}  # a read without a name is none


def test_tasks_grow_with_the_rows_and_results_stay(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(rng.choice("ab"), rng.randrange(50), s := rng.randrange(90_000), s + rng.choice([0, 3, 700])) for _ in range(600)], "k string, r int, s long, e long")
    rows = 10 << 20  # ten tasks, whatever the session's number of partitions
    merged = intervals.merge_intervals(df, ["k"], rows=rows)
    assert merged.exceptAll(intervals.merge_intervals(df, ["k"])).count() == 0
    budget = spark.createDataFrame([("a", 5), ("b", 9)], "k string, budget long")
    gone = conflict.removed_reads(df, budget, "r", "k", rows=rows)
    assert {tuple(r) for r in gone.collect()} == {tuple(r) for r in conflict.removed_reads(df, budget, "r", "k").collect()} and gone.count() == 14
    left = conflict.drop_removed(df, gone, "r", "k", rows=rows)
    assert left.exceptAll(conflict.drop_removed(df, gone, "r", "k")).count() == 0 and 0 < left.count() < 600
    for out in (merged, left):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count(", 10), REPARTITION_BY_NUM") >= 2
