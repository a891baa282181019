"""Scores and formulas against values computed by hand."""

import pytest
from pyspark.sql import functions as F

from tallyseq.functions import formulas as fx
from tallyseq.operators import classify as cl
from tallyseq.operators import conflict as cf
from tallyseq.operators import intervals as iv
from tallyseq.operators import score as sc


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


NUMBERS = [
    (lambda: sc.breadth_score(F.lit(0.01), F.lit(0.5)), 0.5 * 0.5**0.3),
    (lambda: sc.breadth_score(F.lit(0.02), F.lit(0.5), power=2.0), 0.25),
    (lambda: sc.gini_score(F.lit(0.96), F.lit(5e5), F.lit(0.4)), 0.432),  # 1.8 * 0.2 * 1 * (1 + 0.5 * 0.4)
    (lambda: sc.gini_score(F.lit(0.99), F.lit(5e6), F.lit(0.0)), 0.54),  # 1.8 * 0.1 * (1 + 2 * 1)
    (lambda: sc.gini_score(F.lit(0.5), F.lit(5e6), F.lit(0.4)), 1.0),
    (lambda: sc.gini_score(F.lit(1.01), F.lit(5e6), F.lit(0.4)), 0.0),
    (lambda: sc.gini_component(F.lit(0.8), F.lit(0.5), F.lit(0.5), F.lit(0.25)), 0.05),
    (lambda: sc.abundance_confidence(F.lit(50), F.lit(1_000_000)), 0.8807970779778823),  # one decade above 5: 1 / (1 + e^-2)
    (lambda: sc.abundance_confidence(F.lit(0), F.lit(1_000_000)), 0.0),
    (lambda: fx.depth_confidence(F.lit(0.00003), F.lit(10.0)), 0.75),
    (lambda: fx.depth_confidence(F.lit(0.000033), F.lit(25.0)), 0.6065306597126334 / 2),
    (lambda: fx.logarithmic_weight(F.lit(1e-5)), 1.0),
    (lambda: fx.logarithmic_weight(F.lit(0.001**0.5)), 0.9375),
    (lambda: fx.logarithmic_weight(F.lit(3.0)), 0.0),
    (lambda: sc.population_percentile(F.lit(1.0), F.lit(3.0), F.lit(1.0)), 0.022750131948179195**2),
    (lambda: sc.population_percentile(F.lit(3.0), F.lit(3.0), F.lit(1.0)), 0.5),
    (lambda: sc.population_percentile(F.lit(4.5), F.lit(3.0), F.lit(1.0)), 1 - 0.06680720126885807**1.5),
    (lambda: sc.population_percentile(F.lit(0.0), F.lit(3.0), F.lit(0.0)), 1 - 0.0013498980316300933**2),
    (lambda: fx.normal_cdf(F.lit(-5.0)), 2.866515718791933e-07),
    (lambda: fx.normal_cdf(F.lit(7.0)), 1.0),
]


@pytest.mark.parametrize("column, want", NUMBERS)
def test_numbers(spark, column, want):
    assert value(spark, column()) == pytest.approx(want, rel=1e-9, abs=1e-15)


def test_totals(spark):
    parts = {n: F.lit(v) for n, v in (("breadth", 0.5), ("minhash", 0.4), ("gini", 0.3))}
    weights = {"breadth": 0.27, "minhash": 0.31, "gini": 0.42}
    say = lambda **k: value(spark, sc.additive_score(parts, weights, F.lit(0.5), 0.1, **k))
    assert say() == pytest.approx(0.435**0.7) and say(scale=F.lit(0.0)) == pytest.approx(0.435)
    assert say(abundance=F.lit(0.5), abundance_weight=0.2, gate=True, power=1.0) == pytest.approx((0.435 + 0.1) * 0.5)
    low = lambda v, **k: value(spark, sc.penalized_score({"breadth": F.lit(v), "minhash": F.lit(v)}, {"breadth": 0.5, "minhash": 0.5}, F.lit(0.5), 0.3, **k))
    assert low(0.1) == pytest.approx(0.1 + 0.15 * 0.1 / 0.15)
    assert low(0.2) == pytest.approx(0.2 + 0.15)
    assert low(0.1, abundance=F.lit(0.4), abundance_weight=0.5) == pytest.approx(0.5 - 0.4 * 0.7 + 0.1)
    assert low(0.2, abundance=F.lit(0.4), gate=True) == pytest.approx(0.5 - 0.15 * 0.4)
    assert sc.normalized_weights({"a": 1.0, "b": 3.0}) == {"a": 0.25, "b": 0.75} and sc.normalized_weights({"a": 0.0}) == {"a": 0.0}


def test_shared_minhash(spark):
    rows = [("g", "a", 60.0, 0.5, 0.2), ("g", "b", 40.0, 0.5, 0.05), ("h", "c", 60.0, 0.5, 0.25), ("h", "d", 40.0, 0.5, 0.25), ("s", "e", 7.0, 0.5, 0.1), ("z", "f", 0.0, 0.5, 0.1), ("z", "g", 0.0, 0.5, 0.1)]
    df = spark.createDataFrame(rows, "bucket string, id string, rpm double, mh double, cov double")
    out = {r.id: r for r in sc.share_minhash(df, "bucket", "rpm", "id", "mh", F.lit(0.9), F.col("cov"), F.lit(0.5), F.lit(0.6), F.lit(5)).collect()}
    assert out["a"].minhash_shared == pytest.approx(0.5 + 0.4 * (0.6 + 0.75 * 0.2)) and out["a"].factor == pytest.approx(1.6)
    assert out["b"].factor == pytest.approx((0.65 * 0.52 + 0.35 * 0.5125) * 0.7)  # too little coverage for parity
    assert out["d"].factor == pytest.approx(0.4816 + (0.4 / 0.6 - 0.4) / 0.4 * (0.8 - 0.4816))
    assert out["e"].minhash_shared == pytest.approx(0.5 + 0.4 * 0.9 * 0.5) and out["f"].minhash_shared == 0.5
    many = spark.createDataFrame([("g", str(i), 10.0 - i, 1.0, 0.2) for i in range(8)], "bucket string, id string, rpm double, mh double, cov double")
    low = {r.id: r.factor for r in sc.share_minhash(many, "bucket", "rpm", "id", "mh", F.lit(1.0), F.col("cov"), F.lit(0.5), F.lit(None).cast("double"), F.lit(None).cast("int")).collect()}
    kept = (0.65 * (0.2 + 0.8 * 3 / 52) + 0.35) / (1 + 0.3 * 6)
    assert low["7"] == pytest.approx(max(0.2, kept))
    kept = (0.65 * (0.2 + 0.8 * 9 / 52) + 0.35) / (1 + 0.3 * 6)
    assert low["1"] == pytest.approx(kept + 0.25 * (0.2 - 0.1) / 0.15 * (0.8 - kept))


def test_read_scores_and_removal(spark):
    aln = spark.createDataFrame([(i, "A", 10, 5) for i in range(4)] + [(9, "B", 10, 5), (8, "C", 1, 1)], "read long, ref string, mapq int, own int")
    pairs = spark.createDataFrame([("A", "B", 0.5), ("B", "A", 0.5)], "ref string, alt string, jaccard double")
    out = {r.ref: r.read_score for r in cf.read_scores(aln, "read", "ref", "mapq", "own", pairs).collect()}
    assert out == {"A": 10 + 5 - 0.5 + 10 * 0.5 * 2, "B": 10 + 5 - 0.5 - 10, "C": 2.0}
    left = cf.drop_removed(aln, spark.createDataFrame([("A", 1), ("A", 1), ("B", 8)], "ref string, read long"), "read", "ref")
    assert left.columns == aln.columns and left.count() == 5


def test_windows(spark):
    df = spark.createDataFrame([("N" * 3 + "A" * 17, 20), ("ACGT", 4), ("AC", 2)], "seq string, n long")
    wins = iv.sequence_windows(df, "n", 10, 5, 3)
    assert sorted((r.n, r.w_start, r.w_end) for r in wins.collect()) == [(4, 0, 4), (20, 0, 10), (20, 5, 15), (20, 10, 20)]
    assert sorted((r.n, r.w_start) for r in iv.drop_unknown(wins, "seq").collect()) == [(4, 0), (20, 5), (20, 10)]


@pytest.mark.parametrize("number, want", [(0.00012345, "0.00012"), (3.0, "3"), (12.3456, "12.34"), (0.1002, "0.12"), (0.5, "0.5"), (1e-11, "0")])
def test_leading_decimals(spark, number, want):
    assert value(spark, fx.leading_decimals(F.lit(number))) == want


def test_names_and_sites(spark):
    assert value(spark, fx.name_aliases(F.lit("Escherichia coli (Migula 1895) Castellani"))) == ["Escherichia coli"]
    assert value(spark, fx.name_aliases(F.lit("Bacillus subtilis group"))) == ["Bacillus subtilis", "Bacillus subtilis group"][:1]
    assert value(spark, fx.binomial(F.lit("uncultured thing"))) is None
    site = lambda s: value(spark, cl.body_site(F.lit(s)))
    assert [site(s) for s in (" CSF ", "gi", "left lung biopsy", "pleural fluid", "hand", None, "vaginal swab")] == ["csf", "gut", "lung", "sterile", "hand", "unknown", "urogenital"]
    plat = lambda s: value(spark, cl.platform(F.lit(s)))
    assert [plat(s) for s in ("PB", "Nova_Seq", "grid-ion", "MinION", None)] == ["ont", "illumina", "grid ion", "ont", "illumina"]


def test_pathogen_match(spark):
    sheet = spark.createDataFrame([(1, "Ecoli alpha", "Ecoli", "Commensal", False), (None, "Ecoli beta", "Ecoli", "Primary", True), (7, "Solo", None, "Potential", False)],
                                  "taxid long, name string, genus string, class string, high_consequence boolean")
    rows = [(1, "x", "species"), (None, "ecoli BETA", "strain"), (2, "Ecoli beta K12", "strain"), (3, "Ecoli gamma", "species"), (4, "Ecoli phage D6", "species"), (5, "Ecoli", "genus"), (6, "Ecoli gamma", "no rank"), (None, None, None)]
    out = cl.match_pathogens(spark.createDataFrame(rows, "taxid long, name string, rank string"), sheet).collect()
    got = {(r.taxid, r.name): (r.matched_by, r["class"], r.high_consequence) for r in out}
    assert got == {
        (1, "x"): ("taxid", "commensal", False), (None, "ecoli BETA"): ("name", "primary", True), (2, "Ecoli beta K12"): ("two words", "primary", True), (3, "Ecoli gamma"): ("genus", "primary", True),
        (4, "Ecoli phage D6"): (None, None, None), (5, "Ecoli"): ("genus", "primary", True), (6, "Ecoli gamma"): (None, None, None), (None, None): (None, None, None)}


def test_default_row_may_be_missing(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    dim = spark.createDataFrame([("a", 1.0)], "x string, v double")
    assert {r.k: r.out for r in sc.first_match(df, dim, [[("k", "x")], []], "v", "out").collect()} == {"a": 1.0, "b": None}


def test_rounding_of_the_scaled_number(spark):
    """0.588235 and 1.005 lie a little below the half that their shortest decimal forms show."""
    for x, digits, want in ((0.588235, 5, 0.58823), (1.005, 2, 1.0), (0.125, 2, 0.13), (-0.125, 2, -0.13), (0.62449, 5, 0.62449)):
        assert value(spark, fx.round_scaled(F.lit(x), digits)) == want
