"""Segments of depth intervals worked out by hand and against a plain loop."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallyseq.operators import segment as sg


def _rows(spark, depths, gap=0):
    return spark.createDataFrame([("c", i * (10 + gap), i * (10 + gap) + 10, d) for i, d in enumerate(depths)], "chrom string, start long, end long, depth double")


def _got(df):
    return sorted((r.start, r.end, round(r.mean_depth, 6), r.n) for r in df.collect())


def test_jump_gap_and_limits(spark):
    rows = _rows(spark, [1.0, 2.0, 9.0, 9.0, None])
    assert _got(sg.merged_runs(rows, "chrom", "jump", 3)) == [(0, 20, 1.5, 2), (20, 40, 9.0, 2), (40, 50, 0.0, 1)]
    assert len(_got(sg.merged_runs(_rows(spark, [1.0, 1.0], gap=5), "chrom", "jump", 3, gap=4))) == 2
    assert [x[3] for x in _got(sg.merged_runs(rows, "chrom", "jump", 99, most_rows=2))] == [2, 2, 1]
    assert [x[3] for x in _got(sg.merged_runs(rows, "chrom", "jump", 99, most_length=30))] == [3, 2]
    assert sg.default_jump(rows, "chrom", "depth") == 10.0
    assert sg.merged_runs(rows.limit(0), "chrom", "gini", 0.1).count() == 0


@pytest.mark.parametrize("method,limit", [("variance", 4.0), ("gini", 0.2)])
def test_spread_against_a_plain_loop(spark, method, limit):
    rng = random.Random(5)
    depths = [float(rng.choice([1, 2, 3, 8, 9, 20])) for _ in range(400)]

    def spread(v):
        if method == "variance":
            return statistics.pvariance(v)
        v, n = sorted(v), len(v)
        return sum(abs(a - b) for a in v for b in v) / (2 * n * sum(v))

    want, open_ = [], [depths[0]]
    for d in depths[1:]:
        if spread([*open_, d]) <= limit + 1e-9 and abs(d - sum(open_) / len(open_)) <= 6:
            open_.append(d)
        else:
            want.append(len(open_))
            open_ = [d]
    want.append(len(open_))
    assert [x[3] for x in _got(sg.merged_runs(_rows(spark, depths), "chrom", method, limit + 1e-9, tolerance=6))] == want


def plain(rows, method, limit, most_rows, most_length, tolerance, gap):
    """One loop over sorted rows (key, s, e, d)."""
    def spread(seg, d):
        if method == "jump":
            return abs(d - seg[-1][3])
        v = [r[3] for r in seg] + [d]
        if method == "variance":
            return statistics.pvariance(v)
        n = len(v)
        return sum((i + 1) * x for i, x in enumerate(sorted(v))) * 2 / (n * sum(v)) - (n + 1) / n if sum(v) else 0.0

    out, seg = [], []
    for r in sorted(rows):
        fits = seg and seg[0][0] == r[0] and len(seg) < most_rows and (most_length is None or r[2] - seg[0][1] <= most_length)
        fits = fits and r[1] - seg[-1][2] <= gap(r[0]) and spread(seg, r[3]) <= limit
        if fits and tolerance is not None and method != "jump":
            fits = abs(r[3] - sum(x[3] for x in seg) / len(seg)) <= tolerance
        if not fits and seg:
            out.append(seg)
            seg = []
        seg.append(r)
    out.append(seg)
    return sorted((x[0][0], x[0][1], x[-1][2], round(sum(r[3] for r in x) / len(x), 6), len(x)) for x in out)


@pytest.mark.parametrize("method,limit,most_rows,most_length,tolerance", [
    ("jump", 3.0, 7, None, None), ("jump", 99.0, 10, None, None), ("variance", 4.0, 12, 130, 6), ("variance", 400.0, 9, None, None), ("gini", 0.21, 15, None, None), ("gini", 0.9, 16, 140, 8)])
def test_chunks_equal_one_loop(spark, monkeypatch, method, limit, most_rows, most_length, tolerance):
    monkeypatch.setattr(sg, "CHUNK", 20)
    rng = random.Random(most_rows)
    rows = []
    for key, n in (("hot", 400), ("b", 30), ("c", 1), ("d", 19)):
        at = 0
        for _ in range(n):
            at += rng.choice([0, 0, 0, 0, 3, 40])
            rows.append((key, at, at + 10, float(rng.choice([1, 2, 3, 8, 9, 20, 21.5, 0]))))
            at += 10
    lengths = spark.createDataFrame([("hot", 100), ("b", 390), ("c", 1)], "chrom string, length long")
    df = spark.createDataFrame(rows, "chrom string, start long, end long, depth double").join(lengths, "chrom", "left")
    got = sg.merged_runs(df, "chrom", method, limit, gap=sg.allowed_gap(F.col("length"), 0.1, 20), most_rows=most_rows, most_length=most_length, tolerance=tolerance)
    assert sorted((r.chrom, r.start, r.end, round(r.mean_depth, 6), r.n) for r in got.collect()) == plain(rows, method, limit, most_rows, most_length, tolerance, lambda k: 39 if k == "b" else 20)


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        sg.merged_runs(_rows(spark, [1.0]), "chrom", "other", 1)
