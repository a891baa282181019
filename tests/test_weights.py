"""The weight fit: its loss by hand, its optimum against a dense grid."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyseq.operators import weights as wt

KIND = "breadth double, minhash double, gini double, disparity double, population double, plasmid double, abundance double, tp long, fp long, grp int"


def table(spark, n=60, seed=2, plasmid=0.0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        right = i % 3 > 0
        x = np.clip(rng.normal([0.7, 0.55, 0.5, 0.5, 0.5] if right else [0.2, 0.5, 0.45, 0.5, 0.5], 0.2), 0, 1)
        rows.append((*map(float, x), plasmid * float(rng.random()), 0.5, 50 + i if right else 0, 3 if i % 4 else 0, i % 6))
    rows.append((0.1, 0.1, 0.1, 0.1, 0.1, 0.9, 0.5, 0, 0, 0))  # no truth: doesn't count
    return spark.createDataFrame(rows, KIND)


def plain_loss(rows, w, rules):
    p = [min(1 - 1e-6, max(1e-6, min(1, max(0, sum(a * b for a, b in zip(w, r[:5])))) ** w[6])) for r in rows]
    right = [-math.log(x) for x, r in zip(p, rows) if r.tp]
    wrong = [-math.log(1 - x) for x, r in zip(p, rows) if not r.tp and r.fp]
    return (sum(right) / len(right) + sum(wrong) / len(wrong)) / 2 + rules.ridge * sum((a - 0.2) ** 2 for a in w[:5])


def test_losses_by_hand(spark):
    df, rules = table(spark), wt.Rules(ridge=0.1)
    rows = [r for r in df.collect() if r.tp + r.fp >= 1]
    candidates = np.array([[0.2] * 5 + [0, 1.0], [1, 0, 0, 0, 0, 0, 0.5]])
    got = wt.losses(df.repartition(4), candidates, rules, np.full(5, 0.2))
    assert got == pytest.approx([plain_loss(rows, c, rules) for c in candidates])


def test_optimum_equals_a_dense_grid(spark):
    df, rules = table(spark), wt.Rules(ridge=0.05, fp_ceiling_weight=0.5, tp_floor_weight=0.5)
    found = wt.fit_weights(df, rules, seed=3, generations=14, population=40, finish=10)
    steps = 10
    grid = np.array([[*(x / steps for x in g), 1 - sum(g) / steps, 0.0, power] for g in itertools.product(range(steps + 1), repeat=4) if sum(g) <= steps for power in (0.3, 0.5, 0.75, 1.0)])
    best = wt.losses(df, grid, rules, np.full(5, 0.2))
    assert found["status"] == "ok" and found["loss"] <= best.min() + 1e-3
    weights = list(found["weights"].values())
    assert sum(weights) == pytest.approx(1) and min(weights) >= 0 and found["bonus"] == 0
    assert np.abs(np.array(weights) - grid[best.argmin()][:5]).max() <= 1.5 / steps


def test_bounds_bonus_and_levels(spark):
    df = table(spark, plasmid=1.0)
    fitted = wt.fit_levels(df, {"one": F.col("grp"), "row": F.monotonically_increasing_id()}, wt.Rules(least=0.1), generations=3, population=12, finish=2)
    assert [f["level"] for f in fitted] == ["one", "row"]
    for f in fitted:
        assert min(f["weights"].values()) >= 0.1 - 1e-9 and 0 <= f["bonus"] <= 0.2 and 0.3 <= f["power"] <= 1
    grouped = wt.level_rows(df, F.col("grp")).where("grp = 1").first()
    own = df.where("grp = 1").agg(F.max("breadth"), F.sum("tp")).first()
    assert (grouped.breadth, grouped.tp) == tuple(own)


def test_nothing_right(spark):
    df = table(spark).withColumn("tp", F.lit(0))
    assert wt.fit_weights(df)["status"] == "nothing right to fit to"
    assert wt.fit_weights(df.limit(0))["status"] == "nothing right to fit to"
    only = wt.fit_weights(table(spark).where("tp > 0").withColumn("fp", F.lit(0)), generations=2, population=8, finish=1)
    assert only["status"] == "ok"


def test_lifting_power(spark):
    df = table(spark)
    fitted = {"weights": {"breadth": 1.0}, "bonus": 0.0, "power": 0.9}
    mean = df.where("tp > 0").agg(F.avg("breadth")).first()[0]
    assert wt.lifting_power(df, fitted, wt.Rules(tp_target=0.95)) == pytest.approx(max(0.15, math.log(0.95) / math.log(mean)))
    assert wt.lifting_power(df, fitted, wt.Rules(tp_target=0.1)) == 0.9


def test_projection():
    x = wt.on_simplex(np.array([[0.9, 0.9, -0.5, 0.0, 0.1], [1.0, 0, 0, 0, 0]]), 0.05)
    assert x.sum(axis=1) == pytest.approx([1, 1]) and x.min() >= 0.05 - 1e-12
