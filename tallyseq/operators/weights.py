"""Weights of a score fitted to truth: a population search on the simplex with a projected-gradient finish.

A whole generation of candidates is one aggregate over the rows: candidates are a small matrix, tasks multiply
their rows with it and give sums by candidate, and Spark adds those up. The loss is put together from the
sums. The same pass serves gradients (candidates a step to each side) and line searches (candidates along
the way), so the fit is a few dozen short jobs whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyseq.session import materialize

#: The parts of a score in the order of their weights, and what else rows hold: what is added for plasmids,
#: confidence by abundance, and reads of the truth.
PARTS = ("breadth", "minhash", "gini", "disparity", "population")
ROW = (*PARTS, "plasmid", "abundance", "tp", "fp")
#: Bounds of the plasmid bonus and of the power, scores at which the shape of retention is
#: looked at, what is to be kept and to go there, and the score from which wrong ones are to go.
BONUS, POWER = (0.0, 0.20), (0.3, 1.0)
CHECKS, KEEP, GO, GO_FROM = (0.1, 0.2, 0.3, 0.5, 0.7), 0.95, 0.05, 0.15
#: Scores are held to this distance from 0 and 1 under logarithms; cut-offs are tried in steps of 1 / STEPS.
EPS, STEPS = 1e-6, 100
SUMS = 8


@dataclass(frozen=True)
class Rules:
    """What makes up the loss; a weight of 0 leaves a term out. mode and scopes are taxa, reads or hybrid, the
    share `hybrid` of which is of taxa."""

    mode: str = "taxa"
    hybrid: float = 0.5
    alpha: float = 1.0
    positive: float = 1.0
    negative: float = 1.0
    ridge: float = 0.0
    entropy: float = 0.0
    least: float = 0.0
    prior: dict[str, float] = field(default_factory=dict)
    prior_weight: float = 0.0
    abundance: float = 0.0
    abundance_gate: bool = False
    tp_target: float | None = None
    tp_target_weight: float = 0.0
    tp_target_scope: str = "taxa"
    scope: str = "taxa"
    youden: float = 0.0
    youden_least: float | None = None
    high_cutoff: float = 0.0
    fp_cutoff: float = 0.5
    fp_cutoff_weight: float = 0.0
    tp_floor: float = 0.7
    tp_floor_weight: float = 0.0
    fp_ceiling: float = 0.15
    fp_ceiling_weight: float = 0.0
    separation: float = 0.0


def scores(x: np.ndarray, candidates: np.ndarray, rules: Rules) -> np.ndarray:
    """Scores of rows (ROW) by candidates (weights, bonus, power)."""
    out = rules.alpha * (x[:, :5] @ candidates[:, :5].T) + x[:, 5:6] * candidates[:, 5] + rules.abundance * x[:, 6:7]
    out = out * x[:, 6:7] if rules.abundance_gate else out
    return np.clip(np.clip(out, 0, 1) ** candidates[:, 6], EPS, 1 - EPS)


def _sums(x: np.ndarray, candidates: np.ndarray, rules: Rules) -> np.ndarray:
    """(candidate, sums): SUMS plain ones, then right and wrong reads and taxa from each check on and by step."""
    p, (tp, fp) = scores(x, candidates, rules), x[:, 7:9].T
    right, wrong = (tp > 0).astype(float), ((tp == 0) & (fp > 0)).astype(float)
    by = np.stack([tp, fp, right, wrong])
    plain = np.stack([
        tp @ np.log(p), fp @ np.log(1 - p), right @ np.log(p), wrong @ np.log(1 - p), right @ p, tp @ p,
        right @ np.maximum(0, rules.tp_floor - p) ** 2, wrong @ np.maximum(0, p - rules.fp_ceiling) ** 2], axis=1)
    kept = [(by @ (p >= t)).T for t in (rules.fp_cutoff, *CHECKS)]
    step = np.floor(p * STEPS).astype(int)
    hist = np.zeros((len(candidates), 4, STEPS))
    for c in range(len(candidates) if rules.youden or rules.high_cutoff else 0):
        for i in range(4):
            hist[c, i] = np.bincount(step[:, c], by[i], STEPS)
    return np.concatenate([plain, *kept, hist.reshape(len(candidates), -1)], axis=1)


def _blend(taxa: float | None, reads: float | None, how: str, share: float) -> float | None:
    if how == "reads":
        return reads
    if how == "hybrid" and taxa is not None and reads is not None:
        return share * taxa + (1 - share) * reads
    return reads if how == "hybrid" and taxa is None else taxa


def _loss(s: np.ndarray, w: np.ndarray, start: np.ndarray, totals: np.ndarray, rules: Rules) -> float:
    """The loss of a candidate with these sums; totals: right reads, wrong reads, right taxa, wrong taxa."""
    tp, fp, right, wrong = totals
    over = lambda a, b: a / b if b > 0 else None
    none = lambda a: 0.0 if a is None else a
    pos = _blend(none(over(-s[2], right)), none(over(-s[0], tp)), rules.mode, rules.hybrid)
    neg = _blend(none(over(-s[3], wrong)), none(over(-s[1], fp)), rules.mode, rules.hybrid)
    out = (rules.positive * pos + rules.negative * neg) / (rules.positive + rules.negative) + rules.ridge * float(((w - start) ** 2).sum())
    if rules.entropy:
        safe = np.clip(w, 1e-8, 1)
        out += rules.entropy * (1 + float((safe * np.log(safe)).sum()) / np.log(len(w)))
    out += rules.prior_weight * sum((w[PARTS.index(k)] - v) ** 2 for k, v in rules.prior.items())
    if rules.tp_target is not None and (mean := _blend(over(s[4], right), over(s[5], tp), rules.tp_target_scope, rules.hybrid)) is not None:
        out += rules.tp_target_weight * max(0.0, rules.tp_target - mean) ** 2

    def kept(at: np.ndarray) -> tuple[float, float] | None:
        """Shares of right and wrong that are kept, of (right reads, wrong reads, right taxa, wrong taxa)."""
        taxa = (at[2] / right, at[3] / wrong) if right > 0 and wrong > 0 else None
        reads = (at[0] / tp, at[1] / fp) if tp > 0 and fp > 0 else None
        if rules.scope == "reads":
            return reads
        if rules.scope == "hybrid":
            return None if taxa is None or reads is None else tuple(rules.hybrid * a + (1 - rules.hybrid) * b for a, b in zip(taxa, reads))
        return taxa

    at = s[SUMS: SUMS + 4 * (len(CHECKS) + 1)].reshape(-1, 4)
    if rules.fp_cutoff_weight and (r := kept(at[0])):
        out += rules.fp_cutoff_weight * r[1]
    if rules.separation:
        for t, a in zip(CHECKS, at[1:]):
            if r := kept(a):
                out += rules.separation * (max(0.0, KEEP - r[0]) ** 2 + (max(0.0, r[1] - GO) ** 2 if t >= GO_FROM else 0.0))
    out += rules.tp_floor_weight * none(over(s[6], right)) + rules.fp_ceiling_weight * none(over(s[7], wrong))
    if rules.youden or rules.high_cutoff:
        hist = s[SUMS + at.size:].reshape(4, STEPS)
        curve = [kept(x) for x in hist[:, ::-1].cumsum(axis=1)[:, ::-1].T]
        if curve[0] is not None:
            j = np.array([a - b for a, b in curve])
            cut = np.arange(STEPS) / STEPS
            ok = cut >= rules.youden_least if rules.youden_least is not None else np.ones(STEPS, bool)
            out += rules.youden * (1 - (float(j[ok].max()) if ok.any() else 0.0))
            held = np.flatnonzero(hist.sum(axis=0))
            best = int(np.where(ok, j, -np.inf).argmax()) if ok.any() else int(j.argmax())
            best = int(np.clip(best, held[0], held[-1]))
            out += rules.high_cutoff * (1 - (best - held[0]) / max(1, held[-1] - held[0]))
    return float(out)


def losses(rows: DataFrame, candidates: np.ndarray, rules: Rules, start: np.ndarray) -> np.ndarray:
    """The loss of each candidate (five weights, bonus, power) over rows with the columns ROW, in one job.

    Rows without right or wrong reads don't count; nulls count as 0. Without right ones there is no loss: NaN.
    """
    import pyarrow as pa

    width = SUMS + 4 * (len(CHECKS) + 1) + 4 * STEPS

    def batches(it):
        total, counts = np.zeros((len(candidates), width)), np.zeros(4)
        for b in it:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1).reshape(-1, len(ROW))
            for i in range(0, len(x), 8192):
                part = x[i: i + 8192]
                total += _sums(part, candidates, rules)
                tp, fp = part[:, 7], part[:, 8]
                counts += [tp.sum(), fp.sum(), (tp > 0).sum(), ((tp == 0) & (fp > 0)).sum()]
        c, i = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([c, np.full(4, -1)])), pa.array(np.concatenate([i, np.arange(4)])), pa.array(np.concatenate([total[c, i], counts]))], ["c", "i", "v"])

    values = rows.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in ROW]).where("tp + fp >= 1")
    found = values.mapInArrow(batches, "c long, i long, v double").groupBy("c", "i").agg(F.sum("v").alias("v")).collect()  # candidates x sums
    sums, totals = np.zeros((len(candidates), width)), np.zeros(4)
    for c, i, v in found:
        if c < 0:
            totals[i] = v
        else:
            sums[c, i] = v
    if not (totals[0] if rules.mode == "reads" else totals[2]) > 0:
        return np.full(len(candidates), np.nan)
    return np.array([_loss(s, c[:5], start, totals, rules) for s, c in zip(sums, candidates)])


def on_simplex(w: np.ndarray, least: float = 0.0) -> np.ndarray:
    """The nearest weights that sum to 1, each `least` or more."""
    v = np.sort(w - least, axis=-1)[..., ::-1]
    room = 1 - least * w.shape[-1]
    over = (v.cumsum(axis=-1) - room) / np.arange(1, w.shape[-1] + 1)
    last = (v > over).sum(axis=-1, keepdims=True) - 1
    return np.maximum(w - least - np.take_along_axis(over, last, axis=-1), 0) + least


def _legal(c: np.ndarray, rules: Rules, bonus: bool) -> np.ndarray:
    out = np.empty_like(c)
    out[:, :5] = on_simplex(c[:, :5], rules.least)
    out[:, 5] = np.clip(c[:, 5], *BONUS) if bonus else 0.0
    out[:, 6] = np.clip(c[:, 6], *POWER)
    return out


def fit_weights(rows: DataFrame, rules: Rules = Rules(), start: dict[str, float] | None = None, seed: int = 1, generations: int = 30, population: int = 60, finish: int = 12) -> dict:
    """The weights with the least loss that the search finds: weights by part, bonus, power, loss, status.

    `generations` of differential evolution over `population` candidates, the start among them, then `finish`
    steps down the gradient, each with a line search. The bonus is fitted if any row has one. With no right
    row nothing is fitted and the status says so; with no wrong one the right are only raised. Equal seeds give
    equal results, but for the rounding of sums.
    """
    bonus = rows.where("plasmid > 0 and tp + fp >= 1").limit(1).count() > 0
    w0 = on_simplex(np.array([(start or {}).get(p, 1 / len(PARTS)) for p in PARTS]), rules.least)
    first = np.concatenate([w0, [(start or {}).get("bonus", 0.0), (start or {}).get("power", 1.0)]])
    rng = np.random.default_rng(seed)
    pool = np.concatenate([rng.dirichlet(np.ones(5), population), rng.uniform(*BONUS, (population, 1)), rng.uniform(*POWER, (population, 1))], axis=1)
    pool[0] = first
    pool = _legal(pool, rules, bonus)
    cost = losses(rows, pool, rules, w0)
    if np.isnan(cost).any():
        return {"weights": dict(zip(PARTS, w0.tolist())), "bonus": 0.0, "power": float(first[6]), "loss": None, "status": "nothing right to fit to"}
    for _ in range(generations):
        pick = np.array([rng.choice(population, 3, replace=False) for _ in range(population)])
        scale = rng.uniform(0.5, 1.0, (population, 1))
        trial = pool[pick[:, 0]] + scale * (pool[pick[:, 1]] - pool[pick[:, 2]])
        best = pool[cost.argmin()]
        lead = rng.random(population) < 0.3
        trial[lead] = pool[lead] + scale[lead] * (best - pool[lead]) + scale[lead] * (pool[pick[lead, 1]] - pool[pick[lead, 2]])
        cross = rng.random(trial.shape) < 0.8
        cross[np.arange(population), rng.integers(0, trial.shape[1], population)] = True
        trial = _legal(np.where(cross, trial, pool), rules, bonus)
        new = losses(rows, trial, rules, w0)
        better = new <= cost
        pool[better], cost[better] = trial[better], new[better]
    x, least = pool[cost.argmin()].copy(), float(cost.min())
    step = 0.05
    for _ in range(finish):
        h = 1e-4
        near = losses(rows, np.concatenate([x + h * np.eye(7), x - h * np.eye(7)]), rules, w0)
        slope = (near[:7] - near[7:]) / (2 * h)
        slope[:5] -= slope[:5].mean()  # along the simplex
        size = np.linalg.norm(slope)
        if size == 0:
            break
        way = _legal(x - step * 2.0 ** -np.arange(10)[:, None] * slope / size, rules, bonus)
        down = losses(rows, way, rules, w0)
        if down.min() >= least:
            step /= 2**6
            continue
        at = int(down.argmin())
        x, least, step = way[at], float(down[at]), min(0.2, step * 2.0 ** (1 - at))
    return {"weights": dict(zip(PARTS, x[:5].tolist())), "bonus": float(x[5]), "power": float(x[6]), "loss": least, "status": "ok"}


def lifting_power(rows: DataFrame, fitted: dict, rules: Rules) -> float:
    """The power that lifts the mean score of right rows to the target, from 0.15 to 1; the fitted one if they
    are there already."""
    raw = sum((F.coalesce(F.col(p), F.lit(0.0)) * w for p, w in fitted["weights"].items()), F.lit(0.0)) * rules.alpha + F.coalesce(F.col("plasmid"), F.lit(0.0)) * fitted["bonus"]
    raw = raw + rules.abundance * F.coalesce(F.col("abundance"), F.lit(0.0))
    raw = raw * F.coalesce(F.col("abundance"), F.lit(0.0)) if rules.abundance_gate else raw
    mean = rows.where("tp >= 1").agg(F.avg(F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0)))).first()[0]
    if mean is None or rules.tp_target is None or not 0 < mean < rules.tp_target:
        return fitted["power"]
    return float(np.clip(np.log(rules.tp_target) / np.log(mean), 0.15, 1.0))


def level_rows(rows: DataFrame, level: Column) -> DataFrame:
    """Rows of a level's groups: the largest of each part, reads summed."""
    most = [F.max(c).alias(c) for c in ROW[:7]]
    return rows.groupBy(level.alias("grp")).agg(*most, F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))


def fit_levels(rows: DataFrame, levels: dict[str, Column], rules: Rules = Rules(), **how) -> list[dict]:
    """fit_weights at each level, with its name; each level's rows are written once."""
    return [{"level": name, **fit_weights(materialize(level_rows(rows, column), "fit-rows"), rules, **how)} for name, column in levels.items()]
