"""Quality by hierarchical empirical Bayes: a document classifier combined with host and path posteriors.

A logistic classifier on text statistics and hashed words and word pairs gives each document a probability
of good quality. Means of these per host and per path within the host are shrunk, path to host to the
global prior, by the variance components of a nested design: within paths, between the paths of a host,
and between hosts. Each document's own evidence is left out of its site's. The posterior log odds are the
document's plus those of its path over the global prior's.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyseq.llm.sampling import hash_sample
from tallyseq.llm.words import words
from tallyseq.session import materialize

#: Labelled rows that the classifier is fitted to, about, if there are more: those with the smallest hashes of their keys.
FIT_ROWS = 20_000
#: Up to this many (host, path) rows, about 64 bytes each, the site table is broadcast.
MAX_BROADCAST_SITES = 200_000
#: Up to this many keys (16 bytes each) are broadcast; more are joined by shuffle.
MAX_BROADCAST_KEYS = 1_000_000
FEATURES = ("log_words", "word_length", "distinct_words", "short_words", "pipes", "symbols", "stops", "exclaims", "upper", "digits", "lines", "distinct_lines", "other")
#: Hash buckets of words and word pairs, and the count that each has in advance in both classes.
BUCKETS, SMOOTH = 1 << 14, 2.0
_NOT_PLAIN = bytes(set(range(128)) - set(b"abcdefghijklmnopqrstuvwxyz \n\t\r.,"))
_UPPER, _DIGIT = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"


def features(text: str | None) -> list[float]:
    """Statistics of a whole text; null counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    w, lines = raw.lower().split(), raw.split(b"\n")
    n, k = max(1, len(raw)), max(1, len(w))
    without = lambda drop: (len(raw) - len(raw.translate(None, drop))) / n
    letters = sum(map(len, w))
    big = sum(c.isupper() for c in text or "") / max(1, len(text or ""))
    return [
        math.log1p(len(w)), letters / k, len(set(w)) / k, sum(len(x) <= 3 for x in w) / k,
        raw.count(b"|") / k, (raw.count(b"%") + raw.count(b"&") + raw.count(b"$") + raw.count(b"#") + raw.count(b"*")) / k,
        (raw.count(b".") + raw.count(b",")) / k, raw.count(b"!") / k, big, without(_DIGIT),
        math.log1p(len(lines)), len(set(lines)) / len(lines), without(_NOT_PLAIN),
    ]


def word_buckets(text: str | None) -> np.ndarray:
    """Distinct buckets of a whole text's words and word pairs."""
    from zlib import crc32

    w = words(text)
    own = np.fromiter(map(crc32, w), np.uint64, len(w))
    pairs = (own[:-1] * np.uint64(0x9E3779B1) + own[1:] * np.uint64(0x85EBCA77)) >> np.uint64(7)
    return np.unique(np.concatenate([own, pairs]) & np.uint64(BUCKETS - 1)).astype(np.int32)


def log_odds(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Per bucket, the log of its rate among good documents over that among bad ones; counts are smoothed."""
    rate = lambda n: (n + SMOOTH) / (n.sum() + SMOOTH * len(n))
    return np.log(rate(good)) - np.log(rate(bad))


def lexical(buckets: np.ndarray, odds: np.ndarray) -> float:
    """Mean log odds of a text's buckets; 0 without any."""
    return float(odds[buckets].mean()) if len(buckets) else 0.0


def _vector(values: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    z = np.clip((values - mean) / sd, -4, 4)
    return np.concatenate([np.ones((len(z), 1)), z, z * z], axis=1)


def fit_classifier(values: np.ndarray, good: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> dict:
    """Ridge logistic regression on standardised features and their squares, by Newton steps."""
    mean, sd = values.mean(axis=0), values.std(axis=0)
    sd = np.where(sd > 1e-9, sd, 1.0)
    x, w = _vector(values, mean, sd), np.zeros(2 * values.shape[1] + 1)
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (good - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return {"mean": mean, "sd": sd, "w": w}


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def components(paths: DataFrame) -> dict:
    """Variance within paths, between the paths of a host and between hosts, from one row per path with its
    number n, sum a and sum of squares aa of probabilities (moments of the unbalanced nested design)."""
    hosts = paths.groupBy("h").agg(
        F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("aa").alias("aa"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("a") * F.col("a") / F.col("n")).alias("pp"), F.count("*").alias("p"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0.0)).cast("double")
    n, a, aa, nn, pp, p, nh, hh, h, n2 = hosts.agg(
        total("n"), total("a"), total("aa"), total("nn"), total("pp"), total("p"), total(F.col("nn") / F.col("n")), total(F.col("a") * F.col("a") / F.col("n")), F.count("*"), total(F.col("n") * F.col("n"))).first()
    if not n:
        return {"prior": 0.5, "within": 1.0, "path": 0.0, "host": 0.0}
    prior = min(1 - 1e-6, max(1e-6, a / n))
    within = max(1e-9, (aa - pp) / (n - p) if n > p else prior * (1 - prior))
    path = max(0.0, (pp - hh - (p - h) * within) / (n - nh)) if n > nh else 0.0
    host = max(0.0, (hh - a * a / n - (h - 1) * within - path * (nh - nn / n)) / (n - n2 / n)) if n > n2 / n else 0.0
    return {"prior": prior, "within": within, "path": path, "host": host}


def score_quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", path: str = "lang",
    label: str = "quality", cutoff: float = 0.5,
) -> DataFrame:
    """(key, p_doc, host_posterior, path_posterior, posterior, rejected), one row per input row.

    Null texts count as empty; null hosts and paths are sites of their own. Rows with a null key are
    scored too. Labels with a null key or value don't count; a key labelled twice counts twice. Without
    any label of one of both classes every p_doc is the labelled rate (0.5 without labels), and with 0.5
    nothing is rejected. Ties at the cutoff stay; repeated rows each count in their site and get the same
    p_doc; very long texts are read whole. An empty input gives an empty result. Other columns are not read.
    """
    import pyarrow as pa

    names = [f"f{i}" for i in range(len(FEATURES))]
    flat = docs.select(F.col(key).alias("k"), F.col(host).cast("string").alias("h"), F.col(path).cast("string").alias("p"), F.col(text).alias("t"))
    kind = docs.schema[key].dataType.simpleString()

    # the labelled sample: its statistics and word buckets, in two folds
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("double").alias("good")).where("k is not null and good is not null")
    known = materialize(hash_sample(known, F.col("k"), FIT_ROWS, known.count()), "quality-labels")

    def labelled(it):
        for b in it:
            texts = [t.as_py() for t in b.column(1)]
            values = np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))
            found = pa.array([word_buckets(t) for t in texts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), found, *map(pa.array, values.T.copy())], ["good", "found", *names])

    sample = flat.join(F.broadcast(known), "k").select("good", "t").mapInArrow(labelled, "good double, found array<int>, " + ", ".join(f"{n} double" for n in names))
    sample = materialize(sample.withColumn("fold", F.pmod(F.xxhash64(*names), F.lit(2)).cast("int")), "quality-sample")
    counts = np.zeros((2, 2, BUCKETS))
    per = sample.select("fold", (F.col("good") > 0.5).cast("int").alias("g"), F.explode("found").alias("b")).groupBy("fold", "g", "b").count()  # 4 * BUCKETS rows at most
    for fold, g, bucket, n in per.collect():
        counts[fold, g, bucket] = n
    # a fold's own texts are measured by the other fold's odds, so that the classifier can trust them
    crossed = [log_odds(counts[1 - f, 1], counts[1 - f, 0]) for f in (0, 1)]

    def measured(it):
        for b in it:
            value = [lexical(x.values.to_numpy(), crossed[f]) for x, f in zip(b.column(0), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(value, pa.float64()), *[b.column(i) for i in range(2, 3 + len(names))]], ["lexical", *names, "good"])

    fit = sample.select("found", "fold", *names, "good").mapInArrow(measured, "lexical double, " + ", ".join(f"{n} double" for n in names) + ", good double")
    picked = fit.toPandas().sort_values([*names, "good"]).to_numpy(float)
    good = picked[:, -1] > 0.5
    model = fit_classifier(picked[:, :-1], good.astype(float)) if len(good) and 0 < good.mean() < 1 else None
    rate = float(good.mean()) if len(good) else 0.5
    odds = log_odds(counts[:, 1].sum(axis=0), counts[:, 0].sum(axis=0))

    def scored(it):
        for b in it:
            if model is None:
                p = np.full(b.num_rows, rate)
            else:
                texts = [t.as_py() for t in b.column(3)]
                values = np.array([[lexical(word_buckets(t), odds), *features(t)] for t in texts], float).reshape(-1, len(FEATURES) + 1)
                p = 1 / (1 + np.exp(-np.clip(_vector(values, model["mean"], model["sd"]) @ model["w"], -700, 700)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(p)], ["k", "h", "p", "p_doc"])

    # sites as non-null keys: null is a site of its own
    site = lambda c: F.coalesce(F.concat(F.lit("a"), F.col(c)), F.lit("b"))
    rows = flat.mapInArrow(scored, f"k {kind}, h string, p string, p_doc double").select("k", site("h").alias("h"), site("p").alias("p"), "p_doc")
    rows = materialize(rows, "quality-scored")
    return site_posteriors(rows, cutoff).withColumnRenamed("k", key)


def site_posteriors(rows: DataFrame, cutoff: float = 0.5) -> DataFrame:
    """(k, h, p, p_doc) with non-null sites -> (k, p_doc, host_posterior, path_posterior, posterior, rejected)."""
    paths = materialize(rows.groupBy("h", "p").agg(F.count("*").alias("n"), F.sum("p_doc").alias("a"), F.sum(F.col("p_doc") * F.col("p_doc")).alias("aa")), "quality-paths")
    hosts = paths.groupBy("h").agg(F.sum("n").alias("n_host"), F.sum("a").alias("a_host"), F.sum(F.col("n") * F.col("n")).alias("nn_host"))
    v = components(paths)
    prior, within, between_paths, between_hosts = v["prior"], v["within"], v["path"], v["host"]
    sites = paths.select("h", "p", F.col("n").alias("n_path"), F.col("a").alias("a_path")).join(hosts, "h")
    if paths.count() <= MAX_BROADCAST_SITES:
        sites = F.broadcast(sites)
    out = rows.join(sites, ["h", "p"])

    def shrunk(total: str, n: str, noise: Column, between: float, parent: Column) -> Column:
        """The mean of a site's other documents, drawn to its parent by noise against the spread between sites."""
        others = F.col(n) - 1
        weight = between / (between + noise) if between > 0 else F.lit(0.0)
        return F.when(others > 0, parent + weight * ((F.col(total) - F.col("p_doc")) / others - parent)).otherwise(parent)

    host_noise = within / F.greatest(F.col("n_host") - 1, F.lit(1)) + between_paths * F.col("nn_host") / (F.col("n_host") * F.col("n_host"))
    out = out.withColumn("host_posterior", shrunk("a_host", "n_host", host_noise, between_hosts, F.lit(prior)))
    path_noise = within / F.greatest(F.col("n_path") - 1, F.lit(1))
    out = out.withColumn("path_posterior", shrunk("a_path", "n_path", path_noise, between_paths, F.col("host_posterior")))
    odds = _logit(F.col("p_doc")) + _logit(F.col("path_posterior")) - math.log(prior / (1 - prior))
    out = out.withColumn("posterior", 1 / (1 + F.exp(-odds)))
    return out.select("k", "p_doc", "host_posterior", "path_posterior", "posterior", (F.col("posterior") < cutoff).alias("rejected"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """docs with all its columns without the keys of which every row is rejected; null keys stay."""
    scored = score_quality(docs, labels, key, **options)
    out = scored.where(F.col(key).isNotNull()).groupBy(key).agg(F.bool_and("rejected").alias("out")).where("out").select(key)
    out = materialize(out, "quality-out")
    return docs.join(F.broadcast(out) if out.count() <= MAX_BROADCAST_KEYS else out, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
