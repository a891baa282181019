"""SimHash, forest, quality, WARC and the pipeline."""

import base64
import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tallyseq.llm import benchmark_leaks, prefix_forest, simhash_vptree, site_quality, warc_index
from tallyseq.llm.words import words

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    w = words(text)
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(nodes, linked):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                up[root(a)] = root(b)
    return root


def test_simhash_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(9001, None), (9002, ""), (9003, " \n"), (9004, "one two"), (9005, "ONE two"), (9006, "one"), (None, "one"), (None, "alone here only"), (9007, "x y z " * 90_000), (5, docs[5][1]), (5, docs[5][1])]
    out = simhash_vptree.near_duplicates(spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, component_id string")).collect()
    assert Counter((r.doc_id, r.fingerprint) for r in out) == Counter((k, f"{plain_fingerprint(t):016x}") for k, t in docs)
    root = components({plain_fingerprint(t) for _, t in docs}, lambda a, b: (a ^ b).bit_count() <= 3)
    low = {}
    for k, t in docs:
        if k is not None:
            r = root(plain_fingerprint(t))
            low[r] = min(low.get(r, k), k)
    assert all(r.component_id == low.get(root(int(r.fingerprint, 16))) for r in out)
    assert simhash_vptree.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_trees_lose_no_close_pair(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 1500, dtype=np.int64).view(np.uint64)
    near = base[:400] ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64))
    dense = base[0] ^ rng.integers(0, 1 << 12, 700).astype(np.uint64)
    x = np.unique(np.concatenate([base, near, dense]))
    for name, value in (("SHARD", 100), ("SAMPLE", 600)):
        monkeypatch.setattr(simhash_vptree, name, value)
    df = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "node long").withColumn("fp0", F.col("node"))
    links = [tuple(r) for r in simhash_vptree.fingerprint_links(df, 3, len(x)).collect()]
    up = {int(v): int(v) for v in x.view(np.int64)}

    def root(v):
        while up[v] != v:
            up[v] = up[up[v]]
            v = up[v]
        return v

    for a, b in links:
        up[root(a)] = root(b)
    a, b = np.nonzero(np.bitwise_count(x[:, None] ^ x[None]) <= 3)
    s = x.view(np.int64)
    assert all(root(int(s[i])) == root(int(s[j])) for i, j in zip(a, b))
    want = {}
    for i, j in zip(a, b):
        want.setdefault(i, set()).add(j)
    seen, groups = set(), 0
    for i in want:
        if i not in seen:
            todo, groups = [i], groups + 1
            while todo:
                k = todo.pop()
                if k not in seen:
                    seen.add(k)
                    todo.extend(want[k])
    assert len({root(int(v)) for v in s}) == groups


def test_keep_one(spark):
    long = " ".join(f"word{i}" for i in range(300))
    rows = [(4, long, "a"), (2, long, "b"), (2, long, "b"), (9, long.replace("word7 ", "other "), "c"), (2, "another text entirely of its own", "d"), (None, "no key at all here", "e"), (None, "no key at all here", "e"), (11, None, "f"), (12, "", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, k string")
    out = simhash_vptree.keep_one(df, size=0, tables=8, radius=3, total=96)
    assert out.columns == df.columns
    assert sorted(map(str, (tuple(r)[0::2] for r in out.collect()))) == sorted(map(str, [(2, "b"), (2, "d"), (None, "e"), (11, "f")]))


def brute_neighbours(rows, k=20):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in ok:
        if q % 20 == 0:
            best = sorted(((-float((v * u).sum()), i) for i, u in ok if i != q))[:k]
            out[q] = [(i, -s) for s, i in best]
    return out


def test_forest_is_exact_when_it_reaches_all(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.standard_normal(8).astype(np.float32)]) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 420)]  # one vector fills a third of the table
    rows += [(1000, None), (1020, [0.0] * 8), (1040, [1.0] * 7 + [None]), (1060, [float("nan")] * 8), (1080, [float("inf")] * 8), (None, rows[3][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = {}
    for r in prefix_forest.nearest_neighbours(df, F.col("vec_id") % 20 == 0, reach=32.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute_neighbours(rows)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], rel=1e-12)


def test_forest_recall_and_shards(spark, monkeypatch):
    monkeypatch.setattr(prefix_forest, "SHARD", 256)
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = prefix_forest.nearest_neighbours(df, F.col("vec_id") % 20 == 0).collect()
    x = np.array([v for _, v in rows], float)
    ids = np.array([i for i, _ in rows])
    got = Counter(r.query_id for r in out)
    hit = total = 0
    found = {(r.query_id, r.vec_id) for r in out}
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -9
        best = ids[np.argsort(-s)[:20]]
        hit += sum((ids[q], b) in found for b in best)
        total += 20
    assert set(got.values()) == {20} and hit / total >= 0.9


def test_forest_small_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 0.0])], schema)
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in prefix_forest.nearest_neighbours(one, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 2.0)]
    assert prefix_forest.nearest_neighbours(one.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_quality_holds_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    fit, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    out = site_quality.score_quality(docs, fit)
    assert out.count() == docs.count()
    n = out.join(held, "doc_id").groupBy("quality").agg(F.avg(F.col("rejected").cast("int")).alias("r")).collect()
    rate = {r.quality: r.r for r in n}
    assert rate[0] >= 0.9 and rate[1] <= 0.03
    kept = site_quality.keep_good(docs, fit)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_quality_shrinks_sparse_sites(spark):
    rows = [(i, "good plain words in a row " * 5 if i % 3 else "bad | bad | %%% ### |" * 5, f"h{i % 4}", None if i % 7 else "p", 0.0) for i in range(200)] + [(None, None, None, None, 0.0), (300, "x" * 300_000, "lone", "p", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, posterior double")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(100)] + [(None, 1), (5, None)], "doc_id long, quality int")
    out = site_quality.score_quality(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r.posterior <= 1 for r in out)
    lone = next(r for r in out if r.doc_id == 300)
    prior = sum(r.p_doc for r in out) / len(out)
    assert lone.host_posterior == pytest.approx(prior, abs=1e-6)  # its only document is its own
    assert not any(r.rejected for r in site_quality.score_quality(docs, labels.limit(0)).collect())
    assert site_quality.score_quality(docs.limit(0), labels).count() == 0


def nested_posteriors(rows):
    """(h, p, p_doc) -> host and path posteriors, by the sums of squares of a nested design."""
    h, p, y = (np.array(c) for c in zip(*rows))
    path = np.array([f"{a}/{b}" for a, b in rows_sites(rows)])
    mean = lambda mask: y[mask].mean()
    prior, n = y.mean(), len(y)
    hosts, paths = sorted(set(h)), sorted(set(path))
    sw = sum(((y[path == q] - mean(path == q)) ** 2).sum() for q in paths)
    within = sw / (n - len(paths))
    of = {q: q.split("/")[0] for q in paths}
    size = {q: (path == q).sum() for q in paths} | {a: (h == a).sum() for a in hosts}
    sp = sum(size[q] * (mean(path == q) - mean(h == of[q])) ** 2 for q in paths)
    sh = sum(size[a] * (mean(h == a) - prior) ** 2 for a in hosts)
    inner = {a: sum(size[q] ** 2 for q in paths if of[q] == a) for a in hosts}
    c1 = n - sum(inner[a] / size[a] for a in hosts)
    s2p = max(0, (sp - (len(paths) - len(hosts)) * within) / c1)
    c2 = sum(inner[a] / size[a] for a in hosts) - sum(size[q] ** 2 for q in paths) / n
    s2h = max(0, (sh - (len(hosts) - 1) * within - s2p * c2) / (n - sum(size[a] ** 2 for a in hosts) / n))
    out = []
    for i in range(n):
        a, q = h[i], path[i]
        others = np.arange(n) != i
        noise = within / max(1, size[a] - 1) + s2p * inner[a] / size[a] ** 2
        w = s2h / (s2h + noise) if s2h else 0
        host = prior + w * (mean((h == a) & others) - prior) if size[a] > 1 else prior
        w = s2p / (s2p + within / max(1, size[q] - 1)) if s2p else 0
        out.append((host, host + w * (mean((path == q) & others) - host) if size[q] > 1 else host))
    return out


def rows_sites(rows):
    return [(r[0], r[1]) for r in rows]


def test_quality_posteriors_match_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = []
    for a in range(6):
        for b in range(4):
            centre = 0.5 + 0.3 * np.sin(a) + 0.1 * np.cos(3 * b + a)
            rows += [(f"h{a}", f"p{b}", float(np.clip(centre + 0.1 * rng.standard_normal(), 0.01, 0.99))) for _ in range(1 + (a * 7 + b * 5) % 11)]
    rows.append(("lone", "p0", 0.2))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "k long, h string, p string, p_doc double")
    got = {r.k: (r.host_posterior, r.path_posterior) for r in site_quality.site_posteriors(df).collect()}
    for i, want in enumerate(nested_posteriors(rows)):
        assert got[i] == pytest.approx(want, rel=1e-9)


def test_forest_takes_ties_and_dimensions(spark):
    rows = [(i, [1.0 if j == i % 4 else 0.0 for j in range(4)]) for i in range(400)] + [(1000 + i, [1.0, 0.0]) for i in range(0, 50)]
    rows += [(2000 + i, [1.0, float(i), 0.0, 0.0]) for i in range(300)]  # all tie for a one-hot query
    out = {}
    for r in prefix_forest.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, reach=16.0).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.vec_id)
    by = dict(rows)
    for q, got in out.items():
        want = sorted((-sum(a * b for a, b in zip(by[q], v)), i) for i, v in rows if i != q and len(v) == len(by[q]))[:20]
        assert got == [i for _, i in want]
    assert len(out) == 20 + 3 + 15


def test_warc_round_trip(spark, tmp_path):
    pages = [(1, "http://a", "<p>é😀</p>"), (2, "http://b\r\nX: y", "<p>é😀</p>"), (3, None, None), (9, "http://c", ""), (4, "http://d", "WARC/1.1\r\n\r\nfake\r\n\r\n"), (None, "http://e", "<p>é😀</p>"), (None, "u", "solo"), (2, "http://b", "<p>é😀</p>"), (8, "http://l", "z" * 3_000_000)]
    df = spark.createDataFrame([(*p, 0) for p in pages], "page_id long, url string, html string, offset int")
    index = warc_index.write_archives(df, str(tmp_path / "w"))
    assert index.count() == len(pages)
    out = warc_index.read_records(index, payload=True).collect()
    best = {}
    for i, _, h in pages:
        if i is not None:
            best[h or ""] = max(best.get(h or "", i), i)
    want = Counter()
    for i, _, h in pages:
        h = h or ""
        top = best.get(h)
        revisit = top is not None and (i is None or i < top)
        want[i, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(), "revisit" if revisit else "response", top if revisit else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == want
    assert {r.payload.decode() for r in out if r.record_type == "response"} == {h or "" for _, _, h in pages}
    some = warc_index.read_records(index.where("url = 'http://d'")).collect()
    assert [(r.page_id, r.url) for r in some] == [(4, "http://d")]
    bigger = warc_index.write_archives(df, str(tmp_path / "v"), least_bytes=100)
    assert {r.record_type for r in warc_index.read_records(bigger).collect()} == {"response"}
    assert warc_index.read_records(warc_index.write_archives(df.limit(0), str(tmp_path / "e"))).count() == 0


def test_coalesced_ranges():
    places = [("a", 0, 10), ("a", 10, 5), ("a", 100 << 10, 5), ("b", 0, 3), ("b", 3, warc_index.RANGE), ("b", 4 + warc_index.RANGE, 1)]
    got = list(warc_index.coalesced(places))
    assert [g[:3] for g in got] == [("a", 0, 15), ("a", 100 << 10, (100 << 10) + 5), ("b", 0, 3), ("b", 3, 3 + warc_index.RANGE), ("b", 4 + warc_index.RANGE, 5 + warc_index.RANGE)]
    assert [i for g in got for i in g[3]] == list(range(6)) and list(warc_index.coalesced([])) == []


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](spark, docs, SF).cache()
    wrong = good.join(labels.where("quality = 0"), "doc_id").count()
    clean = docs.join(labels.where("quality = 1"), "doc_id").count()
    assert wrong <= 2 and good.join(labels.where("quality = 1"), "doc_id").count() >= 0.97 * clean
    one = stages["simhash near-dedup"](spark, good, SF).cache()
    assert one.select("text").distinct().count() == one.count() and one.columns == docs.columns
    left = stages["benchmark decontamination"](spark, one, SF).cache()
    assert benchmark_leaks.find_leaks(left, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    mixed = stages["mixing to weights"](spark, left, SF)
    assert mixed.columns == docs.columns and set(r.doc_id for r in mixed.collect()) <= set(r.doc_id for r in left.collect())
    out = corpus_pipeline.run(spark, SF)
    assert out.count() == mixed.count() and out.columns[:4] == docs.columns[:4] and {*docs.columns, "shard", "slot"} <= set(out.columns)
    assert {tuple(r) for r in out.select("doc_id", "text", "source", "lang").collect()} <= {tuple(r) for r in docs.select("doc_id", "text", "source", "lang").collect()}
    assert {r[0] for r in out.select(F.regexp_extract(F.input_file_name(), r"shard=(\d+)", 1).cast("int") == F.col("shard")).collect()} == {True}


def test_pipeline_stages_take_awkward_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    empty = docs.limit(0)
    clash = "doc_id long, text string, lang string, source string, n_chars long, row string, node long, shard string, k int, t double, slot int, h string, p string, c string"
    odd = [(None, None, None, None, None) + (None,) * 9, (1, "", "en", "s", 0, "r", 1, "x", 1, 1.0, 1, "h", "p", "c"), (2, "plain words " * 100_000, "en", "s", 1, "r", 1, "x", 1, 1.0, 1, "h", "p", "c")]
    odd += [(3, "one text that stands twice", "en", None, 1, "r", 1, "x", 1, 1.0, 1, "h", "p", "c")] * 2
    odd = spark.createDataFrame(odd, clash)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, empty, SF).count() == 0
        out = stage(spark, odd, SF)
        assert set(out.columns) >= set(odd.columns) and (i == 4 or out.columns == odd.columns)
        # near-dedup keeps one of the null and empty texts and one of the repeated rows
        assert out.count() == {1: 3, 2: 5, 4: 5}.get(i, out.count())


def test_keep_one_verifies_shingles(spark, monkeypatch):
    monkeypatch.setattr(simhash_vptree, "CHUNK", 4)  # components of several chunks too
    rng = np.random.default_rng(8)

    def changed(w, n):
        w = list(w)
        for i in rng.choice(len(w), n, replace=False):
            w[i] = f"new{rng.integers(1 << 30)}"
        return w

    rows = []
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(150)]
        rows += [" ".join(changed(base, n)) for n in (0, 0, 1, 2, 3, 4, 5, 6, 8, 10)]
        rows += [" ".join(base[::-1]), " ".join(rng.permutation(base))]  # the same words in another order
    rows += [" ".join(changed(rows[0].split(), 1)) for _ in range(20)]
    rows += ["one two", "ONE  two", "two one", "", None]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    sets = [{b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if (w := words(t)) else set() for t in rows]
    loose = {r.doc_id: r.component_id for r in simhash_vptree.near_duplicates(df, size=0, tables=8, radius=3, total=96).collect()}
    root = components(range(len(rows)), lambda a, b: loose[a] == loose[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    low = {}
    for i in range(len(rows)):
        low.setdefault(root(i), i)
    out = simhash_vptree.near_duplicates(df, size=0, tables=8, radius=3, total=96, min_jaccard=0.8)
    assert {r.doc_id: r.component_id for r in out.collect()} == {i: low[root(i)] for i in range(len(rows))}
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, SF).collect()}
    assert kept == set(low.values())
    assert kept < set(range(len(rows))) and len(set(loose.values())) < len(kept)
