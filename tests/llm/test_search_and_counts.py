"""Ranked search, hard negatives and token counts against plain brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyseq.llm import block_search, radix_negatives, token_counts

SF = "/root/testdata/sf0.001"


def plain_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain_ranking(docs, items, k):
    own = [(d, plain_terms(t)) for d, t in docs]
    n_docs, n_terms = sum(1 for _, w in own if w), sum(len(w) for _, w in own)
    df = Counter(t for _, w in own for t in set(w))
    out = []
    for item, text in items:
        found = []
        for d, w in own:
            tf, score = Counter(w), 0
            for t in set(plain_terms(text)):
                if tf[t]:
                    m = 50 + 50 * len(w) * n_docs // n_terms
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * m))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(found)[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("shard, first", [(16 << 20, 16), (2_000, 2)])
def test_ranking_matches_brute_force(spark, monkeypatch, shard, first):
    monkeypatch.setattr(block_search, "SHARD_BYTES", shard)
    monkeypatch.setattr(block_search, "FIRST", first)
    rng = random.Random(shard)
    vocabulary = ["the", "of", "Äpfel", "中文", "x1", "b2"] + [f"w{i}" for i in range(150)]
    text = lambda n: rng.choice([" ", "-", "\n"]).join(rng.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=n))
    docs = [(i, text(rng.choice([1, 3, 20, 60, 200]))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(200)]  # one text fills a third of the table
    docs += [(None, "the w3"), (None, "the w3"), (5, "the w3"), (5, "THE w3"), (2000, None), (2001, ""), (2002, "-!? \t"), (2003, "the " * 30_000)]
    items = [(1, "The OF w3 w4 w4"), (2, None), (3, ""), (4, "nowhere"), (5, docs[7][1]), (5, "äpfel 中文"), (None, "w9 of"), (7, " ".join(vocabulary))]
    got = block_search.rank_documents(
        spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, score int").repartition(3),
        spark.createDataFrame([(*x, "r") for x in items], "item_id long, text string, rank string"), k=20).collect()
    assert Counter(tuple(r) for r in got) == plain_ranking(docs, items, 20)


def test_search_in_blocks_of_items_and_with_nothing(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = Counter(map(tuple, block_search.rank_documents(docs, items).collect()))
    monkeypatch.setattr(block_search, "ITEM_BYTES", 1_500)
    assert Counter(map(tuple, block_search.rank_documents(docs, items).collect())) == whole
    assert block_search.rank_documents(docs.limit(0), items).count() == 0
    assert block_search.rank_documents(docs, items.limit(0)).count() == 0
    named = block_search.rank_documents(docs.withColumnRenamed("doc_id", "item_id"), items, key="item_id")
    assert named.columns == ["item_id_item", "rank", "item_id", "score"]


def test_bytes_that_are_not_text(spark):
    docs = spark.range(1).select(F.lit(1).cast("long").alias("doc_id"), F.expr("cast(unhex('61FF62') as string)").alias("text"))
    items = docs.select(F.col("doc_id").alias("item_id"), "text")
    assert block_search.rank_documents(docs, items).count() == 1
    import public_tokenizers

    assert token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).first().n_bytes == 3


def plain_blocks(f):
    """Least sum of block sizes times block maxima plus prices, over all cuts."""
    price = block_search.PRICE * f.mean()
    best = [0.0]
    for j in range(1, len(f) + 1):
        best.append(min(best[i] + (j - i) * f[i:j].max() + price for i in range(j)))
    return best[-1]


def test_blocks_are_the_best_cuts():
    rng = np.random.default_rng(1)
    lists = [rng.integers(1, 1000, n) ** 2 for n in (1, 2, 7, 40, 100, 128, 128, 129, 700)]
    start = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    first, block = block_search.choose_blocks(np.concatenate(lists), start)
    for i, f in enumerate(lists):
        cuts = first[block[i]: block[i + 1]] - start[i]
        assert cuts[0] == 0 and (np.diff(cuts) > 0).all()
        cost = sum(len(p) * p.max() for p in np.split(f, cuts[1:])) + len(cuts) * block_search.PRICE * f.mean()
        if len(f) <= block_search.CELLS:
            assert cost == pytest.approx(plain_blocks(f))
        assert cost <= len(f) * f.max() + block_search.PRICE * f.mean() + 1e-6  # never worse than one block


def test_bounds_skip_postings(monkeypatch):
    rng = np.random.default_rng(3)
    n = 4_000
    lengths = np.sort(rng.integers(5, 2_000, n)).astype(np.int32)
    post = [np.sort(rng.choice(n, size, replace=False)) for size in (40, 900, 3_500)]
    tf = [np.where(rng.random(len(p)) < 0.02, 40, 1) for p in post]
    shard = block_search.Shard(lengths, np.arange(3), np.array([len(p) for p in post]), np.concatenate(post).astype(np.int32), np.concatenate(tf).astype(np.int32), n, int(lengths.sum()))
    weight = np.array([6_000, 1_500, 100])
    docs, scores = shard.search(np.arange(3), weight, 10, 0, np.arange(n))
    whole = np.zeros(n, np.int64)
    start = 0
    for p, w in zip(post, weight):
        np.add.at(whole, p, shard.impact[start: start + len(p)] * w)
        start += len(p)
    want = np.lexsort((np.arange(n), -whole))[:10]
    assert docs.tolist() == want.tolist() and scores.tolist() == whole[want].tolist()
    for t in (1, 2):  # bounds by block hold, and are tighter than one bound for a list
        own = post[t]
        bound = np.zeros(n, np.int64)
        for b in range(shard.block[t], shard.block[t + 1]):
            bound[shard.low[b]: shard.high[b] + 1] = shard.top[b]
        impact = shard.impact[shard.start[t]: shard.start[t + 1]]
        assert (bound[own] >= impact).all()
        assert (bound[own] - impact).sum() < 0.7 * (impact.max() - impact).sum()
    read = 0

    def counted(starts, sizes, spread=block_search.spread):
        nonlocal read
        read += int(sizes.sum())
        return spread(starts, sizes)

    monkeypatch.setattr(block_search, "spread", counted)
    shard.search(np.arange(3), weight, 10, 0, np.arange(n))
    assert read < 0.75 * sum(map(len, post))  # blocks that can't matter aren't read


def plain_negatives(rows, k=5):
    ok = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for a, lab, v in ok:
        if a % 100:
            continue
        scored = [(sum(x * y for x, y in zip(v, u)), i, other) for i, other, u in ok if i != a and len(u) == len(v)]
        order = lambda s: (-s[0], s[1])
        for p, i, _ in sorted((s for s in scored if s[2] == lab), key=order)[:k]:
            hard = sorted((s for s in scored if s[2] != lab and 80 * p <= 100 * s[0] <= 100 * p), key=order)[:k]
            out |= {(a, i, rank, s[1], p, s[0]) for rank, s in enumerate(hard, 1)}
    return out


@pytest.mark.parametrize("digit, anchors, ids", [(12, 1 << 14, 1), (3, 1 << 14, 1), (5, 2, 1), (12, 1 << 14, 1 << 53)])
def test_negatives_match_brute_force(spark, monkeypatch, digit, anchors, ids):
    monkeypatch.setattr(radix_negatives, "DIGIT", digit)
    monkeypatch.setattr(radix_negatives, "ANCHORS", anchors)
    rng = np.random.default_rng(digit)
    vectors = [[float(x) for x in rng.standard_normal(6).astype(np.float32)] for _ in range(300)]
    rows = [(i * ids, int(rng.integers(0, 3)), v) for i, v in enumerate(vectors)]
    rows += [((300 + i) * ids, int(rng.integers(0, 3)), vectors[0]) for i in range(150)]  # one vector fills a third of the table
    rows += [(-100 * ids, 1, vectors[0]), (-100 * ids - 1, 1, vectors[0]), (900, None, vectors[1]), (None, 1, vectors[1]), (1000, 1, None), (1100, 1, [1.0] * 5 + [None]),
             (1200, 1, [float("nan")] * 6), (1300, 1, [float("inf")] * 6), (1400, 1, [1.0, 2.0]), (1401, 1, [1.0, 2.0]), (1402, 2, [1.0, 1.9]), (1500, 1, []), (1501, 1, []), (1502, 2, [])]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, label int, embedding array<float>, rank int").repartition(3)
    got = radix_negatives.mine_negatives(df, F.col("vec_id") % 100 == 0).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert {tuple(r) for r in got} == plain_negatives(rows)


def test_negatives_of_nothing_and_of_huge_numbers(spark):
    kind = "vec_id long, label int, embedding array<double>"
    assert radix_negatives.mine_negatives(spark.createDataFrame([], kind), F.col("vec_id") % 100 == 0).count() == 0
    assert radix_negatives.mine_negatives(spark.createDataFrame([(7, 1, [1.0])], kind), F.col("vec_id") % 100 == 0).count() == 0
    rows = [(100, 1, [1e308, 1.0]), (101, 1, [1e300, 0.0]), (102, 2, [1e299, 0.0]), (200, 1, [-3.0, 2.0]), (201, 1, [3.0, 5.0]), (202, 2, [-3.0, 2.0])]
    got = radix_negatives.mine_negatives(spark.createDataFrame(rows, kind), F.col("vec_id") % 100 == 0).collect()
    assert (100, 101, 1, 102, radix_negatives.MOST, radix_negatives.MOST) in {tuple(r) for r in got}


def test_repeated_keys_keep_k_rows(spark):
    v = [1.0, 1.0]
    rows = [(100, 1, v), (100, 1, v), (1, 1, v)] + [(2, 2, v)] * 40
    got = radix_negatives.mine_negatives(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"), F.col("vec_id") == 100).collect()
    assert sorted((r.positive_id, r["rank"], r.negative_id) for r in got) == [(1, n, 2) for n in range(1, 6)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_match_whole_texts(spark, monkeypatch, name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    monkeypatch.setattr(token_counts, "BATCH_BYTES", 2_000)
    rng = random.Random(5)
    odd = "aZ19 '.,\t\n\x0b\x1c\x1f\x85\xa0é中文😀²_<|>" + "".join(map(chr, (0x2003, 0x3000, 0x200B, 0x301)))
    bits = ["<|endoftext|>", "'s", "'re", "  ", "\n\n", "abc123" * 30, "word ", "</s>"]
    texts = ["".join(rng.choice(odd) if rng.random() < 0.6 else rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    texts += [None, "", " ", "word " * 30_000, "x" * 20_000, texts[3], texts[3]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b")]
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        count = lambda t: len(own.encode(t, add_special_tokens=False))
    else:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_tokens int")
    got = token_counts.count_tokens(df, path).collect()
    want = Counter((i, len((t or "").encode()), n := count(t or ""), n > 1024) for i, t in rows)
    assert Counter(tuple(r) for r in got) == want
    assert token_counts.count_tokens(df.limit(0), path).count() == 0


def test_pieces_start_anew_when_full(monkeypatch):
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        file = f.read()
    texts = [" ".join(f"word{i * j}" for j in range(50)) for i in range(40)]
    want = token_counts.Counter(file, ".json").counts(texts)
    monkeypatch.setattr(token_counts, "REMEMBERED", 60)
    small = token_counts.Counter(file, ".json")
    assert small.counts(texts) == want and len(small.known) <= 60
    assert all("".join(token_counts.pieces(t)) == t for t in texts)


def test_filters_keep_columns_with_dots(spark):
    from tallyseq.llm import benchmark_leaks, site_quality

    rows = [(i, f"some words of text number {i} and more", "en", "s", i) for i in range(40)] + [(99, "a b c d e f", "en", "s", 1), (98, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, `x.y` int")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    whole = {r.doc_id for r in docs.collect()}
    kept = benchmark_leaks.drop_leaking(docs, items)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == whole - {99}
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    assert site_quality.keep_good(docs, labels).columns == docs.columns
