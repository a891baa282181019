"""SimHash near-duplicates: exact pairs within a Hamming radius by vantage-point trees.

A pair within a radius of r bits is within r // 2 bits in one half of the fingerprint, so there is one
tree for each half with that smaller radius, by which it prunes far better. A tree fitted to a bounded
sample cuts the fingerprints into shards. A node holds a vantage point v and a threshold mu:
fingerprints with d(v, x) <= mu in the tree's half go inside, the others outside, and by the triangle
inequality a pair within the tree's radius that is cut apart has its outer end at d <= mu + radius, so
outer fingerprints that near the boundary are queried inside as well. Every linked pair thus meets in at
least one shard. Shards go on splitting by the same rule in memory, then compare all bits exactly. A
shard gives out a spanning forest of its links instead of all pairs, and components are joined across
shards.

With `min_jaccard` these components are only candidates: inside each one, all texts are compared by the
exact Jaccard of their five-word shingles, and the links that pass make the final components.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyseq.llm.sampling import hash_sample
from tallyseq.llm.words import words
from tallyseq.operators.graph import connected_components
from tallyseq.session import materialize, scratch

#: Fingerprints that the shared trees are fitted to: so many a leaf, at least and at most in all. Distinct
#: fingerprints aimed at in a shard; beyond MOST / PER_LEAF shards they grow, and go on splitting in memory.
PER_LEAF, SAMPLE, MOST, SHARD = 32, 16_384, 1 << 20, 4_096
#: Up to this many row keys (24 bytes each) are broadcast; more are joined by shuffle.
MAX_BROADCAST_KEYS = 1_000_000
#: Texts, and shingles in all, of a candidate component that one group of the Jaccard check takes.
CHUNK, CHUNK_SHINGLES = 512, 1 << 20
#: Blocks up to this size are compared as a matrix.
BLOCK = 384
_BYTES = np.uint64(0x0101010101010101)
#: The bits that each tree measures by.
HALVES = (np.uint64(0x00000000FFFFFFFF), np.uint64(0xFFFFFFFF00000000))


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set; sums run in bytes over up to 255 rows."""
    pad = -len(h) % 255
    rows = np.concatenate([h, np.zeros(pad, np.uint64)]).reshape(-1, 255)
    out = np.zeros((8, 8), np.int64)
    for s in range(8):
        sums = ((rows >> np.uint64(s)) & _BYTES).sum(axis=1, dtype=np.uint64)
        out[:, s] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out.ravel()


def _mix(h: np.ndarray, table: int) -> np.ndarray:
    """Hashes of another table, from those of the first by an odd multiplier and two folds."""
    if not table:
        return h
    with np.errstate(over="ignore"):
        h = h * np.uint64((2 * table * 0x9E3779B97F4A7C15 + 1) & ((1 << 64) - 1))
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def fingerprint(text: str | None, size: int = 3, seed: int = 42, tables: int = 1) -> np.ndarray:
    """64-bit SimHash per table over word shingles with repeats (size 0: over distinct words); no words give 0."""
    import xxhash

    w = words(text)
    if not w:
        return np.zeros(tables, np.uint64)
    if size:
        found = map(b" ".join, zip(*[w[i:] for i in range(size)])) if len(w) > size else iter([b" ".join(w)])
    else:
        found = iter(set(w))
    counts, n = np.zeros((tables, 64), np.int64), 0
    while part := list(itertools.islice(found, 1 << 17)):
        h = np.fromiter(map(xxhash.xxh64_intdigest, part, itertools.repeat(seed)), np.uint64, len(part))
        for t in range(tables):
            counts[t] += bit_counts(_mix(h, t))
        n += len(part)
    return np.packbits(2 * counts > n, axis=1, bitorder="little").view("<u8").ravel()


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; a shorter text is one shingle, no words give none."""
    import xxhash

    w = words(text)
    found = {b" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else ()
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found)))


def jaccard_forest(sets: list[np.ndarray], least: float) -> tuple[list[int], list[int]]:
    """Index pairs at a Jaccard of `least` or more whose components are those of all such pairs.

    One pass counts what a set has in common with every other. A pair between two clusters is found from
    either end, so the members of the largest cluster needn't be passed.
    """
    n = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], np.repeat(np.arange(len(sets)), n)[order]
    label, done, src, dst = np.arange(len(sets)), n == 0, [], []
    while len(todo := np.flatnonzero(~done & (label != np.bincount(label).argmax()))):
        i = int(todo[0])
        done[i] = True
        low = np.searchsorted(every, sets[i])
        many = np.searchsorted(every, sets[i], "right") - low
        at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        shared = np.bincount(owner[at], minlength=len(sets))
        for j in np.flatnonzero((shared > 0) & (shared >= least * (n[i] + n - shared) - 1e-9)):
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                src.append(i)
                dst.append(int(j))
    return src, dst


def choose_split(x: np.ndarray, radius: int, rng: np.random.Generator) -> tuple | None:
    """(vantage, mu) that splits x best with its overlap, or None if no split pays."""
    best = None
    for v in rng.choice(x, size=min(8, len(x)), replace=False):
        hist = np.bincount(np.bitwise_count(x ^ v), minlength=65)[:65]
        upto = np.cumsum(hist)
        inside = upto[np.minimum(np.arange(65) + radius, 64)]
        outside = len(x) - upto
        cost = inside.astype(float) ** 2 + outside.astype(float) ** 2
        mu = int(cost.argmin())
        if best is None or cost[mu] < best[0]:
            best = (cost[mu], v, mu)
    return None if best[0] > 0.93 * float(len(x)) ** 2 else best[1:]


def cut(x: np.ndarray, v, mu: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    d = np.bitwise_count(x ^ v)
    return np.flatnonzero(d <= mu + radius), np.flatnonzero(d > mu)


def fit_tree(sample: np.ndarray, leaves: int, radius: int) -> list:
    """Nodes as [vantage, mu, inside, outside]; a child below zero is leaf number -child - 1."""
    rng, nodes, n_leaves = np.random.default_rng(7), [], 0
    limit = max(1.0, len(sample) / leaves)

    def grow(x: np.ndarray, depth: int) -> int:
        nonlocal n_leaves
        split = choose_split(x, radius, rng) if len(x) > max(limit, 16) and depth < 24 else None
        if split is None:
            n_leaves += 1
            return -n_leaves
        at = len(nodes)
        nodes.append([split[0], split[1], 0, 0])
        inside, outside = cut(x, *split, radius)
        nodes[at][2] = grow(x[inside], depth + 1)
        nodes[at][3] = grow(x[outside], depth + 1)
        return at

    root = grow(sample, 0)
    return [root, nodes]


def shards_of(x: np.ndarray, tree: list, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard, index into x): the home shard of each fingerprint and those it overlaps."""
    root, nodes = tree
    todo, shard, index = [(root, np.arange(len(x)))], [], []
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if node < 0:
            shard.append(np.full(len(at), -node - 1, np.int32))
            index.append(at)
            continue
        v, mu, low, high = nodes[node]
        inside, outside = cut(x[at], v, mu, radius)
        todo += [(low, at[inside]), (high, at[outside])]
    return (np.concatenate(shard), np.concatenate(index)) if shard else (np.zeros(0, np.int32), np.zeros(0, np.int64))


def _flood(x: np.ndarray, full: np.ndarray, radius: int, total: int, out: list) -> None:
    """Spanning forest of x when no split pays: visited fingerprints leave the search."""
    left = np.arange(len(x))
    while len(left) > 1:
        seed, left = left[0], left[1:]
        front = [seed]
        while front and len(left):
            p = front.pop()
            near = np.bitwise_count(x[left] ^ x[p]) <= radius
            if near.any() and full.shape[1] > 1:
                at = np.flatnonzero(near)
                near[at] = np.bitwise_count(full[left[at]] ^ full[p]).sum(axis=1) <= total
            if near.any():
                got, left = left[near], left[~near]
                out.append((np.repeat(seed, len(got)), got))
                front.extend(got)


def _block(x: np.ndarray, full: np.ndarray, radius: int, total: int, out: list) -> None:
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= radius
    if full.shape[1] > 1:
        a, b = np.nonzero(near)
        near[a, b] = np.bitwise_count(full[a] ^ full[b]).sum(axis=1) <= total
    linked = near.sum(axis=1) > 1
    while linked.any():
        seed = int(linked.argmax())
        member = near[seed]
        while True:
            more = near[member].any(axis=0)
            if (more == member).all():
                break
            member = more
        linked &= ~member
        got = np.flatnonzero(member & (np.arange(len(x)) != seed))
        out.append((np.repeat(seed, len(got)), got))


def shard_links(x: np.ndarray, radius: int, half: np.uint64, full: np.ndarray | None = None, total: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose components are those of all pairs of x within `radius` bits (radius // 2 in the
    half), and within `total` bits over all tables if full holds more than one."""
    full = x[:, None] if full is None else full
    part, near = x & half, radius // len(HALVES)
    rng, out, todo = np.random.default_rng(11), [], [np.arange(len(x))]
    while todo:
        at = todo.pop()
        if len(at) < 2:
            continue
        split = choose_split(part[at], near, rng) if len(at) > BLOCK else None
        if split is not None:
            todo += [at[i] for i in cut(part[at], *split, near)]
        else:
            found: list = []
            (_block if len(at) <= BLOCK else _flood)(x[at], full[at], radius, total, found)
            out += [(at[a], at[b]) for a, b in found]
    none = np.zeros(0, np.int64)
    return (np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])) if out else (none, none)


def _text_hash(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _few(df: DataFrame) -> DataFrame:
    """df, broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_KEYS else df


def fingerprints(docs: DataFrame, key: str, text: str, size: int, seed: int, tables: int = 1, shingles: bool = False) -> DataFrame:
    """(k, fp0, fp1, ..., node) of every row as signed bigints; node names the distinct fingerprint (tuple).

    With `shingles`, node names the distinct set of five-word shingles instead, and (n, h) are its size and
    the text's hash.
    """
    import pyarrow as pa
    import xxhash

    names = [f"fp{t}" for t in range(tables)]

    def batches(it):
        for b in it:
            fp = [fingerprint(t.as_py(), size, seed, tables) for t in b.column(1)]
            fp = np.array(fp, np.uint64).reshape(-1, tables).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c) for c in fp.T.copy()]], ["k", *names])

    def with_sets(it):
        for b in it:
            fp, of = [], []
            for t in b.column(1):
                t = t.as_py()
                fp.append(fingerprint(t, size, seed, tables))
                of.append((xxhash.xxh64_intdigest((s := shingle_set(t)).tobytes()), len(s)))
            fp, of = np.array(fp, np.uint64).reshape(-1, tables).view(np.int64), np.array(of, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c) for c in fp.T.copy()], *[pa.array(c) for c in of.T.copy()], b.column(2)], ["k", *names, "node", "n", "h"])

    kind = docs.schema[key].dataType.simpleString()
    if shingles:
        rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), _text_hash(text).alias("h"))
        return rows.mapInArrow(with_sets, f"k {kind}, " + "".join(f"{n} long, " for n in names) + "node long, n long, h long")
    out = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(batches, f"k {kind}, " + ", ".join(f"{n} long" for n in names))
    return out.withColumn("node", F.col("fp0") if tables == 1 else F.xxhash64(*names))


def fingerprint_links(nodes: DataFrame, radius: int, n: int, tables: int = 1, total: int = 0) -> DataFrame:
    """Distinct nodes with their fingerprints -> links (src, dst) with the components of all close pairs."""
    import pyarrow as pa

    names = [f"fp{t}" for t in range(tables)]
    sample = min(MOST, max(SAMPLE, PER_LEAF * math.ceil(n / SHARD)))
    picked = hash_sample(nodes, F.col("node"), sample, n).select(*names).toPandas().to_numpy(np.int64).view(np.uint64) if n > SHARD else np.zeros((0, tables), np.uint64)
    near = radius // len(HALVES)
    trees = [fit_tree(picked[:, t] & half, math.ceil(n / SHARD), near) if len(picked) else [-1, []] for t in range(tables) for half in HALVES]

    def deal(it):
        for b in it:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(tables + 1)]
            for t, tree in enumerate(trees):
                table, half = divmod(t, len(HALVES))
                shard, at = shards_of(cols[1 + table].view(np.uint64) & HALVES[half], tree, near)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t, np.int32)), pa.array(shard), *[pa.array(c[at]) for c in cols]], ["t", "shard", "node", *names])

    def link(key: tuple, rows: pa.Table) -> pa.Table:
        node, first = np.unique(rows.column("node").to_numpy(), return_index=True)
        full = np.stack([rows.column(c).to_numpy()[first].view(np.uint64) for c in names], axis=1)
        table, half = divmod(key[0].as_py(), len(HALVES))
        a, b = shard_links(full[:, table].copy(), radius, HALVES[half], full, total)
        return pa.table({"src": pa.array(node[a]), "dst": pa.array(node[b])})

    fields = "t int, shard int, node long, " + ", ".join(f"{n} long" for n in names)
    return nodes.select("node", *names).mapInArrow(deal, fields).groupBy("t", "shard").applyInArrow(link, "src long, dst long")


def verified_links(docs: DataFrame, text: str, members: DataFrame, least: float) -> DataFrame:
    """Members (node, component, n, h) of candidate components -> links (src, dst) with the components of
    all pairs inside a candidate component at a five-word Jaccard of `least` or more.

    A component of more than CHUNK texts is cut into chunks, each compared together with the component's
    first text, which ties the chunks of true copies. What isn't in the component's largest cluster then
    is compared with all its texts, in groups of two chunks.
    """
    import pyarrow as pa

    def link(_: tuple, rows: pa.Table) -> pa.Table:
        node, first = np.unique(rows.column("node").to_numpy(), return_index=True)
        texts = rows.column("t")
        a, b = jaccard_forest([shingle_set(texts[int(i)].as_py()) for i in first], least)
        return pa.table({"src": pa.array(node[a], pa.int64()), "dst": pa.array(node[b], pa.int64())})

    out = "src long, dst long"
    chunks = F.greatest(F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("n") / CHUNK_SHINGLES)).cast("int")
    big = materialize(members.groupBy("component").agg(chunks.alias("chunks")).where("chunks > 1"), "simhash-big")
    cut = members.join(_few(big), "component", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    cut = materialize(cut.withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks").cast("int")), "simhash-chunks")
    texts = docs.select(_text_hash(text).alias("h"), F.col(text).alias("t")).join(_few(cut), "h").dropDuplicates(["node"])
    texts = materialize(texts.select("component", "chunks", "chunk", "node", "t"), "simhash-texts")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    where = F.when(F.col("node") == F.col("component"), upto("chunks")).otherwise(F.array("chunk"))
    links = materialize(texts.select("component", F.explode(where).alias("a"), "node", "t").groupBy("component", "a").applyInArrow(link, out), "simhash-verified")
    if not big.count():
        return links
    in_big = cut.where("chunks > 1").select("component", "node")
    clusters = connected_components(links.join(in_big.select(F.col("node").alias("src")), "src", "left_semi")).select("node", F.col("component").alias("cluster"))
    clusters = materialize(in_big.join(clusters, "node", "left").withColumn("cluster", F.coalesce("cluster", "node")), "simhash-clusters")
    largest = clusters.groupBy("component", "cluster").count().groupBy("component").agg(F.max_by("cluster", F.struct("count", "cluster")).alias("cluster"))
    rest = materialize(clusters.join(_few(materialize(largest, "simhash-largest")), ["component", "cluster"], "left_anti").select("component", "node"), "simhash-rest")
    if not rest.count():
        return links
    of = rest.groupBy("component").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("others"))
    wide = texts.join(_few(materialize(of, "simhash-others")), "component")
    all_of = wide.select("component", F.col("chunk").alias("a"), F.explode(upto("others")).alias("b"), "node", "t")
    odd = wide.join(_few(rest.select("node")), "node", "left_semi")
    odd = odd.select("component", F.explode(upto("chunks")).alias("a"), F.pmod(F.xxhash64("node"), "others").cast("int").alias("b"), "node", "t")
    return links.unionByName(all_of.unionByName(odd).groupBy("component", "a", "b").applyInArrow(link, out))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, radius: int = 3, seed: int = 42, tables: int = 1, total: int = 0, min_jaccard: float = 0.0,
) -> DataFrame:
    """(key, fingerprint, component_id), one row per input row.

    component_id is the smallest key reachable over links. Two fingerprints link if they differ in at
    most `radius` bits; with several tables (each SimHash from other hashes of the same features) if
    that holds in any of them and all tables together differ in at most `total` bits. With `min_jaccard`
    the components of these links are candidates, and two texts link if they are in one candidate
    component and their sets of five-word shingles have that Jaccard at least (a text of 1 to 4 words is
    one shingle; texts without words are equal). Null keys are
    never the smallest, and a component of null keys alone has null. Null and empty texts, and texts of
    white space, have fingerprint zero and link like any other. Repeated rows stay. An empty input gives
    an empty result; other columns are not read; texts are hashed whole.
    """
    with scratch(docs.sparkSession) as keep:
        rows = keep(materialize(fingerprints(docs, key, text, size, seed, tables, min_jaccard > 0), "simhash"))
        names = [f"fp{t}" for t in range(tables)]
        of_set = [F.first("n").alias("n"), F.min("h").alias("h")] if min_jaccard > 0 else []
        nodes = rows.groupBy("node").agg(F.min("k").alias("low"), *[F.first(c).alias(c) for c in names], *of_set)
        nodes = materialize(nodes, "simhash-nodes")
        links = materialize(fingerprint_links(nodes, radius, nodes.count(), tables, total), "simhash-links")
        comps = connected_components(links)
        if min_jaccard > 0:
            members = nodes.select("node", "n", "h").join(comps, "node")
            comps = connected_components(verified_links(docs, text, materialize(members, "simhash-members"), min_jaccard))
        rooted = nodes.select("node", "low").join(comps, "node", "left").withColumn("root", F.coalesce("component", "node"))
        rooted = materialize(rooted.select("node", "root", "low"), "simhash-roots")
        lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
        labels = keep(materialize(rooted.select("node", "root").join(lows, "root").select("node", "component_id"), "simhash-labels"))
    return rows.join(labels, "node").select(
        F.col("k").alias(key), F.lpad(F.lower(F.hex("fp0")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, radius: int = 3, seed: int = 42, tables: int = 1, total: int = 0, min_jaccard: float = 0.0,
) -> DataFrame:
    """docs with all its columns and one row of each component: that with the smallest key (null last).

    Rows are told apart by key and text, so a key used for two texts is two documents, and of fully
    repeated rows one stays.
    """
    tag = F.struct(F.coalesce(F.col(key).cast("bigint"), F.lit((1 << 63) - 1)).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"))
    with scratch(docs.sparkSession) as keep:
        found = near_duplicates(docs.select(tag.alias("k"), F.col(text).alias("t")), "k", "t", size, radius, seed, tables, total, min_jaccard)
        per_key = found.groupBy("k").agg(F.count("*").alias("n"), F.first("component_id").alias("c"))
        odd = keep(materialize(per_key.select("k", (F.col("k") == F.col("c")).alias("first"), "n").where("not first or n > 1"), "simhash-odd"))
    few = F.broadcast if odd.count() <= MAX_BROADCAST_KEYS else lambda df: df
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), tag.alias("k"))
    alone = rows.join(few(odd.select("k")), "k", "left_anti")
    repeated = rows.join(few(odd.where("first").select("k")), "k", "left_semi").dropDuplicates(["k"])
    return alone.unionByName(repeated).select("row.*")
