"""Ranked lexical search with variable-size posting blocks and their score bounds.

Documents are read once into shards, each an inverted index of one row: documents numbered by length, and for
every term of the items the documents that hold it. Shards are written to the shared folder, and document
frequencies, counts and lengths are summed from them. Then every shard is searched where it is read. Dynamic
programming cuts each posting list into blocks of variable size, so that the sum over all postings of the
block's largest impact less the posting's own, plus a price for each block, is least. An item's rare terms, the
short lists, say which documents they add to; of its frequent terms, the largest impacts of the blocks that
overlap a document bound what they can add. Documents are scored in the order of their bounds, from the
blocks that hold them, until no bound reaches the item's kth score so far; all other blocks are skipped. No
document with a bound that could reach the result is left out, so results are exact.

The kth scores of a few shards, searched first, start the search of all others. A task sends an item's k
best over all its shards. Items are a stated query set and are taken in blocks of ITEM_BYTES, whose terms
alone are indexed and broadcast.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from tallyseq.session import materialize, scratch

#: UTF-8 bytes of items in a block, and of documents in a shard, about.
ITEM_BYTES, SHARD_BYTES = 8 << 20, 16 << 20
#: Shards whose results start the search of the others.
FIRST = 16
#: A list's places where a block may end, at most; shorter lists may be cut anywhere.
CELLS = 128
#: What a block costs, in postings of mean impact.
PRICE = 16
#: Lists that hold fewer than one in so many of a shard's documents are read whole, not by blocks.
SPARSE = 8
#: ASCII letters and digits in lower case and all bytes beyond ASCII belong to terms.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8, with repeats; null gives none."""
    return text.translate(FOLD).split() if text else []


def norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """100 - 50 + ((50 n N) div L) of document lengths n."""
    if len(lengths) and int(lengths.max()) * 50 * n_docs >= 1 << 63:
        return np.array([50 + 50 * int(n) * n_docs // n_terms for n in lengths], np.int64)
    return 50 + 50 * lengths.astype(np.int64) * n_docs // max(1, n_terms)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def choose_blocks(impact: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first posting of each block, first block of each list, with ends) for lists that begin at `start`.

    A list of up to CELLS postings may be cut anywhere, a longer one after every so many postings. All lists
    of about the same number of cells are cut at once.
    """
    sizes = np.diff(start)
    step = -(-sizes // CELLS)
    cells = -(-sizes // step)
    cell_start = spread(np.zeros_like(cells), cells) * np.repeat(step, cells) + np.repeat(start[:-1], cells)
    cell_top = np.maximum.reduceat(impact, cell_start) if len(cell_start) else impact
    cell_size = np.diff(cell_start, append=start[-1])
    first_cell = np.concatenate([[0], np.cumsum(cells)])
    price = PRICE * np.add.reduceat(impact, start[:-1]) / np.maximum(1, sizes) if len(sizes) else sizes
    cut = np.zeros(len(cell_start), bool)
    for bits in np.unique(np.frexp(cells)[1]):
        own = np.flatnonzero(np.frexp(cells)[1] == bits)
        width = int(cells[own].max())
        at = first_cell[own][:, None] + np.arange(width)
        real = np.arange(width) < cells[own][:, None]
        at = np.where(real, at, 0)
        top, size = np.where(real, cell_top[at], 0).T.astype(float), np.where(real, cell_size[at], 0).T
        best, back = np.zeros((width + 1, len(own))), np.zeros((width + 1, len(own)), np.int64)
        for j in range(1, width + 1):
            high, n, least = np.zeros(len(own)), np.zeros(len(own)), np.full(len(own), np.inf)
            for i in range(j - 1, -1, -1):
                high, n = np.maximum(high, top[i]), n + size[i]
                cost = best[i] + high * n + price[own]
                better = cost < least
                least, back[j] = np.where(better, cost, least), np.where(better, i, back[j])
            best[j] = least
        at = cells[own]
        todo = np.arange(len(own))
        while len(todo):
            at[todo] = back[at[todo], todo]
            cut[first_cell[own[todo]] + at[todo]] = True
            todo = todo[at[todo] > 0]
    blocks = np.flatnonzero(cut)
    return cell_start[blocks], np.searchsorted(blocks, first_cell)


class Shard:
    """One row of the index, ready to be searched."""

    def __init__(self, lengths: np.ndarray, term: np.ndarray, sizes: np.ndarray, post: np.ndarray, tf: np.ndarray, n_docs: int, n_terms: int):
        self.n, self.post = len(lengths), post
        self.at = {int(t): i for i, t in enumerate(term)}
        tf = tf.astype(np.int64)
        self.impact = 1_000_000_000 * tf // (1000 * tf + 20 * norms(lengths, n_docs, n_terms)[post])
        start = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        self.start, self.sizes = start, sizes.astype(np.int64)
        self.first, self.block = choose_blocks(self.impact, start)
        self.size = np.diff(self.first, append=len(post))
        self.top = np.maximum.reduceat(self.impact, self.first) if len(post) else self.impact
        self.low, self.high = post[self.first].astype(np.int64), post[self.first + self.size - 1].astype(np.int64)

    def search(self, item: np.ndarray, weight: np.ndarray, k: int, least: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the k best of an item with scores above 0 and at least `least`; ties by `order`."""
        none = np.zeros(0, np.int64)
        lists = [(self.at[t], w) for t, w in zip(item.tolist(), weight.tolist()) if t in self.at and w > 0]
        if not lists:
            return none, none
        no, w = np.array(lists, np.int64).T
        rare = self.sizes[no] * SPARSE < self.n  # a block of these spans many documents that it doesn't hold
        at = spread(self.start[no[rare]], self.sizes[no[rare]])
        base = np.zeros(self.n, np.int64)
        np.add.at(base, self.post[at], self.impact[at] * np.repeat(w[rare], self.sizes[no[rare]]))
        no, w = no[~rare], w[~rare]
        many = self.block[no + 1] - self.block[no]
        blocks, w = spread(self.block[no], many), np.repeat(w, many)
        low, high, top = self.low[blocks], self.high[blocks], self.top[blocks] * w
        edge = np.zeros(self.n + 1, np.int64)
        np.add.at(edge, low, top)
        np.add.at(edge, high + 1, -top)
        bound = base + np.cumsum(edge[:-1])
        docs = np.flatnonzero(bound >= max(1, least))
        docs = docs[np.argsort(-bound[docs], kind="stable")]
        found, scores, done, step = none, none, 0, 4 * k
        while done < len(docs) and bound[docs[done]] >= least:
            part = docs[done: done + step]
            wanted = np.zeros(self.n, bool)
            wanted[part] = True
            held = np.concatenate([[0], np.cumsum(wanted)])
            use = held[high + 1] > held[low]  # the others hold none of these documents
            at = spread(self.first[blocks[use]], self.size[blocks[use]])
            got = base.copy()
            np.add.at(got, self.post[at], self.impact[at] * np.repeat(w[use], self.size[blocks[use]]))
            part = part[got[part] >= max(1, least)]
            found, scores = np.concatenate([found, part]), np.concatenate([scores, got[part]])
            best = np.lexsort((order[found], -scores))[:k]
            found, scores = found[best], scores[best]
            if len(found) == k:
                least = max(least, int(scores[-1]))
            done, step = done + step, step * 4
        return found, scores


def _batch(columns: dict):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) if isinstance(v, int) else pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in columns.values()], list(columns))


def build_index(docs: DataFrame, key: str, text: str, vocabulary) -> DataFrame:
    """One row a shard: n_docs and n_terms over all documents with terms, and of those that hold any term of
    the broadcast vocabulary (term to number): keys, lengths, and by term the documents and their counts."""
    import pyarrow as pa

    kind = docs.schema[key].dataType
    arrow_kind = to_arrow_type(kind)

    def pack(keys: list, lengths: list, sizes: list, ids: list, tfs: list, n_docs: int, n_terms: int):
        lengths, doc = np.array(lengths, np.int32), np.repeat(np.arange(len(keys)), np.array(sizes, np.int64))
        order = np.argsort(lengths, kind="stable")
        no = np.empty(len(keys), np.int64)
        no[order] = np.arange(len(keys))
        ids, tfs, doc = np.array(ids, np.int64), np.array(tfs, np.int32), no[doc]
        by = np.argsort(ids * max(1, len(keys)) + doc, kind="stable")
        term, size = np.unique(ids, return_counts=True)
        whole = lambda x: pa.array(np.asarray(x, np.int32))
        return _batch({"n_docs": n_docs, "n_terms": n_terms, "docs": pa.array([keys[i] for i in order], arrow_kind), "lengths": whole(lengths[order]), "terms": whole(term), "sizes": whole(size), "post": whole(doc[by]), "tf": whole(tfs[by])})

    def index(it) -> Iterator:
        number = vocabulary.value.get
        own, n_docs, n_terms, size = ([], [], [], [], []), 0, 0, 0
        for b in it:
            for k, x in zip(b.column(0), b.column(1)):
                raw = x.as_py()
                found = terms(raw)
                if not found:
                    continue
                n_docs, n_terms, size = n_docs + 1, n_terms + len(found), size + len(raw)
                count = Counter(map(number, found))
                count.pop(None, None)
                if count:
                    keys, lengths, sizes, ids, tfs = own
                    keys.append(k.as_py()), lengths.append(len(found)), sizes.append(len(count)), ids.extend(count), tfs.extend(count.values())
                if size >= SHARD_BYTES:
                    yield pack(*own, n_docs, n_terms)
                    own, n_docs, n_terms, size = ([], [], [], [], []), 0, 0, 0
        if n_docs:
            yield pack(*own, n_docs, n_terms)

    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("binary").alias("t"))
    return rows.mapInArrow(index, f"n_docs long, n_terms long, docs array<{kind.simpleString()}>, lengths array<int>, terms array<int>, sizes array<int>, post array<int>, tf array<int>")


def search_index(index: DataFrame, queries, least, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, k, score): of every item, the k best of each task; queries: broadcast list of (terms, weights),
    least: broadcast array of scores below which nothing matters."""
    import pyarrow as pa

    kind = index.schema["docs"].dataType.elementType
    arrow_kind = to_arrow_type(kind)
    ordered = lambda x: (-x[1], x[0] is None, x[0] if x[0] is not None else 0)

    def search(it):
        items, floor = queries.value, least.value.copy()
        best: list[list] = [[] for _ in items]
        for b in it:
            for row in range(b.num_rows):
                keys = b.column(0)[row].as_py()
                arrays = [b.column(i)[row].values.to_numpy() for i in range(1, 6)]
                if not keys:
                    continue
                shard = Shard(*arrays, n_docs, n_terms)
                order = np.empty(len(keys), np.int64)
                order[sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i] if keys[i] is not None else 0))] = np.arange(len(keys))
                for i, (item, weight) in enumerate(items):
                    docs, scores = shard.search(item, weight, k, int(floor[i]), order)
                    if len(docs):
                        best[i] = sorted(best[i] + [(keys[d], s) for d, s in zip(docs.tolist(), scores.tolist())], key=ordered)[:k]
                        if len(best[i]) == k:
                            floor[i] = max(floor[i], best[i][-1][1])
        found = [(i, *x) for i, own in enumerate(best) for x in own]
        no, key, score = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(no, pa.int64()), pa.array(key, arrow_kind), pa.array(score, pa.int64())], ["item", "k", "score"])

    return index.select("docs", "lengths", "terms", "sizes", "post", "tf").mapInArrow(search, f"item long, k {kind.simpleString()}, score long")


def _search_block(docs: DataFrame, items: list[tuple], key: str, text: str, k: int) -> DataFrame:
    """(no, k, score) of a block of items (no, text): k rows at least that hold each item's k best."""
    spark = docs.sparkSession
    own = [sorted(set(terms(t))) for _, t in items]
    number = {t: i for i, t in enumerate(sorted({t for x in own for t in x}))}
    index = materialize(build_index(docs, key, text, spark.sparkContext.broadcast(number)), "search-index")
    shards, n_docs, n_terms = index.agg(F.count("*"), F.sum("n_docs"), F.sum("n_terms")).first()
    held = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("x")).groupBy("x.terms").agg(F.sum("x.sizes"))
    weight = np.zeros(len(number), np.int64)
    for t, df in held.collect():  # a row for each term of the items at most
        weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    ids = [np.array([number[t] for t in x], np.int64) for x in own]
    queries = spark.sparkContext.broadcast([(x, weight[x]) for x in ids])
    least = np.zeros(len(items), np.int64)
    run = lambda part: search_index(part, queries, spark.sparkContext.broadcast(least.copy()), n_docs or 0, n_terms or 0, k)
    if shards > 4 * FIRST:
        space = 1 << 20
        draw = F.pmod(F.xxhash64("n_docs", "n_terms", F.element_at("lengths", -1), F.size("post")), F.lit(space)) < space * FIRST // shards
        first = materialize(run(index.where(draw)), "search-first")
        top = Window.partitionBy("item").orderBy(F.desc("score"))
        for i, score in first.withColumn("no", F.row_number().over(top)).where(F.col("no") == k).select("item", "score").collect():
            least[i] = score
        found = first.unionByName(run(index.where(~draw)))
    else:
        found = run(index)
    names = spark.createDataFrame([(i, no) for i, (no, _) in enumerate(items)], "item long, no long")
    return found.join(F.broadcast(names), "item").select("no", "k", "score")


def rank_documents(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", k: int = 50) -> DataFrame:
    """(item_key, rank, key, score): the k highest-scoring documents of each item with a score above 0.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z in lower case; texts are
    taken whole. A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))) over the N documents with terms; a
    document's score sums weight * ((10^9 tf) div (1000 tf + 20 m)) over the item's different terms, where m is
    50 + (50 n N) div L. Equal scores come by ascending key, null keys last. Null and empty texts have no
    terms and are in no result; items without terms have none. Repeated documents are ranked one by one,
    repeated items have results each. Empty tables give an empty result; other columns are not read. An item
    key named like the document key gets the suffix `_item`. Bytes that aren't UTF-8 are term characters.
    """
    spark = docs.sparkSession
    names = [item_key + "_item" * (item_key == key), "rank", key, "score"]
    with scratch(spark) as keep:
        rows = keep(materialize(items.select(F.monotonically_increasing_id().alias("no"), F.col(item_key).alias("i"), F.col(item_text).cast("binary").alias("t")), "search-items"))
        blocks = -(-(rows.agg(F.sum(F.octet_length("t"))).first()[0] or 1) // ITEM_BYTES)
        found = []
        for b in range(blocks):
            own = rows.where(F.pmod(F.xxhash64("no"), F.lit(blocks)) == b).select("no", "t").orderBy("no").collect()  # ITEM_BYTES, about
            if own:
                found.append(keep(materialize(_search_block(docs, [tuple(r) for r in own], key, text, k), "search-hits")))
    if not found:
        kind = docs.schema[key].dataType.simpleString()
        return rows.select(F.col("i"), F.lit(1).alias("r"), F.lit(None).cast(kind).alias("k"), F.lit(0).cast("long").alias("s")).where("false").toDF(*names)
    hits = found[0]
    for x in found[1:]:
        hits = hits.unionByName(x)
    place = F.row_number().over(Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("k")))
    best = hits.withColumn("rank", place).where(F.col("rank") <= k)
    return best.join(rows.select("no", "i"), "no").select("i", "rank", "k", "score").toDF(*names)
