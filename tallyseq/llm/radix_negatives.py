"""Hard-negative mining by distributed radix selection.

A window belongs to an anchor: it is a range of scores, over rows of the anchor's label (for positives) or
of other labels (for negatives), of which the first k by score, then by key, are wanted. No window is ever
gathered to find them. Every pass multiplies blocks of rows with a block of anchors and counts, for each
window, how many rows fall into each bucket of the current digit. The bucket that holds the kth row becomes
the range of the next digit; buckets above it are known to qualify whole. Where scores end and more rows tie
than are wanted, the digits of the key follow. Then one pass gathers the rows that qualify, k of a window.

A task sends a window's buckets only until they hold the k rows wanted, which is exact, as lower ones can't
matter then. Anchors are a stated query set and are taken in blocks of ANCHORS rows at most, each broadcast
by itself; the table is never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.session import shared_path

#: Anchors, and bytes of their vectors, in a block that is broadcast.
ANCHORS, ANCHOR_BYTES = 1 << 14, 32 << 20
#: Bits of a digit.
DIGIT = 12
#: Anchors and rows that are multiplied at once.
TILE = (512, 2048)
#: Hits that a task collects before it counts them.
SETTLE = 1 << 16
#: Scores are held to this range, so that differences of two fit 64 bits.
MOST = 1 << 61


def quantised(x: np.ndarray) -> np.ndarray:
    """floor(256 x) as doubles, which hold it exactly, or as Python integers where a double can't hold 256 x."""
    with np.errstate(over="ignore"):
        q = np.floor(256.0 * x)
    return q if np.isfinite(q).all() else np.array([[int(v) * 256 if abs(v) > 1e300 else int(np.floor(256.0 * v)) for v in row] for row in x], object)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of a and b, held to +-MOST: by doubles where every sum is exact."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    if a.dtype != object and b.dtype != object and a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) < 2**53:
        return (a @ b.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    return np.clip(exact(a) @ exact(b).T, -MOST, MOST).astype(np.int64)


@dataclass
class Keys:
    """What rows of a window are ordered by: hi - score, then the key in one part or two of less than 62 bits."""

    low: int
    high: int

    @property
    def spans(self) -> list[int]:
        if self.high - self.low < 1 << 62:
            return [self.high - self.low]
        return [(self.high >> 32) - (self.low >> 32), (1 << 32) - 1]

    def of(self, u: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
        return [u, ids - self.low] if len(self.spans) == 1 else [u, (ids >> 32) - (self.low >> 32), ids & 0xFFFFFFFF]


@dataclass
class Windows:
    """Windows of a block of anchors and how far their selection is: at `level`, rows from base to base + top
    are still to be told apart, and `need` of them are wanted; ties[j] is the value settled at level j."""

    anchors: int
    anchor: np.ndarray
    high: np.ndarray
    span: np.ndarray
    k: int
    same: bool
    keys: Keys
    digit: int

    def __post_init__(self):
        n = len(self.anchor)
        self.level, self.base, self.top = np.zeros(n, np.int64), np.zeros(n, np.int64), self.span.copy()
        self.need, self.open = np.full(n, self.k), np.ones(n, bool)
        self.ties = np.zeros((len(self.keys.spans) + 1, n), np.int64)
        # positions of each anchor's windows, padded by -1
        self.by_anchor = np.full((self.anchors, int(np.bincount(self.anchor, minlength=1).max())), -1)
        order = np.argsort(self.anchor, kind="stable")
        own = self.anchor[order]
        self.by_anchor[own, np.arange(n) - np.searchsorted(own, own)] = order

    @property
    def shift(self) -> np.ndarray:
        return np.maximum(0, bit_lengths(self.top) - self.digit)

    def place(self, w: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
        """The offset of rows in the range that their windows tell apart; -1 outside of it."""
        x = np.full(len(w), -1)
        for level in range(len(keys)):
            at = self.level[w] == level
            for j in range(level):
                at &= keys[j] == self.ties[j, w]
            x = np.where(at, keys[level] - self.base[w], x)
        return np.where((x >= 0) & (x <= self.top[w]) & self.open[w], x, -1)

    def chosen(self, w: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
        """Whether rows qualify: before the range that was told apart, or in it."""
        done, equal = np.zeros(len(w), bool), (keys[0] >= 0) & (keys[0] <= self.span[w])
        for level, key in enumerate(keys):
            here = self.level[w] == level
            end = np.where(here, self.base[w] + self.top[w] + 1, self.ties[level, w])
            done |= equal & (key < end) & (self.level[w] >= level)
            equal = equal & (key == end) & ~here
        return done

    def scores(self) -> tuple[np.ndarray, np.ndarray]:
        """The lowest and highest score that open windows still look at."""
        first = np.where(self.level == 0, self.base, self.ties[0])
        return self.high - np.where(self.level == 0, self.base + self.top, first), self.high - first

    def refine(self, w: np.ndarray, bucket: np.ndarray, before: np.ndarray, n: np.ndarray) -> None:
        """Go on with the bucket that holds the last wanted row; it is -1 where there are too few rows."""
        go = bucket >= 0
        seen = np.zeros(len(self.anchor), bool)
        seen[w[go]] = True
        self.open &= seen  # the others hold fewer rows than are wanted, so that all of them qualify
        w, bucket, before, n = w[go], bucket[go], before[go], n[go]
        shift = self.shift[w]
        self.base[w] += bucket << shift
        self.top[w] = np.minimum(self.top[w] - (bucket << shift), (np.int64(1) << shift) - 1)
        self.need[w] -= before
        whole = n == self.need[w]
        self.open[w[whole]] = False
        w = w[~whole & (shift == 0)]  # one value is left, and more rows have it than are wanted
        last = self.level[w] == len(self.keys.spans)
        self.open[w[last]] = False  # rows that repeat a key: any of them
        w = w[~last]
        self.ties[self.level[w], w] = self.base[w]
        self.base[w], self.top[w] = 0, np.array(self.keys.spans, np.int64)[self.level[w]]
        self.level[w] += 1


def bit_lengths(x: np.ndarray) -> np.ndarray:
    """Bits of each non-negative number."""
    return np.array([int(v).bit_length() for v in np.unique(x)], np.int64)[np.unique(x, return_inverse=True)[1]] if len(x) else np.zeros(0, np.int64)


def ranges(n: int, step: int) -> Iterator[slice]:
    return (slice(i, min(i + step, n)) for i in range(0, n, step))


class Block:
    """Anchors of a block: (id, label, vector) each, grouped by dimension."""

    def __init__(self, rows: list[tuple]):
        self.ids, self.labels = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
        self.grids: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        sizes = np.array([len(r[2]) for r in rows])
        for d in np.unique(sizes):
            at = np.flatnonzero(sizes == d)
            self.grids[int(d)] = at, quantised(np.array([rows[i][2] for i in at], float).reshape(len(at), int(d)))

    def near(self, batch, win: Windows, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(window, score, id) of a batch's rows between low and high, by tiles; both may rise between tiles."""
        ids, labels, lists = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
        ends = np.cumsum(lists.value_lengths().to_numpy())
        flat, sizes = lists.flatten().to_numpy(zero_copy_only=False).astype(float), np.diff(ends, prepend=0)
        for d in np.unique(sizes):
            if int(d) not in self.grids:
                continue
            anchors, grid = self.grids[int(d)]
            rows = np.flatnonzero(sizes == d)
            x = quantised(flat[(ends[rows] - d)[:, None] + np.arange(d)] if len(rows) < len(ids) else flat.reshape(len(ids), int(d)))
            for part in ranges(len(rows), TILE[1]):
                r = rows[part]
                for own in ranges(len(anchors), TILE[0]):
                    live = (win.by_anchor[anchors[own]] >= 0) & (low <= high)[win.by_anchor[anchors[own]]]
                    use = own.start + np.flatnonzero(live.any(axis=1))
                    a = anchors[use]
                    mine = np.where(live, win.by_anchor[anchors[own]], -1)[use - own.start]
                    least = np.where(mine >= 0, low[mine], MOST * 2).min(axis=1, initial=MOST * 2)
                    most = np.where(mine >= 0, high[mine], -MOST * 2).max(axis=1, initial=-MOST * 2)
                    s = products(grid[use], x[part])
                    ok = (s >= least[:, None]) & (s <= most[:, None])
                    ok &= (labels[r][None] == self.labels[a][:, None]) if win.same else (labels[r][None] != self.labels[a][:, None])
                    ok &= ids[r][None] != self.ids[a][:, None]
                    i, j = np.nonzero(ok)
                    score = s[i, j]
                    for no in range(mine.shape[1]):
                        w = mine[i, no]
                        hit = np.flatnonzero(w >= 0)
                        hit = hit[(score[hit] >= low[w[hit]]) & (score[hit] <= high[w[hit]])]
                        if len(hit):
                            yield w[hit], score[hit], ids[r[j[hit]]]


def first_of_each(w: np.ndarray, n: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Of entries sorted by window and order, those before which their window's counts fall short of `need`."""
    total = np.cumsum(n)
    start = np.flatnonzero(np.diff(w, prepend=-1))
    before = total - n - np.repeat((total - n)[start], np.diff(np.append(start, len(w))))
    return before < need[w]


def histogram(rows: DataFrame, block, state) -> DataFrame:
    """(w, bucket, before, n): of each window that has rows, the bucket of the last wanted one, the rows in
    buckets before it and in it; nulls if there are fewer rows than wanted."""
    import pyarrow as pa

    def count(it):
        win: Windows = state.value
        shift = win.shift
        low, high = win.scores()
        low[~win.open] = MOST * 2
        found, waiting = [np.zeros(0, np.int64)] * 3, []  # window, bucket, rows: no longer than what is needed

        def settle() -> None:
            w, b, n = (np.concatenate(c) for c in zip(found, *waiting))
            order = np.lexsort((b, w))
            w, b, n = w[order], b[order], n[order]
            start = np.flatnonzero((np.diff(w, prepend=-1) != 0) | (np.diff(b, prepend=-1) != 0))
            w, b, n = w[start], b[start], np.add.reduceat(n, start)
            keep = first_of_each(w, n, win.need)
            w, b, n = found[:] = w[keep], b[keep], n[keep]
            waiting.clear()
            held = np.add.reduceat(n, np.flatnonzero(np.diff(w, prepend=-1)))
            last = np.flatnonzero(np.diff(w, append=-1))
            last = last[(held >= win.need[w[last]]) & (win.level[w[last]] == 0)]
            own = w[last]  # lower scores can't matter to these any more
            low[own] = np.maximum(low[own], win.high[own] - win.base[own] - ((b[last] + 1) << shift[own]) + 1)

        for batch in it:
            for w, score, ids in block.value.near(batch, win, low, high):
                x = win.place(w, win.keys.of(win.high[w] - score, ids))
                w, x = w[x >= 0], x[x >= 0]
                if len(w):
                    waiting.append((w, x >> shift[w], np.ones(len(w), np.int64)))
                if sum(len(c[0]) for c in waiting) > max(SETTLE, len(found[0])):
                    settle()
        if waiting:
            settle()
        w, b, n = found
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (w, b, n, win.need[w])], ["w", "b", "n", "need"])

    counts = rows.select("id", "label", "v").mapInArrow(count, "w long, b long, n long, need long").groupBy("w", "b", "need").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("w").orderBy("b"))
    at = F.min(F.when(F.col("upto") >= F.col("need"), F.struct("b", (F.col("upto") - F.col("n")).alias("before"), "n"))).alias("at")
    return counts.withColumn("upto", upto).groupBy("w").agg(at).select("w", "at.b", "at.before", "at.n")


def select(rows: DataFrame, block, win: Windows) -> DataFrame:
    """(a, hi, anchor_id, id, score, no): the first k rows of every window, numbered; a and hi name the window.

    A window's selection state is a few numbers, so those of a block go to the driver and back each digit.
    """
    import pyarrow as pa

    context = rows.sparkSession.sparkContext
    while win.open.any():
        state = context.broadcast(win)
        got = histogram(rows, block, state).collect()
        state.unpersist()
        win.refine(*np.array([[-1 if x is None else x for x in r] for r in got], np.int64).reshape(len(got), 4).T)
    state = context.broadcast(win)

    def gather(it):
        win: Windows = state.value
        low, high = win.high - win.span, win.high.copy()
        cut = win.level == 0
        low[cut] = np.maximum(low, win.high - win.base - win.top)[cut]
        low[~cut] = (win.high - win.ties[0])[~cut]
        found = [np.zeros(0, np.int64)] * 3
        for batch in it:
            for w, score, ids in block.value.near(batch, win, low, high):
                ok = win.chosen(w, win.keys.of(win.high[w] - score, ids))
                w, score, ids = (np.concatenate([x, y[ok]]) for x, y in zip(found, (w, score, ids)))
                order = np.lexsort((ids, -score, w))
                w, score, ids = w[order], score[order], ids[order]
                keep = first_of_each(w, np.ones(len(w), np.int64), np.full(len(win.anchor), win.k))
                found = [w[keep], score[keep], ids[keep]]
        w, score, ids = found
        a = win.anchor[w]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (a, win.high[w], block.value.ids[a], ids, score)], ["a", "hi", "anchor_id", "id", "score"])

    got = rows.select("id", "label", "v").mapInArrow(gather, "a long, hi long, anchor_id long, id long, score long")
    no = F.row_number().over(Window.partitionBy("a", "hi").orderBy(F.desc("score"), "id"))
    return got.withColumn("no", no).where(F.col("no") <= win.k)


def usable(vectors: DataFrame, key: str, vec: str, label: str, anchor: Column) -> DataFrame:
    """(id, label, v, anchor) of rows with a key, a label and a vector of finite components."""
    kind = vectors.schema[vec].dataType.simpleString()
    v = F.col(vec) if kind in ("array<float>", "array<double>") else F.col(vec).cast("array<double>")
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), v.alias("v"), anchor.alias("anchor"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)


def mine_negatives(
    vectors: DataFrame, anchor: Column, key: str = "vec_id", vec: str = "embedding", label: str = "label",
    positives: int = 5, negatives: int = 5, near: tuple[int, int] = (4, 5),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and positive.

    A component x counts as floor(256 x), a score is the integer inner product with the anchor; higher ones
    come first, ties by smaller key. An anchor's positives are its first rows of the same label, negatives
    of a positive are the first rows of other labels with a score of at most the positive's and at least
    `near` of it (as a fraction); where fewer qualify, all of them. Rows with a null key or label, a null
    vector, or a component null or non-finite take no part. Vectors of another length than the anchor's
    have no score; empty vectors score 0 with each other. Rows with the anchor's own key are never its
    partners. Anchors that repeat key, label and vector are mined once; other repeated rows are rows of their
    own. Scores beyond +-2^61 count as that. Empty tables give an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vec, label, anchor)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + F.pow(F.floor(x.cast("double") * 256).cast("double"), 2)))
    low, high, longest, size, n = rows.agg(F.min("id"), F.max("id"), F.max(length), F.max(F.size("v")), F.count_if(F.col("anchor"))).first()
    kind = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    path, empty = shared_path(spark, "negatives"), spark.createDataFrame([], kind)
    if not n:
        return empty
    empty.write.parquet(path)
    asked = rows.where("anchor").select("id", "label", "v").distinct()
    blocks = -(-n // max(1, min(ANCHORS, ANCHOR_BYTES // (8 * max(1, size)))))
    keys = Keys(low, high)
    for no in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("id", "label", "v"), F.lit(blocks)) == no).collect()  # ANCHORS of them, about
        own = sorted((r.id, r.label, tuple(r.v)) for r in own)
        if not own:
            continue
        block = spark.sparkContext.broadcast(Block(own))
        at = np.arange(len(own))
        bound = np.array([_bound(r[2], longest) for r in own], np.int64)
        found = select(rows, block, Windows(len(own), at, bound, 2 * bound, positives, True, keys, DIGIT))
        best_path = shared_path(spark, "positives")
        found.write.parquet(best_path)
        best = spark.read.schema(found.schema).parquet(best_path)
        pairs = best.where("score >= 0").select("a", "score").distinct().collect()  # `positives` an anchor at most
        if pairs:
            a, hi = np.array(sorted(map(tuple, pairs)), np.int64).T
            least = np.array([-(-int(s) * near[0] // near[1]) for s in hi], np.int64)
            hard = select(rows, block, Windows(len(own), a, hi, hi - least, negatives, False, keys, DIGIT))
            hard = hard.select("a", F.col("hi").alias("score"), F.col("no").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
            out = best.select("a", "score", "anchor_id", F.col("id").alias("positive_id")).join(hard, ["a", "score"])
            out.select("anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score").write.mode("append").parquet(path)
    return spark.read.schema(kind).parquet(path)


def _bound(vector: tuple, longest: float) -> int:
    """No score of the vector is beyond this, by its length and the longest one's."""
    own = float(np.sqrt(sum(np.floor(256.0 * x) ** 2 for x in vector if abs(x) < 1e150))) if all(abs(x) < 1e150 for x in vector) else float("inf")
    x = own * longest * (1 + 1e-9) + 1
    return int(x) if x < MOST else MOST

