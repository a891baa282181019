"""Benchmark decontamination: short test items inside long documents.

An item is contained if at least `threshold` of its distinct word shingles occur in the document. Items
are partitioned by size, and each keeps the MinHash sketch (the k smallest shingle hashes) whose length
its partition's largest size calls for: an item of n shingles can miss at most n - ceil(t n) of them, so
of its n - ceil(t n) + 1 smallest one must occur in any document that contains it. Probing documents for
sketches alone therefore loses no pair, whatever the document's length. Documents too short for a
partition skip it. Every candidate is verified by exact shingle containment.

Items of up to BLOCK_BYTES are broadcast as an index, and documents are searched where they are read. More
items are matched by a shuffle of sketch hashes: a bitmap of fixed size spares the documents' shingles
that can't be in any sketch, and only candidate texts are gathered for the exact check.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyseq.llm.words import words
from tallyseq.session import materialize

#: UTF-8 bytes of item texts that the broadcast index may hold; more items are matched by shuffle.
BLOCK_BYTES = 16 << 20
#: Bits of the bitmap of sketch hashes: 8 MB.
BITMAP = 1 << 26


def shingles(w: list[bytes], size: int) -> Iterator[tuple]:
    return zip(*[w[i:] for i in range(size)])


def sketch(text: str | None, size: int, threshold: float) -> tuple | None:
    """(width, size partition, shingles, how many of them must occur, sketch) of an item; None without words."""
    import xxhash

    w = words(text)
    if not w:
        return None
    width = min(size, len(w))
    own = frozenset(shingles(w, width))
    need = math.ceil(threshold * len(own) - 1e-9)
    part = (len(own) - 1).bit_length()
    largest = 1 << part
    k = min(len(own), largest - math.ceil(threshold * largest - 1e-9) + 1)
    return width, part, own, need, sorted(own, key=lambda s: (xxhash.xxh64_intdigest(b" ".join(s), 42), s))[:k]


class ItemIndex:
    """Items by shingle width, then by size partition."""

    def __init__(self, items: list[tuple], size: int, threshold: float):
        self.items, self.parts = [], {}
        for item_id, text in items:
            if not (found := sketch(text, size, threshold)):
                continue
            width, part, own, need, probes = found
            at = self.parts.setdefault(width, {}).setdefault(part, {"least": need, "probe": {}})
            at["least"] = min(at["least"], need)
            for s in probes:
                at["probe"].setdefault(s, []).append(len(self.items))
            self.items.append((item_id, own, need))

    def search(self, text: str | None) -> list[tuple]:
        """(item, shingles of the item, of them in the text), in the order of the items."""
        w, found = words(text), []
        for width, parts in self.parts.items():
            n = len(w) - width + 1
            live = [p["probe"] for p in parts.values() if p["least"] <= n]
            if not live or all(p.keys().isdisjoint(shingles(w, width)) for p in live):
                continue
            own = set(shingles(w, width))
            for i in {i for p in live for s in p.keys() & own for i in p[s]}:
                item_id, item, need = self.items[i]
                common = len(item & own)
                if common >= need:
                    found.append((i, item_id, len(item), common))
        return [x[1:] for x in sorted(found)]


def _index(items: DataFrame, item_key: str, item_text: str, size: int, threshold: float) -> Broadcast | None:
    """The broadcast index of all items, or None if they are too many."""
    rows = items.select(F.col(item_key).alias("i"), F.col(item_text).alias("t"))
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    if total > BLOCK_BYTES:
        return None
    return items.sparkSession.sparkContext.broadcast(ItemIndex([tuple(r) for r in rows.orderBy("i", "t").collect()], size, threshold))


def _hashes(found) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(b" ".join(s), 42) for s in found], np.uint64).view(np.int64)


def _shuffled_leaks(docs: DataFrame, items: DataFrame, key: str, text: str, item_key: str, item_text: str, size: int, threshold: float) -> DataFrame:
    """(k, h, i, n_shingles, n_found) of all leaking pairs, where h is a hash of the document's text; a pair
    of repeated rows occurs once for each row of the items and once for each different (k, h)."""
    import pyarrow as pa

    rows = materialize(items.select(F.monotonically_increasing_id().alias("no"), F.col(item_key).alias("i"), F.col(item_text).alias("t")), "leak-items")

    def sketches(it):
        for b in it:
            out = [(no, width, h) for no, t in zip(b.column(0).to_pylist(), b.column(1)) if (found := sketch(t.as_py(), size, threshold))
                   for width, h in zip([found[0]] * len(found[4]), _hashes(found[4]).tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 3)], ["no", "width", "s"])

    probes = materialize(rows.select("no", "t").mapInArrow(sketches, "no long, width long, s long"), "leak-sketches")
    widths = sorted(r[0] for r in probes.select("width").distinct().collect())  # `size` rows at most
    bit = F.pmod(F.col("s"), F.lit(BITMAP)) + 1  # the bitmap functions count from one
    marked = probes.groupBy(F.bitmap_bucket_number(bit).alias("no")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    bits = np.zeros(BITMAP // 8 + 8192, np.uint8)
    for no, part in marked.collect():  # one bit for each of BITMAP places
        bits[(no - 1) * 4096: no * 4096] = np.frombuffer(part, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    own = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("h"), F.col(text).alias("t"))

    def hits(it):
        for b in it:
            at, width, found = [], [], []
            for row, t in enumerate(b.column(2)):
                w = words(t.as_py())
                for n in widths:
                    if len(w) >= n:
                        s = _hashes(set(shingles(w, n)))
                        place = np.mod(s, BITMAP)
                        s = s[(shared.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0]
                        at.append(np.full(len(s), row))
                        width.append(np.full(len(s), n))
                        found.append(s)
            if at:
                at = pa.array(np.concatenate(at))
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(np.concatenate(width)), pa.array(np.concatenate(found))], ["k", "h", "width", "s"])

    kind, item_kind = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    met = own.mapInArrow(hits, f"k {kind}, h long, width long, s long").join(probes, ["width", "s"]).select("k", "h", "no").distinct()
    met = materialize(met, "leak-candidates")
    wide = own.alias("d").join(met.alias("m"), F.col("d.k").eqNullSafe(F.col("m.k")) & (F.col("d.h") == F.col("m.h"))).select("d.k", "d.h", "d.t", "m.no")
    wide = wide.dropDuplicates(["k", "h", "no"]).join(rows.select("no", "i", F.col("t").alias("item")), "no")

    def check(it):
        for b in it:
            keep, n, common = [], [], []
            for row, (t, item) in enumerate(zip(b.column(2), b.column(4))):
                width, _, wanted, need, _ = sketch(item.as_py(), size, threshold)
                shared_n = len(wanted & set(shingles(words(t.as_py()), width)))
                if shared_n >= need:
                    keep.append(row), n.append(len(wanted)), common.append(shared_n)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), b.column(3).take(at), pa.array(n, pa.int64()), pa.array(common, pa.int64())], ["k", "h", "i", "n_shingles", "n_found"])

    return wide.select("k", "h", "t", "i", "item").mapInArrow(check, f"k {kind}, h long, i {item_kind}, n_shingles long, n_found long")


def find_leaks(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    size: int = 5, threshold: float = 0.8,
) -> DataFrame:
    """(key, item_key, n_shingles, n_found, containment) of all pairs at or above the threshold.

    Words are runs without ASCII white space, A-Z in lower case. Items with fewer words than `size` are
    one shingle of all their words; items without words match nothing, nor do null texts. Repeated rows
    of either side give repeated pairs; null keys stay null. Empty tables give no pairs; other columns
    are not read. An item key named like the document key gets the suffix `_item`. With few items there
    is one pass over the documents and no shuffle.
    """
    import pyarrow as pa

    names = [key, item_key + "_item" * (item_key == key), "n_shingles", "n_found", "containment"]
    index = _index(items, item_key, item_text, size, threshold)
    if index is None:
        found = materialize(_shuffled_leaks(docs, items, key, text, item_key, item_text, size, threshold), "leaks")
        rows = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("h")).alias("d")
        pairs = rows.join(found.alias("f"), F.col("d.k").eqNullSafe(F.col("f.k")) & (F.col("d.h") == F.col("f.h")))
        return pairs.select("d.k", "f.i", "n_shingles", "n_found", F.col("n_found") / F.col("n_shingles")).toDF(*names)
    kinds = [docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString(), "long", "long", "double"]
    item_type = to_arrow_type(items.schema[item_key].dataType)

    def search(it):
        for b in it:
            hits = [(row, *hit) for row, t in enumerate(b.column(1)) for hit in index.value.search(t.as_py())]
            if hits:
                at, item, n, common = zip(*hits)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at)), pa.array(item, item_type), pa.array(n, pa.int64()), pa.array(common, pa.int64()), pa.array([c / m for c, m in zip(common, n)])], names)

    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(search, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))


def drop_leaking(
    docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", size: int = 5, threshold: float = 0.8,
) -> DataFrame:
    """The rows of docs, with all their columns, that contain no item; rules as in find_leaks."""
    import pyarrow as pa

    index = _index(items, item_key, item_text, size, threshold)
    if index is None:
        h = F.md5(text)  # 128 bits name a text
        found = _shuffled_leaks(docs.withColumn("__leak_hash", h), items, "__leak_hash", text, item_key, item_text, size, threshold)
        bad = materialize(found.select(F.col("k").alias("__leak_hash")).distinct(), "leaking")
        return docs.withColumn("__leak_hash", h).join(bad, "__leak_hash", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    at = docs.columns.index(text)

    def keep(it):
        for b in it:
            yield b.filter(pa.array([not index.value.search(t.as_py()) for t in b.column(at)], pa.bool_()))

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names with dots are no names to mapInArrow
    return plain.mapInArrow(keep, plain.schema).toDF(*docs.columns)
