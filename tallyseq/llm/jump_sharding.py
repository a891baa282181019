"""Jump consistent hashing: rows go to shards by key alone, without a ring table."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyseq.session import materialize

#: Fixed value: the multiplier of the 64-bit linear congruential generator in the published algorithm.
MULTIPLIER = 2862933555777941757


def jump_hash(key: Column, shards: int) -> Column:
    """Shard in [0, shards) of a bigint key (null: as key 0), as a SQL expression.

    The unsigned 64-bit product is formed from 32-bit halves, since ANSI bigint arithmetic would
    overflow. A key jumps about ln(shards) times; the loop has room for far more, and the expression
    raises rather than return an unfinished jump.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    m_hi, m_lo, low = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF, 0xFFFFFFFF
    rounds = shards if shards <= 64 else 64 + 8 * math.ceil(math.log(shards))

    def step(s: Column, _: Column) -> Column:
        hi, lo = s["hi"], s["lo"]
        top = F.shiftright(lo, 16) * m_lo
        tail = lo.bitwiseAND(0xFFFF) * m_lo + F.shiftleft(top.bitwiseAND(0xFFFF), 16) + 1
        cross = lo * m_hi + hi.bitwiseAND(0xFFFF) * m_lo + F.shiftleft((F.shiftright(hi, 16) * m_lo).bitwiseAND(0xFFFF), 16)
        new_hi = (F.shiftright(tail, 32) + F.shiftright(top, 16) + cross).bitwiseAND(low)
        jump = ((s["j"] + 1) * (F.lit(float(1 << 31)) / (F.shiftright(new_hi, 1) + 1).cast("double"))).cast("bigint")
        go = F.struct(new_hi.alias("hi"), tail.bitwiseAND(low).alias("lo"), s["j"].alias("b"), jump.alias("j"))
        return F.when(s["j"] < shards, go).otherwise(s)

    k = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    start = F.struct(
        F.shiftrightunsigned(k, 32).alias("hi"),
        k.bitwiseAND(low).alias("lo"),
        F.lit(0).cast("bigint").alias("b"),
        F.lit(0).cast("bigint").alias("j"),
    )
    end = lambda s: F.when(s["j"] >= shards, s["b"]).otherwise(F.raise_error(F.lit("jump hash did not end")).cast("bigint"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step, end).cast("int")


def shard_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 8, buckets: int = 4096) -> DataFrame:
    """Each row's shard, its shard with one more shard, and its gapless slot within the shard.

    Returns (key, size, text_crc32, law, shard, slot, grown_shard). Size is the text's UTF-8 bytes plus
    one; a null text counts as empty. Null keys all act as key 0. Rows with the same key share a shard
    and are told apart by checksum and size in slot order; fully equal rows are interchangeable. Other
    columns of the input are not read.

    Slots are ranked in two steps: each shard's rows fall into hashed buckets, bucket counts give each
    bucket its first slot, and only rows of one (shard, bucket) are sorted together.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    flat = docs.select(
        F.col(key).cast("bigint").alias("k"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    flat = flat.withColumns({
        "shard": jump_hash(F.col("k"), shards),
        "grown_shard": jump_hash(F.col("k"), shards + 1),
        "bucket": F.pmod(F.xxhash64("k", "text_crc32"), F.lit(buckets)),
    })
    flat = materialize(flat, "shards")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        flat.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
        .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    )
    if shards * buckets <= 1 << 18:  # at most that many rows of 24 bytes
        first = F.broadcast(first)
    within = Window.partitionBy("shard", "bucket").orderBy("k", "text_crc32", "size")
    return (
        flat.withColumn("at", F.row_number().over(within))
        .join(first, ["shard", "bucket"])
        .select(
            F.col("k").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
            (F.col("first_slot") + F.col("at") - 1).cast(T.LongType()).alias("slot"), "grown_shard",
        )
    )


PLACE = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def place_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 8, buckets: int = 4096) -> DataFrame:
    """docs with all its columns and, after them, those of PLACE, by the rules of shard_rows.

    A column of docs that has a name of PLACE is replaced. Rows are grouped by (shard, bucket), which a
    table written by shard needs anyway, so this is the one shuffle of the texts; the buckets' first slots
    come from a narrow count before it. Fully equal rows are interchangeable.
    """
    body, own = F.coalesce(F.col(text), F.lit("")), [c for c in docs.columns if c not in PLACE]
    k = F.col(key).cast("bigint")
    tagged = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), k.alias("k"), F.crc32(body.cast("binary")).alias("text_crc32"),
                         (F.octet_length(body) + 1).cast("bigint").alias("size"))
    tagged = tagged.withColumns({"shard": jump_hash(F.col("k"), shards), "bucket": F.pmod(F.xxhash64("k", "text_crc32"), F.lit(buckets))})
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = materialize(tagged.groupBy("shard", "bucket").agg(F.count("*").alias("n")), "shard-buckets")
    first = first.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    if shards * buckets <= 1 << 18:  # at most that many rows of 24 bytes
        first = F.broadcast(first)
    at = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("k", "text_crc32", "size"))
    return tagged.withColumn("at", at).join(first, ["shard", "bucket"]).select(
        "row.*", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first_slot") + F.col("at") - 1).cast("bigint").alias("slot"),
        jump_hash(F.col("k"), shards + 1).alias("grown_shard"))
