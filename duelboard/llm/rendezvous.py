"""Sharding by rendezvous hashing of record keys over weighted shards.

Each shard draws one number from the record's key; the record goes to the shard with
the highest draw, scaled by the shard's weight. Adding a shard adds one draw, so a
record either stays or moves to the new shard. Everything is a column expression:
no state, and shards need not be listed in a table.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PRIME = 2**31 - 1
OVERHEAD_BYTES = 16


def shard_constants(shard: int) -> tuple[int, int, int]:
    """Multipliers and offset of a shard, drawn from the MD5 of its number."""
    digest = hashlib.md5(f"shard {shard}".encode()).digest()
    a, b, c = (int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(3))
    return a % (2**30 - 1) + 1, b % (2**30 - 1) + 1, c % (2**30 - 1)


def key_parts(key: Column) -> tuple[Column, Column]:
    """Two independent numbers below 2^31 from the MD5 of a key; a null key counts as empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    part = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint") % PRIME
    return part(1), part(9)


def rendezvous_shard(u: Column, v: Column, weights: list[float]) -> Column:
    """Number of the winning shard for key parts ``u`` and ``v``.

    Equal weights compare the draws themselves; otherwise the draw ``h`` of a shard of
    weight ``w`` scores ``w / -ln(h)`` with ``h`` in (0, 1), so shares follow the
    weights. Ties go to the lower shard. Shards of weight 0 get nothing.
    """
    used = [(i, w) for i, w in enumerate(weights) if w > 0]
    if not used:
        raise ValueError("no shard has a positive weight")
    even = len({w for _, w in used}) == 1
    scores = []
    for i, weight in used:
        a, b, c = shard_constants(i)
        draw = (u * a + v * b + c) % PRIME
        score = draw.cast("double") if even else -F.lit(float(weight)) / F.log((draw + 0.5) / PRIME)
        scores.append(F.struct(score.alias("score"), F.lit(-i).alias("last")))
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return (-best["last"]).cast("int")


def assign_shards(
    df: DataFrame, key: str = "doc_id", text: str = "text", weights: list[float] | None = None, grown: list[float] | None = None, blocks: int | None = None
) -> DataFrame:
    """Shard and gapless slot of every row: key, size, text_crc32, law, shard, slot, grown_shard.

    ``weights`` has one entry per shard (default 40 equal ones) and ``grown`` the shards
    after growth (default one more). ``size`` is the text's UTF-8 bytes (null: none)
    plus 16; the CRC of a null text is that of no bytes. Slots of a shard count 0, 1, ...
    They are numbered inside blocks of a shard, whose counts give each block its first
    slot, so that no task holds a whole shard. Rows with the same key share the shard and
    get different slots; a null key is a key like any other. The texts themselves are
    never shuffled. ``blocks`` per shard defaults to one for every 50,000 rows of a shard.
    """
    weights = weights or [1.0] * 40
    grown = grown or [*weights, 1.0]
    content = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    u, v = key_parts(F.col("key"))
    rows = (
        df.select(F.col(f"`{key}`").alias("key"), (F.octet_length(content) + OVERHEAD_BYTES).cast("bigint").alias("size"), F.crc32(content).alias("text_crc32"))
        .select("*", u.alias("u"), v.alias("v"))
        .select("key", "size", "text_crc32", rendezvous_shard(F.col("u"), F.col("v"), weights).alias("shard"), rendezvous_shard(F.col("u"), F.col("v"), grown).alias("grown_shard"))
    )
    if blocks is None:
        blocks = max(1, math.ceil(df.count() / (50_000 * len(weights))))
    # repeated keys share a block unless their rows differ
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key", "size", "text_crc32"), F.lit(blocks)).cast("int"))
    counts = rows.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    order = Window.partitionBy("shard", "block").orderBy("key", "size", "text_crc32")
    return (
        rows.withColumn("place", F.row_number().over(order) - 1)
        .join(first, ["shard", "block"])
        .select(
            F.col("key").alias(key),
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("first") + F.col("place")).cast("bigint").alias("slot"),
            "grown_shard",
        )
    )
