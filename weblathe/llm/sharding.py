"""Sharding by jump consistent hashing, in DataFrame expressions only.

``jump(key, n)`` is the published algorithm: a 64-bit linear congruential generator seeded with the key draws jumps
until one passes ``n``. A key's shard depends on the key and ``n`` alone, there is no ring table, and going from ``n``
to ``n + 1`` shards moves a key either nowhere or to the new shard.

Spark's ANSI mode rejects 64-bit overflow, so the generator works on two 32-bit halves.

Cases: a null key counts as 0; null text has no bytes (size 1, CRC 0); empty tables give no rows; repeated rows each get
a slot of their own; extra columns are ignored. Equal texts are not held together: under the ``key`` law the key alone
decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

#: Fixed values of the published generator: state * MULTIPLIER + 1 modulo 2**64, of which the top 31 bits are drawn.
MULTIPLIER = 2862933555777941757
MASK32 = (1 << 32) - 1


def _times32(x: Column, factor: int) -> Column:
    """(x * factor) mod 2**32 for x and factor below 2**32."""
    low, high = factor & 0xFFFF, factor >> 16
    return (x * F.lit(low) + F.shiftleft((x * F.lit(high)).bitwiseAND(F.lit(0xFFFF)), 16)).bitwiseAND(F.lit(MASK32))


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """One step of the generator on (high, low) halves."""
    a_high, a_low = MULTIPLIER >> 32, MULTIPLIER & MASK32
    middle = low * F.lit(a_low >> 16)
    total = low * F.lit(a_low & 0xFFFF) + F.lit(1) + F.shiftleft(middle.bitwiseAND(F.lit(0xFFFF)), 16)
    carry = F.shiftright(total, 32) + F.shiftright(middle, 16)
    return (carry + _times32(low, a_high) + _times32(high, a_low)).bitwiseAND(F.lit(MASK32)), total.bitwiseAND(F.lit(MASK32))


def jump(key: Column, shards: int) -> Column:
    """Shard of a BIGINT key, from 0 to ``shards - 1``."""
    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    start = F.struct(
        F.shiftrightunsigned(key, 32).bitwiseAND(F.lit(MASK32)).alias("high"),
        key.bitwiseAND(F.lit(MASK32)).alias("low"),
        F.lit(-1).cast("bigint").alias("shard"),
        F.lit(0).cast("bigint").alias("jump"),
    )

    def step(s: Column, _: Column) -> Column:
        high, low = _next(s["high"], s["low"])
        drawn = F.shiftright(high, 1) + F.lit(1)
        to = ((s["jump"] + F.lit(1)).cast("double") * (F.lit(2147483648.0) / drawn.cast("double"))).cast("bigint")
        moved = F.struct(high.alias("high"), low.alias("low"), s["jump"].alias("shard"), to.alias("jump"))
        return F.when(s["jump"] < F.lit(shards), moved).otherwise(s)

    # every jump goes up by one at least, so that many steps always suffice
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)["shard"].cast("int")


def assign_shards(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 16, slot_groups: int = 1024) -> DataFrame:
    """Return key, size, text_crc32, law, shard, slot and grown_shard for every row.

    Slots number a shard's rows without gaps. They come from counts of ``slot_groups`` groups a shard (a table of at most
    ``shards * slot_groups`` rows, hence safe to broadcast) and a row number within each group, so no task ever holds a
    whole shard.
    """
    k = F.coalesce(F.col(key).cast("bigint"), F.lit(0).cast("bigint"))
    low = _next(F.shiftrightunsigned(k, 32).bitwiseAND(F.lit(MASK32)), k.bitwiseAND(F.lit(MASK32)))[1]
    rows = df.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(text_or_empty(text)).cast("bigint") + F.lit(1)).alias("size"),
        F.crc32(text_or_empty(text).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        jump(F.col(key), shards).alias("shard"),
        jump(F.col(key), shards + 1).alias("grown_shard"),
        # the text counts too, so that different rows under one key don't meet in one task
        F.pmod(F.shiftright(low, 8) + F.crc32(text_or_empty(text).cast("binary")), F.lit(slot_groups)).cast("int").alias("_group"),
    )
    before = "sum(n) OVER (PARTITION BY shard ORDER BY _group ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS _before"
    counts = rows.groupBy("shard", "_group").agg(F.count(F.lit(1)).alias("n")).selectExpr("shard AS _shard", "_group AS _g", before)
    number = F.expr("row_number() OVER (PARTITION BY shard, _group ORDER BY doc_id, size, text_crc32)")
    placed = rows.withColumn("_n", number).join(F.broadcast(counts), (F.col("shard") == F.col("_shard")) & (F.col("_group") == F.col("_g")))
    slot = (F.col("_before") + F.col("_n") - F.lit(1)).cast("bigint").alias("slot")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", slot, "grown_shard")
