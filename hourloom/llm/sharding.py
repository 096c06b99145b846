"""Sharding by a permutation-filled lookup table.

Every shard walks the slots of a prime-sized table in an order of its own; the shards take
turns, each claiming the first free slot of its order, until the table is full. A key is
hashed to a slot, and the slot names the shard. Adding or removing a shard moves few slots.

Native: placing rows is a broadcast join with the table, whose size is that of the prime.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 16411  # a prime, over 100 slots for each of 128 shards


def _number(label: str, name: str) -> int:
    return int(hashlib.md5(f"{label}:{name}".encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[str]:
    """Shard by slot. Takes as many steps as a shard's walk is long; the table is the bound."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names")
    if slots < len(shards) or any(slots % d == 0 for d in range(2, math.isqrt(slots) + 1)):
        raise ValueError("the number of slots must be a prime, not below the number of shards")
    offset = [_number("offset", s) % slots for s in shards]
    skip = [_number("skip", s) % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    step = [0] * len(shards)
    table: list[str | None] = [None] * slots
    free = slots
    while True:
        for k, shard in enumerate(shards):
            while table[slot := (offset[k] + step[k] * skip[k]) % slots] is not None:
                step[k] += 1
            table[slot] = shard
            step[k] += 1
            free -= 1
            if not free:
                return table


def slot_of(keys: list[Column], slots: int = SLOTS) -> Column:
    """Slot of a key: its first 60 bits of MD5 modulo the table's size. Null differs from ''."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), k.cast("string")), F.lit("null")) for k in keys])
    return (F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % slots).cast("int")


def placement(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard): the lookup table as a frame of ``slots`` rows."""
    names = F.array(*[F.lit(s) for s in shards])
    at = {s: i for i, s in enumerate(shards)}
    filled = ",".join(str(at[s]) for s in lookup_table(shards, slots))
    table = spark.range(1).select(F.posexplode(F.split(F.lit(filled), ",")).alias("slot", "i"))
    return table.select("slot", F.get(names, F.col("i").cast("int")).alias("shard"))


def assign_shards(
    df: DataFrame, keys: list[str], shards: list[str], slots: int = SLOTS, slot: str = "slot", shard: str = "shard"
) -> DataFrame:
    """The rows with their slot and shard; columns of these names are replaced.

    Equal keys, repeated rows included, meet in one shard; null keys are keys like others.
    The rows are not shuffled. An empty table stays empty.
    """
    table = placement(df.sparkSession, shards, slots).toDF("__slot", "__shard")
    columns = [F.col(f"`{c}`") for c in df.columns if c not in (slot, shard)]
    placed = df.select("*", slot_of([F.col(f"`{k}`") for k in keys], slots).alias("__slot"))
    named = placed.join(F.broadcast(table), "__slot")
    return named.select(*columns, F.col("__slot").alias(slot), F.col("__shard").alias(shard))


def write_shards(df: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder per shard; a shard with far more rows than others is written by several tasks."""
    df.hint("rebalance", shard).write.partitionBy(shard).parquet(path)
