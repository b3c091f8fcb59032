"""Sharding by jump consistent hashing.

A key's shard follows from the key and the number of shards alone: the key seeds a 64-bit
linear congruential generator, and each number drawn decides how far the key would jump as
shards are appended. With one more shard a row either stays or goes to the new shard. There
is no ring table and no state; assigning shards needs no shuffle.

Defined results: a NULL key hashes as 0, rows with equal keys share a shard, an empty table
gives no rows, and NULL text counts as no bytes. Input columns other than the key and the
text are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlytics.llm.common import numbered

# Multiplier of the generator of jump consistent hashing, in 16-bit limbs.
MULTIPLIER = 2862933555777941757
_LIMBS = [(MULTIPLIER >> shift) & 0xFFFF for shift in (0, 16, 32, 48)]
_LOW = 0xFFFF

#: Draws after which any key has long passed the last shard; more raise an error.
MAX_DRAWS = 160


def _next_state(state: Column) -> Column:
    """state * MULTIPLIER + 1 modulo 2**64, in limbs, since bigint products overflow."""
    s = [F.shiftrightunsigned(state, shift).bitwiseAND(_LOW) for shift in (0, 16, 32, 48)]
    out, carry = None, F.lit(1).cast("bigint")
    for place in range(4):
        total = carry
        for i in range(place + 1):
            total = total + s[i] * F.lit(_LIMBS[place - i]).cast("bigint")
        limb = F.shiftleft(total.bitwiseAND(_LOW), 16 * place)
        out = limb if out is None else out.bitwiseOR(limb)
        carry = F.shiftrightunsigned(total, 16)
    return out


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards`` - 1 of a bigint key."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    start = F.struct(
        F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint")).alias("state"),
        F.lit(0).cast("bigint").alias("shard"),
        F.lit(0).cast("bigint").alias("next"),
    )

    def jump(acc: Column) -> Column:
        state = _next_state(acc["state"])
        drawn = F.shiftrightunsigned(state, 33) + 1
        ahead = F.floor((acc["next"] + 1) * (F.lit(float(1 << 31)) / drawn.cast("double")))
        return F.struct(state.alias("state"), acc["next"].alias("shard"), ahead.alias("next"))

    # Each draw moves ahead by one shard at least, so ``shards`` draws always suffice.
    draws = min(shards, MAX_DRAWS)
    last = F.aggregate(
        F.sequence(F.lit(1), F.lit(draws)),
        start,
        lambda acc, _: F.when(acc["next"] < shards, jump(acc)).otherwise(acc),
        lambda acc: F.when(acc["next"] >= shards, acc["shard"]).otherwise(
            F.raise_error(F.lit(f"key not placed after {draws} draws")).cast("bigint")
        ),
    )
    return last.cast("int")


def shard_rows(rows: DataFrame, key: str, text: str, shards: int) -> DataFrame:
    """Key, size in bytes, checksum, shard, shard after growth and slot of every row.

    Slots number the rows of a shard from 0 without gaps, by ascending key. A shard holding
    most rows is numbered by many tasks, since ranges are cut by (shard, key).
    """
    content = F.coalesce(F.col(text), F.lit(""))
    placed = rows.select(
        F.col(key).alias("key"),
        (F.octet_length(content).cast("bigint") + 1).alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        jump_shard(F.col(key), shards).alias("shard"),
        jump_shard(F.col(key), shards + 1).alias("grown_shard"),
    )
    ranked = numbered(placed, [F.col(c) for c in ("shard", "key", "text_crc32", "size")], "place")
    firsts = ranked.groupBy("shard").agg(F.min("place").alias("first"))
    return ranked.join(F.broadcast(firsts), "shard").withColumn(
        "slot", F.col("place") - F.col("first")
    ).drop("place", "first")
