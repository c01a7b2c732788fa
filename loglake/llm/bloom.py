"""A blocked Bloom filter as a small table: which rows may have a key that another table has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8


def _hashes(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """A key's block, and the bit it sets in each of the block's words."""
    spot, bits = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("long")
    return F.pmod(spot, F.lit(blocks)), [
        F.call_function("shiftleft", one, F.shiftright(bits, 6 * i).bitwiseAND(63).cast("int")) for i in range(WORDS)]


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """``block, w0 .. w7`` of the keys; blocks without any are left out."""
    block, bits = _hashes(F.col(key), blocks)
    return keys.select(block.alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(bits)]).groupBy("block").agg(
        *[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def with_possible(rows: DataFrame, keys: DataFrame, key: str, max_blocks: int = 1 << 17) -> DataFrame:
    """``rows`` and ``possible``: false only where ``keys`` certainly lacks the row's ``key`` (so for null).

    The filter has about twelve bits for each key and ``max_blocks`` blocks (of 64 bytes) at most, so
    it fits every task; more keys make more possible hits, never a wrong ``false``.
    """
    blocks = min(max_blocks, max(1, keys.count() * 12 // 512 + 1))
    block, bits = _hashes(F.col(key), blocks)
    tested = rows.withColumn("block", F.when(F.col(key).isNotNull(), block)).join(
        F.broadcast(bloom_filter(keys, key, blocks)), "block", "left")
    passes = F.col(key).isNotNull()
    for i, bit in enumerate(bits):
        passes = passes & (F.col(f"w{i}").bitwiseAND(bit) != 0)
    return tested.select(*rows.columns, F.coalesce(passes, F.lit(False)).alias("possible"))
