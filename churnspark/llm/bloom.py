"""Blocked Bloom filter as a DataFrame of fixed maximal size.

One 512-bit block per key, eight bits set in it.  The table has at most
``max_blocks`` rows whatever the number of keys: more keys only let more rows
through to the exact join that follows, so broadcasting it is always bounded.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONGS = 8
BITS_PER_KEY = 12
#: 8 MB of masks at most.
MAX_BLOCKS = 1 << 17


def _bits(key: Column, n_blocks: int) -> tuple[Column, list[Column]]:
    """Block number, and one mask per long of the block (one bit in each)."""
    h, g = F.xxhash64(key), F.xxhash64(F.lit(11), key)
    return (F.pmod(h, F.lit(n_blocks)).cast("int"),
            [F.call_function("shiftleft", F.lit(1).cast("long"), F.call_function(
                "shiftrightunsigned", g, F.lit(6 * i)).bitwiseAND(F.lit(63)).cast("int")) for i in range(LONGS)])


def bloom_filter(keys: DataFrame, key: str, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """(block, m0..m7) of the blocks that are set, and the number of blocks."""
    n_blocks = max(1, min(max_blocks, ceil(keys.count() * BITS_PER_KEY / (64 * LONGS))))
    block, masks = _bits(F.col(key), n_blocks)
    return keys.groupBy(block.alias("block")).agg(*[F.bit_or(m).alias(f"m{i}") for i, m in enumerate(masks)]), n_blocks


def with_possible(df: DataFrame, key: Column, blocks: DataFrame, n_blocks: int, name: str = "possible") -> DataFrame:
    """``df`` (with no columns named block or m0..m7) and a flag: false means
    certainly not among the keys (a null key is not)."""
    block, masks = _bits(key, n_blocks)
    hit = F.lit(True)
    for i, m in enumerate(masks):
        hit = hit & (F.col(f"m{i}").bitwiseAND(m) != 0)
    tested = df.withColumn("block", F.when(key.isNotNull(), block)).join(F.broadcast(blocks), "block", "left")
    return tested.withColumn(name, F.coalesce(hit, F.lit(False))).drop("block", *[f"m{i}" for i in range(LONGS)])
