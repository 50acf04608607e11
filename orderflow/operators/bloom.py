"""Bloom filters over ids as tables: a row for each block of bits.

An id sets ``POSITIONS`` bits in one block of ``BLOCK_BITS``, so looking it up takes one row.
With ``BITS_PER_ID`` bits for each id, about one id in a million that is not there seems to be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What Spark's bitmap functions hold in a value.
BLOCK_BITS = 1 << 15
BITS_PER_ID = 32
POSITIONS = 12
_PER_HASH = 4


def block_count(ids: int) -> int:
    """Blocks for so many ids, as a power of two, so that few sizes occur."""
    needed = max(1, -(-ids * BITS_PER_ID // BLOCK_BITS))
    return 1 << (needed - 1).bit_length()


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), key), blocks)


def _positions(key: Column) -> list[Column]:
    """Places in the block, four of each hash."""
    hashes = [F.xxhash64(F.lit(seed), key) for seed in range(1, 1 + POSITIONS // _PER_HASH)]
    return [
        F.shiftrightunsigned(h, 15 * k).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int")
        for h in hashes
        for k in range(_PER_HASH)
    ]


def build_filter(ids: DataFrame, key: str, blocks: int) -> DataFrame:
    """``blocks``, ``block`` and ``bits`` of the ids that are not null."""
    key_column = F.col(key)
    places = ids.where(key_column.isNotNull()).select(
        _block(key_column, F.lit(blocks)).alias("block"),
        F.explode(F.array(*_positions(key_column))).alias("place"),
    )
    made = places.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits"))
    return made.select(F.lit(blocks).cast("bigint").alias("blocks"), "block", "bits")


def _is_set(place: Column) -> Column:
    byte = F.substring("bits", F.shiftright(place, 3) + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    bit = F.call_function("shiftright", value, place.bitwiseAND(F.lit(7)))
    return bit.bitwiseAND(F.lit(1)) == 1


def may_contain(ids: DataFrame, key: str, filters: DataFrame, sizes: list[int]) -> DataFrame:
    """Ids joined with the filters that may have them; ``sizes`` are the filters' ``blocks``.

    Bits are tested within the join, the first that is missing ends a test, so what comes
    out is what is there and about one in a million of the rest.
    """
    every = ids.where(F.col(key).isNotNull()).withColumn(
        "blocks", F.explode(F.array(*[F.lit(size).cast("bigint") for size in sizes]))
    )
    every = every.withColumn("block", _block(F.col(key), F.col("blocks")))
    found = (F.col("i.blocks") == F.col("f.blocks")) & (F.col("i.block") == F.col("f.block"))
    for place in _positions(F.col(f"i.{key}")):
        found = found & _is_set(place)
    rest = [F.col(f"f.{c}") for c in filters.columns if c not in ("blocks", "block", "bits")]
    return every.alias("i").join(filters.alias("f"), found).select(F.col(f"i.{key}"), *rest)
