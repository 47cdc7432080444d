"""Blocked Bloom filters as tables: which of many ids may be among wanted ones.

A filter is a table of bit blocks of 4096 bytes, made by Spark's bitmap
aggregate. An id belongs to one block by its hash and sets a few bits there, so
a test is one lookup of a block. The number of blocks follows from the number of
ids, and a filter beyond a fixed size is not made: then all rows pass, which
costs time and changes no result, as an exact join follows every use.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of a block (what Spark's bitmap functions use), set by each id, and kept for each id.
BLOCK_BITS, HASHES, BITS_PER_ID = 32768, 3, 16
#: Bytes of the largest filter that is made and sent to all tasks.
MOST_BYTES = 32 << 20


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i + 1), key), F.lit(BLOCK_BITS)) for i in range(HASHES)]


def block_count(ids: int) -> int:
    """Blocks for so many ids; a false id passes in about one of 200 cases."""
    return max(1, -(-ids * BITS_PER_ID // BLOCK_BITS))


def blocks_of(ids: DataFrame, key: str, count: int) -> DataFrame:
    """(block, bits): the filter over a column of ids, of ``count`` blocks at most."""
    return (
        ids.filter(F.col(key).isNotNull())
        .select(_block(F.col(key), count).alias("block"), F.explode(F.array(*_bits(F.col(key)))).alias("bit"))
        .groupBy("block")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def maybe_among(rows: DataFrame, ids: DataFrame, key: str = "id", ids_key: str = "id", most: int = MOST_BYTES) -> DataFrame:
    """Rows whose key may be among the ids: all that are, few of the others.

    The ids are counted first. Where their filter would be larger than ``most``
    bytes, every row passes.
    """
    count = block_count(ids.agg(F.count(ids_key)).first()[0])
    if count * BLOCK_BITS // 8 > most:
        return rows
    # the size is bounded by the check above
    blocks = F.broadcast(blocks_of(ids, ids_key, count).toDF("_block", "_bits"))
    tests = [_is_set(F.col("_bits"), bit) for bit in _bits(F.col(key))]
    matched = rows.join(blocks, _block(F.col(key), count) == F.col("_block"))
    return matched.filter(reduce(lambda a, b: a & b, tests)).drop("_block", "_bits")
