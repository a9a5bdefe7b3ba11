"""Which rows of a wide table belong to a set of keys, decided without shuffling the wide rows.

Two bit tables of a bounded size are made from narrow tables: one of the keys that belong, one of those that do not. A row
whose key's bit is missing in one of them is decided by that. Only rows with both bits, which are there by chance, are
joined exactly. The answer is the same at every size; what grows with the table is the share of rows decided by the join,
once the keys outnumber ``LARGEST_BITS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import stage

BITS_PER_KEY = 16
SMALLEST_BITS, LARGEST_BITS = 1 << 18, 1 << 28  # of one table: at most 32 MB
_BLOCK = 15  # a block has 2**15 bits, as Spark's bitmap aggregate makes them


def table_bits(n_keys: int) -> int:
    """Bits of a table for so many keys: a power of two between the two bounds."""
    return min(LARGEST_BITS, max(SMALLEST_BITS, 1 << (BITS_PER_KEY * n_keys - 1).bit_length() if n_keys else 0))


def _place(key: Column, bits: int) -> Column:
    return F.xxhash64(F.lit("member"), key).bitwiseAND(F.lit(bits - 1))


def _bit_table(keys: DataFrame, bits: int, label: str) -> DataFrame:
    placed = keys.select(_place(F.col("_key"), bits).alias("_place"))
    blocks = placed.groupBy(F.shiftright("_place", _BLOCK).alias(f"_{label}")).agg(
        F.bitmap_construct_agg(F.col("_place").bitwiseAND(F.lit((1 << _BLOCK) - 1))).alias(f"_{label}_bits")
    )
    return stage(blocks, f"bits-{label}")


def _has_bit(bitmap: Column, place: Column) -> Column:
    inside = place.bitwiseAND(F.lit((1 << _BLOCK) - 1))
    byte = F.conv(F.hex(F.substring(bitmap, (F.shiftright(inside, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (inside.bitwiseAND(F.lit(7)) + 1).cast("int"))
    return F.coalesce(byte.bitwiseAND(bit) != 0, F.lit(False))


def marked(wide: DataFrame, key: Column, inside: DataFrame, outside: DataFrame, flag: str) -> DataFrame:
    """``wide`` with the boolean ``flag``: whether ``key`` is in ``inside``.

    ``inside`` and ``outside`` (one column _key each, of the type of ``key``) are disjoint, hold every key of ``wide``
    between them, and are written tables, as they are read more than once. A null key is in neither: its flag is false.
    """
    bits = table_bits(inside.count() + outside.count())
    rows = wide.withColumn("_key", key).withColumn("_place", _place(F.col("_key"), bits))
    for keys, label in ((inside, "in"), (outside, "out")):
        blocks = F.broadcast(_bit_table(keys, bits, label))  # at most LARGEST_BITS / 8 bytes
        rows = rows.join(blocks, F.shiftright("_place", _BLOCK) == F.col(f"_{label}"), "left")
        rows = rows.withColumn(f"_{label}_hit", _has_bit(F.col(f"_{label}_bits"), F.col("_place"))).drop(f"_{label}", f"_{label}_bits")
    clear = rows.where(~(F.col("_in_hit") & F.col("_out_hit")))
    open_rows = rows.where(F.col("_in_hit") & F.col("_out_hit"))
    decided = clear.withColumn(flag, F.col("_in_hit") & F.col("_key").isNotNull())
    found = inside.select(F.col("_key").alias("_found")).distinct()
    joined = open_rows.join(found, open_rows["_key"] == found["_found"], "left").withColumn(flag, F.col("_found").isNotNull())
    return decided.unionByName(joined.drop("_found")).drop("_key", "_place", "_in_hit", "_out_hit")
