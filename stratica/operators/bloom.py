"""Mergeable filters of keys, kept per date.

A filter is a set of bits, ``HASHES`` of them set by each key, stored as pieces of 4 KB: filters of several dates merge by
an or of their pieces. A key whose bits are not all set is certainly not there. The size is a parameter, the same for all
dates, and bounds what is brought to the driver and sent out when a filter is asked: ``bits`` / 8 bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A million bytes, for some 800,000 keys at one wrong answer in a hundred.
BITS = 1 << 23
HASHES = 5
_PIECE = 1 << 15
_SEED = "stratica"


def _positions(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(_SEED), F.lit(i), key.cast("string")), F.lit(bits)) for i in range(HASHES)]


def filters(keys: DataFrame, key: str, date: str, bits: int = BITS) -> DataFrame:
    """``(date, piece, bits)``: the filter of each date's keys; null keys set nothing."""
    if bits % _PIECE:
        raise ValueError(f"bits must be a multiple of {_PIECE}")
    spots = keys.where(F.col(key).isNotNull()).select(F.col(date).alias("date"), F.explode(F.array(*_positions(F.col(key), bits))).alias("at"))
    one = F.col("at") + 1  # bitmap functions count from one
    return spots.groupBy("date", F.bitmap_bucket_number(one).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(one)).alias("bits"))


def may_contain(stored: DataFrame, key: Column, bits: int = BITS) -> Column:
    """Whether a key may be among those of the ``stored`` filters, merged; null for a null key.

    The merged filter is part of the expression, ``bits`` / 8 bytes of it.
    """
    merged = stored.groupBy("piece").agg(F.bitmap_or_agg("bits").alias("bits")).collect()
    whole = bytearray(bits // 8)
    for row in merged:
        start = (row["piece"] - 1) * _PIECE // 8
        whole[start : start + len(row["bits"])] = row["bits"]
    held = F.lit(bytes(whole))

    def is_set(at: Column) -> Column:
        byte = F.conv(F.hex(F.substring(held, F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << b) for b in range(8)]), at.bitwiseAND(7).cast("int") + 1)) != 0

    found = F.lit(True)
    for at in _positions(key, bits):
        found = found & is_set(at)
    return F.when(key.isNotNull(), found)
