"""Order keys: one integer for the pool order, one for a reproducible random order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_BITS = 55
HASH_DIGITS = 15
BUCKET_BITS = 12


def pool_position(src_rank: Column, doc_id: Column) -> Column:
    """One ascending integer for (split, id), so that order and joins need a single bigint.

    Ids must lie in [0, 2^55); anything else raises instead of being reordered.
    """
    rank, ident = src_rank.cast("bigint"), doc_id.cast("bigint")
    inside = (ident >= 0) & (ident < F.lit(1 << ID_BITS)) & (rank >= 0) & (rank < 256)
    return F.when(inside, F.shiftleft(rank, ID_BITS) + ident).otherwise(
        F.raise_error(F.lit("document ids must be integers in [0, 2^55) and splits fewer than 256"))
    )


def split_rank(pool_pos: Column) -> Column:
    return F.shiftright(pool_pos, ID_BITS).cast("int")


def document_id(pool_pos: Column) -> Column:
    return pool_pos.bitwiseAND(F.lit((1 << ID_BITS) - 1))


def hash_order(ident: Column, seed: int | str) -> Column:
    """60 uniform bits of ``md5(seed:id)``; the same on every engine that has md5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), ident.cast("string")))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("bigint")


def hash_bucket(order: Column) -> Column:
    """Leading 12 bits of a hash order: 4,096 even buckets that keep the order."""
    return F.shiftright(order, HASH_DIGITS * 4 - BUCKET_BITS).cast("int")
