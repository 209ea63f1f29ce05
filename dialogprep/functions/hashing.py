"""Seeded, partitioning-independent ordering keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hex digits of the key that name a bucket: 65,536 of them, whatever the data.
BUCKET_DIGITS = 4


def shuffle_key(conv_id: Column, seed: int) -> Column:
    """Uniform hex key. Unlike ``rand(seed)`` it survives re-partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), conv_id.cast("string")))


def key_bucket(key: Column) -> Column:
    return F.substring(key, 1, BUCKET_DIGITS)


def in_hash_share(conv_id: Column, seed: int, share: float) -> Column:
    """Stateless membership in about ``share`` of the ids, for streams.

    The first 60 bits of the key are compared with a bound, so that no share is
    favoured.
    """
    slot = F.conv(F.substring(shuffle_key(conv_id, seed), 1, 15), 16, 10).cast("bigint")
    return slot < int(share * (1 << 60))
