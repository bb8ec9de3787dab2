"""Stable row hashes that any engine can reproduce (MD5 of the key text)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidecast.operators.columns import col

BITS = 60


def key_hash(keys: Sequence[str], seed: int = 0) -> Column:
    """60-bit hash of the keys' text, as bigint. The same keys always hash the same."""
    text = F.concat_ws("|", F.lit(str(seed)), *[col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("bigint")


def key_bucket(keys: Sequence[str], buckets: int, seed: int = 0) -> Column:
    return F.pmod(key_hash(keys, seed), F.lit(buckets))
