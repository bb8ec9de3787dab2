"""Row splits, folds and samples by key hash: repeatable on any cluster and partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.hashing import BITS, key_bucket, key_hash
from tidecast.operators.columns import col

_BUCKET_BITS = 16
_SORTED_ROWS = 100_000  # a bucket of at most so many rows is sorted in one task


def is_held_out(keys: Sequence[str], percent: int = 10, seed: int = 0) -> Column:
    return key_bucket(keys, 100, seed) < percent


def holdout_rows(
    df: DataFrame, keys: Sequence[str] | None = None, percent: int = 10, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """(train, validation); rows with equal keys always land on the same side."""
    held = is_held_out(keys or df.columns, percent, seed)
    return df.filter(~held), df.filter(held)


def fold_of(keys: Sequence[str], folds: int, bag_set: int = 0) -> Column:
    """Fold number 0..folds-1 of a row within one bag set."""
    return key_bucket(keys, folds, bag_set).cast("int")


def sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """The ``n`` rows with the smallest key hash; ``keys`` should identify rows.

    A job counts hash buckets (at most 65,536 numbers reach the driver). Whole buckets below the cut
    are taken by a filter. The bucket at the cut is sorted if it is small, and else counted again by
    the next bits, first of the key's hash and then, for rows of one key, of the whole row's, so that
    a key repeated any number of times is in no one sort. Of equal rows any are as good as others.
    """
    comparable = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]  # maps have no hash
    tie = F.pmod(F.xxhash64(*map(col, comparable)), F.lit(1 << BITS))
    edge = df.withColumns({"_hash": key_hash(keys, seed), "_tie": tie})
    below, left = [], n
    for name, shift in [(c, s) for c in ("_hash", "_tie") for s in range(BITS - _BUCKET_BITS, -_BUCKET_BITS, -_BUCKET_BITS)]:
        bucket = F.shiftright(name, max(shift, 0))
        cut, size = None, 0
        for b, count in sorted(edge.groupBy(bucket.alias("b")).count().collect()):
            if count > left:
                cut, size = b, count
                break
            left -= count
        if cut is None:
            below.append(edge)
            break
        below.append(edge.filter(bucket < F.lit(cut)))
        edge = edge.filter(bucket == F.lit(cut))
        if left == 0:
            break
        if size <= _SORTED_ROWS:
            below.append(edge.orderBy("_hash", *map(col, keys), "_tie").limit(left))
            break
    else:
        below.append(_copies(edge.limit(1), left))
    out = below[0]
    for part in below[1:]:
        out = out.unionByName(part)
    return out.drop("_hash", "_tie")


def _copies(row: DataFrame, n: int) -> DataFrame:
    """The one row ``n`` times, opened by many tasks."""
    parts = row.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit((n - 1) // _SORTED_ROWS)))).repartition("_part")
    size = F.least(F.lit(_SORTED_ROWS), F.lit(n) - F.col("_part") * _SORTED_ROWS)
    return parts.withColumn("_copy", F.explode(F.sequence(F.lit(1), size.cast("int")))).drop("_part", "_copy")
