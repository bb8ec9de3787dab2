"""What several of the text operators share: word rules, shared-folder tables, text batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidecast.session import scratch_path
from tidecast.sources.store import remove

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"

MARKS = 1 << 27  # most bits of a bitmap that goes to every task: 16 MB
ROWS_AT_ONCE = 1024  # rows of an Arrow batch that become Python values at once


_held: tuple = (None, None)  # what this worker keeps from task to task, and of what it was made


def held(make: Callable, *of):
    """``make(*of)``, which a worker keeps for its next tasks until anything else is asked for.

    Workers are used again by later stages. If each operator kept what it needs in a cache of its own, a worker
    would hold the indexes, tokenizers and words of all operators that it ever ran.
    """
    global _held
    if _held[0] != (make, of):
        release()
        _held = ((make, of), make(*of))
    return _held[1]


def release() -> None:
    """Give back what the worker keeps; for tasks that need memory, but nothing of earlier tasks."""
    global _held
    if _held[0] is not None:
        _held = (None, None)
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc holds on to freed pieces between others
        if trim is not None:
            trim(0)


def named(name: str) -> Column:
    """A column by its exact name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from lost executors."""
    return Stored(df, label).rows


class Stored:
    """A table in the shared folder that can be dropped once nothing reads it any more.

    ``seen`` holds what the aggregates ``watch`` are over its rows, taken by the job that writes them.
    """

    def __init__(self, df: DataFrame, label: str, **watch: Column):
        self.spark, self.path = df.sparkSession, scratch_path(df.sparkSession, label)
        told = Observation()
        watched = df.observe(told, *[c.alias(name) for name, c in watch.items()]) if watch else df
        watched.write.parquet(self.path)
        self.seen = told.get if watch else {}
        self.rows = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        remove(self.spark, self.path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def near(rows: DataFrame, at: Column, wanted: DataFrame, of: Column, n: int) -> DataFrame:
    """The ``rows`` whose hash ``at`` is the hash ``of`` of one of the ``n`` rows of ``wanted``, and a few others.

    The hashes are marked in a bitmap of 64 bits a row, at most MARKS, which goes to every task, so ``rows`` are not
    shuffled. About one in 64 of the others passes (more from MARKS / 64 rows on): an exact join has to follow.
    """
    bits = min(MARKS, 1 << max(15, (64 * n).bit_length()))
    place = lambda h: F.pmod(h, F.lit(bits)) + 1
    marks = wanted.select(place(of).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("marks")
    )
    bit = F.bitmap_bit_position(place(at)).cast("int")
    byte = F.conv(F.hex(F.substring("marks", F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.bit_get(byte, bit.bitwiseAND(F.lit(7))) == 1
    return rows.join(F.broadcast(marks), (F.bitmap_bucket_number(place(at)) == F.col("bucket")) & marked, "left_semi")


def words_of(text: Column) -> Column:
    """The words of ``text`` as an array; none for null or blank text."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    none = F.array().cast("array<string>")
    return F.when(bare == "", none).otherwise(F.split(bare, SPACE + "+", -1))


def crc_mod(key: Column, n: int) -> Column:
    """The remainder of crc32 of the key as text; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def texts(batch, column: int = 1) -> list[bytes]:
    """The values of a text column of an Arrow batch as bytes, null as empty."""
    return [x or b"" for x in batch.column(column).cast("binary").to_pylist()]


def pieces(batches: Iterator, text: int = 1, size: int = 4 << 20) -> Iterator[tuple[list, list[bytes]]]:
    """(keys, texts) of Arrow batches in runs of about ``size`` bytes, so that memory stays bounded.

    One row is never split: a run holds at least one whole text.
    """
    for whole in batches:
        for first in range(0, whole.num_rows, ROWS_AT_ONCE):
            batch = whole.slice(first, ROWS_AT_ONCE)
            keys, values = batch.column(0).to_pylist(), texts(batch, text)
            at = 0
            while at < len(values):
                end, held = at, 0
                while end < len(values) and (end == at or held + len(values[end]) <= size):
                    held += len(values[end])
                    end += 1
                yield keys[at:end], values[at:end]
                at = end
