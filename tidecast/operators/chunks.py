"""Order-dependent work on long series without putting an item into one task.

Rows are grouped by ``(item, chunk)``, where a chunk is a fixed range of calendar steps, so
no group exceeds ``CHUNK`` steps plus a halo however long or hot an item is. Two shapes
cover everything the library needs:

* *Halo*: the last ``halo`` steps of a chunk are also sent to the next one, so look-backs of
  up to ``halo`` steps are complete inside each chunk (lags, seasonal differences, rolling
  means). Costs ``halo / CHUNK`` extra rows and one shuffle.
* *Carry*: each chunk is reduced to one summary row, the summaries (a ``CHUNK``-th of the
  data) are scanned per item, and the running value is handed to the chunk (forward fill).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.operators.columns import ITEM

CHUNK = 4096


def chunk_size(halo: int) -> int:
    """Chunk width in steps, at least as wide as the halo so it reaches one chunk only."""
    size = CHUNK
    while size < halo:
        size *= 2
    return size


def chunk_index(step: Column, size: int = CHUNK) -> Column:
    return ((step - F.pmod(step, F.lit(size))) / size).cast("bigint")


def with_halo(df: DataFrame, halo: int, item: str = ITEM, step: str = "step") -> DataFrame:
    """Add ``chunk`` and ``in_halo``; rows near a chunk's end appear in the next one too."""
    size = chunk_size(halo)
    own = chunk_index(F.col(step), size)
    tail = F.pmod(F.col(step), F.lit(size)) >= size - halo
    homes = F.when(tail, F.array(own, own + 1)).otherwise(F.array(own))
    return df.withColumn("chunk", F.explode(homes)).withColumn("in_halo", F.col("chunk") != own)


def chunk_window(item: str = ITEM, step: str = "step"):
    return Window.partitionBy(item, "chunk").orderBy(step)


def value_at_lag(value: Column, lag: int, item: str = ITEM, step: str = "step") -> Column:
    """Value exactly ``lag`` steps earlier, null where that step was not observed."""
    if lag == 1:
        # The step before, if observed at all, is the row before.
        window = chunk_window(item, step)
        return F.when(F.lag(step).over(window) == F.col(step) - 1, F.lag(value).over(window))
    return F.first(value).over(chunk_window(item, step).rangeBetween(-lag, -lag))


def refuse_duplicates(value: Column, item: str = ITEM, step: str = "step") -> Column:
    """``value``, or an error naming the item when two rows share one step.

    Rides on a window the plan already has, so the check costs no shuffle of its own.
    """
    before = F.lag(step).over(chunk_window(item, step))
    message = F.concat(F.lit("duplicate timestamp for item "), F.col(item))
    return F.when(before == F.col(step), F.raise_error(message).cast("double")).otherwise(value)
