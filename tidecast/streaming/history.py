"""A rolling history per item, kept between micro-batches."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidecast.operators.columns import ITEM, STAMP, TARGET, col
from tidecast.sources.store import names_in, read_json, remove, write_json

# Fixed value: the state store this operator needs.
STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)

_RANK = "row_rank"  # of rows with the same item and timestamp: the highest wins, of equal ones the last to arrive
_ARRIVAL = "arrival"  # of rows that are merged: what was stored comes first
_HISTORY = f"{ITEM} string, {STAMP} timestamp_ntz, {TARGET} double"
_RANKED = f"{_HISTORY}, {_RANK} long"
_STATE = f"{STAMP} timestamp_ntz, {TARGET} double, {_RANK} long"
BUCKETS = 64  # parts of a stored history; a micro-batch rewrites those it touches


def _winners(rows: pd.DataFrame, by: list[str]) -> pd.DataFrame:
    ordered = rows.sort_values([*by, _RANK], kind="stable")
    return ordered.drop_duplicates(by, keep="last")


class _LastRows(StatefulProcessor):
    """Keeps the ``n`` latest rows of an item and emits them after each update."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", _STATE)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        columns = [STAMP, TARGET, _RANK]
        kept = pd.DataFrame(list(self.rows.get()), columns=columns)
        # Batches are folded one by one, so memory stays at n rows however many arrive.
        for batch in rows:
            kept = pd.concat([kept, batch[columns]], ignore_index=True) if len(kept) else batch[columns]
            kept = _winners(kept, [STAMP]).tail(self.n)
        self.rows.put([(t.to_pydatetime(), float(y), int(r)) for t, y, r in kept.itertuples(index=False)])
        yield pd.DataFrame({ITEM: key[0], STAMP: kept[STAMP], TARGET: kept[TARGET]})

    def close(self) -> None:
        pass


def _trim(n: int):
    def trim(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield _winners(rows, [ITEM, STAMP]).groupby(ITEM, sort=False).tail(n)

    return trim


def rolling_history(stream: DataFrame, n: int, order: str | None = None) -> DataFrame:
    """Stream of each updated item's ``n`` latest rows.

    Of several rows for a timestamp the one with the largest ``order`` (a whole number, null lowest)
    wins, so results don't depend on how rows were dealt to tasks and micro-batches; without it, or
    among equals, the last to arrive does. Rows are trimmed to ``n`` per item in every batch of the
    scan, before they are shuffled to the item's state, so a hot item sends little more than the
    others. Needs the RocksDB state store (``STATE_STORE``).
    """
    rows = stream.select(ITEM, STAMP, TARGET, _rank(order)).mapInPandas(_trim(n), _RANKED)
    return rows.groupBy(ITEM).transformWithStateInPandas(
        statefulProcessor=_LastRows(n), outputStructType=_HISTORY, outputMode="Update", timeMode="None"
    )


def run_history(
    stream: DataFrame, n: int, name: str, output: str, checkpoint: str, order: str | None = None, buckets: int = BUCKETS
) -> None:
    """Bring the stored histories up to date with what is there.

    Of several rows for a timestamp that wins which ``rolling_history`` says. The stored table has one
    row per item and timestamp at any time, and is all the state there is: a micro-batch is merged
    with it by aggregates and windows, without a step per item. It lies in ``buckets`` parts by
    item hash; a micro-batch writes new versions of the parts it touches, then a list of the current
    version of every part, and only then removes versions that neither this list nor the one before
    names. A repeated micro-batch starts from the same list as the first time. Rows without an item
    are left out; a null timestamp is the latest.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        _merge(batch, batch_id, output, buckets, n, order)

    writer = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.foreachBatch(handle).start().awaitTermination()


def _rank(order: str | None):
    rank = F.lit(0) if order is None else F.coalesce(col(order).cast("long"), F.lit(-(2**63)))
    return rank.cast("long").alias(_RANK)


def _latest(rows: DataFrame, n: int | None) -> DataFrame:
    """One row per item and timestamp, of the ``n`` latest timestamps; a hot item's rows are reduced before each shuffle."""
    best = F.max_by(F.struct(TARGET, _RANK), F.struct(_RANK, _ARRIVAL)).alias("best")
    one = rows.where(F.col(ITEM).isNotNull()).groupBy(ITEM, STAMP).agg(best).select(ITEM, STAMP, "best.*")
    if n is None:
        return one
    newest = Window.partitionBy(ITEM).orderBy(F.col(STAMP).desc_nulls_first())
    return one.withColumn("place", F.row_number().over(newest)).where(F.col("place") <= n).drop("place")


def _versions(spark: SparkSession, output: str, before: int | None = None) -> tuple[int | None, dict[str, int]]:
    """(micro-batch, {bucket: micro-batch that wrote its current version}) of the newest list."""
    known = [int(x) for x in names_in(spark, f"{output}/versions") if x.isdigit()]
    known = [x for x in known if before is None or x < before]
    return (max(known), read_json(spark, f"{output}/versions/{max(known)}")) if known else (None, {})


def _part(output: str, version: int, bucket: "int | str") -> str:
    return f"{output}/data/{version}/bucket={bucket}"


def _merge(batch: DataFrame, batch_id: int, output: str, buckets: int, n: int | None = None, order: str | None = None) -> None:
    spark = batch.sparkSession
    last, current = _versions(spark, output, batch_id)
    arrived = batch.select(
        ITEM, F.col(STAMP).cast("timestamp_ntz").alias(STAMP), F.col(TARGET).cast("double").alias(TARGET),
        _rank(order), F.monotonically_increasing_id().alias(_ARRIVAL),
    )
    bucket = F.pmod(F.xxhash64(ITEM), F.lit(buckets)).cast("int").alias("bucket")
    placed = _latest(arrived, n).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = sorted(r.bucket for r in placed.select(bucket).distinct().collect())  # at most ``buckets``
        rows = placed
        old = [_part(output, current[str(b)], b) for b in touched if str(b) in current]
        if old:
            kept = spark.read.schema(_RANKED).parquet(*old)
            both = kept.withColumn(_ARRIVAL, F.lit(0)).unionByName(placed.withColumn(_ARRIVAL, F.lit(1)))
            rows = _latest(both, n)
        rows.select("*", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{output}/data/{batch_id}")
    finally:
        placed.unpersist()
    now = {**current, **{str(b): batch_id for b in touched}}
    write_json(spark, f"{output}/versions/{batch_id}", now)
    needed = {*now.items(), *current.items()}
    for version in names_in(spark, f"{output}/data"):
        here = [x for x in names_in(spark, f"{output}/data/{version}") if x.startswith("bucket=")]
        unused = [x for x in here if (x.partition("=")[2], int(version)) not in needed]
        if len(unused) == len(here):
            remove(spark, f"{output}/data/{version}")
        else:
            for x in unused:
                remove(spark, f"{output}/data/{version}/{x}")
    for version in names_in(spark, f"{output}/versions"):
        if version.isdigit() and int(version) not in (batch_id, last):
            remove(spark, f"{output}/versions/{version}")


def read_history(spark: SparkSession, output: str) -> DataFrame:
    """Each item's current history: one row per item and timestamp, each stored row read once."""
    _, current = _versions(spark, output)
    if not current:
        return spark.createDataFrame([], _HISTORY)
    return spark.read.schema(_HISTORY).parquet(*[_part(output, v, b) for b, v in current.items()])
