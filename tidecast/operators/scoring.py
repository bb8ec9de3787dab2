"""Scoring with a user's own code: load once per worker, score Arrow batches.

``load_fn`` builds the model (from files, a broadcast, anything picklable) the first time a
Python worker needs it; the worker keeps it for later tasks of the same scorer.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.operators.chunks import chunk_index
from tidecast.operators.columns import ITEM, STAMP, col
from tidecast.operators.series import last_chunks, with_step



def _model(token: str, load_fn: Callable[[], Any]) -> Any:
    # Kept in a module of the worker process, because functions arrive anew with every task.
    loaded = vars(sys.modules.setdefault("tidecast_loaded", types.ModuleType("tidecast_loaded")))
    if token not in loaded:
        loaded[token] = load_fn()
    return loaded[token]


def score_with(
    df: DataFrame,
    load_fn: Callable[[], Any],
    score_fn: Callable[[Any, pd.DataFrame], pd.DataFrame],
    schema: str,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Score rows batch by batch. Only ``columns`` are read and sent to Python."""
    token = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(token, load_fn)
        for batch in batches:
            yield score_fn(model, batch)

    source = df.select(*map(col, columns)) if columns is not None else df
    return source.mapInPandas(run, schema)


def recent_context(series: DataFrame, context: int, freq) -> DataFrame:
    """The last ``context`` calendar steps of every item."""
    stepped = with_step(series, freq).withColumn("chunk", chunk_index(F.col("step")))
    joined = stepped.join(last_chunks(stepped, context), [ITEM, "chunk"])
    return joined.filter(F.col("step") > F.col("last_step") - context).drop("step", "chunk", "last_step")


def score_items(
    series: DataFrame,
    load_fn: Callable[[], Any],
    score_fn: Callable[[Any, pd.DataFrame], pd.DataFrame],
    schema: str,
    context: int,
    freq,
) -> DataFrame:
    """Score each item's recent history with a model that needs all of it at once.

    ``context`` is the model's context length: the scorer gets exactly the last ``context``
    steps, in time order, which also bounds every group.
    """
    token = uuid.uuid4().hex

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return score_fn(_model(token, load_fn), rows.sort_values(STAMP, ignore_index=True))

    return recent_context(series, context, freq).groupBy(ITEM).applyInPandas(run, schema)
