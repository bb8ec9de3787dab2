"""Scoring streams of rows; forecast requests are in ``requests``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidecast.operators.columns import align_columns
from tidecast.operators.series import join_known, join_static
from tidecast.plans.tabular import TabularModel
from tidecast.streaming.requests import forecast_requests, forecast_stream, read_forecasts  # noqa: F401


def predict_stream(model: TabularModel, requests: DataFrame, keys: Sequence[str], name: str | None = None) -> DataFrame:
    """Predictions for a stream of rows; stateless, so no shuffle and no watermark."""
    return model.predict(_trimmed(model, requests, keys), keys=keys, model=name)


def predict_proba_stream(
    model: TabularModel, requests: DataFrame, keys: Sequence[str], name: str | None = None
) -> DataFrame:
    """Prediction frame with probability columns for a stream of rows, same options as batch."""
    return model.score(_trimmed(model, requests, keys), keys=keys, model=name)


def _trimmed(model: TabularModel, requests: DataFrame, keys: Sequence[str]) -> DataFrame:
    needed = model.schema.fieldNames()
    return align_columns(requests, [*keys, *(c for c in needed if c not in keys)])


def with_side_inputs(
    stream: DataFrame, static: DataFrame | None = None, known: DataFrame | None = None
) -> DataFrame:
    """Stream of series rows with static features and covariates from stored tables.

    The tables are read again for every micro-batch, so updates to them are picked up.
    """
    if static is not None:
        stream = join_static(stream, static)
    if known is not None:
        stream = join_known(stream, known)
    return stream
