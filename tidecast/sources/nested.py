"""Nested forecast requests and responses.

A request body is ``{"inputs": [{item_id, start, target, past_covariates, future_covariates,
static_features}, ...], "parameters": {freq, prediction_length, quantile_levels}}``.
Bodies are bounded documents (a few MB), one per row; opening them is row-local work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.frequency import named_frequency, stamp_at_named
from tidecast.operators.columns import ITEM, STAMP, TARGET, col

# What a request gets when it leaves a field out.
DEFAULT_START = "2020-01-01"
DEFAULT_FREQ = "D"
DEFAULT_HORIZON = 1
REQUEST_BYTES = 5 * 1024 * 1024  # what the service being replaced takes in one request

_BODY = (
    "inputs array<struct<item_id:string,start:string,target:array<double>,"
    "past_covariates:map<string,array<double>>,future_covariates:map<string,array<double>>,"
    "static_features:map<string,string>>>,"
    "parameters struct<prediction_length:int,freq:string,quantile_levels:array<double>>"
)
_BROKEN = "_broken"


def parse_bodies(bodies: DataFrame, body: str = "body", request: str = "request_id") -> DataFrame:
    """One row per (request, item), options filled in. Malformed bodies are an error."""
    parsed = bodies.select(col(request).alias("request_id"), F.from_json(col(body), _BODY, {"mode": "FAILFAST"}).alias("b"))
    empty = F.raise_error(F.lit("a request needs `inputs`"))
    parsed = parsed.withColumn("b", F.when(F.col("b.inputs").isNotNull(), F.col("b")).otherwise(empty))
    return _open(parsed)


def judged_bodies(
    bodies: DataFrame,
    body: str = "body",
    request: str = "request_id",
    max_bytes: int | None = REQUEST_BYTES,
    freq: str | None = None,
    horizon: int | None = None,
    covariates: Sequence[str] = (),
) -> DataFrame:
    """(request_id, digest, b, error) per request: its parsed body, and why it can't be answered.

    ``error`` is null for a good request. A fitted model's ``freq``, ``horizon`` and ``covariates``
    add its own demands. Everything is found within the row; nothing is raised. The same body under
    the same id is one request however often it comes, and ``digest`` tells different ones apart.
    """
    once = bodies.select(col(request).alias("request_id"), col(body).cast("string").alias("body")).dropDuplicates()
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    parsed = once.select(
        "request_id",
        F.xxhash64("body").alias("digest"),
        F.octet_length("body").alias("bytes"),
        F.from_json("body", f"{_BODY},{_BROKEN} string", options).alias("b"),
    )
    inputs, parameters = F.col("b.inputs"), F.col("b.parameters")
    given = F.coalesce(parameters["freq"], F.lit(freq or DEFAULT_FREQ))
    levels = parameters["quantile_levels"]
    bad_start = F.exists(inputs, lambda i: i["start"].isNotNull() & i["start"].try_cast("timestamp_ntz").isNull())
    future = "future_covariates"
    some, every = (test(inputs, lambda i: i[future].isNotNull()) for test in (F.exists, F.forall))
    steps = F.lit(horizon) if horizon is not None else F.coalesce(parameters["prediction_length"], F.lit(DEFAULT_HORIZON))
    named = [_all_name(inputs, future, c) for c in covariates]
    wide = [future] if not covariates else list(covariates)
    short = (
        F.exists(inputs, lambda i: F.exists(F.map_values(i[future]), lambda v: F.size(v) != steps))
        if not covariates
        else F.exists(inputs, lambda i: F.greatest(*[F.size(i[future][c]) != steps for c in covariates], F.lit(False)))
    )
    faults = [
        (F.col("bytes") > max_bytes if max_bytes is not None else F.lit(False), f"the body has more than {max_bytes} bytes"),
        (F.col("b").isNull() | F.col(f"b.{_BROKEN}").isNotNull(), "the body is not the JSON of a request"),
        (inputs.isNull(), "a request needs `inputs`"),
        (F.exists(inputs, lambda i: i["target"].isNull()), "an item has no `target`"),
        (named_frequency(given).isNull(), "unknown frequency"),
        (bad_start, "an item's `start` is no timestamp"),
        (F.coalesce(parameters["prediction_length"], F.lit(1)) < 1, "`prediction_length` must be at least 1"),
        (F.exists(levels, lambda q: q.isNull() | (q <= 0) | (q >= 1)), "quantile levels must lie strictly between 0 and 1"),
        (some & ~every, "either all items or none have `future_covariates`"),
    ]
    if freq is not None:
        faults.append((named_frequency(given) != freq, f"the model's frequency is {freq}"))
    if covariates:
        faults.append((~F.coalesce(F.least(*named, every), F.lit(False)), f"the model needs future values of {', '.join(covariates)}"))
    faults.append((short, f"{', '.join(wide)} must have one value per horizon step"))
    error = F.coalesce(*[F.when(fault, F.lit(text)) for fault, text in faults])
    return parsed.select("request_id", "digest", "b", error.alias("error"))


def _all_name(inputs: Column, field: str, name: str) -> Column:
    return F.forall(inputs, lambda i: i[field][name].isNotNull())


def open_requests(judged: DataFrame, freq: str | None = None, horizon: int | None = None) -> DataFrame:
    """One row per item of the good requests of ``judged_bodies``, options filled in.

    A fitted model's ``freq`` stands in for a missing one, and its ``horizon`` for any.
    """
    return _open(judged.where("error IS NULL"), freq or DEFAULT_FREQ, horizon)


def _open(parsed: DataFrame, default_freq: str = DEFAULT_FREQ, horizon: int | None = None) -> DataFrame:
    freq = F.coalesce("b.parameters.freq", F.lit(default_freq))
    asked = F.coalesce("b.parameters.prediction_length", F.lit(DEFAULT_HORIZON))
    horizon = asked if horizon is None else F.lit(horizon)
    marks = [c for c in ("digest",) if c in parsed.columns]
    any_future = F.exists("b.inputs", lambda i: i["future_covariates"].isNotNull())
    return parsed.select(
        "request_id",
        *marks,
        freq.alias("freq"),
        horizon.alias("prediction_length"),
        F.array_sort("b.parameters.quantile_levels").alias("quantile_levels"),
        any_future.alias("any_future"),
        F.posexplode("b.inputs").alias("pos", "i"),
    ).select(
        "request_id",
        *marks,
        "freq",
        "prediction_length",
        "quantile_levels",
        "any_future",
        "pos",
        F.coalesce("i.item_id", F.col("pos").cast("string")).alias(ITEM),
        F.coalesce("i.start", F.lit(DEFAULT_START)).cast("timestamp_ntz").alias("start"),
        _needed(F.col("i.target"), "target").alias(TARGET),
        F.col("i.past_covariates").alias("past_covariates"),
        F.col("i.future_covariates").alias("future_covariates"),
        F.col("i.static_features").alias("static_features"),
    )


def _needed(value: Column, name: str) -> Column:
    message = F.concat(F.lit(f"a request item has no `{name}`: "), F.coalesce("i.item_id", F.lit("unnamed")))
    return F.when(value.isNull(), F.raise_error(message).cast("array<double>")).otherwise(value)


def _named(values: str, names: Sequence[str], at: Column) -> list[Column]:
    return [F.get(F.col(values)[name], at).alias(name) for name in names]


def series_from_requests(items: DataFrame, covariates: Sequence[str] = ()) -> DataFrame:
    """Long history of parsed bodies: (request_id, pos, item_id, timestamp, target, ...)."""
    opened = items.select(
        "request_id", "pos", ITEM, "start", "freq", "past_covariates", F.posexplode(TARGET).alias("k", TARGET)
    )
    stamp = stamp_at_named(F.col("start"), F.col("k"), F.col("freq"))
    return opened.select(
        "request_id", "pos", ITEM, stamp.alias(STAMP), TARGET, *_named("past_covariates", covariates, F.col("k"))
    )


def covariates_from_requests(items: DataFrame, covariates: Sequence[str]) -> DataFrame:
    """Future covariates on the horizon's timestamps, only for requests that carry any.

    If one item of a request has them, all must; every list must be as long as the horizon.
    """
    last = F.size(TARGET) - 1
    given = F.col("future_covariates")
    lacking = F.concat(F.lit("no `future_covariates` for item "), F.col(ITEM))
    short = F.concat(F.lit("`future_covariates` must have one value per horizon step for item "), F.col(ITEM))
    full = F.forall(F.map_values(given), lambda v: F.size(v) == F.col("prediction_length"))
    checked = (
        F.when(given.isNull(), F.raise_error(lacking).cast("map<string,array<double>>"))
        .when(~full, F.raise_error(short).cast("map<string,array<double>>"))
        .otherwise(given)
    )
    steps = (
        items.filter("any_future")
        .withColumn("future_covariates", checked)
        .withColumn("h", F.explode(F.sequence(F.lit(1), F.col("prediction_length"))))
    )
    stamp = stamp_at_named(F.col("start"), last + F.col("h"), F.col("freq"))
    return steps.select(
        "request_id", "pos", ITEM, stamp.alias(STAMP), *_named("future_covariates", covariates, F.col("h") - 1)
    )


def series_from_nested_json(
    bodies: DataFrame, covariates: Sequence[str] = (), body: str = "body", request: str = "request_id"
) -> DataFrame:
    return series_from_requests(parse_bodies(bodies, body, request), covariates)


def covariates_from_nested_json(
    bodies: DataFrame, covariates: Sequence[str], body: str = "body", request: str = "request_id"
) -> DataFrame:
    return covariates_from_requests(parse_bodies(bodies, body, request), covariates)


def items_to_lists(forecast: DataFrame, by: Sequence[str] = (ITEM,), order: str = STAMP) -> DataFrame:
    """One row per item of a *forecast* table, every column as a list in time order.

    Meant for forecasts, whose rows per item are bounded by the horizon.
    """
    values = [c for c in forecast.columns if c not in by and c != order]
    packed = F.sort_array(F.collect_list(F.struct(order, *map(col, values))))
    grouped = forecast.groupBy(*by).agg(packed.alias("rows"))
    return grouped.select(*by, *[_field_list("rows", c) for c in (order, *values)])


def _field_list(rows: str, name: str) -> Column:
    return F.transform(rows, lambda r: r.getField(name)).alias(name)


def forecast_to_nested_json(forecast: DataFrame) -> DataFrame:
    """Forecast as one JSON object per item: (item_id, prediction).

    Each column is a list; ``item_id`` is text and ``start`` the first timestamp. A response
    body is these objects in a list; building one per row keeps any number of items in play.
    """
    values = [c for c in forecast.columns if c not in (ITEM, STAMP)]
    lists = items_to_lists(forecast)
    start = F.date_format(F.element_at(STAMP, 1), "yyyy-MM-dd'T'HH:mm:ss")
    record = F.struct(*[col(c) for c in values], F.col(ITEM).cast("string").alias(ITEM), start.alias("start"))
    return lists.select(F.col(ITEM).cast("string").alias(ITEM), F.to_json(record).alias("prediction"))


def response_bodies(forecast: DataFrame, request: str = "request_id") -> DataFrame:
    """(request_id, body) with body ``{"predictions": [...]}``; a request's items are bounded."""
    values = [c for c in forecast.columns if c not in (request, ITEM, STAMP, "pos")]
    lists = items_to_lists(forecast, (request, "pos", ITEM))
    start = F.date_format(F.element_at(STAMP, 1), "yyyy-MM-dd'T'HH:mm:ss")
    record = F.struct("pos", F.struct(*[col(c) for c in values], ITEM, start.alias("start")).alias("p"))
    ordered = F.transform(F.sort_array(F.collect_list(record)), lambda r: r.getField("p"))
    return lists.groupBy(request).agg(F.to_json(F.struct(ordered.alias("predictions"))).alias("body"))
