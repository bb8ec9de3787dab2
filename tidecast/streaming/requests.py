"""Forecast requests: nested bodies or long tables, answered in one plan per batch.

Frequency, season, horizon and quantile levels are values of a request's row, never part of the
plan, so a batch of any mixture of requests has the same plan as one request. Requests that cannot
be answered go to an error table beside the answers and leave the others alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidecast.functions.frequency import season_named, stamp_at_named
from tidecast.functions.quantiles import level_name, sorted_levels, z_column
from tidecast.operators.baseline import baseline_mean_sigma
from tidecast.operators.columns import ITEM, STAMP, TARGET, col
from tidecast.plans.forecast import ForecastModel
from tidecast.sources.nested import (
    REQUEST_BYTES,
    covariates_from_requests,
    judged_bodies,
    open_requests,
    series_from_requests,
)

KEYS = ("request_id", "pos", ITEM)
QUANTILES = "quantiles"  # map of level name to value, however many levels a request has
_ANSWER = ("request_id", "pos", ITEM, STAMP, "mean", QUANTILES)


# -- closed forms ----------------------------------------------------------------------------------


def request_statistics(items: DataFrame, seasonal: bool = True) -> DataFrame:
    """One row per request item with what the closed forms need, ``season`` being a column.

    Bodies hold gap-free series, so a value's place in its list is its step and lagged values are the
    list moved along itself: rows are opened once and only partial sums leave their task. With
    ``seasonal``, sums are first taken per season position, which also gives each position's latest
    value.
    """
    size = F.size(TARGET)

    def moved(by: Column) -> Column:
        by = F.least(by, size)
        return F.concat(F.array_repeat(F.lit(None).cast("double"), by.cast("int")), F.slice(TARGET, F.lit(1), (size - by).cast("int")))

    keys = ["key", "request_id", "pos", ITEM, "start", "freq", "prediction_length", "quantile_levels", "season"]
    lists = items.withColumn("season", season_named(F.col("freq")))
    lists = lists.select(*keys, F.col(TARGET).alias("y"), moved(F.lit(1)).alias("y1"), moved(F.col("season")).alias("ym"))
    rows = lists.select(*keys, F.posexplode_outer(F.arrays_zip("y", "y1", "ym")).alias("step", "v"))
    rows = rows.select(*keys, F.col("step").cast("bigint").alias("step"), F.col("v.y").alias("y"), "v.y1", "v.ym")
    y, seen = F.col("y"), F.when(F.col("y").isNotNull(), F.col("step"))
    d1, dm = y - F.col("y1"), y - F.col("ym")
    sums = {
        "n": F.count(y),
        "n1": F.count(d1),
        "sum_d1": F.sum(d1),
        "ss_d1": F.sum(d1 * d1),
        "nm": F.count(dm),
        "ss_dm": F.sum(dm * dm),
    }
    ends = {"last_step": F.max("step"), "first_step": F.min(seen), "last_seen": F.max(seen)}
    if seasonal:
        phase = F.pmod("step", F.col("season"))
        each = rows.withColumn("phase", phase).groupBy(*keys, "phase").agg(
            *(c.alias(n) for n, c in {**sums, **ends}.items()), F.max_by(y, seen).alias("value")
        )
        slots = F.collect_list(F.when(F.col("value").isNotNull(), F.struct("phase", "value")))
        stats = each.groupBy(*keys).agg(
            *(F.sum(n).alias(n) for n in sums),
            F.max_by("value", "last_seen").alias("y_last"),
            *(F.max(n).alias(n) for n in ("last_step", "last_seen")),
            F.min("first_step").alias("first_step"),
            F.map_from_entries(slots).alias("by_phase"),
        )
    else:
        x = F.col("step").cast("double")
        stats = rows.groupBy(*keys).agg(
            *(c.alias(n) for n, c in {**sums, **ends}.items()),
            F.max_by(y, seen).alias("y_last"),
            F.min_by(y, seen).alias("y_first"),
            F.avg(y).alias("y_mean"),
            F.var_samp(y).alias("y_var"),
            F.regr_avgx(y, x).alias("x_bar"),
            F.regr_avgy(y, x).alias("y_bar"),
            F.regr_sxx(y, x).alias("sxx"),
            F.regr_syy(y, x).alias("syy"),
            F.regr_sxy(y, x).alias("sxy"),
        )
    # An item without values still has a last step, the one before its start.
    return stats.withColumn("last_step", F.coalesce("last_step", F.lit(-1).cast("bigint")))


def _with_key(items: DataFrame) -> DataFrame:
    """A text key of each request item, whatever is null in it; it can be read back by ``_KEY``."""
    return items.withColumn("key", F.to_json(F.struct("request_id", "digest", "pos", ITEM)))


_KEY = "request_id string, digest bigint, pos int, item_id string"


def answer_requests(judged: DataFrame, model: str = "seasonal_naive", levels: Sequence[float] | None = None) -> DataFrame:
    """(request_id, pos, item_id, timestamp, mean, quantiles) for the good ones of ``judged_bodies``.

    Runs no job. A request's own levels win over ``levels``; items without values get nulls.
    """
    stats = request_statistics(_with_key(open_requests(judged)), model == "seasonal_naive")
    usual = F.array(*map(F.lit, sorted_levels(levels)))
    wanted = F.array_sort(F.array_distinct(F.coalesce("quantile_levels", usual)))
    stats = stats.withColumn("names", F.transform(wanted, lambda q: q.cast("string"))).withColumn("zs", F.transform(wanted, z_column))
    steps = stats.withColumn("h", F.explode(F.sequence(F.lit(1), F.col("prediction_length"))))
    mean, sigma = baseline_mean_sigma(model, F.col("season"), F.col("h"))
    rows = steps.select(
        *KEYS,
        stamp_at_named(F.col("start"), F.col("last_step") + F.col("h"), F.col("freq")).alias(STAMP),
        mean.cast("double").alias("mean"),
        F.coalesce(sigma, F.lit(0.0)).alias("spread"),
        "names",
        "zs",
    )
    values = F.transform("zs", lambda z: F.col("mean") + z * F.col("spread"))
    return rows.withColumn(QUANTILES, F.map_from_arrays("names", values)).select(*_ANSWER)


# -- fitted models ---------------------------------------------------------------------------------


def judge_for(model: "ForecastModel | str", bodies: DataFrame, max_bytes: int | None = REQUEST_BYTES) -> DataFrame:
    """``judged_bodies`` with the demands of ``model``, a fitted one or a closed form's name."""
    if isinstance(model, str):
        return judged_bodies(bodies, max_bytes=max_bytes)
    return judged_bodies(bodies, max_bytes=max_bytes, freq=str(model.freq), horizon=model.horizon, covariates=model.known_names)


def _static_column(model: ForecastModel, name: str) -> Column:
    value = F.col("static_features")[name]
    text = model.regression is not None and name in model.regression.text
    return (value if text else value.try_cast("double")).alias(name)


def answer_with(model: ForecastModel, judged: DataFrame) -> DataFrame:
    """As ``answer_requests``, by a fitted model whose horizon, levels and frequency hold.

    Future covariates come from the bodies and are joined to the model's own future rows by
    (request, item, step); past ones and static features too, and what a body leaves out counts as
    missing. All requests are one table of series to the model, so it runs once per batch.
    """
    items = _with_key(open_requests(judged, str(model.freq), model.horizon)).withColumn(ITEM, F.col("key"))
    series = series_from_requests(items, model.known_names).select(ITEM, STAMP, TARGET, *map(col, model.known_names))
    known = static = None
    if model.known_names:
        known = covariates_from_requests(items, model.known_names).select(ITEM, STAMP, *map(col, model.known_names))
    if model.static_names:
        static = items.select(ITEM, *(_static_column(model, name) for name in model.static_names))
    table = _predicted(model, series, known, static)
    parts = F.from_json(ITEM, _KEY)
    return table.select(
        parts["request_id"].alias("request_id"), parts["pos"].alias("pos"), parts["item_id"].alias(ITEM), STAMP, "mean", _packed(model.levels)
    )


def _predicted(model: ForecastModel, series: DataFrame, known: DataFrame | None, static: DataFrame | None) -> DataFrame:
    """Predict from canonical tables, whatever the model's own column names are."""
    own = {ITEM: model.id_column, STAMP: model.timestamp_column, TARGET: model.target}
    return model.predict(*(None if t is None else t.withColumnsRenamed(own) for t in (series, known, static)))


def _packed(levels: Sequence[float]) -> Column:
    pairs = [x for q in levels for x in (F.lit(level_name(q)), col(level_name(q)))]
    return (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")).alias(QUANTILES)


def forecast_tables(
    model: ForecastModel,
    rows: DataFrame,
    known: DataFrame | None = None,
    static: DataFrame | None = None,
    request: str = "request_id",
    id_column: str | None = None,
    timestamp_column: str | None = None,
) -> DataFrame:
    """Forecasts (request_id, item_id, timestamp, mean, quantiles) for requests that are long tables.

    ``rows`` holds many requests' series, told apart by ``request``; so do ``known`` and ``static``.
    Item and time columns are the model's unless the requests name others. Items of different
    requests are different series, whatever they are called.
    """
    item, stamp = id_column or model.id_column, timestamp_column or model.timestamp_column
    key = F.to_json(F.struct(col(request).cast("string").alias("request_id"), col(item).cast("string").alias(ITEM)))

    def keyed(df: DataFrame | None, *names: str) -> DataFrame | None:
        if df is None:
            return None
        missing = [c for c in (request, item, *names) if c not in df.columns]
        if missing:
            raise ValueError(f"the requests lack {', '.join(missing)}")
        given = [c for c in df.columns if c not in (request, item, stamp, model.target)]
        kept = [c for c in given if c in (*model.known_names, *model.static_names)]
        return df.select(key.alias(ITEM), *(col(n).alias(a) for n, a in zip(names, (STAMP, TARGET))), *map(col, kept))

    series = keyed(rows, stamp, model.target)
    table = _predicted(model, series, keyed(known, stamp), keyed(static))
    parts = F.from_json(ITEM, "request_id string, item_id string")
    return table.select(parts["request_id"].alias("request_id"), parts["item_id"].alias(ITEM), STAMP, "mean", _packed(model.levels))


# -- batches and streams ---------------------------------------------------------------------------


def _answers(judged: DataFrame, model: "ForecastModel | str", levels: Sequence[float] | None) -> DataFrame:
    return answer_requests(judged, model, levels) if isinstance(model, str) else answer_with(model, judged)


def refused(judged: DataFrame) -> DataFrame:
    """(request_id, error) of the requests that cannot be answered."""
    return judged.where("error IS NOT NULL").select("request_id", "error")


def _all_good(judged: DataFrame) -> DataFrame:
    """The same requests; reading a bad one is an error."""
    message = F.concat(F.lit("request "), F.coalesce("request_id", F.lit("null")), F.lit(": "), F.col("error"))
    return judged.withColumn("error", F.when(F.col("error").isNotNull(), F.raise_error(message).cast("string")))


def forecast_requests(
    bodies: DataFrame, model: "ForecastModel | str" = "seasonal_naive", levels: Sequence[float] | None = None
) -> DataFrame:
    """Forecast every request of a batch of nested bodies, with a column per level that occurs.

    A request that cannot be answered is an error here; ``judge_for`` and ``refused`` tell which
    ones are. Runs one small job for the names of the levels. ``answer_requests`` runs none and
    leaves the quantiles in a map.
    """
    return level_columns(_answers(_all_good(judge_for(model, bodies)), model, levels))


def level_columns(answers: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Quantiles as columns, one per level name; those that occur unless given."""
    if names is None:
        found = answers.select(F.explode(F.map_keys(QUANTILES)).alias("name")).distinct().collect()
        names = sorted((r.name for r in found), key=float)
    rest = [c for c in answers.columns if c != QUANTILES]
    return answers.select(*map(col, rest), *(F.col(QUANTILES)[name].alias(name) for name in names))


def forecast_stream(
    bodies: DataFrame,
    name: str,
    output: str,
    checkpoint: str,
    model: "ForecastModel | str" = "seasonal_naive",
    levels: Sequence[float] | None = None,
    available_now: bool = False,
    errors: str | None = None,
    max_bytes: int | None = REQUEST_BYTES,
) -> StreamingQuery:
    """Forecast a stream of (request_id, body) rows into Parquet folders, one per micro-batch.

    ``model`` is a closed form's name or a fitted model. Each request carries its own history, so
    results do not depend on batch boundaries. A repeated micro-batch replaces its own folders,
    which makes restarts exact. With ``errors``, requests that are too large or cannot be answered
    go to that folder as (request_id, error) in the same micro-batch; without it they end the query.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        judged = judge_for(model, batch, max_bytes).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            checked = judged if errors is not None else _all_good(judged)
            _answers(checked, model, levels).write.mode("overwrite").parquet(f"{output}/batch={batch_id}")
            if errors is not None:
                refused(judged).write.mode("overwrite").parquet(f"{errors}/batch={batch_id}")
        finally:
            judged.unpersist()

    return _started(bodies, name, checkpoint, available_now, handle)


def table_stream(
    rows: DataFrame,
    name: str,
    output: str,
    checkpoint: str,
    model: ForecastModel,
    available_now: bool = False,
    known: DataFrame | None = None,
    static: DataFrame | None = None,
    request: str = "request_id",
    id_column: str | None = None,
    timestamp_column: str | None = None,
) -> StreamingQuery:
    """Forecast a stream of long-table requests by a fitted model; a request is within one file.

    ``known`` and ``static`` are stored tables, read again for every micro-batch.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            answers = forecast_tables(model, held, known, static, request, id_column, timestamp_column)
            answers.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")
        finally:
            held.unpersist()

    return _started(rows, name, checkpoint, available_now, handle)


def _started(stream: DataFrame, name: str, checkpoint: str, available_now: bool, handle) -> StreamingQuery:
    writer = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(handle)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_forecasts(spark: SparkSession, output: str, levels: Sequence[float] | None = None) -> DataFrame:
    """Everything a forecast stream has written so far, with a column per level."""
    names = None if levels is None else [level_name(q) for q in sorted_levels(levels)]
    return level_columns(spark.read.parquet(output).drop("batch"), names)


def read_refused(spark: SparkSession, errors: str) -> DataFrame:
    """(request_id, error) of all requests a forecast stream has refused so far."""
    return spark.read.parquet(errors).drop("batch")
