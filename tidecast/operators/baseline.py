"""Training-free forecasters as aggregates over each item.

All five models read the same per-item statistics, gathered in one pass; forecasts are
expressions over one row per item, opened to ``horizon`` rows only at the very end.
Uncertainty follows the textbook residual rules for each model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.frequency import Frequency
from tidecast.functions.quantiles import normal_quantiles
from tidecast.operators.chunks import refuse_duplicates, value_at_lag, with_halo
from tidecast.operators.columns import ITEM, STAMP, TARGET
from tidecast.operators.series import future_rows, with_step

BASELINES = ("naive", "seasonal_naive", "mean", "drift", "trend")
_NEEDS_LAG_1 = {"naive", "seasonal_naive", "drift"}


def item_statistics(
    series: DataFrame, freq, season: int, models: Sequence[str] = BASELINES, scale: bool = False, held: str | None = None
) -> DataFrame:
    """One row per item with what ``models`` need (and the seasonal scale when asked).

    The origin (last_timestamp, last_step) comes from all rows; null targets only stay out of the
    statistics, so an item of nulls has a row without any. The series is read once and its rows are
    shuffled once.

    Rows whose column ``held`` is true count for nothing but ``actuals``, an array of their (step,
    timestamp, actual); items without other rows have no row.
    """
    freq = Frequency.parse(freq)
    lags = set()
    if _NEEDS_LAG_1 & set(models):
        lags.add(1)
    if "seasonal_naive" in models or scale:
        lags.add(season)
    past = F.lit(True) if held is None else ~F.col("held")
    marked = [] if held is None else [F.col(held).alias("held")]
    rows = with_step(series, freq).select(ITEM, STAMP, "step", TARGET, *marked)
    kept = [c for c in rows.columns if c != TARGET]
    if lags:
        rows = with_halo(rows, max(lags))
        change = {lag: (F.col(TARGET) - value_at_lag(F.col(TARGET), lag)).alias(f"d{lag}") for lag in lags}
        rows = rows.select(*kept, "in_halo", refuse_duplicates(F.col(TARGET)).alias(TARGET), *change.values()).filter(
            ~F.col("in_halo")
        )
    y, x = F.when(past, F.col(TARGET)), F.col("step").cast("double")
    seen = F.when(y.isNotNull(), F.col("step"))
    wanted = [
        F.count(y).alias("n"),
        F.max(F.when(past, F.col(STAMP))).alias("last_timestamp"),
        F.min(seen).alias("first_step"),
        F.max(F.when(past, F.col("step"))).alias("last_step"),
        F.max(seen).alias("last_seen"),
        F.max_by(y, seen).alias("y_last"),
    ]
    if "mean" in models:
        wanted += [F.avg(y).alias("y_mean"), F.var_samp(y).alias("y_var")]
    if "drift" in models:
        wanted.append(F.min_by(y, seen).alias("y_first"))
    if "trend" in models:
        wanted += [
            F.regr_avgx(y, x).alias("x_bar"),
            F.regr_avgy(y, x).alias("y_bar"),
            F.regr_sxx(y, x).alias("sxx"),
            F.regr_syy(y, x).alias("syy"),
            F.regr_sxy(y, x).alias("sxy"),
        ]
    if 1 in lags:
        d1 = F.when(past, F.col("d1"))
        wanted += [F.count(d1).alias("n1"), F.sum(d1).alias("sum_d1"), F.sum(d1 * d1).alias("ss_d1")]
    if season in lags:
        dm = F.when(past, F.col(f"d{season}"))
        wanted += [
            F.count(dm).alias("nm"),
            F.sum(dm * dm).alias("ss_dm"),
            F.avg(F.abs(dm)).alias("scale_abs"),
            F.avg(dm * dm).alias("scale_sq"),
        ]
    if held is not None:
        actual = F.struct("step", F.col(STAMP).alias("timestamp"), F.col(TARGET).alias("actual"))
        wanted.append(F.collect_list(F.when(~past, actual)).alias("actuals"))
    if "seasonal_naive" in models:
        # Grouping sets give an item's statistics and, in at most ``season`` small rows more, the
        # latest value seen in each season position.
        phased = rows.withColumn("phase", F.pmod("step", F.lit(season)))
        both = phased.groupingSets([[ITEM], [ITEM, "phase"]], ITEM, "phase").agg(*wanted, F.grouping("phase").alias("whole"))
        whole = F.col("whole") == 1
        names = [c for c in both.columns if c not in (ITEM, "phase", "whole")]
        entry = F.when(~whole & F.col("y_last").isNotNull(), F.struct("phase", F.col("y_last").alias("value")))
        stats = both.groupBy(ITEM).agg(
            *[F.first(F.when(whole, F.col(c)), ignorenulls=True).alias(c) for c in names],
            F.map_from_entries(F.collect_list(entry)).alias("by_phase"),
        )
    else:
        stats = rows.groupBy(ITEM).agg(*wanted)
    return stats if held is None else stats.filter(F.col("last_step").isNotNull())


def _safe_sqrt(value: Column) -> Column:
    return F.sqrt(F.greatest(value, F.lit(0.0)))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom)


def baseline_mean_sigma(model: str, season: "int | Column", h: Column) -> tuple[Column, Column]:
    """(mean, sigma) of ``model`` at step ``h``, over a row of ``item_statistics``.

    The season may be a column, so that rows of several frequencies share a plan.
    """
    season = season if isinstance(season, Column) else F.lit(season)
    n, last = F.col("n"), F.col("y_last")
    away = F.col("last_step") - F.col("last_seen") + h  # steps since the last observed value
    if model in ("naive", "seasonal_naive"):
        naive_sigma = F.sqrt(_ratio(F.col("ss_d1"), F.col("n1"))) * F.sqrt(away)
    if model == "naive":
        return last, naive_sigma
    if model == "seasonal_naive":
        # Histories shorter than one season fall back to the naive forecast.
        short = F.col("last_seen") - F.col("first_step") + 1 < season
        phase = F.pmod(F.col("last_step") + h, season)
        seasonal = F.coalesce(F.element_at(F.col("by_phase"), phase), last)
        rounds = F.floor((away - 1) / season)
        sigma = F.sqrt(_ratio(F.col("ss_dm"), F.col("nm"))) * F.sqrt(rounds + 1)
        return F.when(short, last).otherwise(seasonal), F.when(short, naive_sigma).otherwise(sigma)
    if model == "mean":
        return F.col("y_mean"), F.sqrt(F.col("y_var")) * F.sqrt(1 + _ratio(F.lit(1.0), n))
    if model == "drift":
        span = F.col("last_seen") - F.col("first_step")
        slope = F.coalesce(_ratio(last - F.col("y_first"), span), F.lit(0.0))
        ss = F.col("ss_d1") - 2 * slope * F.col("sum_d1") + F.col("n1") * slope * slope
        sigma = _safe_sqrt(_ratio(ss, F.col("n1") - 1)) * F.sqrt(away * (1 + _ratio(away, span)))
        return last + away * slope, sigma
    if model == "trend":
        slope = F.coalesce(_ratio(F.col("sxy"), F.col("sxx")), F.lit(0.0))
        off = F.col("last_step") + h - F.col("x_bar")
        residual = F.col("syy") - slope * F.col("sxy")
        sigma = _safe_sqrt(_ratio(residual, n - 2)) * F.sqrt(1 + _ratio(F.lit(1.0), n) + _ratio(off * off, F.col("sxx")))
        return F.col("y_bar") + slope * off, sigma
    raise ValueError(f"unknown baseline {model!r}; known: {BASELINES}")


def forecast_rows(
    stats: DataFrame, models: Sequence[str], horizon: int, freq, season: int, keep: Sequence[str] = ()
) -> DataFrame:
    """Open per-item statistics into (item_id, timestamp, h, model, mean, sigma)."""
    return _mean_sigma_rows(future_rows(stats, horizon, freq), models, season, keep)


def _mean_sigma_rows(ahead: DataFrame, models: Sequence[str], season: int, keep: Sequence[str]) -> DataFrame:
    h = F.col("h")
    if len(models) == 1:
        mean, sigma = baseline_mean_sigma(models[0], season, h)
        return ahead.select(
            ITEM, STAMP, "h", F.lit(models[0]).alias("model"), mean.alias("mean"), sigma.alias("sigma"), *keep
        )
    options = []
    for model in models:
        mean, sigma = baseline_mean_sigma(model, season, h)
        options.append(
            F.struct(
                F.lit(model).alias("model"), mean.cast("double").alias("mean"), sigma.cast("double").alias("sigma")
            )
        )
    return ahead.select(ITEM, STAMP, "h", F.explode(F.array(*options)).alias("m"), *keep).select(
        ITEM, STAMP, "h", "m.model", "m.mean", "m.sigma", *keep
    )


def baseline_forecast(
    series: DataFrame, horizon: int, freq, season: int, models: Sequence[str] = BASELINES
) -> DataFrame:
    stats = item_statistics(series, freq, season, models)
    return forecast_rows(stats, models, horizon, freq, season)


def backtest_rows(
    marked: DataFrame, horizon: int, freq, season: int, models: Sequence[str] = BASELINES, scale: bool = False
) -> DataFrame:
    """Forecasts of the held-out steps beside what was seen there: the rows that
    ``score_rows`` takes, with ``scale_abs`` and ``scale_sq`` when asked.

    ``marked`` is a series as ``last_steps`` gives it for this horizon; after a gap before the held-out
    steps, those beyond the horizon aren't forecast. Statistics and held-out values leave one pass in
    one row per item, so forecasts meet their actual values without a join.
    """
    stats = item_statistics(marked, freq, season, models, scale, held="held_out")
    opened = stats.withColumn("a", F.explode("actuals")).withColumns(
        {STAMP: F.col("a.timestamp"), "h": F.col("a.step") - F.col("last_step"), "actual": F.col("a.actual")}
    )
    opened = opened.filter(F.col("h") <= horizon)
    keep = ["actual", *(["scale_abs", "scale_sq"] if scale else [])]
    return _mean_sigma_rows(opened, models, season, keep)


def as_forecast_table(rows: DataFrame, levels: Sequence[float], keep: Sequence[str] = ()) -> DataFrame:
    """(item_id, timestamp, mean, one column per level) from rows with mean and sigma."""
    mean = F.col("mean").cast("double")
    return rows.select(ITEM, STAMP, *keep, mean.alias("mean"), *normal_quantiles(mean, F.col("sigma"), levels))
