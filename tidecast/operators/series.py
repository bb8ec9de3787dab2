"""Long time-series tables: building, regularising, extending into the future."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.frequency import (
    Frequency,
    epoch_micros,
    grid_phase,
    on_anchor,
    stamp_at,
    step_index,
)
from tidecast.operators.chunks import CHUNK, chunk_index
from tidecast.operators.columns import ITEM, STAMP, TARGET, canonicalize, col, known_covariate_names


def to_series(
    df: DataFrame,
    id_column: str = ITEM,
    timestamp_column: str = STAMP,
    target: str = TARGET,
    static: DataFrame | None = None,
    static_id: str | None = None,
) -> DataFrame:
    """Canonical long table, with static features attached when given."""
    series = canonicalize(df, id_column, timestamp_column, target)
    if static is None:
        return series
    return join_static(series, static, static_id or id_column)


def duplicate_stamps(series: DataFrame) -> DataFrame:
    """(item, timestamp) pairs that occur more than once, with their counts."""
    return series.groupBy(ITEM, STAMP).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def join_static(series: DataFrame, static: DataFrame, id_column: str = ITEM) -> DataFrame:
    """Series with one row of static features per item.

    No broadcast hint: Spark broadcasts the static side when its measured size allows it and
    otherwise sort-merges, splitting hot items with the adaptive skew join.
    """
    keyed = static.select(
        F.col(id_column).cast("string").alias(ITEM), *[col(c) for c in static.columns if c != id_column]
    )
    return series.join(keyed, ITEM, "left")


def join_known(
    future: DataFrame, known: DataFrame, id_column: str = ITEM, timestamp_column: str = STAMP
) -> DataFrame:
    """Future index with the known covariates of the same item and timestamp."""
    keyed = canonicalize(known, id_column, timestamp_column, None)
    return future.join(keyed, [ITEM, STAMP], "left")


def missing_covariates(
    future: DataFrame, known: DataFrame, id_column: str = ITEM, timestamp_column: str = STAMP
) -> DataFrame:
    """Future rows that the covariate table does not cover (a null value counts as missing)."""
    names = known_covariate_names(known, id_column, timestamp_column)
    keyed = canonicalize(known, id_column, timestamp_column, None).dropna(subset=names or None)
    return future.select(ITEM, STAMP).join(keyed.select(ITEM, STAMP), [ITEM, STAMP], "left_anti")


def item_bounds(series: DataFrame) -> DataFrame:
    """First and last timestamp and number of rows per item."""
    return series.groupBy(ITEM).agg(
        F.min(STAMP).alias("first_timestamp"),
        F.max(STAMP).alias("last_timestamp"),
        F.count("*").alias("n_rows"),
    )


def future_rows(last: DataFrame, horizon: int, freq, stamp: str = "last_timestamp") -> DataFrame:
    """Expand one row per item into ``horizon`` rows with ``h`` and ``timestamp``."""
    ahead = last.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return ahead.withColumn(STAMP, stamp_at(F.col(stamp), F.col("h"), freq))


def future_index(series: DataFrame, horizon: int, freq) -> DataFrame:
    """The ``horizon`` timestamps after each item's last one, as (item_id, timestamp)."""
    if horizon < 1:
        raise ValueError("the horizon must be at least 1")
    last = series.groupBy(ITEM).agg(F.max(STAMP).alias("last_timestamp"))
    return future_rows(last, horizon, freq).select(ITEM, STAMP)


def off_grid_items(series: DataFrame, freq) -> DataFrame:
    """Items whose timestamps do not lie on one grid of this frequency."""
    return (
        series.groupBy(ITEM)
        .agg(
            F.min(grid_phase(F.col(STAMP), freq)).alias("min_phase"),
            F.max(grid_phase(F.col(STAMP), freq)).alias("max_phase"),
            F.bool_and(on_anchor(F.col(STAMP), freq)).alias("anchored"),
        )
        .filter((F.col("min_phase") != F.col("max_phase")) | ~F.col("anchored"))
    )


def with_step(series: DataFrame, freq) -> DataFrame:
    return series.withColumn("step", step_index(F.col(STAMP), freq))


_START, _ROW, _END = 0, 1, 2


def regularize(series: DataFrame, freq, fill: "str | float | None" = None) -> DataFrame:
    """Put every item on the full grid; gaps get a null target unless ``fill`` says otherwise.

    ``fill`` is ``"ffill"`` (latest earlier value) or a number. Only observed rows and two
    markers per (item, chunk) are shuffled; each row then opens the gap up to its successor
    in place, so neither a join with the grid nor a whole item in one task is needed.
    """
    freq = Frequency.parse(freq)
    rest = [c for c in series.columns if c not in (ITEM, STAMP, TARGET)]
    observed = with_step(series, freq).withColumns({"chunk": chunk_index(F.col("step")), "kind": F.lit(_ROW)})
    bounds = observed.groupBy(ITEM).agg(
        F.min(STAMP).alias("first_timestamp"), F.min("step").alias("lo"), F.max("step").alias("hi")
    )
    chunks = bounds.withColumn("chunk", F.explode(F.sequence(chunk_index(F.col("lo")), chunk_index(F.col("hi")))))
    begin = F.greatest(F.col("lo"), F.col("chunk") * CHUNK)
    end = F.least(F.col("hi"), F.col("chunk") * CHUNK + (CHUNK - 1))
    starts = chunks.select(
        ITEM,
        "chunk",
        begin.alias("step"),
        stamp_at(F.col("first_timestamp"), begin - F.col("lo"), freq).alias(STAMP),
        F.lit(_START).alias("kind"),
    )
    if fill == "ffill":
        starts = _carried(starts, observed)
    ends = chunks.select(ITEM, "chunk", (end + 1).alias("step"), F.lit(_END).alias("kind"))
    rows = observed.unionByName(starts, allowMissingColumns=True).unionByName(ends, allowMissingColumns=True)

    window = Window.partitionBy(ITEM, "chunk").orderBy("step", "kind")
    following, next_kind = F.lead("step").over(window), F.lead("kind").over(window)
    twice = (F.col("kind") == _ROW) & (next_kind == _ROW) & (following == F.col("step"))
    message = F.concat(F.lit("duplicate timestamp for item "), F.col(ITEM))
    following = F.when(twice, F.raise_error(message).cast("bigint")).otherwise(following)
    value = F.col(TARGET)
    if fill == "ffill":
        value = F.last(TARGET, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    opened = rows.select(ITEM, STAMP, "step", "kind", value.alias(TARGET), *map(col, rest), following.alias("next"))
    opened = opened.filter((F.col("kind") != _END) & (F.col("next") > F.col("step")))
    opened = opened.withColumn("j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("next") - F.col("step") - 1)))
    here = (F.col("j") == 0) & (F.col("kind") == _ROW)
    target = F.col(TARGET) if fill == "ffill" else F.when(here, F.col(TARGET))
    if fill is not None and fill != "ffill":
        target = F.coalesce(target, F.lit(float(fill)))
    return opened.select(
        ITEM,
        stamp_at(F.col(STAMP), F.col("j"), freq).alias(STAMP),
        target.alias(TARGET),
        *[F.when(here, col(c)).alias(c) for c in rest],
    )


def _carried(starts: DataFrame, observed: DataFrame) -> DataFrame:
    """Chunk starts with the item's latest value from earlier chunks."""
    latest = (
        observed.filter(F.col(TARGET).isNotNull())
        .groupBy(ITEM, "chunk")
        .agg(F.max_by(TARGET, "step").alias("latest"))
    )
    before = Window.partitionBy(ITEM).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last("latest", ignorenulls=True).over(before)
    return starts.join(latest, [ITEM, "chunk"], "left").withColumn(TARGET, carried).drop("latest")


_SLICE_ROWS = f"{ITEM} string, gap_us long, n long, slice int, first_us long, last_us long"


def stamp_gaps(series: DataFrame) -> DataFrame:
    """Distance from each timestamp to the item's previous one, with its count.

    Returns (item_id, gap_us, n). Rows are range-partitioned by item and time, so slices hold about
    as many rows each however the stamps of an item are spread, and a burst or a hot item is several
    slices. A task walks its sorted slice in batches and sums gaps as it goes; what it can't see, the
    gap from an item's end in one slice to its beginning in the next, comes from a row per slice and
    item in a second pass. Exact for any spacing, with one shuffle of the series.
    """

    def walk(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        slice_number, before = TaskContext.get().partitionId(), None
        open_item = first = last = None

        def edge():
            return pa.RecordBatch.from_pylist(
                [{ITEM: open_item, "gap_us": None, "n": None, "slice": slice_number, "first_us": first, "last_us": last}], schema
            )

        schema = pa.schema(
            [(ITEM, pa.string()), ("gap_us", pa.int64()), ("n", pa.int64()), ("slice", pa.int32()), ("first_us", pa.int64()), ("last_us", pa.int64())]
        )
        for batch in batches:
            if not batch.num_rows:
                continue
            us = batch.column(1).to_numpy()
            items = batch.column(0).dictionary_encode()
            code, names = items.indices.fill_null(-1).to_numpy(zero_copy_only=False), items.dictionary.to_pylist()
            name = lambda c: None if c < 0 else names[c]
            same = np.append(before is not None and name(code[0]) == open_item, code[1:] == code[:-1])
            gap = np.diff(us, prepend=before if before is not None else us[0])
            found = pa.table({ITEM: batch.column(0), "gap_us": gap}).filter(pa.array(same))
            counted = found.group_by([ITEM, "gap_us"]).aggregate([([], "count_all")])
            none = pa.nulls(len(counted))
            yield from pa.table(
                [counted[ITEM].cast(pa.string()), counted["gap_us"], counted["count_all"], none.cast(pa.int32()), none.cast(pa.int64()), none.cast(pa.int64())],
                schema=schema,
            ).combine_chunks().to_batches()
            starts = np.flatnonzero(~same)
            for at, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(us)]):
                if first is not None:
                    yield edge()
                open_item, first, last = name(code[at]), int(us[at]), int(us[stop - 1])
            last = before = int(us[-1])
        if first is not None:
            yield edge()

    points = series.select(F.col(ITEM).cast("string").alias(ITEM), epoch_micros(F.col(STAMP)).alias("us")).where("us IS NOT NULL")
    walked = points.repartitionByRange(ITEM, "us").sortWithinPartitions(ITEM, "us").mapInArrow(walk, _SLICE_ROWS)
    ends = F.struct("slice", "first_us", "last_us")
    # An item has at most one row of ends per slice; partial sums come before every shuffle.
    summed = walked.groupBy(ITEM, "gap_us").agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_list(F.when(F.col("slice").isNotNull(), ends))).alias("ends")
    )
    number = lambda gap, n: F.struct(gap.alias("gap_us"), n.cast("bigint").alias("n"))
    nexts = F.slice("ends", F.lit(2), F.greatest(F.size("ends") - 1, F.lit(0)))
    across = F.transform(nexts, lambda e, i: number(e["first_us"] - F.get("ends", i)["last_us"], F.lit(1)))
    found = F.when(F.col("gap_us").isNotNull(), F.array(number(F.col("gap_us"), F.col("n")))).otherwise(across)
    gaps = summed.select(ITEM, F.explode(found).alias("g")).select(ITEM, "g.*")
    return gaps.groupBy(ITEM, "gap_us").agg(F.sum("n").alias("n"))


def item_frequency(series: DataFrame) -> DataFrame:
    """Per item: most common gap (ties: the smaller one) and the frequency code it means."""
    best = F.max_by(F.col("gap_us"), F.struct(F.col("n"), -F.col("gap_us")))
    modal = stamp_gaps(series).groupBy(ITEM).agg(
        best.alias("modal_gap_us"), F.max("gap_us").alias("max_gap_us"), F.min("gap_us").alias("min_gap_us")
    )
    shape = series.groupBy(ITEM).agg(
        *[F.bool_and(on_anchor(F.col(STAMP), unit)).alias(unit) for unit in ("MS", "ME", "QS", "QE", "YS", "YE", "B")],
        F.max(F.weekday(STAMP)).alias("hi_day"),
        F.min(F.weekday(STAMP)).alias("lo_day"),
    )
    joined = modal.join(shape, ITEM)
    return joined.select(ITEM, "modal_gap_us", _code(joined).alias("freq"))


def _code(df: DataFrame) -> Column:
    day = 86_400_000_000
    gap, days = F.col("modal_gap_us"), F.col("modal_gap_us") / 86_400_000_000
    weekday = F.element_at(F.array(*[F.lit(d) for d in ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")]), F.col("lo_day") + 1)
    business = F.col("B") & (F.col("max_gap_us") == 3 * day) & (F.col("min_gap_us") == day)

    def count(unit_us: int, code: str) -> Column:
        n = (gap / unit_us).cast("bigint")
        return F.when(n == 1, F.lit(code)).otherwise(F.concat(n.cast("string"), F.lit(code)))

    def whole(unit_us: int) -> Column:
        return F.pmod(gap, F.lit(unit_us)) == 0

    chain = F.when(business, "B")
    for unit, low, high in (
        ("YS", 365, 366), ("YE", 365, 366), ("QS", 90, 92), ("QE", 90, 92), ("MS", 28, 31), ("ME", 28, 31),
    ):
        chain = chain.when(F.col(unit) & days.between(low, high), unit)
    weekly = whole(7 * day) & (F.col("hi_day") == F.col("lo_day"))
    chain = chain.when(weekly & (gap == 7 * day), F.concat(F.lit("W-"), weekday))
    chain = chain.when(whole(day), count(day, "D"))
    for unit_us, code in ((3_600_000_000, "h"), (60_000_000, "min"), (1_000_000, "s")):
        chain = chain.when(whole(unit_us), count(unit_us, code))
    return chain


def infer_freq(series: DataFrame) -> str:
    """The one frequency all items share. Runs a job; raises when items disagree.

    An item whose usual gap is no frequency disagrees too. Items of a single timestamp say nothing.
    """
    codes = item_frequency(series).select("freq").distinct().limit(5).collect()
    found = sorted("irregular" if row.freq is None else row.freq for row in codes)
    if len(found) != 1 or found == ["irregular"]:
        raise ValueError(f"cannot infer one frequency, items show {found or 'none'}; pass freq=")
    return found[0]


def resolve_freq(series: DataFrame, freq=None) -> Frequency:
    """A given frequency wins; otherwise it is inferred."""
    return Frequency.parse(freq if freq is not None else infer_freq(series))


def season_length(freq, season: int | None = None) -> int:
    return season or Frequency.parse(freq).season


def stack_frames(*frames: DataFrame) -> DataFrame:
    """Union by name; columns a frame lacks become null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def order_items(df: DataFrame, by: str = ITEM) -> DataFrame:
    """Rows in item order (or by a caller-given ordinal), then time."""
    return df.orderBy(*dict.fromkeys((by, ITEM, STAMP)))


def check_forecast(forecast: DataFrame, items: DataFrame, horizon: int) -> DataFrame:
    """Items whose forecast is not exactly ``horizon`` rows, or is missing, or unexpected."""
    counts = forecast.groupBy(ITEM).agg(F.count("*").alias("n_rows"), F.countDistinct(STAMP).alias("n_stamps"))
    known = items.select(ITEM).distinct().withColumn("expected", F.lit(True))
    both = known.join(counts, ITEM, "full_outer")
    good = F.col("expected") & (F.col("n_rows") == horizon) & (F.col("n_stamps") == horizon)
    return both.filter(~F.coalesce(good, F.lit(False))).select(
        ITEM, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("expected", F.lit(False)).alias("expected")
    )


def last_chunks(stepped: DataFrame, count: int) -> DataFrame:
    """(item_id, chunk, last_step) for the chunks that each item's last ``count`` steps touch.

    Joining this to series rows by (item, chunk) marks an item's end without gathering the
    item: a hot one is read by as many tasks as it has chunks.
    """
    ends = stepped.groupBy(ITEM).agg(F.max("step").alias("last_step"))
    first = chunk_index(F.col("last_step") - (count - 1))
    return ends.withColumn("chunk", F.explode(F.sequence(first, chunk_index(F.col("last_step")))))


def last_steps(series: DataFrame, horizon: int, freq) -> DataFrame:
    """Series with ``step`` and ``held_out``: true on the last ``horizon`` steps of each item."""
    stepped = with_step(series, freq).withColumn("chunk", chunk_index(F.col("step")))
    # Chunks the held-out range does not touch find no partner: they are history.
    marked = stepped.join(last_chunks(stepped, horizon), [ITEM, "chunk"], "left")
    held = F.coalesce(F.col("step") > F.col("last_step") - horizon, F.lit(False))
    return marked.withColumn("held_out", held).drop("chunk", "last_step")


def holdout_split(series: DataFrame, horizon: int, freq) -> tuple[DataFrame, DataFrame]:
    """(history, validation): the last ``horizon`` steps of each item are held out."""
    marked = last_steps(series, horizon, freq)
    history = marked.filter(~F.col("held_out")).drop("step", "held_out")
    return history, marked.filter("held_out").drop("step", "held_out")
