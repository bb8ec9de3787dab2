"""Quantile levels and their columns."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.session import scratch_path

# The levels a forecast reports unless told otherwise.
DEFAULT_LEVELS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)


def sorted_levels(levels: Sequence[float] | None = None) -> list[float]:
    levels = sorted({float(q) for q in (DEFAULT_LEVELS if levels is None else levels)})
    if not all(0 < q < 1 for q in levels):
        raise ValueError(f"quantile levels must lie strictly between 0 and 1, got {levels}")
    return levels


def level_name(q: float) -> str:
    return str(float(q))


def z_value(q: float) -> float:
    return NormalDist().inv_cdf(q)


# Coefficients of Wichura's rational approximation AS 241 (double precision), from the
# constant term up: numerator and denominator near the centre, further out, and in the far tails.
_CENTRE = (
    (3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
     45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727),
    (1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
     21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610),
)
_OUTER = (
    (1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
     1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
     0.148103976427480074590, 0.0151986665636164571966, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
_TAIL = (
    (6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
     0.0265321895265761230930, 0.00124266094738807843860, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)


def z_column(q: Column) -> Column:
    """As ``z_value``, for a level that is a row's value; null outside of (0, 1)."""

    def ratio(tables, x: Column) -> Column:
        parts = []
        for coefficients in tables:
            total = F.lit(coefficients[-1])
            for c in reversed(coefficients[:-1]):
                total = total * x + F.lit(c)
            parts.append(total)
        return parts[0] / parts[1]

    away = q - 0.5
    far = F.sqrt(-F.log(F.least(q, 1 - q)))
    tail = F.when(far <= 5, ratio(_OUTER, far - 1.6)).otherwise(ratio(_TAIL, far - 5))
    value = F.when(F.abs(away) <= 0.425, away * ratio(_CENTRE, 0.180625 - away * away)).otherwise(F.signum(away) * tail)
    return F.when((q > 0) & (q < 1), value)


def normal_quantiles(mean: Column, sigma: Column, levels: Sequence[float]) -> list[Column]:
    """One column per level: the quantile of a normal distribution around ``mean``."""
    spread = F.coalesce(sigma, F.lit(0.0))
    return [
        (mean if q == 0.5 else mean + F.lit(z_value(q)) * spread).alias(level_name(q)) for q in levels
    ]


def empirical_quantiles(value: Column, levels: Sequence[float]) -> list[Column]:
    """Aggregates: exact interpolated quantiles of a column, one per level."""
    return [F.percentile(value, F.lit(q)).alias(level_name(q)) for q in levels]


ACCURACY = 10_000  # of the sketches that bracket a quantile: a rank is known to within one part in so many
FEW = 1 << 20  # values of a group between two brackets that are sorted; more are bracketed again


def group_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, levels: Sequence[float], accuracy: int = ACCURACY, few: int = FEW
) -> DataFrame:
    """(keys, one column per level): exact interpolated quantiles of groups of any size.

    Unlike ``empirical_quantiles``, no task holds a group's distinct values. Each round one mergeable
    sketch per group gives values on both sides of every wanted rank; only rows between them go on,
    a few parts in ``accuracy`` of the group, with the number of those below. When no group has more
    than ``few`` rows left between two brackets, those are ranked. Counts check every bracket, so the
    result doesn't rest on the sketch. Nulls don't count; NaN is the largest value; groups without
    values get nulls; null keys are a group. Runs a job or two per round; a round is rarely followed
    by another.
    """
    from tidecast.operators.columns import col

    levels = sorted_levels(levels)
    group = [f"g{i}" for i in range(len(keys))]
    names = [level_name(q) for q in levels]
    rows = df.select(*(col(k).alias(g) for k, g in zip(keys, group)), col(value).cast("double").alias("v"))
    if not keys:
        group, rows = ["g0"], rows.withColumn("g0", F.lit(0))
    sizes = rows.groupBy(*group).agg(F.count("v").alias("n"))
    # Wanted per group and level: ranks low and low + 1 among ``n`` values, ``skip`` of them behind us.
    places = F.array(*[F.struct(F.lit(i).alias("level"), F.lit(q).alias("q")) for i, q in enumerate(levels)])
    wanted = sizes.where("n > 0").select(*group, "n", F.explode(places).alias("l")).select(*group, "n", "l.level", (F.col("l.q") * (F.col("n") - 1)).alias("place"))
    wanted = wanted.select(*group, "level", "place", F.floor("place").cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("skip"), "n")
    left = rows.where("v IS NOT NULL").select(*group, F.lit(-1).alias("of"), "v")  # -1: rows of every level
    held: list[DataFrame] = []
    before = None

    try:
        while True:
            # Rows of one value need no telling apart, and where a round leaves as many rows as there
            # were, a few values hold them all: both are counted by value in the end.
            most = wanted.agg(F.max("n")).first()[0]
            if most is None or most <= few or most == before:
                break
            before = most
            bracketed = _bracketed(left, wanted, group, accuracy)
            left, wanted = (x.persist(StorageLevel.MEMORY_AND_DISK) for x in bracketed)
            held += [left, wanted]
        ranked = _ranked(left, wanted, group)
        cells = ranked.groupBy(*group).agg(*[F.max(F.when(F.col("level") == i, F.col("x"))).alias(n) for i, n in enumerate(names)])
        out = _matched(sizes, cells, group, how="left").select(*(F.col(g).alias(k) for g, k in zip(group, keys)), *map(col, names))
        return out if not held else _kept(out)
    finally:
        for frame in held:
            frame.unpersist()


def _kept(out: DataFrame) -> DataFrame:
    """One row per group, computed before the intermediate rows go."""
    out = out.persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    return out


def _matched(a: DataFrame, b: DataFrame, on: Sequence[str], also: Column | None = None, how: str = "inner") -> DataFrame:
    """``a`` with the other columns of ``b``, null keys matching each other."""
    met = F.lit(True) if also is None else also
    for c in on:
        met = met & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return a.join(b.withColumnsRenamed({c: f"_{c}" for c in on}), met, how).drop(*[f"_{c}" for c in on])


def _of_level() -> Column:
    """Whether rows left ``of`` a level, or of all (-1), are those of ``level``."""
    return (F.col("of") == -1) | (F.col("of") == F.col("level"))


def _bracketed(left: DataFrame, wanted: DataFrame, group: Sequence[str], accuracy: int) -> tuple[DataFrame, DataFrame]:
    """(rows, wanted) after one round: rows between brackets of each level, and the ranks among them.

    ``of`` is the level a row is left for, -1 for all of them.
    """
    first = F.col("low") - F.col("skip")
    slack = 2.0 / accuracy
    last = accuracy // 8
    steps = [i / last for i in range(last + 1)]
    sketch = left.groupBy(*group, "of").agg(F.percentile_approx("v", F.lit(steps), F.lit(accuracy)).alias("cuts"))
    met = _matched(wanted, sketch, group, _of_level())
    # On both sides of the ranks first and first + 1, by more than a sketch can be wrong.
    under = F.floor((first / F.col("n") - slack) * last).cast("int") - 1
    over = F.ceil(((first + 2) / F.col("n") + slack) * last).cast("int") + 1
    # Beyond the first and last cut there is no bracket; null stands for that.
    bounds = met.select(
        *group, "level", "place", "low", "skip", "n",
        F.when(under >= 0, F.get("cuts", under)).alias("a"), F.when(over <= last, F.get("cuts", over)).alias("b"),
    )
    # A sketch depends on the order in which its parts arrive, so another run of it has other cuts: the
    # brackets are written, one row per group and level, and all that follows reads the same ones.
    path = scratch_path(left.sparkSession, "brackets")
    bounds.write.parquet(path)
    bounds = left.sparkSession.read.schema(bounds.schema).parquet(path)
    each = bounds.groupBy(*group).agg(F.collect_list(F.struct("level", "a", "b")).alias("bs"))  # one entry per level
    joined = _matched(left, each, group).select(*group, "of", "v", F.explode("bs").alias("b")).select(*group, "of", "v", "b.*").where(_of_level())
    below = F.coalesce(F.col("v") < F.col("a"), F.lit(False))
    inside = ~below & F.coalesce(F.col("v") <= F.col("b"), F.lit(True))
    counts = joined.groupBy(*group, "level").agg(F.count_if(below).alias("passed"), F.count_if(inside).alias("among"))
    checked = _matched(bounds, counts, [*group, "level"])
    good = (first >= F.col("passed")) & (F.least(first + 1, F.col("n") - 1) < F.col("passed") + F.col("among"))
    wrong = F.raise_error(F.lit("a quantile lies outside of its bracket")).cast("bigint")
    after = checked.select(
        *group, "level", "place", "low", F.when(good, F.col("skip") + F.col("passed")).otherwise(wrong).alias("skip"), F.col("among").alias("n")
    )
    return joined.where(inside).select(*group, F.col("level").alias("of"), "v"), after


def _ranked(left: DataFrame, wanted: DataFrame, group: Sequence[str]) -> DataFrame:
    """(group, level, x) from the rows that are left: values are counted, then ranked by running sums."""
    counted = left.groupBy(*group, "of", "v").agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy(*group, "of").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    met = _matched(wanted, counted.withColumn("upto", F.sum("c").over(upto)), group, _of_level())
    first = F.col("low") - F.col("skip")
    start = F.col("upto") - F.col("c")
    holds = lambda r: (start <= r) & (r < F.col("upto"))
    picked = met.groupBy(*group, "level").agg(
        *(F.max(c).alias(c) for c in ("place", "low")),
        *(F.max(F.when(holds(first + i), F.col("v"))).alias(f"x{i}") for i in (0, 1)),
    )
    part = F.col("place") - F.col("low")
    between = F.col("x0") + (F.coalesce("x1", "x0") - F.col("x0")) * part
    return picked.select(*group, "level", F.when(part == 0, F.col("x0")).otherwise(between).alias("x"))
