import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidecast.functions.frequency import (
    Frequency,
    on_anchor,
    stamp_at_named,
    stamps_from_start,
    step_index,
)

STARTS = [
    "2024-01-31 05:00",
    "2024-02-29 00:00",
    "2023-12-31 23:15",
    "2024-01-01 00:00",
    "2024-03-02 07:30:15",
    "2024-06-30 12:00",
    "2024-10-01 00:00",
    "2021-05-09 01:00",
]
FREQS = ["D", "2D", "h", "6h", "15min", "30s", "W", "W-WED", "2W", "MS", "ME", "M", "QS", "QE", "B", "3B", "YS", "YE"]


@pytest.mark.parametrize("freq", FREQS)
def test_ranges_follow_pandas(spark, freq):
    frame = spark.createDataFrame([(s,) for s in STARTS], "start string")
    start = F.col("start").cast("timestamp_ntz")
    frame = frame.select(
        "start",
        stamps_from_start(start, F.lit(14), freq).alias("stamps"),
        F.transform(F.sequence(F.lit(0), F.lit(13)), lambda k: stamp_at_named(start, k, F.lit(freq))).alias("named"),
    )
    stamps = F.col("stamps")
    checked = frame.select(
        "*",
        F.transform(stamps, lambda t: step_index(t, freq)).alias("steps"),
        F.forall(stamps, lambda t: on_anchor(t, freq)).alias("anchored"),
    ).collect()
    spelling = {"M": "ME"}.get(freq, freq)
    for row in checked:
        expected = list(pd.date_range(row.start, periods=14, freq=spelling).to_pydatetime())
        assert row.stamps == expected, (freq, row.start)
        assert row.named == expected
        assert row.anchored
        assert {b - a for a, b in zip(row.steps, row.steps[1:])} == {1}


def test_empty_range_and_bad_codes(spark):
    row = spark.range(1).select(stamps_from_start(F.lit("2024-01-01").cast("timestamp_ntz"), F.lit(0), "D")).first()
    assert row[0] == []
    with pytest.raises(ValueError):
        Frequency.parse("fortnight")
    assert Frequency.parse("W").season == 52 and Frequency.parse("2h").season == 12 and Frequency.parse("7D").season == 1
