"""Calendar frequencies as Spark column expressions.

A frequency turns timestamps into integer *steps* on a calendar that is the same for every
item (``step_index``) and turns a start plus a step count back into timestamps
(``stamp_at``). Lags, seasons and horizons are then plain integer arithmetic, so no plan
needs a per-item row number, and none depends on a whole item sitting in one task.

Ranges follow the pandas convention: an anchored frequency first rolls the start *forward*
to the anchor and keeps the time of day; step ``k`` is always computed from the start.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday numbers (Monday = 0), as in the anchor part of "W-SUN".
WEEKDAYS = {"MON": 0, "TUE": 1, "WED": 2, "THU": 3, "FRI": 4, "SAT": 5, "SUN": 6}

# Other spellings of the unit codes.
ALIASES = {
    "H": "h",
    "T": "min",
    "S": "s",
    "M": "ME",
    "Q": "QE",
    "A": "YE",
    "Y": "YE",
    "AS": "YS",
    "W": "W-SUN",
}

# Steps in one season for n = 1; anything else has season 1.
SEASONS = {"h": 24, "D": 7, "B": 5, "W": 52, "MS": 12, "ME": 12, "QS": 4, "QE": 4}

_SECONDS = {"s": 1, "min": 60, "h": 3600}
_CALENDAR = ("D", "B", "MS", "ME", "QS", "QE", "YS", "YE")
UNITS = (*_SECONDS, *_CALENDAR, *(f"W-{day}" for day in WEEKDAYS))


@dataclass(frozen=True)
class Frequency:
    n: int
    unit: str

    @staticmethod
    def parse(text: "str | Frequency") -> "Frequency":
        if isinstance(text, Frequency):
            return text
        match = re.fullmatch(r"(\d*)([A-Za-z]+(?:-[A-Za-z]{3})?)", text.strip())
        if not match:
            raise ValueError(f"cannot read frequency {text!r}")
        unit = ALIASES.get(match.group(2), match.group(2))
        n = int(match.group(1) or 1)
        if unit not in UNITS or n < 1:
            raise ValueError(f"unknown frequency {text!r}; known units: {sorted(UNITS)}")
        return Frequency(n, unit)

    def __str__(self) -> str:
        return self.unit if self.n == 1 else f"{self.n}{self.unit}"

    @property
    def season(self) -> int:
        base = SEASONS.get(self.unit.split("-")[0], 1)
        return base // self.n if base % self.n == 0 else 1


def _midnight(t: Column) -> Column:
    return F.to_date(t).cast("timestamp_ntz")


def _days(count: Column) -> Column:
    return count * F.expr("INTERVAL '1' DAY")


def _months(date: Column, count: Column) -> Column:
    return F.add_months(date, count.cast("int"))


def _at_time_of(date: Column, t: Column) -> Column:
    return date.cast("timestamp_ntz") + (t - _midnight(t))


def _epoch_day(t: Column) -> Column:
    return F.unix_date(F.to_date(t)).cast("bigint")


def _floor_div(value: Column, by: Column) -> Column:
    return ((value - F.pmod(value, by)) / by).cast("bigint")


def epoch_micros(t: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), t)


def _raw_index(t: Column, unit: str) -> Column:
    """Position on the unit's calendar for n = 1."""
    if unit in _SECONDS:
        return _floor_div(epoch_micros(t), F.lit(_SECONDS[unit] * 1_000_000))
    if unit == "D":
        return _epoch_day(t)
    if unit.startswith("W-"):
        # 1970-01-01 was a Thursday (3), so this is a multiple of 7 on every anchor day.
        return _floor_div(_epoch_day(t) + F.lit(3 - WEEKDAYS[unit[2:]]), F.lit(7))
    if unit == "B":
        since_monday = _epoch_day(t) + F.lit(3)
        week = _floor_div(since_monday, F.lit(7))
        return week * 5 + F.least(F.pmod(since_monday, F.lit(7)), F.lit(4))
    year, month = F.year(t).cast("bigint"), F.month(t)
    if unit in ("MS", "ME"):
        return year * 12 + month - 1
    if unit in ("QS", "QE"):
        return year * 4 + F.quarter(t) - 1
    return year


def step_index(t: Column, freq: "str | Frequency") -> Column:
    """Integer step of ``t``; neighbouring stamps of one item differ by exactly one."""
    freq = Frequency.parse(freq)
    raw = _raw_index(t, freq.unit)
    return raw if freq.n == 1 else _floor_div(raw, F.lit(freq.n))


def on_anchor(t: Column, freq: "str | Frequency") -> Column:
    """Whether ``t`` lies on an anchor day (always true for plain day/hour/... units)."""
    unit = Frequency.parse(freq).unit
    day = F.to_date(t)
    if unit.startswith("W-"):
        return F.weekday(t) == WEEKDAYS[unit[2:]]
    if unit == "B":
        return F.weekday(t) < 5
    if unit == "MS":
        return F.dayofmonth(t) == 1
    if unit == "ME":
        return day == F.last_day(day)
    if unit == "QS":
        return day == F.trunc(t, "QUARTER")
    if unit == "QE":
        return day == F.last_day(F.add_months(F.trunc(t, "QUARTER"), 2))
    if unit == "YS":
        return day == F.trunc(t, "YEAR")
    if unit == "YE":
        return day == F.last_day(F.add_months(F.trunc(t, "YEAR"), 11))
    return F.lit(True)


def grid_phase(t: Column, freq: "str | Frequency") -> Column:
    """Offset of ``t`` inside its step, in microseconds; constant for an item on a grid."""
    freq = Frequency.parse(freq)
    if freq.unit in _SECONDS:
        return F.pmod(epoch_micros(t), F.lit(freq.n * _SECONDS[freq.unit] * 1_000_000))
    within_day = F.timestamp_diff("MICROSECOND", _midnight(t), t)
    return within_day + F.pmod(_raw_index(t, freq.unit), F.lit(freq.n)) * 86_400_000_000


def _seconds_stamp(t: Column, jump: Column, seconds: Column) -> Column:
    return t + (jump * seconds) * F.expr("INTERVAL '1' SECOND")


def _weekly_stamp(t: Column, jump: Column, weekday: Column) -> Column:
    return t + _days(F.pmod(weekday - F.weekday(t), F.lit(7)) + jump * 7)


def _stamp(t: Column, k: Column, n: Column, unit: str) -> Column:
    jump = (k * n).cast("bigint")
    if unit in _SECONDS:
        return _seconds_stamp(t, jump, F.lit(_SECONDS[unit]))
    if unit == "D":
        return t + _days(jump)
    if unit.startswith("W-"):
        return _weekly_stamp(t, jump, F.lit(WEEKDAYS[unit[2:]]))
    if unit == "B":
        roll = F.when(F.weekday(t) >= 5, F.lit(7) - F.weekday(t)).otherwise(F.lit(0))
        first = F.when(F.weekday(t) >= 5, F.lit(0)).otherwise(F.weekday(t))
        total = first + jump
        shift = _floor_div(total, F.lit(5)) * 7 + F.pmod(total, F.lit(5)) - first
        return t + _days(roll + shift)
    month = F.trunc(t, "MM")
    if unit == "MS":
        late = F.when(F.dayofmonth(t) == 1, 0).otherwise(1)
        return _at_time_of(_months(month, jump + late), t)
    if unit == "ME":
        return _at_time_of(F.last_day(_months(month, jump)), t)
    if unit in ("QS", "QE"):
        quarter = F.trunc(t, "QUARTER")
        if unit == "QS":
            late = F.when(F.to_date(t) == quarter, 0).otherwise(1)
            return _at_time_of(_months(quarter, (jump + late) * 3), t)
        return _at_time_of(F.last_day(_months(quarter, jump * 3 + 2)), t)
    year = F.trunc(t, "YEAR")
    if unit == "YS":
        late = F.when(F.to_date(t) == year, 0).otherwise(1)
        return _at_time_of(_months(year, (jump + late) * 12), t)
    return _at_time_of(F.last_day(_months(year, jump * 12 + 11)), t)


def stamp_at(t: Column, k: Column, freq: "str | Frequency") -> Column:
    """Timestamp ``k`` steps after ``t`` (``k`` = 0 is ``t`` rolled forward to the anchor)."""
    freq = Frequency.parse(freq)
    return _stamp(t, k, F.lit(freq.n), freq.unit)


def _parts(freq: Column) -> tuple[Column, Column]:
    """(n, unit) of a frequency given per row as text."""
    digits = F.regexp_extract(freq, r"^(\d*)", 1)
    n = F.when(digits == "", F.lit(1)).otherwise(digits.try_cast("bigint"))
    code = F.regexp_extract(freq, r"^\d*(.*)$", 1)
    return n, F.coalesce(_lookup(ALIASES)[code], code)


def named_frequency(freq: Column) -> Column:
    """A row's frequency text in the one spelling ``str(Frequency)`` has; null when it is none."""
    n, unit = _parts(F.trim(freq))
    known = unit.isin(*UNITS) & (n >= 1)
    return F.when(known, F.when(n == 1, unit).otherwise(F.concat(n.cast("string"), unit)))


def season_named(freq: Column) -> Column:
    """As ``Frequency.season``, with the frequency given per row as text; 1 for what is no frequency."""
    n, unit = _parts(freq)
    n = F.greatest(n, F.lit(1))
    whole = F.coalesce(_lookup(SEASONS)[F.split(unit, "-")[0]], F.lit(1)).cast("bigint")
    return F.when(F.pmod(whole, n) == 0, (whole / n).cast("bigint")).otherwise(F.lit(1).cast("bigint"))


def stamp_at_named(t: Column, k: Column, freq: Column) -> Column:
    """As ``stamp_at``, with the frequency given per row as text."""
    n, unit = _parts(freq)
    jump = (k * n).cast("bigint")
    seconds = _lookup(_SECONDS)[unit]
    weekday = _lookup({f"W-{day}": number for day, number in WEEKDAYS.items()})[unit]
    chain = F.when(seconds.isNotNull(), _seconds_stamp(t, jump, seconds))
    chain = chain.when(weekday.isNotNull(), _weekly_stamp(t, jump, weekday))
    for name in _CALENDAR:
        chain = chain.when(unit == name, _stamp(t, k, n, name))
    return chain.otherwise(F.raise_error(F.concat(F.lit("unknown frequency "), freq)).cast("timestamp_ntz"))


def _lookup(table: dict) -> Column:
    return F.create_map(*[F.lit(part) for pair in table.items() for part in pair])


def stamps_from_start(start: Column, count: Column, freq: "str | Frequency") -> Column:
    """Array of ``count`` stamps beginning at ``start`` rolled forward to the anchor."""
    steps = F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int")))
    return F.transform(F.coalesce(steps, F.array().cast("array<int>")), lambda k: stamp_at(start, k, freq))
