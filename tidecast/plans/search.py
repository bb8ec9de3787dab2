"""Search spaces for hyperparameters: ranges, seeded trials and successive halving."""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any, Protocol

TRIALS = 10  # drawn from ranges unless ``num_trials`` says otherwise
ETA = 3  # of successive halving: how many times fewer trials, and more rows, each rung has
SHARES = 10_000  # steps in which a rung's share of the rows is given


class Space(Protocol):
    def at(self, u: float) -> Any:
        """The value at ``u`` in [0, 1)."""


@dataclass(frozen=True)
class IntRange:
    """Whole numbers from ``low`` to ``high``, both included; ``log`` spreads magnitudes evenly."""

    low: int
    high: int
    log: bool = False

    def __post_init__(self):
        _check(self.low, self.high, self.log)

    def at(self, u: float) -> int:
        if self.log:
            return min(self.high, max(self.low, int(math.exp(math.log(self.low) + u * (math.log(self.high + 1) - math.log(self.low))))))
        return self.low + int(u * (self.high - self.low + 1))


@dataclass(frozen=True)
class RealRange:
    """Numbers from ``low`` up to ``high``; ``log`` spreads magnitudes evenly."""

    low: float
    high: float
    log: bool = False

    def __post_init__(self):
        _check(self.low, self.high, self.log)

    def at(self, u: float) -> float:
        if self.log:
            return math.exp(math.log(self.low) + u * (math.log(self.high) - math.log(self.low)))
        return self.low + u * (self.high - self.low)


@dataclass(frozen=True)
class Choice:
    """One of several values."""

    values: tuple

    def __init__(self, *values):
        if not values:
            raise ValueError("a choice needs values")
        object.__setattr__(self, "values", values)

    def at(self, u: float) -> Any:
        return self.values[int(u * len(self.values))]


def _check(low, high, log) -> None:
    if not low <= high or (log and low <= 0):
        raise ValueError(f"no range from {low} to {high}" + (" by magnitude" if log else ""))


def is_space(value: Any) -> bool:
    return isinstance(value, (IntRange, RealRange, Choice))


def _share(seed: int, trial: int, name: str) -> float:
    """A number in [0, 1) that depends on nothing but its arguments."""
    return int.from_bytes(hashlib.md5(f"{seed}:{trial}:{name}".encode()).digest()[:6], "big") / 2**48


def trials(settings: Mapping[str, Any], search: Mapping[str, Any] | None) -> list[dict[str, Any]]:
    """The settings of every trial.

    Without ranges, lists of values are walked in product order, all of them or ``num_trials``. With
    any, each of ``num_trials`` trials draws all its values by ``seed``, lists counting as choices;
    trials that repeat an earlier one are left out. More trials keep the first ones as they are.
    """
    search = search or {}
    lists = {k: v for k, v in settings.items() if isinstance(v, (list, tuple))}
    spaces = {k: v for k, v in settings.items() if is_space(v)}
    count = search.get("num_trials")
    if not spaces:
        return [{**settings, **dict(zip(lists, values))} for values in itertools.islice(itertools.product(*lists.values()), count)]
    spaces |= {k: Choice(*v) for k, v in lists.items()}
    found: list[dict[str, Any]] = []
    for trial in range(count if count is not None else TRIALS):
        drawn = {**settings, **{k: s.at(_share(search.get("seed", 0), trial, k)) for k, s in spaces.items()}}
        if drawn not in found:
            found.append(drawn)
    return found


def rungs(n_trials: int, eta: int = ETA) -> list[tuple[int, int]]:
    """(trials, share of the rows in SHARES) of each rung; the last has all rows.

    >>> rungs(9)
    [(9, 1111), (3, 3333), (1, 10000)]
    """
    if eta < 2:
        raise ValueError("eta must be at least 2")
    counts = [n_trials]
    while counts[-1] > 1:
        counts.append(math.ceil(counts[-1] / eta))
    return [(n, SHARES // eta ** (len(counts) - 1 - i)) for i, n in enumerate(counts)]


def halve(
    names: Sequence[str], score: Callable[[str, int], float | None], eta: int = ETA
) -> tuple[list[str], list[tuple[str, int, float | None]]]:
    """(the last rung's trials, all (name, share, score)) of successive halving.

    ``score(name, share)`` fits on that share of the rows; None (nothing came of it) is worst. Equal
    scores keep the earlier trial. The last rung is left to the caller.
    """
    left, log = list(names), []
    plan = rungs(len(left), eta)
    for (_, share), (keep, _) in zip(plan, plan[1:]):
        scored = [(name, score(name, share)) for name in left]
        log += [(name, share, s) for name, s in scored]
        ranked = sorted(range(len(scored)), key=lambda i: (-math.inf if scored[i][1] is None else scored[i][1], -i), reverse=True)
        left = [scored[i][0] for i in sorted(ranked[:keep])]
    return left, log
