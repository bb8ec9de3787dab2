"""Exponential smoothing for items of any length.

Smoothing is a recurrence over time, but a linear one: after any stretch of a series the
state is ``A x + b`` in the state ``x`` before it, and the squared one-step errors are a
quadratic in ``x``. A stretch is therefore summed up by a few numbers, and neighbouring
summaries combine. So each task folds chunks of bounded length, a second, much smaller pass
folds the summaries of an item in time order with constant memory, and no item is ever
gathered whole. The starting state needs no heuristic: it is the minimiser of the quadratic.

Smoothing weights are chosen per item from a fixed grid by in-sample squared error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.frequency import epoch_micros
from tidecast.operators.chunks import chunk_index
from tidecast.operators.columns import ITEM, STAMP, TARGET
from tidecast.operators.series import future_rows, with_step

SMOOTHERS = ("ses", "holt")

# The grids searched. Holt pairs are (level weight, trend weight as a share).
SES_GRID = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
HOLT_GRID = tuple((a, share) for a in (0.1, 0.3, 0.5, 0.8) for share in (0.05, 0.2, 0.5))


@dataclass(frozen=True)
class Smoother:
    """``error = y - w.x``; ``x' = (F - g w) x + g y`` for each grid point's gain ``g``."""

    gains: np.ndarray  # (K, d)
    alpha: np.ndarray
    beta: np.ndarray

    @property
    def d(self) -> int:
        return self.gains.shape[1]

    @property
    def w(self) -> np.ndarray:
        return np.ones(self.d)

    def advance(self, steps: np.ndarray) -> np.ndarray:
        """Transition over ``steps`` unobserved steps: one matrix per entry."""
        out = np.broadcast_to(np.eye(self.d), (len(steps), self.d, self.d)).copy()
        if self.d == 2:
            out[:, 0, 1] = steps
        return out


def smoother(kind: str, ses_grid=SES_GRID, holt_grid=HOLT_GRID) -> Smoother:
    if kind == "ses":
        alpha = np.asarray(ses_grid, dtype=float)
        return Smoother(alpha[:, None], alpha, np.zeros_like(alpha))
    if kind == "holt":
        alpha, share = np.asarray(holt_grid, dtype=float).T
        return Smoother(np.stack([alpha, alpha * share], axis=1), alpha, alpha * share)
    raise ValueError(f"unknown smoother {kind!r}; known: {SMOOTHERS}")


class Summary:
    """Summaries of G stretches at once; every array is indexed (stretch, grid point, ...)."""

    def __init__(self, A, b, S0, s1, S2):
        self.A, self.b, self.S0, self.s1, self.S2 = A, b, S0, s1, S2

    @staticmethod
    def empty(g: int, model: Smoother) -> "Summary":
        k, d = model.gains.shape
        eye = np.broadcast_to(np.eye(d), (g, k, d, d)).copy()
        return Summary(eye, np.zeros((g, k, d)), np.zeros((g, k)), np.zeros((g, k, d)), np.zeros((g, k, d, d)))

    def pack(self) -> np.ndarray:
        g = self.S0.shape[0]
        return np.concatenate([part.reshape(g, -1) for part in (self.A, self.b, self.S0, self.s1, self.S2)], axis=1)

    @staticmethod
    def unpack(flat: np.ndarray, model: Smoother) -> "Summary":
        k, d = model.gains.shape
        shapes = ((k, d, d), (k, d), (k,), (k, d), (k, d, d))
        parts, at = [], 0
        for shape in shapes:
            size = int(np.prod(shape))
            parts.append(flat[:, at : at + size].reshape(len(flat), *shape).copy())
            at += size
        return Summary(*parts)

    def take(self, index) -> "Summary":
        return Summary(self.A[index], self.b[index], self.S0[index], self.s1[index], self.S2[index])

    def advance(self, rows: slice, model: Smoother, steps: np.ndarray) -> None:
        """Move ``rows`` over unobserved steps (in place)."""
        if model.d == 1 or not steps.any():
            return
        jump = model.advance(steps)[:, None]
        self.A[rows] = jump @ self.A[rows]
        self.b[rows] = (jump @ self.b[rows][..., None])[..., 0]

    def observe(self, rows: slice, model: Smoother, y: np.ndarray) -> None:
        """Add one observation per stretch in ``rows`` (in place)."""
        A, b = self.A[rows], self.b[rows]
        v = A.sum(axis=-2)  # w A, with w all ones
        r = y[:, None] - b.sum(axis=-1)
        self.S0[rows] += r * r
        self.s1[rows] += r[..., None] * v
        self.S2[rows] += v[..., :, None] * v[..., None, :]
        if model.d == 2:
            A[..., 0, :] += A[..., 1, :]
            b[..., 0] += b[..., 1]
        gain = model.gains[None]
        self.A[rows] = A - gain[..., :, None] * v[..., None, :]
        self.b[rows] = b + gain * r[..., None]

    def then(self, rows: slice, later: "Summary") -> None:
        """Append ``later`` stretches to ``rows`` (in place)."""
        A, b = self.A[rows], self.b[rows]
        At = np.swapaxes(A, -1, -2)
        pull = (later.S2 @ b[..., None])[..., 0]
        self.S0[rows] += later.S0 - 2 * (later.s1 * b).sum(-1) + (b * pull).sum(-1)
        self.s1[rows] += (At @ (later.s1 - pull)[..., None])[..., 0]
        self.S2[rows] += At @ later.S2 @ A
        self.A[rows] = later.A @ A
        self.b[rows] = (later.A @ b[..., None])[..., 0] + later.b

    def solve(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best squared error and final state for every (stretch, grid point)."""
        start = (np.linalg.pinv(self.S2, rcond=1e-10, hermitian=True) @ self.s1[..., None])[..., 0]
        # Two points fit any line: with fewer than three the trend starts at zero.
        few = n < 3
        start[few] = 0.0
        start[few, :, 0] = self.s1[few, :, 0] / self.S2[few, :, 0, 0]
        sse = self.S0 - 2 * (self.s1 * start).sum(-1) + (start * (self.S2 @ start[..., None])[..., 0]).sum(-1)
        state = (self.A @ start[..., None])[..., 0] + self.b
        return np.maximum(sse, 0.0), state


_SEGMENT = f"{ITEM} string, first_step bigint, last_step bigint, last_us bigint, n bigint, summary array<double>"
_STATE = (
    f"{ITEM} string, last_step bigint, last_us bigint, n bigint, level double, trend double, "
    "alpha double, beta double, sse double"
)


def _by_length(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of stretches, longest first, and how many are at least 1, 2, ... long."""
    order = np.argsort(-lengths, kind="stable")
    active = np.searchsorted(-lengths[order], -np.arange(1, lengths.max() + 1), side="right")
    return order, active


PIECE = 128  # rows folded one after the other; longer stretches are cut and joined again


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Positions where a new run of equal keys begins."""
    changed = np.zeros(len(keys[0]), dtype=bool)
    changed[0] = True
    for key in keys:
        changed[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(changed)


def _join(rows: pd.DataFrame, model: Smoother, *keys: str) -> pd.DataFrame:
    """One segment per run of equal keys, from neighbouring segments in time order."""
    item = rows[ITEM].to_numpy()
    start = _starts(*(rows[k].to_numpy() for k in keys))
    length = np.diff(np.append(start, len(rows)))
    first_step, last_step = rows["first_step"].to_numpy(), rows["last_step"].to_numpy()
    parts = Summary.unpack(np.stack(rows["summary"].to_numpy()), model)
    order, active = _by_length(length)
    total = parts.take(start[order])
    for j, count in enumerate(active[1:], start=1):
        at = start[order[:count]] + j
        gap = first_step[at] - last_step[at - 1]
        if (gap <= 0).any():
            raise ValueError(f"duplicate timestamp for item {item[at][gap <= 0][0]}")
        total.advance(slice(0, count), model, gap - 1)
        total.then(slice(0, count), parts.take(at))
    ends = start[order] + length[order] - 1
    return pd.DataFrame(
        {
            ITEM: item[ends],
            "first_step": first_step[start[order]],
            "last_step": last_step[ends],
            "last_us": rows["last_us"].to_numpy()[ends],
            "n": np.add.reduceat(rows["n"].to_numpy(), start)[order],
            "summary": list(total.pack()),
        }
    )


def _fold_rows(model: Smoother):
    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A batch may cut a chunk in two: both halves become segments of their own.
        for rows in batches:
            if not len(rows):
                continue
            item, chunk, step = (rows[c].to_numpy() for c in (ITEM, "chunk", "step"))
            y = rows[TARGET].to_numpy(dtype=float)
            stretch = _starts(item, chunk)
            place = np.arange(len(rows)) - np.repeat(stretch, np.diff(np.append(stretch, len(rows))))
            start = np.flatnonzero(place % PIECE == 0)
            length = np.diff(np.append(start, len(rows)))
            gap = np.diff(step, prepend=step[0])
            inside = place > 0
            if (gap[inside] == 0).any():
                raise ValueError(f"duplicate timestamp for item {item[inside][gap[inside] == 0][0]}")
            order, active = _by_length(length)
            total = Summary.empty(len(start), model)
            for j, count in enumerate(active):
                at = start[order[:count]] + j
                part = slice(0, count)
                if j:
                    total.advance(part, model, gap[at] - 1)
                total.observe(part, model, y[at])
            back = np.argsort(order)
            last = start + length - 1
            pieces = pd.DataFrame(
                {
                    ITEM: item[start],
                    "chunk": chunk[start],
                    "first_step": step[start],
                    "last_step": step[last],
                    "last_us": rows["us"].to_numpy()[last],
                    "n": length,
                    "summary": list(total.take(back).pack()),
                }
            )
            yield _join(pieces, model, ITEM, "chunk") if len(start) > len(stretch) else pieces.drop(columns="chunk")

    return fold


def _fold_segments(model: Smoother):
    def finish(done: pd.DataFrame) -> pd.DataFrame:
        total = Summary.unpack(np.stack(done["summary"].to_numpy()), model)
        sse, state = total.solve(done["n"].to_numpy())
        best = np.argmin(np.round(sse, 6), axis=1)
        pick = np.arange(len(done))
        chosen = state[pick, best]
        return pd.DataFrame(
            {
                ITEM: done[ITEM].to_numpy(),
                "last_step": done["last_step"].to_numpy(),
                "last_us": done["last_us"].to_numpy(),
                "n": done["n"].to_numpy(),
                "level": chosen[:, 0],
                "trend": chosen[:, 1] if model.d == 2 else np.zeros(len(done)),
                "alpha": model.alpha[best],
                "beta": model.beta[best],
                "sse": sse[pick, best],
            }
        )

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry: pd.DataFrame | None = None
        for rows in batches:
            if not len(rows):
                continue
            if carry is not None:
                rows = pd.concat([carry, rows], ignore_index=True)
            open_item = rows[ITEM].iloc[-1]
            merged = _join(rows, model, ITEM)
            still_open = (merged[ITEM] == open_item).to_numpy()
            carry = merged[still_open]
            if not still_open.all():
                yield finish(merged[~still_open])
        if carry is not None:
            yield finish(carry)

    return fold


def smoothing_states(series: DataFrame, freq, kind: str = "ses", model: Smoother | None = None) -> DataFrame:
    """Fitted smoothing state, one row per item."""
    model = model or smoother(kind)
    rows = (
        with_step(series, freq)
        .filter(F.col(TARGET).isNotNull())
        .select(ITEM, "step", epoch_micros(F.col(STAMP)).alias("us"), TARGET, chunk_index(F.col("step")).alias("chunk"))
        .repartition(ITEM, "chunk")
        .sortWithinPartitions(ITEM, "chunk", "step")
    )
    segments = rows.mapInPandas(_fold_rows(model), _SEGMENT)
    states = (
        segments.repartition(ITEM)
        .sortWithinPartitions(ITEM, "first_step")
        .mapInPandas(_fold_segments(model), _STATE)
    )
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return states.withColumn("last_timestamp", F.timestamp_add("MICROSECOND", F.col("last_us"), epoch)).drop("last_us")


def smoothing_mean_sigma(h: Column) -> tuple[Column, Column]:
    """(mean, sigma) at step ``h`` over a row of ``smoothing_states``."""
    a, b = F.col("alpha"), F.col("beta")
    variance = F.col("sse") / F.col("n")
    growth = a * a + a * b * h + b * b * h * (2 * h - 1) / 6
    return F.col("level") + F.col("trend") * h, F.sqrt(variance * (1 + (h - 1) * growth))


def smoothing_forecast(series: DataFrame, horizon: int, freq, kind: str = "ses") -> DataFrame:
    """(item_id, timestamp, h, model, mean, sigma) of one smoother.

    Steps follow each item's last timestamp, also where its last targets are null; an item of
    nulls gets null forecasts.
    """
    ends = with_step(series, freq).groupBy(ITEM).agg(F.max(STAMP).alias("last_timestamp"), F.max("step").alias("origin"))
    states = smoothing_states(series, freq, kind).drop("last_timestamp")
    ahead = future_rows(ends.join(states, ITEM, "left"), horizon, freq)
    mean, sigma = smoothing_mean_sigma(F.col("h") + F.col("origin") - F.col("last_step"))
    return ahead.select(ITEM, STAMP, "h", F.lit(kind).alias("model"), mean.alias("mean"), sigma.alias("sigma"))
