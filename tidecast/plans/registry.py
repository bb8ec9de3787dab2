"""Named candidate lists and the layering of their settings."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from tidecast.operators.baseline import BASELINES
from tidecast.operators.smoothing import SMOOTHERS

FORECASTERS = (*BASELINES, *SMOOTHERS, "lag_regression")

# A preset is only a candidate list; budgets are separate.
FORECAST_PRESETS = {
    "fast_training": ("naive", "seasonal_naive"),
    "medium_quality": ("naive", "seasonal_naive", "drift", "ses"),
    "good_quality": (*BASELINES, *SMOOTHERS),
    "high_quality": (*BASELINES, *SMOOTHERS, "lag_regression"),
    "best_quality": (*BASELINES, *SMOOTHERS, "lag_regression", "ensemble"),
}
TABULAR_PRESETS = {
    "fast_training": ("linear",),
    "medium_quality": ("linear", "tree"),
    "good_quality": ("linear", "forest"),
    "high_quality": ("linear", "tree", "forest"),
    "best_quality": ("linear", "tree", "forest", "boosted"),
}

# Registry layer of settings; a user's constructor and call settings come on top.
DEFAULT_SETTINGS: dict[str, dict[str, Any]] = {
    "seasonal_naive": {"season": None},
    "lag_regression": {"lags": None, "calendar": True, "reg_param": 0.0},
    "linear": {"regParam": 0.0, "maxIter": 100},
    "tree": {"maxDepth": 5},
    "forest": {"numTrees": 20, "maxDepth": 5, "seed": 7},
    "boosted": {"maxIter": 10, "maxDepth": 3, "seed": 7},
}


def merge_settings(model: str, *layers: Mapping[str, Any] | None) -> dict[str, Any]:
    """Settings of ``model``: registry first, each later layer overrides earlier ones."""
    merged = dict(DEFAULT_SETTINGS.get(model, {}))
    for layer in layers:
        merged.update(layer or {})
    return merged


def preset(table: Mapping[str, tuple[str, ...]], name: str | list[str] | None, default: str) -> tuple[str, ...]:
    """Candidates of a preset; of several presets the last one wins, as with keyword defaults."""
    chosen = name[-1] if isinstance(name, (list, tuple)) else (name or default)
    if chosen not in table:
        raise ValueError(f"unknown preset {chosen!r}; known: {sorted(table)}")
    return table[chosen]
