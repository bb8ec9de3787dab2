"""tidecast: training, scoring and forecasting over large tables with PySpark."""

import sys

from pyspark import cloudpickle

# Python workers get the functions they run by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"

_PUBLIC = {
    "forecast": "tidecast.plans.forecast",
    "ForecastEstimator": "tidecast.plans.forecast",
    "ForecastModel": "tidecast.plans.forecast",
    "TabularEstimator": "tidecast.plans.tabular",
    "TabularModel": "tidecast.plans.tabular",
    "MultiModalEstimator": "tidecast.plans.multimodal",
    "MultiModalModel": "tidecast.plans.multimodal",
    "read_table": "tidecast.sources.tables",
    "convert_format": "tidecast.sources.tables",
}


def __getattr__(name: str):
    if name in _PUBLIC:
        from importlib import import_module

        return getattr(import_module(_PUBLIC[name]), name)
    raise AttributeError(f"module 'tidecast' has no attribute {name!r}")
