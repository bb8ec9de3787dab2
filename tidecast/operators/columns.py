"""Schema rules: alignment, canonical names and the checks made before any job starts."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ITEM, STAMP, TARGET = "item_id", "timestamp", "target"
PROBA = "_proba"


def col(name: str) -> Column:
    """Column by its literal name, dots and all (quantile columns are called "0.1")."""
    return F.col("`" + name.replace("`", "``") + "`")


def missing_columns(have: Iterable[str], want: Iterable[str]) -> list[str]:
    have = set(have)
    return [name for name in want if name not in have]


def align_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Exactly ``expected``, in that order; extras are dropped (and never scanned)."""
    missing = missing_columns(df.columns, expected)
    if missing:
        raise ValueError(f"the input lacks {', '.join(missing)}")
    return df.select(*map(col, expected))


def feature_columns(df: DataFrame, label: str) -> list[str]:
    return [name for name in df.columns if name != label]


def stringify_columns(df: DataFrame, names: Sequence[object] | None = None) -> DataFrame:
    """Rename every column to the text form of ``names`` (default: its own name)."""
    return df.toDF(*map(str, names if names is not None else df.columns))


def canonicalize(
    df: DataFrame,
    id_column: str = ITEM,
    timestamp_column: str = STAMP,
    target: str | None = TARGET,
) -> DataFrame:
    """Series columns under their canonical names and types; other columns unchanged.

    Item ids become text, event times ``timestamp_ntz``, the target ``double``.
    ``target=None`` is for tables without one (known covariates).
    """
    wanted = {ITEM: (id_column, "string"), STAMP: (timestamp_column, "timestamp_ntz")}
    if target is not None:
        wanted[TARGET] = (target, "double")
    sources = [source for source, _ in wanted.values()]
    missing = missing_columns(df.columns, sources)
    if missing:
        raise ValueError(f"the series lacks {', '.join(missing)}")
    rest = [name for name in df.columns if name not in sources]
    clash = [name for name in rest if name in wanted]
    if clash:
        raise ValueError(f"Columns {clash} collide with the canonical series names")
    named = [col(source).cast(kind).alias(name) for name, (source, kind) in wanted.items()]
    if target is not None:  # NaN is how other libraries write a missing value
        value = col(target).cast("double")
        named[-1] = F.when(~F.isnan(value), value).alias(TARGET)
    return df.select(*named, *map(col, rest))


def restore_names(df: DataFrame, id_column: str = ITEM, timestamp_column: str = STAMP) -> DataFrame:
    """Undo the renaming of ``canonicalize`` on a forecast table."""
    return df.withColumnsRenamed({ITEM: id_column, STAMP: timestamp_column})


def known_covariate_names(known: DataFrame, id_column: str = ITEM, timestamp_column: str = STAMP) -> list[str]:
    """Every column but the two keys."""
    return [name for name in known.columns if name not in (id_column, timestamp_column)]


def _report(problems: Sequence[str]) -> None:
    """One error that lists everything found."""
    if problems:
        raise ValueError("; ".join(problems))


def _lacking(table: str, df: DataFrame, names: Iterable[str]) -> list[str]:
    gone = missing_columns(df.columns, names)
    return [f"{table} lacks {', '.join(gone)}"] if gone else []


def validate_tabular(train: DataFrame, test: DataFrame | None, label: str | None) -> None:
    """The label is named and trained on; a test table has every feature."""
    if not label:
        _report(["no label was named"])
    problems = _lacking("train_data", train, [label])
    if test is not None:
        problems += _lacking("test_data", test, feature_columns(train, label))
    _report(problems)


def validate_series(
    train: DataFrame,
    tuning: DataFrame | None = None,
    id_column: str = ITEM,
    timestamp_column: str = STAMP,
    target: str = TARGET,
) -> None:
    """Every series table has its id, timestamp and target."""
    tables = {"train_data": train, "tuning_data": tuning}
    keys = (id_column, timestamp_column, target)
    _report([p for name, df in tables.items() if df is not None for p in _lacking(name, df, keys)])


def validate_known_covariates(
    known: DataFrame | None,
    names: Sequence[str] | None,
    train: DataFrame | None = None,
    id_column: str = ITEM,
    timestamp_column: str = STAMP,
) -> list[str]:
    """Names of the known covariates (inferred when not given), once both tables have them.

    Columns that nobody declared are left out with a warning.
    """
    keys = (id_column, timestamp_column)
    if isinstance(names, str) or not isinstance(names, (list, tuple, type(None))):
        _report([f"names of known covariates come as a list, not as {type(names).__name__}"])
    if names is None:
        names = known_covariate_names(known, *keys) if known is not None else []
    problems = []
    if known is not None:
        problems += _lacking("known_covariates", known, (*keys, *names))
        unused = missing_columns((*keys, *names), known.columns)
        if unused and not problems:
            warnings.warn(f"left out, since not declared: {', '.join(unused)}", stacklevel=2)
    if train is not None:
        problems += _lacking("train_data", train, names)
    _report(problems)
    return list(names)


def schema_to_json(schema: T.StructType) -> str:
    return schema.json()


def schema_from_json(text: str) -> T.StructType:
    import json

    return T.StructType.fromJson(json.loads(text))
