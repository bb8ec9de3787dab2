"""Every catalogue query against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from tidecast.catalog import all_queries, all_sql

# Fits of several candidates: long, and their values are covered by other tests.
SLOW = {"fc_best_quality", "tab_leaderboard", "tab_search", "mixed_classify", "tab_linear_proba"}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


def test_every_oracle_has_its_query():
    assert set(all_sql()) <= set(all_queries())


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_value_match(spark, duck, sf_dir, name):
    frame = all_queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in frame.collect()), key=repr)
    cursor = duck.execute(all_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = sorted((tuple(plain(r[i]) for i in at) for r in cursor.fetchall()), key=repr)
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        for x, y in zip(a, b):
            same = x == pytest.approx(y, abs=2e-4, rel=1e-6) if isinstance(x, float) and isinstance(y, float) else x == y
            assert same, (a, b)


@pytest.mark.parametrize("name", sorted(set(all_queries()) - set(all_sql()) - SLOW))
def test_fitted_queries_give_rows(spark, sf_dir, name):
    assert all_queries()[name](spark, sf_dir).count() > 0
