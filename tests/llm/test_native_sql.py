"""op1 and op3 against their SQL: whole table, edge cases, extra columns and empty tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tidecast.llm.host_rules import apply_rules
from tidecast.llm.mixing import mix_report, mix_sources
from tidecast.llm.oracles import SQL
from tidecast.llm.queries import QUERIES

LONG = " ".join(f"word{i}" for i in range(30_000))
REPEATED = "a b c d e " * 30
ROWS = [
    (1, "one two three", "x"), (1, "one two three", "x"), (2, None, "x"), (3, "", None), (4, " \t\n", "y"), (None, "no key at all", "y"),
    (5, LONG, "hot"), (6, REPEATED, "bad"), (7, REPEATED, "bad"), (8, "Ünï cödé ﬁne words here to be enough for the rule okay then", "ü"),
    (9, "line one of text\nline one of text\n\nother # $ line | of <words> and more words", None), (10, "\x1c \x85 odd", ""),
] + [(100 + i, f"document {i} has its own words and {'more ' * (i % 13)}of them in line {i}\nand another", "hot" if i % 3 else f"s{i % 5}") for i in range(120)]


def oracle(name, rows):
    import pandas as pd

    duck = duckdb.connect()
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})  # noqa: F841
    duck.execute("CREATE TABLE documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(text AS VARCHAR) AS text, CAST(source AS VARCHAR) AS source FROM documents")
    found = duck.execute(SQL[name])
    names = [d[0] for d in found.description]
    return names, sorted(map(plain, found.fetchall()), key=repr)


def plain(row):
    return tuple(round(x, 6) if isinstance(x, float) else x for x in row)


def frame(spark, rows):
    """The table with columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.withColumns({"size": F.lit("s"), "host": F.lit(1), "skey": F.lit(2), "n_words": F.lit("n"), "copies": F.lit(0)}).repartition(5)


def test_mix_as_in_sql(spark):
    names, expected = oracle("op1_mix", ROWS)
    got = mix_report(frame(spark, ROWS)).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
    assert sorted((plain(r) for r in got.select(*names).collect()), key=repr) == expected
    for r in mix_report(frame(spark, ROWS)).collect():
        assert r.copies * r.size <= 3 * r.size
    mixed = mix_sources(frame(spark, ROWS))
    assert mixed.columns == frame(spark, ROWS).columns
    assert mixed.count() == sum(r.copies for r in mix_report(frame(spark, ROWS)).collect())


def test_rules_as_in_sql(spark):
    """The SQL tells documents apart by their ids; a repeated row or a null id is a document all the same."""
    unique = list({r[0]: r for r in ROWS if r[0] is not None}.values())
    names, expected = oracle("op3_host_rules", unique)
    got = apply_rules(frame(spark, unique))
    assert sorted((plain(r) for r in got.select(*names).collect()), key=repr) == expected
    rest = apply_rules(frame(spark, ROWS)).where("doc_id = 1 OR doc_id IS NULL").select("doc_id", "n_words", "word_chars", "n_dup_lines")
    assert sorted(map(tuple, rest.collect()), key=repr) == [(1, 3, 11, 0), (1, 3, 11, 0), (None, 4, 10, 0)]


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "a b", "x"), (1, "a b", "x")]])
def test_few_rows(spark, rows):
    for name, run in (("op1_mix", mix_report), ("op3_host_rules", apply_rules)):
        assert run(frame(spark, rows)).count() == len(rows) == len(oracle(name, rows)[1])


@pytest.mark.parametrize("name", ["op1_mix", "op3_host_rules"])
def test_whole_table_as_in_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = QUERIES[name](spark, sf_dir)
    expected = duck.execute(f"SELECT {', '.join(got.columns)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(plain, got.collect()), key=repr) == sorted(map(plain, expected), key=repr)
