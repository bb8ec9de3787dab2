import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tidecast.llm import lexical_search as ls
from tidecast.llm.oracles import SQL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    """[(item, rank, key, score)] by scoring every document for every item."""
    bags = [(key, Counter(terms(t)), len(terms(t))) for key, t in docs]
    n, total = sum(m > 0 for *_, m in bags), sum(m for *_, m in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in items:
        scored = []
        for key, bag, length in bags:
            score = 0
            for t in terms(text):
                if bag[t]:
                    m = 25 + 75 * length * n // total
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
            if score > 0:
                scored.append((-score, key is not None, key or 0, key))
        out += [(item, i, key, -s) for i, (s, _, _, key) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def made(n, seed):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(n)]


@pytest.fixture
def small(monkeypatch):
    """Blocks, ranges and sets so small that a few hundred documents need many."""
    monkeypatch.setattr(ls, "RANGE", 8)
    monkeypatch.setattr(ls, "BLOCK_DOCS", 64)
    monkeypatch.setattr(ls, "SHORT", 8)
    monkeypatch.setattr(ls, "SET_TERMS", 120)


def test_against_brute_force(spark, small):
    docs = made(500, 1) + [(7, "w1 w2 w2 w3")] * 3 + [(900 + i, "w1 w5 w9") for i in range(30)]
    docs += [(None, "w5 w9 Ärger"), (-4, None), (None, ""), (3, "..."), (1000, "W1 \x85w2 ÉÜ_x-y " * 4000)]
    items = [(i, t) for i, t in made(30, 2)] + [(3, "w1 w5 w9"), (3, "w1 w5 w9"), (None, "Ärger w2"), (77, ""), (78, None), (79, "nowhere")]
    frame = spark.createDataFrame([(t, k, 1, 2) for k, t in docs], "text string, doc_id long, rank int, n string")
    wanted = spark.createDataFrame(items, "item_id long, text string")
    got = ls.search(frame.repartition(5), wanted)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)
    assert sorted(map(tuple, ls.search(frame, wanted, k=3).collect()), key=repr) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ls.search(docs.limit(0), items).count() == 0
    assert ls.search(docs, items.limit(0)).count() == 0
    assert ls.search(docs.select("doc_id", docs.text.substr(1, 0).alias("text")), items).count() == 0
    assert ls.search(docs, items).count() == 1


def test_skipping_leaves_documents_unscored():
    """With a good document in the first range, later ranges of frequent terms are not walked."""
    size = 20_000
    keys = np.arange(size)
    terms = [np.array([0, 1, 2], np.int32) if i < 20 else np.array([0], np.int32) for i in keys]
    sizes = np.array([len(t) for t in terms])
    block = ls.Block(keys, np.full(size, 3), sizes, np.concatenate(terms), np.ones(sizes.sum(), np.int32), size, 3 * size)
    walked, ranges = [], block.ranges
    block.ranges = lambda i: walked.append(i) or ranges(i)
    best = ls.Best(10)
    block.search([(0, 5), (1, 900), (2, 900)], best)
    assert best.keys.tolist() == list(range(10))
    assert len(walked) < 5  # of 10 ranges, one was walked


def test_same_as_sql(spark, sf_dir):
    from tidecast.llm.queries import QUERIES

    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    frame = QUERIES["op11_ranked_search"](spark, sf_dir)
    expected = duck.execute(f"SELECT {', '.join(frame.columns)} FROM ({SQL['op11_ranked_search']})").fetchall()
    assert sorted(map(tuple, frame.collect())) == sorted(expected)
    assert {t for _, t in frame.dtypes} == {"bigint", "int"}
