import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tidecast.llm import trie
from tidecast.llm.oracles import SQL


def brute(rows):
    """Rows of the trie from (conv, turn, role, text), by walking it."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in turns.items()}
    members, ending = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        seq = own.get(c - c % 20, [])[:h] + own[c][h:]
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ending[tuple(seq)].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(node[-1][1].encode().split()) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in kids[node])
    return sorted(
        (
            min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(ending[n]))).encode()).hexdigest(),
        )
        for n, m in members.items()
    )


def made():
    rng = random.Random(5)
    say = lambda: " ".join(rng.choice(["yes", "no", "why", "so\n so", "Ü b"]) for _ in range(rng.randint(0, 2)))
    rows = [(c, t, rng.choice(["user", "bot"]), say()) for c in range(70) if c != 40 for t in range(rng.randint(1, 5))]
    rows += [(c, t, "user", f"step {t}") for c in (100, 101, 105) for t in range(30 + c % 3)]  # long chains, shared
    rows += [(c, 0, "user", "same") for c in range(200, 300)] + [(c, 1, None, None) for c in range(220, 240)]
    rows += [(7, None, None, "first"), (7, None, None, "first"), (7, 2, "user", ""), (None, 0, "user", "nobody")]
    return rows + [(2**40 + 19, 1, "a", "b " * 5000)]


@pytest.mark.parametrize("chunk", [4096, 4])
def test_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(trie, "CHUNK", chunk)
    rows = made()
    table = spark.createDataFrame([(9, *r, "x") for r in rows], "depth int, conv_id long, turn long, role string, text string, hi string")
    got = trie.conversation_trie(table.repartition(5))
    assert got.columns == "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_small_tables(spark):
    table = spark.createDataFrame([(3, 1, "user", "a b")], "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, trie.conversation_trie(table).collect())) == brute([(3, 1, "user", "a b")])
    assert trie.conversation_trie(table.limit(0)).count() == 0
    assert trie.conversation_trie(table.withColumn("conv_id", F.lit(None).cast("long"))).count() == 0


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """3,000 turns of one conversation in several parts; as many rounds as its length has bits, and some."""
    rounds = []
    plain = trie._round
    monkeypatch.setattr(trie, "_round", lambda live, turn: rounds.append(turn) or plain(live, turn))
    rows = [(20, t, "user", f"t {t % 7}") for t in range(3000)] + [(21, 0, "user", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, trie.conversation_trie(table.repartition(4)).collect())) == brute(rows)
    assert len(rounds) <= 16


def test_same_as_sql(spark, sf_dir):
    from tidecast.llm.queries import QUERIES

    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    frame = QUERIES["op13_prefix_trie"](spark, sf_dir)
    expected = duck.execute(f"SELECT {', '.join(frame.columns)} FROM ({SQL['op13_prefix_trie']})").fetchall()
    assert sorted(map(tuple, frame.collect())) == sorted(expected)
