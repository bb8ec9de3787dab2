import random
from itertools import combinations

from pyspark.sql import functions as F

from tidecast.llm import jaccard
from tidecast.llm.common import Stored, near
from tidecast.llm.graph import Growing, components
from tidecast.llm.jaccard import drop_near_duplicates, similar_components
from tidecast.sources.store import names_in


def sets_of(text):
    w = [x.lower() for x in (text or "").encode().split()]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, whole=False):
    sets = [sets_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            root[find(i)] = find(j)
    out = []
    for i, (k, _) in enumerate(rows):
        same = [r[0] for j, r in enumerate(rows) if find(j) == find(i) and r[0] is not None]
        out.append((k, len(sets[i]), min(same) if same else None, rows[i]))
    return out if whole else sorted((r[:3] for r in out), key=repr)


def result(df):
    return sorted(((r.key, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def edited(rng, words, k):
    out = list(words)
    for _ in range(k):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


def test_random_texts(spark):
    rng = random.Random(3)
    rows, key = [], 0
    passage = [f"p{i}" for i in range(60)]
    for _ in range(40):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([6, 12, 40, 90, 200]))]
        for k in (0, 0, 1, 2, 3, 5, 8):
            rows.append((key * 7 % 991, " ".join(edited(rng, base, k)).upper() if k == 3 else "\n".join(edited(rng, base, k))))
            key += 1
    for _ in range(120):  # a passage in many texts that have else little in common
        rows.append((2000 + key, " ".join(passage + [f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(2, 60))])))
        key += 1
    group = [f"g{i}" for i in range(80)]
    for _ in range(80):  # near copies that aren't all linked with each other
        rows.append((3000 + key, " ".join(edited(rng, group, rng.randrange(4)))))
        key += 1
    rows += [(5000, None), (5001, ""), (5002, " \n"), (None, "a b c"), (5003, "A b  c"), (None, "lonely words"), (5004, "a b c d")]
    rows += [(5005, "long " * 30_000), (5005, "long " * 30_000), (5006, "long")]
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, node int").repartition(5)
    assert result(similar_components(df)) == brute(rows)
    assert result(similar_components(df, rounds=1)) == brute(rows)
    check_drop(drop_near_duplicates(df), df, rows)


def check_drop(kept, df, rows):
    assert kept.columns == df.columns
    groups, bare = {}, []
    for k, n, c, (_, t) in brute(rows, True):
        if n:
            groups.setdefault((c, t if c is None else None), []).append(k)
        else:
            bare.append(k)
    want = bare + [min(g, key=lambda k: (k is None, k or 0)) for g in groups.values()]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert result(similar_components(df)) == brute([(r.doc_id, r.text) for r in df.collect()])
    assert similar_components(df.limit(0)).count() == 0


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100 + i * 2) for i in range(1, 20)] + [(7, 7), (200, -5)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert all(got[i] == 0 for i in range(61))
    assert got[200] == got[-5] == -5
    assert len(components(df.limit(0)).collect()) == 0


def test_components_of_links_in_parts(spark):
    rng = random.Random(11)
    parts = [[(rng.randrange(300), rng.randrange(300)) for _ in range(60)] for _ in range(3)] + [[]]
    grown, so_far = Growing(), []
    for part in parts:
        so_far += part
        frame = lambda links: spark.createDataFrame(links, "a long, b long")
        got = {r.node: r.root for r in grown.add(frame(part)).collect()}
        want = {r.node: r.root for r in components(frame(so_far)).collect()}
        # a link of a node with itself makes no component, alone or in parts
        assert {n: r for n, r in got.items() if n != r} == {n: r for n, r in want.items() if n != r}


def test_superseded_tables_are_dropped(spark, monkeypatch):
    made = []
    own = Stored.__init__

    def noted(self, *args, **watch):
        own(self, *args, **watch)
        made.append(self.path)

    monkeypatch.setattr(Stored, "__init__", noted)
    links = spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long")
    assert components(links).count() == 21
    assert len(made) > 2 and [p for p in made if names_in(spark, p)] == made[-1:]


def test_texts_of_candidates_are_not_shuffled(spark, monkeypatch):
    """Sets of the wanted nodes only, hashed where the texts are read, however large the list of nodes is."""
    docs = spark.createDataFrame([(k if k else None, f"a b c d e{k} f") for k in range(3000)], "doc_id long, text string")
    rows = jaccard.profiles(docs, jaccard.costly_shingles(docs))
    nodes = rows.where("key IS NULL OR key % 50 = 0").select("node", "key")
    plans = []
    kept = jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda df, label: plans.append(df._jdf.queryExecution().toString()) or kept(df, label))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sets = jaccard.whole_sets(docs, nodes, nodes.count(), "doc_id", "text")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(r.node for r in sets.collect()) == sorted(r.node for r in nodes.collect())
    physical = plans[0][plans[0].index("== Physical Plan ==") :]
    assert "BroadcastHashJoin" in physical[physical.index("MapInArrow") :]
    assert "SortMergeJoin" not in physical[physical.index("MapInArrow") :].split("Exchange hashpartitioning(node")[0]


def test_marked_rows(spark):
    rows, wanted = spark.range(-100_000, 100_000), spark.range(0, 100_000, 100)
    at = lambda df: F.xxhash64(df["id"])
    met = {r.id for r in near(rows, at(rows), wanted, at(wanted), 1000).collect()}
    assert met >= set(range(0, 100_000, 100))
    assert len(met) < 200_000 / 32
    assert near(rows, at(rows), wanted.limit(0), at(wanted), 0).count() == 0


def test_counts_of_shingles_over_runs(spark, monkeypatch):
    """Runs that a set doesn't fit into, and what is met twice in one of them."""
    docs = spark.createDataFrame([(k, " ".join(f"w{i}" for i in range(30))) for k in range(40)], "doc_id long, text string").coalesce(1)
    for run in (10, 260, 4_000_000):
        monkeypatch.setattr(jaccard, "RUN", run)
        shingles, n = jaccard.costly_shingles(docs)
        # 26 shingles of 40 texts; a run of 260 holds each ten times
        assert len(shingles) == (0 if run == 10 else 26) and set(n) <= {40}
