import random
from collections import Counter

import numpy as np

from tidecast.llm.decontamination import Index, benchmark_matches, drop_contaminated

NAMES = "doc_id long, text string, item_id long"


def grams(text):
    w = (text or "").encode().lower().split()
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def brute(docs, items):
    """Best weighted similarity over every run of shingles of every document."""
    out = {}
    for k, text in docs:
        g = grams(text)
        for item, wanted in items:
            need = Counter(grams(wanted))
            total, best = sum(need.values()), 0.0
            for a in range(len(g)):
                if g[a] not in need:
                    continue
                seen, shared = Counter(), 0
                for b in range(a, min(len(g), a + 2 * total)):
                    seen[g[b]] += 1
                    shared += seen[g[b]] <= need[g[b]]
                    best = max(best, shared / (total + b - a + 1 - shared))
            if best >= 0.75:
                out[(k, item)] = best
    return out


def test_planted_passages(spark):
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([14, 15, 19, 22, 27, 31, 36, 40, 44, 51, 59, 75, 120])]
    docs, key = [], 0
    for i, text in items:
        w = text.split()
        forms = [w, w[1:], w[:-1], w[: len(w) // 2], [x.upper() for x in w]]
        forms.append([*w[: len(w) // 4], *w[len(w) // 4 + 1 :]] if len(w) > 40 else w)
        forms.append([*w[: len(w) // 2], "changed", *w[len(w) // 2 + 1 :]] if len(w) > 42 else w)
        for form in forms:
            around = [[word() for _ in range(rng.randrange(0, 300))] for _ in range(2)]
            docs.append((key, " ".join([*around[0], *form, *around[1]])))
            key += 1
    docs += [(900, None), (901, ""), (902, " ".join(word() for _ in range(5000))), (903, items[3][1] + " " + items[5][1])]
    docs += [(None, items[0][1]), (904, items[0][1]), (904, items[0][1]), (905, "a b c d")]
    shorts = [(50, "a b c d"), (51, None), (52, ""), (53, "\n")]
    df = spark.createDataFrame([(k, t, 0) for k, t in docs], NAMES).repartition(4)
    marks = spark.createDataFrame(items + shorts, "item_id long, text string")
    rows = benchmark_matches(df, marks).collect()
    want = brute(docs, items)
    got = {(r.doc_id, r.item_id): r.similarity for r in rows}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert sum(r.doc_id == 904 for r in rows) == 2
    kept = drop_contaminated(df, marks)
    assert kept.columns == df.columns
    hit = {k for k, _ in want}
    assert sorted((r.doc_id for r in kept.collect())) == sorted(k for k, _ in docs if k not in hit)
    assert benchmark_matches(df.limit(0), marks).count() == benchmark_matches(df, marks.limit(0)).count() == 0


def test_whole_table(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    docs, items = read("documents"), read("benchmark")
    got = {(r.doc_id, r.item_id) for r in benchmark_matches(docs, items).collect()}
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == set(want)


def test_every_print_within_the_radius_is_found():
    rng = np.random.default_rng(2)
    own = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    index = Index(())
    table = index._table([(int(x), i, 0) for i, x in enumerate(own)])
    asked = own[rng.integers(0, 300, 5000)].copy()
    for k in range(5000):
        for bit in rng.choice(64, k % 12, replace=False):
            asked[k] ^= np.uint64(1) << np.uint64(bit)
    got = {(int(a), int(b)) for w, f in index.near(asked, table) for a, b in zip(w, f)}
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(np.bitwise_count(asked[:, None] ^ own[None, :]) <= 8))}
    assert got == want


def test_insertions_and_scattered_edits():
    """Copies with words inserted in the middle, up to what the threshold allows, or changed here and there."""
    rng = random.Random(31)
    word = lambda: f"w{rng.randrange(3000)}"
    found = 0
    for t in range(160):
        n = [14, 22, 36, 59, 75, 120, 300, 59][t % 8]
        w = [word() for _ in range(n)]
        form = list(w)
        if t % 8 == 7:
            form[n // 2 : n // 2] = [word() for _ in range(7)]
        elif t % 2:
            form[n // 2 : n // 2] = [word() for _ in range(rng.randrange(1, n // 3))]
        else:
            for _ in range(max(1, n // 45)):
                form[rng.randrange(n)] = "edit"
        text = " ".join([word() for _ in range(rng.randrange(200))] + form + [word() for _ in range(100)])
        want = brute([(0, text)], [(1, " ".join(w))])
        got = Index(((1, " ".join(w).encode()),)).scan([b"a b", text.encode(), b""], 75)
        assert not got[0] and not got[2]
        assert got[1].keys() == {item for _, item in want}
        assert all(abs(got[1][item][0] - s) < 1e-9 for (_, item), s in want.items())
        found += len(want)
    assert found >= 80
