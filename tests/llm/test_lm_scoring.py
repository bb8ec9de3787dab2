import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidecast.llm import context_tree as ct
from tidecast.llm.lm_scoring import fit_tree, corpus_counts, score_texts


def held(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 5 == 1


def plain_tree(texts, nodes):
    """The same tree by recursion over dictionaries; gives log10 of a text."""
    seen = defaultdict(Counter)
    total = 0
    for t in texts:
        t = bytes([255]) * ct.DEPTH + t + bytes([255])
        for i in range(ct.DEPTH, len(t)):
            total += 1
            for d in range(ct.DEPTH + 1):
                seen[t[i - d : i]][t[i]] += 1
    least = max(1, -(-total // nodes))
    kept = {c for c, n in seen.items() if not c or sum(n.values()) >= least}
    children = defaultdict(list)
    for c in kept:
        if c:
            children[c[1:]].append(c)

    def split(counts, prefix, k):
        zero = sum(n for b, n in counts.items() if b >> (8 - k) == prefix and not (b >> (7 - k)) & 1)
        one = sum(n for b, n in counts.items() if b >> (8 - k) == prefix and (b >> (7 - k)) & 1)
        return zero, one

    def log_kt(z, o):
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.log(math.pi) - math.lgamma(z + o + 1)

    def other(c):
        return seen[c] - sum((seen[x] for x in children[c]), Counter())

    def weighted(c, prefix, k):
        own = log_kt(*split(seen[c], prefix, k))
        if len(c) == ct.DEPTH:
            return own
        below = log_kt(*split(other(c), prefix, k)) + sum(weighted(x, prefix, k) for x in children[c])
        return np.logaddexp(own, below) + math.log(0.5)

    def chance(c, history, prefix, k):
        z, o = split(seen[c], prefix, k)
        own = (o + 0.5) / (z + o + 1)
        if len(c) == ct.DEPTH:
            return own
        w = math.exp(math.log(0.5) + log_kt(z, o) - weighted(c, prefix, k))
        deeper = history[len(history) - len(c) - 1 :]
        if deeper in kept:
            return w * own + (1 - w) * chance(deeper, history, prefix, k)
        z, o = split(other(c), prefix, k)
        aside = (o + 0.5) / (z + o + 1) if other(c) else own
        return w * own + (1 - w) * aside

    def score(t):
        t, out = bytes([255]) * ct.DEPTH + t + bytes([255]), 0.0
        for i in range(ct.DEPTH, len(t)):
            for k in range(8):
                p = chance(b"", t[i - ct.DEPTH : i], t[i] >> (8 - k), k)
                out += math.log10(p if (t[i] >> (7 - k)) & 1 else 1 - p)
        return out

    return score


def rows():
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(1, 7))) for _ in range(30)]
    out = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 25))).upper()) for i in range(60)]
    return out + [(100, None), (101, ""), (102, "abc\x00ÿ " * 3), (None, "x y"), (3, out[3][1]), (3, "other words")]


@pytest.mark.parametrize("nodes", [4, 40, 10_000])
def test_tree_is_as_by_recursion(spark, nodes):
    train = [(t or "").encode().lower() for k, t in rows() if not held(k)]
    df = spark.createDataFrame([(t.decode(),) for t in train], "text string").repartition(3)
    tree, plain = fit_tree(corpus_counts(df), nodes), plain_tree(train, nodes)
    texts = [b"", b"a", b"never seen \xf0\x9f\x98\x80", *train[:6]]
    assert np.allclose(tree.log10(texts), [plain(t) for t in texts], rtol=1e-5)
    row = tree.table.reshape(-1, 256).astype(float)
    assert np.allclose((10**row).sum(1), 1, atol=1e-4)


def check(got, data):
    train = [(t or "").encode().lower().split() for k, t in data if not held(k)]
    count = Counter(w for t in train for w in [*t, None])
    n, v, want = sum(count.values()), len(count), []
    for k, t in data:
        tokens = [*(t or "").encode().lower().split(), None]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        want.append((k, held(k), len(tokens), sum(count[w] > 0 for w in tokens), n, round(base, 6)))
    have = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)


def test_scores_of_rows(spark, monkeypatch):
    import tidecast.llm.lm_scoring as module

    monkeypatch.setattr(module, "FREQUENT", 25)
    df = spark.createDataFrame([(k, t, 0) for k, t in rows()], "doc_id long, text string, word int").repartition(4)
    got = score_texts(df).collect()
    check(got, rows())
    plain = plain_tree([(t or "").encode().lower() for k, t in rows() if not held(k)], ct.NODES)
    want = sorted(round(plain((t or "").encode().lower()), 3) for _, t in rows())
    assert np.allclose(sorted(r.score for r in got), want, atol=0.02)
    assert score_texts(df.limit(0)).count() == 0
    check(score_texts(df.where("doc_id = 6 OR doc_id IS NULL")).collect(), [r for r in rows() if r[0] in (6, None)])


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = score_texts(df).collect()
    check(got, [(r.doc_id, r.text) for r in df.collect()])
    own, base = (sum(r[c] for r in got if r.held_out) for c in ("score", "base_score"))
    assert all(r.score < 0 for r in got) and own < 0 and base < 0


def test_nothing_to_learn_from(spark):
    key = next(i for i in range(99) if held(i))
    got = score_texts(spark.createDataFrame([(key, "a b")], "doc_id long, text string")).collect()
    assert got[0].n_known == got[0].train_tokens == 0
    assert abs(got[0].score - 4 * math.log10(1 / 256)) < 1e-4


def test_every_context_has_a_node_whatever_the_corpus(spark, monkeypatch):
    """A context that comes twice is learnt beside much more text, also in several blocks and parts of the tree."""
    import tidecast.llm.lm_scoring as module

    monkeypatch.setattr(module, "HELD_GRAMS", 50)
    monkeypatch.setattr(module, "BLOCK_GRAMS", 100)
    monkeypatch.setattr(module, "RUN", 300)
    rng = random.Random(3)
    data = [(i, " ".join(rng.choice(["aa", "ab", "ba", "bb"]) for _ in range(200))) for i in range(40)]
    data += [(100, "qxzj"), (100, "qxzj"), (next(k for k in range(200, 300) if held(k)), "aqxzj never é")]
    train = [t.encode() for k, t in data if not held(k)]
    assert sum(len(t) + 1 for t in train) > 2 * ct.NODES  # a share of one in NODES would leave out what comes twice
    got = {r.doc_id: r.score for r in score_texts(spark.createDataFrame(data, "doc_id long, text string").repartition(3)).collect()}
    tree, plain = fit_tree(corpus_counts(spark.createDataFrame([(t.decode(),) for t in train], "text string"))), plain_tree(train, 10**9)
    assert np.allclose([got[k] for k, _ in data], tree.log10([t.encode() for _, t in data]), rtol=1e-4)
    assert np.isclose(got[100], plain(b"qxzj"), rtol=1e-5)
