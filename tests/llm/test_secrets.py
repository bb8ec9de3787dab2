import hashlib
import random
import re

from tidecast.llm.queries import op10_secrets
from tidecast.llm.secrets import scan_secrets

RULES = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def base(text):
    out = []
    for place, (kind, rule, group, least) in enumerate(RULES):
        out += [(m.start(), place, m.end(), kind) for m in rule.finditer(text or "") if len(m[group]) >= least]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out)), [sum(x[3] == r[0] for x in out) for r in RULES]


TEXTS = [
    None, "", "token=token: abcdef1", "PASSWORD : 'hunter22' and secret=abc, api_key=\"x.y-z=1\"",
    "é😀 AKIA" + "Z9" * 8 + " AKIAAKIA12345 x" + "0a1b" * 6 + "0a1b", "deadbeef" * 3 + "g" + "deadbeef" * 2,
    "passwd==" + "q" * 5000 + " token:" * 3000 + " secret=aaaaaa" * 300, "tokenſ=abcdefg apiKey=1234567",
]


def test_base_spans(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, TEXTS[3], "x"), (3, TEXTS[3], "x"), (3, "token=123456", "y")]
    got = scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, kind string").repartition(3))
    have = sorted(((r.doc_id, r.base, [r.n_assign, r.n_access, r.n_hex]) for r in got.collect()), key=repr)
    assert have == sorted(((k, *base(t)) for k, t, _ in rows), key=repr)
    assert scan_secrets(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_whole_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op10_secrets(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        spans, counts = base(docs[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == counts
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert set(filter(None, spans.split(","))) <= set(r.spans.split(","))


def test_random_strings_are_added_and_words_are_not(spark):
    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows, secret = [], set()
    for i in range(400):
        rows.append((i, "see http://a/" + "international2telecommunication" + "s" * (i % 9) + " and 11112222333344445555aaaa"))
    for i in range(400, 460):
        rows.append((i, "key " + "".join(rng.choice(letters) for _ in range(24 + i % 30)) + " end"))
        secret.add(i)
    got = scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    hit = {r.doc_id for r in got if "random:" in r.spans}
    assert len(hit & secret) >= 54
    assert not hit - secret


def test_parts_between_mixed_separators_and_letters_alone(spark):
    rng = random.Random(8)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    rows, secret = [(0, "é api-v1/keys/9f8A7c2kQ0ZtXw41LmB6 end")], {0: (14, 34)}
    for i in range(1, 61):
        own = "".join(rng.choice(letters if i % 2 else letters + "0123456789") for _ in range(24 + i))
        before = "see " if i % 2 else "see api-v1/keys/"
        rows.append((i, before + own + (" end" if i % 2 else "/of-all")))
        secret[i] = (len(before), len(before) + len(own))
    rows += [(i, "see http://a-b/" + "counterrevolutionary/deinstitutionalization-of/" + "e" * 24 + "/all-the-rest") for i in range(61, 161)]
    got = {r.doc_id: r.spans.split(",") for r in scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "random:14:34" in got[0]
    for odd in (0, 1):
        mine = [i for i in secret if i % 2 == odd]
        assert sum(f"random:{secret[i][0]}:{secret[i][1]}" in got[i] for i in mine) >= 0.9 * len(mine)
    assert all(f"random:{t.index('eeee')}:{t.index('eeee') + 24}" not in got[i] for i, t in rows[61:])
