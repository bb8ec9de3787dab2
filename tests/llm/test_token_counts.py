import heapq
import json

import pytest

from tidecast.llm import token_counts as tc
from tidecast.llm.token_output import tokenizer_path

TEXTS = [
    "The quick  brown fox, don't you\tKNOW it's 2024?\n",
    "",
    None,
    " \n\t ",
    "élève ÉCOLE İstanbul ΣΊΣΥΦΟΣ naïve été",
    "x<|endoftext|>y <|startoftext|> 's'S <|endoftext|><|endoftext|>",
    "日本語 テスト ½ ² á été 🙂🙂 ​",
    "word " * 9000,
    "abcdefghij" * 3000,
    "\x1c\x85\xa0 odd spaces",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa !!!???--- 123456789",
    "'take 'll'd'm it'S",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    return lambda text: len(tok.encode(text or "", add_special_tokens=False).ids)


def test_against_library(spark, library):
    rows = [(i if i else None, t, 1, 2) for i, t in enumerate(TEXTS)] + [(3, TEXTS[0], 1, 2)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int, n_tokens int")
    got = tc.token_counts(docs.repartition(3), limit=9)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = [(k, len((t or "").encode()), library(t), library(t) > 9) for k, t, *_ in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    assert tc.token_counts(docs.limit(0)).count() == 0


def test_whole_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tc.token_counts(docs).collect()}
    for r in docs.collect():
        n = library(r.text)
        assert got[r.doc_id] == (len((r.text or "").encode()), n, n > tc.LIMIT)


def test_merging_is_lowest_rank_then_leftmost():
    """Against rescanning all pairs after every merge."""
    model = json.load(open(tokenizer_path()))["model"]
    rules = tc.MergeRules(model["merges"], model["end_of_word_suffix"])

    def rescanned(piece):
        symbols = [rules.inner[b] for b in piece[:-1]] + [rules.last[piece[-1]]]
        while True:
            ranked = [(rules.rank[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in rules.rank]
            if not ranked:
                return len(symbols)
            rank, i = heapq.nsmallest(1, ranked)[0]
            symbols[i : i + 2] = [rules.joined[rank]]

    for piece in [b"a", b"aaaaaaaaa", b"internationalisation", "überraschung".encode(), bytes(range(256)), b"abab" * 40]:
        assert rules.count(piece) == rescanned(piece)


def test_memory_of_counts_is_bounded(monkeypatch, library):
    monkeypatch.setattr(tc, "KNOWN", 8)
    monkeypatch.setattr(tc, "RUN", 64)
    counter = tc.TokenCounter(tokenizer_path())
    for text in TEXTS:
        assert counter.count((text or "").encode()) == library(text)
        assert len(counter.pieces) <= 8
    long = "one two three four " * 50 + "x" * 300 + " tail " * 30
    assert counter.count(long.encode()) == library(long)


def test_other_files_are_refused(tmp_path):
    spec = json.load(open(tokenizer_path()))
    spec["normalizer"] = None
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="isn't a lower-casing"):
        tc.TokenCounter(str(other))
