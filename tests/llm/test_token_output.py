import zlib

import numpy as np
import pytest

from tidecast.llm import bitpack, token_output
from tidecast.llm.token_output import WordIds, token_rows, tokenizer_path

TEXTS = [
    "The quick  brown fox, don't you\tKNOW it's 2024?\n",
    "",
    None,
    "élève ÉCOLE İstanbul ΣΊΣΥΦΟΣ naïve",
    "x<|endoftext|>y <|startoftext|> 's'S",
    "日本語 テスト ½ ² á été",
    "word " * 9000,
    "\x1c\x85\xa0 odd spaces",
]


def expected(rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_ids_read_back(spark):
    rows = [(i * 3 % 17, t) for i, t in enumerate(TEXTS)] + [(None, "no key")]
    docs = spark.createDataFrame([(k, t, 5) for k, t in rows], "doc_id long, text string, start long")
    got = [tuple(r) for r in token_rows(spark, docs.repartition(3)).orderBy("start").collect()]
    assert got == expected(rows)


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c")], "doc_id long, text string")
    assert token_rows(spark, docs).count() == 3
    assert token_rows(spark, docs.limit(0)).count() == 0


def test_words_alone_and_together_agree():
    coder = WordIds(tokenizer_path())
    words = [w for t in TEXTS if t for w in t.encode().split()]
    coder._learn(set(words))
    for w in words:
        assert coder.known[w] == coder._alone(w.decode())


@pytest.mark.parametrize("width", [1, 3, 8, 11, 16, 17, 24, 32])
def test_packing_round_trip(width, tmp_path):
    rng = np.random.default_rng(width)
    ids = rng.integers(0, 1 << width, 20_011).astype("<u4")
    assert np.array_equal(bitpack.unpack(bitpack.pack(ids, width), len(ids), width), ids)

    class Out:
        at, data = 0, b""

        def write(self, x):
            self.data += x
            self.at += len(x)

        def size(self):
            return len(self.data)

        def read_at(self, n, at):
            return self.data[at : at + n]

    out = Out()
    writer, cuts = bitpack.Writer(out, width), [0, 0, 5, 8192, 16384, 16390, len(ids)]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        writer.add(k if k else None, ids[a:b].tobytes())
    writer.close()
    reader = bitpack.Reader(out)
    assert [k for k, _, _ in reader.documents(100)] == [None, 1, 2, 3, 4, 5]
    assert np.array_equal(np.concatenate([x for _, _, x in reader.documents(100)]), ids)
    assert np.array_equal(reader.ids(8190, 8200), ids[8190:8200])


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = [tuple(r) for r in token_rows(spark, docs).orderBy("start").collect()]
    assert got == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_marks_and_case():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    texts = ["H̱a H̱.", "<|ENDOFTEXT|>. X<|endoftext|>.", "été. ÉTÉ!? a×b. don't. I'LL... 's'. x_y-z; (a) [b]", "A.B. c,d; ŉ. İ. ÿ!"]
    coder = WordIds(tokenizer_path())
    got = coder.encode([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_that_come_again_are_taken_back(monkeypatch):
    """When a worker knows too many words, those that come again aren't encoded again."""
    monkeypatch.setattr(token_output, "KNOWN_WORDS", 60)
    coder, encoded = WordIds(tokenizer_path()), []
    plain = coder._encode_new
    coder._encode_new = lambda words: (encoded.extend(words), plain(words))
    texts = [("common words. stay " + " ".join(f"x{chr(97 + i)}{chr(97 + j)}" for j in range(20))).encode() for i in range(20)]
    got = [coder.encode([t])[0] for t in texts]
    assert len(coder.known) + len(coder.older) <= 140
    assert len(encoded) == len(set(encoded))
    assert got == [WordIds(tokenizer_path()).encode([t])[0] for t in texts]
