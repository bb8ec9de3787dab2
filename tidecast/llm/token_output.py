"""Token ids of documents in bit-packed files in ascending key order, and back.

Spark range-sorts the rows; each task encodes its documents and writes its files under temporary
names. One row per file goes into a manifest table, whose running sum gives each file's first
position. Reading is one task per file, by blocks.

The tokenizer works on pieces that never span white space, so the ids of a text are those of its
words one after another. Words are encoded by a worker when they are new and looked up after that.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.llm.common import held, named, pieces, stored
from tidecast.session import bounded_batches, scratch_path

END_ID = 1
KNOWN_WORDS = 500_000  # words a worker remembers, and as many of before that it takes back when they come again
TOGETHER = 512  # new words that are encoded in one call
FILE_IDS = 1 << 26  # ids after which a task begins its next file
MANIFEST = "file string, n_docs long, n_ids long, width int"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds:
    """Ids of texts by a tokenizer whose pieces end in a word-end mark."""

    def __init__(self, path: str):
        import numpy as np
        import regex
        from tokenizers import Tokenizer

        self.np, self.tokenizer = np, Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        # Words of these characters are encoded many at a time: their pieces can be counted surely.
        self.plain = regex.compile(r"[\x21-\x7eÀ-įı-ſ]+")
        # Letters, then marks that no piece joins to them; a dotted capital I becomes a letter and a mark.
        self.ended = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|\xc5[\x80-\xbf])+)([!-&(-/:;=>?@\[-`{-~]+)").fullmatch
        # The pieces the tokenizer's own file describes.
        self.piece = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")

    def _ids(self, text: str):
        """The tokenizer's ids of ``text``, without working out where each one is in it."""
        return self.np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _alone(self, word: str) -> bytes:
        return self._ids(word).tobytes()

    def _recall(self, words: set[bytes]) -> set[bytes]:
        """Take back those of ``words`` that were known before; gives the others."""
        back = words & self.older.keys()
        self.known.update((w, self.older[w]) for w in back)
        return words - back

    def _learn(self, words: set[bytes]) -> None:
        """Remember the ids of new words; those of letters and then marks come from their two parts."""
        known, ended, whole, parted = self.known, self.ended, set(), []
        for raw in self._recall(words):
            m = ended(raw)
            if m:
                parted.append((raw, *m.groups()))
            else:
                whole.add(raw)
        whole |= self._recall({x for _, *parts in parted for x in parts if x not in known})
        self._encode_new(whole)
        for raw, letters, marks in parted:
            known[raw] = known[letters] + known[marks]

    def _encode_new(self, words: set[bytes]) -> None:
        np, together = self.np, []
        for raw in words:
            if raw.isalpha():  # of ASCII letters: one piece
                together.append((raw, 1))
                continue
            word = raw.decode("utf-8", "replace")
            if self.plain.fullmatch(word) and "<|" not in word:
                together.append((raw, 1 if word.isalpha() else len(self.piece.findall(word.lower()))))
            else:
                self.known[raw] = self._alone(word)
        for at in range(0, len(together), TOGETHER):
            run = together[at : at + TOGETHER]
            ids = self._ids(b" ".join([raw for raw, _ in run]).decode())
            ends = np.flatnonzero(self.ends[ids]) + 1
            counts = np.cumsum([n for _, n in run])
            if len(ends) != counts[-1]:
                self.known.update((raw, self._alone(raw.decode())) for raw, _ in run)
                continue
            data, begin = ids.tobytes(), 0
            for (raw, _), stop in zip(run, (ends[counts - 1] * 4).tolist()):
                self.known[raw] = data[begin:stop]
                begin = stop

    @staticmethod
    def _may_lower(text: bytes) -> bool:
        """Whether lower-casing A-Z first changes nothing: no combining marks, no special token's name."""
        return b"\xcc" not in text and b"\xcd" not in text and b"<|" not in text

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian uint32."""
        words = [(x.lower() if self._may_lower(x) else x).split() for x in texts]
        here = set().union(*words)
        new = here - self.known.keys()
        if len(self.known) + len(new) > KNOWN_WORDS:  # words that come often are taken back
            self.older, self.known, new = self.known, {}, here
        self._learn(new)
        get = self.known.__getitem__
        return [b"".join(map(get, w)) for w in words]


def _encoder(path: str) -> WordIds:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path)


def write_tokens(
    docs: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID
) -> DataFrame:
    """Write all texts' ids, each followed by ``end_id``, below ``folder``; gives the manifest.

    Files follow the keys in ascending order, null keys first; rows of the same key follow the hash
    of their text, and equal rows are interchangeable. Null and empty texts are the end id alone.
    An empty table gives no files. The manifest has file, first (position of the file's first id),
    n_docs, n_ids and width. Other columns are not read.
    """

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        from tidecast.llm.bitpack import Writer, width_of
        from tidecast.llm.shared import CommittedFile

        encoder, part, rows = held(_encoder, path), TaskContext.get().partitionId(), []
        width, end = width_of(max(encoder.size, end_id + 1)), end_id.to_bytes(4, "little")
        file = writer = None

        def close() -> None:
            writer.close()
            file.commit()
            rows.append((file.name, len(writer.keys), writer.n_ids, width))

        for keys, values in pieces(batches):
            for k, ids in zip(keys, encoder.encode(values)):
                if writer is None:
                    name = f"ids-{part:06d}-{len(rows):05d}.bin"
                    file = CommittedFile(folder, name)
                    file.name = name
                    writer = Writer(file, width)
                writer.add(k, ids + end)
                if writer.n_ids >= FILE_IDS:
                    close()
                    writer = None
        if writer is not None:
            close()
        if rows:
            columns = [pa.array(c) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([*columns[:3], columns[3].cast(pa.int32())], ["file", "n_docs", "n_ids", "width"])

    bounded_batches(docs.sparkSession)
    ordered = (
        docs.select(named(key).cast("long").alias("key"), named(text).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("key", "tie")
        .sortWithinPartitions("key", "tie")
        .select("key", "text")
    )
    files = stored(ordered.mapInArrow(write, MANIFEST), "token-files")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"), "n_docs", "n_ids", "width")


def read_tokens(manifest: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """Per document from the files: key, start, n_tokens and the crc32 of its ids as uint32."""

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from tidecast.llm.bitpack import Reader
        from tidecast.llm.shared import open_fs

        fs, root = open_fs(folder)
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(f"{root}/{name}") as file:
                    rows: list[tuple] = []
                    for k, at, ids in Reader(file).documents():
                        rows.append((k, first + at, len(ids), zlib.crc32(ids.tobytes())))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    spread = max(1, manifest.count())
    files = manifest.select("file", "first").repartition(spread, "file")
    return files.mapInArrow(read, ROWS).withColumnRenamed("doc_id", key)


def token_rows(spark: SparkSession, docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of ``docs`` to a new place in the shared folder and read the documents back."""
    folder = scratch_path(spark, "token-ids")
    manifest = write_tokens(docs, folder, path or tokenizer_path(), key, text)
    return read_tokens(manifest, folder, key)
