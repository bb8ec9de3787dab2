"""Pages as WARC files: range-sorted, rolled by compressed size, with digests and revisits.

One shuffle carries the pages: it sorts them by key, and the notes on which page revisits which are
sorted in among them, so that the task that writes a page has read its note just before. Files are
committed by renaming; one row per file goes into a manifest table. The same input gives the same
records, byte for byte.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm.common import named, stored
from tidecast.session import scratch_path

FILE_BYTES = 256 << 20  # compressed bytes after which the next file begins
LEVEL = 4  # of gzip
DATE = "2000-01-01T00:00:00Z"  # records carry no clock time, so that reruns agree
SPACE = uuid.UUID("6f1f3c1e-6f0a-4b77-9d0e-5a3d8c1f7b10")  # of record ids
CHUNK = 1 << 20
MANIFEST = "file string, n_records long, n_bytes long"
ROWS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, file string"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{key}:{payload_digest}')}>"


def record(key: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP head only."""
    own = digest(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(key, own)),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{own}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Length", str(len(block))),
    ]
    if key is not None:
        fields.append(("X-Key", str(key)))
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c.isprintable() and c != " " else f"%{ord(c):02X}" for c in url)))
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(refers_to, own)),
            ("X-Refers-To-Key", str(refers_to)),
        ]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    """``data`` as a gzip member without time or name."""
    coder = zlib.compressobj(level, zlib.DEFLATED, 31)
    return coder.compress(data) + coder.flush()


def members(stream) -> Iterator[bytes]:
    """The unpacked gzip members of a stream, one at a time."""
    held = stream.read(CHUNK)
    while held:
        coder, parts = zlib.decompressobj(31), []
        while not coder.eof:
            if not held:
                raise ValueError("the last record is cut off")
            parts.append(coder.decompress(held))
            held = coder.unused_data or (b"" if coder.eof else stream.read(CHUNK))
        yield b"".join(parts)
        held = held or stream.read(CHUNK)


def parsed(data: bytes) -> dict:
    """Key, type, digest, payload length and url of a record whose digests hold."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a WARC/1.1 record")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rsplit(b"Content-Length: ", 1)[1])
    own = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if fields["WARC-Block-Digest"] != f"sha1:{digest(block)}" or not revisit and (digest(payload), len(payload)) != (own, length):
        raise ValueError(f"digest of {fields['WARC-Record-ID']} does not hold")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Key"), "payload_bytes": length, "payload_digest": own,
        "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Key"), "url": fields.get("WARC-Target-URI"),
    }


def revisits(pages: DataFrame, key: str, html: str, least: int) -> DataFrame:
    """(key, sha1, refers_to) of every page whose payload a smaller key has too; one row per key and payload."""
    slim = (
        pages.select(named(key).cast("long").alias("key"), F.coalesce(named(html), F.lit("")).cast("binary").alias("body"))
        .where("key IS NOT NULL")
        .select("key", F.sha1("body").alias("sha"), F.octet_length("body").alias("size"))
        .where(F.col("size") >= least)
        .select("key", "sha")
    )
    firsts = slim.groupBy("sha").agg(F.min("key").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return slim.join(firsts.select("sha", "refers_to"), "sha").select("key", "sha", "refers_to").distinct()


def write_warc(
    pages: DataFrame, folder: str, key: str = "page_id", html: str = "html", url: str = "url",
    least: int = 0, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write every page below ``folder`` as WARC files; gives the manifest.

    Of pages with equal payloads of at least ``least`` bytes the smallest key is the response and
    the others revisit it; of equal rows with that key one is the response. Null html is an empty
    payload. A page without a key is always a response, and comes first. A null url leaves its
    header out. An empty table gives no files. Other columns are not read.
    """

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        from tidecast.llm.shared import CommittedFile

        part, rows = TaskContext.get().partitionId(), []
        file, n, at, notes, done = None, 0, None, {}, set()

        def close() -> None:
            file.commit()
            rows.append((file.name, n, file.at))

        for batch in batches:
            body = batch.column(3).cast("binary")
            for i, (k, sha, refers, link) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 4)))):
                if k != at:
                    at, notes, done = k, {}, set()
                if sha is not None:
                    notes[sha] = refers
                    continue
                payload = body[i].as_py() or b""
                own = hashlib.sha1(payload).hexdigest() if notes else ""
                first = notes.get(own)
                again = first is not None and (first != k or own in done)
                done.add(own)
                if file is None:
                    name, n = f"pages-{part:06d}-{len(rows):05d}.warc.gz", 0
                    file = CommittedFile(folder, name)
                    file.name = name
                file.write(member(record(k, link, payload, first, again)))
                n += 1
                if file.at >= file_bytes:
                    close()
                    file = None
        if file is not None:
            close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["file", "n_records", "n_bytes"])

    none = F.lit(None)
    notes = revisits(pages, key, html, least).select("key", "sha", "refers_to", none.cast("string").alias("html"), none.cast("string").alias("url"))
    whole = pages.select(
        named(key).cast("long").alias("key"), none.cast("string").alias("sha"), none.cast("long").alias("refers_to"),
        named(html).cast("string").alias("html"), named(url).cast("string").alias("url"),
    )
    ordered = (
        notes.unionByName(whole)
        .repartitionByRange("key")
        .sortWithinPartitions("key", F.col("sha").asc_nulls_last(), F.xxhash64("html", "url"))
    )
    return stored(ordered.mapInArrow(write, MANIFEST), "warc-files")


def read_warc(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the files in ``manifest``: ``ROWS``. Digests are checked on the way."""

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from tidecast.llm.shared import open_fs

        fs, root = open_fs(folder)
        names = [x.split(" ")[0] for x in ROWS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, kinds)], names)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows: list[dict] = []
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for data in members(stream):
                        rows.append(parsed(data) | {"file": name})
                        if len(rows) == 5_000:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    files = manifest.select("file").repartition(max(1, manifest.count()), "file")
    return files.mapInArrow(read, ROWS)


def warc_rows(spark: SparkSession, pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``pages`` to a new place in the shared folder and read the records back."""
    folder = scratch_path(spark, "warc")
    return read_warc(write_warc(pages, folder, least=least), folder)
