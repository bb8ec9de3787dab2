import base64
import gzip
import hashlib
import io

from tidecast.llm.shared import open_fs
from tidecast.llm.warc import members, read_warc, warc_rows, write_warc
from tidecast.session import scratch_path

SCHEMA = "page_id long, url string, html string, key string"


def expected(rows, least):
    firsts, seen, out = {}, set(), []
    for k, _, html, _ in rows:
        body = (html or "").encode()
        if k is not None and len(body) >= least:
            firsts[body] = min(k, firsts.get(body, k))
    for k, _, html, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        body = (html or "").encode()
        own = base64.b32encode(hashlib.sha1(body).digest()).decode()
        first = firsts.get(body) if k is not None and len(body) >= least else None
        again = first is not None and (first != k or body in seen)
        if k is not None:
            seen.add(body)
        out.append((k, len(body), own, "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def rows_of(df):
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def pages():
    rows = [(i, f"http://a/{i}", f"<p>{i % 7} é\r\n\r\n</p>" * (i % 5), "x") for i in range(60)]
    rows += [(70, None, None, None), (71, "u \n v", "", "y"), (None, "n", "<p>", "z"), (None, "n", "<p>", "z")]
    return rows + [(2, "http://a/2", rows[2][2], "x"), (90, "long", "ab\n" * 400_000, "x")]


def test_round_trip(spark):
    df = spark.createDataFrame(pages(), SCHEMA).repartition(4)
    assert rows_of(warc_rows(spark, df)) == expected(pages(), 0)
    assert rows_of(warc_rows(spark, df, least=12)) == expected(pages(), 12)
    assert warc_rows(spark, df.limit(0)).count() == 0


def test_files_roll_and_are_plain_gzip(spark):
    df, folder = spark.createDataFrame(pages(), SCHEMA), scratch_path(spark, "warc-test")
    manifest = write_warc(df, folder, file_bytes=1500)
    files = [r.file for r in manifest.collect()]
    assert len(files) > 3
    assert rows_of(read_warc(manifest, folder)) == expected(pages(), 0)
    fs, root = open_fs(folder)
    for name in files:
        data = fs.open_input_file(f"{root}/{name}").read()
        assert gzip.decompress(data) == b"".join(members(io.BytesIO(data)))
    again = scratch_path(spark, "warc-test")
    sizes = lambda m: sorted(tuple(r) for r in m.collect())
    assert sizes(write_warc(df, again, file_bytes=1500)) == sizes(manifest)
