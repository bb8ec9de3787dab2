"""Contents of the files that rows name, and of no other."""

import pytest

from tidecast.sources import images
from tidecast.sources.images import attach_named_files, list_images, write_files


def test_only_named_files_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(images, "HELD", 4000)
    for i in range(6):
        (tmp_path / f"{i}.bin").write_bytes(bytes([i]) * 1000)
    rows = [(k, str(tmp_path / f"{k % 3}.bin"), "x") for k in range(40)] + [(99, f"file:{tmp_path}/5.bin", None), (100, None, "y")]
    table = spark.createDataFrame(rows, "k int, image string, note string").coalesce(1)
    counter = spark.sparkContext.accumulator(0)
    got = {r.k: (r.image, r.note) for r in attach_named_files(table, "image", counter).collect()}
    assert got == {k: (None if p is None else bytes([5 if k == 99 else k % 3]) * 1000, note) for k, p, note in rows}
    assert counter.value == 4000  # three files of forty rows, and one more
    assert attach_named_files(table.limit(0), "image").count() == 0
    assert {(r.path, r.length) for r in list_images(str(tmp_path)).collect()} == {(str(tmp_path / f"{i}.bin"), 1000) for i in range(6)}


def test_missing_files_and_columns(spark, tmp_path):
    table = spark.createDataFrame([(str(tmp_path / "none.bin"),)], "image string")
    with pytest.raises(Exception, match="none.bin"):
        attach_named_files(table, "image").collect()
    with pytest.raises(ValueError, match="valid image column"):
        attach_named_files(table, "picture")


def test_written_files_are_named(spark, tmp_path, monkeypatch):
    """One file per row, repeated and empty ones too, in folders of bounded size."""
    monkeypatch.setattr(images, "FOLDER_FILES", 4)
    values = [None, b"", *(bytes([i]) * i for i in range(30)), b"same", b"same"]
    rows = spark.createDataFrame([(v,) for v in values], "content binary").coalesce(2)
    files = write_files(rows, "content", f"file://{tmp_path}/out")
    assert sorted(r.length for r in files.collect()) == sorted(len(v or b"") for v in values)
    assert files.distinct().count() == len(values) == len(list(tmp_path.rglob("*.bin")))
    assert max(len(list(d.iterdir())) for d in (tmp_path / "out" / "files").iterdir()) <= 4
    got = attach_named_files(files.select("path"), "path").collect()
    assert sorted(bytes(r.path) for r in got) == sorted(v or b"" for v in values)
