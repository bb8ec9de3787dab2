"""Files by path, read by tasks through pyarrow's file systems."""

from __future__ import annotations


def store_of(uri: str):
    """(file system, path) of a URI or an absolute path; other spellings of the S3 scheme are S3."""
    from pyarrow import fs

    scheme, mark, rest = uri.partition("://")
    if mark and scheme in ("s3a", "s3n"):
        return fs.FileSystem.from_uri(f"s3://{rest}")
    if uri.startswith("file:/") and not mark:
        return fs.FileSystem.from_uri(uri.removeprefix("file:"))
    return fs.FileSystem.from_uri(uri)

