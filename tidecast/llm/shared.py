"""Files in the shared folder, written and read by tasks through pyarrow's file systems."""

from __future__ import annotations

import uuid


def open_fs(uri: str):
    """(file system, path) of a URI or an absolute path; s3a and s3n mean s3."""
    from pyarrow import fs

    scheme, sep, rest = uri.partition("://")
    if sep and scheme in ("s3a", "s3n"):
        uri = f"s3://{rest}"
    elif uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


class CommittedFile:
    """A file written under a temporary name and renamed when whole.

    An attempt that dies leaves only a temporary name. The content is a function of the input, so
    when two attempts finish it does not matter which rename comes last.
    """

    def __init__(self, folder: str, name: str):
        self.fs, root = open_fs(folder)
        self.final, self.temporary = f"{root}/{name}", f"{root}/_temporary/{name}-{uuid.uuid4().hex}"
        self.fs.create_dir(f"{root}/_temporary", recursive=True)
        self.out, self.at = self.fs.open_output_stream(self.temporary), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def commit(self) -> None:
        self.out.close()
        self.fs.move(self.temporary, self.final)
