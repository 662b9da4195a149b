"""Files of our own formats in the shared folder, written by tasks."""

from __future__ import annotations

import re
import uuid


def shared(uri: str):
    """The file system of a shared URI, and the path in it."""
    from pyarrow import fs

    if uri.startswith("/"):
        uri = f"file://{uri}"
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


class whole_file:
    """Writes under a name of its own and renames at the end: a lost or doubled task leaves no half file."""

    def __init__(self, uri: str):
        self.fs, self.path = shared(uri)
        head, _, name = self.path.rpartition("/")
        self.part = f"{head}/_{uuid.uuid4().hex}-{name}"

    def __enter__(self):
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.part, compression=None)
        return self.out

    def __exit__(self, kind, *_):
        self.out.close()
        if kind is None:
            self.fs.move(self.part, self.path)
        else:
            self.fs.delete_file(self.part)
