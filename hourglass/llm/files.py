"""Writing binary files to the shared folder: temporary name, then the final one."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or of a plain local path."""
    if re.match(r"[a-z][a-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def commit_file(folder: str, name: str, data: bytes) -> str:
    """Writes ``data`` under a temporary name and moves it to ``name``.

    The content of a name is a function of the input, so that a repeated or
    concurrent attempt replaces the file by the same bytes.
    """
    store, root = located(folder)
    store.create_dir(root, recursive=True)
    temporary = f"{root}/_{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(temporary) as out:
        out.write(data)
    store.move(temporary, f"{root}/{name}")
    return name
