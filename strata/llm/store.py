"""Files that tasks write into the shared scratch folder in a format of their own."""

from __future__ import annotations

import uuid
from urllib.parse import unquote, urlparse

from pyarrow import fs


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a plain path or URI; any task on any machine must reach it."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path)
    return fs.FileSystem.from_uri(uri)


def put(folder: str, name: str, data: list[bytes]) -> None:
    """Write a file whole: under a name of its own first, then moved, so a lost or repeated task leaves no half file."""
    system, path = located(folder)
    system.create_dir(path, recursive=True)
    draft = f"{path}/_{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft, compression=None) as out:
        for piece in data:
            out.write(piece)
    system.move(draft, f"{path}/{name}")
