"""Files that tasks write to the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow.fs as pafs


def put(root: str, name: str, content: Callable) -> None:
    """Write a file below ``root``; ``content`` gets the open stream.

    It is written under a name of its own and moved to its place when it is whole. A task that runs
    twice makes the same file, so one that is there already stays.
    """
    fs, path = pafs.FileSystem.from_uri(root)
    fs.create_dir(path, recursive=True)
    own, place = f"{path}/.{name}.{uuid.uuid4().hex}", f"{path}/{name}"
    with fs.open_output_stream(own) as out:
        content(out)
    if fs.get_file_info(place).type == pafs.FileType.NotFound:
        fs.move(own, place)
    else:
        fs.delete_file(own)
