"""Files that tasks write to the shared folder and read again.

Each attempt of a task writes files under names of its own; what counts is the list of names that
the attempt which Spark accepts returns. So a lost or repeated attempt leaves an unused file and
nothing else.
"""

from __future__ import annotations

import uuid


def own_name(folder: str, suffix: str) -> str:
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def _place(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write(path: str, data: bytes) -> None:
    system, name = _place(path)
    system.create_dir(name.rpartition("/")[0], recursive=True)
    with system.open_output_stream(name, compression=None) as out:
        out.write(data)


def writer(path: str):
    """An open stream to a new file."""
    system, name = _place(path)
    system.create_dir(name.rpartition("/")[0], recursive=True)
    return system.open_output_stream(name, compression=None)


def read(path: str) -> bytes:
    system, name = _place(path)
    with system.open_input_stream(name, compression=None) as source:
        return source.read()


def reader(path: str):
    """An open file that can be read from any place."""
    system, name = _place(path)
    return system.open_input_file(name)
