"""Files that tasks write to, and map from, the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid


def write_once(folder: str, name: str, parts: list[bytes]) -> None:
    """Write under another name, then rename: a task that runs twice leaves one whole file."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    attempt = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(attempt) as out:
        for part in parts:
            out.write(part)
    system.move(attempt, f"{path}/{name}")


def mapped(folder: str, name: str):
    """The file's bytes as a memory map, or None if there is none.

    A folder that is no mounted path is read once into a file without a name, which goes with the worker.
    """
    import numpy as np
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    found = system.get_file_info(f"{path}/{name}")
    if found.type != fs.FileType.File or not found.size:
        return None
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(f"{path}/{name}", dtype=np.uint8, mode="r")
    with tempfile.TemporaryFile() as copy, system.open_input_stream(f"{path}/{name}") as source:
        while block := source.read(1 << 24):
            copy.write(block)
        copy.flush()
        return np.memmap(copy, dtype=np.uint8, mode="r")
