"""Arrays in a shared folder that workers write in parts and map into memory."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyarrow import fs


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder given by URI or plain path."""
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def put(folder: str, name: str, values: np.ndarray) -> None:
    """Write one array; a second attempt of a task replaces it by the same."""
    files, path = opened(folder)
    files.create_dir(path, recursive=True)
    own = f"{path}/.{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(own) as out:
        out.write(values.tobytes())
    files.move(own, f"{path}/{name}")


def mapped(folder: str, name: str, kind: type) -> np.ndarray:
    """One array, mapped into memory and read page by page as it is used.

    A file system that is not mounted on the worker is copied from first, to
    an unnamed file that goes with the process.
    """
    files, path = opened(folder)
    file = f"{path}/{name}"
    size = files.get_file_info(file).size
    if not size:
        return np.zeros(0, kind)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(file, kind, mode="r")
    with tempfile.TemporaryFile() as copy, files.open_input_stream(file) as source:
        while data := source.read(1 << 22):
            copy.write(data)
        copy.flush()
        return np.memmap(copy, kind, mode="r")
