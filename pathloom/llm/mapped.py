"""Arrays in files of the shared folder, memory-mapped by whoever reads them."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def save(uri: str, *arrays: np.ndarray) -> None:
    """Writes arrays to one file; a second attempt of the same task replaces it with the same."""
    system, path = _open(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    made = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(made) as out:
        out.write(np.array([len(arrays), *(len(a) for a in arrays), *(a.dtype.itemsize for a in arrays)], dtype=np.int64).tobytes().ljust(128, b"\0"))
        for a in arrays:
            out.write(np.ascontiguousarray(a).data if len(a) else b"")
            out.write(b"\0" * (-a.nbytes % 8))
    system.move(made, path)


def narrow(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.uint32 if not len(counts) or int(counts.max()) < 1 << 32 else np.uint64)


def load(uri: str, *dtypes: type | None) -> list[np.ndarray]:
    """The arrays of a file, mapped; without a type they are unsigned, of the size they were written in. From a store that cannot be mapped a copy is made, whose name goes at once."""
    system, path = _open(uri)
    local = path
    if not isinstance(system, fs.LocalFileSystem):
        local = os.path.join(tempfile.gettempdir(), uuid.uuid4().hex)
        with system.open_input_stream(path) as source, open(local, "wb") as copy:
            while block := source.read(1 << 24):
                copy.write(block)
    with open(local, "rb") as file:
        head = np.frombuffer(file.read(128), np.int64)
    n = int(head[0])
    raw = np.memmap(local, dtype=np.uint8, mode="r")
    if local != path:
        os.unlink(local)
    out, at = [], 128
    for length, size, dtype in zip(head[1 : 1 + n].tolist(), head[1 + n : 1 + 2 * n].tolist(), dtypes, strict=True):
        out.append(raw[at : at + length * size].view(dtype or {4: np.uint32, 8: np.uint64}[size]))
        at += length * size + -length * size % 8
    return out
