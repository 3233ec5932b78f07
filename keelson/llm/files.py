"""Byte access to the shared folder from inside tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI and the path in it; a URI without scheme is a local path."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def new_file(folder: str, suffix: str) -> str:
    """A fresh name in a folder. Every attempt of a task writes files of its own; only the names that a
    committed result holds are read later, so retries and speculative copies do no harm."""
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"


def write_stream(uri: str):
    system, path = opened(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None, buffer_size=1 << 20)


def read_range(uri: str, offset: int, length: int) -> bytes:
    system, path = opened(uri)
    with system.open_input_file(path) as f:
        f.seek(offset)
        data = f.read(length)
    if len(data) != length:
        raise ValueError(f"{uri}: {length} bytes at {offset} wanted, {len(data)} there")
    return data
