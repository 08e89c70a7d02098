"""Opening landing files where they lie, in tasks."""

from __future__ import annotations


def open_file(path: str):
    """Seekable reader for a local or shared-folder path."""
    if path.startswith("file:"):
        return open("/" + path[len("file:"):].lstrip("/"), "rb")
    if "://" not in path:
        return open(path, "rb")
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def create_file(path: str):
    """Writer for a new local or shared-folder file; missing folders are made."""
    import os

    if path.startswith("file:") or "://" not in path:
        local = "/" + path[len("file:"):].lstrip("/") if path.startswith("file:") else path
        os.makedirs(os.path.dirname(local), exist_ok=True)
        return open(local, "wb")
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    system.create_dir(os.path.dirname(name), recursive=True)
    return system.open_output_stream(name)
