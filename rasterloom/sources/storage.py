"""File access from inside tasks, by URI, on any file system that Arrow can open."""

from __future__ import annotations

import os
import re
from functools import lru_cache

from pyarrow import fs as arrow_fs

#: Names of files that are not complete begin so.
PARTIAL = "._partial."
_PARTS = re.compile(r"(?s)(?:([A-Za-z][A-Za-z0-9+.-]+):)?(.*)$")


@lru_cache(maxsize=64)
def _filesystem(scheme: str, netloc: str):
    if scheme in ("", "file"):
        return arrow_fs.LocalFileSystem()
    return arrow_fs.FileSystem.from_uri(f"{scheme}://{netloc}/")[0]


def locate(uri: str):
    """(file system, path on it) of a Hadoop path text, in which nothing is percent-encoded."""
    scheme, rest = _PARTS.match(uri).groups()
    scheme = {None: "", "s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    netloc, path = "", rest
    if rest.startswith("//"):
        netloc, _, tail = rest[2:].partition("/")
        path = f"{netloc}/{tail}" if scheme in ("s3", "gs") else f"/{tail}"
    return _filesystem(scheme, netloc), path


def read_bytes(uri: str) -> bytes:
    files, path = locate(uri)
    with files.open_input_stream(path) as stream:
        return stream.read()


def open_replacing(uri: str, token: str):
    """(stream, finish): write under a name that listings skip; ``finish`` moves the file over ``uri``."""
    files, path = locate(uri)
    folder, name = os.path.split(path)
    files.create_dir(folder, recursive=True)
    partial = f"{folder}/{PARTIAL}{name}.{token}"
    stream = files.open_output_stream(partial)

    def finish():
        stream.close()
        files.move(partial, path)

    return stream, finish


def remove(uri: str) -> None:
    files, path = locate(uri)
    files.delete_file(path)


def list_folder(uri: str):
    """Yield (name, size, modified seconds, whether it is a folder) of what lies directly in a folder.

    Links to folders are not followed; a folder that is gone by now is empty, and a file that is gone is left out.
    """
    files, path = locate(uri)
    if isinstance(files, arrow_fs.LocalFileSystem):
        try:
            with os.scandir(path) as entries:
                for entry in entries:
                    if entry.is_dir(follow_symlinks=False):
                        yield entry.name, 0, 0.0, True
                    elif entry.is_file() and not entry.name.startswith(PARTIAL):
                        try:
                            info = entry.stat()
                        except FileNotFoundError:
                            continue
                        yield entry.name, info.st_size, info.st_mtime, False
        except FileNotFoundError:
            return
        return
    for info in files.get_file_info(arrow_fs.FileSelector(path, allow_not_found=True)):
        if info.type == arrow_fs.FileType.Directory or not info.base_name.startswith(PARTIAL):
            folder = info.type == arrow_fs.FileType.Directory
            yield info.base_name, info.size or 0, info.mtime.timestamp() if info.mtime else 0.0, folder
