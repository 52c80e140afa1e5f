"""Files opened and folders listed from inside tasks, by local, hdfs, s3 or gs paths.

Spark hands out the paths; a task opens what it was given, reads the bytes it needs and closes it.
"""

from __future__ import annotations

import re
from functools import cache

from pyarrow import fs

_URI = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)?$", re.S)


@cache
def _remote(scheme: str, authority: str) -> fs.FileSystem:
    return fs.FileSystem.from_uri(f"{scheme}://{authority}/")[0]


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path within it. Names are taken as they are, nothing in
    them is decoded."""
    found = _URI.match(path)
    if not found or found[1] == "file":
        return fs.LocalFileSystem(), found[3] if found else path
    scheme = {"s3a": "s3", "s3n": "s3"}.get(found[1], found[1])
    host, rest = found[2] or "", found[3] or "/"
    within = rest if scheme in ("hdfs", "viewfs") else f"{host}{rest}"
    return _remote(scheme, host), within


def open_file(path: str):
    """A seekable file of a path."""
    system, within = resolve(path)
    return system.open_input_file(within)


def children(path: str) -> list[fs.FileInfo]:
    """What lies directly in a folder; nothing if there is no such folder."""
    system, within = resolve(path)
    return system.get_file_info(fs.FileSelector(within, allow_not_found=True))
