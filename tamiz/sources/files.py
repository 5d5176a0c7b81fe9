"""Files wherever they lie: plain paths, or URIs of any file system that pyarrow knows (hdfs, s3, gs, file)."""

from __future__ import annotations

import glob
import os
from typing import BinaryIO


def _system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def open_bytes(path: str) -> BinaryIO:
    """A stream from the start; on a cluster every task opens its own."""
    if "://" not in path:
        return open(path, "rb")
    system, inner = _system(path)
    return system.open_input_stream(inner)


def file_size(path: str) -> int:
    if "://" not in path:
        return os.path.getsize(path)
    system, inner = _system(path)
    return system.get_file_info(inner).size


def list_files(path: str) -> list[str]:
    """The files of a folder or a glob, or the file itself, in order of their names. Hidden and marker files are left out."""
    if "://" not in path:
        found = [os.path.join(path, n) for n in os.listdir(path)] if os.path.isdir(path) else glob.glob(path) or [path]
        found = [p for p in found if not os.path.isdir(p)]
    else:
        from pyarrow import fs

        system, inner = _system(path)
        if system.get_file_info(inner).type == fs.FileType.Directory:
            scheme = path.split("://", 1)[0]
            host = path.split("://", 1)[1].removesuffix("/").removesuffix(inner.removesuffix("/"))
            found = [f"{scheme}://{host}{i.path}" for i in system.get_file_info(fs.FileSelector(inner)) if i.type == fs.FileType.File]
        else:
            found = [path]
    return sorted(p for p in found if not os.path.basename(p).startswith((".", "_")))
