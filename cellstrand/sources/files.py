"""Opening of files by path or URL, local or in any store that pyarrow reaches."""

from __future__ import annotations

import glob
import gzip
import io
import os
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs


def file_system(url: str) -> tuple[pafs.FileSystem, str]:
    """pyarrow's file system of a URL, and the path in it; a path without a scheme is local."""
    if url.startswith("file:"):
        url = url.removeprefix("file:").removeprefix("//")
    if "://" not in url:
        return pafs.LocalFileSystem(), os.path.abspath(url)
    return pafs.FileSystem.from_uri(url.replace("s3a://", "s3://", 1))


def open_input(path: str) -> BinaryIO:
    fs, inner = file_system(path)
    return io.BufferedReader(fs.open_input_stream(inner, compression=None))


def open_at(path: str) -> tuple[pa.NativeFile, int]:
    """A file that can be read from any place, and its size."""
    fs, inner = file_system(path)
    file = fs.open_input_file(inner)
    return file, file.size()


def open_text(path: str) -> io.TextIOWrapper:
    """Text of a file, unpacked if it is gzip by content."""
    raw = io.BufferedReader(open_input(path))
    packed = raw.peek(2)[:2] == b"\x1f\x8b"
    return io.TextIOWrapper(gzip.GzipFile(fileobj=raw) if packed else raw, encoding="utf-8")


def listed(path: str) -> list[str]:
    """Files of a comma list of paths, local ones with wild cards."""
    out: list[str] = []
    for p in path.split(","):
        out += sorted(glob.glob(p)) if "://" not in p and any(c in p for c in "*?[") else [p]
    return out


def files_in(folder: str, suffix: str = "") -> list[str]:
    """URLs of a folder's part files, in order."""
    fs, inner = file_system(folder)
    names = sorted(f.base_name for f in fs.get_file_info(pafs.FileSelector(inner)) if f.base_name.startswith("part-") and f.base_name.endswith(suffix))
    return [f"{folder.rstrip('/')}/{name}" for name in names]


def make_folder(path: str) -> None:
    """Folder of an output file; none for a bare name."""
    folder = os.path.dirname(path)
    if folder:
        fs, inner = file_system(folder)
        fs.create_dir(inner, recursive=True)
