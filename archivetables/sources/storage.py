"""Seekable files on the paths Spark lists.

Spark's own file readers hand out whole files; archives are read in ranges, so tasks open
them through Arrow's file systems: local and mounted paths, S3, HDFS, GCS.
"""

from __future__ import annotations

import io
import re
import struct
import zipfile

import pyarrow.fs as pafs

READ_BUFFER = 1 << 18

SCHEME_ALIASES = {"s3a": "s3", "s3n": "s3"}


def locate(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path within it. Paths are taken as written, not percent-decoded."""
    match = re.match(r"([A-Za-z][A-Za-z0-9+.\-]*):(?://([^/]*))?(.*)$", path, re.DOTALL)
    if match is None or match[1] == "file":
        return pafs.LocalFileSystem(), match[3] if match else path
    scheme, authority, rest = match[1], match[2] or "", match[3]
    fs, base = pafs.FileSystem.from_uri(
        f"{SCHEME_ALIASES.get(scheme, scheme)}://{authority}/"
    )
    return fs, f"{base.rstrip('/')}/{rest.lstrip('/')}"


def open_input(path: str) -> io.BufferedReader:
    """Open for random reads, with read-ahead so that sorted reads share requests."""
    fs, inner = locate(path)
    return io.BufferedReader(fs.open_input_file(inner), READ_BUFFER)


def open_zip(file: io.BufferedReader, path: str) -> zipfile.ZipFile:
    try:
        return zipfile.ZipFile(file)
    except (ValueError, zipfile.BadZipFile) as error:  # ValueError: shorter than any zip
        raise zipfile.BadZipFile(f"{path}: {error}") from error


class StoredMember:
    """A zip member that is stored unpacked, as a range of the archive: seeking costs
    nothing, and the read-ahead of the archive serves neighbouring reads."""

    def __init__(self, file: io.BufferedReader, info: zipfile.ZipInfo) -> None:
        file.seek(info.header_offset + 26)
        name_size, extra_size = struct.unpack("<HH", file.read(4))
        self._file, self._size = file, info.file_size
        self._begin = info.header_offset + 30 + name_size + extra_size
        self._at = 0

    def seek(self, offset: int) -> None:
        self._at = min(offset, self._size)

    def read(self, size: int) -> bytes:
        self._file.seek(self._begin + self._at)
        data = self._file.read(min(size, self._size - self._at))
        self._at += len(data)
        return data


def open_member(file: io.BufferedReader, archive: zipfile.ZipFile, member: str):
    """Open a member for ``seek`` and ``read``; packed ones are unpacked from their start."""
    info = archive.getinfo(member)
    if info.compress_type == zipfile.ZIP_STORED:
        return StoredMember(file, info)
    return archive.open(info)
