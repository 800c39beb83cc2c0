"""Index lines of given URLs, found by the order of the index.

A packed index has a list of its blocks with the first key of each; only blocks whose keys can be
those wanted are unpacked. A plain index is searched by halving. Both need an index that is sorted by keys
of the usual kind, which is looked at before: an index that is out of order, whose keys are not those of
its URLs, or that has no list of blocks, is read whole, so the result is the same.
"""

from __future__ import annotations

import json
import zipfile
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from archivetables.session import partitions_for
from archivetables.sources.archives import (
    CDX_FILES,
    SPLIT,
    SPLIT_ARROW,
    SPLIT_BYTES,
    _at_members,
    _batch,
    _directory,
    _is_stored,
    _paths,
    _splits,
    block_list,
    is_gapless,
    read_splits,
)
from archivetables.sources.sort_keys import sort_keys
from archivetables.sources.storage import StoredMember, open_input, open_member, open_zip

SAMPLES = 16  # lines of a plain index that are looked at before it is trusted
# A search reads about so much for each key; an index smaller than that is read whole.
SEARCH_BYTES = 4 << 20
HEAD_BYTES = 1 << 16


def lookup_lines(
    archives: DataFrame,
    urls: list[str],
    split_bytes: int = SPLIT_BYTES,
    search_bytes: int = SEARCH_BYTES,
    partitions: int | None = None,
) -> DataFrame:
    """Lines, as ``text_lines`` gives them, of the indexes' parts that can hold the URLs. They hold other URLs
    too. The URLs go to all tasks, so their number must be bounded."""
    n = partitions or partitions_for(archives.sparkSession)
    splits = lookup_splits(archives, urls, split_bytes, search_bytes)
    return read_splits(_at_members(splits, n), n)


def lookup_splits(
    archives: DataFrame,
    urls: list[str],
    split_bytes: int = SPLIT_BYTES,
    search_bytes: int = SEARCH_BYTES,
) -> DataFrame:
    """The parts of the indexes that ``lookup_lines`` reads."""
    keys = sorted({key.encode() for url in urls for key in sort_keys(url)})
    shared = archives.sparkSession.sparkContext.broadcast(keys)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in _paths(batches):
            rows = [
                row
                for info in _directory(path, strict=True)
                if info.filename in CDX_FILES
                for row in _member_splits(path, info, shared.value, split_bytes, search_bytes)
            ]
            if rows:
                yield _batch(rows, SPLIT_ARROW)

    return archives.select("path").mapInArrow(split, SPLIT)


def _member_splits(
    path: str, info: zipfile.ZipInfo, keys: list[bytes], split_bytes: int, search_bytes: int
) -> list[tuple]:
    ranges = None
    if _is_stored(info):
        with open_input(path) as file, open_zip(file, path) as archive:
            source = open_member(file, archive, info.filename)
            if info.filename.endswith(".gz"):
                ranges = _block_ranges(source, block_list(path), info.file_size, keys)
            elif info.file_size > len(keys) * search_bytes:
                ranges = _line_ranges(source, info.file_size, keys)
    if ranges is None:
        return [row for row in _splits(path, "cdx", split_bytes, True) if row[1] == info.filename]
    return [(path, info.filename, start, stop, False, None) for start, stop in ranges]


def _is_usual(line: bytes, key: bytes) -> bool:
    """Whether a line begins with this key, and it is a key of its URL."""
    found, _, rest = line.partition(b" ")
    try:
        url = json.loads(rest[rest.index(b"{") :])["url"]
        return found == key and found.decode() in sort_keys(url)
    except (ValueError, KeyError, TypeError):
        return False


def _block_ranges(
    source: StoredMember, blocks: list[tuple[int, int, bytes]], size: int, keys: list[bytes]
) -> list[tuple[int, int]] | None:
    """Stretches of blocks that can hold a key; none if the list cannot be trusted. A key that begins a
    block may also end the one before it. The first line of the index, and of each stretch, is looked at."""
    firsts = [key for _, _, key in blocks]
    if not blocks or not is_gapless(blocks, size) or firsts != sorted(firsts):
        return None
    if not _is_usual(_first_line(source, 0), firsts[0]):
        return None
    ranges: list[tuple[int, int]] = []
    for (offset, length, first), after in zip(blocks, [*firsts[1:], None], strict=True):
        at = bisect_left(keys, first)
        if at < len(keys) and (after is None or keys[at] <= after):
            if ranges and ranges[-1][1] == offset:
                ranges[-1] = ranges[-1][0], offset + length
            else:
                if not _is_usual(_first_line(source, offset), first):
                    return None
                ranges.append((offset, offset + length))
    return ranges


def _first_line(source: StoredMember, offset: int) -> bytes:
    """The first line of a block; no more of it is unpacked than that takes."""
    source.seek(offset)
    inflater, line = zlib.decompressobj(zlib.MAX_WBITS | 16), b""
    data = source.read(HEAD_BYTES)
    while data and b"\n" not in line and not inflater.eof:
        line += inflater.decompress(data, HEAD_BYTES)
        data = inflater.unconsumed_tail or source.read(HEAD_BYTES)
    return line.partition(b"\n")[0]


def _line_ranges(
    source: StoredMember, size: int, keys: list[bytes]
) -> list[tuple[int, int]] | None:
    """Where the lines of each key are in a plain index; none if it cannot be trusted."""
    starts = [_line_at(source, size * i // SAMPLES, size)[0] for i in range(SAMPLES)]
    lines = [_line_at(source, start, size)[1] for start in starts if start < size]
    firsts = [line.partition(b" ")[0] for line in lines]
    if firsts != sorted(firsts) or not all(map(_is_usual, lines, firsts)):
        return None
    ranges, low = [], 0
    for key in keys:
        start = low = _lower_bound(source, size, low, key)
        while low < size and (line := _line_at(source, low, size)[1]).partition(b" ")[0] == key:
            low += len(line) + 1
        if low > start:
            ranges.append((start, min(low, size)))
    return ranges


def _lower_bound(source: StoredMember, size: int, low: int, key: bytes) -> int:
    """Where the first line from ``low``, itself the start of one, begins whose key is not less."""
    high = found = size
    while low < high:
        middle = (low + high) // 2
        start, line = _line_at(source, middle, size)
        if start >= high:
            high = middle
        elif line.partition(b" ")[0] < key:
            low = start + len(line) + 1
        else:
            high, found = middle, start
    return found


def _line_at(source: StoredMember, at: int, size: int) -> tuple[int, bytes]:
    """The first line that begins at or behind ``at``, and where; ``size`` if there is none."""
    source.seek(max(at - 1, 0))
    held, start = b"", 0 if at == 0 else None
    while True:
        data = source.read(HEAD_BYTES)
        held += data
        if start is None:
            feed = held.find(b"\n")
            if feed >= 0:
                start = feed + 1
            elif not data:
                return size, b""
            else:
                continue
        end = held.find(b"\n", start)
        if end >= 0 or not data:
            begin = max(at - 1, 0) + start
            return (begin, held[start : end if end >= 0 else None]) if begin < size else (size, b"")
