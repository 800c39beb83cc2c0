"""Web archive containers (WACZ: a zip of page lists, indexes, logs and WARC files).

Nothing here runs on the driver but planning: Spark lists the archives, tasks read the zip
directories, and the text members are cut into splits that tasks read independently, so
one huge archive spreads over many tasks like many small ones.
"""

from __future__ import annotations

import json
import zipfile
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from archivetables import schemas
from archivetables.session import partitions_for
from archivetables.sources.gzip_members import Chain, search
from archivetables.sources.storage import open_input, open_member, open_zip

# fixed values: where a WACZ file keeps its parts
PAGES_FILES = ["pages/pages.jsonl", "pages/extraPages.jsonl"]
CDX_FILES = ["indexes/index.cdx.gz", "indexes/index.cdxj"]
WARC_DIR = "archive"
LOG_DIR = "logs"

CDX_BLOCKS_FILE = "indexes/index.idx"

SPLIT_BYTES = 32 << 20
CHUNK_BYTES = 1 << 20


def list_archives(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(path, length)`` of every file the paths or globs name; no content is read.

    Spark's listing passes over files of zero bytes and names that begin with ``_`` or ``.``; where the
    file system counts more files than Spark, those are added.
    """
    found = spark.read.format("binaryFile").load(paths).select("path", "length")
    statuses = _statuses(spark, [paths] if isinstance(paths, str) else paths)
    if sum(map(len, statuses)) == found.count():
        return found
    rows = [
        (s.getPath().toString(), s.getLen())
        for group in statuses
        for s in group
        if s.isFile() and (not s.getLen() or s.getPath().getName()[:1] in "_.")
    ]
    return found.unionByName(spark.createDataFrame(rows, "path string, length bigint"))


def _statuses(spark: SparkSession, paths: list[str]) -> list:
    """Hadoop's file statuses for each path or glob, folders opened; names and lengths only."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    groups = []
    for text in paths:
        path = jvm.org.apache.hadoop.fs.Path(text)
        system = path.getFileSystem(conf)
        named = system.globStatus(path) or []
        groups += [system.listStatus(s.getPath()) if s.isDirectory() else [s] for s in named]
    return groups


def archive_bytes(archives: DataFrame) -> int:
    """Size of all archives together, from the listing."""
    return archives.agg(F.sum("length")).first()[0] or 0


def member_kind(member: Column) -> Column:
    return (
        F.when(member.isin(PAGES_FILES), "pages")
        .when(member.isin(CDX_FILES), "cdx")
        .when(member == CDX_BLOCKS_FILE, "blocks")
        .when(member.startswith(f"{WARC_DIR}/"), "warc")
        .when(member.startswith(f"{LOG_DIR}/"), "log")
        .otherwise("other")
    )


def wacz_members(archives: DataFrame, strict: bool = True) -> DataFrame:
    """Directory of every archive: ``wacz_path, member, kind, size, stored``.

    An unreadable archive raises; when not ``strict`` it gives one row without a member.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in _paths(batches):
            rows = [
                (path, info.filename, info.file_size, _is_stored(info))
                for info in _directory(path, strict)
            ]
            yield _batch(rows or [(path, None, None, None)], MEMBER_ARROW)

    rows = archives.select("path").mapInArrow(read, schemas.MEMBER)
    kind = F.when(F.col("member").isNotNull(), member_kind(F.col("member")))
    return rows.select("wacz_path", "member", kind.alias("kind"), "size", "stored")


def text_lines(
    archives: DataFrame,
    kind: str,
    strict: bool = True,
    split_bytes: int = SPLIT_BYTES,
    partitions: int | None = None,
) -> DataFrame:
    """Lines of the text members of one kind: ``pages``, ``cdx`` or ``log``.

    ``line`` holds the bytes without the line feed, ``line_pos`` where it begins in the
    (unpacked) split; it is 0 for the first line of a member only in the split that starts
    at 0, and grows along the member.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in _paths(batches):
            rows = _splits(path, kind, split_bytes, strict)
            if rows:
                yield _batch(rows, SPLIT_ARROW)

    n = partitions or partitions_for(archives.sparkSession)
    splits = archives.select("path").mapInArrow(split, SPLIT)
    if kind == "cdx" or kind.endswith(".gz"):
        splits = _at_members(splits, n)
    return read_splits(splits, n)


def read_splits(splits: DataFrame, partitions: int) -> DataFrame:
    """The lines that begin in each of the splits."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _read_split(**row)

    dealt = splits.repartition(partitions, "wacz_path", "member", "start")
    return dealt.mapInArrow(read, schemas.LINE)


def _at_members(splits: DataFrame, partitions: int) -> DataFrame:
    """Splits of packed members without a block list, cut where a gzip member begins. Each is searched by a
    task of its own; what they found is then put together in order. Other splits stay as they are."""

    def opened(row: dict):
        return open_input(row["wacz_path"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                places = (None, None, None)
                if row["before"] == UNKNOWN:
                    with opened(row) as file, open_zip(file, row["wacz_path"]) as archive:
                        source = open_member(file, archive, row["member"])
                        size = archive.getinfo(row["member"]).file_size
                        places = search(source, row["start"], row["stop"], size) or places
                found.append((*row.values(), *places))
            if found:
                yield _batch(found, FOUND_ARROW)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member, chain, held, size = None, Chain(), None, 0

        def last() -> Iterator[pa.RecordBatch]:
            if held:
                yield _batch([(*member, held[0], size, held[0] == 0, held[1])], SPLIT_ARROW)

        for batch in batches:
            for row in batch.to_pylist():
                if row["before"] != UNKNOWN:
                    yield _batch([tuple(row[n] for n in SPLIT_ARROW.names)], SPLIT_ARROW)
                    continue
                here = row["wacz_path"], row["member"]
                if here != member:
                    yield from last()
                    member, chain, held = here, Chain(), None
                found = None if row["entry"] is None else (row["entry"], row["exit"], row["last"])
                with opened(row) as file, open_zip(file, row["wacz_path"]) as archive:
                    source = open_member(file, archive, row["member"])
                    size = archive.getinfo(row["member"]).file_size
                    cut = chain.take(source, row["start"], row["stop"], size, found)
                if cut is not None:
                    if held:
                        yield _batch([(*member, held[0], cut[0], False, held[1])], SPLIT_ARROW)
                    held = cut
        yield from last()

    searched = splits.repartition(partitions, "wacz_path", "member", "start").mapInArrow(
        find, f"{SPLIT}, entry bigint, exit bigint, last bigint"
    )
    ordered = searched.repartition(partitions, "wacz_path", "member").sortWithinPartitions(
        "wacz_path", "member", "start"
    )
    return ordered.mapInArrow(join, SPLIT)


def member_lines(archives: DataFrame, member: str, **options) -> DataFrame:
    """Lines of one named member, in every archive that has it."""
    kinds = {**dict.fromkeys(PAGES_FILES, "pages"), **dict.fromkeys(CDX_FILES, "cdx")}
    kind = kinds.get(member, member)
    return text_lines(archives, kind, **options).where(F.col("member") == member)


MEMBER_ARROW = pa.schema(
    [
        ("wacz_path", pa.string()),
        ("member", pa.string()),
        ("size", pa.int64()),
        ("stored", pa.bool_()),
    ]
)
SPLIT = "wacz_path string, member string, start bigint, stop bigint, whole boolean, before bigint"
SPLIT_ARROW = pa.schema(
    [
        ("wacz_path", pa.string()),
        ("member", pa.string()),
        ("start", pa.int64()),
        ("stop", pa.int64()),
        ("whole", pa.bool_()),
        ("before", pa.int64()),
    ]
)
FOUND_ARROW = pa.schema(
    [*SPLIT_ARROW, ("entry", pa.int64()), ("exit", pa.int64()), ("last", pa.int64())]
)
UNKNOWN = -1  # where the gzip member before a split begins, as long as members are not found


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[str]:
    for batch in batches:
        yield from batch.column(0).to_pylist()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _is_stored(info: zipfile.ZipInfo) -> bool:
    return info.compress_type == zipfile.ZIP_STORED


def _directory(path: str, strict: bool) -> list[zipfile.ZipInfo]:
    try:
        with open_input(path) as file, open_zip(file, path) as archive:
            return archive.infolist()
    except (OSError, zipfile.BadZipFile):
        if strict:
            raise
        return []


def _wanted(member: str, kind: str) -> bool:
    if kind == "pages":
        return member in PAGES_FILES
    if kind == "cdx":
        return member in CDX_FILES
    if kind == "log":
        return member.startswith(f"{LOG_DIR}/")
    return member == kind


def _splits(path: str, kind: str, split_bytes: int, strict: bool) -> list[tuple]:
    """Byte ranges of the wanted members. Only what is stored unpacked can be cut: plain
    text anywhere (readers align to lines), gzip text at the blocks its index lists, or, for want of a
    list, anywhere for the time being. ``before`` is where the block before a split begins, null if the
    split is known to begin a line."""
    rows = []
    for info in _directory(path, strict):
        if not _wanted(info.filename, kind):
            continue
        cuts, before = [0], [0]
        if _is_stored(info) and info.file_size > split_bytes:
            if not info.filename.endswith(".gz"):
                before = cuts = list(range(0, info.file_size, split_bytes))
            else:
                cuts, before = _block_cuts(path, info, split_bytes)
                if cuts is None:
                    cuts = list(range(0, info.file_size, split_bytes))
                    before = [UNKNOWN] * len(cuts)
        stops = cuts[1:] + [info.file_size]
        rows += [
            (path, info.filename, start, stop, len(cuts) == 1, last)
            for start, stop, last in zip(cuts, stops, before, strict=True)
        ]
    return rows


def block_list(path: str) -> list[tuple[int, int, bytes]]:
    """``(offset, length, first key)`` of each block of the packed index, in order of their place; none
    if the archive has no list of them."""
    with open_input(path) as file, open_zip(file, path) as archive:
        if CDX_BLOCKS_FILE not in archive.namelist():
            return []
        with archive.open(CDX_BLOCKS_FILE) as lines:
            texts = [(line[line.find(b"{") :], line) for line in lines if b'"offset"' in line]
    places = [(json.loads(text), line.split(b" ", 1)[0]) for text, line in texts]
    return sorted((p["offset"], p["length"], key) for p, key in places)


def is_gapless(blocks: list[tuple[int, int, bytes]], size: int) -> bool:
    ends = [0, *(offset + length for offset, length, _ in blocks)]
    return [offset for offset, _, _ in blocks] == ends[:-1] and ends[-1] == size


def _block_cuts(
    path: str, info: zipfile.ZipInfo, split_bytes: int
) -> tuple[list[int] | None, list[int] | None]:
    """Starts of gzip members, at least ``split_bytes`` apart, and of the member before each, if the
    block list covers the file without a gap."""
    blocks = block_list(path)
    if not is_gapless(blocks, info.file_size):
        return None, None
    cuts, before, last = [0], [0], 0
    for offset, _, _ in blocks:
        if offset - cuts[-1] >= split_bytes:
            cuts.append(offset)
            before.append(last)
        last = offset
    return cuts, before


def _read_split(
    wacz_path: str, member: str, start: int, stop: int, whole: bool, before: int | None
) -> Iterator[pa.RecordBatch]:
    with open_input(wacz_path) as file, open_zip(file, wacz_path) as archive:
        source = open_member(file, archive, member)
        if member.endswith(".gz"):
            cut = start > 0 and before is not None and not _ends_line(source, before, start)
            source.seek(start)
            if whole:
                runs = _lines(_inflate(_chunks(source, None)), 0, None)
            else:
                runs = _lines(_own_blocks(source, start, stop), 0, None, cut)
        else:
            # a line belongs to the split it begins in; look back one byte to see whether
            # one begins right at the start
            source.seek(max(start - 1, 0))
            runs = _lines(_chunks(source, None), start, None if whole else stop)
        for lines, positions in runs:
            size = len(lines)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([wacz_path] * size, pa.string()),
                    pa.array([member] * size, pa.string()),
                    pa.array(np.full(size, start, dtype=np.int64)),
                    pa.array(positions),
                    pa.array(lines, pa.binary()),
                ],
                names=["wacz_path", "member", "split_start", "line_pos", "line"],
            )


def _chunks(source, limit: int | None) -> Iterator[bytes]:
    while limit is None or limit > 0:
        chunk = source.read(CHUNK_BYTES if limit is None else min(CHUNK_BYTES, limit))
        if not chunk:
            return
        if limit is not None:
            limit -= len(chunk)
        yield chunk


def _ends_line(source, start: int, stop: int) -> bool:
    """Whether the gzip blocks from ``start`` to ``stop`` end with a line feed."""
    source.seek(start)
    last = b""
    for data in _inflate(_chunks(source, stop - start)):
        last = data[-1:] or last
    return last == b"\n"


def _own_blocks(source, start: int, stop: int) -> Iterator[bytes]:
    """The text of the gzip blocks from ``start`` to ``stop``, and of what follows as much as ends the
    last line."""
    last = b""
    for data in _inflate(_chunks(source, stop - start)):
        last = data[-1:] or last
        yield data
    if last == b"\n":
        return
    source.seek(stop)
    for data in _inflate(_chunks(source, None)):
        head, feed, _ = data.partition(b"\n")
        yield head + feed
        if feed:
            return


def _inflate(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """Unpack gzip members standing one behind the other."""
    member = None
    for data in chunks:
        while data:
            if member is None:
                data = data.lstrip(b"\0")
                if not data:
                    break
                member = zlib.decompressobj(zlib.MAX_WBITS | 16)
            yield member.decompress(data, CHUNK_BYTES)
            if member.eof:
                data, member = member.unused_data, None
            else:
                data = member.unconsumed_tail
    if member is not None:
        raise EOFError("gzip text ends within a member")


def _lines(
    chunks: Iterable[bytes], start: int, stop: int | None, cut: bool = False
) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Runs of lines, with positions, of those that begin in ``[start, stop)``.

    A reader with ``start > 0`` begins one byte early and drops all up to the first line
    feed; so does one whose text is ``cut`` in front.
    """
    position = max(start - 1, 0)
    aligned = start == 0 and not cut
    rest = b""
    for chunk in chunks:
        lines = (rest + chunk).split(b"\n")
        rest = lines.pop()
        if not lines:
            continue
        sizes = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines)) + 1
        begins = position + np.concatenate(([0], np.cumsum(sizes)[:-1]))
        position = int(begins[-1] + sizes[-1])
        if not aligned:
            lines, begins = lines[1:], begins[1:]
            aligned = True
        if stop is not None and position >= stop:
            keep = int(np.searchsorted(begins, stop))
            if keep:
                yield lines[:keep], begins[:keep]
            return
        if lines:
            yield lines, begins
    if rest and aligned and (stop is None or position < stop):
        yield [rest], np.array([position], dtype=np.int64)
