"""Packs tables into archives on the executors, for tests and round-trip queries."""

from __future__ import annotations

import gzip
import json
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from archivetables.sources.archives import (
    CDX_BLOCKS_FILE,
    CDX_FILES,
    LOG_DIR,
    PAGES_FILES,
    WARC_DIR,
)
from archivetables.sources.sort_keys import sort_key
from archivetables.sources.storage import locate

PAGE = (
    "url string, entries array<struct<extra:boolean,title:string,text:string>>, "
    "captures array<struct<mime:string,status:string,http:boolean,"
    "headers:array<struct<name:string,value:string>>,payload:binary>>, log_line string"
)

CDX_BLOCK_LINES = 500
ROWS_IN_HAND = 100  # rows of a batch turned into Python objects at a time


def pack_archives(
    pages: DataFrame,
    folder: str,
    partitions: int,
    pages_per_archive: int = 2000,
    pages_per_warc: int = 500,
    deflate_warcs: bool = False,
    list_blocks: bool = True,
) -> int:
    """Write rows of schema ``PAGE`` as archives into ``folder``; gives their number. On request the WARC
    files are packed within the archives, or the lists of the packed indexes' blocks are left out.

    A row is one URL with its entries in the page lists and its captures. Every task writes
    its rows as they come, beginning a new archive after a number of them, so memory holds
    one archive's rows at most. Captures of a URL follow each other in one WARC file. Names and bytes depend on the rows only, and files get their
    final name when complete, so a repeated task changes nothing.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        rows, count = [], 0
        for batch in batches:
            for row in _rows(batch):
                rows.append(row)
                if len(rows) == pages_per_archive:
                    _write_archive(folder, task, count, rows, pages_per_warc, deflate_warcs, list_blocks)
                    rows, count = [], count + 1
        if rows:
            _write_archive(folder, task, count, rows, pages_per_warc, deflate_warcs, list_blocks)
            count += 1
        yield pa.RecordBatch.from_pydict({"archives": [count]})

    fs, inner = locate(folder)
    fs.create_dir(inner, recursive=True)
    written = (
        pages.repartition(partitions, "url")
        .sortWithinPartitions("url")
        .mapInArrow(write, "archives bigint")
    )
    return written.groupBy().sum("archives").first()[0]


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """A batch's rows, few at a time: as Python objects a whole batch takes several times its bytes."""
    for first in range(0, len(batch), ROWS_IN_HAND):
        yield from batch.slice(first, ROWS_IN_HAND).to_pylist()


def _write_archive(
    folder, task, number, rows, pages_per_warc, deflate_warcs, list_blocks
) -> None:
    name = f"part-{task.partitionId():05d}-{number:05d}.wacz"
    fs, inner = locate(f"{folder}/{name}")
    draft = f"{inner}.{task.taskAttemptId()}.draft"
    with fs.open_output_stream(draft) as stream, zipfile.ZipFile(stream, "w") as archive:
        index = []
        for first in range(0, len(rows), pages_per_warc):
            warc = f"rec-{number}-{first // pages_per_warc}.warc.gz"
            info = _entry(f"{WARC_DIR}/{warc}", deflate_warcs)
            with archive.open(info, "w") as member:
                index += _write_warc(member, warc, rows[first : first + pages_per_warc])
        half = len(index) // 2
        _write_index(archive, sorted(index[:half]), list_blocks)
        _put(archive, CDX_FILES[1], "".join(f"{line}\n" for line in sorted(index[half:])))
        for path, extra in zip(PAGES_FILES, [False, True], strict=True):
            fields = ["title", "text"] if extra else ["title"]
            lines = [
                json.dumps({"url": row["url"]} | {name: entry[name] for name in fields})
                for row in rows
                for entry in row["entries"]
                if entry["extra"] == extra
            ]
            header = json.dumps({"format": "json-pages-1.0", "id": "pages", "title": "All Pages"})
            if lines or not extra:
                text = "".join(f"{line}\n" for line in [header, *lines])
                _put(archive, path, text, deflate=extra)
        log = [r["log_line"] for r in rows if r["log_line"]]
        _put(archive, f"{LOG_DIR}/crawl.log", "".join(f"{line}\n" for line in log), deflate=True)
    fs.move(draft, inner)


def _entry(name: str, deflate: bool) -> zipfile.ZipInfo:
    info = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
    info.compress_type = zipfile.ZIP_DEFLATED if deflate else zipfile.ZIP_STORED
    return info


def _put(archive: zipfile.ZipFile, name: str, text: str | bytes, deflate: bool = False) -> None:
    archive.writestr(_entry(name, deflate), text)


def _write_index(archive: zipfile.ZipFile, lines: list[str], list_blocks: bool) -> None:
    """The packed index: blocks of lines, each a gzip member, and on request the list of blocks."""
    data, blocks = b"", ['!meta 0 {"format": "cdxj-gzip-1.0", "filename": "index.cdx.gz"}']
    for first in range(0, len(lines), CDX_BLOCK_LINES):
        block = lines[first : first + CDX_BLOCK_LINES]
        packed = gzip.compress("".join(f"{line}\n" for line in block).encode(), mtime=0)
        place = json.dumps({"offset": len(data), "length": len(packed)})
        blocks.append(f"{' '.join(block[0].split(' ', 2)[:2])} {place}")
        data += packed
    _put(archive, CDX_FILES[0], data)
    if list_blocks:
        _put(archive, CDX_BLOCKS_FILE, "".join(f"{line}\n" for line in blocks))


def _write_warc(member, name: str, rows: list[dict]) -> list[str]:
    """Write records, one gzip member each; gives their index lines."""
    lines, offset = [], 0
    for row in rows:
        for capture in row["captures"]:
            packed = gzip.compress(_warc_record(row["url"], capture), mtime=0)
            member.write(packed)
            place = {
                "url": row["url"],
                "mime": capture["mime"],
                "status": capture["status"],
                "digest": f"crc32:{zlib.crc32(capture['payload']):08x}",
                "length": str(len(packed)),
                "offset": str(offset),
                "filename": name,
            }
            lines.append(f"{sort_key(row['url'])} 20250101000000 {json.dumps(place)}")
            offset += len(packed)
    return lines


def _warc_record(url: str, capture: dict) -> bytes:
    kind, block = "resource", capture["payload"]
    media = capture["mime"]
    if capture["http"]:
        kind, media = "response", "application/http; msgtype=response"
        pairs = [(h["name"], h["value"]) for h in capture["headers"]]
        head = [f"HTTP/1.1 {capture['status']} OK", *(f"{n}: {v}" for n, v in pairs)]
        body = _encoded(block, {n.lower(): v for n, v in pairs})
        block = ("\r\n".join(head) + "\r\n\r\n").encode() + body
    fields = {
        "WARC-Type": kind,
        "WARC-Target-URI": url,
        "Content-Type": media,
        "Content-Length": str(len(block)),
    }
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def _encoded(body: bytes, headers: dict[str, str]) -> bytes:
    if headers.get("content-encoding") == "gzip":
        body = gzip.compress(body, mtime=0)
    elif headers.get("content-encoding") == "deflate":
        body = zlib.compress(body)
    if headers.get("transfer-encoding") == "chunked":
        pieces = [body[i : i + 1000] for i in range(0, len(body), 1000)]
        body = b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in pieces) + b"0\r\n\r\n"
    return body
