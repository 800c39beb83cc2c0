"""WARC records by position: the lookup join of index pointers with archive bytes.

The pointer rows are shuffled by blocks of the WARC files they point into, sorted by
position, and every task reads its blocks front to back. A file holding a third of all
records is many blocks, so it spreads over many tasks. Payloads leave the reading task
towards the sink; they are not shuffled.
"""

from __future__ import annotations

import re
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import ExitStack

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivetables import schemas
from archivetables.session import partitions_for
from archivetables.sources.archives import WARC_DIR
from archivetables.sources.storage import open_input, open_member, open_zip

# a task reads many blocks, so that blocks of any hash even out, and a block many records
BLOCK_BYTES = 16 << 20
MIN_BLOCK_BYTES = 1 << 20
BLOCKS_PER_TASK = 16
BATCH_BYTES = 8 << 20  # of payloads in an output batch, which a worker holds three times over while it goes out
STRETCH_BYTES = 32 << 20  # of payloads read in the order of their places where the result has another order
USUAL_RECORD = 1 << 14  # bytes of a packed record whose length the index does not give
PACKING = 4  # how much a record grows when it is unpacked, about

HEADERS_ARROW = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))


class ArchiveReadError(RuntimeError):
    """A pointer that leads to no readable record."""


def fetch_warc(
    pointers: DataFrame,
    strict: bool = True,
    n_bytes: int = 0,
    partitions: int | None = None,
    block_bytes: int | None = None,
    batch_bytes: int | None = None,
    staged: DataFrame | None = None,
    order: Column | None = None,
) -> DataFrame:
    """Add ``payload``, ``headers`` and ``payload_problem`` to pointer rows.

    Needs ``wacz_path``, ``filename`` and ``offset_num``; other columns pass through. The
    payload is the HTTP body without transfer and content encoding. A row without a file
    name points nowhere and gets a null payload. A record that cannot be read, or a body that cannot
    be decoded in full, raises; when not ``strict`` it leaves a problem, with a null payload or what
    could be decoded. ``n_bytes``, the size of the archives, sets the number of tasks and the size of
    blocks. Files that ``staged`` names (see ``stage_packed``) are read from there.

    With ``order`` the result is sorted by it, without moving a payload: the pointers are dealt by ranges of
    that order, and each task reads its own in stretches of ``batch_bytes``, within them by place.
    """
    n = partitions or partitions_for(pointers.sparkSession, n_bytes)
    if block_bytes is None:
        even = n_bytes // (n * BLOCKS_PER_TASK) if n_bytes else BLOCK_BYTES
        block_bytes = max(MIN_BLOCK_BYTES, min(even, BLOCK_BYTES))
    if staged is not None:
        # a row per packed file; the join keeps the number of pointers
        pointers = pointers.join(staged.drop("staged_bytes"), ["wacz_path", "filename"], "left")
    key_at = [
        pointers.columns.index(c)
        for c in ("wacz_path", "filename", "offset_num", "staged_path")
        if c in pointers.columns
    ]
    length_at = pointers.columns.index("length") if "length" in pointers.columns else None
    schema = T.StructType(
        pointers.schema.fields
        + [
            T.StructField("payload", T.BinaryType()),
            T.StructField("headers", T.DataType.fromDDL(schemas.HEADERS)),
            T.StructField("payload_problem", T.StringType()),
        ]
    )

    in_order = order is not None
    if batch_bytes is None:
        batch_bytes = STRETCH_BYTES if in_order else BATCH_BYTES

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read(key: tuple) -> tuple:
            record = records.read(*key)
            if strict and record[2]:
                raise ArchiveReadError(f"{record[2]}: {key[:3]}")
            return record

        with _Records() as records:
            for batch in batches:
                keys = list(zip(*(batch.column(i).to_pylist() for i in key_at), strict=True))
                if in_order:
                    lengths = [None] * len(keys) if length_at is None else batch.column(length_at).to_pylist()
                    for first, last in _stretches(lengths, batch_bytes):
                        found: list[tuple] = [()] * (last - first)
                        for i in sorted(range(first, last), key=lambda i: _place(keys[i])):
                            found[i - first] = read(keys[i])
                        yield _extend(batch.slice(first, last - first), found)
                    continue
                found, size, first = [], 0, 0
                for key in keys:
                    found.append(read(key))
                    size += len(found[-1][0] or b"")
                    if size >= batch_bytes:
                        yield _extend(batch.slice(first, len(found)), found)
                        first += len(found)
                        found, size = [], 0
                if found:
                    yield _extend(batch.slice(first, len(found)), found)

    if in_order:
        # a hash at the end, so that rows of one rank can still be dealt to several tasks
        ranged = pointers.repartitionByRange(n, order, F.xxhash64("wacz_path", "filename"))
        return ranged.sortWithinPartitions(order).mapInArrow(fetch, schema).drop("staged_path")
    block = F.expr(f"offset_num div {block_bytes}")
    # rows that point nowhere read nothing; they are dealt out, or all would meet in one task
    spread = F.when(F.col("filename").isNull(), F.monotonically_increasing_id())
    return (
        pointers.repartition(n, "wacz_path", "filename", block, spread)
        .sortWithinPartitions("wacz_path", "filename", "offset_num")
        .mapInArrow(fetch, schema)
        .drop("staged_path")
    )


def _place(key: tuple) -> tuple:
    return tuple((part is not None, part) for part in key[:3])


def _stretches(lengths: list[str | None], n_bytes: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose packed records take so many bytes together, by the index's word."""
    first, size = 0, 0
    for i, length in enumerate(lengths):
        size += int(length) if length and length.isascii() and length.isdigit() else USUAL_RECORD
        if size >= n_bytes // PACKING:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(lengths):
        yield first, len(lengths)


def _extend(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
    payloads, headers, problems = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays(
        batch.columns
        + [
            pa.array(payloads, pa.binary()),
            pa.array(headers, HEADERS_ARROW),
            pa.array(problems, pa.string()),
        ],
        names=batch.schema.names + ["payload", "headers", "payload_problem"],
    )


class _Records:
    """Reads records in pointer order, keeping one archive and one member open."""

    def __init__(self) -> None:
        self._open = ExitStack()
        self._file = self._archive = self._member = None
        self._archive_key = self._member_key = self._record_key = None
        self._record: tuple = ()

    def __enter__(self) -> _Records:
        return self

    def __exit__(self, *error: object) -> None:
        self._open.close()

    def read(
        self, path: str, filename: str | None, offset: int | None, staged: str | None = None
    ) -> tuple:
        """``(payload, headers, problem)``; repeated pointers are read once."""
        if (path, filename, offset) != self._record_key:
            self._record_key = (path, filename, offset)
            try:
                self._record = self._read(path, filename, offset, staged)
            except (OSError, EOFError, ValueError, zlib.error, zipfile.BadZipFile) as error:
                self._record = (None, None, f"unreadable record: {error}")
        return self._record

    def _read(
        self, path: str, filename: str | None, offset: int | None, staged: str | None
    ) -> tuple:
        if filename is None:
            return None, None, None
        if offset is None or offset < 0:
            return None, None, "no record position"
        if (staged or path) != self._archive_key:
            self._open.close()
            self._member_key = self._archive_key = None
            self._file = self._open.enter_context(open_input(staged or path))
            if staged is None:
                self._archive = self._open.enter_context(open_zip(self._file, path))
            self._archive_key = staged or path
        if staged is not None:
            self._member = self._file
        elif filename != self._member_key:
            self._member_key = None
            try:
                name = f"{WARC_DIR}/{filename}"
                self._member = open_member(self._file, self._archive, name)
            except KeyError:
                return None, None, "no such WARC file"
            self._member_key = filename
        self._member.seek(offset)
        return http_payload(_ByteStream(self._member))


class _ByteStream:
    """The bytes of one record: unpacked if they begin with the gzip mark."""

    def __init__(self, source) -> None:
        self._source = source
        head = source.read(1 << 14)
        self._inflater = (
            zlib.decompressobj(zlib.MAX_WBITS | 16) if head[:2] == b"\x1f\x8b" else None
        )
        self._buffer = b""
        self._take(head)

    def _take(self, data: bytes) -> bool:
        self._buffer += self._inflater.decompress(data) if self._inflater else data
        return bool(data)

    def _more(self) -> bool:
        if self._inflater is not None and self._inflater.eof:
            return False
        return self._take(self._source.read(1 << 16))

    def head(self) -> bytes:
        """Bytes up to the empty line that ends a header block."""
        seen = 0
        while (end := self._buffer.find(b"\r\n\r\n", seen)) < 0:
            # a bad pointer shows at once, not at the end of the file
            if not self._buffer.startswith(b"WARC/"[: len(self._buffer)]):
                raise ValueError("no WARC record begins here")
            seen = max(0, len(self._buffer) - 3)
            if not self._more():
                raise EOFError("record ends within its headers")
        head, self._buffer = self._buffer[:end], self._buffer[end + 4 :]
        return head

    def body(self, size: int) -> bytes:
        parts, got = [self._buffer], len(self._buffer)
        while got < size:
            self._buffer = b""
            if not self._more():
                raise EOFError(f"record ends after {got} of {size} bytes")
            parts.append(self._buffer)
            got += len(self._buffer)
        return b"".join(parts)[:size]


def http_payload(stream: _ByteStream) -> tuple:
    """``(payload, headers, problem)`` of the WARC record a stream begins with."""
    version, *fields = header_fields(stream.head())
    if not version[0].startswith("WARC/"):
        raise ValueError("no WARC record begins here")
    warc = {name.lower(): value for name, value in fields}
    block = stream.body(int(warc["content-length"])) if "content-length" in warc else b""
    if not warc.get("content-type", "").startswith("application/http"):
        return block, None, None
    head, _, body = block.partition(b"\r\n\r\n")
    _, *headers = header_fields(head)
    body, problem = decode_body(body, {n.lower(): v.lower() for n, v in headers})
    return body, [{"name": n, "value": v} for n, v in headers], problem


def header_fields(head: bytes) -> list[tuple[str, str]]:
    """The first line, as a name, and the ``name: value`` pairs after it, in order.

    A line that begins with white space continues the value before it.
    """
    try:
        text = head.decode("utf-8")
    except UnicodeDecodeError:
        text = head.decode("iso-8859-1")
    first, *lines = text.split("\r\n")
    fields = [(first.strip(), "")]
    for line in lines:
        if line[:1] in (" ", "\t") and len(fields) > 1:
            name, value = fields.pop()
            fields.append((name, f"{value}{line.rstrip()}"))
        elif ":" in line:
            name, _, value = line.partition(":")
            fields.append((name.strip(), value.strip()))
    return fields


def decode_body(body: bytes, headers: dict[str, str]) -> tuple[bytes, str | None]:
    """Undo chunked transfer and content encodings, the last one applied first.

    Archives often hold bodies that are decoded already: one that does not begin as its headers say is
    taken as it stands. One that begins so and breaks off, or whose encoding we cannot undo, is
    reported, and returned as far as it was decoded."""
    if headers.get("transfer-encoding", "").strip() == "chunked":
        body, problem = _join_chunks(body)
        if problem:
            return body, problem
    for encoding in reversed(headers.get("content-encoding", "").split(",")):
        name = encoding.strip().removeprefix("x-")
        if name in ("", "identity"):
            continue
        if name not in DECODERS:
            return body, f"content encoding not supported: {name}"
        if not body.startswith(MARKS.get(name, b"")):
            continue
        try:
            body = DECODERS[name](body)
        except ImportError:
            return body, f"content encoding not supported: {name}"
        except Exception as error:  # each decoder has errors of its own
            return body, f"content encoding {name} is broken: {error}"
    return body, None


def _unpacked(body: bytes, bits: int) -> bytes:
    """All members of a zlib or gzip body; one that is cut short is an error."""
    parts = []
    while body:
        inflater = zlib.decompressobj(bits)
        parts.append(inflater.decompress(body) + inflater.flush())
        if not inflater.eof:
            raise EOFError("the body ends within a member")
        body = inflater.unused_data.lstrip(b"\0")
    return b"".join(parts)


def _gunzip(body: bytes) -> bytes:
    return _unpacked(body, zlib.MAX_WBITS | 16)


def _deflate(body: bytes) -> bytes:
    """With or without the zlib frame: servers send both under this name. Without it nothing marks a
    body as packed, so one that cannot be unpacked is taken as it stands."""
    if len(body) > 1 and body[0] & 15 == 8 and int.from_bytes(body[:2]) % 31 == 0:
        return _unpacked(body, zlib.MAX_WBITS)
    try:
        return _unpacked(body, -zlib.MAX_WBITS)
    except zlib.error:
        return body


def _brotli(body: bytes) -> bytes:
    import brotli

    return brotli.decompress(body)


def _zstd(body: bytes) -> bytes:
    import zstandard

    inflater, parts = zstandard.ZstdDecompressor(), []
    while body:
        one = inflater.decompressobj()
        parts.append(one.decompress(body))
        if not one.eof:
            raise EOFError("the body ends within a frame")
        body = one.unused_data
    return b"".join(parts)


# fixed values: what packed bodies begin with
MARKS = {"gzip": b"\x1f\x8b", "zstd": b"\x28\xb5\x2f\xfd"}
DECODERS = {"gzip": _gunzip, "deflate": _deflate, "br": _brotli, "zstd": _zstd}


def _join_chunks(body: bytes) -> tuple[bytes, str | None]:
    """The chunks of a body joined, up to the first size that is no hexadecimal number."""
    if not re.match(rb"[0-9A-Fa-f]+[ \t]*(;[^\r\n]*)?\r\n", body):
        return body, None
    parts, at = [], 0
    while at < len(body):
        line_end = body.find(b"\r\n", at)
        size_text = body[at : line_end if line_end >= 0 else None].split(b";")[0].strip()
        if line_end < 0 or not re.fullmatch(rb"[0-9A-Fa-f]+", size_text):
            return b"".join(parts), "chunked body is broken: no chunk size"
        size = int(size_text, 16)
        if size == 0:
            return b"".join(parts), None
        chunk = body[line_end + 2 : line_end + 2 + size]
        parts.append(chunk)
        if len(chunk) < size:
            break
        at = line_end + 2 + size + 2
    return b"".join(parts), "chunked body ends early"
