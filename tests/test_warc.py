import gzip
import os
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from archivetables import testing
from archivetables.sources import fetch_warc
from archivetables.sources.storage import locate
from tests.helpers import http_block, warc_file, warc_record, write_archive

SCHEMA = "wacz_path string, filename string, offset_num bigint, note string"


def chunked(data, size=5):
    pieces = [data[i : i + size] for i in range(0, len(data), size)]
    return b"".join(b"%X;ext=1\r\n%s\r\n" % (len(p), p) for p in pieces) + b"0\r\n\r\n"


BODY = "<p>é</p>".encode() * 50
RAW_DEFLATE = zlib.compressobj(wbits=-15)
RECORDS = {
    "plain": (http_block(BODY, ("Content-Type", "text/html")), BODY),
    "empty": (http_block(b""), b""),
    "gzip": (http_block(gzip.compress(BODY), ("Content-Encoding", "GZIP")), BODY),
    "deflate": (http_block(zlib.compress(BODY), ("content-encoding", "deflate")), BODY),
    "raw deflate": (
        http_block(RAW_DEFLATE.compress(BODY) + RAW_DEFLATE.flush(), ("Content-Encoding", "deflate")),
        BODY,
    ),
    "chunked": (http_block(chunked(BODY), ("Transfer-Encoding", "chunked")), BODY),
    "both": (
        http_block(chunked(gzip.compress(BODY), 17), ("Transfer-Encoding", "chunked"), ("Content-Encoding", "gzip")),
        BODY,
    ),
    "not chunked": (http_block(BODY, ("Transfer-Encoding", "chunked")), BODY),
    "not gzip": (http_block(BODY, ("Content-Encoding", "gzip")), BODY),
    "unknown": (http_block(BODY, ("Content-Encoding", "zstd")), BODY),
    "no text": (http_block(b"\xff\xfe"), b"\xff\xfe"),
    "blank lines": (http_block(b"\r\n\r\nx\r\n\r\n"), b"\r\n\r\nx\r\n\r\n"),
}


def fetch(spark, pointers, **options):
    df = spark.createDataFrame(pointers, SCHEMA)
    return {r.note: r for r in fetch_warc(df, **options).collect()}


@pytest.mark.parametrize("pack", [True, False])
@pytest.mark.parametrize("deflate", [True, False])
def test_bodies(spark, tmp_path, pack, deflate):
    data, offsets = warc_file(*(warc_record(block) for block, _ in RECORDS.values()), pack=pack)
    name = "archive/r.warc.gz"
    path = write_archive(tmp_path / "a.wacz", {name: data}, deflate=[name] if deflate else [])
    pointers = [(path, "r.warc.gz", at, note) for note, at in zip(RECORDS, offsets, strict=True)]
    got = fetch(spark, pointers, block_bytes=500, batch_bytes=700)
    assert {note: bytes(r.payload) for note, r in got.items()} == {
        note: body for note, (_, body) in RECORDS.items()
    }


def test_headers(spark, tmp_path):
    head = b"HTTP/1.1 200 OK\r\nSet-Cookie: a=1 \r\nX: one\r\n\ttwo\r\nset-cookie:b\r\nSet-Cookie: c:d\r\nLatin: \xe9\r\n\r\n"
    data, _ = warc_file(warc_record(head + b"x"))
    path = write_archive(tmp_path / "a.wacz", {"archive/r": data})
    got = fetch(spark, [(path, "r", 0, "n")])["n"]
    assert [(h.name, h.value) for h in got.headers] == [
        ("Set-Cookie", "a=1"), ("X", "one\ttwo"), ("set-cookie", "b"), ("Set-Cookie", "c:d"),
        ("Latin", "é"),
    ]


def test_record_without_http(spark, tmp_path):
    data, _ = warc_file(warc_record(b"text", content_type="text/plain", kind="resource"))
    path = write_archive(tmp_path / "a.wacz", {"archive/r": data})
    got = fetch(spark, [(path, "r", 0, "n")])["n"]
    assert (bytes(got.payload), got.headers) == (b"text", None)


def test_big_record_and_repeated_pointers(spark, tmp_path):
    import os

    body = os.urandom(3 << 20)
    data, offsets = warc_file(warc_record(http_block(b"a")), warc_record(http_block(body)))
    path = write_archive(tmp_path / "a.wacz", {"archive/r": data})
    pointers = [(path, "r", offsets[1], str(i)) for i in range(3)] + [(path, "r", 0, "a")]
    got = fetch(spark, pointers, batch_bytes=1 << 20)
    assert [bytes(got[n].payload) == body for n in "012"] == [True] * 3
    assert bytes(got["a"].payload) == b"a"


def test_unreadable_pointers(spark, tmp_path):
    data, offsets = warc_file(warc_record(http_block(b"a")), warc_record(http_block(b"b")))
    path = write_archive(tmp_path / "a.wacz", {"archive/r": data})
    pointers = [
        (path, "r", 0, "good"), (path, "r", 3, "within"), (path, "r", 10**9, "behind"),
        (path, "missing", 0, "member"), (path, "r", None, "null"), (path, "r", -1, "negative"),
        (f"{path}x", "r", 0, "archive"), (path, "r", offsets[1], "good2"),
    ]
    got = fetch(spark, pointers, strict=False, partitions=1)
    assert {n for n, r in got.items() if r.payload is not None} == {"good", "good2"}
    assert got["member"].payload_problem == "no such WARC file"
    assert got["null"].payload_problem == "no record position"
    assert all(r.payload_problem for r in got.values() if r.payload is None)
    with pytest.raises(Exception, match="no such WARC file"):
        fetch(spark, [(path, "missing", 0, "n")])


BROKEN = {
    "cut gzip": (gzip.compress(BODY)[:-9], ("Content-Encoding", "gzip")),
    "cut chunk": (b"400\r\nshort", ("Transfer-Encoding", "chunked")),
    "negative chunk": (b"1\r\nA\r\n-6\r\n", ("Transfer-Encoding", "chunked")),
    "no last chunk": (chunked(BODY)[:-5], ("Transfer-Encoding", "chunked")),
    "unknown": (BODY, ("Content-Encoding", "snappy")),
    "unknown below": (gzip.compress(BODY), ("Content-Encoding", "snappy, gzip")),
    "cut zstd": (zstandard.compress(os.urandom(4000))[:-9], ("Content-Encoding", "zstd")),
}


def test_whole_bodies_of_several_encodings(spark, tmp_path):
    twice = gzip.compress(BODY[:200]) + gzip.compress(BODY[200:])
    bodies = {
        "two members": (twice, ("Content-Encoding", "x-gzip")),
        "stacked": (gzip.compress(zlib.compress(BODY)), ("Content-Encoding", "deflate, gzip")),
        "zstd": (zstandard.compress(BODY), ("Content-Encoding", "zstd")),
        "identity": (BODY, ("Content-Encoding", "identity")),
    }
    data, offsets = warc_file(*(warc_record(http_block(*b)) for b in bodies.values()))
    path = write_archive(tmp_path / "a.wacz", {"archive/r": data})
    got = fetch(spark, [(path, "r", at, n) for n, at in zip(bodies, offsets, strict=True)])
    assert {n: bytes(r.payload) for n, r in got.items()} == dict.fromkeys(bodies, BODY)


def test_broken_bodies_are_reported(spark, tmp_path):
    data, offsets = warc_file(*(warc_record(http_block(*b)) for b in BROKEN.values()))
    path = write_archive(tmp_path / "a.wacz", {"archive/r": data})
    pointers = [(path, "r", at, n) for n, at in zip(BROKEN, offsets, strict=True)]
    assert all(r.payload_problem for r in fetch(spark, pointers, strict=False).values())
    for pointer in pointers:
        with pytest.raises(Exception, match="chunk|encoding"):
            fetch(spark, [pointer])


def test_cut_record_is_no_record(spark, tmp_path):
    data, _ = warc_file(warc_record(http_block(os.urandom(100_000))), pack=False)
    path = write_archive(tmp_path / "a.wacz", {"archive/r": data[:50_000]})
    got = fetch(spark, [(path, "r", 0, "n")], strict=False)["n"]
    assert got.payload is None and "50" not in got.note and "ends after" in got.payload_problem
    with pytest.raises(Exception, match="ends after"):
        fetch(spark, [(path, "r", 0, "n")])


def test_pointers_to_nowhere_spread(spark):
    rows = spark.range(10_000).selectExpr(
        "'a' AS wacz_path", "CAST(NULL AS STRING) AS filename", "CAST(NULL AS BIGINT) AS offset_num"
    )
    parts = fetch_warc(rows, partitions=8).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 3_000


def test_locate_takes_paths_as_written():
    assert locate("file:/a%20b/c d")[1] == "/a%20b/c d"
    assert locate("/a/b")[1] == "/a/b"
    assert locate("file:///a")[1] == "/a"


def test_a_batch_to_pack_is_turned_into_objects_in_small_parts(monkeypatch):
    monkeypatch.setattr(testing, "ROWS_IN_HAND", 3)
    taken = []

    class Batch:
        def __init__(self, rows):
            self.rows = rows

        def __len__(self):
            return len(self.rows)

        def slice(self, first, n):
            return Batch(self.rows[first : first + n])

        def to_pylist(self):
            taken.append(len(self.rows))
            return self.rows

    assert list(testing._rows(Batch(list(range(8))))) == list(range(8)) and taken == [3, 3, 2]
