"""Packed WARC files, ordered records, damaged URL lists, keys of index lines."""

import bz2
import gzip
import lzma
import random

import pytest
from pyspark.sql import functions as F

from archivetables import generate_records
from archivetables.operators import cdx_fields, cdx_schema, deleted_urls, parse_cdx
from archivetables.sources import (
    fetch_warc,
    list_archives,
    read_previous_url_list,
    read_url_list,
    scan_url_list,
    stage_packed,
    text_lines,
    url_list_problems,
    wacz_members,
)
from tests.helpers import cdx_line, http_block, page_list, warc_file, warc_record, write_archive

SEEDS, CDXJ = "pages/pages.jsonl", "indexes/index.cdxj"


def crawl(folder, name, n, deflate=True, damaged=False):
    rng = random.Random(name)
    bodies = [rng.randbytes(rng.randrange(10, 3000)) for _ in range(n)]
    data, offsets = warc_file(*(warc_record(http_block(b)) for b in bodies), pack=False)
    urls = [f"https://h/{name}/{i}" for i in range(n)]
    index = "".join(cdx_line(u, "sub/rec.warc", str(at)) for u, at in zip(urls, offsets, strict=True))
    members = {SEEDS: page_list(*({"url": u} for u in urls)), CDXJ: index, "archive/sub/rec.warc": data}
    path = write_archive(folder / f"{name}.wacz", members, deflate=["archive/sub/rec.warc"] if deflate else [])
    if damaged:
        raw = bytearray((folder / f"{name}.wacz").read_bytes())
        at = raw.find(b"archive/sub/rec.warc") + 200
        raw[at : at + 50] = b"\xff" * 50
        (folder / f"{name}.wacz").write_bytes(raw)
    return path, dict(zip(urls, bodies, strict=True))


def test_packed_files_are_unpacked_once(spark, tmp_path):
    (_, one), (_, two) = crawl(tmp_path, "a", 40), crawl(tmp_path, "b", 30, deflate=False)
    archives = list_archives(spark, str(tmp_path))
    pointers = parse_cdx(text_lines(archives, "cdx"))
    staged = stage_packed(wacz_members(archives), pointers)
    [row] = staged.collect()
    assert row.filename == "sub/rec.warc" and row.wacz_path.endswith("a.wacz")
    assert (tmp_path / "a.wacz").stat().st_size < row.staged_bytes + 20_000
    kept = [r.asDict() for r in pointers.collect()]
    (tmp_path / "a.wacz").write_bytes(b"")  # blocks of records no longer need the archive
    again = spark.createDataFrame(kept, pointers.schema)
    got = {r.url: bytes(r.payload) for r in fetch_warc(again, staged=staged, block_bytes=100).collect()}
    assert got == one | two
    assert "staged_path" not in fetch_warc(again, staged=staged).columns
    assert stage_packed(wacz_members(list_archives(spark, str(tmp_path / "b.wacz")))) is None
    assert stage_packed(wacz_members(list_archives(spark, str(tmp_path / "b.wacz"))), pointers.limit(0)) is None


def test_records_of_packed_and_damaged_files(spark, tmp_path):
    _, bodies = crawl(tmp_path, "a", 20)
    decoded = F.unbase64("html_base64").alias("body")
    rows = generate_records(spark, str(tmp_path)).select("url", decoded).collect()
    assert {r.url: bytes(r.body) for r in rows} == bodies
    crawl(tmp_path, "c", 20, damaged=True)
    with pytest.raises(Exception, match="unreadable record"):
        generate_records(spark, str(tmp_path)).collect()
    rows = generate_records(spark, str(tmp_path), strict=False).collect()
    assert len(rows) == 40 and any(r.payload_problem for r in rows if "/c/" in r.url)
    assert not any(r.payload_problem for r in rows if "/a/" in r.url)


@pytest.mark.parametrize("order", ["numeric", "lexicographic"])
def test_ordered_records_are_read_in_order(spark, tmp_path, order):
    for name in "abc":
        crawl(tmp_path, name, 40, deflate=name == "b")
    previous = spark.createDataFrame([(f"https://h/gone/{i}",) for i in range(9)], "url string")
    options = {"current_urls": previous.limit(0), "previous_urls": previous, "offset_order": order}
    ordered = generate_records(spark, str(tmp_path), ordered=True, **options)
    plan = ordered._jdf.queryExecution().executedPlan().toString()
    above = plan.split("MapInArrow")[0]
    assert "Exchange" not in above and "Sort" not in above and "REPARTITION" in plan
    rows = ordered.collect()
    assert sorted(map(str, rows)) == sorted(map(str, generate_records(spark, str(tmp_path), **options).collect()))
    offsets = [r.cdx_offset for r in rows]
    active = [o for o in offsets if o is not None]
    assert offsets[len(active) :] == [None] * 9
    assert active == sorted(active, key=int if order == "numeric" else str)


def test_ordered_fetch_in_short_stretches(spark, tmp_path):
    crawl(tmp_path, "a", 60, deflate=False)
    pointers = parse_cdx(text_lines(list_archives(spark, str(tmp_path)), "cdx"))
    rank = F.struct(F.col("offset_num") * -1)
    rows = fetch_warc(pointers, order=rank, batch_bytes=64, partitions=3).collect()
    assert [r.offset_num for r in rows] == sorted((r.offset_num for r in rows), reverse=True) and len(rows) == 60


# URL lists

URLS = ["u1", "  u2\t", "", "ü3", "u1"]
TEXT = "\n".join(URLS).encode()


def test_url_lists_of_any_packing(spark, tmp_path):
    packed = {"a.txt": TEXT, "b.gz": gzip.compress(TEXT) + gzip.compress(b"\nlast\n"), "c.bz2": bz2.compress(TEXT),
              "d.xz": lzma.compress(TEXT), "e": b"one\r\n\xff\n"}
    for name, data in packed.items():
        (tmp_path / name).write_bytes(data)
    want = [u.strip() for u in URLS] * 4 + ["last", "one", "�"]
    for split_bytes in (1, 7, 1 << 20):
        rows = scan_url_list(spark, str(tmp_path), split_bytes).collect()
        assert sorted(r.url for r in rows) == sorted(want) and not any(r.problem for r in rows)
    assert sorted(r.url for r in read_previous_url_list(spark, str(tmp_path)).collect()) == sorted(want)
    assert url_list_problems(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("damage", ["cut", "no gzip", "flipped"])
def test_a_damaged_previous_list_deletes_nothing(spark, tmp_path, damage):
    data = bytearray(gzip.compress(b"\n".join(b"https://h/%d" % i for i in range(5000))))
    if damage == "flipped":
        data[len(data) // 2] ^= 0xFF
    bad = {"cut": data[:-10], "no gzip": b"https://h/1\n", "flipped": data}[damage]
    (tmp_path / "list").mkdir()
    (tmp_path / "list" / "good.gz").write_bytes(gzip.compress(b"https://h/x\n"))
    (tmp_path / "list" / "bad.gz").write_bytes(bytes(bad))
    path = str(tmp_path / "list")
    current = spark.createDataFrame([("https://h/1",)], "url string")
    assert deleted_urls(read_previous_url_list(spark, path), current).count() == 0
    [problem] = url_list_problems(spark, path).collect()
    assert problem.path.endswith("bad.gz") and "rror" in problem.problem
    with pytest.raises(Exception, match="."):
        deleted_urls(current, read_url_list(spark, path)).collect()
    (tmp_path / "list" / "bad.gz").unlink()
    assert deleted_urls(read_previous_url_list(spark, path), current).count() == 1


def test_a_list_that_is_not_there(spark, tmp_path):
    assert read_previous_url_list(spark, str(tmp_path / "none")).count() == 0
    assert url_list_problems(spark, str(tmp_path / "none")).count() == 1


# all keys of index lines


def test_all_keys_of_index_lines(spark, tmp_path):
    lines = [
        cdx_line("u1", recordDigest="sha256:1"), cdx_line("u2", **{"odd \"key\".x": [1, "a"], "n": 5}),
        cdx_line("u3", n="five"), "k t {}\n", 'k t { }\n', "k t {\"other\": null}\n", "k t nothing\n", "k t [1]\n",
    ]
    write_archive(tmp_path / "a.wacz", {CDXJ: "".join(lines)})
    captures = parse_cdx(text_lines(list_archives(spark, str(tmp_path)), "cdx"), keep_raw=True)
    fields = {"recordDigest": "string", 'odd "key".x': "array<string>", "n": "bigint", "other": "string"}
    rows = cdx_fields(captures, fields)
    got = {r.url: tuple(r[c] for c in fields) for r in rows.collect()}
    assert got == {
        "u1": ("sha256:1", None, None, None), "u2": (None, ["1", "a"], 5, None), "u3": (None, None, None, None),
        None: (None, None, None, None),
    }
    assert "n: VARIANT" in cdx_schema(captures) and "recordDigest: STRING" in cdx_schema(captures)
    plain = parse_cdx(text_lines(list_archives(spark, str(tmp_path)), "cdx"))
    assert plain.count() == 3 and "raw" not in plain.columns
