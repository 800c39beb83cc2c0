import gzip
import json
import random

import pytest

from archivetables.operators import cdx_rejects, page_rejects, parse_cdx, parse_pages
from archivetables.plans import html_websites, scan_cdx, scan_pages, scan_problems
from archivetables.sources import list_archives, member_lines, text_lines, wacz_members
from archivetables.sources.archives import _inflate, _lines
from tests.helpers import cdx_line, page_list, write_archive

SEEDS, EXTRA = "pages/pages.jsonl", "pages/extraPages.jsonl"
CDX_GZ, CDXJ = "indexes/index.cdx.gz", "indexes/index.cdxj"


def archives(spark, *paths):
    return list_archives(spark, list(paths))


def test_members_of_stored_and_packed_archives(spark, tmp_path):
    path = write_archive(
        tmp_path / "a b%20.wacz",
        {SEEDS: "abc", CDX_GZ: b"", "indexes/index.idx": "", "archive/r.warc.gz": b"12",
         "logs/x.log": "", "other.json": "{}"},
        deflate=[SEEDS],
    )
    rows = wacz_members(archives(spark, str(tmp_path))).collect()
    assert {r.member: r.kind for r in rows} == {
        SEEDS: "pages", CDX_GZ: "cdx", "indexes/index.idx": "blocks",
        "archive/r.warc.gz": "warc", "logs/x.log": "log", "other.json": "other",
    }
    assert {(r.member, r.size, r.stored) for r in rows} >= {(SEEDS, 3, False), ("archive/r.warc.gz", 2, True)}
    assert rows[0].wacz_path.endswith(path)


def test_unreadable_archive(spark, tmp_path):
    (tmp_path / "bad.wacz").write_bytes(b"no zip")
    listed = archives(spark, str(tmp_path))
    assert [r.member for r in wacz_members(listed, strict=False).collect()] == [None]
    assert text_lines(listed, "pages", strict=False).count() == 0
    with pytest.raises(Exception, match="BadZipFile"):
        wacz_members(listed).collect()


def test_page_lists(spark, tmp_path):
    write_archive(
        tmp_path / "both.wacz",
        {
            SEEDS: page_list(
                {"url": "u1", "title": "t1"}, {"url": "http://h/sitemap.xml"},
                {"url": "http://h/Sitemap.xml"}, {"title": "no url"}, {"url": "u2", "title": 7},
            ),
            EXTRA: page_list({"url": "u1", "title": "x", "text": "body", "depth": 2}),
            CDXJ: cdx_line("u1"),
        },
    )
    write_archive(tmp_path / "header.wacz", {SEEDS: page_list({"url": "only"}, header="").lstrip("\n")})
    pages = scan_pages(spark, str(tmp_path)).collect()
    assert sorted((r.pages_file, r.url, r.title, r.text) for r in pages) == [
        (EXTRA, "u1", "x", "body"),
        (SEEDS, "http://h/Sitemap.xml", None, None),
        (SEEDS, "u1", "t1", None),
        (SEEDS, "u2", "7", None),
    ]
    raw = [json.loads(r.raw.toJson()) for r in pages if r.text]
    assert raw == [{"url": "u1", "title": "x", "text": "body", "depth": 2}]


def test_page_rejects(spark, tmp_path):
    write_archive(tmp_path / "a.wacz", {SEEDS: 'broken header\n{"url": "u"}\n\n \t\n{"url": \n[1]'})
    lines = text_lines(archives(spark, str(tmp_path)), "pages")
    assert [r.url for r in parse_pages(lines).collect()] == ["u"]
    assert sorted(r.text for r in page_rejects(lines).collect()) == ["[1]", '{"url": ']


def test_both_indexes_are_read(spark, tmp_path):
    write_archive(
        tmp_path / "a.wacz",
        {
            CDX_GZ: gzip.compress(cdx_line("u1").encode()) + gzip.compress(cdx_line("u2").encode()),
            CDXJ: cdx_line("u1") + cdx_line("u3", mime="text/html; charset=utf-8")
            + cdx_line("u4", status="404") + "k t {}\nk t\nk t {bad\n",
        },
        deflate=[CDXJ],
    )
    got = scan_cdx(spark, str(tmp_path)).collect()
    assert sorted(r.url for r in got) == ["u1", "u1", "u2", "u4"]
    assert {r.offset_num for r in got} == {0} and {r.offset for r in got} == {"0"}
    lines = text_lines(archives(spark, str(tmp_path)), "cdx")
    assert sorted((r.line.decode(), r.reason) for r in cdx_rejects(lines).collect()) == [
        ("k t", "no JSON part"), ("k t {bad", "malformed JSON"),
    ]
    assert parse_cdx(lines).where("cdx_file = 'indexes/index.cdxj'").count() == 3


def test_index_line_that_is_no_text(spark, tmp_path):
    write_archive(tmp_path / "a.wacz", {CDXJ: cdx_line("u1").encode() + b'k t {"url": "\xff"}\n'})
    lines = text_lines(archives(spark, str(tmp_path)), "cdx")
    assert [r.url for r in parse_cdx(lines).collect()] == ["u1"]
    assert [r.reason for r in cdx_rejects(lines).collect()] == ["not UTF-8"]


@pytest.mark.parametrize("split_bytes", [1, 7, 64, 1000])
@pytest.mark.parametrize("end", ["", "\n"])
def test_split_text_is_whole_text(spark, tmp_path, split_bytes, end):
    rng = random.Random(split_bytes)
    texts = ["header"] + ["é" * rng.randrange(12) for _ in range(40)]
    write_archive(tmp_path / "a.wacz", {SEEDS: "\n".join(texts) + end})
    lines = text_lines(archives(spark, str(tmp_path)), "pages", split_bytes=split_bytes)
    rows = sorted(lines.collect(), key=lambda r: r.line_pos)
    expected = texts if end or texts[-1] else texts[:-1]
    assert [r.line.decode() for r in rows] == expected
    position = 0
    for row in rows:
        assert row.line_pos == position
        position += len(row.line) + 1
    assert sum(r.split_start == 0 and r.line_pos == 0 for r in rows) == 1


def blocks_file(blocks):
    lines, at = ["!meta 0 {}"], 0
    for block in blocks:
        lines.append(f"k t {json.dumps({'offset': at, 'length': len(block)})}")
        at += len(block)
    return "\n".join(lines)


@pytest.mark.parametrize("split_bytes", [1, 100, 1 << 20])
@pytest.mark.parametrize("index", ["full", "gap", "none"])
def test_packed_index_splits_at_its_blocks(spark, tmp_path, split_bytes, index):
    texts = [f"line {i}" for i in range(50)]
    blocks = [gzip.compress("".join(f"{t}\n" for t in texts[i : i + 5]).encode()) for i in range(0, 50, 5)]
    members = {CDX_GZ: b"".join(blocks)}
    if index != "none":
        members["indexes/index.idx"] = blocks_file(blocks if index == "full" else blocks[:-1])
    write_archive(tmp_path / "a.wacz", members)
    rows = member_lines(archives(spark, str(tmp_path)), CDX_GZ, split_bytes=split_bytes).collect()
    assert sorted(r.line.decode() for r in rows) == sorted(texts)
    splits = {r.split_start for r in rows}
    assert len(splits) == (10 if split_bytes == 1 else len(splits))
    assert (len(splits) > 1) == (split_bytes < 1000)


@pytest.mark.parametrize("split_bytes", [1, 60, 1 << 20])
@pytest.mark.parametrize("size", [3, 11, 40])
def test_lines_across_index_blocks(spark, tmp_path, split_bytes, size):
    texts = [f"line {i} " + "x" * (i % 13) for i in range(30)] + ["the last, without an end"]
    data = "\n".join(texts).encode()
    blocks = [gzip.compress(data[i : i + size]) for i in range(0, len(data), size)]
    members = {CDX_GZ: b"".join(blocks), "indexes/index.idx": blocks_file(blocks)}
    write_archive(tmp_path / "a.wacz", members)
    rows = member_lines(archives(spark, str(tmp_path)), CDX_GZ, split_bytes=split_bytes).collect()
    assert sorted(r.line.decode() for r in rows) == sorted(texts)


def test_every_file_is_listed(spark, tmp_path):
    for name in ("x.wacz", "_under.wacz", ".dot.wacz"):
        write_archive(tmp_path / name, {SEEDS: page_list({"url": "u"})})
    (tmp_path / "zero.wacz").write_bytes(b"")
    listing = {(r.path.rsplit("/", 1)[1], r.length > 0) for r in archives(spark, str(tmp_path)).collect()}
    assert listing == {("x.wacz", True), ("_under.wacz", True), (".dot.wacz", True), ("zero.wacz", False)}


def test_inflate_reports_cut_text():
    data = gzip.compress(b"abc") + b"\0\0" + gzip.compress(b"def") + b"\0"
    assert b"".join(_inflate([data[:5], data[5:]])) == b"abcdef"
    with pytest.raises(EOFError):
        list(_inflate([data[:-3]]))


def test_lines_across_chunks():
    runs = list(_lines([b"a\nb", b"c", b"\n", b"d"], 0, None))
    assert [line for lines, _ in runs for line in lines] == [b"a", b"bc", b"d"]
    assert [int(p) for _, positions in runs for p in positions] == [0, 2, 5]


def test_problems(spark, tmp_path):
    good = {SEEDS: page_list({"url": "u"}), CDXJ: cdx_line("u")}
    write_archive(tmp_path / "good.wacz", good)
    write_archive(tmp_path / "no_cdx.wacz", {SEEDS: good[SEEDS]})
    write_archive(tmp_path / "no_pages.wacz", {SEEDS: page_list(), CDXJ: good[CDXJ]})
    (tmp_path / "bad.wacz").write_bytes(b"PK")
    got = {(r.wacz_path.rsplit("/", 1)[1], r.problem) for r in scan_problems(spark, str(tmp_path)).collect()}
    assert got == {
        ("no_cdx.wacz", "no index lines"), ("no_pages.wacz", "no page rows"),
        ("bad.wacz", "unreadable archive"),
    }


def test_websites_fan_out_per_archive(spark, tmp_path):
    pages = page_list({"url": "u1", "title": "a"}, {"url": "u2", "title": "b"})
    write_archive(
        tmp_path / "1.wacz",
        {SEEDS: pages, EXTRA: page_list({"url": "u1", "title": "c"}),
         CDXJ: cdx_line("u1", offset="1") + cdx_line("u1", offset="2") + cdx_line("u9")},
    )
    write_archive(tmp_path / "2.wacz", {SEEDS: pages, CDXJ: cdx_line("u2")})
    rows = html_websites(spark, str(tmp_path)).collect()
    assert sorted((r.wacz_path[-6], r.url, r.title, r.offset) for r in rows) == [
        ("1", "u1", "a", "1"), ("1", "u1", "a", "2"), ("1", "u1", "c", "1"), ("1", "u1", "c", "2"),
        ("2", "u2", "b", "0"),
    ]
