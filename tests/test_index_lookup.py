"""Looking up URLs by the order of the index, and cutting packed indexes that have no list of blocks."""

import gzip
import io
import json
import random
import zlib

import pytest

from archivetables import content_by_url, content_by_url_indexed
from archivetables.sources import list_archives, member_lines
from archivetables.sources.gzip_members import Chain, search
from archivetables.sources.index_lookup import lookup_lines, lookup_splits
from archivetables.sources.sort_keys import is_plain, sort_key, sort_keys
from tests.helpers import page_list, warc_file, warc_record, write_archive

SEEDS = "pages/pages.jsonl"
CDX_GZ, CDXJ, IDX = "indexes/index.cdx.gz", "indexes/index.cdxj", "indexes/index.idx"


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("https://www.Example.org/A/b/?y=2&X=1#top", "org,example)/a/b?x=1&y=2"),
        ("http://example.org:80", "org,example)/"),
        ("http://example.org:8080/?PHPSESSID=ab12&q=1", "org,example:8080)/?q=1"),
        ("https://10.0.0.1/x", "10.0.0.1)/x"),
        ("u1", "u1"),
    ],
)
def test_keys(url, key):
    assert sort_key(url) == key and key in sort_keys(url)


def test_plain_urls():
    assert all(map(is_plain, ["https://a.b/c_d/~e.f/?x=1&y=/z", "http://h", "https://h:81/#é"]))
    assert not any(map(is_plain, ["u1", "https://h/%41", "https://é/", "https://h/a/../b", "https://h//x", "ftp://h/", "https://u@h/"]))


def crawl(folder, urls, name, usual=True, ordered=True, listed=True, packed=True, block=4, twice=()):
    """An archive with a capture and a page for each URL, its index in blocks of lines."""
    records = [warc_record(f"body of {u} in {name}".encode(), content_type="text/plain", kind="resource") for u in urls]
    warc, offsets = warc_file(*records)
    lines = []
    for url, offset in zip(urls, offsets, strict=True):
        key = sort_key(url) if usual else f"x{zlib.crc32(url.encode()):08x}"
        body = {"url": url, "mime": "text/html", "status": "200", "offset": str(offset), "filename": "rec", "length": "1"}
        lines += [f"{key} 20250101000000 {json.dumps(body)}\n"] * (1 + (url in twice))
    lines = sorted(lines) if ordered else lines
    members = {SEEDS: page_list(*({"url": u, "title": u} for u in urls)), "archive/rec": warc}
    if packed:
        blocks = [lines[i : i + block] for i in range(0, len(lines), block)]
        gz, at, listing = b"", 0, ["!meta 0 {}"]
        for rows in blocks:
            one = gzip.compress("".join(rows).encode())
            listing.append(f"{' '.join(rows[0].split(' ')[:2])} {json.dumps({'offset': at, 'length': len(one)})}")
            gz, at = gz + one, at + len(one)
        members[CDX_GZ] = gz
        if listed:
            members[IDX] = "\n".join(listing)
    else:
        members[CDXJ] = "".join(lines)
    return write_archive(folder / f"{name}.wacz", members)


URLS = [f"https://h{i % 7}.example.org/p/{i}{'/' * (i % 2)}" for i in range(60)] + ["https://www.example.org/", "https://example.org"]
WANTED = [URLS[3], URLS[3], URLS[40], URLS[-1], "https://h3.example.org/none", "https://a.example.org/", "odd one", "https://z.example.org/%41", None]


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("kind", [{}, {"usual": False}, {"ordered": False}, {"listed": False}])
def test_lookup_gives_what_a_scan_gives(spark, tmp_path, kind, packed):
    urls = URLS + ["odd one", "https://z.example.org/%41"]
    crawl(tmp_path, urls, "a", packed=packed, twice=[URLS[40]], **kind)
    crawl(tmp_path, urls[:20], "b", packed=not packed)
    lists = [(u,) for u in WANTED]
    wanted = spark.createDataFrame(lists, "url string")
    rows = content_by_url(spark, str(tmp_path), wanted).collect()
    got = content_by_url_indexed(spark, str(tmp_path), wanted).collect()
    assert sorted(map(str, got)) == sorted(map(str, rows)) and any(r.content for r in rows)
    if kind or packed:
        return
    many = content_by_url_indexed(spark, str(tmp_path), wanted, max_urls=2).collect()
    assert sorted(map(str, many)) == sorted(map(str, rows))
    assert content_by_url_indexed(spark, str(tmp_path), []).count() == 0
    with pytest.raises(Exception, match="one match"):
        content_by_url_indexed(spark, str(tmp_path), [URLS[40]], strict=True).collect()


def test_a_url_reads_a_block_of_each_archive(spark, tmp_path):
    for name in "abc":
        crawl(tmp_path, [f"https://h.example.org/{name}/{i:04d}" for i in range(400)], name, block=10)
    archives = list_archives(spark, str(tmp_path))
    splits = lookup_splits(archives, ["https://h.example.org/b/0123"]).collect()
    lines = lookup_lines(archives, ["https://h.example.org/b/0123"]).collect()
    assert len(splits) <= 3 and not any(s.whole for s in splits)
    assert len(lines) <= 30 and sum(b"/b/0123" in r.line for r in lines) == 1
    # the first key of a block may also end the one before
    first = lookup_splits(archives, ["https://h.example.org/b/0120"]).collect()
    assert sum(s.stop - s.start for s in first) < 4 * max(s.stop - s.start for s in splits)


def test_a_plain_index_is_searched_by_halves(spark, tmp_path):
    urls = [f"https://h.example.org/{i:05d}" for i in range(3000)]
    crawl(tmp_path, urls, "a", packed=False, twice=[urls[77]])
    archives = list_archives(spark, str(tmp_path))
    for i in (0, 1, 77, 1500, 2998, 2999):
        rows = lookup_lines(archives, [urls[i]], search_bytes=1000).collect()
        assert [json.loads(r.line.split(b" ", 2)[2])["url"] for r in rows] == [urls[i]] * (1 + (i == 77))
    assert lookup_lines(archives, ["https://h.example.org/0", "https://h.example.org/9"], search_bytes=1000).count() == 0


# packed text without a list of its blocks


def odd_member(text, level):
    """A gzip member; uncompressed ones show what is packed within them."""
    out = io.BytesIO()
    with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=level, mtime=0) as file:
        file.write(text)
    return out.getvalue()


def packed_text(seed):
    """Members of lines, some with marks, whole members and chains of members within their text."""
    rng, parts, text = random.Random(seed), [], b""
    for _ in range(40):
        lines = b"".join(b"line %d %s\n" % (rng.randrange(1000), b"x" * rng.randrange(40)) for _ in range(rng.randrange(6)))
        inner = rng.choice([b"", b"\x1f\x8b\x08", b"\x1f\x8b\x08\x00" + b"\0" * 8, gzip.compress(b"inner"), gzip.compress(b"a\n") + gzip.compress(b"b")])
        piece = lines + (inner + b"\n" if inner else b"") + rng.choice([b"", b"cut "])
        text += piece
        parts.append(odd_member(piece, rng.choice([0, 0, 9])) + b"\0" * rng.choice([0, 0, 3]))
    return b"".join(parts), text


@pytest.mark.parametrize("split_bytes", [1, 37, 400, 1 << 20])
def test_packed_text_is_cut_at_true_members(spark, tmp_path, split_bytes):
    data, text = packed_text(split_bytes)
    write_archive(tmp_path / "a.wacz", {CDX_GZ: data})
    rows = member_lines(list_archives(spark, str(tmp_path)), CDX_GZ, split_bytes=split_bytes).collect()
    lines = text.split(b"\n")
    assert sorted(bytes(r.line) for r in rows) == sorted(lines if lines[-1] else lines[:-1])
    assert (len({r.split_start for r in rows}) > 5) == (split_bytes < 500)


def test_chain_mends_what_a_search_takes_for_members():
    inner = gzip.compress(b"a" * 300, mtime=0) + gzip.compress(b"b", mtime=0)
    outer = odd_member(b"head " * 10 + inner, 0)
    data = outer + gzip.compress(b"last", mtime=0)
    source, size = io.BytesIO(data), len(data)
    at = data.find(inner)
    false = search(source, at, at + 3, size)
    assert false is not None and false[0] == at  # a whole member, though not one of the text
    chain = Chain()
    ranges = [(i, min(i + 25, size)) for i in range(0, size, 25)]
    cuts = [chain.take(source, a, b, size, search(source, a, b, size)) for a, b in ranges]
    assert [c for c in cuts if c] == [(0, 0), (len(outer), 0)]


def test_one_member_is_one_split_and_a_cut_one_raises(spark, tmp_path):
    data = gzip.compress(random.Random(1).randbytes(5000) + b"\nend\n")
    write_archive(tmp_path / "a.wacz", {CDX_GZ: data})
    rows = member_lines(list_archives(spark, str(tmp_path)), CDX_GZ, split_bytes=100).collect()
    assert {r.split_start for r in rows} == {0} and rows[-1].line == b"end"
    write_archive(tmp_path / "a.wacz", {CDX_GZ: gzip.compress(b"x\n") + data[:-100]})
    with pytest.raises(Exception, match="within a member"):
        member_lines(list_archives(spark, str(tmp_path)), CDX_GZ, split_bytes=100).collect()
