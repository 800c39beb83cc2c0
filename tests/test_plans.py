import base64
import logging

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from archivetables import content_by_url, generate_records, harvest_tables, write_harvest
from archivetables.operators import active_records, drop_duplicate_urls, join_captures
from archivetables.plans import scan_cdx, scan_pages
from archivetables.plans.archive_tables import scan_problems
from archivetables.plans.generate import ArchiveProblemError
from archivetables.schemas import RECORD
from archivetables.sources import fetch_warc, read_url_list
from tests.helpers import cdx_line, http_block, page_list, warc_file, warc_record, write_archive

SEEDS, EXTRA, CDXJ = "pages/pages.jsonl", "pages/extraPages.jsonl", "indexes/index.cdxj"


@pytest.fixture(scope="module")
def crawl(tmp_path_factory):
    """u1 is captured twice in one file, the second time beyond offset 1000; u2 twice in two
    files; u3 once, as JSON; u4 once; u5 never."""
    pad = http_block(b"0123456789" * 200)
    bodies = [b"u1 old", b"u2 first", b"u1 new", b"{}", b"u4 \xc3\xa9"]
    records = [warc_record(http_block(b, ("Set-Cookie", "a"), ("Set-Cookie", "b"))) for b in bodies]
    one, at = warc_file(records[0], warc_record(pad), records[2], records[3], records[4], pack=False)
    two, at2 = warc_file(warc_record(pad), warc_record(pad), records[1], pack=False)
    folder = tmp_path_factory.mktemp("crawl")
    index = [
        cdx_line("u1", "one", str(at[0])), cdx_line("u1", "one", str(at[2])),
        cdx_line("u2", "one", str(at[1])), cdx_line("u2", "two", str(at2[2])),
        cdx_line("u3", "one", str(at[3]), mime="application/json"),
        cdx_line("u4", "one", str(at[4])), cdx_line("u6", "one", "0"),
    ]
    pages = [{"url": f"u{i}", "title": f"t{i}"} for i in range(1, 6)]
    write_archive(
        folder / "a.wacz",
        {SEEDS: page_list(*pages), EXTRA: page_list({"url": "u4", "title": "later"}),
         CDXJ: "".join(index), "archive/one": one, "archive/two": two},
    )
    return str(folder)


def text(record):
    return record.html_base64 and base64.b64decode(record.html_base64).decode()


def test_records(spark, crawl):
    records = generate_records(spark, crawl, check_archives=True)
    assert records.schema.simpleString() == RECORD.simpleString()
    rows = {r.url: r for r in records.collect()}
    assert {u: text(r) for u, r in rows.items()} == {"u1": "u1 new", "u2": "u2 first", "u4": "u4 é"}
    assert rows["u4"].cdx_title == "later" and rows["u2"].cdx_warc_filename == "two"
    assert rows["u1"].response_headers == {"Set-Cookie": ["a", "b"]}
    assert {r.status for r in rows.values()} == {"active"}


def test_counts_of_a_run(spark, crawl):
    counts = Observation()
    gone = spark.createDataFrame([("u1",), ("x",)], "url string")
    generate_records(spark, crawl, gone.limit(0), gone, observation=counts).collect()
    assert counts.get == {"records": 4, "deleted": 2}


def test_lexicographic_order(spark, crawl):
    rows = {r.url: r for r in generate_records(spark, crawl, offset_order="lexicographic").collect()}
    offsets = {r.offset for r in scan_cdx(spark, crawl).where("url = 'u1'").collect()}
    assert rows["u1"].cdx_offset == max(offsets)


def test_deletes_win_unless_told(spark, crawl):
    previous = spark.createDataFrame([("u1",), ("u4",), ("x",), ("y",)], "url string")
    current = spark.createDataFrame([("u4",), ("y",)], "url string")
    rows = {r.url: r for r in generate_records(spark, crawl, current, previous).collect()}
    assert {u: r.status for u, r in rows.items()} == {
        "u1": "deleted", "u2": "active", "u4": "active", "x": "deleted",
    }
    assert all(v is None for v in rows["u1"][2:])
    kept = generate_records(spark, crawl, current, previous, prefer="active").collect()
    assert {(r.url, r.status) for r in kept} == {
        ("u1", "active"), ("u2", "active"), ("u4", "active"), ("x", "deleted"),
    }
    for lists in ({"current_urls": current}, {"previous_urls": previous}):
        assert generate_records(spark, crawl, **lists).where("status = 'deleted'").count() == 0


def test_lists_as_files(spark, crawl, tmp_path, caplog):
    (tmp_path / "now.txt").write_text("u1\n")
    (tmp_path / "before.txt").write_text(" u1 \ngone\n")
    now, before = str(tmp_path / "now.txt"), str(tmp_path / "before.txt")
    got = generate_records(spark, crawl, now, before).where("status = 'deleted'").collect()
    assert [r.url for r in got] == ["gone"]
    with caplog.at_level(logging.ERROR):
        lost = generate_records(spark, crawl, now, str(tmp_path / "lost.txt"))
    assert lost.where("status = 'deleted'").count() == 0


def test_ordered_records_and_crawl_key(spark, crawl):
    rows = generate_records(spark, crawl, ordered=True, keep_crawl=True).collect()
    offsets = [int(r.cdx_offset) for r in rows]
    assert offsets == sorted(offsets) and rows[0].wacz_path.endswith("a.wacz")


def test_dedup_before_and_after_fetch_agree(spark, crawl):
    joined = join_captures(scan_pages(spark, crawl).drop("raw"), scan_cdx(spark, crawl).drop("status"))
    late = drop_duplicate_urls(active_records(fetch_warc(joined), "line_pos", "pages_file"),
                               tie_breaks=("pages_file",))
    # 'pages/pages.jsonl' sorts after 'pages/extraPages.jsonl', so titles of u4 differ
    early = generate_records(spark, crawl)
    columns = ["url", "cdx_offset", "cdx_warc_filename", "html_base64"]
    assert sorted(late.select(columns).collect()) == sorted(early.select(columns).collect())


def test_same_url_in_two_archives(spark, crawl, tmp_path):
    data, at = warc_file(warc_record(http_block(b"other crawl")))
    write_archive(tmp_path / "b.wacz", {SEEDS: page_list({"url": "u4", "title": "b"}),
                                        CDXJ: cdx_line("u4", "r", "0"), "archive/r": data})
    records = generate_records(spark, [crawl, str(tmp_path)]).where("url = 'u4'").collect()
    assert {text(r) for r in records} == {"u4 é", "other crawl"}
    schema = "wacz_path string, url string"
    paths = {r.cdx_title: r.wacz_path for r in
             generate_records(spark, [crawl, str(tmp_path)], keep_crawl=True).where("url = 'u4'").collect()}
    gone = spark.createDataFrame([(paths["b"], "u4")], schema)
    left = generate_records(spark, [crawl, str(tmp_path)], gone.limit(0), gone).where("url = 'u4'")
    assert {(r.status, r.cdx_title) for r in left.collect()} == {("active", "later"), ("deleted", None)}


def test_broken_pointers(spark, tmp_path):
    write_archive(tmp_path / "a.wacz", {SEEDS: page_list({"url": "u"}, {"url": "v"}),
                                        CDXJ: cdx_line("u", "none") + cdx_line("v", "r", "zero"),
                                        "archive/r": b""})
    with pytest.raises(Exception, match="ArchiveReadError"):
        generate_records(spark, str(tmp_path)).collect()
    rows = generate_records(spark, str(tmp_path), strict=False).collect()
    assert {(r.url, r.html_base64, r.payload_problem) for r in rows} == {
        ("u", None, "no such WARC file"), ("v", None, "no record position"),
    }


def test_malformed_page_line(spark, tmp_path):
    write_archive(tmp_path / "a.wacz", {SEEDS: page_list({"url": "u"}) + "{bad\n", CDXJ: cdx_line("x")})
    with pytest.raises(Exception, match="malformed page line: .*a.wacz pages/pages.jsonl"):
        scan_pages(spark, str(tmp_path)).collect()
    assert [r.url for r in scan_pages(spark, str(tmp_path), strict=False).collect()] == ["u"]
    with pytest.raises(Exception, match="malformed page line"):
        generate_records(spark, str(tmp_path)).collect()


def test_incomplete_archives_are_named(spark, tmp_path):
    write_archive(tmp_path / "empty.wacz", {SEEDS: page_list()})
    with pytest.raises(ArchiveProblemError, match="no index: 1"):
        generate_records(spark, str(tmp_path), check_archives=True)
    with pytest.raises(ArchiveProblemError, match="empty.wacz"):
        generate_records(spark, str(tmp_path))
    assert generate_records(spark, str(tmp_path), check_archives=False).count() == 0
    assert generate_records(spark, str(tmp_path), strict=False).count() == 0
    for name in ("zero.wacz", "_under.wacz"):
        (tmp_path / name).write_bytes(b"")
    with pytest.raises(ArchiveProblemError, match="unreadable archive: 2"):
        generate_records(spark, str(tmp_path))
    assert {r.problem for r in scan_problems(spark, str(tmp_path)).collect()} >= {"unreadable archive"}


def test_content_by_url(spark, crawl):
    rows = {r.url: r for r in content_by_url(spark, crawl, ["u1", "u2", "u4", "u5", "nowhere"]).collect()}
    assert {u: (r.match_count, r.content) for u, r in rows.items()} == {
        "u1": (2, None), "u2": (2, None), "u4": (2, None), "u5": (0, None), "nowhere": (0, None),
    }
    with pytest.raises(Exception, match="URL has not one match but 0 nowhere"):
        content_by_url(spark, crawl, ["nowhere"], strict=True).collect()


def test_content_of_single_match(spark, tmp_path):
    data, at = warc_file(warc_record(http_block("é".encode())), warc_record(http_block(b"\xff")))
    write_archive(tmp_path / "a.wacz", {SEEDS: page_list({"url": "u"}, {"url": "v"}),
                                        CDXJ: cdx_line("u", "r") + cdx_line("v", "r", str(at[1])),
                                        "archive/r": data})
    assert content_by_url(spark, str(tmp_path), ["u"], strict=True).first().content == "é"
    assert bytes(content_by_url(spark, str(tmp_path), ["v"], decode=False).first().content) == b"\xff"
    with pytest.raises(Exception, match="INVALID_UTF8"):
        content_by_url(spark, str(tmp_path), ["v"]).collect()


def test_harvest(spark, crawl, tmp_path):
    body = "<urlset>{}</urlset>".format(
        "".join(f"<url><loc>u{i}</loc><lastmod>2025-0{i}-01</lastmod></url>" for i in range(2, 5))
    )
    docs = spark.createDataFrame(
        [("s.xml", body), ("stray.xml", "<urlset><url><loc>stray</loc></url></urlset>")],
        "sitemap_url string, body string",
    )
    roots = spark.createDataFrame([("s.xml",)], "sitemap_url string")
    previous = spark.createDataFrame([("u1",), ("u2",), ("stray",)], "url string")
    tables = harvest_tables(spark, crawl, docs, previous, roots, from_date="2025-03-01")
    assert sorted(r.url for r in tables.seed_urls.collect()) == ["u3", "u4"]
    assert sorted(r.url for r in tables.all_urls.collect()) == ["u2", "u3", "u4"]
    deleted = tables.records.where(F.col("status") == "deleted")
    assert sorted(r.url for r in deleted.collect()) == ["stray", "u1"]

    write_harvest(tables, str(tmp_path / "r.jsonl"), str(tmp_path / "urls"))
    assert spark.read.json(str(tmp_path / "r.jsonl")).count() == 4
    assert read_url_list(spark, str(tmp_path / "urls")).count() == 3
    with pytest.raises(ValueError, match="nothing to write"):
        write_harvest(tables)


def test_archives_are_asked_for_with_the_first_records(spark, crawl):
    asked = []
    docs = spark.createDataFrame([("s.xml", "<urlset><url><loc>u2</loc></url></urlset>")], "sitemap_url string, body string")
    tables = harvest_tables(spark, lambda: asked.append(1) or crawl, docs, docs.select(F.lit("u1").alias("url")))
    assert [r.url for r in tables.seed_urls.collect()] == ["u2"] and not asked
    assert tables.records.where("status = 'deleted'").count() == 1 and len(asked) == 1


def test_harvest_without_sitemaps_deletes_nothing(spark, crawl, tmp_path, caplog):
    previous = spark.createDataFrame([("x",)], "url string")
    tables = harvest_tables(spark, crawl, previous_urls=previous)
    assert tables.all_urls is None and tables.records.where("status = 'deleted'").count() == 0
    write_harvest(tables, urls_path=str(tmp_path / "urls"))
    assert not (tmp_path / "urls").exists() and "no URL snapshot" in caplog.text
