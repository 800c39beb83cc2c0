import base64
import logging

import pytest
from pyspark.sql import functions as F

from archivetables import operators as ops
from archivetables.sources import (
    read_previous_url_list,
    read_url_list,
    save_url_snapshot,
    write_url_list,
)

RECORD = "url string, status string, cdx_offset string"


def kept(df):
    return sorted((r.url or "", r.status, r.cdx_offset) for r in df.collect())


@pytest.fixture
def records(spark):
    rows = [
        ("http://shop.test/a", "active", "7341"), ("http://shop.test/a", "active", "88"),
        ("http://shop.test/a", "active", "7340"), ("http://shop.test/b", "active", "0"),
        ("text", "active", "999"), ("text", "active", "10000"),
        ("gone", "active", "5"), ("gone", "deleted", None),
        (None, "active", "1"), (None, "active", "2"),
        ("odd", "active", "x"), ("odd", "active", "3"),
    ]
    return spark.createDataFrame(rows, RECORD)


@pytest.mark.parametrize("drop", [ops.drop_duplicate_urls, ops.drop_duplicate_urls_window])
def test_last_offset_wins(records, drop):
    assert kept(drop(records)) == [
        ("", "active", "2"), ("gone", "deleted", None), ("http://shop.test/a", "active", "7341"),
        ("http://shop.test/b", "active", "0"), ("odd", "active", "3"), ("text", "active", "10000"),
    ]


@pytest.mark.parametrize("drop", [ops.drop_duplicate_urls, ops.drop_duplicate_urls_window])
def test_offset_order_and_preference(records, drop):
    got = {r[0]: r for r in kept(drop(records, offset_order="lexicographic", prefer="active"))}
    assert got["text"][2] == "999" and got["gone"][1] == "active" and got["odd"][2] == "x"


def test_equal_offsets_fall_to_the_tie_break(spark):
    df = spark.createDataFrame([("u", "1", "a"), ("u", "1", "b")], "url string, cdx_offset string, f string")
    assert ops.drop_duplicate_urls(df, tie_breaks=("f",)).first().f == "b"


@pytest.mark.parametrize("drop", [ops.drop_duplicate_urls, ops.drop_duplicate_urls_window])
def test_ties_are_decided_by_default(spark, drop):
    names = "url string, cdx_offset string, cdx_warc_filename string, cdx_length string"
    rows = [("u", "5", "one", "9"), ("u", "5", "two", "10"), ("u", "5", "two", "11")]
    for order in (rows, rows[::-1]):
        assert drop(spark.createDataFrame(order, names)).first().cdx_length == "11"


def test_nothing_and_deletes_only(spark):
    empty = spark.createDataFrame([], RECORD)
    assert ops.drop_duplicate_urls(empty).count() == 0
    deletes = spark.createDataFrame([("u", "deleted", None)], RECORD)
    assert kept(ops.drop_duplicate_urls(deletes)) == [("u", "deleted", None)]


def test_unknown_preference(records):
    with pytest.raises(ValueError, match="prefer"):
        ops.drop_duplicate_urls(records, prefer="new")


def test_ordered_with_deletes_last(spark):
    rows = [("b", "20"), ("a", "100"), ("d", None), ("c", None), ("e", "3")]
    df = spark.createDataFrame(rows, "url string, cdx_offset string").withColumn(
        "cdx_warc_filename", F.lit("f")
    )
    assert [r.url for r in ops.order_by_offset(df).collect()] == ["e", "b", "a", "c", "d"]
    assert [r.url for r in ops.order_by_offset(df, "lexicographic").collect()][:3] == ["a", "b", "e"]


def test_active_record_columns(spark):
    row = ("u", "t", "f", "7", "9", b"\xff<p>", [("A", "1"), ("A", "2")])
    schema = (
        "url string, title string, filename string, offset string, length string, "
        "payload binary, headers array<struct<name:string,value:string>>"
    )
    got = ops.active_records(spark.createDataFrame([row], schema)).first().asDict()
    assert got == {
        "url": "u", "status": "active", "cdx_warc_filename": "f", "cdx_title": "t",
        "cdx_offset": "7", "cdx_length": "9", "html_base64": base64.b64encode(b"\xff<p>").decode(),
        "response_headers": {"A": ["1", "2"]},
    }


def lists(spark, tmp_path, current, previous):
    (tmp_path / "current.txt").write_text(current)
    (tmp_path / "previous.txt").write_text(previous)
    return ops.deleted_urls(
        read_previous_url_list(spark, str(tmp_path / "previous.txt")),
        read_url_list(spark, str(tmp_path / "current.txt")),
    )


def test_deleted_urls(spark, tmp_path):
    gone = lists(
        spark, tmp_path, "h/page1\nh/page2\n", "h/page1\n\n \t h/page2　\nh/gone\n  h/gone\n \n"
    )
    assert [(r.url, r.status) for r in gone.collect()] == [("h/gone", "deleted")]


def test_lost_previous_list_deletes_nothing(spark, tmp_path, caplog):
    with caplog.at_level(logging.ERROR):
        previous = read_previous_url_list(spark, str(tmp_path / "nowhere.txt"))
    assert "cannot read the previous URL list" in caplog.text
    current = spark.createDataFrame([("a",)], "url string")
    assert ops.deleted_urls(previous, current).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_url_list(spark, str(tmp_path / "nowhere.txt"))


def test_deletes_per_crawl(spark):
    schema = "wacz_path string, url string"
    previous = spark.createDataFrame([("a", "u"), ("b", "u"), ("b", "v")], schema)
    current = spark.createDataFrame([("a", "u"), ("c", "v")], schema)
    got = {(r.wacz_path, r.url) for r in ops.deleted_urls(previous, current).collect()}
    assert got == {("b", "u"), ("b", "v")}


def test_snapshot(spark, tmp_path, caplog):
    urls = spark.createDataFrame([("b",), ("a",)], "url string")
    assert save_url_snapshot(urls, str(tmp_path / "urls"))
    assert sorted(r.url for r in read_url_list(spark, str(tmp_path / "urls")).collect()) == ["a", "b"]
    assert not save_url_snapshot(None, str(tmp_path / "none"))
    assert "no URL snapshot" in caplog.text and not (tmp_path / "none").exists()
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        write_url_list(urls, str(tmp_path / "urls"))
