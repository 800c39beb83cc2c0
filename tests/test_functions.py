import base64
from datetime import UTC, datetime
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from archivetables import functions as fn
from archivetables.schemas import CDX_JSON


def evaluate(spark, column, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema).coalesce(1)
    return [row[0] for row in df.select(column).collect()]


def test_strip_cuts_what_python_cuts(spark):
    values = [" a ", "\t　a b \r\n", "\x1c\x1fa\x85", "", " \n ", "a​"]
    assert evaluate(spark, fn.strip("v"), values) == [v.strip() for v in values]


def test_base64_has_no_line_breaks(spark):
    data = bytes(range(256)) * 3
    assert evaluate(spark, fn.base64_text("v"), [data], "v binary") == [
        base64.b64encode(data).decode()
    ]


def test_utf8_text(spark):
    assert evaluate(spark, fn.utf8_text("v", strict=False), [b"\xc3\xa9", b"\xff"], "v binary") == [
        "é", None,
    ]
    with pytest.raises(Exception, match="INVALID_UTF8"):
        evaluate(spark, fn.utf8_text("v"), [b"\xff"], "v binary")


def test_cdx_json_and_object(spark):
    cases = {
        'k t {"url": "a", "offset": 34}': ("a", "34"),
        '  k t {"url": "a"} \r': ("a", None),
        'k t {"url":"a"}\x1c': ("a", None),
        "k t": None,
        '{"url": "a"}': None,
        'k  t {"url": "a"}': None,
        'k t {"url": "a"': None,
        "k t [1]": None,
        'k t [{"url": "a"}]': None,
        "k t {'url': 'a'}": None,
        'k t {"url": "a"} extra': None,
        'k t {"url": "a"},{"url": "b"}': None,
        "k t 5": None,
        "k t null": None,
        "k t {}": (None, None),
    }
    column = fn.json_object(fn.cdx_json("v"), CDX_JSON)
    got = evaluate(spark, column, list(cases))
    assert [r and (r.url, r.offset) for r in got] == list(cases.values())


def test_header_map_keeps_case_order_and_repeats(spark):
    pairs = [[("B", "1"), ("Set-Cookie", "x"), ("a", "2"), ("Set-Cookie", "y"), ("b", "3")], [], None]
    got = evaluate(spark, fn.header_map("v"), pairs, "v array<struct<name:string,value:string>>")
    assert got == [{"B": ["1"], "Set-Cookie": ["x", "y"], "a": ["2"], "b": ["3"]}, {}, None]
    names = F.map_keys(fn.header_map("v"))
    got = evaluate(spark, names, pairs[:1], "v array<struct<name:string,value:string>>")
    assert got == [["B", "Set-Cookie", "a", "b"]]


def test_site_parts_agree_with_urlparse(spark):
    urls = [
        "https://example.com/sitemap.xml", "HTTP://Ex.com:80/a;b/c;d?x=1#f", "example.com/x",
        "//h/p", "http://é.com/ü b", "http://h", "http://u:p@h/a?b;c", "http://h/a;x;y", "",
        "http://h?q=/a", "mailto:a@b", " http://h/a\tb",
    ]
    roots = evaluate(spark, fn.site_root("v"), urls)
    paths = evaluate(spark, fn.site_path("v"), urls)
    for url, root, path in zip(urls, roots, paths, strict=True):
        parsed = urlparse(url)
        assert (root, path) == (f"{parsed.scheme}://{parsed.netloc}", parsed.path), url


def test_w3c_timestamp_does_not_depend_on_the_session_zone(spark):
    def utc(*parts):
        return datetime(*parts, tzinfo=UTC).timestamp()

    cases = {
        "2025": utc(2025, 1, 1),
        "2025-03": utc(2025, 3, 1),
        " 2025-03-04\n": utc(2025, 3, 4),
        "2025-03-04T10:00+02:00": utc(2025, 3, 4, 8),
        "2025-03-04T10:00:01.5Z": utc(2025, 3, 4, 10, 0, 1),
        "2025-03-04t10:00:00+0130": utc(2025, 3, 4, 8, 30),
        "2025-03-04T10:00:00": utc(2025, 3, 4, 10),
        "soon": None,
    }
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = evaluate(spark, fn.w3c_timestamp("v").cast("bigint"), list(cases))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == list(cases.values())


def test_keep_last_rank_refuses_unknown_orders():
    with pytest.raises(ValueError, match="offset order"):
        fn.keep_last_rank(F.lit("1"), order="random")
