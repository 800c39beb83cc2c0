import gzip
from datetime import UTC, datetime

import pytest

from archivetables import operators as ops

DAYS = [("//shop/june", "2019-06-30"), ("//shop/july", "2019-07-01"), ("//shop/october", "2019-10-31"),
        ("//shop/never", None)]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(DAYS, "url string, day string").selectExpr(
        "url", "to_timestamp(day) AS last_modified"
    )


def names(df):
    return sorted(r.url.rpartition("/")[2] for r in df.collect())


@pytest.mark.parametrize(
    ("bounds", "expected"),
    [
        ((None, None), ["july", "june", "never", "october"]),
        (("2019-07-01", None), ["july", "october"]),
        ((None, "2019-07-01"), ["june"]),
        (("2019-07-01T00:00:01", None), ["october"]),
        (("2019-06-30", "2019-10-31"), ["july", "june"]),
        (("1 July 2019", "20191101"), ["july", "october"]),
        (("2020", None), []),
    ],
)
def test_date_bounds(pages, bounds, expected):
    assert names(ops.filter_by_date(pages, *bounds)) == expected


def test_bound_given_per_call_goes_first(pages):
    got = ops.filter_by_date(pages, "2019-07-01", "", default_from="2020-01-01", default_to="2019-08-01")
    assert names(got) == ["july"]
    assert names(ops.filter_by_date(pages, default_from="2019-08-01")) == ["october"]
    assert names(ops.filter_by_date(pages, "2019-08-01", keep_undated=True)) == ["never", "october"]


def test_zone_of_a_bound_is_dropped():
    assert ops.date_bound("2025-02-01T10:00+05:00") == datetime(2025, 2, 1, 10, tzinfo=UTC)
    assert ops.date_bound("", "2025-01-01") == datetime(2025, 1, 1, tzinfo=UTC)
    assert ops.date_bound(None) is None


def test_roots(spark):
    urls = ["http://a.test:8080/map/one.xml", "http://a.test:8080/two.xml", "http://a.test:8080/two.xml#x",
            "https://a.test/two.xml"]
    df = spark.createDataFrame([(u,) for u in urls], "sitemap_url string")
    assert {(r.root, r.path) for r in ops.sitemap_roots(df).collect()} == {
        ("http://a.test:8080", "/map/one.xml"), ("http://a.test:8080", "/two.xml"), ("https://a.test", "/two.xml"),
    }


NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
DOCS = [
    ("h/robots.txt", "User-agent: *\nSitemap: h/index.xml\n sitemap:h/plain.xml\nDisallow: /"),
    ("h/index.xml", f"<sitemapindex {NS}><sitemap><loc> h/a.xml </loc></sitemap>"
                    "<sitemap><loc>h/index2.xml</loc></sitemap></sitemapindex>"),
    ("h/index2.xml", "<sitemapindex><sitemap><loc>h/b.xml</loc></sitemap>"
                     "<sitemap><loc>h/index.xml</loc></sitemap></sitemapindex>"),
    ("h/a.xml", f"<?xml version='1.0'?><urlset {NS}><url><loc> h/1?a=1&amp;b=2\n</loc>"
                "<lastmod>2025-01-01</lastmod></url><url><loc>h/2</loc></url><url/></urlset>"),
    ("h/b.xml", "<s:urlset xmlns:s='x'><s:url><s:loc>h/1?a=1&amp;b=2</s:loc>"
                "<s:lastmod>2025-01-01T00:00:00Z</s:lastmod></s:url></s:urlset>"),
    ("h/c.xml", "<urlset><url><loc>h/3</loc></url></urlset>"),
    ("h/bad.xml", "<urlset><url><loc>h/4</loc>"),
    ("h/junk", "urlset"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, "sitemap_url string, body string")


def test_entries(docs):
    got = {(r.sitemap_url, r.url, str(r.last_modified)) for r in ops.sitemap_entries(docs).collect()}
    assert got == {
        ("h/a.xml", "h/1?a=1&b=2", "2025-01-01 00:00:00"), ("h/a.xml", "h/2", "None"),
        ("h/b.xml", "h/1?a=1&b=2", "2025-01-01 00:00:00"), ("h/c.xml", "h/3", "None"),
    }


FEEDS = [
    ("rss", "<?xml version='1.0'?><rss xmlns:atom='a'><channel><link>h/home</link><atom:link href='x' rel='self'/>"
            "<item><link> h/1 </link><pubDate>Mon, 01 Jan 2024</pubDate></item><item><title>t</title></item>"
            "<item><link>h/2</link></item></channel></rss>"),
    ("atom", "<feed xmlns='http://www.w3.org/2005/Atom'><link href='h/home'/>"
             "<entry><link rel='alternate' href='h/3'/><link rel='self' href='h/4'/></entry>"
             "<entry><link rel='edit' href='h/5'/></entry><entry><link href='h/6'/></entry></feed>"),
    ("text", "https://h/7\r\n HTTP://h/8 \n\nnot a page\nftp://h/9\nhttps://\n"),
    ("h/robots.txt", "https://h/10\n"),
    ("html", "<html><body>https://h/11</body></html>"),
    ("empty", ""),
]


def test_feeds_and_text(spark):
    docs = spark.createDataFrame(FEEDS, "sitemap_url string, body string")
    rows = ops.sitemap_entries(docs).collect()
    assert {(r.sitemap_url, r.url) for r in rows} == {
        ("rss", "h/1"), ("rss", "h/2"), ("atom", "h/4"), ("atom", "h/5"), ("atom", "h/6"),
        ("text", "https://h/7"), ("text", "HTTP://h/8"),
    }
    assert {r.last_modified for r in rows} == {None}


def test_links_and_reachable(spark, docs):
    links = ops.sitemap_links(docs)
    assert {(r.sitemap_url, r.linked_url) for r in links.collect()} == {
        ("h/robots.txt", "h/index.xml"), ("h/robots.txt", "h/plain.xml"), ("h/index.xml", "h/a.xml"),
        ("h/index.xml", "h/index2.xml"), ("h/index2.xml", "h/b.xml"), ("h/index2.xml", "h/index.xml"),
    }
    roots = spark.createDataFrame([("h/robots.txt",), ("h/robots.txt",)], "sitemap_url string")
    reached = sorted(r.sitemap_url for r in ops.reachable_sitemaps(links, roots).collect())
    assert reached == ["h/a.xml", "h/b.xml", "h/index.xml", "h/index2.xml", "h/plain.xml", "h/robots.txt"]


def test_a_chain_of_any_length_is_walked(spark):
    links = spark.range(40).selectExpr("'s' || id AS sitemap_url", "'s' || (id + 1) AS linked_url")
    roots = spark.createDataFrame([("s0",)], "sitemap_url string")
    assert ops.reachable_sitemaps(links, roots).count() == 41


ODD = [
    ("bom", "\ufeff<?xml version='1.0'?><urlset><url><loc>h/1</loc></url></urlset>", {"h/1"}, {}),
    ("blank", "\n <?xml version='1.0'?>\n<!-- urls -->\n<urlset><url><loc>h/2</loc></url></urlset>\n", {"h/2"}, {}),
    ("cut", "<urlset><url><loc>h/3</loc></url><url><loc>h/4</lo", {"h/3"},
     {"ends within the document": 1, "no address": 1}),
    ("bare", "<urlset><url><loc>h/5?a&b</loc></url><url><loc>h/6?a&amp;b&#38;c</loc></url></urlset>",
     {"h/5?a&b", "h/6?a&b&c"}, {}),
    ("cdata", "<urlset><url><loc><![CDATA[ h/7?a&b ]]></loc><lastmod>soon</lastmod></url></urlset>", {"h/7?a&b"},
     {"no date": 1}),
    ("image", "<urlset xmlns:i='x'><url><i:image><i:loc>h/i</i:loc></i:image><loc>h/8</loc></url></urlset>", {"h/8"}, {}),
    ("feed", "<rss><channel><item><link>h/9</link><title>a urlset</title></item></channel></rss>", {"h/9"}, {}),
    ("broken feed", "<rss><channel><item><link>h/10</link></channel></rss>", set(), {"no well-formed feed": 1}),
    ("page", "<html><body>urlset</body></html>", set(), {"no sitemap": 1}),
    ("nothing", "", set(), {"empty body": 1}),
    ("null", None, set(), {"unreadable body": 1}),
    ("empty set", "<urlset/>", set(), {}),
    ("many", "<urlset>" + "<url><loc>h/same</loc></url>" * 30_000 + "</urlset>", {"h/same"}, {}),
]


@pytest.mark.parametrize("packed", [None, False, True])
def test_odd_documents_are_read_or_reported(spark, packed):
    def body(text):
        if packed is None or text is None:
            return text
        return gzip.compress(text.encode()) if packed else text.encode()

    kind = "string" if packed is None else "binary"
    docs = spark.createDataFrame([(u, body(t)) for u, t, _, _ in ODD], f"sitemap_url string, body {kind}")
    found, rejects = {}, {}
    for r in ops.sitemap_entries(docs).collect():
        found.setdefault(r.sitemap_url, set()).add(r.url)
    for r in ops.sitemap_rejects(docs).collect():
        rejects.setdefault(r.sitemap_url, {})[r.reason] = r.n
    assert found == {u: urls for u, _, urls, _ in ODD if urls}
    assert rejects == {u: reasons for u, _, _, reasons in ODD if reasons}


def test_damaged_gzip_is_reported(spark):
    docs = spark.createDataFrame([("d", bytearray(gzip.compress(b"<urlset/>")[:-9]))], "sitemap_url string, body binary")
    assert ops.sitemap_entries(docs).count() == 0
    assert [r.reason for r in ops.sitemap_rejects(docs).collect()] == ["unreadable body"]


def test_fields_of_a_page(spark):
    body = ("<urlset><url><loc>h/1</loc><lastmod>January 5, 2024</lastmod><changefreq>daily</changefreq>"
            "<priority>0.8</priority></url><url><loc>h/1</loc><lastmod>2024-01-05</lastmod></url></urlset>")
    docs = spark.createDataFrame([("a", body), ("b", body)], "sitemap_url string, body string")
    pages = ops.distinct_pages(ops.sitemap_entries(docs)).orderBy("priority").collect()
    assert [tuple(map(str, r)) for r in pages] == [
        ("h/1", "2024-01-05 00:00:00", "None", "None"), ("h/1", "2024-01-05 00:00:00", "daily", "0.8"),
    ]


def test_distinct(pages):
    twice = pages.union(pages).union(pages.selectExpr("url", "last_modified + INTERVAL 1 DAY"))
    assert ops.distinct_pages(twice).count() == 7
    latest = ops.distinct_pages(twice, by="url").where("url LIKE '%june'").first()
    assert str(latest.last_modified) == "2019-07-01 00:00:00"
    with pytest.raises(ValueError, match="by must be"):
        ops.distinct_pages(pages, by="host")


REFERENCES = [
    ("<url><loc>h/caf&#233;?a=1&#x3D;2</loc></url>", {"h/café?a=1=2"}),
    ("<url><loc>h/&amp;#233;</loc></url>", {"h/&#233;"}),
    ("<url><loc>h/caf&#xE9;?a&b&eacute;</loc></url>", {"h/café?a&b&eacute;"}),
    ("<s:url xmlns:s='x'><s:loc>h/&#x1F600;</s:loc></s:url>", {"h/😀"}),
    ("<url><loc id='1'>h/attribute</loc></url>", {"h/attribute"}),
    ("<url><loc id='1'>h/attribute?a&b</loc></url>", {"h/attribute?a&b"}),
    ("<url><loc>h/&#0;</loc></url>", {"h/&#0;"}),
    ("<url />" "<url><loc>h/next</loc></url>", {"h/next"}),
    ("<!-- <url><loc>h/gone</loc></url> --><url><loc>h/kept</loc></url><!-- </url> -->", {"h/kept"}),
    ("<url><loc><![CDATA[h/<!--x-->&#233;]]></loc></url>", {"h/<!--x-->&#233;"}),
    ("<url><loc>h/one</loc><loc>h/two</loc></url>", {"h/one"}),
]


def test_references_attributes_and_comments(spark):
    pages = [(str(i), f"<urlset>{e}</urlset>") for i, (e, _) in enumerate(REFERENCES)]
    docs = spark.createDataFrame(pages, "sitemap_url string, body string")
    found = {}
    for r in ops.sitemap_entries(docs).collect():
        found.setdefault(r.sitemap_url, set()).add(r.url)
    assert found == {str(i): urls for i, (_, urls) in enumerate(REFERENCES)}
    index = [(u, b.replace("urlset", "sitemapindex").replace("url", "sitemap")) for u, b in pages]
    linked = {}
    for r in ops.sitemap_links(spark.createDataFrame(index, docs.schema)).collect():
        linked.setdefault(r.sitemap_url, set()).add(r.linked_url)
    assert linked == found
    reasons = [(r.sitemap_url, r.reason) for r in ops.sitemap_rejects(docs).collect()]
    assert reasons == [("7", "no address")]
