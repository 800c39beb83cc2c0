"""Archive tables derived from the given parquet tables.

``part``, ``supplier``, ``customer`` and ``lineitem`` give one large crawl of a shop as
tables (pages and captures); ``pages`` and ``documents`` give real archives, packed into
the session's shared folder; ``orders`` gives sitemaps and URL lists; ``events`` gives
crawl logs.
"""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from archivetables.session import partitions_for, scratch_dir
from archivetables.sources.storage import locate
from archivetables.testing import pack_archives

SHOP = "https://shop.example.com"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(*parts) -> F.Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def utc(time: str) -> F.Column:
    """A stored time without zone, as the UTC time it means, in a session of any zone."""
    return F.concat(F.col(time).cast("string"), F.lit("Z")).cast("timestamp")


def utc_text(time: str, pattern: str) -> F.Column:
    return F.date_format(F.to_utc_timestamp(time, F.current_timezone()), pattern)


# the shop crawl: pages from part (seeds), supplier and customer (extra), captures from
# lineitem


def part_url(key: str) -> F.Column:
    return text(f"{SHOP}/part/", F.col(key))


def seed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.lit("shop").alias("wacz_path"),
        F.lit("pages/pages.jsonl").alias("pages_file"),
        part_url("p_partkey").alias("url"),
        F.col("p_name").alias("title"),
        F.col("p_partkey").alias("line_pos"),
    )


def extra_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select(
        part_url("s_suppkey").alias("url"),
        F.col("s_name").alias("title"),
        F.col("s_nationkey").cast("string").alias("text"),
        F.col("s_suppkey").alias("line_pos"),
    )
    customers = table(spark, sf_dir, "customer").select(
        text(f"{SHOP}/customer/", F.col("c_custkey")).alias("url"),
        F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("text"),
        F.col("c_custkey").alias("line_pos"),
    )
    return suppliers.union(customers).select(
        F.lit("shop").alias("wacz_path"), F.lit("pages/extraPages.jsonl").alias("pages_file"), "*"
    )


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_json = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    offset = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return table(spark, sf_dir, "lineitem").select(
        F.lit("shop").alias("wacz_path"),
        part_url("l_partkey").alias("url"),
        F.when(is_json, "application/json")
        .when(F.col("l_returnflag") == "R", "text/html; charset=utf-8")
        .otherwise("text/html")
        .alias("mime"),
        F.when(F.col("l_linestatus") == "F", "404").otherwise("200").alias("status"),
        text("order:", F.col("l_orderkey")).alias("digest"),
        F.col("l_quantity").cast("bigint").cast("string").alias("length"),
        offset.cast("string").alias("offset"),
        text("rec-", F.col("l_suppkey"), "-", F.col("l_linenumber"), ".warc.gz").alias("filename"),
        offset.alias("offset_num"),
        F.col("l_shipdate"),
        F.round(F.col("l_tax") * 100).cast("int").alias("tax"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount"),
    )


def html_shop_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = captures(spark, sf_dir).where("mime = 'text/html'")
    return rows.drop("l_shipdate", "tax", "discount")


def index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captures as text lines. Some break off, some lack or have an empty JSON part."""
    names = ["url", "mime", "status", "digest", "length", "offset", "filename"]
    fields = [text(f'"{name}": "', F.col(name), '"') for name in names]
    json = F.concat(F.lit("{"), F.concat_ws(", ", *fields))
    tax, discount = F.col("tax"), F.col("discount")
    line = F.concat(
        F.lit("com,example,shop)"),
        F.substring_index("url", "example.com", -1),
        F.lit(" "),
        F.date_format("l_shipdate", "yyyyMMddHHmmss"),
        F.when((tax == 0) & (discount == 0), F.concat(F.lit(" "), json))
        .when((tax == 8) & (discount == 10), "")
        .when((tax == 4) & (discount == 5), " {}")
        .otherwise(F.concat(F.lit(" "), json, F.lit("}\r"))),
    )
    return captures(spark, sf_dir).select(
        "wacz_path",
        F.lit("indexes/index.cdxj").alias("member"),
        F.lit(0).cast("bigint").alias("split_start"),
        F.lit(0).cast("bigint").alias("line_pos"),
        line.cast("binary").alias("line"),
    )


# sitemaps and URL lists from orders

_documents: dict[tuple[str, str], str] = {}


def order_sitemap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        text("https://c", F.col("o_custkey"), ".example.com/o/", F.col("o_orderkey")).alias("url"),
        utc("o_orderdate").alias("last_modified"),
        "o_custkey",
        "o_orderkey",
        "o_orderstatus",
    )


def sitemap_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fetched sitemap documents, written once per application and input folder; dealt out, as the kinds
    come one after the other and differ in work."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _documents:
        folder = scratch_dir(spark, "sitemaps")
        dealt = built_sitemap_docs(spark, sf_dir).repartition(partitions_for(spark), "sitemap_url")
        dealt.write.parquet(folder)
        _documents[key] = folder
    return spark.read.parquet(_documents[key])


def built_sitemap_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sitemaps of at most 1,000 orders of one customer each, an index per customer and
    order status that names some of them, and a robots file per customer naming the index."""
    pages = order_sitemap(spark, sf_dir).withColumn("part", F.expr("o_orderkey div 1000"))
    site = text("https://c", F.col("o_custkey"), ".example.com/")
    entry = text(
        "<url><loc> ",
        F.col("url"),
        " </loc><lastmod>",
        utc_text("last_modified", "yyyy-MM-dd"),
        "</lastmod>",
        F.when(F.col("o_orderkey") % 3 == 0, "<changefreq>daily</changefreq>").otherwise(""),
        text("<priority>0.", F.col("o_orderkey") % 10, "</priority></url>"),
    )
    xmlns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    urlsets = pages.groupBy("o_custkey", "part").agg(
        F.concat_ws("", F.collect_list(entry)).alias("entries")
    ).select(
        text(site, "sitemap-", F.col("part"), ".xml").alias("sitemap_url"),
        text(f"<urlset {xmlns}>", F.col("entries"), "</urlset>").alias("body"),
    )
    # one index document per named sitemap; those of parts with failed orders only are in
    # no index
    parts = pages.where("o_orderstatus <> 'F'").select("o_custkey", "part").distinct()
    indexes = parts.select(
        text(site, "index-", F.col("part"), ".xml").alias("sitemap_url"),
        text(
            f'<?xml version="1.0" encoding="UTF-8"?><sitemapindex {xmlns}><sitemap><loc>',
            site,
            "sitemap-",
            F.col("part"),
            ".xml</loc></sitemap></sitemapindex>",
        ).alias("body"),
    )
    robots = parts.select(
        text(site, "part-", F.col("part"), "/robots.txt").alias("sitemap_url"),
        text("User-agent: *\nSitemap: ", site, "index-", F.col("part"), ".xml\n").alias("body"),
    )
    return urlsets.union(indexes).union(robots)


def sitemap_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sitemap per order that names the next order's, in chains of up to 400 orders; one in 41
    names none."""
    orders = table(spark, sf_dir, "orders")
    chain = Window.partitionBy(F.expr("o_orderkey div 400")).orderBy("o_orderkey")
    return orders.select(
        text("sitemap-", F.col("o_orderkey")).alias("sitemap_url"),
        F.when(F.col("o_orderkey") % 41 != 0, text("sitemap-", F.lead("o_orderkey").over(chain))).alias(
            "linked_url"
        ),
        (F.row_number().over(chain) == 1).alias("is_root"),
    )


def odd_sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sitemap of one page per order, of a kind that follows from its number: with a byte-order mark,
    cut at the end, with a bare ampersand, a feed that mentions the tag of a sitemap, an HTML page, and
    numeric character references in a tag with an attribute, after a page in a comment."""
    url = text("https://odd.example.com/o?id=", F.col("o_orderkey"), "&x=1")
    escaped = F.replace(url, F.lit("&"), F.lit("&amp;"))
    sitemap = text("<urlset><url><loc>", escaped, "</loc></url></urlset>")
    numeric = F.replace(F.replace(url, F.lit("&"), F.lit("&#38;")), F.lit("="), F.lit("&#x3D;"))
    comment = "<!-- <url><loc>https://odd.example.com/old</loc></url> -->"
    kind = F.col("o_orderkey") % 6
    body = (
        F.when(kind == 0, text("\ufeff\n<?xml version='1.0'?>", sitemap))
        .when(kind == 1, text(sitemap.substr(F.lit(1), F.length(sitemap) - 9), "<url><loc>"))
        .when(kind == 2, text("<urlset><url><loc>", url, "</loc></url></urlset>"))
        .when(kind == 3, text("<rss><channel><item><title>urlset</title><link>", escaped, "</link></item></channel></rss>"))
        .when(kind == 4, text("<html>", escaped, "</html>"))
        .otherwise(text("<urlset>", comment, "<url><loc id='1'>", numeric, "</loc></url></urlset>"))
    )
    return table(spark, sf_dir, "orders").select(
        text("odd-", F.col("o_orderkey"), ".xml").alias("sitemap_url"), body.alias("body")
    )


def damaged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one log member with bytes that are no UTF-8 in them; errors are fatal lines."""
    mark = F.when(F.col("event_type") == "error", '"logLevel":"fatal"').otherwise('"logLevel":"info"')
    head = text("{", mark, ',"message":"user ', F.col("user_id"), " ")
    return table(spark, sf_dir, "events").select(
        F.lit("crawl").alias("wacz_path"),
        F.lit("logs/crawl.log").alias("member"),
        F.lit(0).cast("bigint").alias("split_start"),
        F.col("event_id").cast("bigint").alias("line_pos"),
        F.concat(head.cast("binary"), F.lit(b"\xff\xc3"), F.lit(b'"}')).alias("line"),
    )


def previous_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the previous URL list: every order's URL, twice if urgent, in white space,
    and a blank line per nation."""
    orders = table(spark, sf_dir, "orders")
    url = text("\t", f"{SHOP}/order/", F.col("o_orderkey"), "  ")
    copies = F.when(F.col("o_orderpriority") == "1-URGENT", 2).otherwise(1)
    urls = orders.select(F.explode(F.array_repeat(url, copies)).alias("value"))
    blanks = table(spark, sf_dir, "nation").select(F.lit(" \t").alias("value"))
    return urls.union(blanks)


def current_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'")
    return orders.select(text(f"{SHOP}/order/", F.col("o_orderkey")).alias("value"))


# crawl logs from events


def crawl_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log per month. Views are status lines, some of them cut off; errors are fatal
    lines, some cut off and some for want of seeds."""
    number = F.col("value") * 100
    amount = F.round(number).cast("bigint")
    k = F.get_json_object("props", "$.k")
    details = text(
        '"details":{"crawled":',
        amount,
        ',"total":',
        F.col("user_id"),
        ',"failed":',
        F.col("event_id"),
        ',"pending":"',
        k,
        '","limit":{"max":',
        k,
        ',"hit":false},"other":1}',
    )
    status = text('{"logLevel":"info","context":"crawlStatus",', details)
    fatal = text('{"logLevel":"fatal","context":"general","message":"')
    line = (
        F.when((F.col("event_type") == "view") & (amount < 100), status)
        .when(F.col("event_type") == "view", text("  ", status, "}"))
        .when((F.col("event_type") == "error") & (amount < 100), text(fatal, "cut"))
        .when(
            (F.col("event_type") == "error") & (amount < 1000),
            text(fatal, "No valid seeds specified: ", F.col("user_id"), '"}'),
        )
        .when(F.col("event_type") == "error", text(fatal, "user ", F.col("user_id"), '"}\t'))
        .when(F.col("event_type") == "click", text('{"context": "crawlStatus"}'))
        .when(F.col("event_type") == "signup", " \t ")
        .otherwise(text("plain text ", k))
    )
    return table(spark, sf_dir, "events").select(
        text("crawl-", F.date_format("ts", "yyyy-MM")).alias("path"),
        F.col("event_id").alias("line_no"),
        line.alias("line"),
    )


# real archives from pages and documents

def _headers(*pairs) -> F.Column:
    return F.array(*(F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in pairs))


def _capture(mime: str, payload, *headers, http: bool = True) -> F.Column:
    return F.struct(
        F.lit(mime).alias("mime"),
        F.lit("200").alias("status"),
        F.lit(http).alias("http"),
        _headers(*headers).alias("headers"),
        payload.cast("binary").alias("payload"),
    )


def _entry(extra: bool, title, body=None) -> F.Column:
    body = F.lit(None).cast("string") if body is None else body
    return F.struct(F.lit(extra).alias("extra"), title.alias("title"), body.alias("text"))


def archive_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to pack.

    A page has a stale capture, then the current one; with a query in its URL also a JSON
    capture and a second list entry; with a fragment it has no capture at all. A document
    has one capture and an extra entry; those of source ``src0`` are sitemap pages.
    """
    pages = table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    html = F.lit("text/html")
    encoding = F.when(F.col("url").startswith("https:"), "gzip").otherwise("identity")
    stale = _capture("text/html", text("stale ", F.col("url")), ("Content-Type", html))
    current = _capture(
        "text/html",
        F.col("html"),
        ("Content-Type", html),
        ("Set-Cookie", text("page=", F.col("page_id"))),
        ("content-encoding", encoding),
        ("Set-Cookie", F.col("url")),
        ("Transfer-Encoding", F.lit("chunked")),
        ("set-cookie", F.lit("lower")),
    )
    data = _capture("application/json", F.lit("{}"), ("Content-Type", F.lit("application/json")))
    has_query, has_fragment = F.col("url").contains("?"), F.col("url").contains("#")
    listed = _entry(False, title)
    again = _entry(True, text("again ", title), F.col("url"))
    page_rows = pages.select(
        "url",
        F.when(has_query, F.array(listed, again)).otherwise(F.array(listed)).alias("entries"),
        F.when(has_fragment, F.slice(F.array(stale), 1, 0))
        .when(has_query, F.array(stale, current, data))
        .otherwise(F.array(stale, current))
        .alias("captures"),
        text('{"context":"crawlStatus","details":{"crawled":', F.col("page_id"), "}}").alias("log_line"),
    )
    docs = table(spark, sf_dir, "documents")
    suffix = F.when(F.col("source") == "src0", "/sitemap.xml").otherwise("")
    doc_rows = docs.select(
        text("https://docs.example.org/", F.col("source"), "/", F.col("doc_id"), suffix).alias("url"),
        F.array(_entry(True, text(F.col("lang"), " ", F.col("doc_id")), F.col("text"))).alias("entries"),
        F.array(
            _capture(
                "text/html",
                text("<pre>", F.col("text"), "</pre>"),
                ("Content-Type", html),
                ("X-Lang", F.col("lang")),
                ("Content-Encoding", F.lit("deflate")),
            )
        ).alias("captures"),
        F.lit(None).cast("string").alias("log_line"),
    )
    return page_rows.unionByName(doc_rows)


_packed: dict[tuple[str, str, bool], str] = {}


def archives(spark: SparkSession, sf_dir: str, plain: bool = True) -> str:
    """Glob of the packed archives; packed once per application and input folder. Those that are not
    ``plain`` hold packed WARC files, and indexes without a list of their blocks."""
    key = (spark.sparkContext.applicationId, sf_dir, plain)
    if key not in _packed:
        folder = scratch_dir(spark, "archives")
        rows, tasks = archive_rows(spark, sf_dir), partitions_for(spark)
        pack_archives(rows, folder, tasks, deflate_warcs=not plain, list_blocks=plain)
        _packed[key] = f"{folder}/*.wacz"
    return _packed[key]


# sites whose sitemaps lie on other hosts, some of them in several sites' trees

CDNS = 7


def cdn_sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched documents. A site holds eight documents. Four of five sites have a robots file that names an
    index and a shared sitemap on another host; the index names the sitemap of the site, and itself."""
    site_no, doc = F.expr("doc_id div 8"), F.col("doc_id")
    site, cdn = text("https://c", site_no, ".example.com"), text("https://cdn", site_no % CDNS, ".example.net")
    page = text("<url><loc>", site, "/o/", doc, "</loc></url>")
    per = table(spark, sf_dir, "documents").groupBy(
        site_no.alias("site_no"),
        site.alias("site"),
        text(cdn, "/index-", site_no, ".xml").alias("index"),
        text(cdn, "/pages-", site_no, ".xml").alias("own"),
        text(cdn, "/shared.xml").alias("shared"),
    ).agg(F.concat_ws("", F.collect_list(page)).alias("pages"))
    named = [text("<sitemap><loc>", F.col(c), "</loc></sitemap>") for c in ("own", "index")]
    robots = per.where("site_no % 5 <> 0").select(
        text(F.col("site"), "/robots.txt"),
        text("User-agent: *\nSitemap: ", F.col("index"), "\nsitemap:", F.col("shared"), "\n"),
    )
    index = per.select("index", text("<sitemapindex>", *named, "</sitemapindex>"))
    extra = per.select(
        text(F.col("site"), "/extra.xml"),
        text("<urlset><url><loc>", F.col("site"), "/extra</loc></url></urlset>"),
    )
    supplier = F.col("s_suppkey")
    shop = text("<url><loc>https://s", supplier, ".example.org/</loc></url>")
    shared = table(spark, sf_dir, "supplier").groupBy((supplier % CDNS).alias("cdn")).agg(
        F.concat_ws("", F.collect_list(shop)).alias("pages")
    )
    shared = shared.select(
        text("https://cdn", F.col("cdn"), ".example.net/shared.xml"),
        text("<urlset>", F.col("pages"), "</urlset>"),
    )
    own = per.select("own", text("<urlset>", F.col("pages"), "</urlset>"))
    docs = robots.unionAll(index).unionAll(own).unionAll(extra).unionAll(shared)
    return docs.toDF("sitemap_url", "body")


def known_sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sitemaps that are known beforehand: one per site, which no other document names."""
    sites = table(spark, sf_dir, "documents").select(F.expr("doc_id div 8").alias("site_no")).distinct()
    return sites.select(text("https://c", F.col("site_no"), ".example.com/extra.xml").alias("sitemap_url"))


# index lines whose objects have keys of their own


def rich_index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index lines with keys that vary by row: a number, a text, an array, and a key of odd characters."""
    doc, size = F.col("doc_id"), F.col("n_chars")
    keys = [
        text('"url": "https://docs.example.org/', doc, '"'),
        F.when(doc % 2 == 0, text('"recordDigest": "sha256:', size, '"')),
        F.when(doc % 3 == 0, text('"tries": ', size)),
        F.when(doc % 3 == 1, text('"tries": "', F.col("lang"), '"')),
        F.when(F.col("lang") == "en", text('"odd key.x": ["en", ', size, "]")),
    ]
    json = F.concat(F.lit("{"), F.concat_ws(", ", *keys), F.lit("}"))
    return table(spark, sf_dir, "documents").select(
        F.lit("docs").alias("wacz_path"),
        F.lit("indexes/index.cdxj").alias("member"),
        F.lit(0).cast("bigint").alias("split_start"),
        F.lit(0).cast("bigint").alias("line_pos"),
        text("key 20250101000000 ", json).cast("binary").alias("line"),
    )


# URL lists in packed files


def document_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line per document, with blanks around its URL, and the source."""
    line = text(" https://docs.example.org/", F.col("doc_id"), "\t")
    return table(spark, sf_dir, "documents").select(line.alias("value"), "source")


def packed_list(lines: DataFrame, label: str, damaged: bool) -> str:
    """The folder of a list written as packed files; of a damaged list the first file breaks off."""
    folder = scratch_dir(lines.sparkSession, label)

    def write(batches):
        number = TaskContext.get().partitionId()
        texts = [line for batch in batches for line in batch.column(0).to_pylist()]
        data = gzip.compress("".join(f"{line}\n" for line in texts).encode(), mtime=0)
        fs, inner = locate(folder)
        fs.create_dir(inner, recursive=True)
        with fs.open_output_stream(f"{inner}/list-{number}.gz", compression=None) as sink:
            sink.write(data[:-9] if damaged and not number else data)
        yield pa.RecordBatch.from_pydict({"n": [len(texts)]})

    tasks = partitions_for(lines.sparkSession)
    spread = lines.select("value").repartition(tasks, F.xxhash64("value"))
    spread.mapInArrow(write, "n bigint").agg(F.sum("n")).collect()
    return folder
