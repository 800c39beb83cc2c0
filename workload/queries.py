"""One query per operator: ``QUERIES[name]`` over Spark, ``ORACLES[name]`` in SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import archivetables as at
from archivetables import operators as ops
from archivetables import plans, sinks
from archivetables.functions import header_map, strip, utf8_text
from archivetables.session import scratch_dir
from archivetables.sources import (
    read_previous_url_list,
    read_url_list,
    stage_packed,
    text_lines,
    url_list_problems,
    urls_gone,
    write_snapshot,
    write_url_list,
)
from workload import sql
from workload import tables as tb

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = oracle
        return function

    return register


# page lists and index


@query(
    f"""WITH {sql.SEED_PAGES}, {sql.EXTRA_PAGES}
    SELECT 'shop' AS wacz_path, * FROM (
      SELECT 'pages/pages.jsonl' AS pages_file, url, title, line_pos,
             CAST(NULL AS VARCHAR) AS text FROM seed_pages
      UNION ALL
      SELECT 'pages/extraPages.jsonl', url, title, line_pos, text FROM extra_pages)"""
)
def pages_union(spark, sf_dir):
    return ops.union_page_lists(tb.seed_pages(spark, sf_dir), tb.extra_pages(spark, sf_dir))


@query(
    """SELECT url FROM pages WHERE NOT ends_with(url, '.html') AND NOT ends_with(url, '#top')"""
)
def page_suffix_filter(spark, sf_dir):
    pages = tb.table(spark, sf_dir, "pages")
    return ops.without_sitemap_pages(pages, [".html", "#top"]).select("url")


@query(
    f"""WITH {sql.INDEX_LINES}
    SELECT url, mime, status, digest, length, "offset", filename, offset_num
    FROM line_parts WHERE state = 'good'"""
)
def cdx_parse(spark, sf_dir):
    return ops.parse_cdx(tb.index_lines(spark, sf_dir)).drop("wacz_path", "cdx_file")


@query(
    f"""WITH {sql.INDEX_LINES}
    SELECT CASE WHEN state = 'no JSON part' THEN head ELSE head || ' ' || json END AS line,
           state AS reason
    FROM line_parts WHERE state IN ('malformed JSON', 'no JSON part')"""
)
def cdx_rejects(spark, sf_dir):
    rejects = ops.cdx_rejects(tb.index_lines(spark, sf_dir))
    return rejects.select(F.col("line").cast("string").alias("line"), "reason")


@query(
    f"""WITH {sql.CAPTURES}
    SELECT url, mime, status, filename, "offset" FROM html_captures"""
)
def cdx_mime_filter(spark, sf_dir):
    rows = ops.html_captures(tb.captures(spark, sf_dir))
    return rows.select("url", "mime", "status", "filename", "offset")


# joins and deduplication

JOINED = """SELECT p.url, p.title, c.status, c.filename, c."offset", c.length
    FROM shop_pages p"""


@query(f"WITH {sql.SHOP_PAGES}, {sql.CAPTURES} {JOINED} JOIN html_captures c USING (url)")
def html_websites(spark, sf_dir):
    joined = ops.join_captures(
        pages_union(spark, sf_dir), tb.html_shop_captures(spark, sf_dir)
    )
    return joined.select("url", "title", "status", "filename", "offset", "length")


@query(f"WITH {sql.SHOP_PAGES}, {sql.CAPTURES} {JOINED} LEFT JOIN html_captures c USING (url)")
def html_websites_left(spark, sf_dir):
    joined = ops.join_captures(
        pages_union(spark, sf_dir), tb.html_shop_captures(spark, sf_dir), keep_uncaptured=True
    )
    return joined.select("url", "title", "status", "filename", "offset", "length")


def _capture_records(spark, sf_dir):
    return tb.html_shop_captures(spark, sf_dir).select(
        "url",
        F.lit("active").alias("status"),
        F.col("filename").alias("cdx_warc_filename"),
        F.col("offset").alias("cdx_offset"),
        F.col("length").alias("cdx_length"),
    )


LAST_RECORDS = """SELECT url, 'active' AS status, filename AS cdx_warc_filename,
    "offset" AS cdx_offset, length AS cdx_length FROM last_capture"""


@query(f"WITH {sql.CAPTURES}, {sql.last_capture(True)} {LAST_RECORDS}")
def dedup_last_offset(spark, sf_dir):
    return ops.drop_duplicate_urls(_capture_records(spark, sf_dir))


@query(f"WITH {sql.CAPTURES}, {sql.last_capture(True)} {LAST_RECORDS}")
def dedup_window(spark, sf_dir):
    return ops.drop_duplicate_urls_window(_capture_records(spark, sf_dir))


@query(f"WITH {sql.CAPTURES}, {sql.last_capture(False)} {LAST_RECORDS}")
def dedup_lexicographic(spark, sf_dir):
    return ops.drop_duplicate_urls(
        _capture_records(spark, sf_dir), offset_order="lexicographic"
    )


def _part_deletes(spark, sf_dir):
    parts = tb.table(spark, sf_dir, "part")
    listed = parts.select(tb.part_url("p_partkey").alias("url"), "p_size")
    return ops.deleted_urls(listed, listed.where("p_size > 10"))


PART_DELETES = """
    part_deletes AS (
      SELECT 'https://shop.example.com/part/' || p_partkey AS url FROM part
      WHERE p_size <= 10)"""


@query(
    f"""WITH {sql.CAPTURES}, {sql.last_capture(True)}, {PART_DELETES}
    {LAST_RECORDS} WHERE url NOT IN (SELECT url FROM part_deletes)
    UNION ALL SELECT url, 'deleted', NULL, NULL, NULL FROM part_deletes"""
)
def dedup_delete_wins(spark, sf_dir):
    records = ops.append_deletes(_capture_records(spark, sf_dir), _part_deletes(spark, sf_dir))
    return ops.drop_duplicate_urls(records)


@query(
    f"""WITH {sql.CAPTURES}, {sql.last_capture(True)}, {PART_DELETES}
    {LAST_RECORDS}
    UNION ALL SELECT url, 'deleted', NULL, NULL, NULL FROM part_deletes
    WHERE url NOT IN (SELECT url FROM last_capture)"""
)
def dedup_active_wins(spark, sf_dir):
    records = ops.append_deletes(_capture_records(spark, sf_dir), _part_deletes(spark, sf_dir))
    return ops.drop_duplicate_urls(records, prefer="active")


@query(
    f"""WITH {sql.SHOP_PAGES}, {sql.CAPTURES}, {sql.last_capture(True)}, {sql.LAST_PAGE}
    SELECT 'shop' AS wacz_path, url, title, filename, "offset", length, offset_num
    FROM last_page JOIN last_capture USING (url)"""
)
def record_pointers(spark, sf_dir):
    return ops.record_pointers(pages_union(spark, sf_dir), tb.html_shop_captures(spark, sf_dir))


@query(
    f"""WITH {sql.SHOP_PAGES}, {sql.CAPTURES}, {PART_DELETES},
    deletes AS (SELECT count(*) AS n FROM part_deletes),
    joined AS (SELECT url FROM shop_pages JOIN html_captures USING (url))
    SELECT 'pages' AS stage, count(*) AS n_rows FROM shop_pages
    UNION ALL SELECT 'captures', count(*) FROM html_captures
    UNION ALL SELECT 'joined', count(*) FROM joined
    UNION ALL SELECT 'records', count(DISTINCT url) FROM joined
    UNION ALL SELECT 'deletes', n FROM deletes"""
)
def pipeline_counts(spark, sf_dir):
    return ops.pipeline_counts(
        pages_union(spark, sf_dir),
        tb.html_shop_captures(spark, sf_dir),
        _part_deletes(spark, sf_dir),
    )


@query(
    """SELECT 'c' || c_custkey AS wacz_path, problem FROM (
      SELECT c_custkey, 'unreadable archive' AS problem FROM customer WHERE c_acctbal < 0
      UNION ALL SELECT c_custkey, 'no page rows' FROM customer
      WHERE c_acctbal >= 0
        AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
      UNION ALL SELECT c_custkey, 'no index lines' FROM customer
      WHERE c_acctbal >= 0
        AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'))"""
)
def archive_problems(spark, sf_dir):
    customers, orders = tb.table(spark, sf_dir, "customer"), tb.table(spark, sf_dir, "orders")
    path = tb.text("c", F.col("c_custkey"))
    member = F.when(F.col("c_acctbal") >= 0, "pages/pages.jsonl")
    crawl = tb.text("c", F.col("o_custkey")).alias("wacz_path")
    return ops.archive_problems(
        customers.select(path.alias("path")),
        customers.select(path.alias("wacz_path"), member.alias("member")),
        orders.where("o_orderpriority = '1-URGENT'").select(crawl),
        orders.where("o_orderpriority = '5-LOW'").select(crawl),
    )


# URL lists and deletions


def _written_list(lines: DataFrame, label: str) -> str:
    path = scratch_dir(lines.sparkSession, label)
    lines.write.text(path)
    return path


@query(f"WITH {sql.PREVIOUS_URLS} SELECT url FROM previous_urls")
def url_strip(spark, sf_dir):
    return tb.previous_lines(spark, sf_dir).select(strip("value").alias("url"))


@query(f"WITH {sql.CURRENT_URLS} SELECT url FROM current_urls")
def url_list_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "urls")
    write_url_list(tb.current_lines(spark, sf_dir).withColumnRenamed("value", "url"), path)
    return read_url_list(spark, path)


GONE_ORDERS = """SELECT url, 'deleted' AS status FROM (
    SELECT url FROM previous_urls WHERE url <> '' EXCEPT SELECT url FROM current_urls)"""


@query(f"WITH {sql.PREVIOUS_URLS}, {sql.CURRENT_URLS} {GONE_ORDERS}")
def deleted_urls(spark, sf_dir):
    previous = _written_list(tb.previous_lines(spark, sf_dir), "previous")
    current = _written_list(tb.current_lines(spark, sf_dir), "current")
    return ops.deleted_urls(read_url_list(spark, previous), read_url_list(spark, current))


@query(f"WITH {sql.PREVIOUS_URLS}, {sql.CURRENT_URLS} {GONE_ORDERS}")
def snapshot_deleted_urls(spark, sf_dir):
    paths = [scratch_dir(spark, "snapshot") for _ in range(2)]
    for path, lines in zip(paths, (tb.previous_lines(spark, sf_dir), tb.current_lines(spark, sf_dir))):
        write_snapshot(lines.withColumnRenamed("value", "url"), path)
    return urls_gone(spark, *paths)


@query(
    """SELECT 'https://shop.example.com/part/' || l_partkey || '/' || l_quantity::BIGINT AS url,
              'deleted' AS status
    FROM (SELECT l_partkey, l_quantity FROM lineitem WHERE l_returnflag <> 'N'
          EXCEPT SELECT l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'N')"""
)
def deleted_urls_anti(spark, sf_dir):
    """Lists with many repeated lines."""
    lines = tb.table(spark, sf_dir, "lineitem").select(
        F.concat_ws("/", tb.part_url("l_partkey"), F.col("l_quantity").cast("bigint")).alias("url"),
        "l_returnflag",
    )
    return ops.deleted_urls(lines.where("l_returnflag <> 'N'"), lines.where("l_returnflag = 'N'"))


@query(
    """SELECT 'c' || o_custkey AS wacz_path, '/' || month AS url, 'deleted' AS status FROM (
      SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders
      WHERE o_orderstatus <> 'O'
      EXCEPT
      SELECT o_custkey, strftime(o_orderdate, '%Y-%m') FROM orders WHERE o_orderstatus = 'O')"""
)
def deleted_urls_per_crawl(spark, sf_dir):
    rows = tb.table(spark, sf_dir, "orders").select(
        tb.text("c", F.col("o_custkey")).alias("wacz_path"),
        F.concat(F.lit("/"), F.date_format("o_orderdate", "yyyy-MM")).alias("url"),
        "o_orderstatus",
    )
    return ops.deleted_urls(
        rows.where("o_orderstatus <> 'O'"), rows.where("o_orderstatus = 'O'")
    )


# records


def _page_fetches(spark, sf_dir):
    """Pages as if fetched, without going through an archive."""
    pages = tb.table(spark, sf_dir, "pages")
    headers = F.from_json(
        F.lit('[{"name":"A","value":"1"},{"name":"B","value":"2"},{"name":"A","value":"3"}]'),
        "array<struct<name:string,value:string>>",
    )
    return pages.select(
        "url",
        tb.text("page ", F.col("page_id")).alias("title"),
        tb.text("rec-", F.length("html"), ".warc.gz").alias("filename"),
        F.length("html").cast("string").alias("offset"),
        F.length("url").cast("string").alias("length"),
        F.col("html").cast("binary").alias("payload"),
        headers.alias("headers"),
    )


PAGE_RECORDS = """
    page_records AS (
      SELECT url, 'active' AS status, 'rec-' || length(html) || '.warc.gz' AS cdx_warc_filename,
             'page ' || page_id AS cdx_title, CAST(length(html) AS VARCHAR) AS cdx_offset,
             CAST(length(url) AS VARCHAR) AS cdx_length,
             to_base64(encode(html)) AS html_base64,
             '{"A":["1","3"],"B":["2"]}' AS response_headers
      FROM pages)"""


def _headers_text(records: DataFrame) -> DataFrame:
    return records.withColumn("response_headers", F.to_json("response_headers"))


@query(f"WITH {PAGE_RECORDS} SELECT * FROM page_records")
def active_records(spark, sf_dir):
    return _headers_text(ops.active_records(_page_fetches(spark, sf_dir)))


def _records_with_deletes(spark, sf_dir):
    active = ops.active_records(_page_fetches(spark, sf_dir))
    return ops.append_deletes(active, _part_deletes(spark, sf_dir))


ALL_RECORDS = f"""{PAGE_RECORDS}, {PART_DELETES},
    all_records AS (
      SELECT * FROM page_records
      UNION ALL
      SELECT url, 'deleted', NULL, NULL, NULL, NULL, NULL, NULL FROM part_deletes)"""


@query(f"WITH {ALL_RECORDS} SELECT * FROM all_records")
def records_with_deletes(spark, sf_dir):
    return _headers_text(_records_with_deletes(spark, sf_dir))


@query(f"WITH {ALL_RECORDS} SELECT * FROM all_records")
def records_ordered(spark, sf_dir):
    return _headers_text(ops.order_by_offset(_records_with_deletes(spark, sf_dir)))


# sinks: written, then read back


def _written_records(spark, sf_dir, fmt):
    path = f"{scratch_dir(spark, 'records')}.{fmt}"
    sinks.write_records(_records_with_deletes(spark, sf_dir), path)
    return path


@query(f"WITH {ALL_RECORDS} SELECT * FROM all_records")
def sink_jsonl(spark, sf_dir):
    path = _written_records(spark, sf_dir, "jsonl")
    return _headers_text(spark.read.schema(at.schemas.RECORD).json(path))


@query(
    f"""WITH {ALL_RECORDS}
    SELECT url, status, coalesce(cdx_warc_filename, 'None') AS cdx_warc_filename,
           coalesce(cdx_title, 'None') AS cdx_title,
           coalesce(cdx_offset, 'None') AS cdx_offset,
           coalesce(cdx_length, 'None') AS cdx_length,
           coalesce(html_base64, 'None') AS html_base64,
           coalesce(response_headers, 'None') AS response_headers
    FROM all_records"""
)
def sink_xml(spark, sf_dir):
    path = _written_records(spark, sf_dir, "xml")
    return spark.read.schema(_flat_schema()).option("rowTag", "record").xml(path)


def _flat_schema():
    return ", ".join(f"{name} string" for name in at.schemas.RECORD.fieldNames())


def _read_cells(spark, path, sep):
    options = {"header": True, "sep": sep, "escape": '"', "multiLine": True}
    return spark.read.options(**options).schema(_flat_schema()).csv(path)


@query(f"WITH {ALL_RECORDS} SELECT * FROM all_records")
def sink_csv(spark, sf_dir):
    return _read_cells(spark, _written_records(spark, sf_dir, "csv"), ",")


@query(f"WITH {ALL_RECORDS} SELECT * FROM all_records")
def sink_tsv(spark, sf_dir):
    return _read_cells(spark, _written_records(spark, sf_dir, "tsv"), "\t")


# sitemaps

SITE = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"
PATH = "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"


@query(
    f"""WITH {sql.ORDER_SITEMAP},
    urls AS (SELECT url FROM pages UNION ALL SELECT url FROM order_sitemap)
    SELECT DISTINCT {SITE} AS root, regexp_replace({PATH}, ';[^/]*$', '') AS path FROM urls"""
)
def sitemap_root_paths(spark, sf_dir):
    urls = tb.table(spark, sf_dir, "pages").select("url")
    urls = urls.union(tb.order_sitemap(spark, sf_dir).select("url"))
    return ops.sitemap_roots(urls, "url")


DATE_TEXT = "strftime(last_modified, '%Y-%m-%d %H:%M:%S') AS last_modified"


PAGE_TEXT = """CASE WHEN o_orderkey % 3 = 0 THEN 'daily' END AS change_frequency,
           '0.' || (o_orderkey % 10) AS priority"""


def _dated(pages: DataFrame) -> DataFrame:
    return pages.withColumn(
        "last_modified", tb.utc_text("last_modified", "yyyy-MM-dd HH:mm:ss")
    )


@query(
    f"""WITH {sql.ORDER_SITEMAP}
    SELECT 'https://c' || o_custkey || '.example.com/sitemap-' || part || '.xml' AS sitemap_url,
           url, {DATE_TEXT}, {PAGE_TEXT}
    FROM order_sitemap"""
)
def sitemap_entries(spark, sf_dir):
    return _dated(ops.sitemap_entries(tb.sitemap_docs(spark, sf_dir)))


@query(
    f"""WITH {sql.SITEMAP_PARTS},
    sites AS (SELECT 'https://c' || o_custkey || '.example.com/' AS site, part FROM linked_parts)
    SELECT site || 'index-' || part || '.xml' AS sitemap_url,
           site || 'sitemap-' || part || '.xml' AS linked_url FROM sites
    UNION ALL
    SELECT site || 'part-' || part || '/robots.txt', site || 'index-' || part || '.xml'
    FROM sites"""
)
def sitemap_links(spark, sf_dir):
    return ops.sitemap_links(tb.sitemap_docs(spark, sf_dir))


@query(
    f"""WITH {sql.SITEMAP_PARTS}
    SELECT url, {DATE_TEXT}, {PAGE_TEXT}
    FROM order_sitemap JOIN linked_parts USING (o_custkey, part)"""
)
def sitemap_tree_pages(spark, sf_dir):
    docs = tb.sitemap_docs(spark, sf_dir)
    roots = docs.where("sitemap_url LIKE '%/robots.txt'")
    reached = ops.reachable_sitemaps(ops.sitemap_links(docs), roots)
    pages = ops.sitemap_entries(docs).join(reached, "sitemap_url", "left_semi")
    return _dated(ops.distinct_pages(pages))


@query(
    """SELECT 'https://c' || o_custkey || '.example.com' AS root, count(*) AS n_entries,
           count(*) AS n_pages, count(*) FILTER (o_orderdate >= DATE '1997-01-01') AS n_in_range
    FROM orders GROUP BY o_custkey"""
)
def sitemap_counts(spark, sf_dir):
    return ops.sitemap_counts(ops.sitemap_entries(tb.sitemap_docs(spark, sf_dir)), "1997-01-01")


@query(
    """WITH RECURSIVE links AS (
      SELECT o_orderkey, o_orderkey // 400 AS chain,
             lead(o_orderkey) OVER (PARTITION BY o_orderkey // 400 ORDER BY o_orderkey) AS next
      FROM orders),
    walk AS (
      SELECT min(o_orderkey) AS o_orderkey FROM links GROUP BY chain
      UNION
      SELECT next FROM walk JOIN links USING (o_orderkey)
      WHERE o_orderkey % 41 <> 0 AND next IS NOT NULL)
    SELECT 'sitemap-' || o_orderkey AS sitemap_url FROM walk"""
)
def sitemap_deep_tree(spark, sf_dir):
    chain = tb.sitemap_chain(spark, sf_dir)
    return ops.reachable_sitemaps(chain.where("linked_url IS NOT NULL"), chain.where("is_root"))


@query(
    """SELECT 'odd-' || o_orderkey || '.xml' AS sitemap_url,
           'https://odd.example.com/o?id=' || o_orderkey || '&x=1' AS url
    FROM orders WHERE o_orderkey % 6 <> 4"""
)
def sitemap_odd_entries(spark, sf_dir):
    docs = tb.odd_sitemaps(spark, sf_dir).withColumn("body", F.col("body").cast("binary"))
    return ops.sitemap_entries(docs).select("sitemap_url", "url")


@query(
    """SELECT 'odd-' || o_orderkey || '.xml' AS sitemap_url, reason, CAST(1 AS BIGINT) AS n
    FROM orders JOIN (VALUES (1, 'ends within the document'), (1, 'no address'), (4, 'no sitemap'))
        AS reasons(kind, reason) ON o_orderkey % 6 = kind"""
)
def sitemap_rejects(spark, sf_dir):
    return ops.sitemap_rejects(tb.odd_sitemaps(spark, sf_dir))


@query(
    """SELECT event_id AS line_no, CASE WHEN event_type = 'error' THEN 'fatal' ELSE 'ok' END AS class,
           CASE WHEN event_type = 'error' THEN 'user ' || user_id || ' ' || chr(65533) || chr(65533) END
             AS message
    FROM events"""
)
def crawl_fatal_damaged(spark, sf_dir):
    lines = ops.crawl_log_lines(tb.damaged_log(spark, sf_dir))
    return ops.crawl_fatal(lines).select("line_no", "class", "message")


def _shipments(spark, sf_dir):
    return tb.table(spark, sf_dir, "lineitem").select(
        tb.part_url("l_partkey").alias("url"),
        tb.utc("l_shipdate").alias("last_modified"),
    )


SHIPMENTS = """
    shipments AS (
      SELECT 'https://shop.example.com/part/' || l_partkey AS url,
             l_shipdate AS last_modified FROM lineitem)"""


@query(f"WITH {SHIPMENTS} SELECT DISTINCT url, {DATE_TEXT} FROM shipments")
def sitemap_distinct(spark, sf_dir):
    return _dated(ops.distinct_pages(_shipments(spark, sf_dir)))


@query(
    f"""WITH {SHIPMENTS}, latest AS (
      SELECT url, max(last_modified) AS last_modified FROM shipments GROUP BY url)
    SELECT url, {DATE_TEXT} FROM latest"""
)
def sitemap_distinct_urls(spark, sf_dir):
    return _dated(ops.distinct_pages(_shipments(spark, sf_dir), by="url"))


@query(
    f"""WITH {sql.ORDER_SITEMAP}
    SELECT url, {DATE_TEXT} FROM order_sitemap
    WHERE last_modified >= TIMESTAMP '1996-02-01' AND last_modified < TIMESTAMP '1998-03-01'"""
)
def sitemap_date_filter(spark, sf_dir):
    pages = tb.order_sitemap(spark, sf_dir).select("url", "last_modified")
    return _dated(ops.filter_by_date(pages, "1996-02-01", "March 1, 1998"))


@query(
    f"""WITH {sql.ORDER_SITEMAP}
    SELECT url, {DATE_TEXT} FROM order_sitemap
    WHERE last_modified >= TIMESTAMP '1997-01-01 00:00:00'
      AND last_modified < TIMESTAMP '1999-06-15'"""
)
def sitemap_date_override(spark, sf_dir):
    pages = tb.order_sitemap(spark, sf_dir).select("url", "last_modified")
    return _dated(
        ops.filter_by_date(
            pages,
            "1997-01-01T00:00:00+05:00",
            "",
            default_from="1990-01-01",
            default_to="1999-06-15",
        )
    )


# crawl logs

STATUS_COLUMNS = 'path, line_no, crawled, total, pending, failed, "limit"'


@query(f"WITH {sql.CRAWL_LOG} SELECT {STATUS_COLUMNS} FROM statuses")
def crawl_status(spark, sf_dir):
    return ops.crawl_status(tb.crawl_log(spark, sf_dir))


@query(
    f"""WITH {sql.CRAWL_LOG}
    SELECT {STATUS_COLUMNS}, entry_no FROM numbered WHERE entry_no % 100 = 0"""
)
def crawl_status_sample(spark, sf_dir):
    return ops.sample_statuses(ops.crawl_status(tb.crawl_log(spark, sf_dir)), block=1000)


@query(
    f"""WITH {sql.CRAWL_LOG}
    SELECT {STATUS_COLUMNS}, entry_no FROM numbered
    WHERE entry_no > entries - 3 AND entry_no > 100 * (entries // 100)"""
)
def crawl_status_tail(spark, sf_dir):
    return ops.last_statuses(ops.crawl_status(tb.crawl_log(spark, sf_dir)), block=1000)


@query(
    f"""WITH {sql.CRAWL_LOG}
    SELECT path, line_no,
           CASE WHEN event_type <> 'error' THEN 'ok'
                WHEN amount < 100 THEN 'unparsable'
                WHEN amount < 1000 THEN 'no_valid_seeds'
                ELSE 'fatal' END AS class,
           CASE WHEN event_type <> 'error' THEN NULL
                WHEN amount < 100
                  THEN '{{"logLevel":"fatal","context":"general","message":"cut'
                WHEN amount < 1000 THEN 'No valid seeds specified: ' || user_id
                ELSE 'user ' || user_id END AS message
    FROM log_parts WHERE event_type <> 'signup'"""
)
def crawl_fatal(spark, sf_dir):
    return ops.crawl_fatal(tb.crawl_log(spark, sf_dir))


FATAL_CLASS = """CASE WHEN amount < 100 THEN 'unparsable'
                WHEN amount < 1000 THEN 'no_valid_seeds' ELSE 'fatal' END"""


@query(
    f"""WITH {sql.CRAWL_LOG}
    SELECT path, line_no, class FROM (
      SELECT path, line_no, {FATAL_CLASS} AS class,
             row_number() OVER (PARTITION BY path ORDER BY line_no) AS rn
      FROM log_parts WHERE event_type = 'error')
    WHERE rn = 1"""
)
def crawl_first_fatal(spark, sf_dir):
    return ops.first_fatal(tb.crawl_log(spark, sf_dir)).select("path", "line_no", "class")


# real archives


@query(
    """SELECT 'log' AS kind,
       CAST(sum(length('{"context":"crawlStatus","details":{"crawled":' || page_id || '}}') + 1)
         AS BIGINT) AS n_bytes
    FROM pages"""
)
def wacz_members(spark, sf_dir):
    members = at.wacz_members(at.list_archives(spark, tb.archives(spark, sf_dir)))
    return (
        members.where("kind = 'log'").groupBy("kind").agg(F.sum("size").alias("n_bytes"))
    )


@query(f"WITH {sql.ARCHIVE_PAGES} SELECT * FROM listed")
def pages_scan(spark, sf_dir):
    pages = at.scan_pages(spark, tb.archives(spark, sf_dir))
    return pages.select("pages_file", "url", "title", "text")


@query(
    f"""WITH {sql.ARCHIVE_PAGES}
    SELECT url, mime, '200' AS status FROM archived WHERE mime = 'text/html'"""
)
def cdx_scan(spark, sf_dir):
    return at.scan_cdx(spark, tb.archives(spark, sf_dir)).select("url", "mime", "status")


def _all_captures(spark, sf_dir):
    lines = text_lines(at.list_archives(spark, tb.archives(spark, sf_dir)), "cdx")
    return ops.parse_cdx(lines)


@query(
    f"""WITH {sql.ARCHIVE_PAGES}
    SELECT url, mime, to_base64(encode(content)) AS content, n_headers FROM archived"""
)
def warc_fetch(spark, sf_dir):
    fetched = at.fetch_warc(_all_captures(spark, sf_dir))
    return fetched.select(
        "url", "mime", at.functions.base64_text("payload").alias("content"),
        F.size("headers").cast("bigint").alias("n_headers"),
    )


@query(f"WITH {sql.ARCHIVE_PAGES} SELECT url, content FROM archived")
def payload_decode(spark, sf_dir):
    fetched = at.fetch_warc(_all_captures(spark, sf_dir))
    return fetched.select("url", utf8_text("payload").alias("content"))


@query(
    f"""WITH {sql.ARCHIVE_PAGES}
    SELECT p.url, p.title, c.mime FROM listed p JOIN archived c USING (url)
    WHERE c.mime = 'text/html'"""
)
def archive_websites(spark, sf_dir):
    return at.html_websites(spark, tb.archives(spark, sf_dir)).select("url", "title", "mime")


@query(
    f"""WITH {sql.ARCHIVE_PAGES}, {sql.SEED_PAGES},
    wanted AS (SELECT url FROM page_base UNION SELECT url FROM doc_base
               UNION SELECT url FROM seed_pages),
    hits AS (
      SELECT p.url, count(*) AS n, max(c.content) AS content
      FROM listed p JOIN archived c USING (url) WHERE c.mime = 'text/html' GROUP BY p.url)
    SELECT url, coalesce(n, 0) AS match_count, CASE WHEN n = 1 THEN content END AS content
    FROM wanted LEFT JOIN hits USING (url)"""
)
def content_by_url(spark, sf_dir):
    wanted = (
        tb.archive_rows(spark, sf_dir)
        .select("url")
        .union(tb.seed_pages(spark, sf_dir).select("url"))
    )
    found = at.content_by_url(spark, tb.archives(spark, sf_dir), wanted)
    return found.select("url", "match_count", "content")


@query(
    f"""WITH {sql.ARCHIVE_PAGES}
    SELECT * FROM page_headers UNION ALL SELECT * FROM doc_headers"""
)
def response_headers(spark, sf_dir):
    records = at.generate_records(spark, tb.archives(spark, sf_dir))
    return ops.response_header_values(records, "url")


def _archive_lists(spark, sf_dir):
    """Previous URL list: all pages and documents; current: without http pages and src1."""
    previous = tb.archive_rows(spark, sf_dir).select("url")
    gone = F.col("url").startswith("http:") | F.col("url").contains("/src1/")
    return previous, previous.where(~gone)


@query(
    f"""WITH {sql.ARCHIVE_PAGES}, {sql.ARCHIVE_DELETES}
    SELECT url, 'active' AS status, title AS cdx_title,
           to_base64(encode(content)) AS html_base64
    FROM winners WHERE url NOT IN (SELECT url FROM gone)
    UNION ALL SELECT url, 'deleted', NULL, NULL FROM gone"""
)
def generate_records(spark, sf_dir):
    previous, current = _archive_lists(spark, sf_dir)
    records = at.generate_records(spark, tb.archives(spark, sf_dir), current, previous)
    return records.select("url", "status", "cdx_title", "html_base64")


@query(
    f"""WITH {sql.ARCHIVE_PAGES}
    SELECT 'info' AS level, page_id AS crawled FROM pages"""
)
def archive_crawl_log(spark, sf_dir):
    status = ops.crawl_status(at.scan_crawl_logs(spark, tb.archives(spark, sf_dir)))
    return status.select(F.lit("info").alias("level"), "crawled")


@query(
    f"""WITH {sql.SITEMAP_PARTS}
    SELECT url FROM order_sitemap JOIN linked_parts USING (o_custkey, part)
    WHERE last_modified >= TIMESTAMP '1997-01-01'"""
)
def harvest_seed_urls(spark, sf_dir):
    docs = tb.sitemap_docs(spark, sf_dir)
    tables = plans.harvest_tables(
        spark,
        lambda: tb.archives(spark, sf_dir),
        sitemap_docs=docs,
        roots=docs.where("sitemap_url LIKE '%/robots.txt'"),
        from_date="1997-01-01",
    )
    return tables.seed_urls


@query(
    f"""WITH {sql.ARCHIVE_PAGES}, {sql.SITEMAP_PARTS}, {PART_DELETES}
    SELECT url, 'active' AS status, title AS cdx_title FROM winners
    UNION ALL
    SELECT url, 'deleted', NULL FROM order_sitemap
    LEFT JOIN linked_parts l USING (o_custkey, part) WHERE l.part IS NULL"""
)
def harvest_records(spark, sf_dir):
    """Current list: orders reachable from the robots files; previous: all orders."""
    docs = tb.sitemap_docs(spark, sf_dir)
    tables = plans.harvest_tables(
        spark,
        tb.archives(spark, sf_dir),
        sitemap_docs=docs,
        roots=docs.where("sitemap_url LIKE '%/robots.txt'"),
        previous_urls=tb.order_sitemap(spark, sf_dir).select("url"),
    )
    return tables.records.select("url", "status", "cdx_title")


# looking up, unpacking and cutting archives


@query(
    f"""WITH {sql.ARCHIVE_PAGES}, supplier_urls AS (
      SELECT 'https://shop.example.com/supplier/' || s_suppkey AS url FROM supplier),
    wanted AS (SELECT url FROM page_base UNION SELECT url FROM supplier_urls),
    hits AS (
      SELECT p.url, count(*) AS n, max(c.content) AS content
      FROM listed p JOIN archived c USING (url) WHERE c.mime = 'text/html' GROUP BY p.url)
    SELECT url, coalesce(n, 0) AS match_count, CASE WHEN n = 1 THEN content END AS content
    FROM wanted LEFT JOIN hits USING (url)"""
)
def content_by_url_indexed(spark, sf_dir):
    """All pages, and suppliers that are in no archive; the blocks of documents stay unread."""
    wanted = tb.table(spark, sf_dir, "pages").select("url")
    suppliers = tb.table(spark, sf_dir, "supplier")
    wanted = wanted.union(suppliers.select(tb.text(f"{tb.SHOP}/supplier/", F.col("s_suppkey"))))
    found = at.content_by_url_indexed(spark, tb.archives(spark, sf_dir), wanted)
    return found.select("url", "match_count", "content")


@query(
    f"""WITH {sql.ARCHIVE_PAGES}
    SELECT url, status, cdx_title, html_base64 FROM (
      SELECT url, 'active' AS status, title AS cdx_title, to_base64(encode(content)) AS html_base64
      FROM winners)"""
)
def generate_records_packed(spark, sf_dir):
    """Archives whose WARC files are packed: each is unpacked once."""
    records = at.generate_records(spark, tb.archives(spark, sf_dir, plain=False))
    return records.select("url", "status", "cdx_title", "html_base64")


@query(
    f"""WITH {sql.ARCHIVE_PAGES}
    SELECT url, mime, '200' AS status, n_headers FROM archived"""
)
def cdx_scan_unlisted(spark, sf_dir):
    """Packed indexes without a list of their blocks, cut at the members that are found."""
    archives = at.list_archives(spark, tb.archives(spark, sf_dir, plain=False))
    captures = ops.parse_cdx(text_lines(archives, "cdx", split_bytes=20_000))
    fetched = at.fetch_warc(captures, staged=stage_packed(at.wacz_members(archives)))
    return fetched.select("url", "mime", "status", F.size("headers").cast("bigint").alias("n_headers"))


@query(
    f"""WITH {sql.ARCHIVE_PAGES}, {sql.ARCHIVE_DELETES}
    SELECT url, 'active' AS status, title AS cdx_title, to_base64(encode(content)) AS html_base64,
           TRUE AS in_order
    FROM winners WHERE url NOT IN (SELECT url FROM gone)
    UNION ALL SELECT url, 'deleted', NULL, NULL, TRUE FROM gone"""
)
def generate_records_ordered(spark, sf_dir):
    """Each record tells whether it comes behind the one before it in its partition."""
    previous, current = _archive_lists(spark, sf_dir)
    archives = tb.archives(spark, sf_dir)
    records = at.generate_records(spark, archives, current, previous, ordered=True)

    def compare(batches):
        last = -1
        for batch in batches:
            order = []
            for offset in batch.column("cdx_offset").to_pylist():
                number = float("inf") if offset is None else int(offset)
                order.append(number >= last)
                last = number
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in RECORD_FIELDS), pa.array(order)], [*RECORD_FIELDS, "in_order"]
            )

    fields = ", ".join(f"{name} string" for name in RECORD_FIELDS)
    return records.select(*RECORD_FIELDS, "cdx_offset").mapInArrow(compare, f"{fields}, in_order boolean")


RECORD_FIELDS = ["url", "status", "cdx_title", "html_base64"]


@query(
    """SELECT 'https://docs.example.org/' || doc_id AS url,
           CASE WHEN doc_id % 2 = 0 THEN 'sha256:' || n_chars END AS "recordDigest",
           CASE WHEN doc_id % 3 = 0 THEN CAST(n_chars AS BIGINT) END AS tries,
           CASE WHEN lang = 'en' THEN '["en",' || n_chars || ']' END AS odd,
           'OBJECT<`odd key.x`: ARRAY<VARIANT>, recordDigest: STRING, tries: VARIANT, url: STRING>' AS all_keys
    FROM documents"""
)
def cdx_extra_fields(spark, sf_dir):
    """The keys of all index lines, and those beyond the usual ones as typed columns."""
    captures = ops.parse_cdx(tb.rich_index_lines(spark, sf_dir), keep_raw=True)
    fields = {"recordDigest": "string", "tries": "bigint", "odd key.x": "string"}
    return ops.cdx_fields(captures, fields).select(
        "url", "recordDigest", "tries", F.col("`odd key.x`").alias("odd"),
        F.lit(ops.cdx_schema(captures)).alias("all_keys"),
    )


# sitemaps of a site on other hosts

CDN_PAGES = """
    sites AS (SELECT DISTINCT doc_id // 8 AS site_no FROM documents),
    root_pages AS (
      SELECT 'https://c' || (doc_id // 8) || '.example.com' AS root,
             'https://cdn' || (doc_id // 8 % 7) || '.example.net/pages-' || (doc_id // 8) || '.xml' AS sitemap_url,
             'https://c' || (doc_id // 8) || '.example.com/o/' || doc_id AS url
      FROM documents WHERE doc_id // 8 % 5 <> 0
      UNION ALL
      SELECT 'https://c' || site_no || '.example.com',
             'https://cdn' || (site_no % 7) || '.example.net/shared.xml',
             'https://s' || s_suppkey || '.example.org/'
      FROM sites JOIN supplier ON s_suppkey % 7 = site_no % 7 WHERE site_no % 5 <> 0
      UNION ALL
      SELECT 'https://c' || site_no || '.example.com', 'https://c' || site_no || '.example.com/extra.xml',
             'https://c' || site_no || '.example.com/extra'
      FROM sites)"""


@query(f"WITH {CDN_PAGES} SELECT * FROM root_pages")
def sitemap_pages_per_root(spark, sf_dir):
    pages = ops.pages_per_root(tb.cdn_sitemaps(spark, sf_dir), tb.known_sitemaps(spark, sf_dir))
    return pages.select("root", "sitemap_url", "url")


@query(
    f"""WITH {CDN_PAGES}
    SELECT root, count(DISTINCT sitemap_url) AS n_sitemaps, count(*) AS n_entries,
           count(DISTINCT url) AS n_pages
    FROM root_pages GROUP BY root"""
)
def sitemap_root_counts(spark, sf_dir):
    return ops.counts_per_root(tb.cdn_sitemaps(spark, sf_dir), tb.known_sitemaps(spark, sf_dir))


@query(
    """SELECT 'whole' AS list, 'https://docs.example.org/' || doc_id AS url, 'deleted' AS status,
           CAST(0 AS BIGINT) AS n_problems
    FROM documents WHERE source = 'src1'
    UNION ALL SELECT 'damaged', NULL, NULL, 1"""
)
def deleted_urls_damaged_list(spark, sf_dir):
    """Deletions by a packed previous list, and by one of whose files the end is lost: none."""
    lines = tb.document_urls(spark, sf_dir)
    current = lines.where("source <> 'src1'").select(strip("value").alias("url"))
    found = []
    for name in ("whole", "damaged"):
        path = tb.packed_list(lines, f"previous-{name}", damaged=name == "damaged")
        gone = ops.deleted_urls(read_previous_url_list(spark, path), current)
        label, no = F.lit(name).alias("list"), F.lit(None).cast("string")
        found.append(gone.select(label, "url", "status", F.lit(0).cast("bigint").alias("n_problems")))
        problems = url_list_problems(spark, path).agg(F.count("*").alias("n_problems"))
        problems = problems.where("n_problems > 0")
        found.append(problems.select(label, no.alias("url"), no.alias("status"), "n_problems"))
    return reduce(DataFrame.unionByName, found)
