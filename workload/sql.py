"""The derived tables of ``tables.py`` in SQL, as named subqueries."""

SEED_PAGES = """
seed_pages AS (
  SELECT 'https://shop.example.com/part/' || p_partkey AS url, p_name AS title,
         p_partkey AS line_pos, FALSE AS extra
  FROM part)"""

EXTRA_PAGES = """
extra_pages AS (
  SELECT 'https://shop.example.com/part/' || s_suppkey AS url, s_name AS title,
         s_suppkey AS line_pos, TRUE AS extra, CAST(s_nationkey AS VARCHAR) AS text
  FROM supplier
  UNION ALL
  SELECT 'https://shop.example.com/customer/' || c_custkey, c_name, c_custkey, TRUE,
         c_mktsegment
  FROM customer)"""

SHOP_PAGES = f"""{SEED_PAGES}, {EXTRA_PAGES},
shop_pages AS (
  SELECT url, title, line_pos, extra FROM seed_pages
  UNION ALL SELECT url, title, line_pos, extra FROM extra_pages)"""

CAPTURES = """
captures AS (
  SELECT 'https://shop.example.com/part/' || l_partkey AS url,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'application/json'
              WHEN l_returnflag = 'R' THEN 'text/html; charset=utf-8'
              ELSE 'text/html' END AS mime,
         CASE WHEN l_linestatus = 'F' THEN '404' ELSE '200' END AS status,
         'order:' || l_orderkey AS digest,
         CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS length,
         CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS "offset",
         'rec-' || l_suppkey || '-' || l_linenumber || '.warc.gz' AS filename,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS offset_num,
         strftime(l_shipdate, '%Y%m%d%H%M%S') AS captured,
         CAST(round(l_tax * 100) AS INTEGER) AS tax,
         CAST(round(l_discount * 100) AS INTEGER) AS discount
  FROM lineitem),
html_captures AS (SELECT * FROM captures WHERE mime = 'text/html')"""

INDEX_LINES = f"""{CAPTURES},
line_parts AS (
  SELECT *,
         'com,example,shop)' || replace(url, 'https://shop.example.com', '') || ' '
           || captured AS head,
         '{{"url": "' || url || '", "mime": "' || mime || '", "status": "' || status
           || '", "digest": "' || digest || '", "length": "' || length
           || '", "offset": "' || "offset" || '", "filename": "' || filename || '"' AS json,
         CASE WHEN tax = 0 AND discount = 0 THEN 'malformed JSON'
              WHEN tax = 8 AND discount = 10 THEN 'no JSON part'
              WHEN tax = 4 AND discount = 5 THEN 'empty'
              ELSE 'good' END AS state
  FROM captures)"""


def last_capture(numeric: bool, source: str = "html_captures") -> str:
    number = "offset_num DESC, " if numeric else ""
    return f"""
last_capture AS (
  SELECT url, filename, "offset", length, offset_num FROM (
    SELECT *, row_number() OVER (
      PARTITION BY url ORDER BY {number}"offset" DESC, filename DESC, length DESC) AS rn
    FROM {source}) WHERE rn = 1)"""


LAST_PAGE = """
last_page AS (
  SELECT url, title FROM (
    SELECT *, row_number() OVER (
      PARTITION BY url ORDER BY extra DESC, line_pos DESC, title DESC) AS rn
    FROM shop_pages) WHERE rn = 1)"""

ORDER_SITEMAP = """
order_sitemap AS (
  SELECT 'https://c' || o_custkey || '.example.com/o/' || o_orderkey AS url,
         o_orderdate AS last_modified, o_custkey, o_orderkey, o_orderstatus,
         o_orderkey // 1000 AS part
  FROM orders)"""

SITEMAP_PARTS = f"""{ORDER_SITEMAP},
linked_parts AS (
  SELECT DISTINCT o_custkey, part FROM order_sitemap WHERE o_orderstatus <> 'F')"""

PREVIOUS_URLS = """
previous_lines AS (
  SELECT 'https://shop.example.com/order/' || o_orderkey AS url, o_orderpriority
  FROM orders),
previous_urls AS (
  SELECT url FROM previous_lines
  UNION ALL SELECT url FROM previous_lines WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT '' FROM nation)"""

CURRENT_URLS = """
current_urls AS (
  SELECT 'https://shop.example.com/order/' || o_orderkey AS url
  FROM orders WHERE o_orderstatus <> 'F')"""

CRAWL_LOG = """
log_parts AS (
  SELECT 'crawl-' || strftime(ts, '%Y-%m') AS path, event_id AS line_no, event_type,
         user_id, CAST(round(value * 100) AS BIGINT) AS amount,
         json_extract_string(props, '$.k') AS k
  FROM events),
statuses AS (
  SELECT path, line_no, amount AS crawled, user_id AS total, CAST(k AS BIGINT) AS pending,
         line_no AS failed,
         '{"hit":false,"max":' || k || '}' AS "limit"
  FROM log_parts WHERE event_type = 'view' AND amount >= 100),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY path ORDER BY line_no) AS entry_no,
         count(*) OVER (PARTITION BY path) AS entries
  FROM statuses)"""

# the packed archives: one row per URL and, for captures, per capture
ARCHIVE_PAGES = r"""
page_base AS (
  SELECT page_id, url, html, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
         contains(url, '?') AS has_query, contains(url, '#') AS has_fragment
  FROM pages),
doc_base AS (
  SELECT 'https://docs.example.org/' || source || '/' || doc_id
           || CASE WHEN source = 'src0' THEN '/sitemap.xml' ELSE '' END AS url,
         lang || ' ' || doc_id AS title, text, lang, '<pre>' || text || '</pre>' AS content
  FROM documents),
listed AS (
  SELECT 'pages/pages.jsonl' AS pages_file, url, title, CAST(NULL AS VARCHAR) AS text
  FROM page_base
  UNION ALL
  SELECT 'pages/extraPages.jsonl', url, 'again ' || title, url FROM page_base WHERE has_query
  UNION ALL
  SELECT 'pages/extraPages.jsonl', url, title, text FROM doc_base
  WHERE NOT ends_with(url, 'sitemap.xml')),
archived AS (
  SELECT url, 'text/html' AS mime, 'stale ' || url AS content, 1 AS n_headers
  FROM page_base WHERE NOT has_fragment
  UNION ALL
  SELECT url, 'text/html', html, 6 FROM page_base WHERE NOT has_fragment
  UNION ALL
  SELECT url, 'application/json', '{}', 1 FROM page_base WHERE has_query AND NOT has_fragment
  UNION ALL
  SELECT url, 'text/html', content, 3 FROM doc_base),
winners AS (
  SELECT url, CASE WHEN has_query THEN 'again ' || title ELSE title END AS title,
         html AS content
  FROM page_base WHERE NOT has_fragment
  UNION ALL
  SELECT url, title, content FROM doc_base WHERE NOT ends_with(url, 'sitemap.xml')),
page_headers AS (
  SELECT url, h.name, h.position, h.value FROM (
    SELECT url, unnest([
      {'name': 'Content-Type', 'position': 0, 'value': 'text/html'},
      {'name': 'Set-Cookie', 'position': 0, 'value': 'page=' || page_id},
      {'name': 'content-encoding', 'position': 0,
       'value': CASE WHEN url LIKE 'https:%' THEN 'gzip' ELSE 'identity' END},
      {'name': 'Set-Cookie', 'position': 1, 'value': url},
      {'name': 'Transfer-Encoding', 'position': 0, 'value': 'chunked'},
      {'name': 'set-cookie', 'position': 0, 'value': 'lower'}]) AS h
    FROM page_base WHERE NOT has_fragment)),
doc_headers AS (
  SELECT url, h.name, h.position, h.value FROM (
    SELECT url, unnest([
      {'name': 'Content-Type', 'position': 0, 'value': 'text/html'},
      {'name': 'X-Lang', 'position': 0, 'value': lang},
      {'name': 'Content-Encoding', 'position': 0, 'value': 'deflate'}]) AS h
    FROM doc_base WHERE NOT ends_with(url, 'sitemap.xml')))"""

# pages whose scheme is http left the sitemap, and so did every captured document of src1
ARCHIVE_DELETES = """
gone AS (
  SELECT url FROM page_base WHERE url LIKE 'http:%'
  UNION SELECT url FROM doc_base WHERE url LIKE '%/src1/%')"""
