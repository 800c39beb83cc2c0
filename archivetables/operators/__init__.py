"""Relational steps over the archive tables, each from DataFrame to DataFrame."""

from archivetables.operators.captures import (
    cdx_fields,
    cdx_rejects,
    cdx_schema,
    html_captures,
    join_captures,
    match_urls,
    page_rejects,
    parse_cdx,
    parse_pages,
    record_pointers,
    union_page_lists,
    without_sitemap_pages,
)
from archivetables.operators.crawl_log import (
    CrawlFailedError,
    NoValidSeedsError,
    crawl_fatal,
    crawl_log_lines,
    crawl_status,
    first_fatal,
    last_statuses,
    raise_if_fatal,
    sample_statuses,
)
from archivetables.operators.quality import archive_gaps, archive_problems, pipeline_counts
from archivetables.operators.records import (
    active_records,
    append_deletes,
    deleted_urls,
    drop_duplicate_urls,
    drop_duplicate_urls_window,
    order_by_offset,
    response_header_values,
)
from archivetables.operators.sitemaps import (
    counts_per_root,
    date_bound,
    distinct_pages,
    filter_by_date,
    pages_per_root,
    reachable_sitemaps,
    reached_from,
    root_counts,
    sitemap_counts,
    sitemap_entries,
    sitemap_links,
    sitemap_rejects,
    sitemap_roots,
    sitemap_starts,
)

__all__ = [
    "CrawlFailedError",
    "NoValidSeedsError",
    "active_records",
    "append_deletes",
    "archive_gaps",
    "archive_problems",
    "cdx_fields",
    "cdx_rejects",
    "cdx_schema",
    "counts_per_root",
    "crawl_fatal",
    "crawl_log_lines",
    "crawl_status",
    "date_bound",
    "deleted_urls",
    "distinct_pages",
    "drop_duplicate_urls",
    "drop_duplicate_urls_window",
    "filter_by_date",
    "first_fatal",
    "html_captures",
    "join_captures",
    "last_statuses",
    "match_urls",
    "order_by_offset",
    "page_rejects",
    "pages_per_root",
    "parse_cdx",
    "parse_pages",
    "pipeline_counts",
    "raise_if_fatal",
    "reachable_sitemaps",
    "reached_from",
    "record_pointers",
    "response_header_values",
    "sample_statuses",
    "root_counts",
    "sample_statuses",
    "sitemap_counts",
    "sitemap_entries",
    "sitemap_links",
    "sitemap_rejects",
    "sitemap_roots",
    "sitemap_starts",
    "union_page_lists",
    "without_sitemap_pages",
]
