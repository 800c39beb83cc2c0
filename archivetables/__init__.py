"""Web-crawl archives as Spark tables."""

from archivetables.plans import (
    content_by_url,
    content_by_url_indexed,
    generate_records,
    harvest_tables,
    html_websites,
    records_from_tables,
    scan_cdx,
    scan_crawl_logs,
    scan_pages,
    write_harvest,
)
from archivetables.session import build_session, ship_package
from archivetables.sinks import write_records
from archivetables.sources import fetch_warc, list_archives, wacz_members

__all__ = [
    "build_session",
    "content_by_url",
    "content_by_url_indexed",
    "fetch_warc",
    "generate_records",
    "harvest_tables",
    "html_websites",
    "list_archives",
    "records_from_tables",
    "scan_cdx",
    "scan_crawl_logs",
    "scan_pages",
    "ship_package",
    "wacz_members",
    "write_harvest",
    "write_records",
]
