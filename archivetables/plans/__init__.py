"""Whole jobs over archives, composed of sources and operators."""

from archivetables.plans.archive_tables import (
    html_websites,
    scan_cdx,
    scan_cdx_rejects,
    scan_crawl_logs,
    scan_pages,
    scan_problems,
)
from archivetables.plans.generate import (
    content_by_url,
    content_by_url_indexed,
    generate_records,
    records_from_tables,
)
from archivetables.plans.harvest import HarvestTables, harvest_tables, write_harvest

__all__ = [
    "HarvestTables",
    "content_by_url",
    "content_by_url_indexed",
    "generate_records",
    "harvest_tables",
    "html_websites",
    "records_from_tables",
    "scan_cdx",
    "scan_cdx_rejects",
    "scan_crawl_logs",
    "scan_pages",
    "scan_problems",
    "write_harvest",
]
