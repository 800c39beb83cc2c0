"""Readers: archive listings, text members, WARC records, URL lists."""

from archivetables.sources.archives import (
    archive_bytes,
    list_archives,
    member_lines,
    text_lines,
    wacz_members,
)
from archivetables.sources.index_lookup import lookup_lines
from archivetables.sources.staging import stage_packed
from archivetables.sources.snapshots import read_snapshot, urls_gone, write_snapshot
from archivetables.sources.url_lists import (
    read_previous_url_list,
    read_url_list,
    save_url_snapshot,
    scan_url_list,
    url_list_problems,
    write_url_list,
)
from archivetables.sources.warc import ArchiveReadError, fetch_warc

__all__ = [
    "ArchiveReadError",
    "archive_bytes",
    "fetch_warc",
    "list_archives",
    "lookup_lines",
    "member_lines",
    "read_previous_url_list",
    "read_snapshot",
    "read_url_list",
    "save_url_snapshot",
    "scan_url_list",
    "stage_packed",
    "text_lines",
    "url_list_problems",
    "urls_gone",
    "wacz_members",
    "write_snapshot",
    "write_url_list",
]
