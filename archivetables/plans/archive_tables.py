"""The tables of a set of archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from archivetables.operators.captures import (
    cdx_rejects,
    html_captures,
    join_captures,
    parse_cdx,
    parse_pages,
    without_sitemap_pages,
)
from archivetables.operators.crawl_log import crawl_log_lines
from archivetables.operators.quality import archive_problems
from archivetables.session import partitions_for
from archivetables.sources.archives import (
    archive_bytes,
    list_archives,
    text_lines,
    wacz_members,
)

Paths = str | list[str] | DataFrame


# page lists and indexes are a small part of an archive, so many archives go to one task
ARCHIVE_BYTES_PER_LINES_TASK = 16 << 30


def listed(spark: SparkSession, wacz_paths: Paths) -> DataFrame:
    """The archives as a listing; paths and globs are listed, a listing is taken as it is."""
    if isinstance(wacz_paths, DataFrame):
        return wacz_paths
    return list_archives(spark, wacz_paths)


def archive_lines(
    spark: SparkSession, wacz_paths: Paths, kind: str, strict: bool, n_bytes: int | None
) -> DataFrame:
    """Lines of one kind, read by a number of tasks that fits the size of the archives."""
    archives = listed(spark, wacz_paths)
    n_bytes = archive_bytes(archives) if n_bytes is None else n_bytes
    n = partitions_for(spark, n_bytes, ARCHIVE_BYTES_PER_LINES_TASK)
    return text_lines(archives, kind, strict, partitions=n)


def scan_pages(
    spark: SparkSession, wacz_paths: Paths, strict: bool = True, n_bytes: int | None = None
) -> DataFrame:
    """All rows of both page lists of every archive, but for sitemap pages.

    Malformed lines raise; when not ``strict`` they are left out. ``n_bytes`` is the size of
    all archives, where the caller knows it already.
    """
    lines = archive_lines(spark, wacz_paths, "pages", strict, n_bytes)
    return without_sitemap_pages(parse_pages(lines, strict))


def scan_cdx(
    spark: SparkSession, wacz_paths: Paths, strict: bool = True, n_bytes: int | None = None
) -> DataFrame:
    """HTML captures of every index, packed or plain, of every archive."""
    return html_captures(parse_cdx(archive_lines(spark, wacz_paths, "cdx", strict, n_bytes)))


def scan_cdx_rejects(spark: SparkSession, wacz_paths: Paths) -> DataFrame:
    return cdx_rejects(archive_lines(spark, wacz_paths, "cdx", True, None))


def scan_crawl_logs(spark: SparkSession, wacz_paths: Paths) -> DataFrame:
    return crawl_log_lines(archive_lines(spark, wacz_paths, "log", True, None))


def html_websites(spark: SparkSession, wacz_paths: Paths) -> DataFrame:
    """Every page with every HTML capture of it."""
    archives = listed(spark, wacz_paths)
    size = archive_bytes(archives)
    return join_captures(
        scan_pages(spark, archives, n_bytes=size), scan_cdx(spark, archives, n_bytes=size)
    )


def scan_problems(spark: SparkSession, wacz_paths: Paths) -> DataFrame:
    """Archives that cannot be read, or hold no page rows or no index lines."""
    archives = listed(spark, wacz_paths)
    size = archive_bytes(archives)
    return archive_problems(
        archives,
        wacz_members(archives, strict=False),
        parse_pages(archive_lines(spark, archives, "pages", False, size)),
        archive_lines(spark, archives, "cdx", False, size),
    )
