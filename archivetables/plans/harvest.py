"""The part of a harvest that follows the crawl: sitemaps and archives to URL lists and
records."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from archivetables.operators.sitemaps import (
    distinct_pages,
    filter_by_date,
    reachable_sitemaps,
    sitemap_entries,
    sitemap_links,
)
from archivetables.plans.archive_tables import Paths
from archivetables.plans.generate import UrlList, generate_records
from archivetables.sinks import write_records
from archivetables.sources.url_lists import save_url_snapshot


class HarvestTables:
    """``seed_urls`` is limited by date, for the crawler; ``all_urls`` is not, for the
    comparison with the previous and the next run. Both are null without sitemaps. Each table is planned,
    and the sitemap tree walked, when it is first asked for."""

    def __init__(
        self,
        pages: Callable[[], DataFrame] | None,
        seeds: Callable[[DataFrame], DataFrame],
        records: Callable[[DataFrame | None], DataFrame],
    ) -> None:
        self._plan_pages, self._plan_seeds, self._plan_records = pages, seeds, records

    @cached_property
    def _pages(self) -> DataFrame | None:
        return self._plan_pages() if self._plan_pages else None

    @cached_property
    def seed_urls(self) -> DataFrame | None:
        return None if self._pages is None else self._plan_seeds(self._pages).select("url")

    @cached_property
    def all_urls(self) -> DataFrame | None:
        return None if self._pages is None else self._pages.select("url")

    @cached_property
    def records(self) -> DataFrame:
        return self._plan_records(self.all_urls)


def harvest_tables(
    spark: SparkSession,
    wacz_paths: Paths | Callable[[], Paths],
    sitemap_docs: DataFrame | None = None,
    previous_urls: UrlList = None,
    roots: DataFrame | None = None,
    from_date: str | None = None,
    to_date: str | None = None,
    **record_options,
) -> HarvestTables:
    """URL lists from sitemap documents and records from archives.

    With ``roots`` only documents reachable from them count; the tree is walked by Spark jobs, and
    bodies are cut to their entries before anything is joined. Vanished URLs are those the
    previous list has and the unfiltered current one lacks: with the date-limited list
    every unmodified page would count as vanished. Without sitemaps there is no current
    list, hence nothing vanished. Archives given as a function are asked for with the first records.
    """

    def pages() -> DataFrame:
        entries = sitemap_entries(sitemap_docs)
        if roots is not None:
            reached = reachable_sitemaps(sitemap_links(sitemap_docs), roots)
            entries = entries.join(reached, "sitemap_url", "left_semi")
        return distinct_pages(entries)

    return HarvestTables(
        pages if sitemap_docs is not None else None,
        lambda found: filter_by_date(found, from_date, to_date),
        lambda urls: generate_records(spark, wacz_paths() if callable(wacz_paths) else wacz_paths, urls, previous_urls, **record_options),
    )


def write_harvest(
    tables: HarvestTables,
    records_path: str | None = None,
    urls_path: str | None = None,
    mode: str = "error",
) -> None:
    """Write the records and the URL snapshot, whichever has a path; one must."""
    if not records_path and not urls_path:
        raise ValueError("nothing to write: give a path for the records or the URL snapshot")
    if records_path:
        write_records(tables.records, records_path, mode=mode)
    if urls_path:
        save_url_snapshot(tables.all_urls, urls_path, mode)
