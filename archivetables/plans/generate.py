"""Archives to records, and URL to content."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from archivetables.functions import keep_last_rank, utf8_text
from archivetables.operators.captures import (
    KEYS,
    html_captures,
    match_urls,
    parse_cdx,
    record_pointers,
)
from archivetables.operators.records import (
    RECORD_COLUMNS,
    active_records,
    append_deletes,
    deleted_urls,
)
from archivetables.plans.archive_tables import (
    ARCHIVE_BYTES_PER_LINES_TASK,
    Paths,
    listed,
    scan_cdx,
    scan_pages,
)
from archivetables.operators.quality import archive_gaps
from archivetables.session import partitions_for, stored
from archivetables.sources.archives import archive_bytes, wacz_members
from archivetables.sources.index_lookup import lookup_lines
from archivetables.sources.sort_keys import is_plain
from archivetables.sources.staging import stage_packed
from archivetables.sources.url_lists import read_previous_url_list, read_url_list
from archivetables.sources.warc import fetch_warc

UrlList = DataFrame | str | None

MAX_LOOKUP = 100_000  # URLs that go to all tasks: some MB


class ArchiveProblemError(RuntimeError):
    """An archive lacks what records are made of."""


class UrlLookupError(LookupError, FileNotFoundError):
    """A URL is in no archive, or is there more than once."""


def records_from_tables(
    pages: DataFrame,
    cdx: DataFrame,
    deletes: DataFrame | None = None,
    *,
    offset_order: str = "numeric",
    prefer: str = "deleted",
    strict: bool = True,
    keep_crawl: bool = False,
    n_bytes: int = 0,
    members: DataFrame | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Records from page rows, HTML captures and, if any, deleted URLs.

    Duplicates are settled on the pointers, so that only captures which become records are
    read, and payloads never pass a shuffle. Offsets order captures within an archive
    only, so the unit of deduplication is (archive, URL). Deletes without ``wacz_path``
    hold for the URL in every archive. ``n_bytes`` is the size of the archives, if known. With the
    ``members`` of the archives, WARC files that are packed there are unpacked once beforehand, if a
    pointer names them. ``ordered`` records are sorted by offset, deleted ones last; they are read in that
    order, and not moved.
    """
    if prefer not in ("deleted", "active"):
        raise ValueError(f"prefer must be 'deleted' or 'active': {prefer!r}")
    excluded = deletes if prefer == "deleted" else None
    pointers = record_pointers(pages, cdx, offset_order, excluded)
    if deletes is not None and prefer == "active":
        keys = [c for c in KEYS if c in deletes.columns]
        deletes = deletes.join(pointers.select(*keys), keys, "left_anti")
    staged = None
    if members is not None:
        pointers = stored(pointers, "pointers")
        staged = stage_packed(members, pointers)
    kept = ["wacz_path", *([] if strict else ["payload_problem"])]
    if ordered:
        rows = pointers.withColumn("status", F.lit("active"))
        if deletes is not None:
            rows = rows.unionByName(deletes, allowMissingColumns=True)
        rank = keep_last_rank("offset", "filename", "url", order=offset_order)
        fetched = fetch_warc(rows, strict, n_bytes, staged=staged, order=rank)
        records = active_records(fetched, *kept, status=F.col("status"))
    else:
        records = active_records(fetch_warc(pointers, strict, n_bytes, staged=staged), *kept)
        if deletes is not None:
            records = append_deletes(records, deletes)
    return records if keep_crawl else records.drop("wacz_path")


def _has_packed(members: DataFrame) -> bool:
    return not members.where("kind = 'warc' AND NOT stored").isEmpty()


def _url_list(spark: SparkSession, urls: DataFrame | str, previous: bool = False) -> DataFrame:
    if isinstance(urls, DataFrame):
        return urls
    return read_previous_url_list(spark, urls) if previous else read_url_list(spark, urls)


def generate_records(
    spark: SparkSession,
    wacz_paths: Paths,
    current_urls: UrlList = None,
    previous_urls: UrlList = None,
    *,
    offset_order: str = "numeric",
    prefer: str = "deleted",
    ordered: bool = False,
    strict: bool = True,
    check_archives: bool | None = None,
    keep_crawl: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """One record per page of the archives, and one per URL that vanished.

    The URL lists are DataFrames with ``url`` or paths of text files. Vanished URLs need
    both. ``check_archives`` reads the archives' directories beforehand and raises for archives that
    are unreadable or lack page lists or an index; it goes with ``strict`` unless given. ``observation`` receives the counts ``records`` and
    ``deleted`` when the result is computed.

    ``ordered`` sorts the pointers and reads the records in that order. WARC files that are packed within
    their archives are unpacked beforehand, by one task each, into the shared folder.
    """
    archives = listed(spark, wacz_paths)
    members = stored(wacz_members(archives, strict=False), "members")
    if strict if check_archives is None else check_archives:
        gaps = archive_gaps(members).groupBy("problem")
        gaps = gaps.agg(F.count("*").alias("n"), F.min("wacz_path").alias("example")).collect()
        if gaps:  # a row per kind of problem
            raise ArchiveProblemError(
                "; ".join(f"{r.problem}: {r.n} archives, such as {r.example}" for r in sorted(gaps))
            )
    deletes = None
    if current_urls is not None and previous_urls is not None:
        deletes = deleted_urls(
            _url_list(spark, previous_urls, previous=True), _url_list(spark, current_urls)
        )
    size = archive_bytes(archives)
    records = records_from_tables(
        scan_pages(spark, archives, strict, size),
        scan_cdx(spark, archives, strict, size),
        deletes,
        offset_order=offset_order,
        prefer=prefer,
        strict=strict,
        keep_crawl=keep_crawl,
        n_bytes=size,
        members=members if _has_packed(members) else None,
        ordered=ordered,
    )
    if observation is not None:
        records = records.observe(
            observation,
            F.count(F.lit(1)).alias("records"),
            F.count_if(F.col("status") == "deleted").alias("deleted"),
        )
    first = ["wacz_path"] if keep_crawl else []
    last = [] if strict else ["payload_problem"]
    return records.select(*first, *RECORD_COLUMNS, *last)


def content_by_url(
    spark: SparkSession,
    wacz_paths: Paths,
    urls: DataFrame | Iterable[str],
    decode: bool = True,
    strict: bool = False,
) -> DataFrame:
    """Content of pages by URL: ``url, wacz_path, match_count, content``.

    The content is there where the URL has exactly one match in the archive. ``strict``
    makes any other count an error when the row is computed.
    """
    if isinstance(urls, DataFrame):
        wanted = urls
    else:
        wanted = spark.createDataFrame([(u,) for u in urls], "url string")
    archives = listed(spark, wacz_paths)
    size = archive_bytes(archives)
    found = match_urls(
        wanted,
        scan_pages(spark, archives, n_bytes=size),
        scan_cdx(spark, archives, n_bytes=size),
    )
    return _single_contents(found, size, decode, strict)


def _single_contents(found: DataFrame, n_bytes: int, decode: bool, strict: bool) -> DataFrame:
    is_single = F.col("match_count") == 1
    if strict:
        message = F.concat_ws(" ", F.lit("URL has not one match but"), "match_count", "url")
        is_single = F.coalesce(F.nullif(is_single, F.lit(False)), F.raise_error(message))
    pointers = found.withColumn("filename", F.when(is_single, F.col("filename")))
    payload = F.col("payload")
    content = utf8_text(payload) if decode else payload
    fetched = fetch_warc(pointers, n_bytes=n_bytes)
    return fetched.select("url", "wacz_path", "match_count", content.alias("content"))


def content_by_url_indexed(
    spark: SparkSession,
    wacz_paths: Paths,
    urls: DataFrame | Iterable[str],
    decode: bool = True,
    strict: bool = False,
    max_urls: int = MAX_LOOKUP,
) -> DataFrame:
    """``content_by_url`` for a few URLs of many archives.

    The order of the indexes leads to the blocks that can hold the URLs, and page lists are read only in
    archives that have a capture of one. URLs that index writers may have rewritten, and lists of more than
    ``max_urls``, are looked for in whole indexes.
    """
    if not isinstance(urls, DataFrame):
        urls = spark.createDataFrame([(u,) for u in urls], "url string")
    wanted = urls.select("url").distinct()
    few = [r.url for r in wanted.limit(max_urls + 1).collect()]
    if len(few) > max_urls:
        return content_by_url(spark, wacz_paths, wanted, decode, strict)
    plain = [u for u in few if u is not None and is_plain(u)]
    other = [u for u in few if u is None or not is_plain(u)]
    archives = listed(spark, wacz_paths)
    size = archive_bytes(archives)
    n = partitions_for(spark, size, ARCHIVE_BYTES_PER_LINES_TASK)
    wanted = spark.createDataFrame([(u,) for u in plain], "url string")
    captures = html_captures(parse_cdx(lookup_lines(archives, plain, partitions=n)))
    captures = stored(captures.join(wanted, "url", "left_semi"), "looked-up")
    having = captures.select(F.col("wacz_path").alias("path")).distinct()
    pages = scan_pages(spark, archives.join(having, "path", "left_semi"), n_bytes=size)
    found = _single_contents(match_urls(wanted, pages, captures), size, decode, strict)
    if not other:
        return found
    rest = spark.createDataFrame([(u,) for u in other], "url string")
    return found.unionByName(content_by_url(spark, archives, rest, decode, strict))
