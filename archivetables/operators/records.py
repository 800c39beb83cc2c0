"""Crawl records: projection, deletions, one record per URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivetables import schemas
from archivetables.functions import base64_text, header_map, keep_last_rank, with_key_hash

# what decides between equal offsets
TIES = ("cdx_warc_filename", "cdx_length")


def active_records(fetched: DataFrame, *keep: str, status: Column | None = None) -> DataFrame:
    """Records of fetched captures, in the fixed columns, after the columns to ``keep``; of ``status``
    ``active`` unless another is given."""
    return fetched.select(
        *keep,
        "url",
        (F.lit("active") if status is None else status).alias("status"),
        F.col("filename").alias("cdx_warc_filename"),
        F.col("title").alias("cdx_title"),
        F.col("offset").alias("cdx_offset"),
        F.col("length").alias("cdx_length"),
        base64_text("payload").alias("html_base64"),
        header_map("headers").alias("response_headers"),
    )


def response_header_values(records: DataFrame, *keys: str) -> DataFrame:
    """Response headers as rows ``name, position, value``."""
    names = records.select(*keys, F.explode("response_headers").alias("name", "values"))
    return names.select(*keys, "name", F.posexplode("values").alias("position", "value"))


def deleted_urls(previous: DataFrame, current: DataFrame) -> DataFrame:
    """URLs of the previous list that the current one lacks, as ``deleted`` records.

    Both lists may carry ``wacz_path``; they are then compared crawl by crawl. Each list is
    made distinct before they meet, which both shuffles them once and takes repeated lines
    out before the shuffle.
    """
    keys = [c for c in ("wacz_path", "url") if c in previous.columns and c in current.columns]
    before = with_key_hash(previous.select(*keys).where("url <> ''"), *keys).distinct()
    now = with_key_hash(current.select(*keys), *keys).distinct()
    gone = before.join(now, ["key_hash", *keys], "left_anti")
    return gone.select(*keys, F.lit("deleted").alias("status"))


def append_deletes(active: DataFrame, deletes: DataFrame) -> DataFrame:
    """Active and deleted records; what a deleted record lacks is null."""
    return active.unionByName(deletes, allowMissingColumns=True)


def _rank(records: DataFrame, offset: str, order: str, prefer: str, tie_breaks: tuple[str, ...]):
    tie_breaks = tuple(c for c in tie_breaks if c in records.columns)
    if prefer not in ("deleted", "active"):
        raise ValueError(f"prefer must be 'deleted' or 'active': {prefer!r}")
    return keep_last_rank(
        offset, *tie_breaks, order=order, nulls_last=prefer == "deleted"
    )


def drop_duplicate_urls(
    records: DataFrame,
    keys: tuple[str, ...] = ("url",),
    offset: str = "cdx_offset",
    offset_order: str = "numeric",
    prefer: str = "deleted",
    tie_breaks: tuple[str, ...] = TIES,
) -> DataFrame:
    """Keep, per URL, the record with the last offset.

    A record without an offset, which is a deleted one, comes last and so wins, unless
    ``prefer="active"``. Equal offsets fall to the greater of ``tie_breaks``, as far as the records have
    those columns. Null URLs count as equal. Aggregated partly before the shuffle,
    so no URL is too frequent.
    """
    rank = _rank(records, offset, offset_order, prefer, tie_breaks)
    row = F.struct(*records.columns)
    groups = with_key_hash(records, *keys).groupBy("key_hash", *keys)
    last = groups.agg(F.max_by(row, rank).alias("last"))
    return last.select(*(F.col("last")[c].alias(c) for c in records.columns))


def drop_duplicate_urls_window(
    records: DataFrame,
    keys: tuple[str, ...] = ("url",),
    offset: str = "cdx_offset",
    offset_order: str = "numeric",
    prefer: str = "deleted",
    tie_breaks: tuple[str, ...] = TIES,
) -> DataFrame:
    """``drop_duplicate_urls`` as a ranking. The filter on the first row lets Spark drop
    all but one row per key before the shuffle as well."""
    rank = _rank(records, offset, offset_order, prefer, tie_breaks)
    window = Window.partitionBy("key_hash", *keys).orderBy(rank.desc())
    return (
        with_key_hash(records, *keys)
        .withColumn("row_number", F.row_number().over(window))
        .where("row_number = 1")
        .drop("row_number", "key_hash")
    )


def order_by_offset(records: DataFrame, offset_order: str = "numeric") -> DataFrame:
    """Sort by offset, records without one last.

    File and URL follow in the sort key, so that one frequent offset (or all the deleted
    records) still spreads over the sorted partitions.
    """
    rank = keep_last_rank("cdx_offset", "cdx_warc_filename", "url", order=offset_order)
    return records.orderBy(rank.asc())


RECORD_COLUMNS = schemas.RECORD.fieldNames()
