"""Errors and counts as data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivetables.functions import with_key_hash
from archivetables.operators.captures import HASHED_KEYS, KEYS


def archive_gaps(members: DataFrame) -> DataFrame:
    """What archives lack by their directories alone: rows ``wacz_path, problem``."""
    has = {kind: F.coalesce(F.bool_or(F.col("kind") == kind), F.lit(False)) for kind in ("pages", "cdx")}
    problem = (
        F.when(F.count("member") == 0, "unreadable archive")
        .when(~has["pages"], "no page list")
        .when(~has["cdx"], "no index")
    )
    return members.groupBy("wacz_path").agg(problem.alias("problem")).where("problem IS NOT NULL")


def archive_problems(
    archives: DataFrame, members: DataFrame, pages: DataFrame, cdx_lines: DataFrame
) -> DataFrame:
    """What archives lack: rows ``wacz_path, problem``; complete archives have none.

    ``pages`` are the rows of the page lists before any filter, ``cdx_lines`` the raw
    index lines.
    """
    unreadable = members.where("member IS NULL").select("wacz_path")
    readable = archives.select(F.col("path").alias("wacz_path")).join(
        unreadable, "wacz_path", "left_anti"
    )

    def lacking(rows: DataFrame, problem: str) -> DataFrame:
        found = rows.select("wacz_path").distinct()
        lacks = readable.join(found, "wacz_path", "left_anti")
        return lacks.withColumn("problem", F.lit(problem))

    return (
        unreadable.withColumn("problem", F.lit("unreadable archive"))
        .union(lacking(pages, "no page rows"))
        .union(lacking(cdx_lines, "no index lines"))
    )


def pipeline_counts(
    pages: DataFrame, cdx: DataFrame, deletes: DataFrame | None = None
) -> DataFrame:
    """Rows ``stage, n_rows``: pages, captures, joined rows, pages with a record, deletes.

    All follow from the rows per URL, so each table is read once and no rows are joined.
    """
    one = F.lit(1)
    per_page = with_key_hash(pages, *KEYS).groupBy(*HASHED_KEYS).agg(F.count(one).alias("n_pages"))
    per_capture = (
        with_key_hash(cdx, *KEYS)
        .groupBy(*HASHED_KEYS)
        .agg(F.count(one).alias("n_captures"), F.count("filename").alias("n_pointers"))
    )
    joined = F.col("n_pages") * F.col("n_pointers")
    stages = {
        "pages": F.sum("n_pages"),
        "captures": F.sum("n_captures"),
        "joined": F.sum(joined),
        "records": F.count_if(joined > 0),
    }
    totals = per_page.join(per_capture, HASHED_KEYS, "full").agg(
        *(F.coalesce(n, F.lit(0)).alias(stage) for stage, n in stages.items())
    )
    counts = totals.unpivot([], list(stages), "stage", "n_rows")
    if deletes is not None:
        counts = counts.union(deletes.agg(F.count(one)).select(F.lit("deletes"), "*"))
    return counts
