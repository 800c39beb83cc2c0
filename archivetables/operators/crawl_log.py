"""Crawl logs: JSON lines as ``path, line_no, line``.

``line_no`` may be any number that grows along the log, such as a byte position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from archivetables.functions import strip

# fixed values: the marks of log lines, and the status fields that are kept
STATUS_MARK = '"context":"crawlStatus"'
FATAL_MARK = '"logLevel":"fatal"'
NO_SEEDS_TEXT = "No valid seeds specified"
STATUS_COUNTS = ["crawled", "total", "pending", "failed"]

SAMPLE_STEP = 100
TAIL = 3
NUMBERING_BLOCK = 1 << 20


def crawl_log_lines(lines: DataFrame) -> DataFrame:
    """Log lines of archive members, one log per archive and member. Bytes that are no UTF-8 become
    U+FFFD, so that a damaged line still shows its marks."""
    path = F.concat_ws("!/", "wacz_path", "member")
    return lines.select(
        path.alias("path"),
        F.col("line_pos").alias("line_no"),
        F.make_valid_utf8(F.col("line").cast("string")).alias("line"),
    )


def _stripped(log: DataFrame) -> DataFrame:
    return log.select("path", "line_no", strip("line").alias("line")).where("line <> ''")


def crawl_status(log: DataFrame) -> DataFrame:
    """Status lines and their counts; lines that are no JSON object are skipped."""
    entry = (
        _stripped(log)
        .where(F.col("line").contains(STATUS_MARK))
        .select("path", "line_no", F.try_parse_json("line").alias("entry"))
        .where(F.schema_of_variant("entry").startswith("OBJECT"))
    )
    return entry.select(
        "path",
        "line_no",
        *(
            F.try_variant_get("entry", f"$.details.{name}", "bigint").alias(name)
            for name in STATUS_COUNTS
        ),
        F.to_json(F.try_variant_get("entry", "$.details.limit", "variant")).alias("limit"),
    )


def _numbered(status: DataFrame, block: int) -> DataFrame:
    """Position of each status line in its log (``entry_no``) and entries in all
    (``entries``).

    Counted per block of line numbers first, so that a log of any length is numbered by
    many tasks: the lines before a block come from a running sum over block counts.
    """
    blocks = status.withColumn("block", F.floor(F.col("line_no") / F.lit(block)))
    in_order = Window.partitionBy("path").orderBy("block")
    counts = blocks.groupBy("path", "block").agg(F.count("*").alias("in_block"))
    offsets = counts.select(
        "path",
        "block",
        (F.sum("in_block").over(in_order) - F.col("in_block")).alias("before"),
        F.sum("in_block").over(Window.partitionBy("path")).alias("entries"),
    )
    in_block = Window.partitionBy("path", "block").orderBy("line_no")
    return (
        blocks.withColumn("rank", F.row_number().over(in_block))
        .join(offsets, ["path", "block"])
        .withColumn("entry_no", F.col("before") + F.col("rank"))
        .drop("block", "rank", "before")
    )


def sample_statuses(
    status: DataFrame, step: int = SAMPLE_STEP, block: int = NUMBERING_BLOCK
) -> DataFrame:
    """Each ``step``-th status entry of every log."""
    sampled = _numbered(status, block).where(F.col("entry_no") % step == 0)
    return sampled.drop("entries")


def last_statuses(
    status: DataFrame,
    step: int = SAMPLE_STEP,
    tail: int = TAIL,
    block: int = NUMBERING_BLOCK,
) -> DataFrame:
    """The last entries of every log since its last sampled one, ``tail`` at most."""
    entry_no, entries = F.col("entry_no"), F.col("entries")
    since_sample = entry_no > entries - entries % step
    rows = _numbered(status, block).where(since_sample & (entry_no > entries - tail))
    return rows.drop("entries")


def crawl_fatal(log: DataFrame) -> DataFrame:
    """Lines with their class: ``ok``, ``no_valid_seeds``, ``fatal`` or ``unparsable``,
    and, for all but ``ok``, the message."""
    rows = _stripped(log)
    is_fatal = F.col("line").contains(FATAL_MARK)
    entry = F.when(is_fatal, F.try_parse_json("line"))
    rows = rows.select("path", "line_no", "line", is_fatal.alias("is_fatal"), entry.alias("entry"))
    message = F.try_variant_get("entry", "$.message", "string")
    kind = (
        F.when(~F.col("is_fatal"), "ok")
        .when(F.col("entry").isNull(), "unparsable")
        .when(message.contains(NO_SEEDS_TEXT), "no_valid_seeds")
        .otherwise("fatal")
    )
    return rows.select(
        "path",
        "line_no",
        kind.alias("class"),
        F.when(F.col("is_fatal"), F.coalesce(message, "line")).alias("message"),
    )


class CrawlFailedError(RuntimeError):
    """The crawl ended on a fatal log line."""


class NoValidSeedsError(CrawlFailedError):
    """The crawl had nothing to start from."""


def first_fatal(log: DataFrame) -> DataFrame:
    """The fatal line each log ended on, the first one, with its class and message."""
    lines = crawl_fatal(log).where(F.col("class") != "ok")
    first = F.min(F.struct("line_no", "class", "message"))
    return lines.groupBy("path").agg(first.alias("first")).select("path", "first.*")


def raise_if_fatal(log: DataFrame) -> None:
    """Raise if a log has a fatal line: ``NoValidSeedsError`` if it was for want of seeds
    in all such logs, ``CrawlFailedError`` otherwise."""
    by_class = first_fatal(log).groupBy("class").agg(
        F.count("*").alias("logs"), F.min(F.struct("path", "message")).alias("example")
    )
    found = {r["class"]: f"{r.logs} logs, {r.example.path}: {r.example.message}"
             for r in by_class.collect()}
    if set(found) == {"no_valid_seeds"}:
        raise NoValidSeedsError(found["no_valid_seeds"])
    if found:
        raise CrawlFailedError("; ".join(f"{kind}: {text}" for kind, text in sorted(found.items())))
