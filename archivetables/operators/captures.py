"""Page lists, capture index, and their join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivetables import schemas
from archivetables.functions import (
    cdx_json,
    ends_with_any,
    keep_last_rank,
    offset_number,
    utf8_text,
    with_json_object,
    with_key_hash,
)

# fixed values: what the crawl's own page list and index are filtered by
SITEMAP_SUFFIXES = ["sitemap.html", "sitemap.xml"]
HTML_MIME = "text/html"

KEYS = ["wacz_path", "url"]
HASHED_KEYS = ["key_hash", *KEYS]
CDX_FIELDS = ["url", "mime", "status", "digest", "length", "offset", "filename"]


def parse_pages(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Page rows from the lines of page lists; lines that hold no JSON object are left out,
    or raise when ``strict``.

    The first line of every list is its header and is skipped, whatever it holds. ``raw``
    keeps the whole object as VARIANT, for the fields beyond the declared ones.
    """
    rows = with_json_object(_page_lines(lines), "text", schemas.PAGE_JSON, "page")
    if strict:
        place = F.concat_ws(" ", F.lit("malformed page line:"), "wacz_path", "member", "line_pos")
        rows = rows.withColumn("page", F.coalesce("page", F.raise_error(place)))
    return rows.where("page IS NOT NULL").select(
        "wacz_path",
        F.col("member").alias("pages_file"),
        "page.*",
        F.try_parse_json("text").alias("raw"),
        "line_pos",
    )


def page_rejects(lines: DataFrame) -> DataFrame:
    """Lines of page lists that are no JSON object."""
    rows = with_json_object(_page_lines(lines), "text", schemas.PAGE_JSON, "page")
    return rows.where("page IS NULL").select("wacz_path", "member", "line_pos", "text")


def _page_lines(lines: DataFrame) -> DataFrame:
    text = utf8_text("line", strict=False)
    first = (F.col("split_start") == 0) & (F.col("line_pos") == 0)
    rows = lines.where(~first).select("wacz_path", "member", "line_pos", text.alias("text"))
    return rows.where(~F.col("text").rlike(r"^\s*$") | F.col("text").isNull())


def without_sitemap_pages(
    pages: DataFrame, suffixes: list[str] = SITEMAP_SUFFIXES
) -> DataFrame:
    """Drop pages whose URL ends like a sitemap; rows without a URL go too."""
    return pages.where(~ends_with_any("url", suffixes))


def union_page_lists(*lists: DataFrame) -> DataFrame:
    """All rows of all lists, by column name; columns a list lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lists)


def _cdx_lines(lines: DataFrame) -> DataFrame:
    text = utf8_text("line", strict=False)
    rows = lines.select(
        "wacz_path",
        F.col("member").alias("cdx_file"),
        "line",
        text.isNull().alias("not_text"),
        cdx_json(text).alias("json"),
    )
    return with_json_object(rows, "json", schemas.CDX_JSON, "cdx")


def parse_cdx(lines: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Capture rows from index lines; lines that hold no JSON object, or an empty one, are
    left out.

    The numbers of the index are text and stay text; ``offset_num`` is the offset as a
    number, null where it is none. With ``keep_raw``, column ``raw`` keeps the whole object as VARIANT,
    and a line counts that has any key, as ``cdx_fields`` and ``cdx_schema`` need it.
    """
    rows = _cdx_lines(lines)
    columns = ["wacz_path", "cdx_file", "cdx.*", offset_number("cdx.offset").alias("offset_num")]
    if not keep_raw:
        return rows.select(*columns).dropna("all", subset=CDX_FIELDS)
    rows = rows.where("cdx IS NOT NULL").where(~F.col("json").rlike(r"^\s*\{\s*\}\s*$"))
    return rows.select(*columns, F.try_parse_json("json").alias("raw"))


def cdx_schema(captures: DataFrame) -> str:
    """The union of all keys of all index lines, with the type that fits the values of each, as a schema
    text; ``captures`` with ``raw``."""
    return captures.agg(F.schema_of_variant_agg("raw").alias("schema")).first().schema


def cdx_fields(captures: DataFrame, fields: dict[str, str]) -> DataFrame:
    """``captures`` (with ``raw``) and further keys of their index lines as columns: for each key its type.
    A line without the key, or with a value that is not of the type, has a null there. A key must not hold
    both kinds of quotes."""
    paths = {key: f"$['{key}']" if '"' in key else f'$["{key}"]' for key in fields}
    columns = {
        key: F.try_variant_get("raw", paths[key], kind).alias(key) for key, kind in fields.items()
    }
    return captures.withColumns(columns)


def cdx_rejects(lines: DataFrame) -> DataFrame:
    """Index lines without a well-formed JSON object, with the reason."""
    reason = (
        F.when(F.col("not_text"), "not UTF-8")
        .when(F.col("json").isNull(), "no JSON part")
        .otherwise("malformed JSON")
    )
    return (
        _cdx_lines(lines)
        .where("cdx IS NULL")
        .select("wacz_path", "cdx_file", "line", reason.alias("reason"))
    )


def html_captures(cdx: DataFrame, mime: str = HTML_MIME) -> DataFrame:
    """Captures of exactly this media type; the HTTP status does not matter."""
    return cdx.where(F.col("mime") == mime)


def join_captures(pages: DataFrame, cdx: DataFrame, keep_uncaptured: bool = False) -> DataFrame:
    """Every page with every capture of its URL.

    Pages without a capture that names a WARC file are dropped, unless ``keep_uncaptured``. The result
    multiplies by nature; a frequent URL needs adaptive skew join, which the session builder sets.
    """
    how = "left" if keep_uncaptured else "inner"
    captured = cdx if keep_uncaptured else cdx.where("filename IS NOT NULL")
    left, right = with_key_hash(pages, *KEYS), with_key_hash(captured, *KEYS)
    return left.join(right, HASHED_KEYS, how).drop("key_hash")


def _last_page(pages: DataFrame, *extra: Column) -> DataFrame:
    """One row per URL: the title of its last row, extra pages after seed pages."""
    last = F.struct(F.col("pages_file").like("%extraPages%"), "line_pos", "title")
    rows = with_key_hash(pages, *KEYS).groupBy(*HASHED_KEYS)
    return rows.agg(F.max(last)["title"].alias("title"), *extra)


def _last_capture(cdx: DataFrame, offset_order: str, *extra: Column) -> DataFrame:
    """One row per URL: the pointer of its last capture, read off the sort key itself."""
    rank = keep_last_rank("offset", "filename", "length", order=offset_order)
    rows = with_key_hash(cdx.where("filename IS NOT NULL"), *KEYS).groupBy(*HASHED_KEYS)
    last = F.col("last")
    return rows.agg(F.max(rank).alias("last"), *extra).select(
        "*",
        last["tie_0"].alias("filename"),
        last["text"].alias("offset"),
        last["tie_1"].alias("length"),
        offset_number(last["text"]).alias("offset_num"),
    ).drop("last")


def record_pointers(
    pages: DataFrame,
    cdx: DataFrame,
    offset_order: str = "numeric",
    excluded: DataFrame | None = None,
) -> DataFrame:
    """One pointer per page URL, to its last capture: what joining all captures and then
    keeping the last offset gives.

    Each side is cut to one row per URL before the join, partly before the shuffle, so
    a URL that holds a third of all captures or page rows costs one row per task and the
    join never multiplies. Both sides and the join share one partitioning; so do
    ``excluded`` rows of archive and URL, while ``excluded`` URLs without an archive hold
    for all of them and take a shuffle by URL.

    No side is broadcast. Spark takes lines to be as small as the splits that they are read from; once it
    has planned to broadcast them, it keeps to that where a merge join takes one more shuffle, however many
    rows have come by then.
    """
    captures = _last_capture(cdx, offset_order).hint("merge")
    pointers = _last_page(pages).join(captures, HASHED_KEYS)
    if excluded is not None and "wacz_path" in excluded.columns:
        keys = with_key_hash(excluded.select(*KEYS), *KEYS)
        pointers = pointers.join(keys.hint("merge"), HASHED_KEYS, "left_anti")
    elif excluded is not None:
        pointers = pointers.join(excluded.select("url").hint("merge"), "url", "left_anti")
    return pointers.select(*KEYS, "title", "filename", "offset", "length", "offset_num")


def match_urls(
    wanted: DataFrame, pages: DataFrame, cdx: DataFrame, offset_order: str = "numeric"
) -> DataFrame:
    """Look up URLs: a row per wanted URL and archive that has it, with ``match_count``,
    the number of (page, capture) pairs. A URL found nowhere has one row and count 0.

    Only a count of 1 is an unambiguous hit.
    """
    wanted = wanted.select("url").distinct()
    count = F.count(F.lit(1))
    # Cut to a row per URL before they meet the list, so that no URL is too frequent. Spark filters
    # first where the list is small enough to broadcast.
    found_pages = _last_page(pages, count.alias("n_pages")).join(wanted, "url", "left_semi")
    found_cdx = _last_capture(cdx, offset_order, count.alias("n_captures"))
    found_cdx = found_cdx.join(wanted, "url", "left_semi")
    hits = found_pages.join(found_cdx, HASHED_KEYS).withColumn(
        "match_count", F.col("n_pages") * F.col("n_captures")
    )
    return (
        wanted.join(hits.drop("n_pages", "n_captures", "key_hash"), "url", "left")
        .withColumn("match_count", F.coalesce("match_count", F.lit(0)))
    )
