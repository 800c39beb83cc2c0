from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# every character Python calls white space; the last one is U+3000
WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

OFFSET_ORDERS = ("numeric", "lexicographic")


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(text: Column | str) -> Column:
    """Cut white space of any kind from both ends."""
    return F.btrim(_column(text), F.lit(WHITE_SPACE))


def base64_text(data: Column | str) -> Column:
    """Base64 on one line, whatever ``spark.sql.chunkBase64String.enabled`` says."""
    return F.replace(F.base64(_column(data)), F.lit("\r\n"), F.lit(""))


def utf8_text(data: Column | str, strict: bool = True) -> Column:
    """Bytes as text. Bad bytes raise, or give null when not ``strict``."""
    text = _column(data).cast("string")
    return F.validate_utf8(text) if strict else F.try_validate_utf8(text)


def ends_with_any(text: Column | str, suffixes: Sequence[str]) -> Column:
    tests = [_column(text).endswith(suffix) for suffix in suffixes]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def offset_number(offset: Column | str) -> Column:
    return _column(offset).try_cast("bigint")


def json_object(text: Column | str, fields: str) -> Column:
    """A struct of ``fields`` from text that is one JSON object and nothing else.

    The JSON reader stops after the first value, so ``{...} junk`` would pass. Read as the
    only element of an array it does not, and gives null like any other malformed text.
    The lambda names the parsed array, so the text is parsed once.
    """
    wrapped = F.concat(F.lit("["), _column(text), F.lit("]"))
    parsed = F.from_json(wrapped, f"array<struct<{fields}>>", {"allowSingleQuotes": "false"})
    only = F.transform(F.array(parsed), lambda v: F.when(F.size(v) == 1, F.get(v, F.lit(0))))
    return F.get(only, F.lit(0))


def with_json_object(df: DataFrame, text: Column | str, fields: str, name: str) -> DataFrame:
    """Add ``json_object`` as column ``name``.

    It is added through a generator of one row: filters on the parsed fields stay above it,
    where as a plain projection every such filter would parse the text again.
    """
    return df.select("*", F.explode(F.array(json_object(text, fields))).alias(name))


def cdx_json(line: Column | str) -> Column:
    """The JSON part of an index line ``<key> <timestamp> <json>``, null when missing.

    A line from a visible ASCII character to a brace has no white space to cut, which
    spares most lines the costlier test.
    """
    text = _column(line)
    visible = F.ascii(text).between(33, 126) & text.endswith("}")
    text = F.when(visible, text).otherwise(strip(text))
    return F.get(F.split(text, " ", 3), F.lit(2))


def header_map(headers: Column | str) -> Column:
    """Header pairs as name → values; names keep their case and first-seen order."""
    pairs = _column(headers)
    names = F.array_distinct(F.transform(pairs, lambda h: h["name"]))
    return F.map_from_entries(
        F.transform(
            names,
            lambda name: F.struct(
                name.alias("key"),
                F.transform(
                    F.filter(pairs, lambda h: h["name"] == name), lambda h: h["value"]
                ).alias("value"),
            ),
        )
    )


def keep_last_rank(
    offset: Column | str,
    *tie_breaks: Column | str,
    order: str = "numeric",
    nulls_last: bool = True,
) -> Column:
    """Sort key of "the capture with the last offset".

    Offsets are text. ``numeric`` compares them as numbers, ``lexicographic`` as text. A
    null offset (a vanished page) comes last and so wins, unless ``nulls_last`` is false.
    """
    if order not in OFFSET_ORDERS:
        raise ValueError(f"offset order must be one of {OFFSET_ORDERS}: {order!r}")
    value = _column(offset)
    null_key = value.isNull() if nulls_last else value.isNotNull()
    keys = [null_key.alias("null_key")]
    if order == "numeric":
        keys.append(offset_number(value).alias("number"))
    keys.append(value.cast("string").alias("text"))
    keys += [_column(c).alias(f"tie_{i}") for i, c in enumerate(tie_breaks)]
    return F.struct(*keys)


def with_key_hash(df: DataFrame, *keys: str) -> DataFrame:
    """Add ``key_hash``, to lead the keys of joins and groupings that sort.

    Archive paths and URLs begin alike by the million; sorted by them alone, almost every
    comparison walks through the common beginning. A leading number settles it at once.
    """
    return df.withColumn("key_hash", F.xxhash64(*keys))


# pieces of a URL: scheme, authority, path
URL_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"


def _url(url: Column | str) -> Column:
    return F.regexp_replace(_column(url), r"^[\x00-\x20]+|[\t\r\n]", "")


def site_root(url: Column | str) -> Column:
    """``scheme://authority``; the scheme in lower case, the authority as written."""
    clean = _url(url)
    return F.concat(
        F.lower(F.regexp_extract(clean, URL_PARTS, 1)),
        F.lit("://"),
        F.regexp_extract(clean, URL_PARTS, 2),
    )


def site_path(url: Column | str) -> Column:
    """Path without query, fragment, and the last segment's ``;parameters``."""
    path = F.regexp_extract(_url(url), URL_PARTS, 3)
    return F.regexp_replace(path, r";[^/]*$", "")


# dates as people write them, besides the forms of the standard
DATE_FORMS = ["MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "yyyy/M/d", "yyyyMMdd"]


def w3c_timestamp(text: Column | str) -> Column:
    """A sitemap date (year, month, day or time precision) as a timestamp.

    Dates without a zone are UTC, whatever the session's zone. Some written-out forms are read too,
    month names in English. Unreadable text gives null.
    """
    words = F.initcap(strip(text))
    days = [F.date_format(F.try_to_timestamp(words, F.lit(f)), "yyyy-MM-dd") for f in DATE_FORMS]
    written_out = F.concat(F.coalesce(*days), F.lit("T00:00:00Z"))
    value = F.upper(strip(text))
    value = F.regexp_replace(value, r"T(\d{2}:\d{2})(?=$|[Z+-])", "T$1:00")
    value = F.regexp_replace(value, r"(T.*[+-]\d{2})(\d{2})$", "$1:$2")
    full = (
        F.when(value.rlike(r"^\d{4}$"), F.concat(value, F.lit("-01-01T00:00:00Z")))
        .when(value.rlike(r"^\d{4}-\d{2}$"), F.concat(value, F.lit("-01T00:00:00Z")))
        .when(value.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(value, F.lit("T00:00:00Z")))
        .when(value.rlike(r"(Z|[+-]\d{2}:\d{2})$"), value)
        .otherwise(F.concat(value, F.lit("Z")))
    )
    return F.coalesce(full.try_cast("timestamp"), written_out.try_cast("timestamp"))
