"""Declared schemas. Nothing in the library infers a schema from data."""

from pyspark.sql import types as T

MEMBER = "wacz_path string, member string, size bigint, stored boolean"

LINE = "wacz_path string, member string, split_start bigint, line_pos bigint, line binary"

PAGE_JSON = "url string, title string, text string"

CDX_JSON = (
    "url string, mime string, status string, digest string, length string, "
    "offset string, filename string"
)

HEADERS = "array<struct<name:string,value:string>>"

FEED_XML = (
    "channel struct<item array<struct<link:string>>>, "
    "entry array<struct<link:array<struct<_href:string,_rel:string>>>>"
)

URL_LIST = "url string"

RECORD = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("cdx_warc_filename", T.StringType()),
        T.StructField("cdx_title", T.StringType()),
        T.StructField("cdx_offset", T.StringType()),
        T.StructField("cdx_length", T.StringType()),
        T.StructField("html_base64", T.StringType()),
        T.StructField(
            "response_headers", T.MapType(T.StringType(), T.ArrayType(T.StringType()))
        ),
    ]
)
