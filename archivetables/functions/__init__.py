"""Column functions. All of them are compositions of built-in Spark expressions."""

from archivetables.functions.columns import (
    base64_text,
    cdx_json,
    ends_with_any,
    header_map,
    json_object,
    keep_last_rank,
    offset_number,
    site_path,
    site_root,
    strip,
    utf8_text,
    w3c_timestamp,
    with_json_object,
    with_key_hash,
)

__all__ = [
    "base64_text",
    "cdx_json",
    "ends_with_any",
    "header_map",
    "json_object",
    "keep_last_rank",
    "offset_number",
    "site_path",
    "site_root",
    "strip",
    "utf8_text",
    "w3c_timestamp",
    "with_json_object",
    "with_key_hash",
]
