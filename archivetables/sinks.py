"""Record writers. Every format is a folder of part files, written in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class UnknownRecordFormat(ValueError, NotImplementedError):
    """No writer for this file format."""


def record_format(path: str) -> str:
    """The format a path asks for: what follows its last dot, in lower case."""
    return path.rsplit(".", 1)[-1].strip().lower()


def _flat(records: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for formats that have cells only."""
    nested = (T.MapType, T.ArrayType, T.StructType)
    return records.select(
        *(
            F.to_json(field.name).alias(field.name)
            if isinstance(field.dataType, nested)
            else F.col(field.name)
            for field in records.schema
        )
    )


def write_jsonl(records: DataFrame, path: str, mode: str = "error") -> None:
    """One object per row, nulls written as ``null``."""
    records.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_xml(records: DataFrame, path: str, mode: str = "error") -> None:
    """``<records><record>...``; every column is present, null cells read ``None``."""
    options = {"rootTag": "records", "rowTag": "record", "nullValue": "None", "declaration": ""}
    _flat(records).write.mode(mode).options(**options).format("xml").save(path)


def write_csv(records: DataFrame, path: str, mode: str = "error", sep: str = ",") -> None:
    """Header line, quotes doubled within quotes, white space kept, null cells empty."""
    options = {
        "header": "true",
        "sep": sep,
        "escape": '"',
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    _flat(records).write.mode(mode).options(**options).csv(path)


def write_tsv(records: DataFrame, path: str, mode: str = "error") -> None:
    write_csv(records, path, mode, sep="\t")


WRITERS = {"jsonl": write_jsonl, "xml": write_xml, "csv": write_csv, "tsv": write_tsv}


def write_records(
    records: DataFrame, path: str, fmt: str | None = None, mode: str = "error"
) -> None:
    """Write in the format ``path`` ends with, or in ``fmt``.

    An unknown format raises before anything runs.
    """
    name = fmt or record_format(path)
    if name not in WRITERS:
        raise UnknownRecordFormat(f"no writer for record format {name!r}")
    WRITERS[name](records, path, mode)
