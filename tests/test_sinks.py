import csv
import json
import xml.etree.ElementTree as ET
from pathlib import Path

import pytest

from archivetables import schemas, sinks


def text_of(path):
    parts = sorted(p for p in Path(path).iterdir() if p.name.startswith("part-"))
    return "".join(p.read_bytes().decode("utf-8") for p in parts)


ROWS = [
    ("http://a/?x=1&y=<2>", "active", "f.warc.gz", ' quo"ted, \ttitle\nsecond ', "10", "5", "QQ==",
     {"Set-Cookie": ["a", "b"]}),
    ("http://b", "deleted", None, None, None, None, None, None),
    ("http://c", "active", "f", "", "1", "2", "", {}),
]


@pytest.fixture
def records(spark):
    return spark.createDataFrame(ROWS, schemas.RECORD).coalesce(1)


NAMES = schemas.RECORD.fieldNames()


def test_jsonl_keeps_nulls(records, tmp_path):
    sinks.write_records(records, str(tmp_path / "r.jsonl"))
    got = [json.loads(line) for line in text_of(tmp_path / "r.jsonl").splitlines()]
    assert got == [dict(zip(NAMES, row, strict=True)) for row in ROWS]


def test_xml(records, tmp_path):
    sinks.write_records(records, str(tmp_path / "r.XML "))
    root = ET.fromstring(text_of(tmp_path / "r.XML "))
    assert root.tag == "records" and {r.tag for r in root} == {"record"}
    first, second, third = root
    assert [c.tag for c in second] == NAMES
    assert [c.text for c in second] == ["http://b", "deleted"] + ["None"] * 6
    assert first.findtext("url") == ROWS[0][0] and first.findtext("cdx_title") == ROWS[0][3]
    assert json.loads(first.findtext("response_headers")) == {"Set-Cookie": ["a", "b"]}
    assert third.findtext("cdx_title") == ""


@pytest.mark.parametrize(("fmt", "sep"), [("csv", ","), ("tsv", "\t")])
def test_cells(records, tmp_path, fmt, sep):
    sinks.write_records(records, str(tmp_path / f"r.{fmt}"))
    text = text_of(tmp_path / f"r.{fmt}")
    got = list(csv.reader(text.splitlines(keepends=True), delimiter=sep))
    cells = [["" if v is None else json.dumps(v, separators=(",", ":")) if isinstance(v, dict) else v
              for v in row] for row in ROWS]
    assert got == [NAMES, *cells]
    assert '""ted' in text


def test_unknown_format_runs_nothing(records, tmp_path):
    for error in (ValueError, NotImplementedError):
        with pytest.raises(error, match="badformat"):
            sinks.write_records(records, str(tmp_path / "r.badformat"))
    assert not list(tmp_path.iterdir())


def test_format_of_path():
    assert [sinks.record_format(p) for p in ("a.b.CSV ", "s3://x/y.jsonl", "xml")] == ["csv", "jsonl", "xml"]
