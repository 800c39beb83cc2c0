import pytest
from pyspark.sql import types as T

from tests.conftest import spark  # noqa: F401

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        # names that operators use themselves, or that differ from theirs by case
        *[T.StructField(name, T.StringType()) for name in ("_row", "TEXT", "chunk", "copies", "size")],
    ]
)


@pytest.fixture(scope="session")
def make(spark):  # noqa: F811
    """A table of documents with extra columns from ``(doc_id, text[, source])``."""

    def table(rows):
        return spark.createDataFrame(
            [(*r, *(["src"] if len(r) == 2 else []), "x", "y", None, "1", "z") for r in rows], SCHEMA
        )

    return table


ODD = [
    (1, None),
    (2, ""),
    (3, " \t\r\n\x0b\x0c "),
    (4, "word"),
    (5, "one two three four five six seven eight nine ten\n" * 3),
    (5, "one two three four five six seven eight nine ten\n" * 3),
    (None, "the quick brown fox jumps over the lazy dog near the river bank today, they said."),
    (None, None),
    (7, "the quick brown fox jumps over the lazy dog near the river bank today, they said."),
    (8, " ".join(f"w{i % 977}x{i // 977}" for i in range(60_000))),
    (9, "é" * 3000 + " ß\x00  中文 a@b.co +1 (988) 555-2485"),
]
