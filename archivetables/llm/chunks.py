"""Documents packed into rows of bounded size, for operators that ask the whole corpus about each of
their lines or substrings.

A chunk sends keys, packed and without repeats, to where equal keys meet; the answers come back to the
chunk, whose order makes positions needless. The chunk table is bucketed by the task that wrote it (so
each task writes one file), and answers are joined to it without moving its texts again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivetables.llm.common import exact, text_of
from archivetables.session import scratch_dir

CHUNK_BYTES = 2 << 20  # of text in a chunk; a longer document is a chunk of its own
CHUNK_ROWS = 1 << 20  # in a chunk, so that chunk * CHUNK_ROWS + position numbers all rows
CHUNKS = 1 << 22  # numbers of chunks for each task
# Small row groups and frequent size checks: a row is large here.
LARGE_ROWS = {
    "compression": "zstd",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size.row.check.min": "2",
    "parquet.block.size.row.check.min": "2",
}
MAX_BUCKETS = 100_000  # Spark's own limit; beyond it a bucket holds several tasks' files


@dataclass(frozen=True)
class Measure:
    """A column of a chunk: a number or name for each of its texts."""

    name: str
    arrow: pa.DataType
    sql: str


def pack(
    docs: DataFrame,
    label: str,
    measures: tuple[Measure, ...] = (),
    measure: Callable[[bytes], tuple] = lambda text: (),
) -> DataFrame:
    """``part, chunk, n_bytes, doc_ids, texts`` (UTF-8; null as empty) of the rows of ``docs``, and what
    ``measure`` finds in each text as further arrays; written."""
    spark = docs.sparkSession
    schema = pa.schema([*CHUNK, *((m.name, pa.list_(m.arrow)) for m in measures)])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number, held, ids, texts, found = part * CHUNKS, 0, [], [], []

        def row() -> pa.RecordBatch:
            values = [part, number, held, ids, texts, *zip(*found, strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], field.type) for v, field in zip(values, schema, strict=True)],
                schema=schema,
            )

        for batch in batches:
            for key, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                raw = text.as_py()
                if ids and (held + len(raw) > CHUNK_BYTES or len(ids) == CHUNK_ROWS):
                    yield row()
                    number, held, ids, texts, found = number + 1, 0, [], [], []
                ids.append(key.as_py())
                texts.append(raw)
                if measures:
                    found.append(measure(raw))
                held += len(raw)
        if ids:
            yield row()

    docs = exact(docs, "doc_id", "text")
    rows = docs.select(F.col("doc_id").cast("long"), text_of(docs).cast("binary").alias("text"))
    sql = "part int, chunk bigint, n_bytes bigint, doc_ids array<bigint>, texts array<binary>"
    packed = rows.mapInArrow(
        fill, ", ".join([sql, *(f"{m.name} array<{m.sql}>" for m in measures)])
    )
    buckets = max(1, min(2 * rows.rdd.getNumPartitions(), MAX_BUCKETS))
    name = f"{label}_{uuid.uuid4().hex}"
    writer = packed.write.options(**LARGE_ROWS).bucketBy(buckets, "part")
    writer.option("path", scratch_dir(spark, label)).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files lie in the scratch folder
    return table


CHUNK = pa.schema(
    [
        ("part", pa.int32()),
        ("chunk", pa.int64()),
        ("n_bytes", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("texts", pa.list_(pa.binary())),
    ]
)


def with_answers(chunks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """``chunks`` with the answers to each, as an array of structs. A chunk gets at most an answer for
    each of its keys. Tasks' files meet their answers by ``part``, the chunk is compared as a condition."""
    columns = [c for c in answers.columns if c not in ("part", "chunk")]
    listed = answers.groupBy("part", "chunk").agg(F.collect_list(F.struct(*columns)).alias(name))
    listed = listed.withColumnRenamed("chunk", "_chunk").hint("shuffle_hash")
    same = (chunks["part"] == listed["part"]) & (chunks["chunk"] - listed["_chunk"] == 0)
    return chunks.join(listed, same, "left").drop(listed["part"]).drop("_chunk")
