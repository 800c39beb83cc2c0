"""WARC files that are packed within their archive, unpacked once into the shared folder.

A packed member can only be read from its start, so every block of records would unpack all before it.
"""

from __future__ import annotations

import hashlib
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivetables.session import partitions_for, scratch_dir, stored
from archivetables.sources.archives import WARC_DIR
from archivetables.sources.storage import locate, open_input, open_zip

STAGED = "wacz_path string, filename string, staged_path string, staged_bytes bigint"
STAGED_ARROW = pa.schema(
    [
        ("wacz_path", pa.string()),
        ("filename", pa.string()),
        ("staged_path", pa.string()),
        ("staged_bytes", pa.int64()),
    ]
)
COPY_BYTES = 1 << 20
BYTES_PER_TASK = 1 << 28


def stage_packed(members: DataFrame, pointers: DataFrame | None = None) -> DataFrame | None:
    """``wacz_path, filename, staged_path, staged_bytes`` of the WARC files among the ``members`` of archives
    that are stored packed, or none if all can be read in place. Each is unpacked by one task. With
    ``pointers``, only files that one of them names are.

    A file that cannot be unpacked is left out; reading its records will tell why.
    """
    spark = members.sparkSession
    packed = members.where("kind = 'warc' AND NOT stored").select(
        "wacz_path", F.substring("member", len(WARC_DIR) + 2, 1 << 30).alias("filename"), "size"
    )
    if pointers is not None:
        named = pointers.select("wacz_path", "filename").distinct()
        packed = packed.join(named, ["wacz_path", "filename"], "left_semi")
    packed = stored(packed, "packed-members")
    total = packed.agg(F.count("*").alias("n"), F.sum("size").alias("size")).first()
    if not total.n:
        return None
    folder = scratch_dir(spark, "unpacked")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        fs, inner = locate(folder)
        fs.create_dir(inner, recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                key = f"{row['wacz_path']}\0{row['filename']}".encode()
                name = f"{hashlib.sha256(key).hexdigest()}.warc"
                draft = f"{inner}/{name}.{attempt}"
                try:
                    size = _copy(row["wacz_path"], f"{WARC_DIR}/{row['filename']}", fs, draft)
                except (OSError, EOFError, zlib.error, zipfile.BadZipFile):
                    continue
                fs.move(draft, f"{inner}/{name}")  # a repeated task puts the same file there
                values = [row["wacz_path"], row["filename"], f"{folder}/{name}", size]
                arrays = [pa.array([v], f.type) for v, f in zip(values, STAGED_ARROW, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=STAGED_ARROW)

    tasks = max(partitions_for(spark, total.size, BYTES_PER_TASK), 1)
    dealt = packed.select("wacz_path", "filename").repartition(tasks, "wacz_path", "filename")
    return stored(dealt.mapInArrow(unpack, STAGED), "unpacked-members")


def _copy(path: str, member: str, fs, target: str) -> int:
    size = 0
    with open_input(path) as file, open_zip(file, path) as archive:
        with archive.open(member) as source, fs.open_output_stream(target) as sink:
            while data := source.read(COPY_BYTES):
                sink.write(data)
                size += len(data)
    return size
