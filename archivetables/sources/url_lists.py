"""URL lists: text files of one URL per line."""

from __future__ import annotations

import bz2
import logging
import lzma
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivetables import schemas
from archivetables.functions import strip
from archivetables.session import partitions_for
from archivetables.sources.archives import SPLIT_BYTES, _chunks, _inflate, _lines
from archivetables.sources.storage import open_input

logger = logging.getLogger(__name__)


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """``url`` per line, white space cut from both ends. Blank lines stay, as ``''``."""
    return spark.read.text(path).select(strip("value").alias("url"))


def read_previous_url_list(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_url_list``, but a list that cannot be read to its end is an empty one, whether that shows
    when it is listed or in the tasks that read it.

    A lost list must lead to no deletions at all, never to mass deletion. ``url_list_problems`` names
    what is wrong.
    """
    try:
        rows = scan_url_list(spark, path)
    except (PySparkException, Py4JJavaError) as error:
        logger.error("cannot read the previous URL list %r: %s", path, error)
        return spark.createDataFrame([], schemas.URL_LIST)
    broken = rows.where("problem IS NOT NULL").agg(F.count("*").alias("n"))
    return rows.where("problem IS NULL").where(broken.scalar() == 0).select("url")


def url_list_problems(spark: SparkSession, path: str) -> DataFrame:
    """``path, problem`` of each file of a URL list that cannot be read to its end."""
    try:
        rows = scan_url_list(spark, path)
    except (PySparkException, Py4JJavaError) as error:
        text = str(error).splitlines()[0]
        return spark.createDataFrame([(path, text)], "path string, problem string")
    return rows.where("problem IS NOT NULL").select("path", "problem")


URL_LINE = "url string, path string, problem string"
URL_LINE_ARROW = pa.schema([("url", pa.string()), ("path", pa.string()), ("problem", pa.string())])
PART = "path string, start bigint, stop bigint"
# by the end of a file's name: what unpacks it; other files are plain text
UNPACKERS = {
    ".gz": _inflate,
    ".bz2": lambda chunks: _stacked(chunks, bz2.BZ2Decompressor),
    ".xz": lambda chunks: _stacked(chunks, lzma.LZMADecompressor),
}


def scan_url_list(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``url, path, problem``: a row per line, as ``read_url_list`` has them, and for each file that cannot
    be read to its end a row without a URL that says why. Long plain files are read by many tasks."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    packed = F.array_contains(F.array(*map(F.lit, UNPACKERS)), F.regexp_extract("path", r"(\.[^./]*)$", 1))
    starts = F.when(packed | (F.col("length") <= split_bytes), F.array(F.lit(0).cast("long")))
    last = F.greatest(F.col("length") - 1, F.lit(0))
    starts = starts.otherwise(F.sequence(F.lit(0).cast("long"), last, F.lit(split_bytes).cast("long")))
    parts = files.select("path", "length", F.explode(starts).alias("start"))
    stop = F.when(F.col("start") + split_bytes < F.col("length"), F.col("start") + split_bytes)
    parts = parts.select("path", "start", F.when(~packed, stop).alias("stop"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                try:
                    for lines in _url_lines(**row):
                        yield _url_batch([line.decode(errors="replace") for line in lines], row["path"])
                except (OSError, EOFError, ValueError, zlib.error, lzma.LZMAError) as error:
                    yield _url_batch([None], row["path"], f"{type(error).__name__}: {error}")

    rows = parts.repartition(partitions_for(spark), "path", "start").mapInArrow(read, URL_LINE)
    return rows.withColumn("url", strip("url"))


def _url_batch(urls: list, path: str, problem: str | None = None) -> pa.RecordBatch:
    columns = [urls, [path] * len(urls), [problem] * len(urls)]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], schema=URL_LINE_ARROW)


def _url_lines(path: str, start: int, stop: int | None) -> Iterator[list[bytes]]:
    unpack = next((f for end, f in UNPACKERS.items() if path.endswith(end)), None)
    with open_input(path) as file:
        if unpack is not None:
            runs = _lines(unpack(_chunks(file, None)), 0, None)
        else:
            file.seek(max(start - 1, 0))
            runs = _lines(_chunks(file, None), start, stop)
        for lines, _ in runs:
            yield lines


def _stacked(chunks: Iterator[bytes], start: Callable) -> Iterator[bytes]:
    """The text of packed streams standing one behind the other."""
    stream = None
    for data in chunks:
        while data:
            stream = stream or start()
            yield stream.decompress(data)
            data = stream.unused_data if stream.eof else b""
            stream = None if stream.eof else stream
    if stream is not None:
        raise EOFError("packed text breaks off")


def write_url_list(urls: DataFrame, path: str, mode: str = "error") -> None:
    """Write column ``url`` as text, one URL per line, in part files under ``path``."""
    urls.select(F.col("url").cast("string").alias("value")).write.mode(mode).text(path)


def save_url_snapshot(urls: DataFrame | None, path: str, mode: str = "error") -> bool:
    """Keep the unfiltered URL list for the next run's comparison.

    Without a list nothing is written and the error is logged.
    """
    if urls is None:
        logger.error("no sitemap was parsed, so no URL snapshot is written to %r", path)
        return False
    write_url_list(urls, path, mode)
    return True
