"""What several operators share: white space, row identities, written intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivetables.session import delete_scratch, scratch_dir, scratch_folders

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
MAX_BUCKETS = 100_000  # Spark's own limit; beyond it a bucket holds several tasks' files


_held: dict[str, Any] = {}  # what ``held`` keeps, in a worker


def held(key: str, build: Callable[[], Any]) -> Any:
    """What ``build`` makes, kept in the worker for its further tasks. It is large: what is kept under another
    key is given up first, as workers outlive the stages of a pipeline."""
    if key not in _held:
        _held.clear()
        _held[key] = build()
    return _held[key]


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and whole if executors are lost."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` returns, written; the tables that ``build`` wrote on the way are deleted."""
    with scratch_folders() as made:
        answer = build()
    answer = written(answer, label)
    delete_scratch(spark, made)
    return answer


def numbered(df: DataFrame, label: str) -> DataFrame:
    """``df`` with a row number ``_row`` that no other row has, written so that it never changes.

    Repeated and null ``doc_id`` therefore stay rows of their own.
    """
    return written(df.withColumn("_row", F.monotonically_increasing_id()), label)


ROW_BITS = 33  # of a row number that count within its task


def parted(df: DataFrame, label: str) -> DataFrame:
    """``numbered``, in a table bucketed by the task ``_part`` that wrote a row, so that ``answered`` joins
    without moving the rows. Each task writes one file."""
    spark, name = df.sparkSession, f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    rows = rows.withColumn("_part", F.shiftright("_row", ROW_BITS).cast("int"))
    # with fewer buckets than it has shuffle partitions, Spark would rather move the rows
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(max(least, 2 * df.rdd.getNumPartitions()), MAX_BUCKETS)
    writer = rows.write.option("compression", "zstd").bucketBy(buckets, "_part")
    writer.option("path", scratch_dir(spark, label)).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files lie in the scratch folder
    return table


def answered(rows: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """``parted`` rows with the column ``name`` of ``answers`` (``_row`` and it), which has one for each row.

    The answers of a task's rows are listed in order and meet them by ``_part``: one narrow row per task
    moves, and no text does.
    """
    part = F.shiftright("_row", ROW_BITS).cast("int").alias("_part")
    listed = F.array_sort(F.collect_list(F.struct("_row", name)))
    listed = answers.groupBy(part).agg(F.transform(listed, lambda a: a[name]).alias("_all"))
    place = F.col("_row").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).cast("int")
    joined = rows.join(listed.hint("shuffle_hash"), "_part")
    return joined.withColumn(name, F.get("_all", place)).drop("_all", "_part")


def exact(docs: DataFrame, *names: str) -> DataFrame:
    """Just these columns of ``docs``, whatever else it has, names that differ by case included."""
    at = {name: f"_c{docs.columns.index(name)}" for name in names}
    numbers = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    return numbers.select(*[F.col(column).alias(name) for name, column in at.items()])


def hidden(docs: DataFrame, *names: str) -> DataFrame:
    """``docs`` with its other columns under names that nothing clashes with; ``toDF`` gives them back."""
    at = {docs.columns.index(name) for name in names}
    return docs.toDF(*[c if i in at else f"_c{i}" for i, c in enumerate(docs.columns)])


def output(docs: DataFrame, ddl: str) -> T.StructType:
    """The schema ``ddl`` after a ``doc_id`` of the type that ``docs`` has."""
    key = T.StructField("doc_id", docs.schema["doc_id"].dataType)
    return T.StructType([key, *T.StructType.fromDDL(ddl).fields])


def text_of(df: DataFrame) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def hex_sha256(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)
