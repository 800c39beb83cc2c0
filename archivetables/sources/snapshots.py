"""URL snapshots of crawls: kept sorted and in buckets, so that two of them compare without a shuffle."""

from __future__ import annotations

import logging
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivetables import schemas
from archivetables.functions import strip

logger = logging.getLogger(__name__)

BUCKETS = 200  # two snapshots compare without a shuffle if they have the same number
FOLDER = re.compile(r"urls-in-([0-9]+)")


def write_snapshot(urls: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Keep the distinct URLs of ``url`` under ``path``, without blank ones, a sorted file per bucket.

    White space is cut from both ends. ``path`` must not exist: a crawl has a snapshot of its own.
    """
    spark = urls.sparkSession
    folder = _folder(spark, path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        raise FileExistsError(path)
    kept = urls.select(strip("url").alias("url")).where("url <> ''").distinct().repartition(buckets, "url")
    name = _name()
    writer = kept.write.bucketBy(buckets, "url").sortBy("url")
    writer.option("path", f"{path.rstrip('/')}/urls-in-{buckets}").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files belong to the caller


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """``url`` of a snapshot, known to Spark by its buckets. Raises ``FileNotFoundError`` if there is none,
    or one that was not written to its end."""
    folder = _folder(spark, path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in files.listStatus(folder)] if files.exists(folder) else []
    whole = [p for p in found if FOLDER.fullmatch(p.getName()) and files.exists(_folder(spark, f"{p}/_SUCCESS"))]
    if len(whole) != 1:
        raise FileNotFoundError(f"no URL snapshot in {path!r}")
    name, buckets = _name(), FOLDER.fullmatch(whole[0].getName())[1]
    place = whole[0].toString().replace("\\", "\\\\").replace("'", "\\'")
    layout = f"CLUSTERED BY (url) SORTED BY (url) INTO {buckets} BUCKETS"
    spark.sql(f"CREATE TABLE {name} (url STRING) USING parquet {layout} LOCATION '{place}'")
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def urls_gone(spark: SparkSession, previous: str, current: str) -> DataFrame:
    """``url, status`` of the URLs that the snapshot ``previous`` has and ``current`` has not.

    Each bucket is compared with its counterpart by one task; snapshots of different numbers of buckets
    are shuffled. A missing previous snapshot is logged and deletes nothing; a missing current one raises.
    """
    now = read_snapshot(spark, current)
    try:
        before = read_snapshot(spark, previous)
    except FileNotFoundError as error:
        logger.error("nothing is deleted: %s", error)
        before = spark.createDataFrame([], schemas.URL_LIST)
    gone = before.join(now.hint("merge"), "url", "left_anti")
    return gone.withColumn("status", F.lit("deleted"))


def _name() -> str:
    return f"snapshot_{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)
