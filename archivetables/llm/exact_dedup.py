"""Exact deduplication by distributed radix partitioning from the most significant byte.

Groups of documents are split by their length and then by successive blocks of bytes, until a group
is a single document or its texts have ended; what is still together then is equal, byte for
byte, without any digest. Every split is an aggregation that combines before its shuffle, so a
group that holds a third of all rows costs a row per task there, and a join of the documents
with the groups that are still shared. Only members of such groups go on to the next split, with
the bytes not yet looked at; the first split moves lengths and first bytes alone, no texts. Blocks
grow eightfold up to 64 MB, so a text of n bytes takes about log8(n) splits, and one more for every
64 MB beyond.

The members of a large group are dealt in pieces over many tasks, whether adaptive execution is on
or not, and the one row of the group is repeated for each piece. At most ``PIECES`` groups are
that large, so their names are broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivetables.llm.common import SPACE, answered, exact, hidden, parted, settled, text_of, written

FIRST_BLOCK, GROWTH, LARGEST_BLOCK = 32, 8, 1 << 26  # bytes; only the number of splits depends on them
PIECES = 1024  # that all shared rows of a split are cut into at most, but for one piece more a group
LEAST_PIECE = 100  # rows


def exact_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``docs``.

    Texts are equal when they are identical after each run of white space became one space; a null
    text counts as empty, and empty texts are equal. Of equal texts the row with the smallest
    ``doc_id`` is kept (null counts as largest; among rows that share it, one). The digest is an
    output only. An empty table gives none.
    """
    docs = exact(docs, "doc_id", "text")
    rows = parted(docs.select("doc_id", _bytes(docs).alias("_bytes")), "radix-rows")
    return _groups(rows, F.col("_bytes")).drop("_row")


def _bytes(docs: DataFrame) -> Column:
    return F.regexp_replace(text_of(docs), SPACE, " ").cast("binary")


def _split(blocks: DataFrame, group: list[str], how: str) -> DataFrame:
    """``blocks`` with ``_size`` and ``_first`` of the rows that share ``group`` and ``_block``, where more
    than one does. The pieces of a large group go to tasks of their own."""
    on = [*group, "_block"]
    smallest = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))
    shared = blocks.groupBy(*on).agg(F.count("*").alias("_size"), smallest.alias("_first"))
    shared = written(shared.filter("_size > 1"), "radix-shared")
    rows = shared.agg(F.sum("_size")).first()[0] or 0
    piece = max(rows // PIECES, LEAST_PIECE)
    name = F.xxhash64(*on)  # where names collide, a small group is cut as well, and nothing else changes
    large = shared.filter(F.col("_size") > piece).groupBy(name.alias("_name"))
    large = F.broadcast(large.agg(F.ceil(F.max("_size") / piece).alias("_pieces")))

    def dealt(df: DataFrame) -> DataFrame:
        df = df.withColumn("_name", name).join(large, "_name", "left").drop("_name")
        return df.withColumn("_pieces", F.coalesce("_pieces", F.lit(1)))

    members = dealt(blocks).withColumn("_piece", F.pmod(F.xxhash64("_row"), "_pieces")).drop("_pieces")
    numbers = F.sequence(F.lit(0).cast("long"), F.col("_pieces") - 1)
    shared = dealt(shared).withColumn("_piece", F.explode(numbers)).drop("_pieces")
    return members.join(shared.hint("shuffle_hash"), [*on, "_piece"], how)


def _groups(rows: DataFrame, content: Column) -> DataFrame:
    """``exact_groups`` of ``parted`` rows by the bytes ``content``, with their numbers."""
    found = [F.col("_first._row").alias("_group"), F.col("_first.doc_id").alias("_keep"), "_size"]
    length, first = F.octet_length(content), F.substring(content, 1, FIRST_BLOCK)
    keys = written(rows.select("_row", "doc_id", length.alias("_length"), first.alias("_block")), "radix-keys")
    at_end = F.col("_length") <= FIRST_BLOCK
    split = _split(keys, ["_length"], "left").select("_row", *found, at_end.alias("_ended"))
    split = written(split, "radix-split")
    ended = [split.filter("_ended AND _size IS NOT NULL").drop("_ended")]
    going = F.when(~F.col("_ended"), F.col("_group")).alias("_group")
    active = answered(rows, split.select("_row", going), "_group").filter("_group IS NOT NULL")
    rest = F.substring(content, F.lit(FIRST_BLOCK + 1), length).alias("_rest")
    active, width = written(active.select("_row", "doc_id", "_group", rest), "radix-rest"), FIRST_BLOCK
    while not active.isEmpty():
        width = min(width * GROWTH, LARGEST_BLOCK)
        blocks = active.withColumn("_block", F.substring("_rest", 1, width))
        rest = F.substring("_rest", F.lit(width + 1), F.octet_length("_rest")).alias("_rest")
        split = _split(blocks.withColumnRenamed("_group", "_before"), ["_before"], "inner")
        split = written(split.select("_row", "doc_id", *found, rest), "radix-split")
        at_end = F.octet_length("_rest") == 0
        ended.append(split.filter(at_end).select("_row", "_group", "_keep", "_size"))
        active = split.filter(~at_end).select("_row", "doc_id", "_group", "_rest")
    members = reduce(DataFrame.unionAll, ended)
    alone = F.col("_size").isNull()
    digests = rows.select("_row", "doc_id", F.sha2(content, 256).alias("text_sha256"))
    return digests.join(members, "_row", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).alias("group_size"),
        (alone | (F.col("_group") == F.col("_row"))).alias("kept"),
        "text_sha256",
        "_row",
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` less the rows that ``exact_groups`` does not keep; columns as before."""
    rows = parted(hidden(docs, "doc_id", "text"), "radix-documents")

    def groups() -> DataFrame:
        return _groups(rows, _bytes(rows)).select("_row", "kept")

    judged = answered(rows, settled(docs.sparkSession, "radix-kept", groups), "kept")
    return judged.filter("kept").drop("_row", "kept").toDF(*docs.columns)


GROUPS_SQL = r"""WITH d AS (SELECT doc_id,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
    doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)"""
