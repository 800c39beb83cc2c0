"""Line deduplication by a sharded minimal perfect hash over line digests.

Each chunk of documents sends the 128-bit digests of its lines, without repeats, to their shards. A
shard adds them up and indexes the lines of two or more documents: a minimal perfect hash gives each
a slot in compact arrays of fingerprint, count and first document. Chunks then probe the arrays of each
shard with their digests; no line is joined with a line. The hash places half of a digest, the
fingerprint is the other half, so that a line outside the index hits it by chance once in 2**64
probes. A line that every document holds is one key per chunk, however often it occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivetables.llm.chunks import pack, with_answers
from archivetables.llm.common import written

MIN_CHARS = 10
SHARD_BYTES = 64 << 20  # of text for each shard
BUFFERED = 4_000_000  # keys that a shard's task holds before it adds them up
NO_ID = np.iinfo("int64").max  # stands for a null doc_id, the largest
LEVELS = 48
STEP = 0x9E3779B97F4A7C15


class PerfectHash:
    """Slots 0 to n - 1 for n distinct 64-bit keys: of each level's bits, those that one key alone
    hits are set; the other keys go on to the next level. What no level parts is listed."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.ranks, total = [], 0
        for bits in levels:
            self.ranks.append(total + np.cumsum(bits, dtype="int64") - 1)
            total += int(bits.sum())
        self.n = total + len(rest)

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = keys + np.uint64(STEP * (level + 1) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype("int64")

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        while len(keys) and len(levels) < LEVELS:
            size = max(64, len(keys) * 3 // 2)
            at = cls.place(keys, len(levels), size)
            bits = np.bincount(at, minlength=size) == 1
            levels.append(bits)
            keys = keys[~bits[at]]
        return cls(levels, np.sort(keys))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key of the set; of any other key, any slot or -1."""
        found = np.full(len(keys), -1, "int64")
        open_ = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = self.place(keys[open_], level, len(bits))
            hit = bits[at]
            found[open_[hit]] = ranks[at[hit]]
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.searchsorted(self.rest, keys[open_]).clip(max=len(self.rest) - 1)
            hit = self.rest[at] == keys[open_]
            found[open_[hit]] = self.n - len(self.rest) + at[hit]
        return found

    def packed(self) -> dict:
        return {
            "sizes": [len(b) for b in self.levels],
            "bits": [np.packbits(b).tobytes() for b in self.levels],
            "rest": self.rest.tobytes(),
        }

    @classmethod
    def unpacked(cls, sizes: list[int], bits: list[bytes], rest: bytes) -> PerfectHash:
        levels = [
            np.unpackbits(np.frombuffer(b, "uint8"), count=n).astype(bool)
            for n, b in zip(sizes, bits, strict=True)
        ]
        return cls(levels, np.frombuffer(rest, "uint64"))


def line_keys(text: bytes) -> list[bytes | None]:
    """The digest of each line's key; None for short keys."""
    out: list[bytes | None] = []
    for line in text.split(b"\n"):
        key = line.strip(b" \t\n\r\x0b\x0c").lower()
        long = len(key) >= MIN_CHARS and (len(key) >= 4 * MIN_CHARS or len(key.decode()) >= MIN_CHARS)
        out.append(xxhash.xxh3_128_digest(key) if long else None)
    return out


REQUEST = "shard int, part int, chunk bigint, keys binary, first binary, last binary, counts binary"
INDEX = (
    "shard int, sizes array<bigint>, bits array<binary>, rest binary, "
    "fingerprints binary, counts binary, first binary"
)


def requests(chunks: DataFrame, shards: int) -> DataFrame:
    """The distinct line digests of each chunk, by shard, with first and last document and count."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lines: dict[bytes, list[int]] = {}
                for doc, text in zip(row["doc_ids"], row["texts"], strict=True):
                    doc = NO_ID if doc is None else doc
                    for key in line_keys(text):
                        if key is not None:
                            seen = lines.setdefault(key, [doc, doc, 0])
                            seen[0], seen[1] = min(seen[0], doc), max(seen[1], doc)
                            seen[2] += 1
                if not lines:
                    continue
                keys = np.frombuffer(b"".join(lines), "uint64").reshape(-1, 2)
                values = np.array(list(lines.values()), "int64")
                shard = (keys[:, 0] % np.uint64(shards)).astype("int64")
                rows = []
                for s in np.unique(shard):
                    mine = shard == s
                    first, last, count = np.ascontiguousarray(values[mine].T)
                    rows.append(
                        (int(s), row["part"], row["chunk"], keys[mine].tobytes(), *(x.tobytes() for x in (first, last, count)))
                    )
                names = [x.split()[0] for x in REQUEST.split(", ")]
                types = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names
                )

    return chunks.select("part", "chunk", "doc_ids", "texts").mapInArrow(ask, REQUEST)


def add_up(keys: np.ndarray, first: np.ndarray, last: np.ndarray, counts: np.ndarray) -> tuple:
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    keys = keys[order]
    new = np.r_[True, (keys[1:] != keys[:-1]).any(1)] if len(keys) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    if not len(at):
        return keys, first, last, counts
    return (
        keys[at],
        np.minimum.reduceat(first[order], at),
        np.maximum.reduceat(last[order], at),
        np.add.reduceat(counts[order], at),
    )


def build_index(asked: DataFrame, shards: int) -> DataFrame:
    """A row per shard with lines of several documents: the perfect hash and its arrays."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, parts = None, 0, []

        def total() -> tuple:
            return add_up(*(np.concatenate(x) for x in zip(*parts, strict=True)))

        def row() -> pa.RecordBatch:
            keys, first, last, counts = total()
            repeated = first < last
            keys, first, counts = keys[repeated], first[repeated], counts[repeated]
            perfect = PerfectHash.build(keys[:, 0].copy())
            slots = perfect.slots(keys[:, 0])
            arrays = [np.empty(len(keys), kind) for kind in ("uint64", "uint32", "int64")]
            for array, values in zip(arrays, (keys[:, 1], counts.clip(max=2**32 - 1), first), strict=True):
                array[slots] = values
            table = {"shard": shard, **perfect.packed()}
            table |= dict(zip(("fingerprints", "counts", "first"), (a.tobytes() for a in arrays), strict=True))
            return pa.RecordBatch.from_pylist([table], INDEX_SCHEMA)

        for batch in batches:
            for r in batch.select(["shard", "keys", "first", "last", "counts"]).to_pylist():
                if r["shard"] != shard and parts:
                    yield row()
                    held, parts = 0, []
                shard = r["shard"]
                parts.append(
                    (
                        np.frombuffer(r["keys"], "uint64").reshape(-1, 2),
                        *(np.frombuffer(r[c], "int64") for c in ("first", "last", "counts")),
                    )
                )
                held += len(parts[-1][0])
                if held > BUFFERED:
                    parts = [total()]
                    held = 0
        if parts:
            yield row()

    return (
        asked.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(build, INDEX)
    )


INDEX_SCHEMA = pa.schema(
    [
        ("shard", pa.int32()),
        ("sizes", pa.list_(pa.int64())),
        ("bits", pa.list_(pa.binary())),
        *[(name, pa.binary()) for name in ("rest", "fingerprints", "counts", "first")],
    ]
)


def probe_index(asked: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """``part, chunk, keys, first``: of each chunk's digests, those in the index, with their first document."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, perfect, fingerprints, first = None, None, None, None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["fingerprints"] is not None:
                    shard = r["shard"]
                    perfect = PerfectHash.unpacked(r["sizes"], r["bits"], r["rest"])
                    fingerprints = np.frombuffer(r["fingerprints"], "uint64")
                    first = np.frombuffer(r["first"], "int64")
                elif r["shard"] == shard and perfect.n:
                    keys = np.frombuffer(r["keys"], "uint64").reshape(-1, 2)
                    slots = perfect.slots(keys[:, 0])
                    hit = (slots >= 0) & (fingerprints[slots] == keys[:, 1])
                    if hit.any():
                        out.append((r["part"], r["chunk"], keys[hit].tobytes(), first[slots[hit]].tobytes()))
            if out:
                types = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*out, strict=True), types, strict=True)],
                    ["part", "chunk", "keys", "first"],
                )

    rows = index.unionByName(asked.drop("first", "last", "counts"), allowMissingColumns=True)
    # a shard's index row comes before its requests
    return (
        rows.repartition(shards, "shard")
        .sortWithinPartitions("shard", F.col("fingerprints").isNull())
        .mapInArrow(probe, "part int, chunk bigint, keys binary, first binary")
    )


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` of every row of ``docs``, with the lines that stay.

    Lines end at ``\\n``. A line's key is the line without white space at its ends, A-Z in lower case.
    Where two or more documents hold a key of at least ten characters, only the one with the smallest
    ``doc_id`` keeps its lines of that key. Null and empty texts are one empty line. Rows that share a
    ``doc_id`` are one document in this; a null ``doc_id`` is the largest. An empty table gives none.
    """
    chunks = pack(docs, "lines")
    n_bytes = chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    shards = n_bytes // SHARD_BYTES + 1
    asked = written(requests(chunks, shards), "line-requests")
    index = written(build_index(asked, shards), "line-index")
    answers = written(probe_index(asked, index, shards), "line-answers")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                first: dict[bytes, int] = {}
                for answer in row["answers"] or ():
                    keys = answer["keys"]
                    split = [keys[i : i + 16] for i in range(0, len(keys), 16)]
                    first.update(zip(split, np.frombuffer(answer["first"], "int64").tolist(), strict=True))
                n_lines, n_dropped, texts = [], [], []
                for doc, text in zip(row["doc_ids"], row["texts"], strict=True):
                    own = NO_ID if doc is None else doc
                    lines = text.split(b"\n")
                    keep = [
                        line
                        for line, key in zip(lines, line_keys(text), strict=True)
                        if first.get(key, own) == own
                    ]
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(keep))
                    texts.append(b"\n".join(keep).decode())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(n_lines, pa.int64()),
                        pa.array(n_dropped, pa.int64()),
                        pa.array(texts, pa.string()),
                    ],
                    ["doc_id", "n_lines", "n_dropped", "text"],
                )

    return (
        with_answers(chunks, answers, "answers")
        .select("doc_ids", "texts", "answers")
        .mapInArrow(clean, "doc_id bigint, n_lines bigint, n_dropped bigint, text string")
    )


LINES_SQL = r"""WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
judged AS (SELECT *, length(key) >= 10 AND min(doc_id) OVER (PARTITION BY key) <> doc_id AS dropped
    FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""
