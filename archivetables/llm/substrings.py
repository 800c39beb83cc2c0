"""Removal of repeated substrings by blockwise suffix sorting with a difference cover.

A byte goes when a string of ``DEPTH`` bytes around it also starts somewhere else. That is a question
about suffixes cut to ``DEPTH`` bytes: which of them tie? Positions whose remainder by ``PERIOD`` is in a
difference cover are the sample. For any two suffixes there is a shift below ``PERIOD`` that takes both
into the sample, so two that tie have samples that tie at depth ``DEPTH - PERIOD + 1``. Hence:

1. The sample strings of all documents are ranked first (6 % of all positions): which of them tie?
2. A suffix none of whose samples ties can't tie and is never sorted. The others are cut into
   buckets by their order and each bucket is sorted by itself, in a task's memory.

Only ties count here, never which of two suffixes is the smaller; so the order is that of 64-bit
names, from sums over mixed 8-byte strings, which long ties cannot slow down. Two different
strings share a name with probability 2**-64. Names travel as packed numbers without positions: a
chunk of documents sends each name once, and gets back a bit for each. A string that all documents
hold is one number per chunk.

Equal documents are found first, by their digests; of each group only one is searched.

Passages, ``PASSAGE`` words in a row that another document has too, whatever white space is between them,
are mostly shorter than ``DEPTH`` bytes. They are found beside the strings, in the same two steps: the
mark of a window is the least name of the ``MARK`` words in a row that lie in it, so equal windows have
equal marks, and most windows share theirs with the next. Only windows whose mark is in another document
are asked for themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivetables.llm.chunks import pack, with_answers
from archivetables.llm.common import written

DEPTH = 400
PASSAGE = 50  # words
MARK = 20  # words
BLOCK = 2 << 20  # bytes named at a time
BUCKET_KEYS = 2_000_000  # names in a bucket, about: what a task sorts


def singer(q: int) -> tuple[int, np.ndarray]:
    """A perfect difference set of q + 1 numbers modulo q * q + q + 1, for a prime q: the powers of
    a generator x of the field of q**3 elements that lie in the plane spanned by 1 and x."""
    v = q * q + q + 1
    for a, b, c in np.ndindex(q, q, q):
        at, planes = (1, 0, 0), []
        for i in range(v):
            if at[2] == 0:
                planes.append(i)
            at = (c * at[2] % q, (at[0] + b * at[2]) % q, (at[1] + a * at[2]) % q)
        differences = {(x - y) % v for x in planes for y in planes}
        if len(planes) == q + 1 and len(differences) == v:
            return v, np.array(planes)
    raise ValueError(f"{q} is no prime")


PERIOD, COVER = singer(17)  # 307 and 18 numbers
SAMPLE_DEPTH = DEPTH - PERIOD + 1
IN_COVER = np.isin(np.arange(PERIOD), COVER)
# Names for each byte of text in the first step, about: words have two bytes at least, and a mark
# serves half of the windows it could.
SAMPLED = len(COVER) / PERIOD + 1 / (PASSAGE - MARK + 2)
GRAM = 8
BASE = 0x9E3779B97F4A7C15
CUT_TO = np.array([256**n - 1 for n in range(GRAM + 1)], "uint64")
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _powers(base: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(BLOCK + DEPTH, base % 2**64, "uint64")])


_tables: list[np.ndarray] = []  # powers of the base and of its inverse, in a worker


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def names(raw: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """A number for each string of ``depth`` bytes that starts at one of ``at`` (ascending)."""
    if not _tables:
        _tables.extend((_powers(BASE), _powers(pow(BASE, -1, 2**64))))
    powers, inverse = _tables
    out = np.empty(len(at), "uint64")
    for begin in range(0, len(raw), BLOCK):
        low, high = np.searchsorted(at, (begin, begin + BLOCK))
        if low == high:
            continue
        x = raw[begin : begin + BLOCK + depth].astype("uint64")
        for width in (1, 2, 4):
            x = x[:-width] | x[width:] << np.uint64(8 * width)
        sums = np.concatenate((np.zeros(1, "uint64"), np.cumsum(mix(x) * powers[: len(x)])))
        own = at[low:high] - begin
        out[low:high] = mix((sums[own + (depth - GRAM + 1)] - sums[own]) * inverse[own])
    return out


def word_names(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A number for each word, from its pieces of eight bytes, their places in it and their lengths."""
    pieces = (stops - starts + GRAM - 1) // GRAM
    first = np.cumsum(pieces) - pieces
    place = np.arange(pieces.sum()) - np.repeat(first, pieces)
    begin = np.repeat(starts, pieces) + GRAM * place
    length = np.minimum(np.repeat(stops, pieces) - begin, GRAM)
    padded = np.concatenate((raw, np.zeros(GRAM, "uint8")))
    eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    values = eight[begin] & CUT_TO[length]
    values = mix(mix(values) + (place * 16 + length).astype("uint64"))
    return mix(np.add.reduceat(values, first)) if len(starts) else values


def rows_of(names: np.ndarray, n: int, width: int = 1) -> np.ndarray:
    """A number for each ``n`` words in a row, from those for each ``width``."""
    while width < n:
        step = min(width, n - width)
        names = mix(names[: max(0, len(names) - step)] * np.uint64(BASE) + names[step:])
        width += step
    return names


def least_of(names: np.ndarray, n: int) -> np.ndarray:
    """The least of each ``n`` names in a row."""
    width = 1
    while width < n:
        step = min(width, n - width)
        names = np.minimum(names[: max(0, len(names) - step)], names[step:])
        width += step
    return names


class Words:
    """The words of a chunk's texts, and the windows of ``PASSAGE`` words in the texts ``asked`` for."""

    def __init__(self, raw: np.ndarray, ends: np.ndarray, asked: np.ndarray):
        inside, edge = ~SPACES[raw], np.zeros(len(raw) + 1, bool)
        edge[0] = True
        edge[ends] = True
        self.starts = np.flatnonzero(inside & (edge[:-1] | ~np.r_[False, inside[:-1]]))
        self.stops = np.flatnonzero(inside & (edge[1:] | ~np.r_[inside[1:], False])) + 1
        self.doc = np.searchsorted(ends, self.starts, "right")
        self.begins = np.r_[0, ends]
        own = word_names(raw, self.starts, self.stops)
        n = max(0, len(own) - PASSAGE + 1)
        same = self.doc[:n] == self.doc[len(self.doc) - n :]
        self.at = np.flatnonzero(same & asked[self.doc[:n]])
        rows = rows_of(own, MARK)
        self.windows = rows_of(rows, PASSAGE, MARK)[self.at]
        least = least_of(rows, PASSAGE - MARK + 1)[self.at]
        doc = self.doc[self.at]
        other = np.ones(len(least), bool)
        other[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
        self.mark = np.cumsum(other) - 1  # of each window
        self.marks, self.mark_docs = mix(least[other]), doc[other]  # the least would crowd the first buckets

    def shared(self, windows: np.ndarray, copied: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
        """For each text its number of words, of words in ``windows``, and the runs of those as byte
        offsets; of ``copied`` texts all words, if they are enough for a window."""
        n, many = len(self.begins) - 1, len(self.starts)
        counts = np.bincount(self.doc, minlength=n)
        steps = np.zeros(many + 1, "int64")
        np.add.at(steps, self.at[windows], 1)
        np.add.at(steps, self.at[windows] + PASSAGE, -1)
        inside = (np.cumsum(steps[:-1]) > 0) | (copied & (counts >= PASSAGE))[self.doc]
        edge = np.ones(many + 1, bool)
        edge[1:-1] = self.doc[1:] != self.doc[:-1]
        first = np.flatnonzero(inside & (edge[:-1] | ~np.r_[False, inside[:-1]]))
        last = np.flatnonzero(inside & (edge[1:] | ~np.r_[inside[1:], False]))
        doc = self.doc[first]
        spans = pa.StructArray.from_arrays(
            [pa.array(x[y] - self.begins[doc], pa.int64()) for x, y in ((self.starts, first), (self.stops, last))],
            ["begin", "stop"],
        )
        offsets = pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32())
        words = np.bincount(self.doc[inside], minlength=n)
        return (
            pa.array(counts, pa.int64()),
            pa.array(words, pa.int64()),
            pa.ListArray.from_arrays(offsets, spans),
        )


class Keys:
    """The distinct names of a chunk in order, cut into buckets; bits for them, and back.

    ``values`` are of strings, which count wherever they start; ``named`` are of words, and count once in
    each of the texts ``docs``.
    """

    def __init__(self, values: np.ndarray, named: np.ndarray, docs: np.ndarray, buckets: int):
        self.values, self.back, self.counts = np.unique(
            np.concatenate((values, named)), return_inverse=True, return_counts=True
        )
        texts = docs.max(initial=0) + 1
        pairs, again = np.unique(self.back[len(values) :] * texts + docs, return_counts=True)
        np.subtract.at(self.counts, pairs // texts, again - 1)
        bucket = ((self.values >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        self.cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)].astype("int64")
        self.buckets = bucket[self.cuts[:-1]].astype("int64") if len(bucket) else np.empty(0, "int64")

    def slices(self) -> Iterator[tuple[int, slice]]:
        for bucket, low, high in zip(self.buckets, self.cuts, self.cuts[1:], strict=False):
            yield int(bucket), slice(low, high)

    def tied(self, answers: list[dict] | None) -> np.ndarray:
        """For each of the values as they were given, whether it ties; buckets not answered don't."""
        bits = np.zeros(len(self.values), bool)
        known = {a["bucket"]: a["bits"] for a in answers or ()}
        for bucket, part in self.slices():
            if bucket in known:
                n = part.stop - part.start
                bits[part] = np.unpackbits(np.frombuffer(known[bucket], "uint8"), count=n)
        return bits[self.back]


class Chunk:
    """The texts of a chunk in one array."""

    def __init__(self, row: dict):
        self.texts = row["texts"]
        self.raw = np.frombuffer(b"".join(self.texts), "uint8")
        lengths = np.array([len(t) for t in self.texts], "int64")
        self.ends = np.cumsum(lengths)
        self.copied, asked = np.zeros(len(lengths), bool), np.ones(len(lengths), bool)
        for copy in row.get("copies") or ():
            self.copied[copy["pos"]] = lengths[copy["pos"]] >= DEPTH
            asked[copy["pos"]] = copy["first"]
        self.words = Words(self.raw, self.ends, asked)
        limits = np.repeat(np.where(asked & (lengths >= DEPTH), self.ends, 0), lengths)
        here = np.arange(len(self.raw))
        self.samples = np.flatnonzero(IN_COVER[here % PERIOD] & (here + SAMPLE_DEPTH <= limits))
        self.inside = here + DEPTH <= limits

    def sample_keys(self, buckets: int) -> Keys:
        own = names(self.raw, self.samples, SAMPLE_DEPTH)
        return Keys(own, self.words.marks, self.words.mark_docs, buckets)

    def asked(self, tied: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the suffixes that have a tied sample among their first ``PERIOD`` positions, and
        which windows have a tied mark."""
        samples, words = tied[: len(self.samples)], tied[len(self.samples) :]
        marks = np.zeros(len(self.raw) + PERIOD + 1, "int64")
        marks[self.samples[samples] + 1] = 1
        upto = np.cumsum(marks)
        n = len(self.raw)
        starts = np.flatnonzero(self.inside & (upto[PERIOD : PERIOD + n] > upto[:n]))
        return starts, np.flatnonzero(words[self.words.mark])

    def suffix_keys(self, starts: np.ndarray, windows: np.ndarray, buckets: int) -> Keys:
        docs = self.words.doc[self.words.at[windows]]
        return Keys(names(self.raw, starts, DEPTH), self.words.windows[windows], docs, buckets)

    def removed(self, repeated: np.ndarray) -> np.ndarray:
        """Which bytes the strings of ``DEPTH`` bytes starting at ``repeated`` cover."""
        steps = np.zeros(len(self.raw) + 1, "int64")
        np.add.at(steps, repeated, 1)
        np.add.at(steps, repeated + DEPTH, -1)
        return np.cumsum(steps[:-1]) > 0


REQUEST = pa.schema(
    [
        ("bucket", pa.int64()),
        ("part", pa.int32()),
        ("chunk", pa.int64()),
        ("keys", pa.binary()),
        ("many", pa.binary()),
    ]
)
ANSWER = pa.schema(
    [("part", pa.int32()), ("chunk", pa.int64()), ("bucket", pa.int64()), ("bits", pa.binary())]
)


def _requests(row: dict, keys: Keys) -> pa.RecordBatch:
    rows = [
        (bucket, row["part"], row["chunk"], keys.values[s].tobytes(), np.packbits(keys.counts[s] > 1).tobytes())
        for bucket, s in keys.slices()
    ]
    columns = zip(*rows, strict=True) if rows else [[]] * len(REQUEST)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, REQUEST, strict=True)], schema=REQUEST
    )


def ties(requests: DataFrame, buckets: int, label: str) -> DataFrame:
    """``part, chunk, bucket, bits``: which names of each request occur elsewhere. A bucket at a time
    is held and sorted."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []

        def answers() -> pa.RecordBatch:
            every = np.sort(np.concatenate([k for _, _, k, _ in held]))
            twice = np.unique(every[1:][every[1:] == every[:-1]])
            rows = []
            for part, chunk, keys, many in held:
                bits = np.unpackbits(np.frombuffer(many, "uint8"), count=len(keys)).astype(bool)
                if len(twice):
                    bits |= twice[np.searchsorted(twice, keys).clip(max=len(twice) - 1)] == keys
                if bits.any():
                    rows.append((part, chunk, bucket, np.packbits(bits).tobytes()))
            columns = zip(*rows, strict=True) if rows else [[]] * len(ANSWER)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, ANSWER, strict=True)], schema=ANSWER
            )

        for batch in batches:
            for r in batch.to_pylist():
                if r["bucket"] != bucket and held:
                    yield answers()
                    held = []
                bucket = r["bucket"]
                held.append((r["part"], r["chunk"], np.frombuffer(r["keys"], "uint64"), r["many"]))
        if held:
            yield answers()

    answered = (
        requests.repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(sort, "part int, chunk bigint, bucket bigint, bits binary")
    )
    return written(answered, label)


def equal_texts(chunks: DataFrame) -> DataFrame:
    """``part, chunk, pos, first`` of each text that has copies; ``first`` is true for one of them."""
    texts = chunks.select("part", "chunk", F.posexplode("texts").alias("pos", "text"))
    digests = written(
        texts.filter(F.octet_length("text") >= DEPTH).select(
            "part", "chunk", "pos", F.unhex(F.sha2("text", 256)).alias("digest")
        ),
        "substring-digests",
    )
    shared = (
        digests.groupBy("digest")
        .agg(F.count("*").alias("n"), F.min(F.struct("chunk", "pos")).alias("least"))
        .filter("n > 1")
    )
    return digests.join(written(shared, "substring-shared"), "digest").select(
        "part", "chunk", "pos", (F.struct("chunk", "pos") == F.col("least")).alias("first")
    )


CUT = {
    "doc_id": "bigint",
    "n_bytes": "bigint",
    "n_removed": "bigint",
    "n_spans": "bigint",
    "kept": "binary",
    "n_words": "bigint",
    "n_passage_words": "bigint",
    "passages": "array<struct<begin: bigint, stop: bigint>>",
}


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept, n_words, n_passage_words, passages`` of every row of ``docs``.

    ``kept`` are the bytes of the text (UTF-8; null as empty) that no string of 400 bytes covers that
    also starts anywhere else, in the same document or another; ``n_spans`` the runs that went.
    What is kept may begin or end inside a character. Repeated rows are documents of their own, so of
    400 bytes or more they all go. An empty table gives none.

    ``passages`` are the runs of words (``[^\\x20\\x09-\\x0D]+``) that 50 words in a row cover which
    another row has too, as byte offsets ``begin, stop``, in order; ``n_passage_words`` the words in them.
    They tell what repeats and is shorter than 400 bytes; ``kept`` still holds them.
    """
    chunks = pack(docs, "substrings")
    n_bytes = chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    sample_buckets = int(n_bytes * SAMPLED) // BUCKET_KEYS + 1
    suffix_buckets = n_bytes // (4 * BUCKET_KEYS) + 1
    asking = "bucket bigint, part int, chunk bigint, keys binary, many binary"

    def ask_samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                yield _requests(row, Chunk(row).sample_keys(sample_buckets))

    def ask_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk = Chunk(row)
                found = chunk.asked(chunk.sample_keys(sample_buckets).tied(row["samples"]))
                yield _requests(row, chunk.suffix_keys(*found, suffix_buckets))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk = Chunk(row)
                starts, windows = chunk.asked(chunk.sample_keys(sample_buckets).tied(row["samples"]))
                tied = chunk.suffix_keys(starts, windows, suffix_buckets).tied(row["suffixes"])
                gone = chunk.removed(starts[tied[: len(starts)]])
                passages = chunk.words.shared(windows[tied[len(starts) :]], chunk.copied)
                n_removed, n_spans, kept = [], [], []
                for begin, end, copied in zip(
                    np.r_[0, chunk.ends[:-1]], chunk.ends, chunk.copied, strict=True
                ):
                    own = np.ones(end - begin, bool) if copied else gone[begin:end]
                    n_removed.append(int(own.sum()))
                    n_spans.append(int(own[:1].sum() + (own[1:] & ~own[:-1]).sum()))
                    kept.append(chunk.raw[begin:end][~own].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array([len(t) for t in chunk.texts], pa.int64()),
                        pa.array(n_removed, pa.int64()),
                        pa.array(n_spans, pa.int64()),
                        pa.array(kept, pa.binary()),
                        *passages,
                    ],
                    list(CUT),
                )

    marked = with_answers(chunks, written(equal_texts(chunks), "substring-copies"), "copies")
    samples = ties(marked.mapInArrow(ask_samples, asking), sample_buckets, "substring-samples")
    marked = with_answers(marked, samples, "samples")
    suffixes = ties(marked.mapInArrow(ask_suffixes, asking), suffix_buckets, "substring-suffixes")
    return with_answers(marked, suffixes, "suffixes").mapInArrow(
        cut, ", ".join(f"{name} {kind}" for name, kind in CUT.items())
    )
