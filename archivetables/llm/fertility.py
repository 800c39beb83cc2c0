"""Quality rules on tokeniser fertility.

Public vocabularies say how much a text looks like what they were made for: characters per token
(byte-level BPE), the share of tokens that fall back to bytes (pieces), and the entropy of the tokens
relative to what prose of that length has at most. Each script has a band for each measure; a text outside
any is rejected. Words are tokenised one by one, each with the space before it, so that a worker
tokenises a frequent word once.

A few counts of words, symbols, repeated lines and repeated five-word windows come first; their limits
reject a text whatever its tokens.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivetables.llm.common import exact, held, hidden, output, text_of

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
MIN_WORDS, MAX_REPEATED, WINDOW = 10, 0.2, 5
ENTROPY_BITS = 8.0  # what prose nears, however long; a shorter text can't have more than log2(tokens)
CACHE = 200_000  # words whose tokens a worker keeps
PIECE_BYTES = 4 << 20  # of words tokenised at once

# First bytes of UTF-8 characters by script; a text's script is that of most letters.
SCRIPTS = {
    "latin": (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA)),
    "greek": (0xCE, 0xCF),
    "cyrillic": (0xD0, 0xD1, 0xD2, 0xD3),
    "semitic": tuple(range(0xD6, 0xDC)),
    "indic": (0xE0, 0xE1),
    "east asian": tuple(range(0xE3, 0xEE)),
}
# Bands by script: characters per token, share of byte tokens, relative entropy; ends are allowed.
# They are wide: prose lies well within, as do texts with some code or numbers.
BANDS = {
    "latin": ((1.2, 12.0), (0.0, 0.1), (0.68, 1.0)),
    "greek": ((0.4, 6.0), (0.0, 0.5), (0.4, 1.0)),
    "cyrillic": ((0.4, 8.0), (0.0, 0.3), (0.4, 1.0)),
    "semitic": ((0.3, 6.0), (0.0, 0.8), (0.3, 1.0)),
    "indic": ((0.2, 6.0), (0.0, 1.0), (0.3, 1.0)),
    "east asian": ((0.2, 4.0), (0.0, 0.9), (0.3, 1.0)),
    "none": ((0.8, 20.0), (0.0, 0.2), (0.3, 1.0)),  # without letters
}


class Vocabularies:
    """Both tokenisers, and the tokens of the words met lately."""

    def __init__(self, ranks: bytes, pieces: bytes, pattern: str):
        pairs = map(bytes.split, ranks.splitlines())
        self.bpe = tiktoken.Encoding(
            "ranks",
            pat_str=pattern,
            mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
            special_tokens={},
        )
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())])
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.n_pieces = self.n_bytes = self.n_tokens = np.empty(0, "int64")
        self.tokens, self.starts = np.empty(0, "int32"), np.empty(0, "int64")

    def learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.index]
        texts = [w.decode() for w in new]
        pieces = self.pieces.encode(texts, num_threads=1)
        encode = self.bpe.encode_ordinary
        tokens = [encode(" " + t) for t in texts]
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))

        def lengths(lists: list) -> np.ndarray:
            return np.fromiter(map(len, lists), "int64", len(lists))

        def flat(lists: list, n: int) -> np.ndarray:
            return np.fromiter((x for one in lists for x in one), "int32", n)

        n_pieces, n_tokens = lengths(pieces), lengths(tokens)
        owner = np.repeat(np.arange(len(new)), n_pieces)
        byte = self.is_byte[flat(pieces, int(n_pieces.sum()))]
        self.n_pieces = np.append(self.n_pieces, n_pieces)
        self.n_bytes = np.append(self.n_bytes, np.bincount(owner[byte], minlength=len(new)))
        self.n_tokens = np.append(self.n_tokens, n_tokens)
        self.tokens = np.append(self.tokens, flat(tokens, int(n_tokens.sum())))
        self.starts = np.cumsum(self.n_tokens) - self.n_tokens

    def measures(self, at: np.ndarray, n_chars: int) -> tuple[float, float, float]:
        """Characters per token, share of byte tokens, relative entropy of words by index."""
        each = self.n_tokens[at]
        total = int(each.sum())
        if not total:
            return 0.0, 0.0, 1.0
        skipped = np.repeat(self.starts[at] - (np.cumsum(each) - each), each)
        counts = np.unique(self.tokens[skipped + np.arange(total)], return_counts=True)[1]
        share = counts / total
        most = min(np.log2(total), ENTROPY_BITS)
        entropy = float(-(share * np.log2(share)).sum() / most) if total > 1 else 1.0
        pieces = max(1, int(self.n_pieces[at].sum()))  # a normaliser may leave nothing of a word
        return n_chars / total, float(self.n_bytes[at].sum() / pieces), min(entropy, 1.0)


def repeated_words(at: np.ndarray) -> int:
    """Words inside windows of five words that are found twice or more, the first included."""
    n = len(at) - WINDOW + 1
    if n < 2:
        return 0
    name = np.zeros(n, "uint64")
    for i in range(WINDOW):
        name = (name ^ at[i : i + n].astype("uint64")) * np.uint64(0x9E3779B97F4A7C15)
        name ^= name >> np.uint64(29)
    _, back, counts = np.unique(name, return_inverse=True, return_counts=True)
    again = counts[back] > 1
    steps = np.zeros(len(at) + 1, "int64")
    steps[:n] += again
    steps[WINDOW:] -= again
    return int((np.cumsum(steps[:-1]) > 0).sum())


def repeated_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    repeated = 0
    for line in text.split(b"\n"):
        if line in seen:
            repeated += bool(line.strip(SPACES))
        else:
            seen.add(line)
    return repeated


def script_of(histogram: np.ndarray) -> str:
    letters = {script: int(histogram[list(first)].sum()) for script, first in SCRIPTS.items()}
    most = max(letters, key=letters.get)
    return most if letters[most] else "none"


COLUMNS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, script string, chars_per_token double, byte_share double, "
    "token_entropy double"
)


def judge(text: bytes, words: list[bytes], vocabularies: Vocabularies, bands: dict) -> tuple:
    histogram = np.bincount(np.frombuffer(text, "uint8"), minlength=256)
    n_chars = len(text) - int(histogram[0x80:0xC0].sum() + histogram[list(SPACES)].sum())
    index = vocabularies.index
    at = np.fromiter((index[w] for w in words), "int64", len(words))
    repeats = repeated_words(at)
    failed = len(words) < MIN_WORDS or 100 * repeats > 100 * MAX_REPEATED * len(words)
    script = script_of(histogram)
    found = vocabularies.measures(at, n_chars)
    inside = all(low <= x <= high for x, (low, high) in zip(found, bands[script], strict=True))
    symbols = int(histogram[list(SYMBOLS)].sum())
    counts = (len(words), n_chars, symbols, repeated_lines(text), repeats)
    return (*counts, failed, inside and not failed, script, *found)


def judge_documents(
    docs: DataFrame, ranks: str, pieces: str, pattern: str, bands: dict = BANDS
) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``kept``, the script and the three measures of every
    row of ``docs``. Words are runs without ASCII white space. A null or empty text has no words and is
    rejected by the base limits; its measures are 0, 0 and 1. Repeated rows stay. ``ranks`` and
    ``pieces`` are paths of vocabulary files, read on the driver and sent to the workers.
    """
    files = [open(path, "rb").read() for path in (ranks, pieces)]
    digest = hashlib.sha256(b"".join(files)).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held(f"fertility {digest}", lambda: Vocabularies(*shared.value, pattern))
        for batch in batches:
            size, begin, words = 0, 0, []
            texts = batch.column("text")
            rows = []
            for i in range(len(batch)):
                words.append(texts[i].as_py().split())
                size += len(texts[i].as_buffer())
                if size < PIECE_BYTES and i < len(batch) - 1:
                    continue
                distinct = {w for one in words for w in one}
                if len(known.index) + len(distinct) > CACHE:
                    known.clear()
                known.learn(distinct)
                rows += [
                    judge(texts[begin + k].as_py(), one, known, bands) for k, one in enumerate(words)
                ]
                size, begin, words = 0, i + 1, []
            columns = [pa.array(c) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns],
                ["doc_id", *(c.split()[0] for c in COLUMNS.split(", "))],
            )

    docs = exact(docs, "doc_id", "text")
    return docs.select("doc_id", text_of(docs).cast("binary").alias("text")).mapInArrow(
        run, output(docs, COLUMNS)
    )


def kept_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` that are kept; columns as before. A row rides along as the key of its text."""
    rows = hidden(docs, "text")
    rows = rows.select(F.struct("*").alias("doc_id"), "text")
    kept = judge_documents(rows, **parameters).filter("kept").select("doc_id.*")
    return kept.toDF(*docs.columns)
