"""Byte-pair encoding as a streaming transducer of bounded lookahead, and decoding.

What follows a position can change the tokens before it only so far. Take the merges in the order
of their ranks over two texts that agree up to position k. The tokens that agree reach up to
a frontier, k at first. A merge (u, v) moves it left only where it joins the last agreeing token u to
the right in one of the texts, so by len(u); the next move is a merge (u', v') of a higher rank,
where v' starts where u started, so that u is on the left spine of v'. The heaviest chain of such
merges is the merge list's sufficient lookahead: tokens that end that far before the end of what
was read are final. A word is read through a window of fixed size, its stable tokens are
emitted, and the window starts again behind them; a word that ends in the window is settled at once.

``encode_documents`` gives the ids and the decoded text of every row. Vocabularies are those of the
``tokenizers`` library with byte-level BPE words and a word-end suffix; the file's path is a parameter.
It is read on the driver and sent to the workers once (its size is that of a vocabulary, not of data).
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivetables.llm.common import exact, held, hex_sha256, output, text_of

BLOCK = 256  # symbols that the window moves at least
CACHE = 200_000  # words lately met whose ids a worker keeps, and as many of before
PIECES = 1 << 16  # words in hand at a time, however long the text
OUT_BYTES = 2 << 20  # text in an output batch
SUFFIX = "</w>"
# Fixed value: the pattern that splits a normalised text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = itertools.count(256)
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Transducer:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, file: bytes):
        parsed = json.loads(file)
        model = parsed["model"]
        ids = dict(model["vocab"])
        self.special = {x["content"]: x["id"] for x in parsed["added_tokens"]}
        ids |= self.special
        self.tokens = [""] * (max(ids.values()) + 1)
        for token, number in ids.items():
            self.tokens[number] = token
        alphabet = byte_alphabet()
        self.inner = [ids[c] for c in alphabet]
        self.last = [ids[c + SUFFIX] for c in alphabet]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merged = [ids[u + v] for u, v in pairs]
        self.none = len(pairs)  # the rank of what doesn't merge
        self.ranks: dict[int, int] = {}
        for rank, (u, v) in enumerate(pairs):
            self.ranks.setdefault(ids[u] << 20 | ids[v], rank)
        self.lookahead = lookahead(pairs)
        self.byte_of = {c: b for b, c in enumerate(alphabet)}
        self.whole = [self.whole_text(token) for token in self.tokens]
        self.words = regex.compile(WORDS)
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.cache: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Tokens of a word that has no more symbols: the lowest rank first, leftmost first."""
        get, none = self.ranks.get, self.none
        ranks = [get(u << 20 | v, none) for u, v in itertools.pairwise(symbols)]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            symbols[i : i + 2] = [token] = [self.merged[least]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(symbols[i - 1] << 20 | token, none)
            if i < len(ranks):
                ranks[i] = get(token << 20 | symbols[i + 1], none)
        return symbols

    def stream(self, symbols: Iterable[int]) -> Iterator[int]:
        """Tokens of a word, emitted once they are stable; holds one window of symbols."""
        source, size = iter(symbols), self.lookahead + BLOCK
        window: list[int] = []
        while True:
            window.extend(itertools.islice(source, size + 1 - len(window)))
            if len(window) <= size:  # the word ends here
                yield from self.merge(window)
                return
            stable = len(window) - self.lookahead
            end = 0
            for token in self.merge(window.copy()):
                end += self.symbols_in(token)
                if end > stable:
                    end -= self.symbols_in(token)
                    break
                yield token
            del window[:end]

    def symbols_in(self, token: int) -> int:
        return len(self.tokens[token].removesuffix(SUFFIX))

    def word(self, word: str) -> bytes:
        """Ids of a word as 32-bit numbers."""
        if len(self.cache) >= CACHE:
            self.before, self.cache = self.cache, {}
        found = self.before.get(word)
        if found is None:
            raw = word.encode("utf-8", "replace")
            inner = self.inner
            symbols = [inner[b] for b in raw]
            symbols[-1] = self.last[raw[-1]]
            whole = len(symbols) <= self.lookahead + BLOCK
            found = array("i", self.merge(symbols) if whole else self.stream(symbols)).tobytes()
        if len(word) <= 64:
            self.cache[word] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        parts = []
        segments = self.specials.split(text) if self.specials and "<" in text else [text]
        for segment in segments:
            if segment in self.special:
                parts.append(array("i", [self.special[segment]]).tobytes())
                continue
            # each character by itself, so no final sigma
            lowered = unicodedata.normalize("NFC", segment).replace("Σ", "σ").lower()
            found = (m.group() for m in self.words.finditer(lowered))
            if len(lowered) < PIECES:
                found = iter(self.words.findall(lowered))
            get, word = self.cache.get, self.word
            while block := list(itertools.islice(found, PIECES)):
                parts.append(b"".join([get(w) or word(w) for w in block]))
        return np.frombuffer(b"".join(parts), "int32")

    def decode(self, ids: np.ndarray) -> str:
        """As the library does for a file without a decoder: the tokens' own strings, parted by spaces."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))

    def whole_text(self, token: str) -> str | None:
        """What the state machine gives for a token that begins and ends with whole characters."""
        if token in self.special:
            return token
        raw = bytes(self.byte_of.get(c, 0xFF) for c in token.removesuffix(SUFFIX))
        try:
            return raw.decode() + " " * token.endswith(SUFFIX)
        except UnicodeDecodeError:
            return None

    def text(self, ids: list[int]) -> str:
        """The words themselves, each followed by a space, from bytes to text token by token. Between
        tokens the state is that of ``Utf8``; tokens of whole characters leave it at rest."""
        try:
            return "".join(map(self.whole.__getitem__, ids))
        except TypeError:  # a token that is cut within a character has no text by itself
            machine, out = Utf8(), []
        for number in ids:
            if (piece := self.whole[number]) is not None:
                out.append(machine.end() + piece)
                continue
            token = self.tokens[number]
            for c in token.removesuffix(SUFFIX):
                out.append(machine.feed(self.byte_of[c]))
            if token.endswith(SUFFIX):
                out.append(machine.end() + " ")
        return "".join(out) + machine.end()


class Utf8:
    """Bytes to text one byte at a time; what can't be part of a character becomes U+FFFD."""

    def __init__(self):
        self.value, self.missing, self.low, self.high = 0, 0, 0x80, 0xBF

    def feed(self, byte: int) -> str:
        if self.missing:
            if self.low <= byte <= self.high:
                self.value, self.missing = self.value << 6 | byte & 0x3F, self.missing - 1
                self.low, self.high = 0x80, 0xBF
                return "" if self.missing else chr(self.value)
            return self.end() + self.feed(byte)
        if byte < 0x80:
            return chr(byte)
        if 0xC2 <= byte <= 0xDF:
            self.value, self.missing = byte & 0x1F, 1
        elif 0xE0 <= byte <= 0xEF:
            self.value, self.missing = byte & 0x0F, 2
            # no over-long forms, no surrogates
            self.low, self.high = 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
        elif 0xF0 <= byte <= 0xF4:
            self.value, self.missing = byte & 0x07, 3
            self.low, self.high = 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
        else:
            return "�"
        return ""

    def end(self) -> str:
        cut, self.missing, self.low, self.high = self.missing, 0, 0x80, 0xBF
        return "�" if cut else ""


def lookahead(pairs: list[tuple[str, str]]) -> int:
    """Sufficient lookahead of a merge list in symbols: the heaviest chain of merges, each of a higher
    rank than the one before and with that one's left part on the left spine of its right part."""
    left = {}
    for u, v in pairs:
        left.setdefault(u + v, u)
    heaviest: dict[str, int] = {}  # over the merges of higher rank, by token on the spine
    most = 0
    for u, v in reversed(pairs):
        weight = len(u) + heaviest.get(u, 0)
        most = max(most, weight)
        spine: str | None = v
        while spine is not None:
            if heaviest.get(spine, 0) < weight:
                heaviest[spine] = weight
            spine = left.get(spine)
    return most


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, ids, decoded, text`` of every row of ``docs``, with no special tokens added: ``decoded`` as
    the library gives it, ``text`` the words that the state machine reads from the ids.

    A special token's own string in a text becomes that token. Null and empty texts, and such
    of white space alone, have no ids and decode to the empty string. Repeated rows stay. A table
    without rows gives none; columns beside ``doc_id`` and ``text`` are not read, whatever their names.
    Memory holds a batch of rows; a long text adds its ids, its words are read in blocks.
    """
    with open(vocabulary, "rb") as file:
        content = file.read()
    digest = hashlib.sha256(content).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = held(f"bpe {digest}", lambda: Transducer(shared.value))
        for batch in batches:
            keys, texts = batch.column("doc_id"), batch.column("text")
            begin, size, ids, decoded, words = 0, 0, [], [], []
            for row, text in enumerate(texts):
                text = text.as_py()
                ids.append(transducer.encode(text))
                decoded.append(transducer.decode(ids[-1]))
                words.append(transducer.text(ids[-1].tolist()))
                size += len(text)
                if size >= OUT_BYTES or row == len(texts) - 1:
                    offsets = np.cumsum([0, *map(len, ids)], dtype="int32")
                    values = pa.array(np.concatenate(ids), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [
                            keys[begin : row + 1],
                            pa.ListArray.from_arrays(pa.array(offsets), values),
                            pa.array(decoded, pa.string()),
                            pa.array(words, pa.string()),
                        ],
                        ["doc_id", "ids", "decoded", "text"],
                    )
                    begin, size, ids, decoded, words = row + 1, 0, [], [], []

    docs = exact(docs, "doc_id", "text")
    return docs.select("doc_id", text_of(docs).alias("text")).mapInArrow(
        encode, output(docs, "ids array<int>, decoded string, text string")
    )


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, text_sha256`` of what ``encode_documents`` gives, and
    ``more`` of its columns."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        hex_sha256(ids).alias("ids_sha256"),
        hex_sha256(F.col("decoded")).alias("decoded_sha256"),
        hex_sha256(F.col("text")).alias("text_sha256"),
        *more,
    )
