"""Secrets by linking the parts of credentials.

A scan of each text finds strong secrets, reported by themselves, and weak parts: access identifiers,
secrets and endpoints. The parts of all documents become rows, and an interval join within scopes finds
those with a complement: parts of a scope (a block of lines without an empty one; a ``[section]`` line
begins another) are counted by intervals of ``REACH`` code points, and a weak part meets the counts of its
own interval and the two beside it, which hold everything within reach. It is reported only if there is

* for an identifier (``login``): a secret, weak or strong
* for a secret after a cue (``phrase``): an identifier or an endpoint
* for a random string (``random``): an identifier
* for an endpoint (``endpoint``): a secret after a cue, weak or strong.

No pairs are made: an interval is one row with the first and last place of each role, so a text with
parts everywhere costs as much as its length.

Null and empty texts have no spans. Repeated rows, and repeated or null ``doc_id``, stay rows of their own,
linked each within itself. An empty table gives no rows. Long texts are read whole, in time that grows
with their length. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivetables.llm.common import exact, output, text_of, written

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "login", "phrase", "random", "endpoint")
REACH = 600  # code points between the beginnings of parts that belong together

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_VALUE = 12  # characters of an assigned value

# fixed values: names that announce a part, before a colon or an equals sign
LOGIN_CUES = ("access key id", "client id", "app id", "account id", "account name", "tenant id", "user name", "user", "login")
PHRASE_CUES = (
    "secret access key", "secret key", "client secret", "private key", "access token", "auth token", "signing key",
    "passphrase", "password", "passwd", "secret", "token", "api key", "pass", "pwd", "credential", "credentials",
)
ENDPOINT_CUES = ("endpoint", "host name", "host", "server", "database", "base url", "url", "bucket")


def _assigned(cues: tuple[str, ...], value: str) -> re.Pattern:
    """A value after one of the names, which may stand behind a prefix that ends with ``_``, ``-`` or ``.``."""
    names = "|".join(cue.replace(" ", "[ _-]?") for cue in cues)
    return re.compile(rf"(?<![A-Za-z0-9])(?:{names})[\"']?[\x20\t]{{0,8}}[:=][\x20\t]{{0,8}}[\"']?({value})", re.ASCII | re.IGNORECASE)


LOGIN = _assigned(LOGIN_CUES, r"[A-Za-z0-9@._+-]{3,}")
PHRASE = _assigned(PHRASE_CUES, r"[^\s\"',;<>{}()]{6,}")
ENDPOINT = _assigned(ENDPOINT_CUES, r"[A-Za-z0-9][A-Za-z0-9.:/_-]{3,}")
ADDRESS = re.compile(r"[A-Za-z]{2,12}://[^\s\"'<>{}()]{3,}", re.ASCII)
RANDOM = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}", re.ASCII)
SCOPE = re.compile(r"\n(?=[\x20\t\r]*(?:\n|\[[\w .:-]{1,80}\][\x20\t\r]*(?:\n|\Z)))", re.ASCII)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the strong secrets, in order; kinds by their place in ``KINDS``."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _is_random(value: str) -> bool:
    """Capitals, small letters and digits mixed, without being words joined by capitals."""
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(value, value[1:], strict=False))
    cased = any(c.isupper() for c in value) and any(c.islower() for c in value)
    return cased and changes >= 4


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the weak parts that overlap no strong secret, in order."""
    found = [(m.start(1), 3, m.end(1)) for m in LOGIN.finditer(text)]
    found += [(m.start(1), 4, m.end(1)) for m in PHRASE.finditer(text)]
    found += [(m.start(), 5, m.end()) for m in RANDOM.finditer(text) if _is_random(m[0])]
    found += [(m.start(), 6, m.end()) for m in ADDRESS.finditer(text)]
    found += [(m.start(1), 6, m.end(1)) for m in ENDPOINT.finditer(text)]
    taken: list[list[int]] = []  # what the strong secrets cover, as stretches apart from each other
    for start, _, end in base:
        if taken and start <= taken[-1][1]:
            taken[-1][1] = max(end, taken[-1][1])
        else:
            taken.append([start, end])
    begins, kept, done = [t[0] for t in taken], [], {}
    for start, kind, end in sorted(set(found)):
        last = bisect_left(begins, end) - 1
        if start >= done.get(kind, 0) and (last < 0 or taken[last][1] <= start):
            kept.append((start, kind, end))
            done[kind] = end
    return kept


def _role(text: str, span: tuple[int, int, int]) -> str:
    """``login``, ``phrase``, ``random`` or ``endpoint``: what a span stands for when it complements another."""
    start, kind, end = span
    if kind == 2:
        return "" if text[start:end].isdigit() else "random"
    return ("phrase", "login", "", "login", "phrase", "random", "endpoint")[kind]


PART = pa.struct(
    [("scope", pa.int64()), ("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("role", pa.string())]
)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, parts`` of every row: the strong and weak parts of its text, each with its scope and role."""

    def parts_of(text: str) -> list[dict]:
        base = base_spans(text)
        spans = base + weak_spans(text, base)
        if not spans:
            return []
        scopes = [0, *(m.end() for m in SCOPE.finditer(text))]
        return [
            {
                "scope": scopes[bisect_right(scopes, span[0]) - 1],
                "start": span[0], "kind": span[1], "end": span[2],
                "role": _role(text, span),
            }
            for span in spans
        ]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [parts_of(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(parts, pa.list_(PART))], ["doc_id", "parts"]
            )

    docs = exact(docs, "doc_id", "text")
    part = "struct<scope bigint, start bigint, kind int, end bigint, role string>"
    return docs.select("doc_id", text_of(docs).alias("text")).mapInArrow(
        find, output(docs, f"parts array<{part}>")
    )


def linked_parts(parts: DataFrame) -> DataFrame:
    """The weak rows of ``parts`` (``_row, scope, start, kind, end, role``) with a complement in reach."""
    block = F.expr(f"start div {REACH}")
    roles = ("login", "phrase", "random", "endpoint")
    counted = parts.where("role <> ''").groupBy("_row", "scope", block.alias("block")).agg(
        *(F.min(F.when(F.col("role") == r, F.col("start"))).alias(f"first_{r}") for r in roles),
        *(F.max(F.when(F.col("role") == r, F.col("start"))).alias(f"last_{r}") for r in roles),
    )
    beside = F.explode(F.array(*(F.col("block") + i for i in (-1, 0, 1))))
    counted = counted.withColumn("block", beside).withColumnsRenamed({"_row": "c_row", "scope": "c_scope", "block": "c_block"})
    weak = parts.where(F.col("kind") >= len(BASE)).withColumn("block", block)

    def near(role: str) -> Column:
        """The nearest parts of a role on either side are the last before and the first after."""
        return F.coalesce(
            (F.abs(F.col(f"first_{role}") - F.col("start")) <= REACH)
            | (F.abs(F.col(f"last_{role}") - F.col("start")) <= REACH),
            F.lit(False),
        )

    complement = (
        F.when(F.col("kind") == 3, near("phrase") | near("random"))
        .when(F.col("kind") == 4, near("login") | near("endpoint"))
        .when(F.col("kind") == 5, near("login"))
        .otherwise(near("phrase"))
    )
    same = (
        (F.col("_row") == F.col("c_row"))
        & (F.col("scope") == F.col("c_scope"))
        & (F.col("block") == F.col("c_block"))
    )
    return weak.join(counted, same & complement, "left_semi").drop("block")


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, found`` of every row of ``docs``: the array of ``(start, kind, end)``, in code points, end
    exclusive, by start and then kind (its place in ``KINDS``)."""
    scanned = written(scan(docs).withColumn("_row", F.monotonically_increasing_id()), "secret-parts")
    linked = linked_parts(scanned.select("_row", F.explode("parts").alias("part")).select("_row", "part.*"))
    span = F.struct("start", "kind", "end")
    listed = linked.groupBy("_row").agg(F.collect_list(span).alias("linked"))
    strong = F.filter("parts", lambda p: p["kind"] < len(BASE))
    strong = F.transform(strong, lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end")))
    found = F.concat(strong, F.coalesce("linked", F.slice(strong, 1, 0)))
    return scanned.join(listed, "_row", "left").select("doc_id", F.array_sort(found).alias("found"))


def joined(found: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(found, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ","
    )


def summary(found: DataFrame) -> DataFrame:
    """``doc_id``, the number of spans of each strong kind, ``base_sha256`` and ``spans``."""
    def of(kind: str) -> Column:
        return F.filter("found", lambda x: x["kind"] == KINDS.index(kind))

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE]
    base = F.filter("found", lambda x: x["kind"] < len(BASE))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )
