"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, schemes and the words
that announce an identifier. From each anchor a small parser expands to the left and right by
fixed rules, and a check (range, digit count, Luhn, mod 97) accepts or drops the whole match. No parser
looks further than its own match, so the work is linear in the text.

Kinds ``email``, ``ip``, ``card`` and ``phone`` are what the usual patterns match, leftmost and without
overlap within a kind. Kinds ``login`` (credentials in a URL), ``iban``, ``account``, ``ssn`` and ``secret``
(the value given to a password, token or key) need an announcing anchor; where one of these but a
``login`` overlaps one of the first four, that one stays alone.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivetables.llm.common import exact, output, text_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "iban", "account", "ssn", "secret")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
LOGIN = re.compile(r"://[^\s/@:]++:[^\s/@]++@[A-Za-z0-9.-]+")
LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
SCHEME = LETTERS | frozenset("0123456789+.-")
IBAN = re.compile(r"[\s:.#]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})")
ACCOUNT = re.compile(r"(?:[\s.]{0,2}(?i:number|no|nr))?[\s.:#]{0,3}([0-9](?:[ -]?[0-9]){5,16})(?![0-9])")
SSN = re.compile(r"(?i:[\s.]{0,2}(?:number|no|nr))?[\s.:#]{0,3}([0-9]{3})([ -])([0-9]{2})\2([0-9]{4})(?![0-9])")
VALUE = re.compile(r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
LEAST_VALUE = 12  # characters of a secret, letters and digits among them
# Words that announce an identifier.
ACCOUNT_CUES = ("account", "acct", "konto", "compte", "cuenta")
IBAN_CUES = ("iban",)
SSN_CUES = ("ssn", "social security")
SECRET_CUES = ("password", "passwd", "secret", "token", "apikey", "apiKey", "api_key", "api-key", "access_key")


@lru_cache(1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for anchor in "@+0123456789":
        found.add_word(anchor, "0" if anchor.isdigit() else anchor)
    found.add_word("://", "://")
    cued = {"account": ACCOUNT_CUES, "iban": IBAN_CUES, "ssn": SSN_CUES, "secret": SECRET_CUES}
    for kind, cues in cued.items():
        for cue in cues:
            for form in {cue, cue.capitalize(), cue.title(), cue.upper()}:
                found.add_word(form, kind)
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(account: str) -> bool:
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by kind as in ``KINDS``, then by start."""
    anchors: dict[str, list[int]] = {}
    for end, what in automaton().iter(text):
        anchors.setdefault(what, []).append(end)
    found: list[tuple[str, int, int]] = []
    done = 0
    for at in anchors.get("@", ()):
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        if begin < at and (m := DOMAIN.match(text, at + 1)):
            done = m.end()
            found.append(("email", begin, done))
    digits = anchors.get("0", ())
    done = 0
    for at in digits:
        if at >= done:
            if m := IP.match(text, at):
                done = m.end()
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.groups()):
                    found.append(("ip", at, done))
            else:
                done = DIGITS.match(text, at).end()
    done = 0
    for at in digits:
        if at >= done and (m := CARD.match(text, at)):
            done = m.end()
            number = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(number) <= 19 and luhn(number):
                found.append(("card", at, done))
    done = 0
    for at in anchors.get("+", ()):
        if at >= done and (m := PHONE.match(text, at)):
            done = m.end()
            if 8 <= sum(map(str.isdigit, m.group())) <= 15:
                found.append(("phone", at, done))
    taken = sorted((start, end) for _, start, end in found)
    starts = [start for start, _ in taken]
    ends = [0, *accumulate((end for _, end in taken), max)]  # the last end of the first so many spans
    found += _logins(text, anchors)
    for parser in (_ibans, _accounts, _ssns, _secrets):
        for kind, begin, end in parser(text, anchors):
            if ends[bisect_left(starts, end)] <= begin:
                found.append((kind, begin, end))
    return found


def _logins(text: str, anchors: dict) -> Iterator[tuple[str, int, int]]:
    done = 0
    for last in anchors.get("://", ()):
        colon = last - 2
        if colon >= done and (m := LOGIN.match(text, colon)):
            begin = colon
            while begin > done and text[begin - 1] in SCHEME:
                begin -= 1
            while begin < colon and text[begin] not in LETTERS:
                begin += 1
            done = m.end()
            yield "login", begin, done


def _ibans(text: str, anchors: dict) -> Iterator[tuple[str, int, int]]:
    done = 0
    for last in anchors.get("iban", ()):
        if last >= done and (m := IBAN.match(text, last + 1)):
            begin, end = m.span(1)
            # the longest stretch ending with a word that passes; a blank may be part of the number
            for stop in range(end, begin + 14, -1):
                account = text[begin:stop].replace(" ", "")
                whole = text[stop - 1] != " " and not text[stop : stop + 1].isalnum()
                if whole and 15 <= len(account) <= 34 and mod97(account):
                    done = stop
                    yield "iban", begin, stop
                    break


def _accounts(text: str, anchors: dict) -> Iterator[tuple[str, int, int]]:
    done = 0
    for last in anchors.get("account", ()):
        if last >= done and (m := ACCOUNT.match(text, last + 1)):
            done = m.end(1)
            yield "account", m.start(1), done


def _ssns(text: str, anchors: dict) -> Iterator[tuple[str, int, int]]:
    """Numbers of the form that is given out: no part is all zeros, the first neither 666 nor 9xx."""
    done = 0
    for last in anchors.get("ssn", ()):
        if last >= done and (m := SSN.match(text, last + 1)):
            area, group, serial = m.group(1, 3, 4)
            if area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000":
                done = m.end()
                yield "ssn", m.start(1), done


def _secrets(text: str, anchors: dict) -> Iterator[tuple[str, int, int]]:
    done = 0
    for last in anchors.get("secret", ()):
        if last >= done and (m := VALUE.match(text, last + 1)):
            done = m.end()
            value = m.group(1).rstrip(".")
            mixed = any(map(str.isdigit, value)) and any(map(str.isalpha, value))
            if mixed and len(value) >= LEAST_VALUE:
                yield "secret", m.start(1), m.start(1) + len(value)


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def find_pii(docs: DataFrame) -> DataFrame:
    """``doc_id, found`` of every row of ``docs``: the array of ``(kind, start, end)`` in its text, in code
    points, end exclusive, by kind and start. Null and empty texts have none; repeated rows and ids stay. A
    table without rows gives none; columns beside ``doc_id`` and ``text`` are not read, whatever their names.
    A text of any length is searched whole, in time that grows with it, by one task.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                [{"kind": k, "start": s, "end": e} for k, s, e in spans(text.as_py())]
                for text in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, pa.list_(SPAN))], ["doc_id", "found"]
            )

    docs = exact(docs, "doc_id", "text")
    return docs.select("doc_id", text_of(docs).alias("text")).mapInArrow(
        find, output(docs, "found array<struct<kind string, start bigint, end bigint>>")
    )


def joined(found: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


def summary(found: DataFrame) -> DataFrame:
    """``doc_id``, the number of spans of each of the first four kinds, ``base_sha256`` and ``spans``."""

    def of(*kinds: str) -> Column:
        return F.filter("found", lambda x: x["kind"].isin(*kinds))

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(of(*BASE)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )
