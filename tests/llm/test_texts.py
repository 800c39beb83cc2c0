"""Operators that look at each document by itself: encoding, personal data, rules, quality, licences."""

import hashlib
import json
import random
import re
import textwrap
import time
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from archivetables.llm import bpe, common, fertility, licences, pii, quality
from archivetables.llm.queries import QUERIES, vocabularies
from tests.llm.conftest import ODD, SF
from workload.check import rows_of

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def transducer():
    with open(WORDS, "rb") as file:
        return bpe.Transducer(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def documents():
    return duckdb.sql(f"SELECT doc_id + 1000, text FROM '{SF}/documents.parquet'").fetchall()


# encoding


def test_encoding_is_the_librarys(spark, make, library):
    rows = [*ODD, (20, "it's <|endoftext|> ΣΑΣ ＡＢＣ"), (21, "<|startoftext|>"), (22, "😀👩‍👩‍👧")]
    got = bpe.encode_documents(make(rows), WORDS).select("doc_id", "ids", "decoded").collect()
    assert len(got) == len(rows)
    want = []
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((key, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert bpe.encode_documents(make([]), WORDS).count() == 0


def test_random_texts_encode_alike(transducer, library):
    dice = random.Random(5)
    alphabets = ["aeinrst", "abcXYZ's 'll 12½", "中文字한글é\x85\xa0　 ", "<|endoftext|> "]
    for i in range(1500):
        text = "".join(dice.choices(dice.choice(alphabets), k=dice.choice((1, 7, 40, 300))))
        assert transducer.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_long_words_stream_through_a_window(transducer, library):
    dice = random.Random(6)
    for alphabet in ("aeinrst", "th", "a", "abcdefghijklmnopqrstuvwxyz"):
        text = "".join(dice.choices(alphabet, k=6000))
        assert transducer.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_tokens_leave_before_the_word_ends(transducer):
    read = []

    def symbols():
        for i in range(10_000):
            read.append(i)
            yield transducer.inner[97 + i % 7]

    next(transducer.stream(symbols()))
    assert len(read) <= transducer.lookahead + bpe.BLOCK + 1


def test_lookahead_of_a_small_list():
    # "b" after "a" takes it from "xa": one merge of one symbol, then of "x"
    assert bpe.lookahead([("a", "b")]) == 1
    assert bpe.lookahead([("a", "b"), ("x", "a")]) == 2
    assert bpe.lookahead([("x", "a"), ("a", "b")]) == 1


def test_stable_tokens_of_random_merge_lists():
    """What is emitted behind the lookahead is what the whole word has, for lists made at random."""
    dice = random.Random(7)
    alphabet = [c + bpe.SUFFIX for c in bpe.byte_alphabet()] + bpe.byte_alphabet()
    for _ in range(30):
        pairs, tokens = [], ["a", "b", "c"]
        for _ in range(12):
            u, v = dice.choice(tokens), dice.choice(tokens)
            if u + v not in tokens:
                pairs.append((u, v))
                tokens.append(u + v)
        vocab = {t: i for i, t in enumerate(dict.fromkeys(alphabet + tokens))}
        file = {"model": {"vocab": vocab, "merges": pairs}, "added_tokens": []}
        small = bpe.Transducer(json.dumps(file).encode())
        symbols = [vocab[c] for c in dice.choices("abc", k=400)]
        whole = small.merge(symbols.copy())
        for cut in range(20, 400, 37):
            end, stable = 0, []
            for token in small.merge(symbols[:cut]):
                end += small.symbols_in(token)
                if end <= cut - small.lookahead:
                    stable.append(token)
            assert whole[: len(stable)] == stable


def test_words_come_back_from_ids(transducer):
    text = "naïve words, 中文 and 😀 emoji"
    parts = re.findall(r"[^\W\d_]+|[^\w\s]+", text)
    assert transducer.text(transducer.encode(text)) == " ".join(parts) + " "


def test_any_ids_become_text_as_their_bytes_do(transducer):
    """Each stretch up to a word's end or a special token is decoded by itself."""
    dice = random.Random(10)
    partial = [i for i, piece in enumerate(transducer.whole) if piece is None]
    for _ in range(2000):
        ids = dice.choices(partial, k=4) + dice.choices(range(len(transducer.tokens)), k=3)
        dice.shuffle(ids)
        want, held = "", b""
        for token in map(transducer.tokens.__getitem__, ids):
            special = token in transducer.special
            if not special:
                held += bytes(transducer.byte_of[c] for c in token.removesuffix(bpe.SUFFIX))
            if special or token.endswith(bpe.SUFFIX):
                want += held.decode(errors="replace") + (token if special else " ")
                held = b""
        assert transducer.text(ids) == want + held.decode(errors="replace"), ids


def test_documents_are_decoded_by_the_state_machine(spark, make, transducer):
    texts = ["naïve words, 中文 and 😀 emoji", "  ", None, "a <|endoftext|> b", "ﬁ \u0001 \ufffd"]
    got = bpe.encode_documents(make(list(enumerate(texts))), WORDS)
    digest = {r.doc_id: r.text_sha256 for r in bpe.digests(got).collect()}
    for row in got.collect():
        ids = transducer.encode(texts[row.doc_id] or "").tolist()
        assert row.ids == ids and row.text == transducer.text(ids)
        assert digest[row.doc_id] == hashlib.sha256(row.text.encode()).hexdigest()


def test_bytes_to_text_as_python_does():
    dice = random.Random(8)
    for _ in range(3000):
        raw = bytes(dice.choices((0x41, 0xC3, 0xA9, 0xE0, 0x80, 0xED, 0xA0, 0xF0, 0x9F, 0xF4, 0x90, 0xFF), k=8))
        machine = bpe.Utf8()
        got = "".join(map(machine.feed, raw)) + machine.end()
        assert got == raw.decode(errors="replace"), raw


# personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    def good(kind, match):
        digits = [int(c) for c in match if c in "0123456789"]
        if kind == "ip":
            return all(int(part) <= 255 for part in match.split("."))
        if kind == "card":
            doubled = [2 * d - 9 * (d > 4) if i % 2 else d for i, d in enumerate(digits[::-1])]
            return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return [
        (kind, *m.span())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text)
        if good(kind, m.group())
    ]


def test_base_spans_are_what_the_patterns_match():
    dice = random.Random(9)
    for _ in range(8000):
        text = "".join(dice.choices("a.@-+ 0125().%_9é\n", k=dice.choice((4, 30, 90))))
        assert [s for s in pii.spans(text) if s[0] in pii.BASE] == plain_spans(text), text


def test_personal_data_of_documents(spark, make):
    rows = [*ODD, *documents(), (30, "card 4041 8949 7460 8795, 1.2.3.999 and 10.0.0.1 x@y.zz")]
    got = pii.summary(pii.find_pii(make(rows))).collect()
    by_text = {}
    for key, text in rows:
        spans = plain_spans(text or "")
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        counts = tuple(sum(k == kind for k, _, _ in spans) for kind in pii.BASE)
        by_text[key] = (*counts, hashlib.sha256(listed.encode()).hexdigest())
    for row in got:
        if row.doc_id is not None:
            assert tuple(row)[1:6] == by_text[row.doc_id]
    assert len(got) == len(rows)
    assert pii.find_pii(make([])).count() == 0


def test_added_kinds_need_a_cue_and_a_valid_number():
    def kinds(text):
        return [(k, text[s:e]) for k, s, e in pii.spans(text) if k not in pii.BASE]

    assert kinds("IBAN: DE89 3704 0044 0532 0130 00 today") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("IBAN: DE88 3704 0044 0532 0130 00 today") == []
    assert kinds("DE89 3704 0044 0532 0130 00") == []
    assert kinds("account no. 12345678.") == [("account", "12345678")]
    assert kinds("get ftp://bob:pw@host.com/x") == [("login", "ftp://bob:pw@host.com")]
    assert kinds("get ftp://bob:pw@localhost/x") == [("login", "ftp://bob:pw@localhost")]


def test_cued_secrets_and_numbers():
    def kinds(text):
        return [(k, text[s:e]) for k, s, e in pii.spans(text) if k not in pii.BASE]

    for text in ('token = "a1b2c3d4e5f6"', "API_KEY: a1b2c3d4e5f6.", "'Password' : 'a1b2c3d4e5f6'"):
        assert kinds(f"see {text} here") == [("secret", "a1b2c3d4e5f6")]
    for text in ("token = a1b2c3d4e5f", "token a1b2c3d4e5f6", "secret: understanding", "token: 123456789012"):
        assert kinds(f"see {text} here") == []
    assert kinds("SSN: 123-45-6789") == kinds("social security number 123-45-6789") == [("ssn", "123-45-6789")]
    for text in ("123-45-6789", "SSN 000-45-6789", "SSN 123-45 6789", "SSN 123-45-67891", "SSN 912-45-6789"):
        assert kinds(text) == []
    # an e-mail address that overlaps a value stays alone
    assert kinds("token=a1b2c3d4e5f6@host.com") == []


def test_many_spans_take_linear_time():
    pair = "bob@host.com account no. 12345678 token=a1b2c3d4e5f6 ftp://a:b@c.de "
    begin = time.perf_counter()
    found = Counter(kind for kind, _, _ in pii.spans(pair * 20_000))
    assert found["account"] == found["secret"] == found["login"] == 20_000
    pii.spans("token=" * 100_000), pii.spans("account no. " * 100_000), pii.spans("ssn:" * 100_000)
    assert time.perf_counter() - begin < 20


def test_logins_are_whole():
    def logins(text):
        return [text[s:e] for k, s, e in pii.spans(text) if k == "login"]

    long = "k" * 200
    for login in (
        "https://bob:s3cr3t!x@db.example.com",  # its e-mail address holds the last letter of the password only
        f"https://bob:{long}@localhost",
        f"https://{long}:{long}@localhost",
        f"https://bob:{long}$@db.example.com",
        "a.scheme+of-more.than+16-characters://bob:pw@localhost",
    ):
        text = f"see 1:{login}/x"
        assert logins(text) == [login]
        assert [s for s in pii.spans(text) if s[0] in pii.BASE] == plain_spans(text)
    assert logins("x://a:b@h://c:d@i") == ["x://a:b@h", "://c:d@i"]
    assert logins("://a" * 50_000 + ":b" * 50_000) == []


# rules


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, at = text.split("\n"), {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i : i + 5]), []).append(i)
    inside = {k for found in at.values() if len(found) > 1 for i in found for k in range(i, i + 5)}
    repeated = sum(
        bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in lines[:i] for i, line in enumerate(lines)
    )
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (len(words), sum(map(len, words)), symbols, repeated, len(inside), failed)


def test_base_counts(spark, make):
    rows = [*ODD, *documents(), (40, "a a a a a a a a a a a\x0bb\n\x1f\n\x1f\n x\n x\n"), (41, "#|<> $ b" * 9)]
    rows.append((42, "\x00 \u200b \x01 \ufeff"))  # a normaliser leaves nothing of these
    want = {key: plain_counts(text or "") for key, text in rows if key is not None}
    got = fertility.judge_documents(make(rows), **vocabularies()).collect()
    assert len(got) == len(rows)
    for row in got:
        if row.doc_id is not None:
            assert tuple(row)[1:7] == want[row.doc_id], row.doc_id
        assert not (row.base_failed and row.kept)
    assert fertility.judge_documents(make([]), **vocabularies()).count() == 0


def test_bands_reject_what_is_no_prose(spark, make):
    prose = "The committee met on Tuesday to discuss the new bridge, and nobody was happy with its price. "
    tail = "Still, all agreed that the old one had to go before winter, so work begins next month."
    dice = random.Random(1)
    noise = " ".join(dice.choices("aaaa bbbb cccc dddd".split(), k=400))
    emoji = " ".join("".join(chr(0x1F300 + dice.randrange(400)) for _ in range(6)) for _ in range(60))
    rows = [(1, prose + tail), (2, noise), (3, "a" + emoji)]
    kept = {r.doc_id: r.kept for r in fertility.judge_documents(make(rows), **vocabularies()).collect()}
    assert kept == {1: True, 2: False, 3: False}


def test_clean_documents_pass(spark):
    judged = QUERIES["op2_fertility"](spark, SF).toPandas().set_index("doc_id")
    labels = duckdb.sql(f"SELECT * FROM '{SF}/labels.parquet' WHERE quality = 1").df().doc_id
    clean = judged.loc[labels]
    assert (clean.kept | clean.base_failed).all()


def test_kept_documents_are_whole_rows(spark, make):
    table = make([(1, "We met on Tuesday to talk about a bridge nobody wants."), (2, "no"), (None, None)])
    kept = fertility.kept_documents(table, **vocabularies())
    assert kept.schema == table.schema
    assert [r.doc_id for r in kept.collect()] == [1]


# quality


def test_rules_tell_quality_apart(spark):
    scored = QUERIES["op1_quality"](spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    labels = duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").df()
    both = scored.join(labels.set_index("doc_id"), how="inner")
    unseen = both[both.held_out]
    assert len(scored) == 1000 and len(unseen) > 50
    assert (unseen.predicted == unseen.quality).mean() > 0.95
    assert unseen.predicted[unseen.quality == 1].mean() > 0.97


def test_scores_of_odd_rows_and_few_labels(spark, make):
    table = make(ODD)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    scored = quality.score_documents(table, none).collect()
    assert len(scored) == len(ODD) and {r.score for r in scored} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(9)] + [(None, 0), (3, None)], "doc_id bigint, quality int")
    assert all(r.score > 0.5 and r.predicted == 1 for r in quality.score_documents(table, ones).collect())
    assert quality.score_documents(make([]), ones).count() == 0


def test_held_out_rows_follow_the_checksum(spark, make):
    from zlib import crc32

    rows = quality.score_documents(
        make([(i, "x") for i in range(60)]), spark.createDataFrame([], "doc_id bigint, quality int")
    )
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows.collect())


def test_compiled_rules_say_what_the_conditions_say(spark, make):
    rule = quality.Rule((("words", True, 1.5), ("upper", False, 0.25)))
    model = quality.RuleModel(0.5, ((rule, 2.0),))
    rows = quality.with_statistics(make([(1, "a b c d e f"), (2, "A B C D E F"), (3, "a")]))
    got = {r.doc_id: r.s for r in rows.select("doc_id", model.score().alias("s")).collect()}
    assert np.allclose([got[1], got[2], got[3]], 1 / (1 + np.exp([-2.5, -0.5, -0.5])))


# licences


def test_licences(spark, make):
    mit = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software "
        "and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, "
        "including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, "
        "subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be "
        "included in all\ncopies or substantial portions of the Software.\n"
    )
    later = (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 3 of the License, "
        "or (at your option) any later version.\n"
    )
    rows = [
        *ODD,
        (50, "Some prose.\nLicensed under the Apache License, Version 2.0.\nMore."),
        (51, mit + "Text. Released under the MIT License."),
        (52, "LICENSED UNDER CC BY-NC 4.0."),
        (53, "A licence is a permission; version 2 of the rights."),
        (54, "Licensed under the MIT License. Licensed under CC BY 4.0."),
        (55, later.replace("software: you", "software you")),
    ]
    got = {r.doc_id: (r.licences, r.n_sentences) for r in licences.scan_licences(make(rows)).collect()}
    assert got[50] == ("Apache-2.0", 1)
    assert got[51] == ("MIT", 3)
    assert got[52] == ("CC-BY-NC-4.0", 1)
    assert got[53] == ("", 0)
    assert got[54] == ("MIT,CC-BY-4.0", 2)
    assert got[55] == ("GPL-3.0-or-later", 2)
    assert got[1] == got[2] == got[8] == ("", 0)
    assert licences.scan_licences(make([])).count() == 0


def test_licence_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = db.execute(licences.scan_sql()).df()
    assert rows_of(QUERIES["op3_license_scan"](spark, SF).toPandas()) == rows_of(want)


def test_licence_scan_runs_no_python(spark):
    plan = QUERIES["op3_license_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def wrapped(text, width):
    return "\n".join(textwrap.wrap(text, width, break_long_words=False)) if width else text


WIDTHS = (None, 1, 12, 40, 50, 55, 60, 72, 79)


def scanned(make, texts):
    rows = licences.scan_licences(make(list(enumerate(texts, 100)))).collect()
    return [(r.licences, r.sentence_ids) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_sentences_over_any_number_of_lines(spark, make):
    keys = ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")
    mit = ". ".join(licences.SENTENCES[key] for key in keys) + "."
    got = scanned(make, [wrapped(mit, width) for width in WIDTHS])
    assert got == [("MIT", ",".join(keys))] * len(WIDTHS)
    rest = {k: x for k, x in licences.SENTENCES.items()}
    for width in (None, 1):
        for (key, text), (_, ids) in zip(rest.items(), scanned(make, [wrapped(x, width) for x in rest.values()])):
            # a word to a line, shorter known sentences in it begin pieces of their own
            inner = [k for k, x in rest.items() if f" {x} " in f" {text} "]
            assert sorted(ids.split(",")) == sorted(inner if width else [key])


def plain_scan(text):
    lowered = text.translate(str.maketrans(licences.UPPER, licences.LOWER))
    pieces = [re.sub("[^a-z0-9]+", " ", p).strip() for p in re.split(licences.CUT, lowered)]
    pieces, known = [p for p in pieces if p], {x: k for k, x in licences.SENTENCES.items()}
    runs = [" ".join(pieces[i:j]) for i in range(len(pieces)) for j in range(i + 1, len(pieces) + 1)]
    return ",".join(known[run] for run in runs if run in known)


def test_runs_of_random_pieces(spark, make):
    dice = random.Random(10)
    cuts = ["\n", "\n", " ", " ", " ", ".\t", "; ", " * ", "\r\n", "\n\n", " \n \n", ",", ":", "é", "中"]
    texts = []
    for _ in range(300):
        words = " ".join(dice.choices(list(licences.SENTENCES.values()), k=dice.choice((1, 2, 3)))).split()
        texts.append("".join(word + dice.choice(cuts[: dice.choice((3, 5, 15))]) for word in words))
    parts = {a for a, _ in licences.JOINED}
    for text, (_, ids) in zip(texts, scanned(make, texts)):
        if not parts & set(ids.split(",")):
            assert ids == plain_scan(text), text


def test_gnu_notices_with_a_comma(spark, make):
    notice = (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} "
        "as published by the Free Software Foundation{} either version {} of the License, or (at your option) "
        "any later version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY."
    )
    gpl, lgpl, agpl = (f"{name}General Public License" for name in ("", "Lesser ", "Affero "))
    cases = [
        (notice.format(gpl, ",", 3), "GPL-3.0-or-later"),
        (notice.format(gpl, ";", 3), "GPL-3.0-or-later"),
        (notice.format(gpl, ",", 2), "GPL-2.0-or-later"),
        (notice.format(gpl, ";", 2), "GPL-2.0-or-later"),
        (notice.format(lgpl, ",", 3), "LGPL-3.0-or-later"),
        (notice.replace("program", "library").format(lgpl, ";", "2.1"), "LGPL-2.1-or-later"),
        (notice.format(agpl, ",", 3), "AGPL-3.0-or-later"),
    ]
    texts = [wrapped(text, width) for text, _ in cases for width in WIDTHS]
    texts += [text.replace("Foundation, ", "Foundation,\n") for text, _ in cases]
    want = [licence for _, licence in cases for _ in WIDTHS] + [licence for _, licence in cases]
    assert [found for found, _ in scanned(make, texts)] == want


def test_cues_hold_over_line_ends(spark, make):
    notice = "This is free and unencumbered software released into the public{}domain."
    rows = [(i, notice.format(gap)) for i, gap in enumerate((" ", "\n", "  ", "\t", "\n * "))]
    db = duckdb.connect()
    db.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    got = licences.scan_licences(make(rows)).toPandas()
    assert rows_of(got) == rows_of(db.execute(licences.scan_sql()).df())
    assert set(got.licences) == {"Unlicense"}


def test_a_worker_holds_one_large_object():
    made = [common.held(key, lambda key=key: [key]) for key in ("a", "a", "b")]
    assert made[0] is made[1] and made[2] == ["b"] and list(common._held) == ["b"]
    assert common.held("a", lambda: ["new"]) == ["new"]
    common._held.clear()
