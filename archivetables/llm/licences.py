"""Licence scan by sentence rules, with DataFrame functions alone.

A text is cut at line ends and sentence ends. Runs of pieces (a sentence may be wrapped over any number of
lines), normalised to lower-case letters and digits, are looked up among known licence sentences. What
is left of a document is the ordered sequence of their identifiers. Ordered
rules then replace runs of identifiers by a licence; an earlier rule takes its identifiers away
from the later ones, so a full text is not also reported as the shorter notices in it.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivetables.llm.common import exact, text_of

# Known licence sentences, normalised, by identifier.
SENTENCES = {
    "mit-name": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-the": "the mit license",
    "mit-short": "mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-2-name": "licensed under the bsd 2 clause license",
    "bsd-3-name": "licensed under the bsd 3 clause license",
    "apache-2-licensed": "licensed under the apache license version 2 0",
    "apache-2-you": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl-3-work": "this work is licensed under the gnu general public license version 3",
    "gpl-3-licensed": "licensed under the gnu general public license version 3",
    "gpl-2-work": "this work is licensed under the gnu general public license version 2",
    "gpl-2-licensed": "licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl-3-later": "either version 3 of the license or at your option any later version",
    "gpl-2-later": "either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "lgpl-3-licensed": "licensed under the gnu lesser general public license version 3",
    "agpl-3-licensed": "licensed under the gnu affero general public license version 3",
    "mpl-2-subject": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-2-licensed": "licensed under the mozilla public license version 2 0",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc-work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "rights": "all rights reserved",
}

# Licences by sequences of identifiers; earlier rules go first.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-2-you", "apache-use", "apache-copy", "apache-as-is", "apache-see")),
    ("Apache-2.0", ("apache-2-you", "apache-use", "apache-copy")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-3-later", "gpl-hope", "gpl-see")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-3-later")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-2-later", "gpl-hope", "gpl-see")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-2-later")),
    ("MIT", ("mit-name",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-the",)),
    ("MIT", ("mit-short",)),
    ("ISC", ("isc-grant",)),
    ("BSD-2-Clause", ("bsd-2-name",)),
    ("BSD-3-Clause", ("bsd-3-name",)),
    ("Apache-2.0", ("apache-2-licensed",)),
    ("Apache-2.0", ("apache-2-you",)),
    ("GPL-3.0", ("gpl-3-work",)),
    ("GPL-3.0", ("gpl-3-licensed",)),
    ("GPL-2.0", ("gpl-2-work",)),
    ("GPL-2.0", ("gpl-2-licensed",)),
    ("GPL", ("gpl-free",)),
    ("LGPL-3.0", ("lgpl-3-licensed",)),
    ("AGPL-3.0", ("agpl-3-licensed",)),
    ("MPL-2.0", ("mpl-2-subject",)),
    ("MPL-2.0", ("mpl-2-licensed",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-4.0", ("cc-by-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-work",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-work",)),
    ("Unlicense", ("unlicense",)),
    ("proprietary", ("rights",)),
)

# Notices of the other GNU licences. The SQL has SENTENCES and RULES alone.
_TERMS = "is free software you can redistribute it and or modify it under the terms of the gnu"
_ISSUER = "general public license as published by the free software foundation"
NOTICES = {
    "lgpl-free": f"this program {_TERMS} lesser {_ISSUER}",
    "lgpl-library-free": f"this library {_TERMS} lesser {_ISSUER}",
    "lgpl-2-1-later": "either version 2 1 of the license or at your option any later version",
    "agpl-free": f"this program {_TERMS} affero {_ISSUER}",
}
NOTICE_RULES = (
    ("LGPL-3.0-or-later", ("lgpl-free", "gpl-3-later")),
    ("LGPL-3.0-or-later", ("lgpl-library-free", "gpl-3-later")),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl-2-1-later")),
    ("LGPL-2.1-or-later", ("lgpl-library-free", "lgpl-2-1-later")),
    ("LGPL", ("lgpl-free",)),
    ("LGPL", ("lgpl-library-free",)),
    ("AGPL-3.0-or-later", ("agpl-free", "gpl-3-later")),
    ("AGPL", ("agpl-free",)),
)
# Known sentences that a comma may join to one, which is then read as both.
JOINED = tuple(
    (free, later)
    for free in ("gpl-free", "lgpl-free", "lgpl-library-free", "agpl-free")
    for later in ("gpl-2-later", "gpl-3-later", "lgpl-2-1-later")
)

# Every known sentence has one of these, so a text without them needs no look-up.
CUES = (
    "licen",
    "permission",
    "redistribut",
    "copyright",
    "warrant",
    "unencumbered",
    "rights",
    "liability",
    "version",
)
MAX_LINES = 8  # pieces in a run, in the SQL only
CUT = r"\n|[.!?;:][\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

assert not any(" " in cue for cue in CUES)  # it may be a line end in the text
for _sentence in (SENTENCES | NOTICES).values():
    assert any(cue in _sentence for cue in CUES), _sentence


def _identifiers(text: Column, sentences: dict[str, str]) -> Column:
    """Identifiers of the known sentences in a lower-cased text, in the order of the text."""
    if not sentences:
        return F.array().cast("array<string>")
    known = [(text, (key,), "") for key, text in sentences.items()]
    for first, second in JOINED:
        if first in sentences and second in sentences:
            known.append((f"{sentences[first]} {sentences[second]}", (first, second), sentences[first]))
    known.sort(key=lambda entry: len(entry[0]))
    entries = F.array(
        *[
            F.struct(
                F.lit(text).alias("text"),
                F.array(*map(F.lit, keys)).alias("ids"),
                F.lit(len(first)).alias("first"),
            )
            for text, keys, first in known
        ]
    )
    # pieces between line ends; words of a piece between single blanks
    pieces = F.concat(F.lit("\n"), F.regexp_replace(text, CUT, "\n"), F.lit("\n"))
    pieces = F.regexp_replace(F.regexp_replace(pieces, r"[^a-z0-9\n]+", " "), r" ?\n[ \n]*", "\n")
    # at each piece the longest run that is a known sentence; any other there is its beginning
    longest = "|".join(re.escape(text).replace(r"\ ", r"[ \n]") for text, _, _ in reversed(known))
    runs = F.regexp_extract_all(pieces, F.lit(rf"\n(?=((?:{longest})\n))"), F.lit(1))

    def of_run(run: Column) -> Column:
        words = F.replace(run, F.lit("\n"), F.lit(" "))

        def ends_a_piece(length: Column) -> Column:
            return F.substring(run, length + 1, F.lit(1)) == "\n"

        def read(entry: Column) -> Column:
            # where the first of two joined sentences ends a piece, each is found by itself
            apart = (entry["first"] > 0) & ends_a_piece(entry["first"])
            return words.startswith(entry["text"]) & ends_a_piece(F.length(entry["text"])) & ~apart

        return F.flatten(F.transform(F.filter(entries, read), lambda entry: entry["ids"]))

    return F.flatten(F.transform(runs, of_run))


def scan_licences(
    docs: DataFrame, sentences: dict = SENTENCES | NOTICES, rules: tuple = NOTICE_RULES + RULES
) -> DataFrame:
    """``doc_id, licences, sentence_ids, n_sentences`` of every row of ``docs``.

    ``licences`` names the recognised licences once each, in the order of the text, joined by
    commas; ``sentence_ids`` the identifiers that were read. Null and empty texts have neither, and
    zero sentences. Repeated rows stay. An identifier that no rule takes is no licence.
    """
    docs = exact(docs, "doc_id", "text")
    lowered = F.translate(text_of(docs), UPPER, LOWER)
    cue = reduce(lambda a, b: a | b, [F.contains(F.col("_text"), F.lit(cue)) for cue in CUES])
    found = docs.select("doc_id", lowered.alias("_text")).select(
        "doc_id",
        F.when(cue, _identifiers(F.col("_text"), sentences))
        .otherwise(F.array().cast("array<string>"))
        .alias("_ids"),
    )
    sequence = F.array_join(F.transform("_ids", lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")
    for licence, ids in rules:
        mark = "".join(f"<{x}>" for x in ids)
        sequence = F.replace(sequence, F.lit(mark), F.lit(f"{{{licence}}}"))
    names = F.array_distinct(F.regexp_extract_all(sequence, F.lit(r"\{([^}]+)\}"), F.lit(1)))
    return found.select(
        "doc_id",
        F.array_join(names, ",").alias("licences"),
        F.array_join("_ids", ",").alias("sentence_ids"),
        F.size("_ids").cast("long").alias("n_sentences"),
    )


def scan_sql() -> str:
    """The same in SQL, over ``documents``, for runs of up to ``MAX_LINES`` pieces, without joined sentences and
    the further notices."""
    known = ", ".join(f"('{value}', '{key}')" for key, value in SENTENCES.items())
    sequence = "list_aggregate(list_transform(ids, lambda x: '<' || x || '>'), 'string_agg', '')"
    sequence = f"coalesce({sequence}, '')"
    for licence, ids in RULES:
        sequence = f"replace({sequence}, '{''.join(f'<{x}>' for x in ids)}', '{{{licence}}}')"
    return f"""WITH known(sentence, id) AS (VALUES {known}),
    numbered AS (SELECT row_number() OVER () AS r, doc_id,
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
    pieces AS (SELECT r, list_filter(list_transform(regexp_split_to_array(t, '{CUT}'),
        lambda x: trim(regexp_replace(x, '[^a-z0-9]+', ' ', 'g'))), lambda x: x <> '') AS p FROM numbered),
    starts AS (SELECT r, p, unnest(range(1, len(p) + 1)) AS s FROM pieces),
    runs AS (SELECT r, s, n, array_to_string(p[s:s + n - 1], ' ') AS sentence
        FROM starts, range(1, {MAX_LINES + 1}) AS lengths(n) WHERE s + n - 1 <= len(p)),
    read AS (SELECT r, list(id ORDER BY s, n) AS ids FROM runs JOIN known USING (sentence) GROUP BY r),
    marked AS (SELECT doc_id, ids, {sequence} AS sequence FROM numbered LEFT JOIN read USING (r)),
    named AS (SELECT doc_id, ids, regexp_extract_all(sequence, '\\{{([^}}]+)\\}}', 1) AS l FROM marked)
    SELECT doc_id,
        array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') AS licences,
        coalesce(array_to_string(ids, ','), '') AS sentence_ids,
        CAST(coalesce(len(ids), 0) AS BIGINT) AS n_sentences
    FROM named"""
