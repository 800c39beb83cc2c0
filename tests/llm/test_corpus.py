"""Operators that compare documents: dedup of texts, lines and substrings, the Jaccard join, mixing."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from archivetables.llm import exact_dedup, jaccard, line_dedup, mixing, substrings
from archivetables.llm.components import components
from archivetables.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import ODD, SF
from workload.check import rows_of

SPACE = r"[\x20\x09-\x0D]"


def documents():
    return duckdb.sql(f"SELECT doc_id + 1000, text FROM '{SF}/documents.parquet'").fetchall()


def words(text, n=300):
    return " ".join(random.Random(text).choices([f"w{i}" for i in range(2000)], k=n))


@pytest.mark.parametrize("name", ["op4_exact_dedup", "op6_line_dedup", "op8_jaccard_join"])
def test_sql_counterparts(spark, name):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = QUERIES[name](spark, SF).toPandas()
    assert rows_of(got) == rows_of(db.execute(ORACLES[name]).df())


# exact dedup


def test_exact_groups(spark, make):
    long = words("a", 30_000)
    rows = [
        *ODD, (40, long), (41, long.replace(" ", "\n")), (42, long + "!"), (43, long[:-1] + "~"),
        (30, "x" * 32), (31, "x" * 32), (32, "x" * 31 + "y"), (33, "x" * 33), (34, "x\x00"), (35, "x\x00"),
    ]
    got = exact_dedup.exact_groups(make(rows)).collect()
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub(SPACE + "+", " ", text or "")].append(key)
    digests = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(got) == len(rows)
    for r in got:
        ids = digests[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert (r.keep_id, r.group_size) == (min(known, default=None), len(ids))
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert kept == dict.fromkeys(digests, 1)
    assert exact_dedup.exact_groups(make([])).count() == 0


def test_exact_copies_go_as_whole_rows(spark, make):
    table = make([(2, "a b"), (1, "a\tb"), (None, "a  b"), (3, None), (4, "")])
    left = exact_dedup.without_copies(table)
    assert left.schema == table.schema
    assert sorted(r.doc_id for r in left.collect()) == [1, 3]


def test_a_hot_text_is_one_row_for_each_task(spark):
    docs = spark.range(20_000).selectExpr(
        "id AS doc_id", "CASE WHEN id % 3 = 0 THEN repeat('same words ', 40) ELSE repeat('w' || id, 50) END AS text"
    )
    got = exact_dedup.exact_groups(docs).groupBy("kept").count().collect()
    assert {r.kept: r["count"] for r in got} == {True: 13_334, False: 6_666}


def test_pieces_of_a_hot_group_go_to_tasks_of_their_own(spark):
    block = "CAST(IF(id % 3 = 0, 'hot', 'b' || (id - id % 3)) AS BINARY) AS _block"
    blocks = spark.range(30_000).selectExpr("id AS _row", "id AS doc_id", "8 AS _length", block)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        split = exact_dedup._split(blocks, ["_length"], "left")
        tasks = [r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect()]
        sizes = {r._size: r["count"] for r in split.groupBy("_size").count().collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(tasks) == 30_000 and max(tasks) < 3 * 30_000 / 40
    assert sizes == {10_000: 10_000, 2: 20_000}


# lines


def plain_lines(rows):
    def key(line):
        return re.sub(f"^{SPACE}+|{SPACE}+$", "", line).translate(
            str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        )

    ids = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            ids[key(line)].add(2**63 - 1 if doc is None else doc)
    out = []
    for doc, text in rows:
        own = 2**63 - 1 if doc is None else doc
        lines = (text or "").split("\n")
        keep = [x for x in lines if len(key(x)) < 10 or own == min(ids[key(x)])]
        out.append((doc, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def test_repeated_lines(spark, make):
    rows = [
        *ODD, *documents(), (3, "An Early Line here\nshort"), (60, "  an early line HERE \x0b\nshort\n" * 2),
        (61, "éééééééééé\nééééééééé"), (62, "éééééééééé\nééééééééé\n\n"), (None, "an early line here"),
    ]
    got = [tuple(r) for r in line_dedup.drop_repeated_lines(make(rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain_lines(rows)))
    assert line_dedup.drop_repeated_lines(make([])).count() == 0


def test_perfect_hash():
    dice = np.random.default_rng(3)
    keys = np.unique(dice.integers(0, 2**63, 20_000).astype("uint64"))
    built = line_dedup.PerfectHash.build(keys)
    again = line_dedup.PerfectHash.unpacked(**built.packed())
    assert sorted(again.slots(keys)) == list(range(len(keys)))
    assert line_dedup.PerfectHash.build(keys[:0]).slots(keys[:5]).tolist() == [-1] * 5
    stuck = line_dedup.PerfectHash([], np.sort(keys[:50]))  # keys that no level parted
    assert sorted(stuck.slots(keys[:50])) == list(range(50)) and stuck.slots(keys[60:61])[0] == -1


def test_shards_and_chunks_of_any_number(spark, make, monkeypatch):
    rows = [*ODD, *documents()]
    monkeypatch.setattr(line_dedup, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(line_dedup, "BUFFERED", 50)
    got = [tuple(r) for r in line_dedup.drop_repeated_lines(make(rows).repartition(3)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain_lines(rows)))


# substrings


def plain_cut(rows):
    depth, seen = substrings.DEPTH, Counter()
    texts = [(doc, (text or "").encode()) for doc, text in rows]
    for _, b in texts:
        seen.update(b[i : i + depth] for i in range(len(b) - depth + 1))
    out = []
    for doc, b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - depth + 1):
            if seen[b[i : i + depth]] > 1:
                gone[i : i + depth] = True
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((doc, len(b), int(gone.sum()), spans, kept))
    return sorted(out, key=str)


def cut_rows(table):
    rows = substrings.remove_repeats(table).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows), key=str)


def test_repeated_substrings(spark, make):
    passage = words("p", 90)  # over 400 bytes
    exact = passage[:400]
    rows = [
        *[r for r in ODD if r[0] != 8],
        (20, "a" * 399), (21, "b" * 400), (22, "c" * 401), (23, "de" * 300),
        (24, "left " + exact + " right"), (25, "other" + exact), (26, exact[:-1] + "#"), (27, exact[1:]),
        (28, exact), (29, exact), (30, passage + words("x") + passage), (31, words("y") + passage + "é" * 300),
        (32, "é" * 199 + "a"), (33, "xé" + "é" * 200),
    ]
    assert cut_rows(make(rows)) == plain_cut(rows)
    assert substrings.remove_repeats(make([])).count() == 0


def test_substrings_of_documents(spark, make, monkeypatch):
    rows = [r for r in documents() if r[0] < 1060]
    monkeypatch.setattr(substrings, "BUCKET_KEYS", 2_000)
    assert cut_rows(make(rows).repartition(3)) == plain_cut(rows)


def test_texts_longer_than_a_block_and_chunk(spark, make, monkeypatch):
    passage = words("q", 120)
    long = words("z", 20_000)
    rows = [(1, long[:60_000] + passage + long[60_000:]), (2, passage), (3, "no"), (4, long[30_000:31_000])]
    monkeypatch.setattr(substrings, "BLOCK", 10_000)
    substrings._tables.clear()
    raw = np.frombuffer(rows[0][1].encode(), "uint8")
    at = np.arange(len(raw) - 400)
    pieces = substrings.names(raw, at, 400)
    monkeypatch.undo()
    substrings._tables.clear()
    assert (pieces == substrings.names(raw, at, 400)).all()
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in substrings.remove_repeats(make(rows)).collect()}
    assert got[1][1] == 2 and got[2] == (len(passage), 1) and got[3] == (0, 0) and got[4] == (1000, 1)


def plain_passages(rows, n=50):
    found = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", (text or "").encode())] for _, text in rows]
    raw = [(text or "").encode() for _, text in rows]
    held = defaultdict(set)
    for i, spans in enumerate(found):
        for k in range(len(spans) - n + 1):
            held[tuple(raw[i][b:e] for b, e in spans[k : k + n])].add(i)
    out = []
    for i, spans in enumerate(found):
        inside = set()
        for k in range(len(spans) - n + 1):
            if len(held[tuple(raw[i][b:e] for b, e in spans[k : k + n])]) > 1:
                inside.update(range(k, k + n))
        first = [k for k in sorted(inside) if k - 1 not in inside]
        last = [k for k in sorted(inside) if k + 1 not in inside]
        runs = [(spans[x][0], spans[y][1]) for x, y in zip(first, last, strict=True)]
        out.append((rows[i][0], len(spans), len(inside), runs))
    return sorted(out, key=str)


def passage_rows(table):
    rows = substrings.remove_repeats(table).select("doc_id", "n_words", "n_passage_words", "passages").collect()
    return sorted(((*r[:3], [tuple(p) for p in r.passages]) for r in rows), key=str)


def odd_passages():
    passage = words("p", 51)
    assert len(passage) < substrings.DEPTH
    w = passage.split()
    short = " ".join("abcdefghijklmnopqrstuvwxyz"[i % 26] + str(i % 7) for i in range(60))
    near = "ends with a pass" + "age"
    return passage, [
        *[r for r in ODD if r[0] != 8],
        (20, f"left {passage} right"), (21, words("l", 80) + "\n" + "\t ".join(w) + " " + words("r", 70)),
        (22, " ".join(w[:49])), (23, " ".join(w[1:])), (24, " ".join(w[:25] + ["x"] + w[25:])), (25, "x" + passage),
        (26, words("s", 60)), (27, words("s", 60)), (28, words("t", 120)), (29, words("t", 120)),  # copies, short and long
        (30, short), (31, short + " é"), (32, "ß " + short), (33, words("u", 55) + " " + words("u", 55)),  # 33: in itself only
        (34, words("v", 90).upper()), (35, words("v", 90)), (36, words("t", 120)[:-1]), (37, words("t", 120) + " more"),
        (38, "same " * 300), (39, "same " * 70), (40, "same " * 49), (41, near), (42, passage), (None, passage + " "),
        (43, words("z", 49)), (44, words("z", 50).split()[-1] + " x"), (45, "a\x1cb\x00 \x85 " + passage.replace(" ", "\r\n")),
    ]


def test_passages_of_fifty_words_shorter_than_the_strings(spark, make):
    passage, rows = odd_passages()
    got = passage_rows(make(rows))
    assert got == plain_passages(rows)
    begin = len(b"left ")
    assert (20, 53, 51, [(begin, begin + len(passage))]) in got
    assert (33, 110, 0, []) in got
    assert cut_rows(make(rows)) == plain_cut(rows)
    assert next(r for r in cut_rows(make(rows)) if r[0] == 20)[2] == 0


def test_passages_of_documents(spark, make, monkeypatch):
    _, rows = odd_passages()
    rows = [*documents(), *rows, *rows[8:14]]
    monkeypatch.setattr(substrings, "BUCKET_KEYS", 2_000)
    assert passage_rows(make(rows).repartition(3)) == plain_passages(rows)


def test_words_of_any_length():
    text = ("x" * 250 + " ab\t" + "y" * 99 + "  \n" + "é" * 60 + " a b c ").encode() * 3 + b"ba end"
    text += b"".join(b" " + b"z" * n + b" " + b"z" * n + b"\0" for n in range(1, 30))
    text += b" 12345678abcdefgh abcdefgh12345678 \0 \0\0 x"
    raw = np.frombuffer(text, "uint8")
    places = np.array([m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)])
    names = substrings.word_names(raw, *places.T)
    by_word = defaultdict(set)
    for (b, e), name in zip(places, names, strict=True):
        by_word[text[b:e]].add(int(name))
    assert all(len(x) == 1 for x in by_word.values())
    assert len(set.union(*by_word.values())) == len(by_word)


def test_passages_of_the_query(spark):
    got = QUERIES["op10_substring_dedup"](spark, SF).toPandas().set_index("doc_id")
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    for key, n_words, inside, runs in plain_passages(rows):
        r = got.loc[key]
        assert (r.n_words, r.n_passage_words, r.n_passages) == (n_words, inside, len(runs))
        assert r.passages == ",".join(f"{b}:{e}" for b, e in runs)


def test_cover_takes_any_two_positions_into_the_sample():
    cover, v = set(substrings.COVER.tolist()), substrings.PERIOD
    assert len(cover) == 18 and v == 307
    for difference in range(v):
        assert any((c + difference) % v in cover for c in cover)


# Jaccard join


def plain_components(rows, n, percent):
    sets, parent = [], list(range(len(rows)))
    for _, text in rows:
        w = [x for x in re.split(f"{SPACE}+", (text or "")) if x]
        w = [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in w]
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= percent * (len(a) + len(sets[j]) - shared):
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        members[root(i)].append(doc)
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in members.items()}
    return sorted(((doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows)), key=str)


def joined(table, n, percent):
    return sorted((tuple(r) for r in jaccard.similar_groups(table, n, percent).collect()), key=str)


def edited(text, n, dice):
    w = text.split()
    for i in dice.sample(range(len(w)), n):
        w[i] = f"new{dice.random()}"
    return " ".join(w)


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_similar_documents(spark, make, n, percent):
    dice = random.Random(n)
    rows = list(ODD)
    for size in (3, 5, 6, 7, 8, 11, 12, 14, 25, 60, 63, 64, 70, 130, 300):
        base = words(f"base {size}", size)
        # around the threshold: some link with the base, some only with each other
        rows += [(len(rows) + 100, edited(base, k, dice)) for k in (0, 0, 1, 1, 2, 3, 4, 5) if k <= size // 4]
        rows += [(len(rows) + 100, base + " " + words(f"more {size}", k)) for k in (1, size // 6, size // 5)]
    dice.shuffle(rows)
    assert joined(make(rows), n, percent) == plain_components(rows, n, percent)


def test_components_of_documents(spark, make):
    rows = documents()
    assert joined(make(rows), 3, 60) == plain_components(rows, 3, 60)
    assert joined(make([]), 4, 85) == []


def test_a_hot_group_that_hardly_links(spark, make, monkeypatch):
    """Many copies each edited so that two of them miss the threshold by little or reach it by little."""
    dice = random.Random(11)
    base = words("hot", 120)
    rows = [(i, edited(base, dice.choice((2, 3, 4)), dice)) for i in range(150)]
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "HELD", 500)
    assert joined(make(rows).repartition(4), 4, 85) == plain_components(rows, 4, 85)


def test_one_of_each_group_stays(spark, make):
    base = words("stay", 200)
    table = make([(5, base), (3, base + " end"), (9, words("other")), (None, base), (7, None)])
    left = jaccard.without_similar(table)
    assert left.schema == table.schema
    assert sorted(r.doc_id for r in left.collect()) == [3, 7, 9]


def test_files_and_bounds_lose_no_pair():
    for percent in (80, 85):
        similarity = jaccard.Similarity(percent)
        for a in range(1, 400):
            for b in range(a, similarity.largest(a) + 1):
                shared = similarity.overlap(a + b)
                if shared > a:
                    continue
                needed = a + b - 2 * shared + 1  # groups that must be filed for one in common
                size_class = a.bit_length() - 1
                for n in (a, b):
                    assert dict(similarity.filed(n))[size_class] >= needed, (a, b)
                assert similarity.groups(size_class) >= needed


def test_tree_lets_all_links_through():
    dice = np.random.default_rng(5)
    base = dice.integers(0, 2**63, 300).astype("uint64")
    sets = []
    for _ in range(120):
        own = np.r_[base[dice.random(300) > 0.08], dice.integers(0, 2**63, 20).astype("uint64")]
        sets.append(np.unique(own))
    similarity = jaccard.Similarity(80)
    points = jaccard.folded([jaccard.point(s) for s in sets])
    tree = jaccard.Tree(points, np.array([len(s) for s in sets]), np.arange(len(sets)))
    every = np.arange(len(sets))
    let = {(min(p), max(p)) for p in tree.pairs(every, every, similarity)}
    for i in range(len(sets)):
        for j in range(i):
            if similarity.links(jaccard.overlap(sets[i], sets[j]), len(sets[i]), len(sets[j])):
                assert (j, i) in let


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_connected_components(spark, shape):
    dice = random.Random(4)
    n = 300
    pairs = {
        "path": [(i, i + 1) for i in range(n)],
        "star": [(0, i) for i in range(1, n)],
        "random": [(dice.randrange(n), dice.randrange(n)) for _ in range(n // 2)],
        "none": [],
    }[shape]
    parent = list(range(n + 1))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(pairs, "a bigint, b bigint"), "test").collect()
    assert {r.node: r.component for r in got} == {i: root(i) for p in pairs if p[0] != p[1] for i in p}


# mixing


def plain_targets(sizes, share=1.5, cap=2.0, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target = sum(sizes.values()), {}
    left, open_ = share * total, set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not above:
            break
        for s in above:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= above
    return target | {s: level * weight[s] for s in open_}


def test_mix_of_documents(spark):
    mix = QUERIES["op9_mixing"](spark, "/root/testdata/sf0.01").toPandas()
    docs = duckdb.sql("SELECT * FROM '/root/testdata/sf0.01/documents.parquet'").df().set_index("doc_id")
    sizes = docs.text.map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)))
    by_source = sizes.groupby(docs.source).sum()
    mix = mix.set_index("doc_id").sort_index()
    docs, sizes = docs.sort_index(), sizes.sort_index()
    assert (mix["size"] == sizes).all() and (mix.source_size == docs.source.map(by_source)).all()
    want = plain_targets(by_source.to_dict())
    assert np.allclose(mix.target, docs.source.map(want))
    assert (mix.taken <= 2 * mix["size"]).all()
    taken = mix.taken.groupby(docs.source).sum()
    largest = sizes.groupby(docs.source).max()
    for source, target in want.items():
        assert abs(taken[source] - target) <= largest[source]
        rates = mix.rate[docs.source == source] * mix["size"][docs.source == source]
        assert rates.sum() == pytest.approx(target, rel=1e-6)


def test_rates_are_tilted_exponentially(spark, make):
    rows = [(i, words(i, i % 50 + 1), "ab"[i % 2]) for i in range(400)]
    rates = mixing.mix_rates(make(rows)).filter("source = 'b' AND rate < 2").toPandas()
    slope = np.log(rates.rate) / rates["size"]
    assert len(rates) > 50 and np.allclose(slope, slope.iloc[0])


def test_mix_of_odd_sources(spark, make):
    rows = [(i, words(i, 20), source) for i, source in enumerate([None, "", "b", "é", "B"] * 8)]
    rows += [(90, None, "b"), (91, "", "empty"), (None, "one two", None), (92, "a b", "b"), (92, "a b", "b")]
    mix = mixing.mix_rates(make(rows)).toPandas()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    want = plain_targets(sizes)
    assert len(mix) == len(rows)
    for r in mix.itertuples():
        assert r.target == pytest.approx(want[r.source if isinstance(r.source, str) else None])
        assert r.copies <= 2 and (r.size > 0 or r.copies == 0)
    again = mixing.mix_rates(make(rows).repartition(7)).toPandas()
    assert rows_of(mix) == rows_of(again)
    assert mixing.mix_rates(make([])).count() == 0


def test_mixed_documents_are_whole_rows(spark, make):
    table = make([(i, words(i, 20), "ab"[i % 2]) for i in range(40)])
    mixed = mixing.mixed_documents(table)
    assert mixed.schema == table.schema
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    rates = mixing.mix_rates(table).filter("copies > 0").select("doc_id", "copies").collect()
    assert counts == {r.doc_id: r.copies for r in rates}


def test_outputs_keep_to_the_contracts(spark):
    want = {
        "op4_exact_dedup": "doc_id keep_id group_size kept text_sha256",
        "op6_line_dedup": "doc_id n_lines n_dropped kept_sha256",
        "op8_jaccard_join": "doc_id n_shingles component_id",
        "op9_mixing": "doc_id size source_size target taken",
        "op10_substring_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    }
    for name, columns in want.items():
        got = QUERIES[name](spark, SF)
        assert got.columns[: len(columns.split())] == columns.split()
        assert got.select(F.count_distinct("doc_id")).first()[0] == got.count() == 200
