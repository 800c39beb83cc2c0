"""The pipeline's stages, each against plain code on what it was given."""

import re
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from archivetables.llm import fertility, mixing
from archivetables.llm.common import answered, documents, hidden, parted, written
from archivetables.llm.queries import vocabularies
from archivetables.session import checkpoint_root
from tests.llm.conftest import SF
from tests.llm.test_corpus import plain_components

ROOT = Path(__file__).resolve().parents[2]


def pairs(table):
    return [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]


def test_stages(spark):
    docs = documents(spark, SF)
    given, out = docs, []
    for name, stage in corpus_pipeline.STAGES:
        got = written(stage(spark, given, SF), "test-stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert got.schema == docs.schema
        out.append(got)
        given = got
    rules, exact, near, mix, tokens = out

    judged = fertility.judge_documents(docs, **vocabularies()).filter("kept")
    assert sorted(pairs(rules)) == sorted(r for r in pairs(docs) if r[0] in {j.doc_id for j in judged.collect()})

    first = {}
    for key, text in sorted(pairs(rules)):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text), (key, text))
    assert sorted(pairs(exact)) == sorted(first.values())

    rows = pairs(exact)
    least = {c for _, _, c in plain_components(rows, 5, 80)}
    assert sorted(pairs(near)) == sorted(r for r in rows if r[0] in least)

    copies = {r.doc_id: r.copies for r in mixing.mix_rates(near).collect()}
    assert Counter(k for k, _ in pairs(mix)) == Counter({k: n for k, n in copies.items() if n})

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter(
        (k, tuple(library.encode(t, add_special_tokens=False).ids)) for k, t in pairs(mix)
    )
    assert Counter((r.doc_id, tuple(r.ids)) for r in tokens.collect()) == want
    assert all(r.n_tokens == len(r.ids) for r in tokens.collect())


def test_stages_leave_no_tables_behind(spark, make):
    shared = Path(checkpoint_root(spark).removeprefix("file://"))
    text = "She said that the committee would meet again in spring, after the river had gone down. "
    given = make([(i, None) for i in range(40)]).select("doc_id", "source", "size")
    given = given.withColumn("text", F.concat(F.lit(text), F.sha2(F.col("doc_id").cast("string"), 256)))
    before = set(shared.iterdir())
    for _, stage in corpus_pipeline.STAGES:
        unwritten = stage(spark, given, SF)
        # what this stage reads is there still, and nothing of the stages before it
        left = {path.name.rsplit("-", 1)[0] for path in set(shared.iterdir()) - before}
        assert len({name.split("-")[0] for name in left} - {"test"}) <= 1, left
        given = written(unwritten, "test-left")
    lazily = corpus_pipeline.mixture(spark, make([(1, "a b c d e f")]), SF)
    assert corpus_pipeline.exact_duplicates(spark, lazily, SF).count() == 1
    assert lazily.count() >= 1  # it was not written, so its tables stayed


def test_run_is_the_stages_in_a_row(spark):
    once = corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256").collect()
    again = corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256").collect()
    assert sorted(once) == sorted(again) and once


def test_empty_and_odd_tables(spark, make):
    for rows in ([], [(None, None), (1, ""), (1, " "), (None, "x")]):
        # as stored, where names that differ by case alone can't be
        given = make(rows).toDF("doc_id", "text", "source", "_row", "part", "chunk", "copies", "size")
        for _, stage in corpus_pipeline.STAGES:
            given = written(stage(spark, given, SF), "test-odd")
        assert given.count() == 0


def test_the_rest_works_without_these_folders(tmp_path):
    copy = tmp_path / "repo"
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__")
    shutil.copytree(ROOT, copy, ignore=skip)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, set(e.oracle_sql()) <= set(q))"
    found = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert found.stdout.split()[1:] == ["False", "True"], found.stderr


def test_all_are_registered():
    code = "import __spark_entry__ as e; print(*e.queries())"
    found = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    names = found.stdout.split()
    assert "pipeline" in names
    assert sorted(n.split("_")[0] for n in names if re.match(r"op\d+_", n)) == sorted(f"op{i}" for i in range(1, 14))


def test_answers_move_no_texts(spark, make):
    rows = parted(hidden(make([(i, f"text {i}") for i in range(50)]), "doc_id", "text"), "test-parted")
    answers = rows.select("_row", (rows["doc_id"] * 2).alias("twice"))
    got = answered(rows, answers, "twice")
    assert {(r.doc_id, r.twice) for r in got.collect()} == {(i, 2 * i) for i in range(50)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = got.filter("twice > 4")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    [scan] = [line for line in plan.splitlines() if "FileScan" in line and "text#" in line]
    assert "Bucketed: true" in scan
