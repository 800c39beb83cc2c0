"""A quality classifier as a sparse ensemble of rules.

A forest of shallow trees is grown on statistics of labelled texts. Every path from a root is a rule, a
conjunction of comparisons; a logistic regression with an absolute-value penalty gives most rules
the weight zero. What is left is compiled into a column expression over the statistics, which scores
any number of documents without a model at hand.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivetables.llm.common import exact, output, text_of, written
from archivetables.llm.fertility import repeated_lines, repeated_words

MAX_LABELLED = 20_000  # labelled rows that a model is fitted on, those of the smallest hash
TREES, DEPTH, PENALTY, SEED = 40, 3, 0.001, 17

STATISTICS = (
    "words",  # logarithm of one more
    "word_chars",  # mean
    "symbols",  # shares of characters
    "upper",
    "digits",
    "exclamations",
    "stops",
    "commas",
    "letters",
    "top_word",  # share of words
    "distinct_words",  # over the root of words
    "capitalised",  # share of words
    "repeated_words",  # share of words in windows found twice
    "repeated_lines",  # share of lines
    "line_words",  # mean
    "sentence_words",  # mean
    "word_entropy",  # bits, over what that many words have at most, eight bits and more counting as eight
)


def _bytes(characters: str) -> list[int]:
    return list(characters.encode())


SYMBOLS, DIGITS = _bytes("#*$%&|<>{}[]\\^~=_@+/"), _bytes("0123456789")
UPPER = list(range(0x41, 0x5B))
LETTERS = [*UPPER, *range(0x61, 0x7B), *range(0xC3, 0xF5)]


def statistics(text: bytes) -> list[float]:
    raw = np.frombuffer(text, "uint8")
    count = np.bincount(raw, minlength=256)
    words = text.split()
    n, n_lines = len(words), text.count(b"\n") + 1
    spaces = int(count[_bytes(" \t\n\r\x0b\x0c")].sum())
    chars = max(1, len(text) - int(count[0x80:0xC0].sum()) - spaces)
    accented = int(((raw[:-1] == 0xC3) & (raw[1:] < 0x9F)).sum())  # À to Þ
    each = Counter(words)
    share = np.fromiter(each.values(), "float64", len(each)) / max(1, n)
    names = np.fromiter(map(hash, words), "int64", n)
    entropy = -(share * np.log2(share)).sum() / min(8.0, np.log2(n)) if n > 1 else 1.0
    return [
        float(np.log1p(n)),
        chars / max(1, n),
        count[SYMBOLS].sum() / chars,
        (count[UPPER].sum() + accented) / chars,
        count[DIGITS].sum() / chars,
        count[ord("!")] / chars,
        count[_bytes(".?")].sum() / chars,
        count[_bytes(",;:")].sum() / chars,
        count[LETTERS].sum() / chars,
        float(share.max(initial=0)),
        len(each) / max(1, n) ** 0.5,
        sum(w[:1].isupper() for w in words) / max(1, n),
        repeated_words(names) / max(1, n),
        repeated_lines(text) / n_lines,
        n / n_lines,
        n / (1 + int(count[_bytes(".?!")].sum())),
        float(entropy),
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and a column of type double for each of ``STATISTICS``, of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics(t.as_py()) for t in batch.column("text")], "float64")
            columns = rows.reshape(-1, len(STATISTICS)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, columns)], ["doc_id", *STATISTICS]
            )

    docs = exact(docs, "doc_id", "text")
    return docs.select("doc_id", text_of(docs).cast("binary").alias("text")).mapInArrow(
        run, output(docs, ", ".join(f"{s} double" for s in STATISTICS))
    )


@dataclass(frozen=True, order=True)
class Rule:
    """A conjunction: each condition is a statistic, whether it has to be above, and the threshold."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        parts = [F.col(s) > t if above else F.col(s) <= t for s, above, t in self.conditions]
        return reduce(Column.__and__, parts)


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """The probability of label 1, as an expression over the statistics."""
        terms = [F.when(rule.column(), weight).otherwise(0.0) for rule, weight in self.weights]
        total = reduce(Column.__add__, terms, F.lit(self.intercept))
        return 1 / (1 + F.exp(-total))


def tree_rules(root) -> Iterator[Rule]:
    """The paths to all nodes below ``root``, each statistic's bounds in a rule made one."""

    def walk(node, path: dict[tuple[str, bool], float]) -> Iterator[Rule]:
        if path:
            yield Rule(tuple(sorted((s, above, t) for (s, above), t in path.items())))
        if node.subtreeDepth() > 0:
            name, at = STATISTICS[node.split().featureIndex()], node.split().threshold()
            low = min(at, path.get((name, False), at))
            high = max(at, path.get((name, True), at))
            yield from walk(node.leftChild(), path | {(name, False): low})
            yield from walk(node.rightChild(), path | {(name, True): high})

    yield from walk(root, {})


def fit(labelled: DataFrame) -> RuleModel:
    """A model from statistics and ``label`` (0 or 1). Without both labels, a constant: the share of 1,
    or a half where there is none at all."""
    n, ones = labelled.agg(F.count("label"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if ones in (0, n):
        share = (ones + 0.5) / (n + 1)
        return RuleModel(float(np.log(share / (1 - share))), ())
    rows = labelled.select(
        F.col("label").cast("double").alias("label"), array_to_vector(F.array(*STATISTICS)).alias("x")
    )
    forest = RandomForestClassifier(
        featuresCol="x", numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=5
    ).fit(rows)
    rules = sorted({rule for tree in forest.trees for rule in tree_rules(tree._java_obj.rootNode())})
    fired = labelled.select(
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.array(*[r.column().cast("double") for r in rules])).alias("x"),
    )
    lasso = LogisticRegression(
        featuresCol="x", elasticNetParam=1.0, regParam=PENALTY, maxIter=200, tol=1e-7
    ).fit(fired)
    weights = lasso.coefficients.toArray()
    return RuleModel(
        float(lasso.intercept),
        tuple((rule, float(w)) for rule, w in zip(rules, weights, strict=True) if w),
    )


def held_out() -> Column:
    """Rows never learnt from: crc32 of the id as text leaves 1 when divided by 3."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(3)) == 1, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the statistics of every row of ``docs``.

    ``labels`` has ``doc_id`` and ``quality``; null labels don't count, several for a document count by
    their majority (1 on a tie). At most ``max_labelled`` documents that are not held out are learnt from,
    those whose ids have the smallest hashes. Null and empty texts are scored like any others.
    Repeated rows stay; a null ``doc_id`` has no label and is not held out.
    """
    measured = written(with_statistics(docs), "quality-statistics")
    labels = exact(labels, "doc_id", "quality")
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
    known = known.agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    order = F.xxhash64("doc_id")
    chosen = known.filter(~held_out()).orderBy(order, "doc_id").limit(max_labelled)
    # at most max_labelled ids and labels, so small enough for all executors
    rows = measured.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    # one sorted partition of bounded size, so that the forest's samples are the same in each run
    labelled = rows.repartition(1).sortWithinPartitions(order, "doc_id")
    labelled = written(labelled, "quality-labelled")
    model = fit(labelled)
    return measured.withColumn("score", model.score()).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        *STATISTICS,
    )
