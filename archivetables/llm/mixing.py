"""Mixing sources to target weights by entropy balancing.

Each source gets a target of words. Among all document rates between 0 and ``cap`` that take the
target from a source, those closest (in relative entropy) to one copy of everything are
``min(cap, exp(lambda * x))``, with ``x`` the document's words over the source's mean. Newton
iterations find the lambda of every source in the convex dual; each is one Spark job over a
histogram of (source, size), which is small however many documents there are. Rates then become
whole copies by systematic rounding along the sizes: a running sum over a distributed sort, so
a source's words differ from its target by less than about its largest document.

Sums are of whole numbers or decimals, so that reruns agree to the bit whatever the partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from archivetables.llm.common import WORD, answered, exact, hidden, parted, settled, text_of, written

WEIGHTS = (5, 2, 1)
UNIT = 1_000_000  # rates are rounded to millionths before they are added up
TOLERANCE = 1e-10  # of a source's target
MAX_ITERATIONS = 100  # bisection alone ends in fewer


def source_targets(sizes: DataFrame, share: float, cap: float, weights: tuple) -> DataFrame:
    """``_key, source, source_size, n_docs, target`` of sources of known size.

    Weights go round in the order of sources (code points, null last). All targets add up to
    ``share`` of all words; a target above ``cap`` times its source is cut to that, and what is
    cut is shared by weight among the others, until none is above.
    """
    ranked = _ranked(sizes, weights)
    total, n_weights = ranked.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))
    ).first()
    limit = cap * F.col("source_size")
    left, open_weights, n_cut = share * total, n_weights, 0
    while True:
        level = left / open_weights if open_weights else float("inf")
        above = F.col("weight") * F.lit(level) > limit
        cut, taken, closed = ranked.agg(
            F.count_if(above),
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(above, F.col("weight"))), F.lit(0)),
        ).first()
        if cut == n_cut:
            break
        n_cut, left, open_weights = cut, share * total - cap * taken, n_weights - closed
    target = F.when(above | F.lit(not open_weights), limit).otherwise(F.col("weight") * F.lit(level))
    return ranked.withColumn("target", target.cast("double"))


def _ranked(sizes: DataFrame, weights: tuple) -> DataFrame:
    """Sources with their weight, ranked by a distributed sort."""
    order = [F.col("source").isNull(), F.col("source")]
    parts = written(
        sizes.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "mix-sources"
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (  # a row per partition
        parts.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    weight = F.element_at(cycle, (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    return written(
        parts.join(offsets, "_part")
        .withColumn("weight", weight)
        .drop("_part", "_n", "_before"),
        "mix-ranked",
    )


def tilt(histogram: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """``targets`` with ``_mean`` and ``_tilt``: the lambda of each source, null where all of its
    documents are taken ``cap`` times (or it has no words)."""
    free = (F.col("source_size") > 0) & (F.col("target") < cap * F.col("source_size"))
    state = targets.withColumn("_mean", F.col("source_size") / F.col("n_docs")).select(
        "*",
        F.when(free, F.lit(0.0)).alias("_tilt"),
        F.lit(None).cast("double").alias("_low"),
        F.lit(None).cast("double").alias("_high"),
        F.lit(False).alias("_done"),
    )
    state = written(state, "mix-tilt")
    x = F.col("size") / F.col("_mean")
    rate = F.least(F.lit(float(cap)), F.exp(F.col("_tilt") * x))
    words = F.col("_n") * F.col("size") * rate
    slope = F.when(rate < cap, words * x).otherwise(0.0)
    for _ in range(MAX_ITERATIONS):
        if state.filter(F.col("_tilt").isNotNull() & ~F.col("_done")).isEmpty():
            break
        sums = (
            histogram.join(state.filter("_tilt IS NOT NULL"), "_key")
            .groupBy("_key")
            .agg(
                F.sum(words.cast("decimal(38,6)")).cast("double").alias("_words"),
                F.sum(slope.cast("decimal(38,6)")).cast("double").alias("_slope"),
            )
        )
        over = F.col("_words") - F.col("target")
        joined = state.join(sums, "_key", "left")
        joined = joined.withColumn("_low", F.when(over < 0, F.col("_tilt")).otherwise(F.col("_low")))
        joined = joined.withColumn("_high", F.when(over > 0, F.col("_tilt")).otherwise(F.col("_high")))
        # Newton on the logarithm of the words, which is nearly straight; kept in the bracket
        step = F.log(F.col("target") / F.col("_words")) * F.col("_words") / F.col("_slope")
        step = F.greatest(F.lit(-4.0), F.least(F.lit(4.0), step))
        newton = F.col("_tilt") + step
        middle = (F.col("_low") + F.col("_high")) / 2
        inside = (F.col("_low").isNull() | (newton > F.col("_low"))) & (
            F.col("_high").isNull() | (newton < F.col("_high"))
        )
        wide = F.col("_tilt") + F.when(over < 0, 4.0).otherwise(-4.0)
        moved = F.when((F.col("_slope") > 0) & inside, newton).otherwise(F.coalesce(middle, wide))
        met = (F.abs(over) <= TOLERANCE * F.col("target")) | (
            F.col("_high") - F.col("_low") <= 1e-15 * (1 + F.abs("_tilt"))
        )
        joined = joined.withColumn("_done", F.col("_done") | F.coalesce(met, F.lit(False)))
        joined = joined.withColumn("_tilt", F.when(F.col("_done"), F.col("_tilt")).otherwise(moved))
        state = written(joined.drop("_words", "_slope"), "mix-tilt")
    return state.drop("_low", "_high", "_done")


def mix_rates(
    docs: DataFrame,
    share: float = 1.5,
    cap: float = 2.0,
    weights: tuple = WEIGHTS,
    carry: tuple = (),
) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies`` of every row of ``docs``.

    Size counts words; a null text has none. A document without words gets no copy. A null
    source is a source of its own. Equal rows share their source's copies like any others.
    An empty table gives an empty result. ``carry`` names further narrow columns to keep.
    """
    docs = exact(docs, "doc_id", "source", "text", *carry)
    narrow = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(text_of(docs), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("doc_id", "text").alias("_order"),
        *carry,
    ).withColumn("_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")))
    narrow = written(narrow, "mix-sizes")
    histogram = written(
        narrow.groupBy("_key", "source", "size").agg(F.count("*").alias("_n")), "mix-histogram"
    )
    sizes = histogram.groupBy("_key", "source").agg(
        F.sum(F.col("size") * F.col("_n")).alias("source_size"), F.sum("_n").alias("n_docs")
    )
    tilted = tilt(histogram.drop("source"), source_targets(sizes, share, cap, weights), cap)
    inside = F.when(
        F.col("_tilt").isNotNull(),
        F.least(F.lit(float(cap)), F.exp(F.col("_tilt") * F.col("size") / F.col("_mean"))),
    ).otherwise(F.lit(float(cap)))
    rate = F.when(F.col("size") > 0, inside).otherwise(0.0)
    rated = narrow.join(tilted.drop("source", "n_docs", "weight"), "_key")
    rated = rated.select(
        *narrow.columns,
        "source_size",
        "target",
        rate.alias("rate"),
        F.round(rate * UNIT).cast("long").alias("_units"),
    )
    # the order of the sort spreads a source, and a size within it, over many partitions
    order = ["_key", "size", "_order", "doc_id"]
    parts = written(
        rated.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "mix-rates"
    )
    before = (
        Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (  # a row per source and partition
        parts.groupBy("_key", "_part")
        .agg(F.sum("_units").alias("_sum"))
        .select("_key", "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    )
    running = Window.partitionBy("_part", "_key").orderBy("size", "_order", "doc_id")
    so_far = F.sum("_units").over(running.rowsBetween(Window.unboundedPreceding, 0))
    upto = F.col("_before") + so_far + UNIT // 2
    copies = F.floor(upto / UNIT) - F.floor((upto - F.col("_units")) / UNIT)
    return (
        parts.join(offsets, ["_part", "_key"])
        .withColumn("copies", copies.cast("long"))
        .drop("_part", "_key", "_order", "_units", "_before")
    )


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it; columns as before."""
    rows = parted(hidden(docs, "doc_id", "source", "text"), "mix-documents")

    def counts() -> DataFrame:
        mix = mix_rates(rows, carry=("_row",), **parameters)
        return mix.select("_row", F.col("copies").alias("_copies"))

    taken = answered(rows, settled(docs.sparkSession, "mix-copies", counts), "_copies")
    # repeated by a generator, whose rows carry references to the text and not copies of it
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    repeated = taken.filter("_copies > 0").withColumn("_copy", copies)
    return repeated.drop("_row", "_copies", "_copy").toDF(*docs.columns)
