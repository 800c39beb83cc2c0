"""Components of documents joined by the Jaccard similarity of their word shingles, exact.

Only connectivity is computed: pairs inside one component are not all tested, so links are not counted.

Shingles are hashed into groups. Two sets that link differ in at most ``d`` shingles, a number that
follows from their sizes; so of ``k`` groups at least ``k - d`` have the same content in both. Ordered
alike (largest group first), the first ``d + 1`` groups of both have one in common: each document is
filed under those, and only documents that share such a group can link. No two components that a link
joins stay apart, and nothing is sampled.

Documents filed under a group are linked into a chain. The chain's pairs are tested by points, vectors
of counts by hashed group whose summed coordinate minima bound the overlap; those that may link are
verified by the sets themselves. A group whose members are by then in one component has nothing more to say. Of the other
groups, members of different components are compared by an R-tree of these points: a box knows the largest count of each coordinate, so
that the same sum bounds the overlap of all points of two boxes. Pairs that survive are verified.

Copies of a text cost a link each. A group that holds a third of all rows is chained by
each task first, so that one entry for each task goes on; groups that stay mixed are compared in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivetables.llm.chunks import CHUNK_ROWS, Measure, pack, with_answers
from archivetables.llm.common import answered, hidden, parted, settled, written
from archivetables.llm.components import components

# Sizes up to twice the smallest of a class; a set may link with one of the next class, not beyond.
SPARE = 1.3  # groups for each one that is filed
CLASS = 2
HELD = 4_000_000  # filed groups that a task holds before it chains them
POINT = 2  # shingles for each coordinate of a point
LEAF, BLOCK = 16, 1024  # points in a box; members of a group compared at a time
SMALLEST = 16  # keys by which a pair is left to another group; of more keys it may come twice
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, words: int) -> np.ndarray:
    """The set of shingles as ascending hashes; a shorter text is one shingle, an empty one none."""
    digest = xxhash.xxh3_64_intdigest
    each = np.array([digest(w) for w in text.lower().split()], "uint64")
    if not len(each):
        return each
    width = min(words, len(each))
    n = len(each) - width + 1
    out = np.full(n, width, "uint64")
    for i in range(width):
        out = mix(out * MULTIPLIER + each[i : i + n])
    return np.unique(out)


class Similarity:
    """At least ``percent`` of the union is shared; all in whole numbers."""

    def __init__(self, percent: int):
        if not 50 < percent <= 100:
            raise ValueError("similarity is from 51 to 100 percent")
        self.percent = percent

    def links(self, shared: int, a: int, b: int) -> bool:
        return 100 * shared >= self.percent * (a + b - shared)

    def overlap(self, sizes):
        """The least overlap of two sets whose sizes add up to ``sizes`` (or to more)."""
        return -(-self.percent * sizes // (100 + self.percent))

    def difference(self, sizes: int) -> int:
        """A bound of the shingles that are in one set only, for sizes that add up to ``sizes``."""
        return (100 - self.percent) * sizes // (100 + self.percent)

    def largest(self, a: int) -> int:
        """The largest set that a set of ``a`` can link with."""
        return 100 * a // self.percent

    def groups(self, size_class: int) -> int:
        """The number of groups of a class: enough for the largest sets in it."""
        top = CLASS ** (size_class + 1) - 1
        return int(SPARE * (self.difference(top + self.largest(top)) + 1)) + 1

    def filed(self, n: int) -> list[tuple[int, int]]:
        """The classes a set of ``n`` is filed in, each with the number of groups it is filed under. Two
        sets meet in the class of the smaller one, which is the larger one's or the next below."""
        own = n.bit_length() - 1
        out = [(own, self.difference(n + self.largest(n)) + 1)]
        below = CLASS**own - 1
        if own and self.largest(below) >= n:
            out.append((own - 1, self.difference(n + below) + 1))
        return out


def file_under(found: np.ndarray, similarity: Similarity) -> np.ndarray:
    """Names of the groups that a set is filed under."""
    out = []
    for size_class, prefix in similarity.filed(len(found)) if len(found) else ():
        if prefix == 1:  # only equal sets could link
            content = mix(np.array([found.sum(dtype="uint64")]))
            out.append(mix(content + np.uint64(size_class)))
            continue
        k = similarity.groups(size_class)
        group = ((found >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)  # ascending
        starts = np.r_[0, np.flatnonzero(np.diff(group)) + 1]
        content = np.add.reduceat(mix(found + MULTIPLIER), starts)
        names = mix(content ^ mix(group[starts] * np.uint64(1 << 20) + np.uint64(size_class)))
        counts = np.diff(np.r_[starts, len(found)])
        chosen = names[np.lexsort((names, -counts))[:prefix]]
        if len(chosen) < prefix:  # so few are filled that empty ones may be what two sets share
            empty = np.setdiff1d(np.arange(k, dtype="uint64"), group)[: prefix - len(chosen)]
            empty = mix(mix(empty * np.uint64(1 << 20) + np.uint64(size_class)))
            chosen = np.r_[chosen, empty]
        out.append(chosen)
    return np.concatenate(out) if out else np.empty(0, "uint64")


def chained(keys: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    """``key, a, b``: for each key its first row with ``b`` of -1, and its rows chained."""
    order = np.lexsort((rows, keys))
    keys, rows = keys[order], rows[order]
    first = np.r_[True, keys[1:] != keys[:-1]]
    before = np.r_[rows[:1], rows[:-1]]
    fresh = first | (before != rows)
    a, b = np.where(first, rows, before)[fresh], np.where(first, -1, rows)[fresh]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys[fresh].view("int64")), pa.array(a), pa.array(b)], ["key", "a", "b"]
    )


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two ascending sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def point(found: np.ndarray) -> np.ndarray:
    """Counts of shingles by group, two to a byte; the number of groups is a power of two that fits
    the size, and twice that as long as a count is above fifteen."""
    n = max(16, 1 << (len(found) // POINT).bit_length())
    while (counts := np.bincount(found % np.uint64(n), minlength=n)).max() > 15:
        n *= 2
    return (counts[0::2] | counts[1::2] << 4).astype("uint8")


def folded(packed: list[np.ndarray]) -> np.ndarray:
    """Points of different lengths as rows of the shortest length: groups fall together in pairs."""
    points = [np.stack((p & 15, p >> 4), 1).ravel() for p in packed]
    n = min(map(len, points))
    return np.array([p.reshape(-1, n).sum(0, dtype="int64") for p in points]).reshape(-1, n)


class Box:
    """A node of the R-tree over count vectors."""

    def __init__(self, at: np.ndarray, tree: Tree):
        self.at = at
        self.top = tree.points[at].max(0)
        self.least = int(tree.sizes[at].min())
        own = tree.components[at]
        self.component = int(own[0]) if (own == own[0]).all() else None
        self.parts: list[Box] = []
        if len(at) > LEAF:
            spread = tree.points[at].max(0) - tree.points[at].min(0)
            order = at[np.argsort(tree.points[at, spread.argmax()], kind="stable")]
            middle = len(at) // 2
            self.parts = [Box(order[:middle], tree), Box(order[middle:], tree)]


class Tree:
    def __init__(self, points: np.ndarray, sizes: np.ndarray, components: np.ndarray):
        self.points, self.sizes, self.components = points, sizes, components

    def pairs(self, left: np.ndarray, right: np.ndarray, similarity: Similarity) -> Iterator[tuple]:
        """Pairs of points of different components whose summed minima allow them to link."""
        open_ = [(Box(left, self), Box(right, self))]
        while open_:
            a, b = open_.pop()
            if a.component is not None and a.component == b.component:
                continue
            if np.minimum(a.top, b.top).sum() < similarity.overlap(a.least + b.least):
                continue
            if a.parts or b.parts:
                open_ += [(x, y) for x in a.parts or [a] for y in b.parts or [b]]
                continue
            shared = np.minimum(self.points[a.at][:, None], self.points[b.at][None]).sum(2)
            needed = similarity.overlap(self.sizes[a.at][:, None] + self.sizes[b.at][None])
            apart = self.components[a.at][:, None] != self.components[b.at][None]
            for i, j in zip(*np.nonzero((shared >= needed) & apart), strict=True):
                yield a.at[i], b.at[j]


def _rows(chunks: DataFrame) -> DataFrame:
    each = F.posexplode(F.arrays_zip("doc_ids", "sizes", "names"))
    return chunks.select("chunk", each.alias("pos", "_x")).select(
        (F.col("chunk") * CHUNK_ROWS + F.col("pos")).alias("row"),
        F.col("_x.doc_ids").alias("doc_id"),
        F.col("_x.sizes").alias("n"),
        F.col("_x.names").alias("name"),
    )


def _filed(chunks: DataFrame, words: int, similarity: Similarity) -> DataFrame:
    """``key, a, b`` over all documents, chained within each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, keys, rows = 0, [], []
        seen: set[bytes] = set()  # a copy is linked by its name
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                for pos, text in enumerate(row["texts"]):
                    if row["names"][pos] in seen:
                        continue
                    seen.add(row["names"][pos])
                    own = file_under(shingles(text, words), similarity)
                    keys.append(own)
                    rows.append(np.full(len(own), row["chunk"] * CHUNK_ROWS + pos, "int64"))
                    held += len(own)
                    if held > HELD:
                        yield chained(np.concatenate(keys), np.concatenate(rows))
                        held, keys, rows = 0, [], []
        if held:
            yield chained(np.concatenate(keys), np.concatenate(rows))

    return chunks.select("chunk", "texts", "names").mapInArrow(run, "key bigint, a bigint, b bigint")


def _chains(filed: DataFrame) -> DataFrame:
    """``key, a, b``: the pairs that chain all documents filed under a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, row = None, None
        for batch in batches:
            keys, a, b = (batch.column(c).to_numpy() for c in ("key", "a", "b"))
            pair = b >= 0
            out = [(keys[pair], a[pair], b[pair])]
            keys, heads = keys[~pair], a[~pair]
            if len(keys):
                before_key = np.r_[keys[:1] if key is None else [key], keys[:-1]]
                before = np.r_[heads[:1] if row is None else [row], heads[:-1]]
                linked = (before_key == keys) & (before != heads)
                out.append((keys[linked], before[linked], heads[linked]))
                key, row = keys[-1], heads[-1]
            columns = [np.concatenate(c) for c in zip(*out, strict=True)]
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["key", "a", "b"])

    return (
        filed.repartition("key")
        .sortWithinPartitions("key", "a")
        .mapInArrow(run, "key bigint, a bigint, b bigint")
    )


def _asked(chunks: DataFrame, pairs: DataFrame) -> DataFrame:
    """The chunks that hold rows of ``pairs``, with their positions."""
    rows = pairs.select(F.col("a").alias("row")).unionAll(pairs.select("b")).distinct()
    chunk = F.shiftright("row", CHUNK_ROWS.bit_length() - 1).alias("chunk")
    wanted = rows.select(chunk, F.pmod("row", F.lit(CHUNK_ROWS)).cast("int").alias("pos"))
    wanted = wanted.join(chunks.select("chunk", "part"), "chunk")
    asked = with_answers(chunks, wanted, "wanted").filter("wanted IS NOT NULL")
    return asked.select("chunk", "texts", "wanted")


def _of_rows(asked: DataFrame, words: int, whole: bool) -> DataFrame:
    """``row, n, data`` of the rows asked for: the size of the set, and the packed set or its point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                chunk = batch.slice(i, 1).to_pylist()[0]
                at = [w["pos"] for w in chunk["wanted"]]
                for begin in range(0, len(at), 64):
                    own = at[begin : begin + 64]
                    found = [shingles(chunk["texts"][pos], words) for pos in own]
                    data = [(f if whole else point(f)).tobytes() for f in found]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([chunk["chunk"] * CHUNK_ROWS + pos for pos in own], pa.int64()),
                            pa.array([len(f) for f in found], pa.int64()),
                            pa.array(data, pa.binary()),
                        ],
                        ["row", "n", "data"],
                    )

    found = asked.mapInArrow(run, "row bigint, n bigint, data binary")
    return written(found, "jaccard-sets" if whole else "jaccard-points")


def _tested(pairs: DataFrame, rows: DataFrame, similarity: Similarity, whole: bool) -> DataFrame:
    """``a, b`` of the pairs whose sets link or, by their points, may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            columns = (batch.column(c) for c in ("n_a", "n_b", "x", "y"))
            for n_a, n_b, x, y in zip(*columns, strict=True):
                n_a, n_b = n_a.as_py(), n_b.as_py()
                if whole:
                    x, y = (np.frombuffer(z.as_buffer(), "uint64") for z in (x, y))
                    keep.append(similarity.links(overlap(x, y), n_a, n_b))
                else:
                    x, y = folded([np.frombuffer(z.as_buffer(), "uint8") for z in (x, y)])
                    keep.append(np.minimum(x, y).sum() >= similarity.overlap(n_a + n_b))
            kept = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            if len(kept):
                yield kept

    def end(name: str, data: str) -> DataFrame:
        return rows.select(
            F.col("row").alias(name), F.col("n").alias(f"n_{name}"), F.col("data").alias(data)
        )

    both = pairs.select("a", "b").join(end("a", "x"), "a").join(end("b", "y"), "b")
    return both.mapInArrow(run, "a bigint, b bigint")


def _links(chunks: DataFrame, pairs: DataFrame, words: int, similarity: Similarity) -> DataFrame:
    sets = _of_rows(_asked(chunks, pairs), words, whole=True)
    return written(_tested(pairs, sets, similarity, whole=True), "jaccard-links")


def _survivors(mixed: DataFrame, points: DataFrame, similarity: Similarity) -> DataFrame:
    """``a, b``: of the members of each key (``key, row, component``), with their points (``row, n, data,
    smallest``), the pairs of different components that the R-tree lets through. Large keys are compared block by block. A pair
    that is known to share a smaller key too (``smallest`` are some of a row's) is left to that one."""
    counts = mixed.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    dealt = mixed.join(written(counts, "jaccard-blocks"), "key")
    dealt = dealt.withColumn("_block", F.pmod(F.xxhash64("row"), F.col("_blocks")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    dealt = dealt.withColumn("_low", F.least("_block", "_other")).withColumn(
        "_high", F.greatest("_block", "_other")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, members = None, []

        def compare() -> pa.RecordBatch:
            tree = Tree(
                folded([np.frombuffer(m["data"], "uint8") for m in members]),
                np.array([m["n"] for m in members]),
                np.array([m["component"] for m in members]),
            )
            block = np.array([m["_block"] for m in members])
            below = [{k for k in m["smallest"] if k < group[0]} for m in members]
            left, right = np.flatnonzero(block == group[1]), np.flatnonzero(block == group[2])
            pairs = [] if not (len(left) and len(right)) else tree.pairs(left, right, similarity)
            rows = [m["row"] for m in members]
            pairs = {
                (min(rows[i], rows[j]), max(rows[i], rows[j]))
                for i, j in pairs
                if below[i].isdisjoint(below[j])
            }
            a, b = zip(*pairs, strict=True) if pairs else ((), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
            )

        for batch in batches:
            for m in batch.to_pylist():
                own = (m["key"], m["_low"], m["_high"])
                if own != group and members:
                    yield compare()
                    members = []
                group = own
                members.append(m)
        if members:
            yield compare()

    return (
        dealt.drop("_blocks", "_other")
        .join(points, "row")  # last, so that points move once
        .repartition("key", "_low", "_high")
        .sortWithinPartitions("key", "_low", "_high")
        .mapInArrow(run, "a bigint, b bigint")
    )


def _joined(rows: DataFrame, nodes: DataFrame, column: str) -> DataFrame:
    """``rows`` with the node of the row in ``column`` in its place."""
    node = nodes.select(F.col("row").alias(column), F.col("node").alias("_node"))
    return rows.join(node, column).drop(column).withColumnRenamed("_node", column)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")


def similar_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``.

    Words are runs without ASCII white space, A-Z in lower case. A document's set holds its distinct
    shingles of ``words`` words; with fewer words the whole sequence is its one shingle, and without
    words (or text) it is empty and linked with nothing. Two documents link when their sets share at least
    ``percent`` of the union; ``component_id`` is the smallest ``doc_id`` reachable by links, null
    counting as largest. Repeated rows are linked. An empty table gives none.
    """
    similarity = Similarity(percent)

    def measure(text: bytes) -> tuple:
        found = shingles(text, words)
        return len(found), xxhash.xxh3_128_digest(found.tobytes())

    measures = (Measure("sizes", pa.int64(), "bigint"), Measure("names", pa.binary(), "binary"))
    chunks = pack(docs, "jaccard", measures, measure)
    rows = written(_rows(chunks), "jaccard-rows")
    copies = rows.filter("n > 0").groupBy("name").agg(F.min("row").alias("node"))
    copies = written(copies, "jaccard-copies")
    nodes = rows.join(copies, "name", "left").select(
        "row", "doc_id", "n", F.coalesce("node", "row").alias("node")
    )
    nodes = written(nodes, "jaccard-nodes")

    chains = written(_chains(_filed(chunks, words, similarity)), "jaccard-chains")
    by_row = chains.groupBy("a", "b").agg(F.count("*").alias("_keys"))
    by_row = by_row.withColumns({"_a": F.col("a"), "_b": F.col("b")})
    by_row = written(_joined(_joined(by_row, nodes, "a"), nodes, "b").filter("a <> b"), "jaccard-pairs")
    pairs = written(_ordered(by_row).distinct(), "jaccard-distinct")
    points = _of_rows(_asked(chunks, pairs), words, whole=False)
    likely = written(_tested(pairs, points, similarity, whole=False), "jaccard-likely")
    links = _links(chunks, likely, words, similarity)
    joined = components(links, "jaccard-components")

    more = _mixed_pairs(chains, by_row, nodes, joined, points, similarity)
    more = written(more.join(likely, ["a", "b"], "left_anti"), "jaccard-more")
    if not more.isEmpty():
        links = links.unionAll(_links(chunks, more, words, similarity))
        joined = components(links, "jaccard-components")

    roots = joined.select("node", F.col("component").alias("_root"))
    members = nodes.join(roots, "node", "left").withColumn("_root", F.coalesce("_root", "node"))
    members = written(members, "jaccard-members")
    order = F.struct(F.col("doc_id").isNull(), "doc_id")
    least = written(members.groupBy("_root").agg(F.min(order).alias("_least")), "jaccard-least")
    return members.join(least, "_root").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("_least.doc_id").alias("component_id"),
    )


def without_similar(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest ``doc_id``; columns as before."""
    rows = parted(hidden(docs, "doc_id", "text"), "jaccard-documents")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")

    def groups() -> DataFrame:
        found = similar_groups(rows.select("text", F.col("_row").alias("doc_id")), words, percent)
        found = found.select(F.col("doc_id").alias("_row"), "component_id")
        return found.join(rows.select("_row", "doc_id"), "_row")

    members = settled(docs.sparkSession, "jaccard-groups", groups)
    kept = members.groupBy("component_id").agg(F.min(order)["_row"].alias("_row"))
    kept = members.select("_row").join(kept.select("_row", F.lit(True).alias("_first")), "_row", "left")
    judged = answered(rows, kept, "_first")
    return judged.filter("_first").drop("_row", "_first").toDF(*docs.columns)


def _mixed_pairs(
    chains: DataFrame,
    by_row: DataFrame,
    nodes: DataFrame,
    joined: DataFrame,
    points: DataFrame,
    similarity: Similarity,
) -> DataFrame:
    """Pairs of the groups whose members are in several components by now, as far as the tree allows.
    A group is mixed where a pair of its chain is; with two members that pair was all."""

    def component(end: str) -> DataFrame:
        return joined.select(F.col("node").alias(end), F.col("component").alias(f"_in_{end}"))

    apart = by_row.join(component("a"), "a", "left").join(component("b"), "b", "left")
    apart = apart.filter(~F.col("_in_a").eqNullSafe(F.col("_in_b")) | F.col("_in_a").isNull())
    apart = apart.select(F.col("_a").alias("a"), F.col("_b").alias("b"), F.lit(True).alias("_apart"))
    keys = chains.join(written(apart, "jaccard-apart"), ["a", "b"], "left").groupBy("key")
    keys = keys.agg(F.count("*").alias("_n"), F.count("_apart").alias("_apart"))
    keys = written(keys.filter("_n > 1 AND _apart > 0").select("key"), "jaccard-mixed")
    rows = chains.join(keys, "key", "left_semi")
    rows = rows.select("key", F.col("a").alias("row")).unionAll(rows.select("key", "b"))
    members = _joined(rows, nodes, "row").distinct()
    members = members.join(joined, F.col("row") == F.col("node"), "left")
    members = members.withColumn("component", F.coalesce("component", "row")).drop("node")
    members = written(members, "jaccard-mixed-members")
    smallest = F.slice(F.sort_array(F.collect_list("key")), 1, SMALLEST).alias("smallest")
    smallest = members.groupBy("row").agg(smallest)  # of the groups that a row is filed under
    return _survivors(members, points.join(smallest, "row"), similarity).distinct()


def groups_sql(words: int, percent: int) -> str:
    """``similar_groups`` in SQL, by all pairs that share a shingle; for small tables of distinct ids."""
    return rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - {words} + 1, 1) + 1),
        lambda i: array_to_string(w[i:i + {words} - 1], ' '))) AS shingle
    FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
    WHERE 100 * shared >= {percent} * (x.size + y.size - shared)),
reach AS (SELECT doc_id, doc_id AS other FROM d
    UNION SELECT r.doc_id, e.b FROM reach AS r
    JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) AS e ON e.a = r.other)
SELECT doc_id, coalesce(any_value(n.size), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id"""
