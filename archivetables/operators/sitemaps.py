"""Sitemap documents, already fetched, as tables of pages.

A document is a row ``sitemap_url, body``.
"""

from __future__ import annotations

import zlib
from datetime import UTC, datetime
from functools import reduce

import pandas as pd
from dateutil import parser as date_parser
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivetables import schemas
from archivetables.functions import site_path, site_root, strip, w3c_timestamp
from archivetables.session import partitions_for, stored

NEAR_LEVELS = 2  # links below the starts that are followed before any is shortened: robots file, index, sitemap
LEVELS_TOGETHER = 8  # levels of a walk before what was reached is written as one
PIECE_ROWS = 1 << 20  # rows that a piece of a sitemap gives, about, when it is joined to the sites that share it

ROBOTS_FILE = "/robots.txt"
WEB_ADDRESS = r"(?i)^\s*https?://[^/\s]"
ROBOTS_SITEMAP = r"(?im)^\s*sitemap:\s*(\S+)"


def sitemap_roots(sitemaps: DataFrame, url: str = "sitemap_url") -> DataFrame:
    """Sites and the sitemap paths known for each: distinct rows ``root, path``.

    One row per path, so a site with very many sitemaps is no single huge row.
    """
    return sitemaps.select(site_root(url).alias("root"), site_path(url).alias("path")).distinct()


GZIP_MARK = b"\x1f\x8b"


@F.pandas_udf(T.BinaryType())
def _gunzip(bodies: pd.Series) -> pd.Series:
    """Packed bodies unpacked, member by member; null where that fails."""

    def one(body: bytes | None) -> bytes | None:
        if body is None or not body.startswith(GZIP_MARK):
            return body
        parts = []
        try:
            while body:
                inflater = zlib.decompressobj(zlib.MAX_WBITS | 16)
                parts.append(inflater.decompress(body) + inflater.flush())
                if not inflater.eof:
                    return None
                body = inflater.unused_data.lstrip(b"\0")
        except zlib.error:
            return None
        return b"".join(parts)

    return bodies.map(one)


def sitemap_text(docs: DataFrame) -> DataFrame:
    """Documents with a ``body`` of text, without a byte-order mark or white space in front; XML without comments.

    Bodies as fetched, of bytes, may be packed; they are unpacked and read as UTF-8. One
    that cannot be unpacked becomes null.
    """
    body = F.col("body")
    if docs.schema["body"].dataType.simpleString() == "binary":
        packed = F.substring("body", 1, 2) == F.lit(GZIP_MARK)
        plain = docs.where(~packed | body.isNull())
        docs = plain.unionByName(docs.where(packed).withColumn("body", _gunzip("body")))
        body = F.make_valid_utf8(F.col("body").cast("string"))
    docs = docs.withColumn("body", F.regexp_replace(body, r"^[\x{FEFF}\s]+", ""))
    plain = F.regexp_replace("body", r"(<!\[CDATA\[[\s\S]*?\]\]>)|<!--[\s\S]*?-->", "$1")
    commented = F.col("body").startswith("<") & F.contains("body", F.lit("<!--"))
    return docs.withColumn("body", F.when(commented, F.ltrim(plain)).otherwise(F.col("body")))


def _root_tag() -> Column:
    """The first element of an XML document, without its prefix; empty for other text."""
    prolog = r"^(?:<\?[^>]*>\s*|<!--(?:(?!-->)[\s\S])*-->\s*|<![^>]*>\s*)*+"
    return F.regexp_extract("body", prolog + r"<(?:[\w.-]+:)?([\w.-]+)", 1)


def _elements(tag: str) -> Column:
    """Whole elements of a name, found one by one, so that a broken one costs no other."""
    pattern = rf"<((?:[\w.-]+:)?){tag}(?:\s[^>]*)?(?<!/)>[\s\S]*?</\1{tag}\s*>"
    return F.regexp_extract_all("body", F.lit(pattern), F.lit(0))


def _read(tag: str, *fields: str) -> Column:
    """Each element of a name as a struct of the texts of its children ``fields``; null where there is none.

    Elements go through the XML parser. One that it refuses goes through it again with bare
    ampersands escaped, and if that fails, its children are found by pattern.
    """
    schema = ", ".join(f"{field} array<string>" for field in fields) + ", _bad string"

    def xml(element: Column) -> Column:
        prefix = F.regexp_extract(element, r"^<((?:[\w.-]+:)?)", 1)
        own = F.concat(F.lit(r"(</?)\Q"), prefix, F.lit(r"\E"))
        bare = F.when(prefix == "", element).otherwise(F.regexp_replace(element, own, F.lit("$1")))
        return F.from_xml(bare, schema, {"columnNameOfCorruptRecord": "_bad"})

    # an element of nothing but its plain children is read by pattern, which gives the same and is faster
    plain = rf"^<{tag}>(?:\s*<({'|'.join(PAGE_FIELDS)})>[^<&]*</\1>)*+\s*</{tag}>$"

    def parsed(found: Column) -> Column:
        return F.struct(
            *[
                F.when(found["plain"], _text_between(found["element"], field))
                .when(found["first"]["_bad"].isNull(), _first(found["first"][field]))
                .when(found["again"].isNotNull() & found["again"]["_bad"].isNull(), _first(found["again"][field]))
                .otherwise(_child(found["element"], tag, field))
                .alias(field)
                for field in fields
            ]
        )

    def once(found: Column) -> Column:
        first = F.when(~found["plain"], xml(found["element"]))
        return F.struct(found["element"].alias("element"), found["plain"].alias("plain"), first.alias("first"))

    def both(found: Column) -> Column:
        # within CDATA an ampersand stands for itself
        escape = found["first"]["_bad"].isNotNull() & ~F.contains(found["element"], F.lit("<![CDATA["))
        again = F.when(escape, xml(F.regexp_replace(found["element"], BARE_AMPERSAND, "&amp;")))
        return F.struct(*(found[n].alias(n) for n in ("element", "plain", "first")), again.alias("again"))

    kinds = F.transform(_elements(tag), lambda e: F.struct(e.alias("element"), e.rlike(plain).alias("plain")))
    return F.transform(F.transform(F.transform(kinds, once), both), parsed)


def _text_between(element: Column, field: str) -> Column:
    """Text of the first child of a name in an element of plain children; null where there is none."""
    text = strip(F.regexp_extract(element, f"<{field}>([^<]*)</", 1))
    # nullif would extract the text twice within a lambda
    return F.when(F.contains(element, F.lit(f"<{field}>")), F.get(F.filter(F.array(text), lambda t: t != ""), F.lit(0)))


def _first(texts: Column) -> Column:
    return F.nullif(strip(F.get(texts, F.lit(0))), F.lit(""))


def _child(element: Column, parent: str, tag: str) -> Column:
    """Text of a child with its parent's prefix, with entities resolved, for elements that the XML parser
    refuses; null if there is none."""
    pattern = rf"^<((?:[\w.-]+:)?){parent}[\s>][\s\S]*?<\1{tag}(?:\s[^>]*)?(?<!/)>([^<]*(?:<!\[CDATA\[[^\]]*\]\]>)?[^<]*)</\1{tag}\s*>"
    text = F.regexp_extract(element, pattern, 2)
    text = F.regexp_replace(text, r"<!\[CDATA\[([^\]]*)\]\]>", "$1")
    for entity, character in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(character))
    return F.nullif(strip(text), F.lit(""))


BARE_AMPERSAND = r"&(?!(?:#[0-9]+|#x[0-9A-Fa-f]+|lt|gt|quot|apos|amp);)"
# fixed values: the entities of XML, the ampersand last
ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&#38;": "&",
    "&#x26;": "&",
    "&amp;": "&",
}


def _feed_links() -> Column:
    """Links of feed items. Of an Atom entry's links the one to itself, else the first."""
    xml = F.from_xml("body", schemas.FEED_XML)

    def own(link: Column) -> Column:
        return F.lower(F.coalesce(link["_rel"], F.lit("self"))) == "self"

    def entry_link(entry: Column) -> Column:
        links = F.concat(F.filter(entry["link"], own), entry["link"])
        return F.get(links, F.lit(0))["_href"]

    items = F.coalesce(xml["channel"]["item"]["link"], F.array())
    return F.concat(items, F.coalesce(F.transform(xml["entry"], entry_link), F.array()))


PAGE_FIELDS = ("loc", "lastmod", "changefreq", "priority")


def _bare_page(url: Column) -> Column:
    nothing = F.lit(None).cast("string")
    return F.struct(url.alias("loc"), *[nothing.alias(f) for f in PAGE_FIELDS[1:]])


def _is_text() -> Column:
    return ~F.col("body").startswith("<") & ~F.col("sitemap_url").endswith(ROBOTS_FILE)


def sitemap_entries(docs: DataFrame) -> DataFrame:
    """Pages the documents list: ``sitemap_url, url, last_modified, change_frequency, priority``.

    Documents are XML sitemaps, RSS or Atom feeds, or text with a URL per line; only the
    first have more than the URL. Each is read once, by the parser of its kind, which its first
    element decides. Bodies may be packed bytes.
    """
    docs = sitemap_text(docs).withColumn("_root", _root_tag())
    urls = F.filter(F.split("body", "\n"), lambda line: line.rlike(WEB_ADDRESS))
    pages = _read("url", *PAGE_FIELDS)
    entries = (
        F.when(F.col("_root") == "urlset", pages)
        .when(F.col("_root").isin("rss", "feed"), F.transform(_feed_links(), _bare_page))
        .when(_is_text(), F.transform(urls, _bare_page))
    )
    pages = docs.select("sitemap_url", F.explode(entries).alias("entry")).select(
        "sitemap_url",
        strip("entry.loc").alias("url"),
        w3c_timestamp("entry.lastmod").alias("last_modified"),
        F.col("entry.changefreq").alias("change_frequency"),
        F.col("entry.priority").alias("priority"),
    )
    return pages.where("url <> ''")


def sitemap_links(docs: DataFrame) -> DataFrame:
    """Sitemaps that index documents and ``robots.txt`` files name:
    ``sitemap_url, linked_url``."""
    indexed = F.transform(_read("sitemap", "loc"), lambda e: e["loc"])
    links = F.when(
        F.col("sitemap_url").endswith(ROBOTS_FILE),
        F.regexp_extract_all("body", F.lit(ROBOTS_SITEMAP), F.lit(1)),
    ).when(_root_tag() == "sitemapindex", indexed)
    return (
        sitemap_text(docs)
        .select("sitemap_url", F.explode(links).alias("link"))
        .select("sitemap_url", strip("link").alias("linked_url"))
        .where("linked_url <> ''")
    )


def sitemap_rejects(docs: DataFrame) -> DataFrame:
    """What the documents hold that is no page or link: ``sitemap_url, reason, n``.

    Reasons are an unreadable or empty body, an XML document of another kind, one that ends before its
    first element does, a feed that is no well-formed XML, entries without an address and dates that
    cannot be read, with their number.
    """
    docs = sitemap_text(docs).withColumn("_root", _root_tag())
    kinds = ("urlset", "sitemapindex", "rss", "feed")
    cut = ~F.col("body").rlike(r"</(?:[\w.-]+:)?(?:urlset|sitemapindex|rss|feed)\s*>\s*(?:<!--[^>]*-->\s*)*$")
    cut &= ~F.col("body").rlike(r"/>\s*$")
    feed = F.from_xml("body", schemas.FEED_XML)
    element = F.when(F.col("_root") == "urlset", "url").when(F.col("_root") == "sitemapindex", "sitemap")
    opened = F.when(element == "url", _opened("url")).otherwise(_opened("sitemap"))
    addressed = F.when(element == "url", _addressed("url")).otherwise(_addressed("sitemap"))
    undated = F.size(
        F.filter(
            _read("url", "lastmod"),
            lambda e: e["lastmod"].isNotNull() & w3c_timestamp(e["lastmod"]).isNull(),
        )
    )
    is_robots = F.col("sitemap_url").endswith(ROBOTS_FILE)
    reasons = {
        "unreadable body": F.when(F.col("body").isNull(), 1),
        "empty body": F.when(~is_robots & (F.col("body") == ""), 1),
        "no sitemap": F.when(
            ~is_robots & F.col("body").startswith("<") & ~F.col("_root").isin(*kinds), 1
        ),
        "ends within the document": F.when(F.col("_root").isin(*kinds) & cut, 1),
        "no well-formed feed": F.when(
            F.col("_root").isin("rss", "feed") & feed["channel"].isNull() & feed["entry"].isNull(), 1
        ),
        "no address": F.when(element.isNotNull(), opened - addressed),
        "no date": F.when(F.col("_root") == "urlset", undated),
    }
    found = F.array(
        *[F.struct(F.lit(r).alias("reason"), n.cast("long").alias("n")) for r, n in reasons.items()]
    )
    return docs.select("sitemap_url", F.explode(found).alias("found")).select(
        "sitemap_url", "found.reason", "found.n"
    ).where("n > 0")


def _opened(tag: str) -> Column:
    return F.regexp_count("body", F.lit(rf"<(?:[\w.-]+:)?{tag}(?:\s[^>]*)?>"))


def _addressed(tag: str) -> Column:
    return F.size(F.filter(_read(tag, "loc"), lambda e: e["loc"].isNotNull()))


def reachable_sitemaps(links: DataFrame, roots: DataFrame) -> DataFrame:
    """``sitemap_url`` of all sitemaps reachable from the given ones, themselves included."""
    starts = roots.select(F.lit("").alias("root"), "sitemap_url")
    return reached_from(links, starts).select("sitemap_url")


def sitemap_starts(sitemaps: DataFrame, url: str = "sitemap_url") -> DataFrame:
    """Where the walk of each site begins: ``root, sitemap_url`` of the sitemaps known by their paths, and of
    the site's robots file."""
    known = sitemap_roots(sitemaps, url)
    paths = F.explode(F.array(F.col("path"), F.lit(ROBOTS_FILE))).alias("path")
    return known.select("root", paths).select("root", F.concat("root", "path").alias("sitemap_url")).distinct()


def reached_from(links: DataFrame, starts: DataFrame) -> DataFrame:
    """``root, sitemap_url``: the sitemaps reachable from each root's ``starts`` (the same columns),
    themselves included.

    Most trees end a few links below their starts, so these are followed first, all at once. If more is
    reached, links are shortened: a sitemap that one other names, and where the walk does not go on from,
    is linked to the first that is named more often, or where it goes on, on the way up to it. That
    takes a logarithmic number of rounds, as every round doubles the length of the links. Diamonds collapse
    on the way, so rounds follow what is left. The walk over the shortened links goes level by level,
    with all roots at once.
    """
    edges = links.select(F.col("sitemap_url").alias("a"), F.col("linked_url").alias("b"))
    edges = stored(edges.where("a <> b").distinct(), "links")
    near = [stored(starts.select("root", "sitemap_url").distinct(), "starts")]
    for _ in range(NEAR_LEVELS):
        near.append(_linked(near[-1], edges).distinct())
    steps = reduce(DataFrame.unionAll, [df.withColumn("steps", F.lit(i)) for i, df in enumerate(near)])
    steps = stored(steps.groupBy("root", "sitemap_url").agg(F.min("steps").alias("steps")), "reached")
    found, level = steps.drop("steps"), steps.where(F.col("steps") == NEAR_LEVELS).drop("steps")
    if _linked(level, edges).join(found, ["root", "sitemap_url"], "left_anti").isEmpty():
        return found
    edges, depth = _shortened(edges, level.select(F.col("sitemap_url").alias("b")).distinct()), 0
    partitions = partitions_for(links.sparkSession)
    while True:
        level = _linked(level, edges).distinct()
        level = stored(level.join(found, ["root", "sitemap_url"], "left_anti"), "level")
        if level.isEmpty():
            return found
        found, depth = found.unionAll(level), depth + 1
        if depth % LEVELS_TOGETHER == 0:  # or the plan would grow with every level
            found = stored(found.coalesce(partitions), "reached")


def _linked(level: DataFrame, edges: DataFrame) -> DataFrame:
    """``root, sitemap_url`` of what the sitemaps of ``level`` are linked to."""
    level = level.join(edges, level["sitemap_url"] == edges["a"])
    return level.select("root", F.col("b").alias("sitemap_url"))


def _shortened(edges: DataFrame, heads: DataFrame) -> DataFrame:
    """Links ``a, b`` such that the same is reachable from ``heads`` (``b``), with chains cut short."""
    while True:
        named = edges.groupBy("b").agg(F.min("a").alias("a"), F.count("*").alias("n"))
        named = stored(named.join(heads, "b", "left_anti"), "named")
        once, chain = named.isEmpty() or named.where("n > 1").isEmpty(), named.where("n = 1").drop("n")
        most, reach, going = chain.count(), 1, False
        while reach <= 2 * most:
            chain = stored(_doubled(_doubled(chain.withColumn("on", F.lit(False)))), "chain")
            reach, going, chain = 4 * reach, not chain.where("on").isEmpty(), chain.drop("on")
            if not going:
                break
        up = chain.select(F.col("b").alias("a"), F.col("a").alias("far"))
        edges = edges.join(up, "a", "left").select(
            F.coalesce("far", "a").alias("a"), "b", F.col("far").isNotNull().alias("moved")
        )
        edges = edges.where("a <> b")
        if going:  # what still hangs on a link of the chain hangs on a ring that nothing leads into
            lost = chain.join(chain.select(F.col("b").alias("a")), "a", "left_semi").select("b")
            edges = edges.join(lost, "b", "left_anti")
        edges = stored(edges.groupBy("a", "b").agg(F.max("moved").alias("moved")), "links")
        moved, edges = not edges.where("moved").isEmpty(), edges.drop("moved")
        # where no two links lead to one sitemap, none can fall together
        if once or not moved:
            return edges


def _doubled(chain: DataFrame) -> DataFrame:
    """``b, a, on``: links of twice the length; ``on`` where this or the last doubling made one longer."""
    up = chain.select(F.col("b").alias("a"), F.col("a").alias("far"))
    joined = chain.join(up, "a", "left")
    return joined.select("b", F.coalesce("far", "a").alias("a"), (F.col("on") | F.col("far").isNotNull()).alias("on"))


def pages_per_root(docs: DataFrame, sitemaps: DataFrame) -> DataFrame:
    """Pages of each site: ``root`` and the columns of ``sitemap_entries``, for every document of ``docs`` in
    the tree that begins with the site's robots file and its ``sitemaps`` (column ``sitemap_url``).

    A sitemap counts for the site whose tree holds it, wherever it lies, and for each of them.
    """
    reached = reached_from(sitemap_links(docs), sitemap_starts(sitemaps))
    entries = sitemap_entries(docs).withColumn("_at", F.monotonically_increasing_id())
    pages = _spread_join(reached, stored(entries, "entries"))
    return pages.select("root", "sitemap_url", "url", "last_modified", "change_frequency", "priority")


def _spread_join(reached: DataFrame, entries: DataFrame) -> DataFrame:
    """``reached`` joined to ``entries``, numbered in ``_at``, by ``sitemap_url``.

    A sitemap of many pages that many sites share gives rows by the product of both, from little input. Its
    entries are dealt into pieces, and its sites go to each, so that a piece gives about ``PIECE_ROWS`` rows.
    """
    spark = reached.sparkSession
    sites = reached.groupBy("sitemap_url").agg(F.count("*").alias("_sites"))
    counts = entries.groupBy("sitemap_url").agg(F.count("*").alias("_n")).join(sites, "sitemap_url")
    rows = F.col("_n").cast("double") * F.col("_sites")
    pieces = F.least(F.col("_n"), F.ceil(rows / PIECE_ROWS)).cast("int")
    counts = stored(counts.select("sitemap_url", pieces.alias("_pieces"), rows.alias("_rows")), "pieces")
    n = partitions_for(spark, int(counts.agg(F.sum("_rows")).first()[0] or 0), 2 * PIECE_ROWS)
    large = counts.where("_pieces > 1").drop("_rows")

    def dealt(df: DataFrame, piece: Column) -> DataFrame:
        held = df.join(large, "sitemap_url", "left").withColumn("_piece", piece).drop("_pieces")
        return held.repartition(n, "sitemap_url", "_piece")

    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))
    piece = F.pmod("_at", F.coalesce("_pieces", F.lit(1))).cast("int")
    return dealt(reached, copies).join(dealt(entries, piece).hint("merge"), ["sitemap_url", "_piece"]).drop("_piece")


def root_counts(pages: DataFrame) -> DataFrame:
    """``root, n_sitemaps, n_entries, n_pages`` of ``pages_per_root``: sitemaps with pages, entries and
    distinct addresses. Each is counted within its sitemap or address first, so a great site spreads."""
    sitemaps = pages.groupBy("root", "sitemap_url").agg(F.count("*").alias("n"))
    sitemaps = sitemaps.groupBy("root").agg(
        F.count("*").alias("n_sitemaps"), F.sum("n").alias("n_entries")
    )
    urls = pages.select("root", "url").distinct().groupBy("root").agg(F.count("*").alias("n_pages"))
    return sitemaps.join(urls, "root").select("root", "n_sitemaps", "n_entries", "n_pages")


def counts_per_root(docs: DataFrame, sitemaps: DataFrame) -> DataFrame:
    """``root_counts`` of ``pages_per_root``, without a row for each page of each site.

    Addresses that lie in the same sitemaps are counted as one class, and a site's classes are added up. So
    pages that one sitemap holds, or several sitemaps hold alike, cost a site a row, however many they are.
    """
    reached = reached_from(sitemap_links(docs), sitemap_starts(sitemaps))
    listed = sitemap_entries(docs).where("sitemap_url IS NOT NULL")
    listed = stored(listed.groupBy("sitemap_url", "url").agg(F.count("*").alias("n")), "listed")
    sizes = listed.groupBy("sitemap_url").agg(F.sum("n").alias("n"))
    totals = reached.join(sizes, "sitemap_url").groupBy("root").agg(
        F.count("*").alias("n_sitemaps"), F.sum("n").alias("n_entries")
    )
    held = reached.join(_classes(listed), "sitemap_url").groupBy("root", "held", "mark", "url")
    pages = held.agg(F.first("n").alias("n")).groupBy("root").agg(F.sum("n").alias("n_pages"))
    return totals.join(pages, "root").select("root", "n_sitemaps", "n_entries", "n_pages")


def _classes(listed: DataFrame) -> DataFrame:
    """``sitemap_url, held, mark, url, n``: classes (``held, mark, url``) of addresses that lie in the same
    sitemaps, with the number of addresses, for each of those sitemaps. ``listed`` has distinct
    ``sitemap_url, url``.

    A class is found by how many sitemaps hold an address, and a hash over them. Where the addresses
    of a class lie in more sitemaps together than each does, the hash was the same by chance, and each is
    a class of its own.
    """
    marks = listed.groupBy("url").agg(F.count("*").alias("held"), F.bit_xor(_mark("sitemap_url")).alias("mark"))
    marked = stored(listed.join(marks, "url").select("sitemap_url", "url", "held", "mark"), "marked")
    classes = marked.groupBy("sitemap_url", "held", "mark").agg(F.count("*").alias("n"))
    classes = stored(classes, "classes")
    mixed = classes.groupBy("held", "mark").agg(F.count("*").alias("all")).where("all <> held").drop("all")
    whole = classes.join(mixed, ["held", "mark"], "left_anti")
    single = marked.join(mixed, ["held", "mark"], "left_semi")
    return whole.select("sitemap_url", "held", "mark", F.lit(None).cast("string").alias("url"), "n").unionAll(
        single.select("sitemap_url", "held", "mark", "url", F.lit(1).cast("bigint").alias("n"))
    )


def _mark(name: str) -> Column:
    return F.xxhash64(name)


def distinct_pages(pages: DataFrame, by: str = "page") -> DataFrame:
    """Pages once: all their fields alike, or one row per URL with its latest date."""
    if by == "page":
        return pages.drop("sitemap_url").distinct()
    if by == "url":
        return pages.groupBy("url").agg(F.max("last_modified").alias("last_modified"))
    raise ValueError(f"by must be 'page' or 'url': {by!r}")


def date_bound(text: str | None, default: str | None = None) -> datetime | None:
    """A bound as given, else the default, else none. A zone in the text is dropped: the
    clock time written counts as UTC."""
    chosen = text or default
    if not chosen:
        return None
    return date_parser.parse(chosen).replace(tzinfo=UTC)


def filter_by_date(
    pages: DataFrame,
    from_date: str | None = None,
    to_date: str | None = None,
    default_from: str | None = None,
    default_to: str | None = None,
    keep_undated: bool = False,
) -> DataFrame:
    """Pages with ``from <= last_modified < to``; either bound may be missing.

    Pages without a date are dropped once a bound is set, unless ``keep_undated``.
    """
    bounds = date_bound(from_date, default_from), date_bound(to_date, default_to)
    return pages.where(_in_range(*bounds, keep_undated))


def _in_range(lower: datetime | None, upper: datetime | None, keep_undated: bool = False) -> Column:
    modified = F.col("last_modified")
    test = F.lit(True)
    if lower:
        test &= modified >= F.lit(lower)
    if upper:
        test &= modified < F.lit(upper)
    return test | modified.isNull() if keep_undated else test


def sitemap_counts(
    entries: DataFrame, from_date: str | None = None, to_date: str | None = None
) -> DataFrame:
    """Per site: entries of its sitemaps, distinct pages and distinct pages within the dates:
    ``root, n_entries, n_pages, n_in_range``. Counted per page first, which is also when they are
    made distinct."""
    fields = [c for c in entries.columns if c != "sitemap_url"]
    pages = entries.groupBy(site_root("sitemap_url").alias("root"), *fields).agg(
        F.count("*").alias("_n")
    )
    inside = _in_range(date_bound(from_date), date_bound(to_date))
    return pages.groupBy("root").agg(
        F.sum("_n").alias("n_entries"),
        F.count("*").alias("n_pages"),
        F.count_if(inside).alias("n_in_range"),
    )
