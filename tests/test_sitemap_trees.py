"""Walks of sitemap links: any shape, many roots at once, in few rounds."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from archivetables import operators as ops
from archivetables.operators import sitemaps


def walk(edges, starts):
    found = set()
    for root, start in starts:
        todo = [start]
        while todo:
            at = todo.pop()
            if (root, at) not in found:
                found.add((root, at))
                todo += [b for a, b in edges if a == at]
    return found


def tables(spark, edges, starts):
    links = spark.createDataFrame(edges, "sitemap_url string, linked_url string")
    return links, spark.createDataFrame(starts, "root string, sitemap_url string")


def check(spark, edges, starts):
    got = [tuple(r) for r in ops.reached_from(*tables(spark, edges, starts)).collect()]
    assert len(got) == len(set(got)) and set(got) == walk(edges, starts)


CHAIN = [(f"c{i}", f"c{i + 1}") for i in range(50)]
RING = [("r0", "r1"), ("r1", "r2"), ("r2", "r0"), ("r2", "off"), ("off", "off2")]
LADDER = [(f"d{i}", f"{side}{i}") for i in range(12) for side in "xy"] + [
    (f"{side}{i}", f"d{i + 1}") for i in range(12) for side in "xy"
]
BRAID = [(f"{a}{i}", f"{b}{i + 1}") for i in range(6) for a in "pq" for b in "pq"]


@pytest.mark.parametrize(
    ("edges", "starts"),
    [
        (CHAIN + RING + LADDER + BRAID + [("c9", "c9"), ("c40", "c3"), ("c50", "d0"), ("d3", "p0"), ("null", None)],
         [("a", "c0"), ("b", "c20"), ("b", "q2"), ("c", "off"), ("d", "nowhere"), ("a", "c0")]),
        (RING + [("r1", "c0")] + CHAIN, [("a", "r1"), ("b", "c49")]),
        ([("a", "b")], []),
    ],
)
def test_shapes(spark, edges, starts):
    check(spark, edges, starts)


@pytest.mark.parametrize("seed", range(3))
def test_random_links(spark, seed):
    rng = random.Random(seed)
    n = 40
    edges = [(f"s{rng.randrange(n)}", f"s{rng.randrange(n)}") for _ in range(rng.choice([30, 45, 60]))]
    check(spark, edges, [(f"root{rng.randrange(4)}", f"s{rng.randrange(n)}") for _ in range(6)])


def test_a_long_chain_and_a_tall_ladder_take_few_rounds(spark, monkeypatch):
    rounds = []
    store = sitemaps.stored
    monkeypatch.setattr(sitemaps, "stored", lambda df, label: rounds.append(label) or store(df, label))
    edges = [(f"c{i}", f"c{i + 1}") for i in range(400)]
    check(spark, edges, [("a", "c0")])
    assert len(rounds) <= 12
    rounds.clear()
    check(spark, LADDER, [("a", "d0")])
    assert rounds.count("level") <= 3


def test_pages_count_for_the_root_whose_tree_holds_them(spark):
    docs = spark.createDataFrame(
        [
            ("https://a.com/robots.txt", "Sitemap: https://cdn.net/shared.xml\nsitemap: https://cdn.net/a.xml"),
            ("https://b.com/robots.txt", "Sitemap: https://cdn.net/shared.xml"),
            ("https://b.com/news.xml", "<urlset><url><loc>https://b.com/n</loc></url></urlset>"),
            ("https://cdn.net/shared.xml", "<urlset><url><loc>https://x/1</loc></url><url><loc>https://x/2</loc></url></urlset>"),
            ("https://cdn.net/a.xml", "<sitemapindex><sitemap><loc>https://a.com/p.xml</loc></sitemap></sitemapindex>"),
            ("https://a.com/p.xml", "<urlset><url><loc>https://x/1</loc></url></urlset>"),
            ("https://cdn.net/lost.xml", "<urlset><url><loc>https://x/3</loc></url></urlset>"),
        ],
        "sitemap_url string, body string",
    )
    known = spark.createDataFrame([("https://a.com/sitemap.xml",), ("https://b.com/news.xml?v=1",)], "sitemap_url string")
    assert {tuple(r) for r in ops.sitemap_starts(known).collect()} == {
        (f"https://{s}.com", f"https://{s}.com{p}") for s, p in
        [("a", "/sitemap.xml"), ("a", "/robots.txt"), ("b", "/news.xml"), ("b", "/robots.txt")]
    }
    pages = ops.pages_per_root(docs, known)
    assert sorted((r.root[8], r.sitemap_url.rsplit("/")[-1], r.url[-1]) for r in pages.collect()) == [
        ("a", "p.xml", "1"), ("a", "shared.xml", "1"), ("a", "shared.xml", "2"),
        ("b", "news.xml", "n"), ("b", "shared.xml", "1"), ("b", "shared.xml", "2"),
    ]
    assert {tuple(r)[1:] for r in ops.root_counts(pages).collect()} == {(2, 3, 2), (2, 3, 3)}


def test_a_shallow_tree_is_walked_without_shortening(spark, monkeypatch):
    monkeypatch.setattr(sitemaps, "_shortened", None)
    edges = [("robots", "index"), ("index", "one"), ("index", "two"), ("one", "index"), ("other", "one")]
    check(spark, edges, [("a", "robots"), ("b", "one"), ("b", "none"), ("c", "two")])


def shared_pages(spark, n_sites, n_pages):
    """Sites that share a large sitemap, and another that holds half of its pages twice over."""
    page = "<url><loc>https://x/{}</loc></url>"
    docs = [("https://cdn.net/all.xml", f"<urlset>{''.join(page.format(i) for i in range(n_pages))}</urlset>"),
            ("https://cdn.net/half.xml", f"<urlset>{''.join(page.format(i // 2) for i in range(n_pages))}</urlset>")]
    for i in range(n_sites):
        lines = ["sitemap: https://cdn.net/all.xml"] * (i % 3 > 0) + ["sitemap: https://cdn.net/half.xml"] * (i % 2)
        docs.append((f"https://s{i}.com/robots.txt", "\n".join(lines)))
        docs.append((f"https://s{i}.com/own.xml", f"<urlset>{page.format(i)}{page.format(f'own-{i}')}</urlset>"))
    known = [(f"https://s{i}.com/own.xml",) for i in range(n_sites)]
    return spark.createDataFrame(docs, "sitemap_url string, body string"), spark.createDataFrame(known, "sitemap_url string")


def test_a_sitemap_that_many_sites_share_is_dealt_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sitemaps, "PIECE_ROWS", 200)
    pages = ops.pages_per_root(*shared_pages(spark, 30, 100))
    got = pages.where("sitemap_url LIKE '%all.xml'").select("root", "url", F.spark_partition_id().alias("task"))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len({r[:2] for r in rows}) == 20 * 100
    tasks = Counter(r[2] for r in rows)
    assert len(tasks) > 3 and max(tasks.values()) <= 1000


@pytest.mark.parametrize("alike", [False, True])
def test_counts_per_root_make_no_row_for_each_page_of_each_site(spark, monkeypatch, alike):
    if alike:  # as if hashes of all sitemaps were the same by chance
        monkeypatch.setattr(sitemaps, "_mark", lambda name: F.length(name) * 0 + F.lit(0).cast("bigint"))
    docs, known = shared_pages(spark, 12, 40)
    expected = {tuple(r) for r in ops.root_counts(ops.pages_per_root(docs, known)).collect()}
    monkeypatch.setattr(sitemaps, "pages_per_root", None)
    assert {tuple(r) for r in ops.counts_per_root(docs, known).collect()} == expected
    assert len(expected) == 12 and ("https://s5.com", 3, 82, 41) in expected


def test_classes_of_addresses_are_few(spark):
    listed = [(s, f"u{i}") for i in range(50) for s in ("a", "b")] + [("a", "x"), ("c", "y"), ("c", "z")]
    listed = spark.createDataFrame(listed, "sitemap_url string, url string")
    got = sorted((r.sitemap_url, r.held, r.n) for r in sitemaps._classes(listed).collect())
    assert got == [("a", 1, 1), ("a", 2, 50), ("b", 2, 50), ("c", 1, 2)]


def test_plain_elements_read_by_pattern_as_by_the_parser(spark):
    """The same elements with a comment, which sends them to the XML parser once it is cut, or an attribute."""
    fields = "<loc>\n h/{} </loc><lastmod>2024-01-0{}</lastmod><priority/><changefreq></changefreq>"
    bodies = []
    for i in range(1, 9):
        inner = fields.format(i, i) if i % 2 else f"<priority>0.{i}</priority> <loc>h/{i}</loc> <loc>h/again</loc>"
        bodies.append((f"plain {i}", f"<urlset><url>{inner}</url></urlset>"))
        bodies.append((f"odd {i}", f"<urlset><url id='1'>{inner}<x>1</x></url></urlset>"))
    docs = spark.createDataFrame(bodies, "sitemap_url string, body string")
    rows = {r.sitemap_url: tuple(r)[1:] for r in ops.sitemap_entries(docs).collect()}
    assert len(rows) == 16 and all(rows[f"plain {i}"] == rows[f"odd {i}"] for i in range(1, 9))
