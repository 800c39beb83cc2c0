"""Pipeline steps against plain pandas on random tables with one very frequent URL."""

import random

import pandas as pd
import pytest

from archivetables import operators as ops


def random_tables(seed):
    rng = random.Random(seed)

    def url():
        return "hot" if rng.random() < 0.35 else f"u{rng.randrange(30)}"

    pages = [
        (rng.choice("ab"), f"pages/{rng.choice(['pages', 'extraPages'])}.jsonl", url(), f"t{i}", i)
        for i in range(120)
    ]
    cdx = [
        (rng.choice("ab"), url(), rng.choice(["f1", "f2", None]), str(rng.randrange(1, 10**6)), str(i))
        for i in range(400)
    ]
    return pages, cdx


PAGES = ["wacz_path", "pages_file", "url", "title", "line_pos"]
CDX = ["wacz_path", "url", "filename", "offset", "length"]
KEYS = ["wacz_path", "url"]


def expected_pointers(pages, cdx, order):
    pages = pages.assign(extra=pages.pages_file.str.contains("extra"))
    pages = pages.sort_values(["extra", "line_pos"])
    joined = pages.merge(cdx, how="left", on=KEYS)
    joined = joined[~joined.filename.isna()]
    joined["rank"] = joined.offset.astype(int) if order == "numeric" else joined.offset
    joined = joined.sort_values(["rank", "offset", "filename", "length"], kind="stable")
    last = joined.drop_duplicates(KEYS, keep="last")
    return {tuple(r) for r in last[[*KEYS, "title", "filename", "offset", "length"]].itertuples(index=False)}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("order", ["numeric", "lexicographic"])
def test_pointers_are_what_join_then_keep_last_gives(spark, seed, order):
    pages, cdx = random_tables(seed)
    spark_pages = spark.createDataFrame(
        pages, "wacz_path string, pages_file string, url string, title string, line_pos bigint"
    )
    spark_cdx = spark.createDataFrame(
        cdx, "wacz_path string, url string, filename string, offset string, length string"
    )
    got = ops.record_pointers(spark_pages, spark_cdx, order).drop("offset_num").collect()
    assert len(got) == len(set(got))
    pages, cdx = pd.DataFrame(pages, columns=PAGES), pd.DataFrame(cdx, columns=CDX)
    assert {tuple(r) for r in got} == expected_pointers(pages, cdx, order)
    counts = {r.stage: r.n_rows for r in ops.pipeline_counts(spark_pages, spark_cdx).collect()}
    joined = pages.merge(cdx[~cdx.filename.isna()], on=KEYS)
    assert counts["joined"] == len(joined) == ops.join_captures(spark_pages, spark_cdx).count()
    assert counts["records"] == len(got)


@pytest.mark.parametrize("seed", range(2))
def test_url_matches(spark, seed):
    pages, cdx = random_tables(seed)
    cdx = [row for row in cdx if row[2]][: 40 + 40 * seed]
    spark_pages = spark.createDataFrame(
        pages, "wacz_path string, pages_file string, url string, title string, line_pos bigint"
    )
    spark_cdx = spark.createDataFrame(
        cdx, "wacz_path string, url string, filename string, offset string, length string"
    )
    wanted = ["hot", "nowhere", *(f"u{i}" for i in range(0, 30, 2))]
    frame = spark.createDataFrame([(u,) for u in wanted + ["hot"]], "url string")
    got = {(r.wacz_path, r.url): r.match_count
           for r in ops.match_urls(frame, spark_pages, spark_cdx).collect()}
    joined = pd.DataFrame(pages, columns=PAGES).merge(pd.DataFrame(cdx, columns=CDX), on=KEYS)
    expected = joined[joined.url.isin(wanted)].groupby(KEYS).size().to_dict()
    found = {url for _, url in expected}
    expected |= {(None, url): 0 for url in wanted if url not in found}
    assert got == expected
