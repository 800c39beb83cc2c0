"""What the physical plans must look like for the jobs to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from archivetables import generate_records, harvest_tables
from archivetables import operators as ops
from archivetables.plans import records_from_tables
from tests.helpers import cdx_line, http_block, page_list, warc_file, warc_record, write_archive
from workload import tables as tb

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(plan):
    return len(re.findall(r"\bExchange ", plan))


def test_pointers_shuffle_each_side_once(spark):
    crawl = F.substring("url", 9, 4)  # not a literal, which Spark would fold away
    pages = tb.seed_pages(spark, SF_DIR).withColumn("wacz_path", crawl)
    cdx = tb.html_shop_captures(spark, SF_DIR).withColumn("wacz_path", crawl)
    plan = plan_of(ops.record_pointers(pages, cdx))
    assert exchanges(plan) == 2 and plan.count("partial_max(") == 2
    assert "PushedFilters" in plan and "l_comment" not in plan


def test_deletes_shuffle_each_list_once(spark):
    urls = tb.order_sitemap(spark, SF_DIR).select("url")
    plan = plan_of(ops.deleted_urls(urls, urls.where("url LIKE '%1'")))
    assert exchanges(plan) == 2 and "LeftAnti" in plan


def test_ranking_is_cut_before_its_shuffle(spark):
    records = tb.html_shop_captures(spark, SF_DIR).withColumnRenamed("offset", "cdx_offset")
    plan = plan_of(ops.drop_duplicate_urls_window(records))
    assert re.search(r"WindowGroupLimit.*Partial", plan)


def test_payload_is_read_after_dedup_and_never_shuffled(spark):
    pages, cdx = tb.seed_pages(spark, SF_DIR), tb.html_shop_captures(spark, SF_DIR)
    deletes = spark.createDataFrame([("u", "deleted")], "url string, status string")
    plan = plan_of(records_from_tables(pages, cdx, deletes))
    above, below = plan.split("MapInArrow", 1)
    assert not re.search(r"\bExchange ", above)
    assert "REPARTITION_BY_NUM" in below and "LeftAnti" in below and "max(" in below


def test_index_text_is_parsed_once(spark):
    plan = plan_of(ops.html_captures(ops.parse_cdx(tb.index_lines(spark, SF_DIR))))
    assert plan.count("from_json") == 1


def test_looked_up_urls_are_cut_before_they_meet(spark):
    crawl = F.substring("url", 9, 4)
    pages = tb.seed_pages(spark, SF_DIR).withColumn("wacz_path", crawl)
    cdx = tb.html_shop_captures(spark, SF_DIR).withColumn("wacz_path", crawl)
    wanted = tb.order_sitemap(spark, SF_DIR).select("url")
    plan = plan_of(ops.match_urls(wanted, pages, cdx))
    # each side's rows per URL are added up before its first shuffle
    assert plan.count("partial_max(") == 2
    for side in plan.split("partial_max(")[1:]:
        assert not re.search(r"\bExchange ", side.split("Scan")[0])


def test_sitemap_bodies_are_not_shuffled(spark):
    docs = tb.sitemap_docs(spark, SF_DIR)
    reached = docs.select("sitemap_url").where("sitemap_url LIKE '%1.xml'")
    entries = ops.sitemap_entries(docs).join(reached, "sitemap_url", "left_semi")
    lines = plan_of(ops.distinct_pages(entries)).split("\n")
    generate = [i for i, line in enumerate(lines) if "Generate" in line]
    first = min(i for i, line in enumerate(lines) if re.search(r"Exchange hashpartitioning\(sitemap_url", line))
    assert first < generate[0] and not any("body" in line for line in lines[: generate[0]])


def test_filters_reach_the_scan(spark):
    pages = tb.order_sitemap(spark, SF_DIR).select("url", "last_modified")
    plan = plan_of(ops.filter_by_date(pages, "1996-02-01", "1998-03-01"))
    read = re.search(r"ReadSchema: struct<([^>]*)", plan)[1]
    assert {c.split(":")[0] for c in read.split(",")} == {"o_custkey", "o_orderkey", "o_orderdate"}


def test_numbering_splits_a_log(spark):
    status = ops.crawl_status(tb.crawl_log(spark, SF_DIR))
    plan = plan_of(ops.sample_statuses(status))
    windows = re.findall(r"Window \[(row_number|sum)[^\n]*", plan)
    assert "row_number" in windows
    assert re.search(r"row_number\(\) windowspecdefinition\(path#\d+, block#\d+", plan)


def test_null_offsets_do_not_break_pointer_blocks(spark):
    df = spark.createDataFrame([(None,), (1,)], "offset_num bigint")
    assert df.select(F.expr("offset_num div 10")).collect()[0][0] is None


N_PAGES = 2000


@pytest.fixture(scope="module")
def long_crawl(tmp_path_factory):
    """An archive of one split per list, which makes some hundred bytes of splits, and its URLs."""
    urls = [f"https://example.org/{i}" for i in range(N_PAGES)]
    data, _ = warc_file(warc_record(http_block(b"<p>")))
    path = write_archive(
        tmp_path_factory.mktemp("crawl") / "long.wacz",
        {
            "pages/pages.jsonl": page_list(*({"url": u, "title": "t"} for u in urls)),
            "indexes/index.cdxj": "".join(map(cdx_line, urls)),
            "archive/rec-0.warc.gz": data,
        },
    )
    return path, urls


def final_plan(spark, records):
    """What ran, where some kilobytes are too much to be broadcast; and the rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32k")
    try:
        rows = records.collect()
        text = records._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return text.split("== Initial Plan ==")[0], rows


@pytest.mark.parametrize("ordered", [False, True])
def test_captures_are_not_broadcast_for_the_size_of_their_splits(spark, long_crawl, ordered):
    path, urls = long_crawl
    previous = spark.createDataFrame([(u,) for u in [*urls, "https://example.org/gone"]], "url string")
    current = previous.where("url RLIKE '[0-4]$'")
    plan, rows = final_plan(spark, generate_records(spark, path, current, previous, ordered=ordered))
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") >= 3
    gone = {u for u in urls if u[-1] in "56789"} | {"https://example.org/gone"}
    assert {r.url for r in rows if r.status == "deleted"} == gone
    assert sorted(r.url for r in rows if r.status == "active") == sorted(set(urls) - gone)


def test_deletes_from_list_files_are_not_broadcast_for_the_size_of_their_splits(spark, long_crawl, tmp_path):
    path, urls = long_crawl
    previous = tmp_path / "previous.txt"
    previous.write_text("".join(f"{u}\n{u}/gone\n" for u in urls))
    current = spark.createDataFrame([(u,) for u in urls], "url string")
    plan, rows = final_plan(spark, generate_records(spark, path, current, str(previous)))
    assert "BroadcastHashJoin" not in plan
    assert len(rows) == 2 * N_PAGES and sum(r.status == "deleted" for r in rows) == N_PAGES


def test_harvested_captures_are_not_broadcast_for_the_size_of_their_splits(spark, long_crawl):
    path, urls = long_crawl
    pages = [f"<url><loc>{u}</loc></url>" for u in urls if u[-1] in "01234"]
    docs = spark.createDataFrame([("s.xml", f"<urlset>{''.join(pages)}</urlset>")], "sitemap_url string, body string")
    previous = spark.createDataFrame([(u,) for u in urls], "url string")
    tables = harvest_tables(spark, path, docs, previous, docs.select("sitemap_url"))
    plan, rows = final_plan(spark, tables.records)
    assert not re.search(r"BroadcastHashJoin \[(key_hash#\d+L, wacz_path|url)#", plan)
    assert sorted(r.url for r in rows if r.status == "active") == sorted(u for u in urls if u[-1] in "01234")
    assert sorted(r.url for r in rows if r.status == "deleted") == sorted(u for u in urls if u[-1] in "56789")
