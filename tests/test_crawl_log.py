import pytest

from archivetables import operators as ops

STATUS = '{"logLevel":"info","context":"crawlStatus","details":{"crawled":%d,"total":9,"limit":{"max":0},"x":1}}'


def log(spark, *logs):
    rows = [(f"log{i}", n, line) for i, lines in enumerate(logs) for n, line in enumerate(lines)]
    return spark.createDataFrame(rows, "path string, line_no bigint, line string")


def test_status_fields(spark):
    lines = [
        f"  {STATUS % 5}\n", "", "  ", STATUS[:-2] % 6, '{"context": "crawlStatus"}',
        '{"context":"crawlStatus"}', '["\\"context\\":\\"crawlStatus\\""]', '[{"context":"crawlStatus"}]',
        '{"context":"crawlStatus","details":{"crawled":"7","pending":null,"failed":"no"}}',
    ]
    got = ops.crawl_status(log(spark, lines)).orderBy("line_no").collect()
    assert [(r.line_no, r.crawled, r.total, r.pending, r.failed, r.limit) for r in got] == [
        (0, 5, 9, None, None, '{"max":0}'), (5, None, None, None, None, None),
        (8, 7, None, None, None, None),
    ]


@pytest.mark.parametrize(
    ("count", "sampled", "tail"),
    [(99, [], [97, 98, 99]), (100, [100], []), (101, [100], [101]), (250, [100, 200], [248, 249, 250])],
)
@pytest.mark.parametrize("block", [1, 7, 1000])
def test_sample_and_tail(spark, count, sampled, tail, block):
    other = [STATUS % 1, STATUS % 2]
    status = ops.crawl_status(log(spark, [STATUS % (i + 1) for i in range(count)], other))
    rows = ops.sample_statuses(status, block=block).collect()
    assert sorted(r.crawled for r in rows) == sampled
    assert all(r.entry_no == r.crawled for r in rows)
    last = ops.last_statuses(status, block=block).collect()
    assert sorted(r.crawled for r in last if r.path == "log0") == tail
    assert sorted(r.crawled for r in last if r.path == "log1") == [1, 2]


def test_fatal_classes(spark):
    lines = [
        '{"logLevel":"fatal","message":"No valid seeds specified, aborting"}',
        '{"logLevel":"fatal","message":"disk"}', '{"logLevel":"fatal"}', '{"logLevel":"fatal" cut',
        '{"logLevel": "fatal","message":"spaced"}', "plain", " ",
    ]
    got = ops.crawl_fatal(log(spark, lines)).orderBy("line_no").collect()
    assert [(r["class"], r.message) for r in got] == [
        ("no_valid_seeds", "No valid seeds specified, aborting"), ("fatal", "disk"),
        ("fatal", '{"logLevel":"fatal"}'), ("unparsable", '{"logLevel":"fatal" cut'),
        ("ok", None), ("ok", None),
    ]


def test_first_fatal_decides(spark):
    seeds = '{"logLevel":"fatal","message":"No valid seeds specified"}'
    disk = '{"logLevel":"fatal","message":"disk"}'
    got = ops.first_fatal(log(spark, ["x", seeds, disk], ["ok"], [disk, seeds])).collect()
    assert {(r.path, r.line_no, r["class"]) for r in got} == {
        ("log0", 1, "no_valid_seeds"), ("log2", 0, "fatal"),
    }
    ops.raise_if_fatal(log(spark, ["ok"]))
    with pytest.raises(ops.NoValidSeedsError, match="1 logs, log0: No valid seeds"):
        ops.raise_if_fatal(log(spark, [seeds, disk]))
    with pytest.raises(ops.CrawlFailedError, match="fatal: 1 logs, log0: disk") as error:
        ops.raise_if_fatal(log(spark, [disk], [seeds]))
    assert not isinstance(error.value, ops.NoValidSeedsError)
