import pytest

from archivetables import operators as ops
from archivetables.streaming import read_crawl_log_stream, stop_on_fatal
from tests.test_crawl_log import STATUS


def drain(spark, stream, tmp_path, name):
    running = (
        stream.writeStream.format("memory")
        .queryName(name)
        .option("checkpointLocation", str(tmp_path / f"state-{name}"))
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.table(name).collect()


@pytest.fixture
def folder(tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    for name, count in (("a", 250), ("b", 99)):
        lines = [STATUS % (i + 1) for i in range(count)]
        (logs / f"{name}.log").write_text("\n".join([*lines, "", "noise", '{"context": "x"}']))
    return str(logs)


def test_status(spark, folder, tmp_path):
    status = ops.crawl_status(read_crawl_log_stream(spark, folder))
    assert len(drain(spark, status, tmp_path, "all_status")) == 349


def test_fatal_line_fails_the_stream(spark, folder, tmp_path):
    (tmp_path / "logs" / "c.log").write_text('{"logLevel":"fatal","message":"disk"}')
    running = (
        read_crawl_log_stream(spark, folder)
        .writeStream.foreachBatch(stop_on_fatal)
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    with pytest.raises(Exception, match="disk"):
        running.awaitTermination()
