import pytest

from archivetables.sources import read_snapshot, urls_gone, write_snapshot


def snapshot(spark, folder, urls, **options):
    write_snapshot(spark.createDataFrame([(u,) for u in urls], "url string"), str(folder), **options)
    return str(folder)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_urls_gone_between_two_snapshots(spark, tmp_path):
    first = [f"https://h.test/{i}" for i in range(500)] + ["https://h.test/7", " https://h.test/8 ", "", "  ", None]
    before = snapshot(spark, tmp_path / "it's 1", first, buckets=8)
    after = snapshot(spark, tmp_path / "2", [f"https://h.test/{i}" for i in range(3, 900)], buckets=8)
    assert read_snapshot(spark, before).count() == 500
    gone = urls_gone(spark, before, after)
    assert sorted(map(tuple, gone.collect())) == [(f"https://h.test/{i}", "deleted") for i in range(3)]
    assert "Exchange" not in plan_of(gone) and "SelectedBucketsCount: 8 out of 8" in plan_of(gone)
    assert urls_gone(spark, before, before).count() == 0


def test_other_numbers_of_buckets_give_the_same_rows(spark, tmp_path):
    before = snapshot(spark, tmp_path / "1", [str(i) for i in range(100)], buckets=7)
    after = snapshot(spark, tmp_path / "2", [str(i) for i in range(90)], buckets=5)
    assert {r.url for r in urls_gone(spark, before, after).collect()} == {str(i) for i in range(90, 100)}


def test_a_missing_or_unfinished_snapshot(spark, tmp_path, caplog):
    whole = snapshot(spark, tmp_path / "1", ["a"], buckets=2)
    part = snapshot(spark, tmp_path / "2", ["a", "b"], buckets=2)
    (tmp_path / "2" / "urls-in-2" / "_SUCCESS").unlink()
    for lost in (part, str(tmp_path / "none")):
        assert urls_gone(spark, lost, whole).count() == 0
        with pytest.raises(FileNotFoundError):
            urls_gone(spark, whole, lost)
    assert "nothing is deleted" in caplog.text
    with pytest.raises(FileExistsError):
        snapshot(spark, tmp_path / "1", ["b"])


def test_an_empty_snapshot(spark, tmp_path):
    before = snapshot(spark, tmp_path / "1", ["a", "b"], buckets=3)
    after = snapshot(spark, tmp_path / "2", [""], buckets=3)
    assert {r.url for r in urls_gone(spark, before, after).collect()} == {"a", "b"}
    assert urls_gone(spark, after, before).count() == 0
