from archivetables.operators import pipeline_counts


def test_counts_without_joining(spark):
    pages = spark.createDataFrame(
        [("a", "u"), ("a", "u"), ("a", "v"), ("b", "u"), ("a", None)], "wacz_path string, url string"
    )
    cdx = spark.createDataFrame(
        [("a", "u", "f"), ("a", "u", "f"), ("a", "u", None), ("c", "u", "f"), ("b", "u", None)],
        "wacz_path string, url string, filename string",
    )
    gone = spark.createDataFrame([("x",)], "url string")
    counts = {r.stage: r.n_rows for r in pipeline_counts(pages, cdx, gone).collect()}
    assert counts == {"pages": 5, "captures": 5, "joined": 4, "records": 1, "deletes": 1}
    empty = pipeline_counts(pages.limit(0), cdx.limit(0)).collect()
    assert {r.n_rows for r in empty} == {0}
