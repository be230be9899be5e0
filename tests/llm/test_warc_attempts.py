from strata.llm import warc as W
from strata.runtime import scratch_path


def test_files_of_another_attempt_are_not_read(spark):
    df = spark.createDataFrame([(i, f"http://a.org/{i}", f"page {i} " * 20) for i in range(30)], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-attempts")
    lost = W.write_archives(W.digested(df.filter("page_id < 20").repartition(2)), folder, 900)
    kept = W.write_archives(W.digested(df.repartition(3, "page_id")), folder, 700)
    names = [{r["archive"] for r in x.collect()} for x in (lost, kept)]
    assert names[0] and not names[0] & names[1]
    got = W.archive_runs(spark, folder, kept).collect()
    assert sorted(r["page_id"] for r in got) == list(range(30))
    assert {r["archive"] for r in got} == names[1]
