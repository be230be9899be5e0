import pytest

from strata.plans.cleaning import LoanRoles, apply, learn
from strata.runtime import scratch_path
from strata.sources import (
    append_metrics,
    describe_schema,
    drop_if_present,
    read_metrics,
    read_table,
    resolve_source,
    write_table,
)


def test_source_choice(spark):
    base = scratch_path(spark, "raw")
    rows = spark.range(10)
    for i in range(3):
        write_table(rows, f"{base}/loan_{i}", format="csv")
    write_table(rows, f"{base}/archive.gz", format="csv", files=1, compression="gzip")
    assert len(resolve_source(spark, f"{base}/loan_*", [f"{base}/archive.gz"])) == 3
    assert resolve_source(spark, f"{base}/loan_*", [f"{base}/archive.gz"], min_parts=4)[0].endswith("archive.gz")
    with pytest.raises(FileNotFoundError):
        resolve_source(spark, f"{base}/none_*", [f"{base}/nope"])


def test_csv_is_read_as_text_without_a_schema(spark):
    path = scratch_path(spark, "csv")
    write_table(spark.createDataFrame([(1, "13%"), (2, None)], "a int, p string"), path, format="csv")
    df = read_table(spark, path, format="csv", partitions=2)
    assert dict(df.dtypes) == {"a": "string", "p": "string"} and df.count() == 2


def test_files_are_bounded(spark):
    path = scratch_path(spark, "bounded")
    write_table(spark.range(1000).repartition(20), path, files=2, max_records=300)
    sizes = [r["n"] for r in spark.read.parquet(path).selectExpr("input_file_name() f").groupBy("f").count().withColumnRenamed("count", "n").collect()]
    assert max(sizes) <= 300 and sum(sizes) == 1000 and len(sizes) <= 8


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "a", None)], "i int, s string, d date")
    got = [(r["column"], r["type"], r["kind"]) for r in describe_schema(df).collect()]
    assert got == [("i", "int", "numeric"), ("s", "string", "categorical"), ("d", "date", "other")]
    assert drop_if_present(df, ["_c0", "d"]).columns == ["i", "s"]


def test_metric_log_appends(spark):
    path = scratch_path(spark, "log")
    m = spark.createDataFrame([("r1", "auc", 0.5)], "run_id string, metric string, value double")
    append_metrics(m, "fit", path)
    append_metrics(m, "fit", path)
    append_metrics(m, "evaluate", path)
    log = read_metrics(spark, path)
    assert log.count() == 3 and log.filter("ts is null").count() == 0


def test_loan_cleaning_end_to_end(spark):
    path = scratch_path(spark, "loans")
    raw = [
        (0, "36 months", "A", "Charged Off", "5000", "13.5%", "40000", "12", "Dec-2015", "Jan-2001", "Médico"),
        (1, "36 months", "A", "Fully Paid", None, "n/a", "60000", "999", "Jan-2016", "Feb-1999", "TEACHER"),
        (2, None, "B", None, "9000", "7.0%", None, "20", "bad", "Feb-1999", None),
    ]
    names = ["_c0", "term", "grade", "loan_status", "loan_amnt", "int_rate", "annual_inc", "dti", "issue_d", "earliest_cr_line", "emp_title"]
    write_table(spark.createDataFrame(raw, names), path, format="csv")
    df = read_table(spark, path, format="csv")
    roles = LoanRoles(sentinels={"dti": 999.0})
    stats = learn(df, roles)
    assert stats.medians["loan_amnt"] == 7000.0 and stats.medians["dti"] == 16.0
    rows = {r["emp_title"]: r for r in apply(df, stats, roles).collect()}
    assert "_c0" not in rows["medico"].asDict()
    assert rows["medico"]["default_flag"] == 1 and rows["medico"]["credit_age"] == 14
    assert rows["teacher"]["int_rate"] == pytest.approx(10.25) and rows["teacher"]["default_flag"] == 0
    assert rows[None]["loan_status"] == "missing" and rows[None]["grade_status"] == "B_missing"
    assert rows[None]["credit_age"] is None and rows[None]["term"] == "missing"
    one = apply(df.limit(1), stats, roles).first()
    assert one["loan_amnt"] is not None


def test_every_archive_is_read(spark, tmp_path):
    path = f"{tmp_path}/zipped"
    write_table(spark.range(5000).selectExpr("id AS k"), path, format="csv", files=3, max_records=500, compression="gzip")
    found = resolve_source(spark, f"{path}/none-*", [f"{path}/part-*.csv.gz"])
    assert len(found) > 3
    assert read_table(spark, found, format="csv").count() == 5000
