"""Rows of a fit lie in few, even partitions, and every row is scored once."""

import pytest
from pyspark.sql import functions as F

from strata import runtime
from strata.operators import models, tuning
from strata.plans import training


def test_tasks_grow_slower_than_rows():
    assert [runtime.fit_tasks(n) for n in (0, 1, 25_000, 25_001, 150_000, 600_000)] == [1, 1, 1, 2, 6, 24]
    assert runtime.fit_tasks(6_000_000) == 24 and runtime.fit_tasks(60_000_000) == 240
    assert runtime.fit_tasks(96_000, runtime.SHARED_TASK_ROWS) == 1


def test_rows_are_dealt_evenly_whatever_partitions_they_come_in(spark):
    df = spark.range(60_000).repartition(1).unionByName(spark.range(60_000, 100_000).repartition(40))
    held = runtime.compact(df)
    assert held.rdd.getNumPartitions() == 4
    sizes = [r["count"] for r in held.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 100_000 == held.distinct().count() and max(sizes) - min(sizes) <= 50
    held.unpersist()


@pytest.fixture
def rows(spark):
    x, y = F.col("id") % 97, F.col("id") % 5
    return spark.range(600).repartition(30).select("id", x.cast("double").alias("x"), y.cast("double").alias("y"), (x + 10 * y > 70).cast("int").alias("label"))


def test_fits_and_folds_take_one_task_for_a_small_table(spark, rows):
    data = training.prepare_training(rows.filter("id < 500"), rows.filter("id >= 500"), "label", "id")
    parts = [data.train, data.validation, data.test]
    assert [df.rdd.getNumPartitions() for df in parts] == [1, 1, 1]
    assert sum(df.count() for df in parts) == 600 and data.test.agg(F.min("id")).first()[0] == 500
    assert {a["name"] for a in data.train.schema["features"].metadata["ml_attr"]["attrs"]["numeric"]} == {"x", "y"}
    data.release()


def test_every_row_is_scored_once_though_metrics_are_several(spark, rows, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(v):
        seen.add(1)
        return v

    plain = models.score
    monkeypatch.setattr(models, "score", lambda *a, **k: plain(*a, **k).withColumn("score", counted("score")))
    data = training.prepare_training(rows.filter("id < 500"), rows.filter("id >= 500"), "label", "id")
    model = training.train_one(data, "DecisionTree")
    assert training.evaluate_one(data, model, "tree").count() == 18
    assert seen.value == 600
    data.release()


def test_more_fits_at_a_time_where_partitions_are_few(spark, rows, monkeypatch):
    asked, plain = [], tuning.side_by_side

    def record(job, items, parallelism=4):
        asked.append(parallelism)
        return plain(job, items, parallelism)

    monkeypatch.setattr(tuning, "side_by_side", record)
    data = training.prepare_training(rows.filter("id < 500"), rows.filter("id >= 500"), "label", "id")
    training.train_one(data, "RandomForest", {"maxDepth": [1, 2], "numTrees": [1]}, folds=2)
    assert asked == [max(4, spark.sparkContext.defaultParallelism), 4]
    data.release()
