import pytest
from pyspark.sql import functions as F

from strata import runtime
from strata.operators import sampling

KEY = ["grade", "loan_status", "id"]


def two_strata(spark, partitions=2):
    rows = [("A", "Good", i) for i in range(10)] + [("B", "Bad", i) for i in range(10)]
    return spark.createDataFrame(rows, "grade string, loan_status string, id long").repartition(partitions)


def four_strata(spark):
    rows = [
        (g, s, base + i)
        for base, g, s in ((0, "A", "Good"), (200, "A", "Bad"), (400, "B", "Good"), (600, "B", "Bad"))
        for i in range(200)
    ]
    return spark.createDataFrame(rows, "grade string, loan_status string, id long")


def counts(df):
    return {(r[0], r[1]): r["count"] for r in df.groupBy("grade", "loan_status").count().collect()}


def test_split_has_exact_shares_whatever_the_partitioning(spark):
    seen = set()
    for partitions in (1, 4, 17):
        train, test = sampling.stratified_split(two_strata(spark, partitions), ["grade", "loan_status"], 0.2, 42, KEY)
        assert counts(train) == {("A", "Good"): 8, ("B", "Bad"): 8}
        assert counts(test) == {("A", "Good"): 2, ("B", "Bad"): 2}
        seen.add(frozenset(tuple(r) for r in test.collect()))
    assert len(seen) == 1


def test_split_keeps_null_and_colliding_strata_apart(spark):
    rows = [(a, b, i) for a, b in (("A_B", "C"), ("A", "B_C"), ("A", None), (None, "A"), (None, None)) for i in range(5)]
    df = spark.createDataFrame(rows, "grade string, loan_status string, id long")
    _, test = sampling.stratified_split(df, ["grade", "loan_status"], 0.2, 1, KEY)
    assert sorted(counts(test).values()) == [1] * 5 and test.count() == 5


def test_split_of_one_row_and_of_nothing(spark):
    df = spark.createDataFrame([("Z", "x", 1)], "grade string, loan_status string, id long")
    train, test = sampling.stratified_split(df, ["grade", "loan_status"], 0.2, 42, KEY)
    assert (train.count(), test.count()) == (1, 0)
    train, test = sampling.stratified_split(df.limit(0), ["grade", "loan_status"], 0.2, 42, KEY)
    assert (train.count(), test.count()) == (0, 0) and train.columns == df.columns


def test_folds_cover_every_row_once_and_keep_shares(spark):
    df = four_strata(spark)
    folded = sampling.stratified_kfolds(df, ["grade", "loan_status"], 5, 42, "id")
    pairs = sampling.fold_pairs(folded, 5)
    ids = sorted(r["id"] for _, val in pairs for r in val.select("id").collect())
    assert ids == list(range(800))
    for train, val in pairs:
        assert set(counts(val).values()) == {40}
        assert train.count() == 640


def test_folds_of_small_strata_start_at_zero(spark):
    df = spark.createDataFrame([("Z", "x", 1), ("Y", "x", 1), ("Y", "x", 2)], "grade string, loan_status string, id long")
    folded = sampling.stratified_kfolds(df, "grade", 5, 42, KEY)
    by = {}
    for r in folded.collect():
        by.setdefault(r["grade"], []).append(r["fold"])
    assert by["Z"] == [0] and sorted(by["Y"])[0] == 0 and len(set(by["Y"])) == 2


def test_wide_strata_go_another_way_with_the_same_result(spark, monkeypatch):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("s"), "id"
    )
    small = sorted(sampling.mark_stratified_test(df, "s", 0.2, 3, "id").collect())
    monkeypatch.setattr(sampling, "fits_broadcast", lambda *a, **k: False)
    monkeypatch.setattr(runtime, "fits_broadcast", lambda *a, **k: False)
    assert sorted(sampling.mark_stratified_test(df, "s", 0.2, 3, "id").collect()) == small


def test_copies_of_a_key_stay_together(spark):
    df = spark.createDataFrame([("a", i % 50) for i in range(500)], "s string, id long")
    sides = sampling.mark_stratified_test(df, "s", 0.2, 3, "id").groupBy("id").agg(F.count_distinct("is_test").alias("n"))
    assert sides.filter("n > 1").count() == 0


def test_samples_are_stable_nested_and_complementary(spark):
    df = spark.range(5000).withColumn("s", (F.col("id") % 3).cast("string"))
    ten = {r["id"] for r in sampling.sample_fraction(df.repartition(3), 0.1, 9, "id").collect()}
    again = {r["id"] for r in sampling.sample_fraction(df.repartition(11), 0.1, 9, "id").collect()}
    thirty = {r["id"] for r in sampling.sample_fraction(df, 0.3, 9, "id").collect()}
    assert ten == again and ten < thirty and 400 < len(ten) < 600
    ladder = sampling.fraction_ladder(df, [0.1, 0.3, 1.0], 9, "id")
    sizes = {r["fraction"]: r["count"] for r in ladder.groupBy("fraction").count().collect()}
    assert sizes == {0.1: len(ten), 0.3: len(thirty), 1.0: 5000}
    train, test = sampling.split_by_sample(df, 0.2, 9, "id")
    assert train.count() + test.count() == 5000 and train.join(test, "id").count() == 0


def test_sample_by_named_strata(spark):
    df = spark.range(3000).withColumn("s", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b"))
    got = {r["s"]: r["count"] for r in sampling.sample_by(df, "s", {"a": 1.0, None: 1.0}, 1, "id").groupBy("s").count().collect()}
    assert got == {"a": 1000, None: 1000}
    assert sampling.sample_by(df, "s", 0.5, 1).count() < 3000


def test_limit_rows_and_random_split(spark):
    df = spark.range(4000)
    assert sampling.limit_rows(df, 10_000, 1, "id").count() == 4000
    assert 850 < sampling.limit_rows(df, 1000, 1, "id").count() < 1150
    parts = sampling.random_split(df, [0.8, 0.2], 1, "id").groupBy("part").count().collect()
    assert {r["part"] for r in parts} == {0, 1} and sum(r["count"] for r in parts) == 4000


def test_unsampled_strata_are_reported(spark):
    df = four_strata(spark)
    out = sampling.compare_distribution(df, df.filter("grade = 'A'"), ["grade"]).collect()
    assert [(r["grade"], r["sampled"], r["pct_sampled"]) for r in out] == [("A", 400, 100.0), ("B", 0, 0.0)]
    assert sampling.share_deviation(df, df.filter("grade = 'A'"), "grade").first()[0] == 0.5


def test_a_key_is_required(spark):
    with pytest.raises(ValueError):
        sampling.stratified_split(two_strata(spark), "grade")
