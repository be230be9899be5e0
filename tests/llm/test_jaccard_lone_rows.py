from strata.llm import jaccard as J


def test_a_lone_salted_row_is_a_list_row(spark):
    rows = [(gram, salt, 100 * gram + salt, 10, 0) for gram in (5, 6, 7) for salt in range(4)]
    df = spark.createDataFrame([*rows, (8, -1, 900, 10, 0)], "gram long, salt int, doc_id long, n long, pos int")
    got = J.candidates(df).collect()
    assert sorted((r["gram"], r["a"], r["n"], r["pos"]) for r in got) == [(g, d, n, pos) for g, _, d, n, pos in rows]
