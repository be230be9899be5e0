import os
import sys

import pytest


@pytest.fixture
def odd_documents(spark):
    """Null, empty, blank, long, repeated and tied rows, with columns that clash with the operators' own names."""
    rows = [
        (1, "a b c d e f g", "en", "s1", 0), (1, "a b c d e f g", "en", "s1", 0), (2, None, None, None, None), (3, "", "en", "", 0),
        (4, " \n\t ", "en", "s1", 0), (None, "no id here at all", "en", "s2", 0), (5, "w" * 50_000, "en", "s1", 0),
        (6, "one\ntwo\none\ntwo " + "x y z " * 40, "de", "s2", 0), (7, "idiot scum trash " * 30, "en", "s1", 0), (8, "a b c d e f g", "en", "s3", 0),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "1 AS size", "2 AS score", "3 AS slot", "'x' AS rank", "4 AS word")
