"""Inputs shared by the tests of the training-data operators."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i % 977} {i}" for i in range(30_000))

#: Nulls, empty and long texts, ties, repeated rows; columns whose names the operators use themselves.
EDGE_ROWS = [
    (1, None, "en"), (2, "", None), (3, "   \n\t ", "en"), (4, "A b c", "en"), (4, "A b c", "en"),
    (None, "no id at all", None), (5, LONG, "en"), (6, "été à la plage ÉTÉ", "fr"), (7, "🙂 日本語 \x00  x", "de"),
    (8, "12345 !!! ... 678", None),
]
EDGE_DDL = "doc_id long, text string, lang string"


def edge_docs(spark):
    """EDGE_ROWS with further columns of clashing names."""
    return spark.createDataFrame(EDGE_ROWS, EDGE_DDL).selectExpr(
        "*", "'x' AS score", "1 AS n_words", "2 AS node", "3 AS fingerprint", "4 AS k1", "5 AS language")


def empty_docs(spark):
    return edge_docs(spark).where("false")
