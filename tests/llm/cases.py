"""Rows every text operator must cope with: nulls, empty and blank texts, repeated rows, a very long text."""

import pyarrow.parquet as pq

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 40_000 + "x" * 30_000

ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (None, "no id here", "en", None, 10),
    (4, "same words twice over", "en", "a", 21), (4, "same words twice over", "en", "a", 21),
    (5, "Ünïcode 日本語 \x00 🙂 text", "de", "b", 20), (6, LONG, "en", "b", len(LONG)), (7, "123 456", "fr", "b", 7),
]


def odd(spark, *extra):
    """The odd rows; ``extra`` names columns that operators use inside."""
    df = spark.createDataFrame(ODD, SCHEMA)
    for name in extra:
        df = df.selectExpr("*", f"'mine' AS {name}")
    return df


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def table(name):
    return pq.read_table(f"{SMALL}/{name}.parquet").to_pylist()
