"""Small inputs shared by the operator tests."""

EMPTY = "doc_id bigint, text string, lang string, source string, n_chars bigint"

#: Nulls in every column, empty and long texts, repeated rows, a clashing extra column.
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en", "b", 3),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en", "a", 3),
    (3, "", "en", "a", 0),
    (4, None, None, None, None),
    (5, "word", "en", "b", 4),
    (5, "word", "en", "b", 4),
    (None, "no id here at all", "fr", "c", None),
    (7, "x" * 3000 + " " + "long text " * 400, "en", "b", 9),
    (8, "Ünïcode   Wörds\twith\x0bodd\u00a0spaces \u2581 and \U0001f600 signs", "de", None, 9),
    (9, " \n\t ", "en", "c", 4),
]


def docs(spark, rows=ROWS, extra=()):
    df = spark.createDataFrame(rows, EMPTY)
    for name in extra:
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("clash"))
    return df


def no_docs(spark):
    return spark.createDataFrame([], EMPTY)
