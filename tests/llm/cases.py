"""Frames with every awkward row: nulls, empty and long texts, repeats, extra columns with clashing names."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed=0, kinds=400):
    draw = random.Random(seed)
    return [f"w{draw.randrange(kinds)}" for _ in range(n)]


def awkward(spark, schema=DOCS):
    long_text = " ".join(words(30_000, 9, 5000))
    rows = [
        (1, " ".join(words(80, 1)), "en", "a", 1), (2, " ".join(words(80, 1)), "en", "b", 1),
        (3, None, None, None, None), (4, "", "en", "a", 0), (5, " \n\t ", "de", "b", 3), (6, long_text, "en", "c", 1),
        (7, "one two", "en", "a", 7), (7, "one two", "en", "a", 7), (None, " ".join(words(80, 1)), "en", "a", 1),
        (8, "ümläut İ ſ 日本 ! # | 3.5 km", None, "a", 1),
    ]
    return spark.createDataFrame(rows, schema)


def with_clashes(docs):
    """The same rows with columns named like those that operators use inside."""
    from pyspark.sql import functions as F

    for name in ("id", "node", "key", "n", "score", "label", "copy", "words", "item", "sites", "line", "piece", "component"):
        docs = docs.withColumn(name, F.lit("extra"))
    return docs


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)
