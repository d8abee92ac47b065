import pytest

from pyspark.sql import types as T

#: Names that operators use inside, or return, as extra columns of the input.
CLASHING = ["score", "size", "h", "start", "bucket", "target", "member", "class_id", "n_lines", "n_removed",
            "lang_pred", "row", "k", "key", "th", "id", "line", "w", "rank", "band", "piece", "group", "own", "look",
            "_gone", "_id", "_h", "_th", "gone", "gone_id", "gone_", "gone_th_", "other_id", "other_th", "slot",
            "begin", "cut", "spoken", "lang_pred_", "lang_score_", "doc", "site", "first", "root"]
LONG = " ".join(f"word{i % 977}" for i in range(60_000)) + ".\nEnd of it."


def frame(spark, rows, extra=CLASHING):
    """documents with the given (doc_id, text, lang, source) and string columns of clashing names."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())]
                          + [T.StructField(c, T.StringType()) for c in extra])
    return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None, *["x"] * len(extra)) for r in rows],
                                 schema)


EDGE = [
    (None, None, None, None), (None, "No id at all, only words here today.", "en", "a"),
    (1, "", "en", "a"), (2, None, "fr", "b"), (3, " \n\t \r\n", None, "b"), (4, "One two three.", "en", None),
    (5, "The cat sat on the mat and the dog sat on the log.\nShared line here.", "en", "a"),
    (5, "The cat sat on the mat and the dog sat on the log.\nShared line here.", "en", "a"),
    (6, "The cat sat on the mat and the dog sat on the log.\nShared line here.", "en", "c"),
    (7, "a\x00b \U0001F600 été <|endoftext|> \x1c x  y", "fr", "c"), (8, LONG, "en", "a"),
    (9, "12345 67890 !!! ###", "en", "d"), (10, "Shared line here.", "en", "d"), (11, "un deux trois", "fr", ""),
    (-12, "Shared line here.\n\n\nShared line here.", "en", "e"),
]


@pytest.fixture(scope="session")
def edge(spark):
    return frame(spark, EDGE).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
