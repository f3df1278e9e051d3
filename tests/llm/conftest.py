import pytest
from pyspark.sql import types as T

AWKWARD = [None, "", " ", "\n\n", "a", "Ärger ΟΔΟΣ Σας", "x  y\t z \n ", "<|endoftext|> mid<|startoftext|>dle", "don't  we'll 12345", "aaaaaaaaa" * 40, "word " * 3000, "é ́x İstanbul", "日本語 テキスト", "same text here.", "same text here."]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with null and repeated ids, null and empty and long texts, and a column whose name clashes with results."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("kept", T.StringType()), T.StructField("source", T.StringType())])
    rows = [(k if k != 3 else None, t, 7, "z", None if k == 1 else "s") for k, t in enumerate(AWKWARD)] + [(14, "same text here.", 7, "z", "s")]
    return spark.createDataFrame(rows, schema)
