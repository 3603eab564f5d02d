import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from text_rows import DOCS  # noqa: E402

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, copies, repeated rows, and columns with names the operators use."""
    df = spark.createDataFrame(DOCS, SCHEMA).repartition(3)
    clash = ("w", "words", "lines", "_text", "_key", "n", "node", "kept", "doc", "text_hash", "_doc", "_hash", "n_words", "digest", "_h", "_lines")
    for c in clash:
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
