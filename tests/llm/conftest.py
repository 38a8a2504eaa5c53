import os
import random

import pytest
from pyspark.sql import types as T


os.environ.setdefault("OMP_NUM_THREADS", "1")  # many workers share the cores here

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents with null ids and texts, blank and very long texts, repeated rows and ids, clashing column names."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7)))
    long_text = " ".join(word() for _ in range(60_000))
    base = [word() for _ in range(120)]
    near = base[:60] + ["changed"] + base[61:]
    rows = [
        (1, None), (2, ""), (3, " \t\n\r "), (4, "One two  three."), (5, "one two\nthree."), (6, "Onetwothree."), (7, long_text), (8, long_text),
        (9, " ".join(base)), (10, " ".join(near)), (11, " ".join(base).upper()), (11, "another text with the same id"), (12, "twice"), (12, "twice"),
        (None, "no id"), (None, None), (13, "a  b \n c"), (14, "<|endoftext|> x"), (15, "é\u00a0ü ñ\x1cz"), (16, "."),
    ]
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("key", T.StringType()),
        T.StructField("rank", T.IntegerType()), T.StructField("length", T.StringType()), T.StructField("component", T.StringType()),
    ])
    return spark.createDataFrame([(i, t, "k", 1, "x", "y") for i, t in rows], schema).repartition(4).cache()


def plain_rows(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]
