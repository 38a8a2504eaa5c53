import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from txrisk.llm.minhash import near_duplicates

from .conftest import SF


def test_stages_filter_and_keep_columns(spark, edge_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.columns == docs.columns and 0 < out.count() <= docs.count(), name
        empty = stage(spark, docs.limit(0), SF)
        assert empty.columns == docs.columns and empty.count() == 0, name
        docs = out
    near = near_duplicates(docs, corpus_pipeline.NEAR_PERCENT)
    assert near.where("not kept").count() == 0
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert {r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).select("doc_id").collect()} == ids


@pytest.mark.parametrize("name", ["op4_url_filter", "op9_exact_dedup", "op10_minhash"])
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    out = __spark_entry__.queries()[name](spark, SF)
    want = con.execute(__spark_entry__.oracle_sql()[name])
    order = [[d[0] for d in want.description].index(c) for c in out.columns]
    assert sorted(tuple(map(str, r)) for r in out.collect()) == sorted(tuple(str(r[k]) for k in order) for r in want.fetchall())


def test_every_operator_is_registered():
    names = list(__spark_entry__.queries())
    assert [n for n in range(1, 14) if not any(x.startswith(f"op{n}_") for x in names)] == [] and "pipeline" in names
