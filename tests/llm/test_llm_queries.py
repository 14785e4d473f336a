"""Registered queries: SQL twins, whole tables, and the pipeline against its stages."""

import pytest

import corpus_pipeline
from bourseloom.llm.queries import SQL, registered
from compare import connect, difference, type_difference


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, name):
    db = connect(sf_dir)
    df = registered()[name](spark, sf_dir)
    assert type_difference(df, db, SQL[name]) == ""
    assert difference(df, db, SQL[name]) == ""


def test_mixing_sql_on_odd_rows(spark, odd_docs, tmp_path):
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    import duckdb

    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    for name in ("op2_source_mixing",):
        assert difference(registered()[name](spark, str(tmp_path)), db, SQL[name]) == ""


def test_there_is_a_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in registered()) == list(range(1, 14))


def test_pipeline_is_its_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == before.columns, name
        rows = docs.collect()
        docs = spark.createDataFrame(rows, before.schema)
        names.append((name, {r["doc_id"] for r in rows}))
        assert names[-1][1] <= {r["doc_id"] for r in before.collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    piece = lambda r: (r["doc_id"], r["start"] if r["doc_tokens"] == r["length"] else 0, r["doc_tokens"])
    whole = {piece(r) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert {piece(r) for r in packed.collect()} == whole
    assert {r[0] for r in whole} == names[-1][1] != names[0][1] != set()
