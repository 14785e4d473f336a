"""Every registered query against its SQL twin, and the invariants that tie queries together."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from bourseloom.plans import modeling
from bourseloom.plans.registered import registered
from bourseloom.schemas import EXECUTION_SIGNAL, FEATURE_VECTOR
from bourseloom.sources import stand_ins as V
from compare import connect, difference, type_difference

# the optional training-text queries have tests of their own
QUERIES = {n: q for n, q in driver.queries().items() if n in registered()}
SQL = {n: q for n, q in driver.oracle_sql().items() if n in QUERIES}
ROWS_ONLY = sorted(set(QUERIES) - set(SQL))


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert ROWS_ONLY == ["batch_predict", "direction_model", "sentiment_scores"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, db, name):
    df = QUERIES[name](spark, sf_dir)
    assert type_difference(df, db, SQL[name]) == ""
    assert difference(df, db, SQL[name]) == ""


def test_entry_is_the_feature_table(spark):
    df = driver.entry(spark)
    assert df.columns == FEATURE_VECTOR.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in FEATURE_VECTOR]
    assert df.count() == 389


def test_feature_join_keeps_price_rows_and_counts(spark, sf_dir):
    vectors = QUERIES["feature_vectors"](spark, sf_dir).cache()
    assert vectors.count() == QUERIES["clean_prices"](spark, sf_dir).count()
    assert vectors.select("symbol", "date").distinct().count() == vectors.count()
    matched = vectors.agg(F.sum("headline_count")).first()[0]
    left_out = QUERIES["unmatched_headlines"](spark, sf_dir).agg(F.sum("headline_count")).first()[0]
    assert matched + left_out == V.raw_headlines(spark, sf_dir).count()
    vectors.unpersist()


def test_baseline_signals_fit_their_table(spark, sf_dir):
    df = QUERIES["baseline_signals"](spark, sf_dir)
    assert df.columns == EXECUTION_SIGNAL.names
    low, high = df.agg(F.min("confidence"), F.max("confidence")).first()
    assert 0.3 <= low < high <= 0.9
    assert {r[0] for r in df.select("signal").distinct().collect()} == {"high", "low", "flat"}


def test_predictions_cover_every_request(spark, sf_dir):
    requests = V.raw_prices(spark, sf_dir).select("symbol", "date").distinct().count()
    rows = QUERIES["batch_predict"](spark, sf_dir).collect()
    assert len(rows) == requests
    assert {r["direction"] for r in rows} <= {"high", "low", "flat"}
    assert all(0.0 <= r["confidence"] <= 1.0 for r in rows)
    assert {r["model_version"] for r in rows} == {"forest-1", "baseline"}


def test_sentiment_trains_on_texts_cleaned_once(spark, sf_dir):
    made = spark.sparkContext.accumulator(0)
    labelled = V.table(spark, sf_dir, "documents").join(V.table(spark, sf_dir, "labels"), "doc_id")

    def seen(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    rows = labelled.select("text", "quality")
    model = modeling.train_sentiment(rows.mapInPandas(seen, rows.schema), "text", "quality")
    assert made.value == labelled.count() and len(model.stages) == 4


def test_sentiment_covers_every_document(spark, sf_dir):
    rows = QUERIES["sentiment_scores"](spark, sf_dir).collect()
    assert len(rows) == V.table(spark, sf_dir, "documents").count()
    assert {r["sentiment"] for r in rows} <= {"positive", "negative", "neutral"}
