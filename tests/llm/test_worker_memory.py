"""Python workers get texts in small batches and hold little beside their filters."""

import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bourseloom.llm import jaccard_join, line_dedup, packing, quality, store
from bourseloom.llm.arrays import mix
from bourseloom.llm.bloom import OnceTwice, contains, filter_bits, seen_twice

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
LIMIT = 4 << 20


@pytest.fixture(scope="module")
def long_texts(spark):
    """16 MB in one partition: 2,000 texts of 8 KB, each text twice."""
    return spark.range(0, 2000, 1, 1).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(249)), lambda k: F.sha2(
            F.concat_ws("-", (F.col("id") % 1000).cast("string"), k.cast("string")), 256).substr(1, 31))).alias("text"))


def test_filters_are_filled_from_small_batches(spark, long_texts):
    def hashes(batch):
        if batch.nbytes > LIMIT:
            raise ValueError(f"{batch.nbytes} bytes in one batch")
        return mix(np.array([int(x.as_py()[:15], 16) for x in batch.column(0)], np.uint64))

    before = spark.conf.get(KEY)
    bitmap = seen_twice(long_texts.select("text"), hashes, filter_bits(2000))
    assert spark.conf.get(KEY) == before
    keys = [int(r["text"][:15], 16) for r in long_texts.filter("doc_id < 1000").collect()]
    assert contains(bitmap, mix(np.array(keys, np.uint64))).all()
    assert not contains(bitmap, mix(np.arange(1000, dtype=np.uint64))).all()


def test_texts_are_settled_in_small_batches(long_texts):
    sizes = long_texts.select("text").mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches), "n long")
    got = [r["n"] for r in store.settle_texts(sizes, "sizes").collect()]
    assert max(got) <= LIMIT and sum(got) >= 16_000_000


@pytest.mark.parametrize(("step", "names"), [
    (jaccard_join.jaccard_classes, {"members", "postings", "fragments"}),
    (line_dedup.drop_repeated_lines, {"suspect-lines"}),
    (lambda docs: quality.resample(docs, docs.selectExpr("doc_id", "1 quality", "0 toxic")), {"counts", "scores"}),
    (packing.pack, {"encoded"}),
], ids=["jaccard", "lines", "quality", "packing"])
def test_steps_over_texts_have_small_batches(spark, odd_docs, step, names, monkeypatch):
    held, real, before = {}, store.settle, spark.conf.get(KEY)

    def settle(df, name):
        held[name] = spark.conf.get(KEY)
        return real(df, name)

    monkeypatch.setattr(store, "settle", settle)
    assert step(odd_docs).count()
    assert held == dict.fromkeys(names, store.TEXT_BATCH) and spark.conf.get(KEY) == before


def test_a_filter_takes_keys_in_runs():
    keys = mix(np.arange(2_000_000, dtype=np.uint64))
    both = OnceTwice(1 << 24)
    tracemalloc.start()
    both.add(np.concatenate([keys, keys[:1000]]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16_008_000 + (16 << 20)  # the keys themselves and one run's arrays
    assert contains(both.once, keys).all() and contains(both.twice, keys[:1000]).all()


@pytest.mark.parametrize("few", [0, 1000])
def test_no_task_has_two_python_workers(spark, few, monkeypatch):
    monkeypatch.setattr(quality, "FEW_IDS", few)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)] + [(None, "x")], "doc_id long, text string")
    ids = spark.range(0, 50, 5).select(F.col("id").alias("__quality_id"))
    found = quality.labelled_texts(docs, ids)
    assert sorted(tuple(r) for r in found.collect()) == sorted((i, f"text {i}") for i in range(0, 50, 5))
    counted = quality._partial(found, "target")
    plan = counted._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall("MapInArrow", plan)) == (1 if few else 2)
    assert ("SortMergeJoin" in plan) == (not few)  # a shuffle parts the two
