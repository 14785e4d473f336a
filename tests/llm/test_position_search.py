"""Ranked lexical search against brute force over all documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from bourseloom.llm import position_search as P
from compare import connect, difference, type_difference
from bourseloom.llm.queries import SQL, registered

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms_of(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    held = [(r["doc_id"], Counter(terms_of(r["text"]))) for r in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item in items:
        scored = []
        for doc_id, c in held:
            n, score = sum(c.values()), 0
            m = 100 - 50 + (50 * n * n_docs) // total
            for t in set(terms_of(item["text"])):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item["item_id"], i + 1, None if x[1] else x[2], -x[0]) for i, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def result(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


ITEMS = [(1, "w1 w2 W3 w59 more"), (2, None), (2, "one two"), (None, "long7 text of signs"), (4, "nowhere"),
         (5, "é aaa other END"), (6, " ".join(f"w{i} long{i}" for i in range(40)))]


@pytest.mark.parametrize("k,shard", [(50, 1 << 21), (3, 1 << 21), (3, 10)])
def test_odd_rows(spark, odd_docs, k, shard):
    docs = odd_docs.withColumns({"n": F.lit("x"), "terms": F.lit(1), "item": F.lit(2)})
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("score", F.lit(0))
    got = result(P.search(docs, items, k=k, shard_postings=shard))
    assert got == brute(docs.collect(), items.collect(), k)


def test_blocks_of_items_and_the_table(spark, sf_dir, sf_docs):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = brute(sf_docs.collect(), items.collect(), 10)
    for block in (1 << 19, 200):
        assert result(P.search(sf_docs.repartition(3), items, k=10, block_terms=block)) == want


def test_nothing(spark, no_docs, odd_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert P.search(no_docs, items).count() == 0
    assert P.search(odd_docs, items.limit(0)).count() == 0


def test_reading_stops_before_the_lists_end():
    """Best positions stop the search early, and the top is that of all documents."""
    rng = np.random.default_rng(3)
    docs, vocab = 20_000, 6
    tf = 1 * (rng.random((docs, vocab)) < 0.5)
    tf[rng.choice(docs, 60, replace=False), 0] = 50 + np.arange(60)
    doc, term = np.nonzero(tf)
    n = rng.integers(90, 110, docs) + tf.sum(axis=1)
    weights = np.array([9000, 900, 500, 300, 200, 100])
    shard = P.Shard(np.arange(docs), n, term, tf[doc, term], np.bincount(doc, minlength=docs), weights, docs, int(n.sum()))
    top = P.Top(10)
    scored = shard.search(np.arange(vocab), top)
    score = np.zeros(docs, np.int64)
    m = 50 + (50 * n * docs) // int(n.sum())
    np.add.at(score, doc, weights[term] * ((10**9 * tf[doc, term]) // (1000 * tf[doc, term] + 20 * m[doc])))
    order = np.lexsort((np.arange(docs), -score))[:10]
    assert top.ids.tolist() == order.tolist() and top.score.tolist() == score[order].tolist()
    assert scored < docs / 4
    assert not shard.seen_doc.any() and not shard.seen_place.any()


def test_sql_on_odd_rows(spark, odd_docs, tmp_path):
    import duckdb

    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([x for x in ITEMS if x != (2, None)], "item_id long, text string").coalesce(1).write.parquet(
        str(tmp_path / "benchmark.parquet"))
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    name = "op11_best_position_search"
    assert difference(registered()[name](spark, str(tmp_path)), db, SQL[name]) == ""
    assert type_difference(registered()[name](spark, str(tmp_path)), db, SQL[name]) == ""
