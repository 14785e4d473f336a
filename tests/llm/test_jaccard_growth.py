"""Pairs and counted shingles of the n-gram Jaccard join grow with the postings."""

from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from bourseloom.llm import arrays, jaccard_join


def near_misses(spark, each):
    """Two groups of near copies; across them 47 of 65 shingles are shared, just too few for a link."""
    rows = []
    for g, at in enumerate((20, 24)):
        for i in range(each):
            words = [f"w{k}" for k in range(60)]
            words[at] = f"own{g}x{i}"
            rows.append((g * each + i, " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_groups_that_nearly_link_make_no_square_of_pairs(spark, monkeypatch):
    pairs, real = [], jaccard_join.settle

    def settle(df, name):
        out = real(df, name)
        if name == "pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "settle", settle)
    got = jaccard_join.jaccard_classes(near_misses(spark, 250))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {i: i // 250 * 250 for i in range(500)}
    assert sum(pairs) <= 500 * 2 * jaccard_join._prefix(56)  # each node with two others in each list that it keeps


def test_links_that_are_left_are_found_in_blocks(spark, monkeypatch):
    """Every link of open nodes that joins components, over several tiles and classes of sizes."""
    monkeypatch.setattr(jaccard_join, "TILE", 3)
    texts = {i: " ".join(f"w{k}" for k in range(n)) for i, n in enumerate((44, 50, 58, 67, 78, 91, 106, 300))}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    nodes = jaccard_join.sets(docs).select("node", "doc_id")
    parts = jaccard_join.fragments(docs, nodes.select("node"))
    rows = nodes.select(F.lit(1).cast("long").alias("s"), "node", F.col("node").alias("c"))
    links = jaccard_join.left_links(rows, parts)
    ids = {r["node"]: r["doc_id"] for r in nodes.collect()}
    size = {i: len(t.split()) - 4 for i, t in texts.items()}
    got = [sorted((ids[r["x"]], ids[r["y"]])) for r in links.collect()]
    assert got and all(size[a] * 100 >= size[b] * 75 for a, b in got)
    assert {tuple(p) for p in got} >= {(k, k + 1) for k in range(6) if size[k] * 100 >= size[k + 1] * 75}
    assert not any(7 in p for p in got)


def test_repeated_shingles_are_counted_exactly(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "KEY_RUN", 500)  # many buckets
    members = jaccard_join.sets(odd_docs)
    got = {r["s"]: r["k"] for r in jaccard_join.repeated_shingles(odd_docs, members).collect()}
    want = Counter()
    for _, own in arrays.row_sets(pa.array([r["text"] for r in odd_docs.collect()]), 5):
        want.update(jaccard_join._keys(own).view("int64").tolist())
    assert got == {s: k for s, k in want.items() if k > 1}
