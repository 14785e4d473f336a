"""Near duplicates by banded MinHash against brute force over whole sets."""

import random
import re
from math import comb

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bourseloom.llm import bayes_minhash as M

WS = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs of texts."""
    sets = []
    for r in rows:
        words = WS.findall((r["text"] or "").translate(LOWER))
        sets.append({tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            k = find(i)
            least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    out = [(r["doc_id"], len(sets[i]), least.get(find(i))) for i, r in enumerate(rows)]
    return sorted(((*x, x[0] == x[2]) for x in out), key=str)


def result(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_rows(spark, odd_docs):
    docs = odd_docs.withColumns({"n": F.lit(1), "node": F.lit("x"), "bands": F.lit(5)})
    assert result(M.near_duplicates(docs)) == brute(docs.collect())


def test_the_table(sf_docs):
    assert result(M.near_duplicates(sf_docs)) == brute(sf_docs.collect())


def test_nothing(no_docs):
    assert M.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("tile", [2048, 7])
def test_chains_and_groups_that_share_bands(spark, monkeypatch, tile):
    """Chains of edits, whose ends do not link, and many texts that share a passage but do not link."""
    monkeypatch.setattr(M, "TILE", tile)
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(5000)}"
    rows, base = [], [word() for _ in range(120)]
    for i in range(25):
        rows.append((i, " ".join(base)))
        base[rng.randrange(120)] = word()
    passage = [word() for _ in range(90)]
    rows += [(100 + i, " ".join([*passage, *(word() for _ in range(30))])) for i in range(40)]
    rows += [(200 + i, " ".join([*passage, *("end" for _ in range(20)), word()])) for i in range(10)]
    rows += [(300 + i, " ".join(word() for _ in range(k))) for i, k in enumerate([1, 2, 3, 4, 5, 6] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(M.near_duplicates(docs)) == brute(docs.collect())


def test_posterior_bounds():
    """The kept pairs are those whose posterior probability reaches the miss probability."""
    steps = [(n, m) for n, m in zip(range(36, 181, 36), M.least_matches(1e-4), strict=True)]
    grid = np.linspace(0, 1, 20001)
    for n, m in steps:
        for k, over in ((m, True), (m - 1, False)):
            density = comb(n, k) * (n + 1) * grid**k * (1 - grid) ** (n - k)
            assert (density[grid >= 0.8].mean() * 0.2 >= 1e-4) == over


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    b = np.concatenate([a[:360], rng.integers(0, 1 << 63, 40, dtype=np.uint64)])
    values = M.signatures_of(np.concatenate([a, b]), np.array([0, 400]))
    assert abs((values[0] == values[1]).mean() - 360 / 440) < 0.12
    assert (M.band_keys(values)[0] == M.band_keys(values)[1]).any()


def test_groups_go_across_batches():
    cols = lambda k: [pa.array(k), pa.array(k), pa.array(k), pa.array(range(len(k)))]
    batches = [pa.RecordBatch.from_arrays(cols(k), names=list("abcd")) for k in ([1, 1, 2], [2, 2], [2, 3], [4])]
    assert [(g["a"][0].as_py(), len(g)) for g in M.groups(iter(batches), 3)] == [(1, 2), (2, 4), (3, 1), (4, 1)]
