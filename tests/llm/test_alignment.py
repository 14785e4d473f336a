"""Alignment of two tokenizers against brute force over whole texts."""

import bisect
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bourseloom.llm import alignment

ALPHABET = alignment._byte_alphabet()


@pytest.fixture(scope="module")
def sides():
    return alignment.PairEncoder(*alignment.default_paths(), 1 << 12)


def ranges(pieces):
    at, out = 0, []
    for i, piece in pieces:
        out.append((at, at + len(piece), i))
        at += len(piece)
    return out


def whole(sides, text):
    """Ranges of both sides' tokens by encoding the whole text at once, None without tokens."""
    if not text:
        return None
    a = sides.a.encode(" " + text, add_special_tokens=False)
    b = sides.b.encode(text)
    a = [(i, bytes(ALPHABET[ord(c)] for c in t)) for i, t in zip(a.ids, a.tokens, strict=True)]
    b = [(i, sides.piece[i]) for i in b]
    want = (" " + text).encode()
    if b"".join(p for _, p in a) != want or b"".join(p for _, p in b) != want:
        return None
    return ranges(a), ranges(b)


def brute(sides, texts):
    found, counts = [], Counter()
    for text in texts:
        both = whole(sides, text)
        if both is None:
            found.append(None)
            continue
        a, b = both
        links, j = [], 0
        for lo, hi, i in a:
            while b[j][1] <= lo:
                j += 1
            k = j
            while k < len(b) and b[k][0] < hi:
                links.append((i, b[k][2]))
                k += 1
        ends = sorted({x[1] for x in a} & {x[1] for x in b})
        own = defaultdict(lambda: ([], []))
        for side, tokens in enumerate((a, b)):
            for _, hi, i in tokens:
                own[bisect.bisect_left(ends, hi)][side].append(str(i))
        groups = ";".join(f"{','.join(own[k][0])}|{','.join(own[k][1])}" for k in range(len(ends)))
        found.append((len(a), len(b), len(ends), links, hashlib.sha256(groups.encode()).hexdigest()))
        counts.update(set(links))
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    return [(0, 0, 0, 0, 0, 0, "") if x is None else (
        *x[:3], len(x[3]), sum(counts[p] == best[p[0]] for p in x[3]), sum(counts[p] for p in x[3]), x[4])
        for x in found]


def rows_of(df):
    names = [*alignment.COUNTS, "n_best", "count_sum", "groups_sha256"]
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0, *(r[n] for n in names)) for r in df.collect()))


@pytest.mark.parametrize("most_frequent", [1 << 20, 100, 0])
def test_alignment_matches_brute_force(spark, sides, odd_docs, most_frequent):
    extra = spark.createDataFrame([(20, "▁ odd ▁", "en", "a", 1), (21, "  two  blanks ", "en", "a", 1),
                                   (22, "a   b c", "en", "a", 1)], odd_docs.schema)
    docs = odd_docs.union(extra).withColumns({"row": F.lit(1), "pairs": F.lit("x"), "n_a": F.lit(5)})
    rows = docs.collect()
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, *x)
                  for r, x in zip(rows, brute(sides, [r["text"] for r in rows]), strict=True))
    assert rows_of(alignment.align(docs, most_frequent=most_frequent)) == want


def test_alignment_of_the_table(sides, sf_docs):
    rows = sf_docs.collect()
    want = sorted((False, r["doc_id"], *x)
                  for r, x in zip(rows, brute(sides, [r["text"] for r in rows]), strict=True))
    assert rows_of(alignment.align(sf_docs)) == want


def test_alignment_of_nothing(no_docs):
    assert alignment.align(no_docs).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60), st.text(
    alphabet="aZé ×'  \u0085▁<|s/>.,5\n\t \r", max_size=40)), max_size=6))
def test_units_encode_as_whole_texts(sides, texts):
    got = {}
    for lo, hi, ids_a, per_a, ids_b, per_b in sides.slices(pa.array(texts, pa.string())):
        at_a, at_b = np.append(0, np.cumsum(per_a)), np.append(0, np.cumsum(per_b))
        for i in range(lo, hi):
            k = i - lo
            got[i] = ids_a[at_a[k]:at_a[k + 1]].tolist(), ids_b[at_b[k]:at_b[k + 1]].tolist()
    for i, text in enumerate(texts):
        both = whole(sides, text)
        want = ([], []) if both is None else tuple([x[2] for x in side] for side in both)
        assert got[i] == want
