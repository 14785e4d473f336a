"""Closed-form text classes and ranking measures against plain Python."""

import math
from collections import Counter

import pytest

from bourseloom.operators import bayes, features, ranking

DOCS = [(i, t) for i, t in enumerate([
    "good good fine", "bad poor", "good text here", "poor poor bad text", "fine words", "bad words", "", None, "new unseen",
    "good bad", "<b>Good</b> news", "poor news"])]
LABELS = [(0, 1), (1, 0), (2, 1), (3, 0), (4, 1), (5, 0), (6, 1), (9, None), (10, 1), (11, 0), (99, 1)]


def plain(texts, labels, folds=5):
    terms = {i: Counter((t or "").lower().replace("<b>", "").replace("</b>", "").split()) for i, t in texts}
    known = {i: y for i, y in labels if y is not None}
    out = {}
    for i in terms:
        fold = i % folds if i in known else -1
        train = [j for j in known if j % folds != fold]
        sums = {c: sum((terms.get(j, Counter()) for j in train if known[j] == c), Counter()) for c in (0, 1)}
        vocab = set(sums[0]) | set(sums[1])
        odds = math.log((sum(known[j] == 1 for j in train) + 1) / (sum(known[j] == 0 for j in train) + 1))
        for term, tf in terms[i].items():
            if term in vocab:
                p, q = ((sums[c][term] + 1) / (sum(sums[c].values()) + len(vocab)) for c in (1, 0))
                odds += tf * math.log(p / q)
        out[i] = (known.get(i), fold, odds)
    return out


def test_cross_scores_against_a_loop(spark):
    docs = spark.createDataFrame(DOCS, "id long, text string")
    labels = spark.createDataFrame(LABELS, "id long, y int")
    rows = bayes.cross_scored(docs, labels, "id", "text", "y").collect()
    want = plain(DOCS, LABELS)
    assert len(rows) == len(DOCS)
    for r in rows:
        label, fold, odds = want[r["id"]]
        assert (r["label"], r["fold"], r["predicted"]) == (label, fold, int(r["log_odds"] > 0))
        assert r["log_odds"] == pytest.approx(odds) and r["probability"] == pytest.approx(1 / (1 + math.exp(-odds)))


def test_without_labels_or_documents(spark):
    docs = spark.createDataFrame(DOCS, "id long, text string")
    none = spark.createDataFrame([], "id long, y int")
    assert {(r["fold"], r["log_odds"], r["predicted"]) for r in bayes.cross_scored(docs, none, "id", "text", "y").collect()} == {(-1, 0.0, 0)}
    assert bayes.cross_scored(docs.limit(0), none, "id", "text", "y").count() == 0


@pytest.mark.parametrize("rows", [
    [(1, 0.9), (0, 0.1), (1, 0.5), (0, 0.5), (1, 0.5), (0, -3.0), (1, -3.0)], [(1, 0.2), (0, 0.3)], [(1, 1.0), (1, 2.0)],
    [(0, 0.0), (1, 0.0)], [(None, 0.5), (1, None), (1, float("nan")), (1, 0.7), (0, 0.6)], []])
def test_rank_quality_against_pairs(spark, rows):
    got = ranking.rank_quality(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()
    fit = [(y, s) for y, s in rows if y is not None and s is not None and not math.isnan(s)]
    pos, neg = [s for y, s in fit if y], [s for y, s in fit if not y]
    assert (got["n"], got["positives"]) == (len(fit), len(pos))
    if not pos or not neg:
        assert got["auc"] is None and got["average_precision"] is None
        return
    assert got["auc"] == pytest.approx(sum((p > q) + (p == q) / 2 for p in pos for q in neg) / len(pos) / len(neg))
    assert got["average_precision"] == pytest.approx(sum(
        sum(p >= v for p in pos) / sum(s >= v for _, s in fit) for v in pos) / len(pos))


def test_calibration(spark):
    rows = [(1, 0.95), (0, 0.91), (1, 1.0), (0, 0.05), (1, 0.05), (None, 0.5), (1, None)]
    made = ranking.calibration(spark.createDataFrame(rows, "y int, p double"), "y", "p")
    got = {r["bin"]: (r["n"], round(r["mean_probability"], 4), round(r["positive_share"], 4)) for r in made.collect()}
    assert got == {9: (3, 0.9533, 0.6667), 0: (2, 0.05, 0.5)}
    error = ranking.calibration_error(made).first()
    assert error["calibration_error"] == pytest.approx((3 * (0.95333333 - 2 / 3) + 2 * 0.45) / 5)
    assert error["largest_gap"] == pytest.approx(0.45)
    assert ranking.calibration_error(made.limit(0)).first()["calibration_error"] is None


def test_terms_are_counted_without_a_shuffle_of_terms(spark):
    docs = spark.createDataFrame([(1, "b a  b a b <i>c</i>&amp;"), (2, None), (3, " "), (1, "a d"), (4, "x")], "id long, text string")
    assert sorted(map(tuple, features.term_counts(docs, "id", "text").collect())) == [
        (1, "a", 3), (1, "b", 3), (1, "c", 1), (1, "d", 1), (4, "x", 1)]
    once = docs.filter("text != 'a d' or text is null")
    tf = features.term_counts(once, "id", "text")
    assert "Exchange" not in tf._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert sorted(map(tuple, tf.collect())) == [(1, "a", 2), (1, "b", 3), (1, "c", 1), (4, "x", 1)]
