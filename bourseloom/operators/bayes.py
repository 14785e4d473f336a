"""Text classification in closed form: multinomial Bayes from term counts.

The model is a table of one row per term, scoring is a join with it. Counts are kept per fold, so the
model without a fold is the total less that fold's counts: every labelled document is scored by a model
that has not seen it, from one pass over the terms.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourseloom.operators.features import HOT_TERM, counted_terms, terms_of
from bourseloom.operators.lookup import split_lookup, stored

FOLDS = 5
SMOOTHING = 1.0
#: Fold of documents without a label: they are scored by the model of all labelled ones.
ALL = -1


def fold_of(doc_id: str, folds: int = FOLDS) -> Column:
    return F.pmod(F.col(doc_id), F.lit(folds)).cast("int")


def term_model(
    tf: DataFrame, labelled: DataFrame, folds: int = FOLDS, smoothing: float = SMOOTHING
) -> tuple[DataFrame, list[float]]:
    """(term, n, w, seen) with the log ratio of the term's share in class 1 and class 0, and the log prior odds.

    ``w`` and the priors have an entry per fold, of the model without it, and a last one of the model of
    all. ``tf`` has (label, fold, term, tf) with labels 0, 1 and, where there is none, null; ``labelled``
    has (label, fold) of the documents with one. ``n`` counts a term's rows of ``tf``. A term that a model
    has not seen weighs 0 in it. Class sizes are smoothed by one document, so a class may be missing.
    """
    own = {f"_{c}{f}": F.sum(F.when((F.col("label") == c) & (F.col("fold") == f), F.col("tf")).otherwise(0))
           for c in (1, 0) for f in range(folds)}
    counts = stored(tf.groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), *[v.alias(k) for k, v in own.items()]), "term-classes")
    names = [*range(folds), ALL]

    def seen(c: int, f: int) -> Column:
        total = sum((F.col(f"_{c}{g}") for g in range(folds) if g != f), F.lit(0))
        return total

    sums = counts.agg(
        *[F.sum(seen(c, f)).alias(f"s{c}_{f}") for c in (1, 0) for f in names],
        *[F.count_if(seen(1, f) + seen(0, f) > 0).alias(f"v_{f}") for f in names]).first()
    docs = labelled.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n")).collect()
    prior, weights = [], []
    for f in names:
        held = {c: sum(r["n"] for r in docs if r["label"] == c and r["fold"] != f) for c in (0, 1)}
        prior.append(math.log((held[1] + 1) / (held[0] + 1)))
        size = {c: (sums[f"s{c}_{f}"] or 0) + smoothing * sums[f"v_{f}"] for c in (0, 1)}
        ratio = F.log((seen(1, f) + smoothing) / F.lit(size[1] or 1.0)) - F.log(
            (seen(0, f) + smoothing) / F.lit(size[0] or 1.0))
        weights.append(F.when(seen(1, f) + seen(0, f) > 0, ratio).otherwise(0.0))
    return counts.select("term", "n", F.array(*weights).alias("w"), (seen(1, ALL) + seen(0, ALL) > 0).alias("seen")), prior


def cross_scored(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, folds: int = FOLDS,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """(doc_id, label, fold, log_odds, probability, predicted) of every document.

    A labelled document is scored by the model of the other folds, one without a label by the model of
    all (fold -1). Ids are unique and not null. A text without a known term gets the prior odds; equal
    odds count for class 0.
    """
    known = labels.filter(F.col(label).isin(0, 1)).select(
        doc_id, F.col(label).cast("int").alias("label"), fold_of(doc_id, folds).alias("fold"))
    at = F.when(F.col("fold") == ALL, folds).otherwise(F.col("fold")).cast("int")
    tagged = docs.select(doc_id, text).join(known, doc_id, "left").withColumn("fold", F.coalesce("fold", F.lit(ALL)))
    tf = stored(counted_terms(
        tagged.select(doc_id, "label", "fold", terms_of(F.col(text)).alias("_terms")), "_terms"), "terms")
    model, prior = term_model(tf, known, folds, smoothing)
    asked = docs.select(doc_id).join(known, doc_id, "left").withColumn("fold", F.coalesce("fold", F.lit(ALL)))
    weighed = split_lookup(
        tf.select(doc_id, at.alias("_at"), "term", "tf"), model.filter("seen").select("term", "w"), "term",
        weights=model.select("term", "n"), share=HOT_TERM).filter(F.col("w").isNotNull())
    sums = weighed.groupBy(doc_id).agg(F.sum(F.col("tf") * F.get("w", F.col("_at"))).alias("_sum"))
    odds = F.get(F.array(*[F.lit(p) for p in prior]), at) + F.coalesce("_sum", F.lit(0.0))
    scored = asked.join(sums, doc_id, "left").withColumn("log_odds", odds)
    return scored.select(
        doc_id, "label", "fold", "log_odds", (1 / (1 + F.exp(-F.col("log_odds")))).alias("probability"),
        (F.col("log_odds") > 0).cast("int").alias("predicted"))
