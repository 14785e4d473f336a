"""Direction labels, technical features, term weights and evaluation. Definitions are our own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourseloom.functions.text import SPACE_PATTERN, strip_entities, strip_tags
from bourseloom.operators.lookup import split_lookup, stored

FLAT_BAND = 0.001
LAGS = [1, 2, 5]
AVERAGES = [5, 20]
VOLATILITY_DAYS = 20
#: Terms with this share of the rows, 500,000 at most, are answered from a broadcast.
HOT_TERM = 2e-6


def with_direction(prices: DataFrame, band: float = FLAT_BAND) -> DataFrame:
    """Adds next_open, gap and direction to daily rows unique per symbol.

    gap = next day's open / close - 1; within ``band`` it is flat. Null for the last day.
    """
    nxt = F.lead("open").over(Window.partitionBy("symbol").orderBy("date"))
    gap = F.try_divide(F.col("next_open"), F.col("close")) - 1
    direction = (
        F.when(F.col("gap") > band, "high").when(F.col("gap") < -band, "low")
        .when(F.col("gap").isNotNull(), "flat")
    )
    return (
        prices.withColumn("next_open", nxt).withColumn("gap", gap)
        .withColumn("direction", direction)
    )


def direction_labels(prices: DataFrame, band: float = FLAT_BAND) -> DataFrame:
    """(symbol, date, close, next_open, gap, direction)."""
    return with_direction(prices.select("symbol", "date", "open", "close"), band).drop("open")


def with_technical(
    prices: DataFrame, lags: Sequence[int] = LAGS, averages: Sequence[int] = AVERAGES,
    volatility_days: int = VOLATILITY_DAYS,
) -> DataFrame:
    """Adds return_<k>, sma_<n> and volatility_<n> to daily rows unique per symbol.

    Averages and volatility cover up to n rows; volatility is the sample deviation of one-day
    returns. All windows share one partitioning and order.
    """
    by_day = Window.partitionBy("symbol").orderBy("date")

    def change(days: int) -> Column:
        return F.try_divide(F.col("close"), F.lag("close", days).over(by_day)) - 1

    added = {f"return_{k}": change(k) for k in lags} | {"_day": change(1)} | {
        f"sma_{n}": F.avg("close").over(by_day.rowsBetween(-n + 1, Window.currentRow))
        for n in averages
    }
    spread = F.stddev_samp("_day").over(by_day.rowsBetween(-volatility_days + 1, Window.currentRow))
    return (
        prices.withColumns(added).withColumn(f"volatility_{volatility_days}", spread).drop("_day")
    )


def technical_features(
    prices: DataFrame, lags: Sequence[int] = LAGS, averages: Sequence[int] = AVERAGES,
    volatility_days: int = VOLATILITY_DAYS,
) -> DataFrame:
    """(symbol, date, close, return_<k>, sma_<n>, volatility_<n>)."""
    return with_technical(prices.select("symbol", "date", "close"), lags, averages,
                          volatility_days)


def terms_of(text: Column) -> Column:
    """The words of the clean text: cut at white space, so collapsing it first is not needed."""
    words = F.split(strip_entities(strip_tags(F.lower(text))), SPACE_PATTERN)
    return F.filter(words, lambda t: t != "")


def counted_terms(rows: DataFrame, terms: str) -> DataFrame:
    """One row per row and distinct term, with ``term`` and ``tf`` for the array ``terms``.

    Counted inside the row: equal terms stand together once sorted, and a run's length is its count.
    Nothing is shuffled, and no task holds more than one row's terms.
    """
    kept = [c for c in rows.columns if c != terms]
    filled = rows.select(*kept, F.sort_array(terms).alias("_s")).filter(F.size("_s") > 0)
    starts = F.filter(
        F.sequence(F.lit(0), F.size("_s") - 1),
        lambda i: (i == 0) | (F.get(F.col("_s"), i) != F.get(F.col("_s"), i - 1)))
    runs = filled.withColumn("_at", starts)
    count = lambda i, k: F.coalesce(F.get(F.col("_at"), k + 1), F.size("_s")) - i
    return runs.select(*kept, F.inline(F.transform("_at", lambda i, k: F.struct(
        F.get(F.col("_s"), i).alias("term"), count(i, k).cast("long").alias("tf")))))


def term_counts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, term, tf) over the clean text, split at blanks; texts of one id count together.

    A job over the ids alone tells whether any id has several texts; only then texts are shuffled.
    """
    repeated = docs.groupBy(doc_id).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if repeated.isEmpty():
        return counted_terms(docs.select(doc_id, terms_of(F.col(text)).alias("_terms")), "_terms")
    whole = docs.groupBy(doc_id).agg(F.collect_list(text).alias("_texts"))
    return counted_terms(
        whole.select(doc_id, F.flatten(F.transform("_texts", terms_of)).alias("_terms")), "_terms")


def tfidf(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, term, tf, df, idf, tfidf), idf = ln((N + 1) / (df + 1)); one row per document.

    The terms are written once, and so are their document frequencies; weights and both halves of the
    join read them. A frequent term stands in nearly every document. Its document frequency is also its
    weight in the join, so the split into heavy and light terms costs no further count.
    """
    tf = stored(term_counts(docs, doc_id, text), "terms")
    vocabulary = stored(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "vocabulary")
    total = docs.agg(F.count(F.lit(1))).scalar()
    joined = split_lookup(
        tf, vocabulary, "term", weights=vocabulary.withColumnRenamed("df", "n"), share=HOT_TERM
    ).withColumn("idf", F.log((total + 1) / (F.col("df") + 1)))
    return joined.withColumn("tfidf", F.col("tf") * F.col("idf"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n): the confusion matrix in long form."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(class, support, predicted, correct, precision, recall, f1, accuracy) per class and ``macro``.

    A ratio with denominator 0 is 0. Everything after the matrix runs on its few rows.
    """
    cells = confusion(df, label, prediction)
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("label").cast("string").alias("class"), F.col("n").alias("support"),
                 F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n"))
                 .otherwise(F.lit(0).cast("long")).alias("correct")),
        F.struct(F.col("prediction").cast("string").alias("class"),
                 F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("correct")),
    )))
    per_class = sides.groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "correct")]
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    scored = per_class.withColumn("precision", ratio(F.col("correct"), F.col("predicted")))
    scored = scored.withColumn("recall", ratio(F.col("correct"), F.col("support")))
    p, r = F.col("precision"), F.col("recall")
    scored = scored.withColumn("f1", ratio(2 * p * r, p + r))
    accuracy = per_class.agg(ratio(F.sum("correct"), F.sum("support"))).scalar()
    macro = scored.agg(
        F.lit("macro").alias("class"),
        *[F.sum(c).alias(c) for c in ("support", "predicted", "correct")],
        *[F.avg(c).alias(c) for c in ("precision", "recall", "f1")],
    )
    return scored.unionByName(macro).withColumn("accuracy", accuracy)
