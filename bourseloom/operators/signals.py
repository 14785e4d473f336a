"""The seeded baseline scorer and prediction records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourseloom.schemas import DIRECTIONS

# Range and precision of the baseline's confidence.
CONFIDENCE_LOW, CONFIDENCE_HIGH, CONFIDENCE_PLACES = 0.3, 0.9, 2
BASELINE_VERSION = "baseline"


def _uniform(salt: str, *parts: Column) -> Column:
    """A number in [0, 1) that depends on the row's key alone: retries give the same row."""
    digest = F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(salt)), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def baseline_prediction(seed: int, *key: Column) -> tuple[Column, Column]:
    """(direction, confidence), uniform over the directions and the confidence range."""
    pick = F.floor(_uniform(f"{seed}|direction", *key) * len(DIRECTIONS)).cast("int") + 1
    direction = F.element_at(F.array(*[F.lit(d) for d in DIRECTIONS]), pick)
    width = CONFIDENCE_HIGH - CONFIDENCE_LOW
    confidence = F.round(
        F.lit(CONFIDENCE_LOW) + F.lit(width) * _uniform(f"{seed}|confidence", *key),
        CONFIDENCE_PLACES,
    )
    return direction, confidence


def baseline_signals(
    features: DataFrame, created_at: Column, seed: int = 7, version: str = BASELINE_VERSION
) -> DataFrame:
    """Feature rows -> execution_signals rows."""
    direction, confidence = baseline_prediction(seed, F.col("symbol"), F.col("date"))
    return features.select(
        "symbol", "date", direction.alias("signal"), confidence.alias("confidence"),
        F.lit(version).alias("model_version"), created_at.alias("created_at"),
    )


def predict_requests(
    requests: DataFrame, scores: DataFrame, version: str, stamped: Column, seed: int = 7
) -> DataFrame:
    """PredictionRequest rows -> one PredictionResponse each.

    ``scores`` has (symbol, date, direction, confidence), unique per (symbol, date); a request
    without a score falls back to the baseline.
    """
    known = scores.select(
        F.col("symbol").alias("_symbol"), F.date_format("date", "yyyy-MM-dd").alias("_date"),
        F.col("direction").alias("_direction"), F.col("confidence").alias("_confidence"),
    )
    fallback, fallback_confidence = baseline_prediction(seed, F.col("symbol"), F.col("date"))
    scored = F.col("_direction").isNotNull()
    return requests.join(
        known, (F.col("symbol") == F.col("_symbol")) & (F.col("date") == F.col("_date")), "left"
    ).select(
        "symbol", "date",
        F.when(scored, F.col("_direction")).otherwise(fallback).alias("direction"),
        F.when(scored, F.col("_confidence")).otherwise(fallback_confidence).alias("confidence"),
        F.when(scored, F.lit(version)).otherwise(F.lit(BASELINE_VERSION)).alias("model_version"),
        stamped.alias("timestamp"),
    )
