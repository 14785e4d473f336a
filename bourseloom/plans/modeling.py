"""Spark ML forms of the declared models. Training runs jobs; scoring is lazy.

The feature sets, labels and parameters are our own choice.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    IDF, HashingTF, IndexToString, StringIndexer, Tokenizer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourseloom.functions.text import clean_text
from bourseloom.operators.features import with_direction, with_technical
from bourseloom.operators.lookup import stored as written
from bourseloom.schemas import OHLCV

SEED = 7
TEXT_FEATURES = 1 << 14
NEUTRAL_BAND = 0.2
KEPT = ("symbol", "date", "direction")


def train_sentiment(labelled: DataFrame, text: str, label: str) -> PipelineModel:
    """Text classifier: hashed term weights into a logistic regression.

    Texts are cleaned and hashed once: the term counts are written, and both fits read them.
    """
    rows = labelled.select(clean_text(F.col(text)).alias("_text"),
                           F.col(label).cast("double").alias("_label")).na.drop()
    hashed = PipelineModel([
        Tokenizer(inputCol="_text", outputCol="_terms"),
        HashingTF(inputCol="_terms", outputCol="_tf", numFeatures=TEXT_FEATURES),
    ])
    counts = written(hashed.transform(rows).select("_tf", "_label"), "sentiment-terms")
    weighed = Pipeline(stages=[
        IDF(inputCol="_tf", outputCol="_weights"),
        LogisticRegression(featuresCol="_weights", labelCol="_label", maxIter=20, regParam=0.01),
    ]).fit(counts)
    return PipelineModel([*hashed.stages, *weighed.stages])


def stored(model: PipelineModel, folder: str) -> PipelineModel:
    """The model as saved and loaded again: what scores is what was kept.

    A freshly trained model drags its training summary, and with it the session, into every
    task; a loaded one does not.
    """
    model.write().overwrite().save(folder)
    return PipelineModel.load(folder)


def score_sentiment(
    model: PipelineModel, docs: DataFrame, key: str, text: str, band: float = NEUTRAL_BAND
) -> DataFrame:
    """(key, positive, sentiment): chance of the positive class and its reading."""
    rows = docs.select(key, F.coalesce(clean_text(F.col(text)), F.lit("")).alias("_text"))
    chance = F.get(vector_to_array("probability"), F.lit(1))
    return model.transform(rows).select(key, chance.alias("positive")).withColumn(
        "sentiment",
        F.when(F.col("positive") > 0.5 + band / 2, "positive")
        .when(F.col("positive") < 0.5 - band / 2, "negative").otherwise("neutral"),
    )


def direction_inputs(features: DataFrame) -> DataFrame:
    """Feature vectors -> model columns and label; values a short history lacks count as 0."""
    rows = with_direction(with_technical(features)).drop(
        *OHLCV, "next_open", "gap", "headlines_json"
    )
    return rows.na.fill(0.0, [c for c in rows.columns if c not in KEPT])


def train_direction(
    inputs: DataFrame, folds: int = 2, depths: tuple[int, ...] = (3, 5), trees: int = 10,
):
    """Cross-validated random forest over the labelled rows."""
    columns = [c for c in inputs.columns if c not in KEPT]
    rows = inputs.filter(F.col("direction").isNotNull())
    forest = RandomForestClassifier(featuresCol="_features", labelCol="_label", numTrees=trees,
                                    seed=SEED)
    stages = Pipeline(stages=[
        StringIndexer(inputCol="direction", outputCol="_label",
                      stringOrderType="alphabetAsc", handleInvalid="skip"),
        VectorAssembler(inputCols=columns, outputCol="_features"),
        forest,
    ])
    grid = ParamGridBuilder().addGrid(forest.maxDepth, list(depths)).build()
    judge = MulticlassClassificationEvaluator(labelCol="_label", metricName="f1")
    search = CrossValidator(estimator=stages, estimatorParamMaps=grid, evaluator=judge,
                            numFolds=folds, seed=SEED, parallelism=2)
    return search.fit(rows).bestModel


def score_direction(model: PipelineModel, inputs: DataFrame) -> DataFrame:
    """(symbol, date, direction, confidence) for every input row, labelled or not."""
    assembler, forest = model.stages[1], model.stages[2]
    names = IndexToString(inputCol="prediction", outputCol="_direction",
                          labels=model.stages[0].labels)
    scored = names.transform(forest.transform(assembler.transform(inputs)))
    return scored.select(
        "symbol", "date", F.col("_direction").alias("direction"),
        F.array_max(vector_to_array("probability")).alias("confidence"),
    )

