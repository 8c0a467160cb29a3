"""A base classifier that learns from labeled samples, with calibrated confidence.

Token counts, inverse document frequencies and a multinomial logistic regression,
fitted by MLlib over all labeled rows: gradients are summed per task, and what the
driver holds is the vocabulary and one weight per term and class, both bounded by
``vocabulary``. A part of the rows is kept from the fit; on it an isotonic
regression learns how often an answer of a given probability is right, so that the
confidence is comparable with a threshold (``calibrate.threshold_sweep``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, Normalizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from echolens import constants as C
from echolens.functions.numbers import round_exact
from echolens.functions.text import strip
from echolens.session import durable

VOCABULARY = 1 << 16
# Every fifth row calibrates.
PARTS = 5
LABELS = (C.POSITIVE, C.NEUTRAL, C.NEGATIVE)


@dataclass
class LearnedScorer:
    """A fitted classifier over a column of tokens."""

    pipeline: PipelineModel
    calibration: IsotonicRegressionModel | None

    def _scored(self, rows: DataFrame, tokens: str) -> DataFrame:
        """With ``_label`` and its probability ``_sure``; rows come out as they came in."""
        known = rows.withColumn("_tokens", F.coalesce(F.col(tokens), F.array().cast("array<string>")))
        # a constant stands in for the truth that the indexer of the fit reads
        out = self.pipeline.transform(known.withColumn("_truth", F.lit(self._labels()[0])))
        chance = vector_to_array("_probability")
        label = F.element_at(F.array(*[F.lit(x) for x in self._labels()]), F.col("_prediction").cast("int") + 1)
        return out.select(*rows.columns, label.alias("_label"), F.array_max(chance).alias("_sure"))

    def _labels(self) -> list[str]:
        return list(self.pipeline.stages[0].labels)

    def predict(self, rows: DataFrame, tokens: str = "tokens_stemmed", text: str = "text_raw") -> DataFrame:
        """``rows`` with base_label and base_confidence, as ``classify.cascade`` takes them.

        Blank text is neutral without asking the model.
        """
        scored = self._scored(rows, tokens)
        sure: Column = F.col("_sure")
        if self.calibration is not None:
            scored = self.calibration.transform(scored)
            sure = F.col("_calibrated")
        blank = strip(F.coalesce(F.col(text), F.lit(""))) == ""
        return scored.select(
            *rows.columns, F.when(blank, C.NEUTRAL).otherwise(F.col("_label")).alias("base_label"),
            F.when(blank, 1.0).otherwise(round_exact(sure, 4)).alias("base_confidence"),
        )

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        if self.calibration is not None:
            self.calibration.write().overwrite().save(f"{path}/calibration")

    @staticmethod
    def load(spark: SparkSession, path: str, calibrated: bool = True) -> "LearnedScorer":
        return LearnedScorer(
            PipelineModel.read().session(spark).load(f"{path}/pipeline"),
            IsotonicRegressionModel.read().session(spark).load(f"{path}/calibration") if calibrated else None,
        )


def fit(
    sample: DataFrame, key: str = "comment_id", tokens: str = "tokens_stemmed", label: str = "label",
    vocabulary: int = VOCABULARY, least_documents: int = 2, regularization: float = 1e-3, rounds: int = 50,
) -> LearnedScorer:
    """Learn from rows with a label of ``LABELS``; others are left out.

    Rows are told apart by ``key``: repeats of a key fall into the same part. Raises
    ValueError without labeled rows to fit on. With no row left to calibrate on, the
    probability is the confidence.
    """
    rows = durable(
        sample.filter(F.col(label).isin(*LABELS)).select(
            F.coalesce(F.col(tokens), F.array().cast("array<string>")).alias("_tokens"), F.col(label).alias("_truth"),
            (F.pmod(F.xxhash64(key), F.lit(PARTS)) == 0).alias("_calibrates"),
        )
    )
    learning = rows.filter("NOT _calibrates")
    if learning.isEmpty():
        raise ValueError("no labeled rows to learn from")
    pipeline = Pipeline(
        stages=[
            StringIndexer(inputCol="_truth", outputCol="_class", stringOrderType="alphabetAsc"),
            CountVectorizer(inputCol="_tokens", outputCol="_counts", vocabSize=vocabulary, minDF=least_documents),
            IDF(inputCol="_counts", outputCol="_weighted"),
            Normalizer(inputCol="_weighted", outputCol="_features"),
            LogisticRegression(
                featuresCol="_features", labelCol="_class", predictionCol="_prediction", probabilityCol="_probability",
                rawPredictionCol="_margins", family="multinomial", regParam=regularization, maxIter=rounds,
            ),
        ]
    ).fit(learning)
    scorer = LearnedScorer(pipeline, None)
    answers = scorer._scored(rows.filter("_calibrates").withColumnRenamed("_truth", "_known"), "_tokens").select(
        "_sure", (F.col("_label") == F.col("_known")).cast("double").alias("_right")
    )
    answers = durable(answers)
    if not answers.isEmpty():
        scorer.calibration = IsotonicRegression(
            featuresCol="_sure", labelCol="_right", predictionCol="_calibrated"
        ).fit(answers)
    return scorer
