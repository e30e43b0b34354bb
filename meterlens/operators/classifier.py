"""Boosted-tree anomaly classifier on MLlib: preparation, training, evaluation, scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.functions.numeric import label_text, reading_context
from meterlens.operators.filters import available, non_null_readings
from meterlens.operators.sampling import sample_readings, stratified_sample, stratified_split
from meterlens.operators.thresholds import explain_rows, feature_thresholds, with_defaults
from meterlens.schema import FEATURES, PRIMARY_USES
from meterlens.sources.tables import append_metrics
from meterlens.storage import durable, shared_folder

# Model parameters.
MAX_DEPTH = 5
LEARNING_RATE = 0.1
ROUNDS = 100
SEED = 42
TEST_SHARE = 0.2
# The trees are fitted on at most this many labelled rows, drawn from each label in
# proportion. Every round reads them several times, in few tasks; all rows are scored.
FIT_ROWS = 50_000
FIT_TASKS = 4


def training_set(readings: DataFrame) -> DataFrame:
    """row_id, the available features as doubles and the label, rows with nulls dropped."""
    features = available(readings, FEATURES)
    rows = readings.select(
        "row_id", *[F.col(c).cast("double").alias(c) for c in features], "anomaly"
    )
    return rows.na.drop(subset=[*features, "anomaly"])


def class_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("anomaly").agg(F.count("*").alias("row_count"))


def train(rows: DataFrame, rounds: int = ROUNDS, fit_rows: int = FIT_ROWS) -> PipelineModel:
    """Fit assembler and trees on at most ``fit_rows`` rows; the order of the features is kept."""
    shared_folder(rows.sparkSession)  # the trees checkpoint their intermediate data there
    features = [c for c in rows.columns if c in FEATURES]
    rows = durable(stratified_sample(rows, fit_rows, "anomaly", SEED).coalesce(FIT_TASKS))
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    trees = GBTClassifier(
        labelCol="anomaly", featuresCol="features", maxDepth=MAX_DEPTH, stepSize=LEARNING_RATE,
        maxIter=rounds, lossType="logistic", seed=SEED,
    )
    return Pipeline(stages=[assembler, trees]).fit(rows)


def model_features(model: PipelineModel) -> list[str]:
    return model.stages[0].getInputCols()


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def with_missing_features(rows: DataFrame, features: list[str]) -> DataFrame:
    """Add the features the table lacks as 0, and their names as ``missing_features``."""
    missing = [c for c in features if c not in rows.columns]
    names = F.array(*[F.lit(c) for c in missing]).cast("array<string>")
    return rows.withColumns({**{c: F.lit(0.0) for c in missing}, "missing_features": names})


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add prediction, its text and confidence, both probabilities and missing features.

    Features the table lacks count as 0 and are named in ``missing_features``.
    """
    features = model_features(model)
    typed = with_missing_features(rows, features)
    typed = typed.withColumns({f"_{c}": F.col(c).cast("double") for c in features})
    plain = model.copy()
    plain.stages[0].setInputCols([f"_{c}" for c in features])
    scored = plain.transform(typed).withColumn("_p", vector_to_array("probability"))
    normal, anomalous = F.col("_p")[0], F.col("_p")[1]
    prediction = F.col("prediction").cast("int")
    return scored.select(
        *rows.columns,
        prediction.alias("prediction"),
        label_text(prediction).alias("prediction_label"),
        F.when(prediction == 1, anomalous).otherwise(normal).alias("confidence"),
        normal.alias("probability_normal"),
        anomalous.alias("probability_anomaly"),
        "missing_features",
    )


def score(model: PipelineModel, rows: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Predictions with the list of out-of-range parameters of each row."""
    return explain_rows(predict(model, rows), with_defaults(thresholds))


def classify(model: PipelineModel, forms: DataFrame) -> DataFrame:
    """Classification-form rows: prediction, probability and context of each.

    ``day_of_week`` counts from Monday as 0; the month comes from the timestamp.
    """
    rows = forms.withColumns(
        {
            "weekday": F.col("day_of_week"),
            "month": F.month(F.col("timestamp").cast("timestamp")),
            "known_type": F.col("primary_use").isin(PRIMARY_USES),
        }
    )
    scored = predict(model, rows)
    return scored.select(
        *forms.columns,
        "known_type",
        F.col("prediction").alias("predicted_anomaly"),
        F.col("probability_anomaly").alias("anomaly_probability"),
        *reading_context(),
    )


def confusion_matrix(predictions: DataFrame, label: str = "anomaly") -> DataFrame:
    return predictions.groupBy(
        F.col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")
    ).agg(F.count("*").alias("row_count"))


def classification_report(matrix: DataFrame) -> DataFrame:
    """Per class: precision, recall, f1 and support; overall accuracy on every row."""
    def cells(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("row_count"))), F.lit(0))

    label, prediction = F.col("label"), F.col("prediction")
    totals = matrix.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total"),
        cells(label == prediction).alias("correct"),
        *[cells((label == a) & (prediction == b)).alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)],
    )
    per_class = totals.select(
        "total",
        "correct",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("class"),
                        F.col(f"n{c}{c}").alias("hits"),
                        (F.col(f"n0{c}") + F.col(f"n1{c}")).alias("predicted"),
                        (F.col(f"n{c}0") + F.col(f"n{c}1")).alias("support"),
                    )
                    for c in (0, 1)
                ]
            )
        ).alias("c"),
    ).select("total", "correct", "c.*")

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    precision = ratio(F.col("hits"), F.col("predicted"))
    recall = ratio(F.col("hits"), F.col("support"))
    return per_class.select(
        "class",
        precision.alias("precision"),
        recall.alias("recall"),
        ratio(2 * precision * recall, precision + recall).alias("f1"),
        "support",
        ratio(F.col("correct"), F.col("total")).alias("accuracy"),
    )


def report_metrics(report: DataFrame, model_name: str) -> DataFrame:
    """A classification report as rows of the model performance table."""
    names = ["precision", "recall", "f1", "support", "accuracy"]
    typed = report.select("class", *[F.col(c).cast("double").alias(c) for c in names])
    long = typed.unpivot("class", names, "metric", "value")
    named = F.when(F.col("metric") == "accuracy", F.col("metric")).otherwise(
        F.concat_ws("_", "metric", "class")
    )
    return long.select(
        F.lit(model_name).alias("model"), named.alias("metric"), "value"
    ).distinct()


def area_under_pr(model: PipelineModel, rows: DataFrame) -> float:
    evaluator = BinaryClassificationEvaluator(labelCol="anomaly", metricName="areaUnderPR")
    return evaluator.evaluate(model.transform(rows))


def run_training(
    readings: DataFrame,
    model_path: str,
    sample_size: int | None = None,
    rounds: int = ROUNDS,
    metrics_path: str | None = None,
) -> DataFrame:
    """Sample (if asked), prepare, split, train, evaluate, save; returns the report."""
    usable = non_null_readings(readings)
    if sample_size is not None:
        usable = sample_readings(usable, sample_size)
    # The split is read in every boosting round: it is computed once.
    split = durable(stratified_split(training_set(usable), "anomaly", TEST_SHARE, SEED))
    test = split.where("is_test").drop("is_test")
    model = train(split.where(~F.col("is_test")).drop("is_test"), rounds)
    save_model(model, model_path)
    report = durable(classification_report(confusion_matrix(predict(model, test))))
    if metrics_path is not None:
        append_metrics(report_metrics(report, model_path), metrics_path)
    return report


def scored_test_rows(readings: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Train on four fifths of the readings and score the last fifth with explanations."""
    split = durable(stratified_split(training_set(readings), "anomaly", TEST_SHARE, SEED))
    model = train(split.where(~F.col("is_test")).drop("is_test"), rounds)
    test = split.where("is_test").drop("is_test")
    return score(model, test, durable(feature_thresholds(readings)))
