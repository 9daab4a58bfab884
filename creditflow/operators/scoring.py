"""Scorecard and boosted-tree models: fit, store as tables, score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditflow import config
from creditflow.functions.expressions import sigmoid
from creditflow.operators import matrices
from creditflow.sources.tables import COMPONENT_SCHEMA, MODEL_SCHEMA, small_table, upper_names

CONSTANT = "const"


# --- scorecard ----------------------------------------------------------------


def model_table(spark: SparkSession, model_no: int, constant: float, coefficients: dict[str, float]) -> DataFrame:
    """A model as rows: the constant first, then one row per ``_woe`` variable."""
    rows = [(model_no, CONSTANT, float(constant))]
    rows += [(model_no, name, float(c)) for name, c in coefficients.items()]
    return small_table(spark, rows, MODEL_SCHEMA)


def model_coefficients(models: DataFrame, model_no: int) -> tuple[float, dict[str, float]]:
    """One model's constant and coefficients; a model has one row per variable."""
    rows = models.where(F.col("model_no") == model_no).select("variable", "coef").collect()
    if not rows:
        raise ValueError(f"no model {model_no}")
    constant = sum(r["coef"] for r in rows if r["variable"] == CONSTANT)
    return constant, {r["variable"]: r["coef"] for r in rows if r["variable"] != CONSTANT}


def model_frame(base: DataFrame, woe: DataFrame, variables: Sequence[str], key: str = "LOAN_ID") -> DataFrame:
    """Ids and raw values beside the model's WOE columns, matched on the loan key."""
    raw = [v[: -len("_woe")] for v in variables]
    ids = [*config.ID_COLUMNS, config.TARGET]
    left = base.select(*dict.fromkeys([*ids, *raw]))
    right = upper_names(woe).select(key, *[v.upper() for v in variables])
    return left.join(right, key)


def score_scorecard(
    df: DataFrame, models: DataFrame, model_no: int = config.MODEL_NO, keep: Sequence[str] = ("LOAN_ID",)
) -> DataFrame:
    """``p_bad``: the logistic of constant plus coefficients times WOE, one expression."""
    constant, coefficients = model_coefficients(models, model_no)
    total = F.lit(float(constant))
    for name, coef in coefficients.items():
        total = total + F.lit(float(coef)) * F.col(name)
    return df.select(*keep, F.lit(model_no).cast("bigint").alias("model_no"), sigmoid(total).alias("p_bad"))


def fit_scorecard(
    woe: DataFrame, variables: Sequence[str], model_no: int = config.MODEL_NO, target: str = config.TARGET
) -> DataFrame:
    """Logistic regression on WOE columns, returned as a model table."""
    fitted = matrices.logistic(woe, variables, target)
    constant, *coefficients = fitted.coefficients.tolist()
    return model_table(woe.sparkSession, model_no, constant, dict(zip(variables, coefficients)))


# --- boosted trees ------------------------------------------------------------


def fit_trees(
    df: DataFrame,
    features: Sequence[str],
    target: str = config.TARGET,
    rounds: int = 20,
    depth: int = 3,
    seed: int = 7,
) -> PipelineModel:
    """Gradient-boosted trees on imputed columns. ``df`` is read once per tree: stage it first."""
    train = df.where(F.col(target).isNotNull()).select(F.col(target).cast("double").alias("label"), *features)
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="features"),
            GBTClassifier(featuresCol="features", labelCol="label", maxIter=rounds, maxDepth=depth, seed=seed),
        ]
    ).fit(train)


def score_trees(df: DataFrame, model: PipelineModel, keep: Sequence[str] = ("LOAN_ID",)) -> DataFrame:
    """Both class probabilities per loan."""
    p = vector_to_array("probability")
    return model.transform(df).select(*keep, p[0].alias("p_good"), p[1].alias("p_bad"))


def save_trees(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_trees(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- principal components -----------------------------------------------------


def explained_variance(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(component, variance, cumulative) of the standardised features that vary, largest first."""
    values = matrices.eigenvalues(matrices.correlations(df, features).matrix)
    rows, total = [], 0.0
    for i, value in enumerate(values.tolist(), 1):
        share = max(value, 0.0) / len(values)
        total += share
        rows.append((i, share, total))
    return small_table(df.sparkSession, rows, COMPONENT_SCHEMA)


def components_for_share(variance: DataFrame, share: float = config.PCA_VARIANCE_SHARE) -> DataFrame:
    """The smallest leading set of components that reaches ``share`` of the variance."""
    return variance.where(F.col("cumulative") - F.col("variance") < share)
