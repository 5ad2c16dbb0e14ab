"""Least squares on pixel rows: split, fit, evaluate, predict, compare."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigrid.functions.bands import linear_prediction
from verdigrid.operators.bands import PIXEL_KEY, drop_missing, set_constant
from verdigrid.operators.gaps import GAP_BANDS, interpolate_linear

# Features, target, test share and the seeds of the two model configurations.
FEATURES = (
    "dtm",
    "fraction_grass",
    "fraction_cropland",
    "fraction_built",
    "fraction_water",
    "fraction_canopy",
)
TARGET = "lst"
TEST_SIZE = 0.2
SEEDS = {"active": 3, "candidate": 8}

_DIGITS = 3
_SMALL_BIN = 10_000


@dataclass(frozen=True)
class OlsModel:
    """Intercept and one coefficient per feature."""

    intercept: float
    coefficients: Mapping[str, float]

    def expression(self) -> Column:
        return linear_prediction(self.intercept, self.coefficients)

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [("intercept", float(self.intercept), 0)]
        rows += [(n, float(v), i) for i, (n, v) in enumerate(self.coefficients.items(), start=1)]
        return spark.createDataFrame(rows, "term string, coefficient double, position int")

    @classmethod
    def from_df(cls, df: DataFrame) -> OlsModel:
        rows = df.orderBy("position").collect()
        return cls(rows[0]["coefficient"], {r["term"]: r["coefficient"] for r in rows[1:]})


# ---------------------------------------------------------------- split


def split_hash(seed: int, key: Sequence[str] = PIXEL_KEY) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def split_rows(
    df: DataFrame, seed: int, test_size: float = TEST_SIZE, key: Sequence[str] = PIXEL_KEY
) -> tuple[DataFrame, DataFrame]:
    """Drop incomplete rows, then split at exactly ``ceil(test_size * n)`` test rows.

    The test rows are those with the smallest seeded hash of the key. Only the hash of the last test row
    is searched for (counts per hash prefix, at most 4,096 at a time, narrowed to the prefix that holds
    the cut); both parts are then plain filters without sort or shuffle, and repeatable on any layout.
    """
    rows = drop_missing(df)
    mark = split_hash(seed, key)
    keys = rows.select(*key, mark.alias("_hash"))
    prefix, wanted, total = "", None, None
    while True:
        length = len(prefix) + _DIGITS
        bins = (
            keys.filter(F.col("_hash").startswith(prefix))
            .groupBy(F.substring("_hash", 1, length).alias("p")).count().collect()
        )
        if total is None:
            total = sum(b["count"] for b in bins)
            wanted = math.ceil(test_size * total)
            if wanted <= 0 or wanted >= total:
                everything, nothing = rows, rows.filter(F.lit(False))
                return (everything, nothing) if wanted <= 0 else (nothing, everything)
        size = 0
        for b in sorted(bins, key=lambda b: b["p"]):
            if wanted <= b["count"]:
                prefix, size = b["p"], b["count"]
                break
            wanted -= b["count"]
        if size <= _SMALL_BIN:
            break
        if length >= 32:
            raise ValueError("the key columns do not identify rows, so no exact split exists")
    cut = (
        keys.filter(F.col("_hash").startswith(prefix)).orderBy("_hash", *key).offset(wanted - 1).limit(1).first()
    )
    upto = F.struct(mark.alias("h"), *key) <= F.struct(
        F.lit(cut["_hash"]).alias("h"), *[F.lit(cut[k]).cast(df.schema[k].dataType).alias(k) for k in key]
    )
    return rows.filter(~upto), rows.filter(upto)


# ---------------------------------------------------------------- fit


def gram_matrix(df: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET) -> DataFrame:
    """One row: count, sums, and sums of products of features and target; combines map-side."""
    names = [*features, target]
    rows = drop_missing(df, names)
    sums = [F.sum(n).alias(f"s_{n}") for n in names]
    products = [
        F.sum(F.col(a) * F.col(b)).alias(f"p_{a}_{b}") for i, a in enumerate(names) for b in names[i:]
    ]
    return rows.agg(F.count(F.lit(1)).alias("n"), *sums, *products)


def fit_ols(
    df: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET, solver: str = "moments"
) -> OlsModel:
    """Least squares with intercept and without penalty.

    ``moments`` takes means and covariances in one aggregate pass (stable, mergeable) and solves the
    small centred system, with the minimum-norm answer on collinear features. ``mllib`` uses the normal
    solver of ``pyspark.ml`` on assembled vectors.
    """
    rows = drop_missing(df.select(*features, target))
    if solver == "mllib":
        return _fit_mllib(rows, features, target)
    if solver != "moments":
        raise ValueError(f"unknown solver {solver}")
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i:]]
    row = rows.agg(
        *[F.avg(n).alias(f"m_{n}") for n in (*features, target)],
        *[F.covar_pop(a, b).alias(f"c_{a}_{b}") for a, b in pairs],
        *[F.covar_pop(a, target).alias(f"t_{a}") for a in features],
    ).first()
    if row[f"m_{target}"] is None:
        raise ValueError("no complete rows to fit")
    gram = np.empty((len(features), len(features)))
    for i, a in enumerate(features):
        for j, b in enumerate(features[i:], start=i):
            gram[i, j] = gram[j, i] = row[f"c_{a}_{b}"]
    moment = np.array([row[f"t_{a}"] for a in features])
    # unit scale per feature, so that the rank is judged alike for metres and fractions
    scale = np.sqrt(np.diag(gram))
    scale[scale == 0.0] = 1.0
    weights = np.linalg.lstsq(gram / np.outer(scale, scale), moment / scale, rcond=1e-12)[0] / scale
    intercept = row[f"m_{target}"] - sum(w * row[f"m_{a}"] for w, a in zip(weights, features))
    return OlsModel(float(intercept), {a: float(w) for a, w in zip(features, weights)})


def _fit_mllib(rows: DataFrame, features: Sequence[str], target: str) -> OlsModel:
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    vectors = VectorAssembler(inputCols=list(features), outputCol="_x").transform(rows)
    fitted = LinearRegression(
        featuresCol="_x", labelCol=target, solver="normal", regParam=0.0
    ).fit(vectors)
    return OlsModel(float(fitted.intercept), dict(zip(features, map(float, fitted.coefficients))))


# ---------------------------------------------------------------- evaluate and predict


def predict(df: DataFrame, model: OlsModel, name: str = "predicted_lst") -> DataFrame:
    return df.withColumn(name, model.expression())


def r_squared(df: DataFrame, actual: str = TARGET, predicted: str = "predicted_lst") -> DataFrame:
    """One row ``r2, n``: 1 - SSres / SStot about the mean of the given rows, in one pass."""
    rows = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    miss = F.col(actual) - F.col(predicted)
    return rows.agg(
        (F.lit(1.0) - F.sum(miss * miss) / F.nullif(F.count(F.lit(1)) * F.var_pop(actual), F.lit(0.0))).alias("r2"),
        F.count(F.lit(1)).alias("n"),
    )


def evaluate(test: DataFrame, model: OlsModel, target: str = TARGET) -> DataFrame:
    """R2 of the model on the test rows, as data."""
    return r_squared(predict(test, model), target)


def counterfactual(
    df: DataFrame, model: OlsModel, scenario: Mapping[str, float] | None = None,
    target: str = TARGET, gap_bands: Sequence[str] = GAP_BANDS,
) -> DataFrame:
    """Predicted temperature under a changed land cover (no trees by default).

    Gaps are filled along the pixel order, the scenario overwrites its bands on every row, the target
    is dropped before incomplete rows are, so a pixel without a measured target is predicted too.
    """
    gapless = interpolate_linear(df, gap_bands)
    changed = set_constant(gapless, scenario or {"fraction_canopy": 0.0}).drop(target)
    return predict(drop_missing(changed), model)


def cooling_effect(df: DataFrame, target: str = TARGET, predicted: str = "predicted_lst") -> DataFrame:
    """Predicted minus measured temperature per pixel."""
    return df.withColumn("cooling", F.col(predicted) - F.col(target))


def train(
    df: DataFrame, seed: int, features: Sequence[str] = FEATURES, target: str = TARGET,
    test_size: float = TEST_SIZE, key: Sequence[str] = PIXEL_KEY,
) -> tuple[OlsModel, DataFrame]:
    """Split, fit on the training rows, and return the model with the test rows."""
    fit_part, test_part = split_rows(df, seed, test_size, key)
    return fit_ols(fit_part, features, target), test_part


def train_all(
    df: DataFrame, seeds: Mapping[str, int] = SEEDS, features: Sequence[str] = FEATURES,
    target: str = TARGET, test_size: float = TEST_SIZE, key: Sequence[str] = PIXEL_KEY,
) -> dict[str, tuple[OlsModel, DataFrame]]:
    """Model and test rows of each configuration. ``df`` is read several times: pass a stored table."""
    return {name: train(df, seed, features, target, test_size, key) for name, seed in seeds.items()}


def score_table(trained: Mapping[str, tuple[OlsModel, DataFrame]], target: str = TARGET) -> DataFrame:
    """One row of test R2 per configuration."""
    scores = [
        evaluate(test, model, target).withColumn("model", F.lit(name)) for name, (model, test) in trained.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), scores)


def compare_models(
    df: DataFrame, seeds: Mapping[str, int] = SEEDS, features: Sequence[str] = FEATURES,
    target: str = TARGET, test_size: float = TEST_SIZE,
) -> DataFrame:
    """Same steps for each configuration; they differ in the seed."""
    return score_table(train_all(df, seeds, features, target, test_size), target)
