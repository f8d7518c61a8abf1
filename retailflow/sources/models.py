"""Stored models: weights of the surge classifier, and the demand forecast."""

from __future__ import annotations

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.functions.surgenet import WEIGHT_NAMES, weight_faults

WEIGHTS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("shape", T.ArrayType(T.IntegerType())),
        T.StructField("numbers", T.ArrayType(T.FloatType())),
    ]
)
REPORT = T.StructType([T.StructField(c, T.StringType()) for c in ("model", "part", "state")])
#: Numbers of one array that are read; the classifier has a few thousand.
MOST_NUMBERS = 10_000_000


def save_weights(spark: SparkSession, weights: dict, path: str) -> None:
    """Write the arrays of a classifier as a table of names, shapes and numbers."""
    rows = [(n, list(np.shape(a)), np.asarray(a, dtype="float32").ravel().tolist()) for n, a in weights.items()]
    spark.createDataFrame(rows, WEIGHTS).coalesce(1).write.mode("overwrite").parquet(path)


def load_weights(spark: SparkSession, path: str) -> tuple[dict | None, DataFrame]:
    """(weights, report): the arrays at ``path`` if all of them have the types and shapes of the signature.

    Else the weights are None, with which every score is 0, and the report says for each array why. A path
    without a table is a model that is missing.
    """
    try:
        table = spark.read.parquet(path)
        known = table.select("name", "shape", "numbers").where(F.col("name").isin(*WEIGHT_NAMES))
        stored = known.where(F.size("numbers") <= MOST_NUMBERS).collect()  # at most six bounded rows, if names are unique
    except AnalysisException:
        stored = []
    arrays, faults = {}, {}
    for row in stored:
        numbers = np.asarray(row["numbers"], dtype=object)
        if row["name"] in arrays:
            faults[row["name"]] = "repeated"
        try:
            arrays[row["name"]] = numbers.astype("float32").reshape([int(k) for k in row["shape"]])
        except (TypeError, ValueError):
            faults[row["name"]] = "type"
    faults = {name: fault for name, fault in weight_faults(arrays).items() if name not in faults} | faults
    rows = [("surge_classifier", name, faults.get(name, "ok")) for name in WEIGHT_NAMES]
    rows.append(("surge_classifier", "all", "fallback 0" if faults else "in use"))
    return (None if faults else arrays), spark.createDataFrame(rows, REPORT)


def load_forecast(path: str) -> GBTRegressionModel:
    """The boosted trees that a training run saved."""
    return GBTRegressionModel.load(path)
