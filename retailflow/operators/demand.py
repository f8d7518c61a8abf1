"""Sales features, property history and the demand forecast."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from retailflow.config import IN_STOCK_LEVEL
from retailflow.functions.numeric import as_long
from retailflow.schemas import PROPERTY_AVAILABLE, PROPERTY_PRICE
from retailflow.session import written

# Model inputs and search grid.
MODEL_INPUTS = ["velocity_7d", "velocity_30d", "dow"]
TREE_DEPTHS = [3, 5]
BOOSTING_ROUNDS = [10, 20]
FOLDS = 2
SEED = 42
#: Item days that one task sorts; some tens of megabytes.
DAYS_A_PART = 500_000


def daily_sales(events: DataFrame) -> DataFrame:
    """Transactions per item and active day."""
    return (
        events.where(F.col("event") == "transaction")
        .groupBy("item_id", F.to_date("event_time").alias("ds"))
        .agg(F.count(F.lit(1)).alias("daily_txn"))
    )


def window_parts(days: DataFrame) -> int:
    """Parts of ``DAYS_A_PART`` rows; the rows are counted from the file."""
    return max(1, -(-days.count() // DAYS_A_PART))


def rolling_features(events: DataFrame) -> DataFrame:
    """Trailing means over the last 7 and 30 active days, calendar fields and the next day's count.

    One window order serves all three; an item has at most one row per day, so no partition grows
    with the event count. The days are dealt into ``window_parts`` by item, a number that grows with the table.
    """
    per_item = Window.partitionBy("item_id").orderBy("ds")

    def trailing(rows: int):
        return F.avg("daily_txn").over(per_item.rowsBetween(1 - rows, Window.currentRow))

    dow = F.dayofweek("ds")
    days = written(daily_sales(events), "days")
    return days.repartition(window_parts(days), "item_id").select(
        "item_id",
        "ds",
        trailing(7).alias("velocity_7d"),
        trailing(30).alias("velocity_30d"),
        dow.alias("dow"),
        dow.isin(1, 7).alias("is_weekend"),
        F.lead("daily_txn").over(per_item).cast("double").alias("label"),
    )


def _latest_value(properties: DataFrame, code: str, parsed) -> DataFrame:
    """Newest parsed value per item; equal timestamps are settled by the larger value."""
    candidates = properties.where(F.col("property") == code).select(
        as_long("itemid").alias("item_id"),
        F.struct(as_long("timestamp").alias("ts"), parsed.alias("parsed")).alias("version"),
    )
    return (
        candidates.where(F.col("item_id").isNotNull())
        .groupBy("item_id")
        .agg(F.max("version")["parsed"].alias("parsed"))
    )


def build_inventory(properties: DataFrame) -> DataFrame:
    """[item_id, stock]: a full shelf when the item was last seen available, else 0."""
    available = F.coalesce(F.col("value").try_cast("int") == 1, F.lit(False))
    stock = F.when(available, F.lit(IN_STOCK_LEVEL)).otherwise(F.lit(0))
    return _latest_value(properties, PROPERTY_AVAILABLE, stock).withColumnRenamed("parsed", "stock")


def build_catalog_price(properties: DataFrame) -> DataFrame:
    """[item_id, catalog_price] from the newest price property; items whose newest text is no number drop out."""
    price = F.regexp_replace("value", "^n", "").try_cast("double")
    latest = _latest_value(properties, PROPERTY_PRICE, price).withColumnRenamed("parsed", "catalog_price")
    return latest.where(F.col("catalog_price").isNotNull())


def forecast_split(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to learn from, rows to score): the newest day of an item has no label yet."""
    known = F.col("label").isNotNull()
    return features.where(known), features.where(~known)


def _grid(regressor: GBTRegressor):
    return (
        ParamGridBuilder()
        .addGrid(regressor.maxDepth, TREE_DEPTHS)
        .addGrid(regressor.maxIter, BOOSTING_ROUNDS)
        .build()
    )


def model_inputs(features: DataFrame) -> DataFrame:
    """Rows with the vector ``inputs`` that the model takes; what is not known is 0."""
    assembler = VectorAssembler(inputCols=MODEL_INPUTS, outputCol="inputs")
    return assembler.transform(features.na.fill(0.0, MODEL_INPUTS[:2]).na.fill(0, MODEL_INPUTS[2:]))


def score_forecast(model, newest: DataFrame) -> DataFrame:
    """[item_id, forecast_demand] of feature rows by a fitted or loaded model, clamped at 0."""
    scored = model.transform(model_inputs(newest))
    return scored.select("item_id", F.greatest("prediction", F.lit(0.0)).alias("forecast_demand"))


def weighted_rows(known: DataFrame) -> DataFrame:
    """[*MODEL_INPUTS, label, fold, n]: rows of equal values and fold once, with their number as weight.

    Every row draws its fold for itself, as the cross validator would; the search reads the rows some hundred
    times, so equal ones are folded before it.
    """
    filled = known.select(*MODEL_INPUTS, "label").na.fill(0.0, MODEL_INPUTS[:2]).na.fill(0, MODEL_INPUTS[2:])
    drawn = filled.withColumn("fold", F.floor(F.rand(SEED) * FOLDS).cast("int"))
    counted = drawn.groupBy(*MODEL_INPUTS, "label", "fold").agg(F.count(F.lit(1)).cast("double").alias("n"))
    return written(counted, "weighted")


def train_forecast(features: DataFrame, model_path: str | None = None, parallelism: int = 4):
    """(model, forecasts, report): boosted trees chosen by two-fold RMSE, forecasts clamped at 0.

    forecasts = [item_id, forecast_demand]; report = one row with the chosen parameters and RMSE.
    """
    spark = features.sparkSession
    known, newest = forecast_split(features)
    train = model_inputs(weighted_rows(known)).select("inputs", "label", "fold", "n").persist(StorageLevel.MEMORY_AND_DISK)
    regressor = GBTRegressor(featuresCol="inputs", labelCol="label", weightCol="n", seed=SEED)
    search = CrossValidator(
        estimator=regressor,
        estimatorParamMaps=_grid(regressor),
        evaluator=RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="rmse", weightCol="n"),
        numFolds=FOLDS,
        foldCol="fold",
        seed=SEED,
        parallelism=parallelism,
    )
    fitted = search.fit(train)
    train.unpersist()
    model = fitted.bestModel
    if model_path:
        model.write().overwrite().save(model_path)
    forecasts = score_forecast(model, newest)
    report = spark.range(1).select(
        F.lit(model.getOrDefault("maxDepth")).alias("max_depth"),
        F.lit(model.getOrDefault("maxIter")).alias("max_iter"),
        F.lit(float(min(fitted.avgMetrics))).alias("cv_rmse"),
    )
    return model, forecasts, report


def forecast_rmse(scored: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Root mean squared error of labelled rows."""
    error = F.col(prediction) - F.col(label)
    return scored.where(F.col(label).isNotNull()).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.count(F.lit(1)).alias("n_rows")
    )
