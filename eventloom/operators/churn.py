"""User features, churn by recency, and a churn model."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.scalar import interval
from eventloom.operators.metrics import is_purchase, revenue

FEATURES = ["events", "active_days", "clicks", "purchases", "spent", "recency_days"]
CHURN_DAYS = 7


def user_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """One row of model inputs per user; recency counts days to the newest event of all."""
    newest = df.agg(F.max(F.to_date(ts))).scalar()
    return df.groupBy("user_id").agg(
        F.count("*").alias("events"),
        F.count_distinct(F.to_date(ts)).alias("active_days"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.count_if(is_purchase()).alias("purchases"),
        revenue().alias("spent"),
        F.max(F.to_date(ts)).alias("_last_day"),
    ).withColumn("recency_days", F.date_diff(newest, F.col("_last_day"))).drop("_last_day")


def churn_recency(df: DataFrame, is_sign_of_life: Column, ts: str = "ts", days: int = CHURN_DAYS) -> DataFrame:
    """Users by days since their last sign of life; those who never gave one count as churned."""
    newest = df.agg(F.max(F.to_date(ts))).scalar()
    last = df.groupBy("user_id").agg(F.max(F.when(is_sign_of_life, F.to_date(ts))).alias("last_day"))
    silent = last.withColumn("days_silent", F.date_diff(newest, F.col("last_day")))
    return silent.withColumn("churned", F.coalesce(F.col("days_silent") >= days, F.lit(True)))


def labelled(
    df: DataFrame, is_sign_of_life: Column, ts: str = "ts", days: int = CHURN_DAYS, newest: Column | None = None
) -> DataFrame:
    """Training rows: features up to the cutoff, ``label`` 1 when the user is silent after it.

    The cutoff lies ``days`` before ``newest``, by default the newest event; nothing after it reaches the features.
    """
    cutoff = (df.agg(F.max(ts)).scalar() if newest is None else newest) - interval(f"{days} days")
    features = user_features(df.where(F.col(ts) <= cutoff), ts)
    alive = df.where((F.col(ts) > cutoff) & is_sign_of_life).select("user_id").distinct()
    joined = features.join(alive.withColumn("_alive", F.lit(1)), "user_id", "left")
    return joined.withColumn("label", F.when(F.col("_alive").isNull(), 1.0).otherwise(0.0)).drop("_alive")


def fit_churn(training: DataFrame, path: str) -> PipelineModel:
    """Fit, save under ``path`` and return the stored model.

    The reloaded model no longer carries the training summary, which holds on to the
    session and cannot be sent to executors once the session observes metrics.
    """
    numbers = training.select("label", *[F.col(f).cast("double").alias(f) for f in FEATURES])
    steps = [
        VectorAssembler(inputCols=FEATURES, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True),
        LogisticRegression(maxIter=20, regParam=0.01),
    ]
    fitted = Pipeline(stages=steps).fit(numbers.persist())
    numbers.unpersist()
    save_model(fitted, path)
    stored = load_model(path)
    if not same_model(fitted, stored):
        raise ValueError(f"the model stored under {path} differs from the fitted one")
    return stored


def predict_churn(model: PipelineModel, features: DataFrame) -> DataFrame:
    numbers = features.select("user_id", *[F.col(f).cast("double").alias(f) for f in FEATURES])
    probability = vector_to_array("probability")[1]
    return model.transform(numbers).select("user_id", F.round(probability, 6).alias("churn_probability"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def same_model(model: PipelineModel, other: PipelineModel) -> bool:
    """Whether two churn models have the same numbers everywhere."""
    numbers = lambda m: [
        m.stages[0].getInputCols(),
        list(m.stages[1].mean),
        list(m.stages[1].std),
        list(m.stages[2].coefficients),
        m.stages[2].intercept,
    ]
    return numbers(model) == numbers(other)


def score_table(scored: DataFrame, label: str = "label", score: str = "churn_probability") -> DataFrame:
    """(score, positives, negatives) per different score; at most a million rows, as scores have six digits."""
    is_one = F.col(label) == 1
    return scored.groupBy(F.round(score, 6).alias("score")).agg(
        F.count_if(is_one).alias("positives"), F.count_if(~is_one).alias("negatives")
    )


def rank_sum_auc(scores: DataFrame) -> DataFrame:
    """(positives, negatives, auc) of a score table: the share of pairs in the right order, ties count half.

    Null where there is only one class.
    """
    below = Window.orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    placed = scores.withColumn("_below", F.coalesce(F.sum("negatives").over(below), F.lit(0)))
    won = F.sum(F.col("positives") * (F.col("_below") + F.col("negatives") / 2))
    sums = placed.agg(F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"), won.alias("_won"))
    return sums.select("positives", "negatives", F.try_divide("_won", F.col("positives") * F.col("negatives")).alias("auc"))


def calibration(scores: DataFrame, bins: int = 10) -> DataFrame:
    """(bin, n, mean_score, share): how often users of a score bin did churn; ``scores`` is a score table."""
    n = F.col("positives") + F.col("negatives")
    bin_ = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    return scores.groupBy(bin_.alias("bin")).agg(
        F.sum(n).alias("n"), (F.sum(F.col("score") * n) / F.sum(n)).alias("mean_score"), (F.sum("positives") / F.sum(n)).alias("share")
    )
