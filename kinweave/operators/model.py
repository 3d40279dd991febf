"""Pair scorers: a fixed rule, and gradient-boosted trees."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.scores import hash_uniform
from kinweave.operators import boosting
from kinweave.operators.features import FEATURES

#: Threshold, cutoff and proxy of the rule.
RULE = {"threshold": 0.75, "topk": 500, "proxy": "max"}
#: Stands for a missing feature; an indicator column goes with it.
MISSING = -1.0
#: The reference's ceiling of boosting rounds.
ROUNDS = 2000


def rule_score() -> Column:
    return F.round(0.5 * F.col("name_cos") + 0.5 * F.coalesce("addr_cos", F.lit(0.0)), 9)


def matches(scored: DataFrame, threshold: float, topk: int) -> DataFrame:
    return scored.where((F.col("cand_rank") < topk) & (F.col("proba") >= threshold))


def filled(pairs: DataFrame) -> DataFrame:
    """Features as doubles without nulls, and a flag for each that was missing."""
    values = {f"f_{c}": F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in FEATURES}
    return pairs.withColumns(values | {f"m_{c}": F.col(c).isNull().cast("double") for c in FEATURES})


def behind(pairs: DataFrame) -> DataFrame:
    """The same rows without their plan, which else the driver copies and describes again in every step that follows.

    What the steps before left in the driver is collected, so that its heap need not grow and Spark deletes their shuffles.
    """
    spark = pairs.sparkSession
    out = DataFrame(spark._jsparkSession.createDataFrame(pairs._jdf.javaRDD(), pairs._jdf.schema()), spark)
    spark.sparkContext._jvm.System.gc()
    return out


def stopping(s1_id: Column) -> Column:
    """Whether a training entity decides when to stop: a tenth of them, by a hash."""
    return hash_uniform(s1_id, 1) < 0.1


def fit(labelled: DataFrame, rounds: int = ROUNDS, depth: int = 5, rate: float = 0.08, seed: int = 42, tolerance: float = 0.0) -> PipelineModel:
    """Boosted trees on labelled pairs, which the caller keeps; positives weighted by negatives / positives.

    The stopping entities end the training at the first round that does not lower
    their loss by the share ``tolerance``, after ``rounds`` at most. There is no patience of further rounds, as in Spark's own trainer.
    """
    counts = labelled.agg(F.sum("is_match").alias("p"), F.count("*").alias("n")).first()
    weight = (counts["n"] - counts["p"]) / counts["p"] if counts["p"] else 1.0
    rows = filled(behind(labelled.select(*FEATURES, F.col("is_match").alias("label"), stopping(F.col("s1_id")).alias("stops"), F.hash("s1_id", "cand_id").alias("key"))))
    columns = [f"{k}_{c}" for c in FEATURES for k in ("f", "m")]
    trees = boosting.fit(rows, columns, counts["n"], weight, rounds, depth, rate, share=0.9, each=0.9, seed=seed, tolerance=tolerance)
    return PipelineModel([VectorAssembler(inputCols=columns, outputCol="features"), trees])


def predict(model: PipelineModel, pairs: DataFrame) -> DataFrame:
    """Add proba to pairs with features."""
    scored = model.transform(filled(pairs)).withColumn("proba", vector_to_array("probability")[1])
    return scored.select(*pairs.columns, "proba")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
