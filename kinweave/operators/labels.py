"""Labels, splits and samples of pairs and entities, all by portable hashes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.scores import hash_uniform

SEED = 42


def truth_by_text(s1: DataFrame, pool: DataFrame) -> DataFrame:
    """True pairs of the entity view: equal text hashes."""
    left = s1.select(F.col("entity_id").alias("s1_id"), "h")
    return left.join(pool.select(F.col("entity_id").alias("cand_id"), "h"), "h").select("s1_id", "cand_id")


def label_by_text(pairs: DataFrame) -> DataFrame:
    """Add is_match to pairs with both sides' text hashes: the pairs of truth_by_text, without listing all of them."""
    return pairs.withColumn("is_match", F.coalesce((F.col("h_1") == F.col("h_2")).cast("int"), F.lit(0)))


def degrees_by_text(s1: DataFrame, pool: DataFrame) -> DataFrame:
    """Number of true matches of every S1 id, from the sizes of the classes of equal text hashes: entity_id, degree."""
    sizes = pool.groupBy("h").agg(F.count("*").alias("degree"))
    return s1.select("entity_id", "h").join(sizes, "h", "left").select("entity_id", F.coalesce("degree", F.lit(0)).alias("degree"))


def known_truth(truth: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """The true pairs whose two ids exist."""
    ids = lambda df, name: df.select(F.col("entity_id").alias(name))
    return truth.join(ids(s1, "s1_id"), "s1_id", "left_semi").join(ids(pool, "cand_id"), "cand_id", "left_semi")


def label(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Add is_match (1 or 0)."""
    marked = truth.select("s1_id", "cand_id").distinct().withColumn("is_match", F.lit(1))
    return pairs.join(marked, ["s1_id", "cand_id"], "left").withColumn("is_match", F.coalesce("is_match", F.lit(0)))


def sample_negatives(labelled: DataFrame, validation: DataFrame, ratio: float, seed: int = SEED) -> DataFrame:
    """Keep validation pairs, positives, and a hashed share of the other negatives; none of those at ratio 0."""
    marked = labelled.join(validation.select(F.col("entity_id").alias("s1_id"), F.lit(1).alias("val")), "s1_id", "left")
    drawn = hash_uniform(F.concat_ws("|", "s1_id", "cand_id"), seed) < ratio
    return marked.where(F.col("val").isNotNull() | (F.col("is_match") == 1) | drawn).withColumn("is_val", F.coalesce("val", F.lit(0))).drop("val")


def sample_ids(entities: DataFrame, share: float, seed: int = SEED) -> DataFrame:
    """Ids of the hashed share of entities."""
    return entities.select("entity_id").where(hash_uniform(F.col("entity_id"), seed) < share)


def sample_n(entities: DataFrame, n: int, seed: int = SEED) -> DataFrame:
    """The n ids with the smallest hashes."""
    return entities.select("entity_id", hash_uniform(F.col("entity_id"), seed).alias("u")).orderBy("u", "entity_id").limit(n).select("entity_id")


def degrees(s1: DataFrame, truth: DataFrame) -> DataFrame:
    """Number of true matches of every S1 id: entity_id, degree."""
    counts = truth.groupBy(F.col("s1_id").alias("entity_id")).agg(F.count("*").alias("degree"))
    return s1.select("entity_id").join(counts, "entity_id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))


def stratified_halves(degrees: DataFrame, n: int, seed: int = SEED) -> DataFrame:
    """About n ids, drawn from each stratum (degree up to 4) in proportion, in two disjoint halves: entity_id, stratum, half.

    Each stratum gives the rounded-up share of n; its draws alternate between the halves in the
    order of their hashes. Each task keeps the first draws of a stratum only, and about n rows are ordered in one.
    """
    strata = degrees.select("entity_id", F.least("degree", F.lit(4)).alias("stratum"), hash_uniform(F.col("entity_id"), seed).alias("u"))
    sizes = {r["stratum"]: r["size"] for r in strata.groupBy("stratum").agg(F.count("*").alias("size")).collect()}  # five rows
    total = sum(sizes.values())
    draws = [strata.where(F.col("stratum") == k).orderBy("u", "entity_id").limit(-(-size * n // total)) for k, size in sorted(sizes.items())]
    drawn = reduce(DataFrame.unionByName, draws, strata.limit(0))
    order = Window.partitionBy("stratum").orderBy("u", "entity_id")
    half = F.when(F.row_number().over(order) % 2 == 1, "calibration").otherwise("tuning")
    return drawn.select("entity_id", "stratum", half.alias("half"))


def class_weight(labelled: DataFrame) -> DataFrame:
    """positives, negatives and the weight negatives / positives (null without positives)."""
    counts = labelled.agg(F.coalesce(F.sum("is_match"), F.lit(0)).alias("positives"), F.coalesce(F.sum(1 - F.col("is_match")), F.lit(0)).alias("negatives"))
    return counts.withColumn("weight", F.when(F.col("positives") > 0, F.col("negatives") / F.col("positives")))
