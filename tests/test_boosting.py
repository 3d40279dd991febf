"""The trainer of boosted trees against Spark's own."""

import random

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from kinweave.operators import boosting, features, model


def labelled(spark, n=1500):
    """Pairs whose features have few values, so that every trainer has the same bins; some addresses are missing."""
    rng = random.Random(11)
    rows = []
    for i in range(n):
        x = [rng.randrange(9) / 8 for _ in features.FEATURES]
        x[4] = x[5] = None if i % 7 == 0 else x[4]
        rows.append((f"S1-{i // 3}", f"S2-{i}", int(x[0] + x[1] * x[2] + 0.1 * rng.random() > 1.05), *x))
    return spark.createDataFrame(rows, "s1_id string, cand_id string, is_match int, " + ", ".join(f"{c} double" for c in features.FEATURES)).persist()


def prepared(pairs):
    columns = [f"{k}_{c}" for c in features.FEATURES for k in ("f", "m")]
    return columns, model.filled(pairs).select("*", F.col("is_match").alias("label"), model.stopping(F.col("s1_id")).alias("stops"), F.hash("s1_id", "cand_id").alias("key"))


def test_rounds_make_no_further_jobs(spark):
    pairs, sc = labelled(spark), spark.sparkContext
    pairs.count()
    made = []
    for rounds in (2, 25):
        sc.setJobGroup(f"trees-{rounds}", "training")
        assert model.fit(pairs, rounds).stages[-1].getNumTrees <= rounds
        made.append(len(sc.statusTracker().getJobIdsForGroup(f"trees-{rounds}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert made[0] == made[1] < 12


def test_trees_are_those_of_spark(spark):
    columns, rows = prepared(labelled(spark))
    rows = rows.withColumn("weight", F.when(F.col("label") == 1, 1.75).otherwise(1.0)).withColumn("label", F.col("label").cast("double")).persist()
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    for rounds, tolerance in ((12, 0.0), (200, 0.02)):
        trees = GBTClassifier(weightCol="weight", validationIndicatorCol="stops", validationTol=tolerance, maxIter=rounds, maxDepth=4, stepSize=0.2, seed=1)
        want = Pipeline(stages=[assembler, trees]).fit(rows)
        got = boosting.fit(rows, columns, rows.count(), 1.75, rounds, 4, 0.2, 1.0, 1.0, 1, tolerance)
        assert got.getNumTrees == want.stages[-1].getNumTrees > 5
        assert got.treeWeights == want.stages[-1].treeWeights
        seen = assembler.transform(rows)
        p = [np.array([r[0][1] for r in m.transform(seen).orderBy("cand_id").select("probability").collect()]) for m in (got, want.stages[-1])]
        assert np.abs(p[0] - p[1]).max() < 1e-5
        assert np.abs(got.featureImportances.toArray() - want.stages[-1].featureImportances.toArray()).max() < 1e-5


def test_trees_do_not_depend_on_tasks(spark):
    columns, rows = prepared(labelled(spark))
    made = [
        boosting.fit(of, columns, 1500, 1.75, 15, 5, 0.08, 0.9, 0.9, 42, 0.0, partitions=n).toDebugString.split("\n", 1)[1]
        for n, of in ((1, rows), (3, rows.repartition(8)), (4, rows.repartition(5, "cand_id")))
    ]
    assert made[0] == made[1] == made[2] and "feature" in made[0]


def test_trees_without_splits_or_stopping_rows(spark):
    columns, rows = prepared(labelled(spark, 300))
    flat = rows.select("key", "label", F.lit(False).alias("stops"), *[F.lit(1.0).alias(c) for c in columns])
    tree = boosting.fit(flat, columns, 300, 1.0, 3, 5, 0.1, 1.0, 1.0, 1, 0.0)
    share = rows.agg(F.avg("label")).first()[0]
    assert tree.getNumTrees == 3 and abs(tree.trees[0].predict(Vectors.dense([0.0] * len(columns))) - (2 * share - 1)) < 1e-6
    kept = boosting.fit(rows.withColumn("stops", F.lit(False)), columns, 300, 1.0, 7, 5, 0.1, 1.0, 1.0, 1, 0.0)
    assert kept.getNumTrees == 7


def test_edges_are_those_of_spark():
    assert boosting.edges(np.array([1.0, 3, 1, 2]), np.ones(4)).tolist() == [1.5, 2.5]
    assert boosting.edges(np.array([2.0, 2]), np.ones(2)).tolist() == []
    many = boosting.edges(np.arange(320.0), np.ones(320))
    assert many.tolist() == [10 * i - 0.5 for i in range(1, 32)]
