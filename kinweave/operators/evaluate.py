"""Macro F0.5, threshold and cutoff sweeps, operating points, and blocking recall."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.scores import f_half, safe_divide

#: Thresholds of the sweep: 0.10 to 0.94 in steps of 0.02 (fixed values).
GRID = [(10 + 2 * i) / 100 for i in range(43)]
TOLERANCE = 0.005


def entity_counts(degrees: DataFrame, predicted: DataFrame) -> DataFrame:
    """n_pred, n_true and tp of every S1 id of ``degrees`` (entity_id, degree), zeros included, from labelled predictions."""
    per = predicted.groupBy(F.col("s1_id").alias("entity_id")).agg(F.count("*").alias("n_pred"), F.sum("is_match").alias("tp"))
    joined = degrees.withColumnRenamed("degree", "n_true").join(per, "entity_id", "left")
    return joined.select("entity_id", F.coalesce("n_pred", F.lit(0)).alias("n_pred"), "n_true", F.coalesce("tp", F.lit(0)).alias("tp"))


def entity_f(counts: DataFrame) -> DataFrame:
    return counts.withColumn("f05", f_half(F.col("n_pred"), F.col("n_true"), F.col("tp")))


def bucket(n_true: Column) -> Column:
    return F.when(n_true == 0, "0").when(n_true == 1, "1").when(n_true <= 3, "2-3").otherwise("4+")


def macro_f(counts: DataFrame) -> DataFrame:
    return entity_f(counts).agg(F.avg("f05").alias("macro_f05"), F.count("*").alias("entities"))


def bucket_f(counts: DataFrame) -> DataFrame:
    return entity_f(counts).groupBy(bucket(F.col("n_true")).alias("bucket")).agg(F.avg("f05").alias("macro_f05"), F.count("*").alias("entities"))


def require_same_population(predicted: DataFrame, true: DataFrame) -> None:
    """Raise unless both tables have the same entity_id values."""
    a, b = predicted.select("entity_id"), true.select("entity_id")
    missing, extra = b.join(a, "entity_id", "left_anti").count(), a.join(b, "entity_id", "left_anti").count()
    if missing or extra:
        raise ValueError(f"populations differ: {missing} entities lack predictions, {extra} are unknown")


def sweep(degrees: DataFrame, scored: DataFrame, cutoffs: list[int], grid: list[float] = GRID) -> DataFrame:
    """Macro F0.5 for every cutoff and threshold, with the volume and recall of the candidates.

    ``degrees`` has entity_id and degree; ``scored`` has s1_id, cand_rank, proba and is_match. Each pair falls into
    the cell of the highest threshold that it reaches and the smallest cutoff that admits its rank; per
    entity, suffix sums over the cells give the counts at all thresholds and cutoffs, so each pair is read once, and
    one exchange by entity serves all steps. Result: topk, threshold, macro_f05, avg_candidates_per_s1,
    candidate_recall (1 if nothing is true).
    """
    cutoffs = sorted(cutoffs)
    levels, ks = (F.array(*[F.lit(x) for x in xs]) for xs in (grid, cutoffs))
    level = F.size(F.filter(levels, lambda t: t <= F.col("proba")))
    first = F.size(F.filter(ks, lambda k: k <= F.col("cand_rank")))  # cutoffs that leave the pair out
    cells = scored.select("s1_id", level.alias("level"), first.alias("first"), "is_match").where(F.col("first") < len(cutoffs)).repartition("s1_id")
    cells = cells.groupBy("s1_id", "level", "first").agg(F.count("*").alias("p"), F.sum("is_match").alias("m"))
    at = F.explode(F.slice(ks, F.col("first") + 1, F.lit(len(cutoffs)))).alias("topk")
    bins = cells.select("s1_id", "level", "p", "m", at).groupBy("s1_id", "topk", "level").agg(F.sum("p").alias("p"), F.sum("m").alias("m"))
    own = Window.partitionBy("s1_id", "topk")
    above = own.orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = bins.select(
        "topk", "s1_id", "level", "p", "m",
        F.sum("p").over(above).alias("n_pred"),
        F.sum("m").over(above).alias("tp"),
        F.coalesce(F.lag("level").over(own.orderBy("level")), F.lit(0)).alias("below"),
    )
    held = steps.join(degrees.withColumnRenamed("entity_id", "s1_id"), "s1_id").select(
        "topk", "p", "m",
        F.when(F.col("level") > 0, F.sequence(F.least(F.col("below") + 1, "level"), F.col("level"))).otherwise(F.array(F.lit(0))).alias("levels"),
        f_half(F.col("n_pred"), F.col("degree"), F.col("tp")).alias("f"),
        F.when(F.col("degree") == 0, 1.0).otherwise(0.0).alias("without"),
    )
    # level 0 carries the volume; an entity without a prediction at a threshold scores 1 if nothing is true, else 0
    flat = held.select("topk", "p", "m", "f", "without", F.posexplode("levels").alias("k", "level"))
    once = lambda c: F.sum(F.when(F.col("k") == 0, F.col(c)))
    gained = flat.groupBy("topk", "level").agg(F.sum(F.col("f") - F.col("without")).alias("gain"), once("p").alias("p"), once("m").alias("m")).persist()  # one row a point
    volume = gained.groupBy("topk").agg(F.sum("p").alias("pairs"), F.sum("m").alias("hits"))
    idle = F.coalesce(F.sum(F.when(F.col("degree") == 0, 1.0)), F.lit(0.0))
    whole = degrees.agg(F.greatest(F.count("*"), F.lit(1)).alias("n"), F.coalesce(F.sum("degree"), F.lit(0)).alias("true"), idle.alias("idle"))
    points = degrees.sparkSession.createDataFrame([(k, i + 1, t) for k in cutoffs for i, t in enumerate(grid)], "topk int, level int, threshold double")
    return (
        F.broadcast(points)
        .join(gained.select("topk", "level", "gain"), ["topk", "level"], "left")
        .join(volume, "topk", "left")
        .join(F.broadcast(whole))
        .select(
            "topk",
            "threshold",
            ((F.col("idle") + F.coalesce("gain", F.lit(0.0))) / F.col("n")).alias("macro_f05"),
            (F.coalesce("pairs", F.lit(0)) / F.col("n")).alias("avg_candidates_per_s1"),
            safe_divide(F.coalesce("hits", F.lit(0)), F.col("true"), 1.0).alias("candidate_recall"),
        )
    )


def choose(table: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """The operating point: within ``tolerance`` of the best F0.5, the fewest candidates, then the highest recall and F0.5, the smaller cutoff and threshold."""
    finite = table.where(F.col("macro_f05").isNotNull() & ~F.isnan("macro_f05")).persist()  # one row a point
    best = finite.agg(F.max("macro_f05").alias("best"))
    if best.first()["best"] is None:
        raise ValueError("no operating point has a score")
    near = finite.join(F.broadcast(best)).where(F.col("macro_f05") >= F.col("best") - tolerance).drop("best")
    return near.orderBy("avg_candidates_per_s1", F.desc("candidate_recall"), F.desc("macro_f05"), "topk", "threshold").limit(1)


def blocking_recall(pool: DataFrame, labelled: DataFrame, degrees: DataFrame) -> DataFrame:
    """One row from labelled pairs: pairs, hits, true pairs, recall, pairs per S1 row and share of all possible pairs (only counted)."""
    counted = labelled.agg(F.count("*").alias("pairs"), F.coalesce(F.sum("is_match"), F.lit(0)).alias("hits"))
    sizes = degrees.agg(F.count("*").alias("n1"), F.coalesce(F.sum("degree"), F.lit(0)).alias("true_pairs")).join(F.broadcast(pool.agg(F.count("*").alias("n2"))))
    both = counted.join(F.broadcast(sizes))
    return both.select(
        "pairs",
        "hits",
        "true_pairs",
        safe_divide(F.col("hits"), F.col("true_pairs"), 1.0).alias("recall"),
        safe_divide(F.col("pairs"), F.col("n1"), 0.0).alias("pairs_per_s1"),
        safe_divide(F.col("pairs"), F.col("n1").cast("double") * F.col("n2"), 0.0).alias("share_of_naive"),
    )


def recall_at(labelled: DataFrame, degrees: DataFrame, cutoffs: list[int]) -> DataFrame:
    """Recall and volume of the best K labelled candidates: topk, kept, hits, recall; all cutoffs in one pass."""
    counts = labelled.agg(
        *[F.count(F.when(F.col("cand_rank") < k, 1)).alias(f"kept_{k}") for k in cutoffs],
        *[F.count(F.when((F.col("cand_rank") < k) & (F.col("is_match") == 1), 1)).alias(f"hits_{k}") for k in cutoffs],
    ).join(F.broadcast(degrees.agg(F.coalesce(F.sum("degree"), F.lit(0)).alias("n"))))
    rows = F.array(*[F.struct(F.lit(k).alias("topk"), F.col(f"kept_{k}").alias("kept"), F.col(f"hits_{k}").alias("hits")) for k in cutoffs])
    return counts.select("n", F.explode(rows).alias("r")).select("r.*", safe_divide(F.col("r.hits"), F.col("n"), 1.0).alias("recall"))


def recall_grid(runs: dict[str, tuple[DataFrame, DataFrame]], cutoffs: list[int]) -> DataFrame:
    """recall_at for several settings, by name (labelled candidates and degrees of each): setting, topk, kept, hits, recall."""
    each = [recall_at(pairs, degrees, cutoffs).select(F.lit(name).alias("setting"), "*") for name, (pairs, degrees) in runs.items()]
    return reduce(DataFrame.unionByName, each)
