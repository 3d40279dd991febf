"""Candidate generation: key families, document frequencies, caps, evidence and ranking."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions import textnorm as tn

KEY = ["family", "country", "value"]
#: Evidence weight of each key family.
WEIGHTS = {"c3": 0.25, "t": 1.0, "a": 1.25, "sn": 1.0, "fn": 1.5}


@dataclass(frozen=True)
class Caps:
    """Largest document frequency of a key that still counts, by family; inclusive (fixed values)."""

    t: int = 1000
    a: int = 2000
    sn: int = 2000
    fn: int = 20000
    c3: int = 2000

    def column(self) -> Column:
        return _by_family({f: getattr(self, f) for f in WEIGHTS})


def _by_family(values: dict) -> Column:
    out = F.lit(None)
    for family, value in values.items():
        out = F.when(F.col("family") == family, F.lit(value)).otherwise(out)
    return out


def key_array() -> Column:
    """The keys of a normalized entity as an array of family and value; see keys()."""
    one = lambda family, value, keep: F.when(keep, F.array(F.struct(F.lit(family).alias("family"), value.alias("value")))).otherwise(F.array())
    many = lambda family, values: F.transform(values, lambda v: F.struct(F.lit(family).alias("family"), v.alias("value")))
    s, n = F.col("name_s"), F.col("stno")
    return F.concat(
        one("c3", F.substring(s, 1, 3), F.length(s) >= 3),
        many("t", tn.tokens(F.col("name_t"))),
        many("a", F.filter(tn.tokens(F.col("addr_t")), lambda v: F.length(v) >= 3)),
        one("sn", n, n != ""),
        one("fn", s, s != ""),
    )


def keys(entities: DataFrame) -> DataFrame:
    """Blocking keys of normalized entities: entity_id, family, country, value.

    Families: c3, the first three characters of the stripped name; t, its tokens; a, address tokens
    of three characters or more; sn, the street number; fn, the whole stripped name. All come from
    one pass over the entities; blanks give no key.
    """
    return entities.select("entity_id", "country", F.explode(key_array()).alias("k")).select("entity_id", "k.family", "country", "k.value")


def weight() -> Column:
    """Evidence weight of a key from its family and df."""
    return _by_family(WEIGHTS) / F.log2(2 + F.col("df"))


def frequencies(pool_keys: DataFrame) -> DataFrame:
    return pool_keys.groupBy(*KEY).agg(F.count("*").alias("df"))


def allowed(df: DataFrame, caps: Caps) -> DataFrame:
    return df.where(F.col("df") <= caps.column())


def evidence(s1_keys: DataFrame, pool_keys: DataFrame, kept: DataFrame) -> DataFrame:
    """Weighted evidence of each pair that shares an allowed key: s1_id, cand_id, score.

    Keys are joined with their country, so no pair crosses countries. Only pool keys are capped; a
    key that many S1 rows share is a skewed join, which adaptive execution splits. The matches are dealt by
    s1_id once, which serves the sums and every ranking of an entity's candidates.
    """
    postings = pool_keys.join(kept, KEY).select(*KEY, F.col("entity_id").alias("cand_id"), weight().alias("w"))
    pairs = s1_keys.withColumnRenamed("entity_id", "s1_id").join(postings, KEY)
    return pairs.select("s1_id", "cand_id", "w").repartition("s1_id").groupBy("s1_id", "cand_id").agg(F.round(F.sum("w"), 9).alias("score"))


def top_k(pairs: DataFrame, score: str, k: int, rank: str = "cand_rank") -> DataFrame:
    """The k best pairs of each s1_id with their rank from 0; ties go to the smaller cand_id. None if k is 0 or less."""
    if k <= 0:
        return pairs.withColumn(rank, F.lit(0)).limit(0)
    order = Window.partitionBy("s1_id").orderBy(F.desc(score), "cand_id")
    return pairs.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k).withColumn(rank, F.col(rank) - 1)


def prefilter(scored: DataFrame, most: int) -> DataFrame:
    """The ``most`` pairs of each s1_id with most evidence; all if ``most`` is 0 or less."""
    return top_k(scored, "score", most, "evidence_rank") if most > 0 else scored.withColumn("evidence_rank", F.lit(None).cast("int"))


def candidates(s1: DataFrame, pool: DataFrame, caps: Caps = Caps(), most: int = 2000) -> DataFrame:
    """Candidate pairs of normalized entities by capped keys and evidence."""
    s1_keys, pool_keys = keys(s1), keys(pool)
    return prefilter(evidence(s1_keys, pool_keys, allowed(frequencies(pool_keys), caps)), most)


def plain_union(s1: DataFrame, pool: DataFrame, caps: Caps = Caps()) -> DataFrame:
    """Distinct pairs that share an allowed key, without evidence. An uncapped family makes nearly all pairs of a country."""
    pool_keys = keys(pool)
    kept = pool_keys.join(allowed(frequencies(pool_keys), caps).select(*KEY), KEY, "left_semi")
    return keys(s1).withColumnRenamed("entity_id", "s1_id").join(kept.withColumnRenamed("entity_id", "cand_id"), KEY).select("s1_id", "cand_id").distinct()
