"""TF-IDF weights fitted on the pool, cosine similarity of pairs, and the ranking proxy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.scores import dot, round_scaled
from kinweave.operators.blocking import top_k

#: Text column of each field.
FIELDS = {"name": "name_t", "addr": "addr_n"}
PROXIES = {"mean": lambda a, b: (a + b) / 2, "max": F.greatest}


def terms(entities: DataFrame) -> DataFrame:
    """Token counts: entity_id, field, token, tf (1 + ln of the count)."""
    lists = F.array(
        *[F.struct(F.lit(f).alias("field"), F.filter(F.split(F.lower(c), r"\s+"), lambda t: t != "").alias("t")) for f, c in FIELDS.items()]
    )
    flat = entities.select("entity_id", F.explode(lists).alias("l")).select("entity_id", "l.field", F.explode("l.t").alias("token"))
    return flat.groupBy("entity_id", "field", "token").agg((1 + F.log(F.count("*"))).alias("tf"))


def idf(pool: DataFrame, least: int = 2) -> DataFrame:
    """Smoothed inverse document frequency of the pool's tokens: field, token, df, idf.

    Tokens of fewer than ``least`` entities are dropped, unless a field would then have none.
    """
    n = pool.agg(F.count("*").alias("n"))
    df = terms(pool).groupBy("field", "token").agg(F.count("*").alias("df"))
    most = df.groupBy("field").agg(F.max("df").alias("most"))
    kept = df.join(F.broadcast(most), "field").where((F.col("df") >= least) | (F.col("most") < least))
    return kept.join(F.broadcast(n)).select("field", "token", "df", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def vectors(entities: DataFrame, fitted: DataFrame) -> DataFrame:
    """One row per entity with a map from token to unit-length weight for each field; null where it has no known token."""
    raw = terms(entities).join(fitted.select("field", "token", "idf"), ["field", "token"])
    entry = F.struct("token", (F.col("tf") * F.col("idf")).alias("weight"))
    lists = raw.groupBy("entity_id").agg(*[F.array_sort(F.collect_list(F.when(F.col("field") == f, entry))).alias(f) for f in FIELDS])
    norms = lists.select("*", *[F.sqrt(F.aggregate(f, F.lit(0.0), lambda s, e: s + e["weight"] * e["weight"])).alias(f"{f}_norm") for f in FIELDS])
    unit = lambda f: F.map_from_entries(F.transform(f, lambda e: F.struct(e["token"], e["weight"] / F.col(f"{f}_norm"))))
    return norms.select("entity_id", *[F.when(F.size(f) > 0, unit(f)).alias(f"{f}_v") for f in FIELDS])


def weights(entities: DataFrame, fitted: DataFrame) -> DataFrame:
    """The vectors' entries: entity_id, field, token, weight."""
    held = vectors(entities, fitted)
    each = [held.select("entity_id", F.lit(f).alias("field"), F.explode(f"{f}_v").alias("token", "weight")) for f in FIELDS]
    return reduce(DataFrame.unionByName, each)


def with_sides(pairs: DataFrame, s1: DataFrame, pool: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs with both entities' columns, as <column>_1 and <column>_2."""
    side = lambda df, key, n: df.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{c}_{n}") for c in columns])
    return pairs.join(side(s1, "s1_id", 1), "s1_id").join(side(pool, "cand_id", 2), "cand_id")


def cosines(pairs: DataFrame) -> DataFrame:
    """Add name_cos and addr_cos from the sides' vectors; 0 where a side has no known token."""
    return pairs.withColumns({f"{f}_cos": F.round(dot(F.col(f"{f}_v_1"), F.col(f"{f}_v_2")), 9) for f in FIELDS})


def proxy(kind: str = "mean") -> Column:
    """Mean or larger of the cosines; the name's alone where either address is blank."""
    both = (F.col("addr_n_1") != "") & (F.col("addr_n_2") != "")
    return round_scaled(PROXIES[kind](F.col("name_cos"), F.when(both, F.col("addr_cos")).otherwise(F.col("name_cos"))), 9)


def rank_by_proxy(pairs: DataFrame, kind: str = "mean", k: int = 0) -> DataFrame:
    """Rank candidates by the proxy; k of 0 or less keeps all."""
    scored = pairs.withColumn("proxy", proxy(kind))
    return top_k(scored, "proxy", k if k > 0 else (1 << 31) - 2)
