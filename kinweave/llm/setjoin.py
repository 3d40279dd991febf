"""Exact joins of sets by Jaccard similarity: prefixes from rare to common members, partitions by size, the hub of a member first."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import settle
from kinweave.llm.components import components

#: Share of the members' space that is counted first, to find the sets that have too many members of their own.
FIRST_SHARE = 0.3
#: Tables in which sets meet one more each, and least hashes in a key of each.
TABLES, WORDS = 16, 8


def least_common(similarity: float, n: Column) -> Column:
    """The fewest members that a set of n has in common with a set that is as alike as ``similarity``."""
    return F.ceil(similarity * n - 1e-9)


def alone(members: DataFrame) -> DataFrame:
    """(node, alone): how many of the ``members`` (x, node) no other set has; sets without any have no row."""
    only = members.groupBy("x").agg(F.min("node").alias("node"), F.max("node").alias("last")).where("node = last")
    return only.groupBy("node").agg(F.count("*").alias("alone"))


def may_have_partner(similarity: float) -> Column:
    """Whether a set (n, alone) may be alike to another: it has few enough members of its own, or of those in a part of the space."""
    return (F.col("n") > 0) & (F.coalesce("alone", F.lit(0)) <= F.col("n") - least_common(similarity, F.col("n")))


def profiles(sets: DataFrame, similarity: float) -> DataFrame:
    """(node, n, own, shared) of sets (node, n, h) that may have a partner: how many members no other has, and the others from rare to common."""
    each = sets.select("node", F.explode("h").alias("x"))
    several = each.groupBy("x").agg(F.count("*").alias("sets")).where("sets > 1")
    shared = each.join(several, "x").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("sets", "x"))).alias("shared"))
    sized = sets.select("node", "n").join(shared, "node").withColumn("own", F.col("n") - F.size("shared"))
    return sized.where(F.col("own") <= F.col("n") - least_common(similarity, F.col("n"))).select("node", "n", "own", F.col("shared")["x"].alias("shared"))


def with_both(sets: DataFrame, pairs: DataFrame, columns: list[str]) -> DataFrame:
    of = lambda name: sets.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])
    return pairs.join(of("u"), "u").join(of("v"), "v")


def alike(sets: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose sets reach ``similarity``, exactly."""
    common = F.size(F.array_intersect("shared_u", "shared_v"))
    reached = common >= similarity * (F.col("n_u") + F.col("n_v") - common) - 1e-9
    return with_both(sets, pairs, ["n", "shared"]).where(reached).select("u", "v")


def _can_reach(similarity: float, n: Column, at: Column, m: Column, other_at: Column) -> Column:
    """Whether sets of n and m members can be alike whose first common one has these places in them."""
    return F.least(n - at, m - other_at) >= similarity / (1 + similarity) * (n + m) - 1e-9


def _roots(edges: DataFrame, sets: DataFrame, few: int) -> DataFrame:
    """(node, root) of all sets, by the components of the edges found so far."""
    return settle(sets.select("node").join(components(edges, few), "node", "left").select("node", F.coalesce("root", "node").alias("root")))


def _sketched(sets: DataFrame) -> DataFrame:
    """Pairs (u, v) of sets with equal least hashes in a table: each with the one there that has the smallest share of members of its own."""
    least = lambda k: F.array_min(F.transform("shared", lambda x: F.xxhash64(F.lit(k), x)))
    codes = [F.xxhash64(F.lit(t), *[least(t * WORDS + w) for w in range(WORDS)]) for t in range(TABLES)]
    each = settle(sets.select("node", (F.col("own") / F.col("n")).alias("share"), F.explode(F.array(*codes)).alias("code")))
    leaders = each.groupBy("code").agg(F.min(F.struct("share", "node"))["node"].alias("v"), F.count("*").alias("sets")).where("sets > 1")
    return each.join(leaders, "code").where("node <> v").select(F.col("node").alias("u"), "v")


def links(sets: DataFrame, similarity: float, known: DataFrame | None = None, tables: bool = False, few: int = 0) -> DataFrame:
    """Edges (u, v) that have the components of all pairs of sets whose similarity reaches ``similarity``.

    ``sets`` are profiles; ``known`` are alike pairs found before. Sets are partitioned by size, a partition
    spanning the factor 1 / similarity, so alike sets lie in one partition or in neighbouring ones. In the
    order from rare to common members, two alike sets have their first common one early in both, at places that
    their sizes bound. Under each such member of a partition, sets are first compared with the one
    that has it earliest, for its share of the size: of copies of one original, that is mostly the original. With ``tables``
    (and nothing known), a set also meets one other with equal least hashes in each of TABLES tables. Then those
    outside the member's largest component are compared with all sets there of other components that the
    bound allows, each pair once a member. So rows grow with the sets, and with the pairs only for those that the bound cannot tell
    from alike ones. No pair is missed, each comparison is exact, and skewed members are joins that adaptive execution splits.
    ``few`` is that of components().
    """
    early = (F.col("n") - least_common(similarity, F.col("n")) + 1 - F.col("own")).cast("int")
    part = lambda n: F.floor(F.log(F.col(n)) / math.log(1 / similarity) + 1e-9).cast("int")
    keyed = sets.select("node", "n", "own", part("n").alias("part"), F.posexplode(F.slice("shared", F.lit(1), early)).alias("k", "x"))
    keyed = keyed.select(F.explode(F.array("part", F.col("part") + 1)).alias("part"), "x", "node", "n", (F.col("own") + F.col("k")).alias("at"))
    keyed = settle(keyed)
    key = ["part", "x"]

    none = sets.select(F.col("node").alias("u"), F.col("node").alias("v")).limit(0)
    first = none if known is None else known
    roots = sets.select("node", F.col("node").alias("root")) if known is None else _roots(first, sets, few)
    rooted = keyed.withColumn("root", F.col("node")) if known is None else keyed.join(roots, "node")
    place = F.struct((F.col("at") / F.col("n")).alias("share"), "node", "n", "at", "root")
    several = rooted.groupBy(*key).agg(F.min(place).alias("leader"), F.min("root").alias("a"), F.max("root").alias("b")).where("a < b")
    led = rooted.join(several.select(*key, "leader"), key).where(F.col("root") != F.col("leader.root"))
    led = led.where(_can_reach(similarity, F.col("n"), F.col("at"), F.col("leader.n"), F.col("leader.at")))
    met = led.select(F.col("node").alias("u"), F.col("leader.node").alias("v"))
    second = settle(alike(sets, (met.unionByName(_sketched(sets)) if tables else met).distinct(), similarity))
    merged = second if known is None else roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(second)
    roots = _roots(merged, sets, few)

    rooted = keyed.join(roots, "node")
    counted = rooted.groupBy(*key, "root").agg(F.count("*").alias("members")).groupBy(*key)
    several = counted.agg(F.max(F.struct("members", "root"))["root"].alias("main"), F.count("*").alias("parts")).where("parts > 1").select(*key, "main")
    active = settle(rooted.join(several, key))
    other = active.select(*key, *[F.col(c).alias(f"{c}_v") for c in ("node", "n", "at", "root")])
    apart = (F.col("root") != F.col("root_v")) & ((F.col("root_v") == F.col("main")) | (F.col("node") < F.col("node_v")))
    once = F.greatest(part("n"), part("n_v")) == F.col("part")  # sets of one partition are in the next one too
    rest = active.where("root <> main").join(other, key).where(apart & once & _can_reach(similarity, F.col("n"), F.col("at"), F.col("n_v"), F.col("at_v")))
    third = settle(alike(sets, rest.select(F.col("node").alias("u"), F.col("node_v").alias("v")).distinct(), similarity))
    return first.unionByName(second).unionByName(third)
