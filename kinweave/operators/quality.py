"""Gates, validation of results, and data profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions import textnorm as tn
from kinweave.functions.scores import jaccard

#: Features whose medians are compared (fixed values).
GATE_FEATURES = ["name_cos", "name_jaccard_suffix_stripped", "addr_jaccard", "addr_cos", "street_number_match"]
#: Tokens that name other countries (fixed values).
SIGNALS = ["usa", "united", "states", "india", "delhi", "mumbai"]
#: Bins of a median's histogram.
BINS = 4096
#: Leading prefixes of ids by side.
PREFIXES = ("S2-", "S3-")


def medians(flat: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Exact median of each group (keys..., median); nulls don't count, and a group of nulls alone has no row.

    A histogram of a group, which is counted before rows are moved, tells in which of its bins the middle ranks lie. The rows are
    read again for these bins alone, become counts of distinct values and are ordered, so no group's values meet in one buffer. Bins cut
    the range from 0 to 1, where the features lie; values outside it are in the first and the last.
    """
    bin_of = F.floor(F.least(F.greatest(F.col("v"), F.lit(0.0)), F.lit(1.0)) * (BINS - 1)).cast("int")
    binned = flat.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("v")).withColumn("bin", bin_of)
    all_of = Window.partitionBy(*keys)
    before = lambda w: F.coalesce(F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = binned.groupBy(*keys, "bin").agg(F.count("*").alias("c"))
    bins = bins.select(*keys, "bin", "c", before(all_of.orderBy("bin")).alias("below"), F.sum("c").over(all_of).alias("n"))
    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    holds = lambda rank, at: (at <= rank) & (rank < at + F.col("c"))
    middle = bins.where(holds(low, F.col("below")) | holds(high, F.col("below"))).select(*keys, "bin", "below", "n")  # two rows a group at most
    distinct = binned.join(F.broadcast(middle), [*keys, "bin"]).groupBy(*keys, "bin", "below", "n", "v").agg(F.count("*").alias("c"))
    inside = distinct.withColumn("at", F.col("below") + before(Window.partitionBy(*keys, "bin").orderBy("v")))
    pick = lambda rank: F.max(F.when(holds(rank, F.col("at")), F.col("v")))
    return inside.groupBy(*keys).agg(((pick(low) + pick(high)) / 2).alias("median"))


def feature_medians(labelled: DataFrame) -> DataFrame:
    """Median of each gate feature by class; nulls don't count: feature, is_match, median (null if all are)."""
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in GATE_FEATURES])
    flat = labelled.select("is_match", F.explode(rows).alias("r")).select("is_match", "r.*")
    every = labelled.select("is_match").distinct().select(F.explode(F.array(*map(F.lit, GATE_FEATURES))).alias("feature"), "is_match")
    return every.join(medians(flat, ["feature", "is_match"], "v"), ["feature", "is_match"], "left")


def adversarial_gate(labelled: DataFrame, by: str = "name_cos", floor: float = 0.99, gap: float = 0.1) -> DataFrame:
    """Whether addresses part true and false pairs of nearly equal names: medians of addr_jaccard and a verdict.

    The verdict is SKIP if either side has no pairs, PASS if the medians differ by more than ``gap``, else FLAG.
    """
    alike = labelled.where(F.col(by) >= floor).select("is_match", F.col("addr_jaccard").cast("double").alias("v"))
    sizes = alike.agg(F.count(F.when(F.col("is_match") == 1, 1)).alias("positives"), F.count(F.when(F.col("is_match") == 0, 1)).alias("negatives"))
    of = lambda m: F.max(F.when(F.col("is_match") == m, F.col("median")))
    counted = sizes.join(F.broadcast(medians(alike, ["is_match"], "v").agg(of(1).alias("positive_median"), of(0).alias("negative_median"))))
    apart = F.coalesce(F.col("positive_median") - F.col("negative_median") > gap, F.lit(False))
    verdict = F.when((F.col("positives") == 0) | (F.col("negatives") == 0), "SKIP").when(apart, "PASS").otherwise("FLAG")
    return counted.withColumn("verdict", verdict)


def normalization_gain(pairs: DataFrame) -> DataFrame:
    """Name similarity of true pairs before and after normalization: sums and how many did not get worse."""
    raw = jaccard(tn.raw_tokens(F.col("business_name_1")), tn.raw_tokens(F.col("business_name_2")))
    norm = jaccard(tn.tokens(F.col("name_t_1")), tn.tokens(F.col("name_t_2")))
    return pairs.select(raw.alias("r"), norm.alias("n")).agg(
        F.count("*").alias("pairs"),
        F.coalesce(F.sum("r"), F.lit(0.0)).alias("raw_sum"),
        F.coalesce(F.sum("n"), F.lit(0.0)).alias("norm_sum"),
        F.count(F.when(F.col("n") >= F.col("r"), 1)).alias("improved_or_equal"),
    )


def header_errors(first_line: str, expected: tuple[str, str]) -> list[str]:
    """What is wrong with a result file's header line."""
    if "\t" not in first_line and "," in first_line:
        return ["comma-separated, not tab-separated"]
    found = [c.strip().lower() for c in first_line.rstrip("\r\n").split("\t")]
    return [] if found == list(expected) else [f"columns are {found}"]


def validate(matching: DataFrame, candidate: DataFrame, s1: DataFrame, pool: DataFrame | None = None, examples: int = 5) -> DataFrame:
    """Violations of result lists by rule: rule, severity, n, examples (the first in order).

    Rules per file: duplicate_row, duplicate_id, self_match, wrong_prefix, unknown_id (only with
    ``pool``), missing_entity, extra_entity; and subset, a match that is no candidate, a warning. Only
    violated rules have a row.
    """
    lists = {"matching": (matching.persist(), "matched_entity_ids"), "candidate": (candidate.persist(), "candidate_entity_ids")}  # read by rows and by ids
    source = F.col("source1_entity_id")
    count = lambda name: [F.lit(int(n == name)).cast("long").alias(n) for n in (*lists, "known")]
    summed = [F.sum(n).alias(n) for n in (*lists, "known")]
    listed = [df.select(source, *count(name)) for name, (df, _) in lists.items()]
    by_source = reduce(DataFrame.unionByName, [*listed, s1.select(F.col("entity_id").alias("source1_entity_id"), *count("known"))]).groupBy(source).agg(*summed)
    flat = []
    for name, (df, column) in lists.items():
        ids = F.filter(F.split(F.coalesce(column, F.lit("")), ","), lambda i: F.trim(i) != "")
        flat.append(df.select(source, F.explode(ids).alias("id"), *count(name)).withColumn("id", F.trim("id")))
    by_pair = reduce(DataFrame.unionByName, flat).groupBy(source, "id").agg(*summed)
    if pool is not None:
        by_pair = by_pair.drop("known").join(pool.select(F.col("entity_id").alias("id"), F.lit(1).alias("known")).distinct(), "id", "left")

    def found(df: DataFrame, item: Column, rules: list[tuple[str, str, Column]]) -> DataFrame:
        """One row per violated rule of each row: how often the item counts, 0 or null for not at all."""
        each = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), n.cast("long").alias("n")) for rule, severity, n in rules])
        return df.select(item.alias("item"), F.explode(F.filter(each, lambda r: r["n"] > 0)).alias("r")).select("r.rule", "r.severity", "item", "r.n")

    rows, pairs = [], []
    own = F.col("id").startswith("S1-")
    prefixed = own | reduce(lambda a, b: a | b, [F.col("id").startswith(p) for p in PREFIXES])
    for name in lists:
        n = F.col(name)
        rows += [(f"{name}_{rule}", "error", F.when(where, times)) for rule, where, times in (
            ("duplicate_row", n > 1, F.lit(1)), ("missing_entity", n == 0, F.col("known")), ("extra_entity", F.col("known") == 0, n),
        )]
        pairs += [(f"{name}_{rule}", "error", F.when(where, times)) for rule, where, times in (
            ("duplicate_id", n > 1, F.lit(1)), ("self_match", own, n), ("wrong_prefix", ~prefixed, n), ("unknown_id", F.lit(pool is not None) & F.col("known").isNull(), n),
        )]
    pairs.append(("subset", "warning", F.when(F.col("candidate") == 0, F.col("matching"))))
    every = found(by_source, source, rows).unionByName(found(by_pair, F.concat_ws(">", source, F.col("id")), pairs)).persist()
    order = Window.partitionBy("rule", "severity").orderBy("item")
    first = every.withColumn("k", F.row_number().over(order)).where(F.col("k") <= examples)
    item = F.struct("item", F.least("n", F.lit(examples)).cast("int").alias("n"))
    repeated = F.flatten(F.transform(F.array_sort(F.collect_list(item)), lambda x: F.array_repeat(x["item"], x["n"])))
    shown = first.groupBy("rule", "severity").agg(F.array_join(F.slice(repeated, 1, examples), ",").alias("examples"))
    return every.groupBy("rule", "severity").agg(F.sum("n").alias("n")).join(shown, ["rule", "severity"])


def order_errors(matching: DataFrame, candidate: DataFrame, examples: int = 5) -> DataFrame:
    """Places at which two files (number, value of their lines) have rows of different ids, or only one has a row, as validate() reports them."""
    key = lambda df, name: df.select("number", F.substring_index("value", "\t", 1).alias(name))
    both = key(matching, "m").join(key(candidate, "c"), "number", "full").where(~F.col("m").eqNullSafe(F.col("c")))
    item = F.concat_ws(">", F.coalesce("m", F.lit("")), F.coalesce("c", F.lit("")))
    first = F.array_sort(F.collect_list(F.struct("number", item.alias("item"))))
    shown = both.orderBy("number").limit(examples).agg(F.array_join(first["item"], ",").alias("examples"))
    return both.agg(F.count("*").alias("n")).where("n > 0").join(F.broadcast(shown)).select(F.lit("row_order").alias("rule"), F.lit("error").alias("severity"), "n", "examples")


def fingerprint(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """Order-free fingerprint of a set of pairs per key: n, sum of hashes, xor of hashes."""
    h = F.conv(F.substring(F.md5(F.col(value).cast("binary")), 1, 12), 16, 10).cast("long")
    return pairs.groupBy(key).agg(F.count("*").alias("n"), F.sum(h).alias("hash_sum"), F.bit_xor(h).alias("hash_xor"))


def country_profile(entities: DataFrame) -> DataFrame:
    """Rows, shares and non-ASCII rates by country."""
    rate = lambda c: F.avg(F.when(F.col(c).rlike(r"[^\x00-\x7F]"), 1.0).otherwise(0.0))
    counted = entities.groupBy("country").agg(F.count("*").alias("n"), rate("business_name").alias("non_ascii_name"), rate("business_address").alias("non_ascii_address"))
    total = entities.agg(F.count("*").alias("total"))
    return counted.join(F.broadcast(total)).select("country", "n", (F.col("n") / F.col("total")).alias("share"), "non_ascii_name", "non_ascii_address")


def signal_tokens(entities: DataFrame, signals: list[str] = SIGNALS, n: int = 20) -> DataFrame:
    """The n most frequent signal tokens of names and addresses: token, n."""
    words = F.concat(*[F.split(F.lower(F.coalesce(c, F.lit(""))), r"\s+") for c in ("business_name", "business_address")])
    rows = entities.select(F.explode(words).alias("token")).where(F.col("token").isin(signals))
    return rows.groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(n)


def length_percentiles(entities: DataFrame, column: str) -> DataFrame:
    """Length percentiles by source: src, p50, p95, p99, longest."""
    size = F.length(column)
    return entities.groupBy("src").agg(*[F.percentile(size, p / 100).alias(f"p{p}") for p in (50, 95, 99)], F.max(size).alias("longest"))


def duplicate_names(entities: DataFrame) -> DataFrame:
    """Groups of S1-, S2- or S3-internal entities with one name and country: src, groups, members."""
    groups = entities.groupBy("src", "country", "name_s").agg(F.count("*").alias("m")).where("m > 1")
    return groups.groupBy("src").agg(F.count("*").alias("groups"), F.sum("m").alias("members"))


def identical_name_nonmatches(s1: DataFrame, pool: DataFrame, truth: DataFrame) -> DataFrame:
    """Pairs of one country and stripped name that are no true pairs, counted from group sizes: pairs, true_pairs, non_matches."""
    key = ["country", "name_s"]
    sizes = s1.groupBy(*key).agg(F.count("*").alias("a")).join(pool.groupBy(*key).agg(F.count("*").alias("b")), key)
    total = sizes.agg(F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0)).alias("pairs"))
    side = lambda df, k: df.select(F.col("entity_id").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in key])
    same = truth.join(side(s1, "s1_id"), "s1_id").join(side(pool, "cand_id"), "cand_id")
    same = same.where("country_s1_id = country_cand_id and name_s_s1_id = name_s_cand_id")
    return total.join(F.broadcast(same.agg(F.count("*").alias("true_pairs")))).withColumn("non_matches", F.col("pairs") - F.col("true_pairs"))


def prefix_coverage(s1: DataFrame, pool: DataFrame, truth: DataFrame) -> DataFrame:
    """Share of true pairs that agree in country and a simple key: rule, covered, true_pairs, coverage."""
    cut = {
        "first_2": lambda c: F.substring(c, 1, 2),
        "first_3": lambda c: F.substring(c, 1, 3),
        "first_4": lambda c: F.substring(c, 1, 4),
        "first_token": lambda c: F.substring_index(c, " ", 1),
        "first_2_tokens": lambda c: F.substring_index(c, " ", 2),
    }
    side = lambda df, k, n: df.select(F.col("entity_id").alias(k), F.col("country").alias(f"country_{n}"), F.col("name_s").alias(f"name_{n}"))
    both = truth.join(side(s1, "s1_id", 1), "s1_id").join(side(pool, "cand_id", 2), "cand_id")
    near = F.col("country_1") == F.col("country_2")
    counts = both.agg(F.count("*").alias("true_pairs"), *[F.count(F.when(near & (f(F.col("name_1")) == f(F.col("name_2"))), 1)).alias(k) for k, f in cut.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("covered")) for k in cut])
    return counts.select("true_pairs", F.explode(rows).alias("r")).select(
        "r.rule", "r.covered", "true_pairs", F.when(F.col("true_pairs") > 0, F.col("r.covered") / F.col("true_pairs")).otherwise(1.0).alias("coverage")
    )
