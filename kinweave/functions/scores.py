"""Similarity, evaluation and sampling expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(a: Column, b: Column, default: float) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(default))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays of distinct tokens; 1 if both are empty."""
    common = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - common
    return F.when(every == 0, 1.0).otherwise(common / every)


def levenshtein_similarity(a: Column, b: Column) -> Column:
    """1 less the edit distance over the longer length; 1 for two empty texts."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longest)


def dot(a: Column, b: Column) -> Column:
    """Inner product of two maps of token weights; 0 if either is null."""
    terms = F.transform(F.map_entries(a), lambda e: e["value"] * F.coalesce(F.element_at(b, e["key"]), F.lit(0.0)))
    return F.coalesce(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), F.lit(0.0))


def round_scaled(x: Column, digits: int) -> Column:
    """Digits of a number that is not negative, halves of the scaled double up, as SQL rounds; Spark's round goes by the decimal text."""
    scaled = x * float(10**digits)
    low = F.floor(scaled)
    return (low + (scaled - low >= 0.5).cast("int")) / float(10**digits)


def f_half(predicted: Column, true: Column, hits: Column) -> Column:
    """F0.5 of one entity from its counts: 1 if nothing is predicted or true."""
    precision, recall = safe_divide(hits, predicted, 1.0), safe_divide(hits, true, 1.0)
    below = 0.25 * precision + recall
    value = F.when(below > 0, 1.25 * precision * recall / below).otherwise(0.0)
    return F.when((predicted == 0) & (true == 0), 1.0).otherwise(value)


def hash_uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) that key and seed fix: the first 32 bits of an MD5."""
    bits = F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")).cast("binary")), 1, 8), 16, 10)
    return bits.cast("double") / float(1 << 32)
