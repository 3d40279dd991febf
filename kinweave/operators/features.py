"""Similarity features of candidate pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions import textnorm as tn
from kinweave.functions.scores import levenshtein_similarity
from kinweave.operators import ranking

#: Order of the feature vector (fixed values).
FEATURES = [
    "name_jaccard_raw",
    "name_jaccard_normalized",
    "name_jaccard_suffix_stripped",
    "name_cos",
    "addr_jaccard",
    "addr_cos",
    "token_overlap_count",
    "street_number_match",
    "missing_address_flag",
    "len_delta_name",
    "len_delta_addr",
]
#: Columns of either side that the features read, besides the vectors.
SIDE = ["raw_bag", "nt_bag", "t_bag", "addr_bag", "name_s", "addr_n", "stno"]


def bags(entities: DataFrame) -> DataFrame:
    """Token sets of each entity, made once for all of its pairs."""
    return entities.withColumns(
        {
            "raw_bag": tn.raw_tokens(F.col("business_name")),
            "nt_bag": tn.tokens(F.col("name_nt")),
            "t_bag": tn.tokens(F.col("name_t")),
            "addr_bag": tn.tokens(F.col("addr_t")),
        }
    )


#: What the ranking compares for the features; see measures().
COMPARED = ranking.Extras(("raw_bag", "nt_bag", "t_bag", "addr_bag"), ("number",), ("has_addr", "name_len", "addr_len"))


#: Texts whose edit similarities are taken.
EDITED = ("business_name", "name_n", "name_s", "addr_n")


def measures(entities: DataFrame) -> DataFrame:
    """Entities with their token sets, and their blanks, lengths and street numbers (null for none)."""
    return bags(entities).withColumns(
        {
            "number": F.when(F.col("stno") != "", F.col("stno")),
            "has_addr": (F.col("addr_n") != "").cast("int"),
            "name_len": F.length("name_s"),
            "addr_len": F.length("addr_n"),
        }
    )


def features(pairs: DataFrame) -> DataFrame:
    """Add the eleven features to pairs with both sides' columns; a feature that lacks a value is null."""
    a, b = (lambda c, n=n: F.col(f"{c}_{n}") for n in (1, 2))
    numbers = (a("stno") != "") & (b("stno") != "")
    compared = {"same_number": F.when(numbers, (a("stno") == b("stno")).cast("int"))}
    for c in COMPARED.bags:
        compared |= {f"common_{c}": F.size(F.array_intersect(a(c), b(c))), f"n_{c}_1": F.size(a(c)), f"n_{c}_2": F.size(b(c))}
    for n, side in ((1, a), (2, b)):
        compared |= {f"has_addr_{n}": (side("addr_n") != "").cast("int"), f"name_len_{n}": F.length(side("name_s")), f"addr_len_{n}": F.length(side("addr_n"))}
    return features_of_compared(pairs.withColumns(compared))


def features_of_compared(pairs: DataFrame) -> DataFrame:
    """Add the eleven features to ranked pairs that have the columns of COMPARED."""

    def likeness(c: str) -> Column:
        every = F.col(f"n_{c}_1") + F.col(f"n_{c}_2") - F.col(f"common_{c}")
        return F.when(every == 0, 1.0).otherwise(F.col(f"common_{c}") / every)

    both = (F.col("has_addr_1") == 1) & (F.col("has_addr_2") == 1)
    delta = lambda c: F.abs(F.col(f"{c}_1") - F.col(f"{c}_2")).cast("double")
    return pairs.withColumns(
        {
            "name_jaccard_raw": likeness("raw_bag"),
            "name_jaccard_normalized": likeness("nt_bag"),
            "name_jaccard_suffix_stripped": likeness("t_bag"),
            "addr_jaccard": F.when(both, likeness("addr_bag")),
            "addr_cos": F.when(both, F.col("addr_cos")),
            "token_overlap_count": F.col("common_t_bag"),
            "street_number_match": F.col("same_number").cast("double"),
            "missing_address_flag": 1 - F.col("has_addr_2"),
            "len_delta_name": delta("name_len"),
            "len_delta_addr": delta("addr_len"),
        }
    )


def edit_features(pairs: DataFrame) -> DataFrame:
    """Add edit similarities of the raw, normalized and stripped names and of the addresses."""
    both = (F.col("addr_n_1") != "") & (F.col("addr_n_2") != "")
    lev = lambda c: levenshtein_similarity(F.col(f"{c}_1"), F.col(f"{c}_2"))
    return pairs.withColumns(
        {
            "lev_name_raw": lev("business_name"),
            "lev_name_norm": lev("name_n"),
            "lev_name_strip": lev("name_s"),
            "lev_addr": F.when(both, lev("addr_n")),
            "lev_proxy": F.when(both, (lev("name_s") + lev("addr_n")) / 2).otherwise(lev("name_s")),
        }
    )
