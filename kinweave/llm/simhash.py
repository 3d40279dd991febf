"""SimHash fingerprints, and near duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.llm import setjoin
from kinweave.llm.common import broadcast_if_small, over_texts, settle, text_or_empty
from kinweave.llm.components import components

BITS = 64
#: Shingles whose bits are counted at once.
BLOCK = 1 << 12


def _shingles(text: str, words: int) -> np.ndarray:
    """XXH64 (seed 42) of the text's word shingles in order; none for a text without words."""
    own = text.encode("utf-8", "replace").lower().split()
    if not own:
        return np.empty(0, np.uint64)
    joined = b" ".join(own)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(own) - words + 1)
    last = ends[min(words, len(own)) - 1 :].tolist()
    hash_of = xxhash.xxh64_intdigest
    return np.fromiter((hash_of(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), last, strict=True)), np.uint64, n)


def _majority(h: np.ndarray) -> list[int]:
    """For each column of hashes, the bits that over half of its rows have."""
    wide = h[:, None] if h.ndim == 1 else h
    count = np.zeros(BITS * wide.shape[1], np.int64)
    for lo in range(0, len(wide), BLOCK):
        rows = np.ascontiguousarray(wide[lo : lo + BLOCK], "<u8").view(np.uint8)
        count += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return np.packbits(2 * count > len(wide), bitorder="little").view("<u8").tolist()


def fingerprint(text: str, words: int = 3) -> int:
    """SimHash of the text's word shingles, repeats included, as an unsigned 64-bit number.

    Words are split at ASCII white space after A-Z are lowered. A shorter text is one shingle; a text
    without words has fingerprint 0. A bit is 1 if set in over half the shingles' XXH64 (seed 42).
    """
    h = _shingles(text, words)
    return _majority(h)[0] if len(h) else 0


def _mixed(h: np.ndarray, columns: int) -> np.ndarray:
    """Further 64 bits of each hash, a column each: the finishing steps of SplitMix64 on its sequence."""
    with np.errstate(over="ignore"):
        z = h[:, None] + np.arange(1, columns + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, f) of every whole text, f being the fingerprint as a signed long; null text: empty."""
    return over_texts(docs, lambda: lambda texts: [np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)], "f long")


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """2^(radius+1) - 1 masks such that any ``radius`` bits are all left out by one of them.

    Bit i has a non-zero vector m(i) of radius+1 bits, and each non-zero vector v makes the mask of the
    bits where v and m(i) have an odd number of ones in common. Any ``radius`` vectors m(i) have a
    common orthogonal v, so fingerprints that differ in those bits agree under its mask. The m(i)
    are dealt round robin, so each mask keeps somewhat over half of the bits.
    """
    tables = (1 << (radius + 1)) - 1
    vectors = [i % tables + 1 for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if (v & m).bit_count() % 2) for v in range(1, tables + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (u, v) whose components are those of all distinct fingerprints ``f`` within ``radius`` bits.

    Every fingerprint goes into a bucket of each covering table, so that each pair within the radius
    shares one. Inside a bucket, members within the radius are found without comparing pairs:
    each member is also listed under the values that it reaches by flipping up to radius/2 bits
    (rounded up) that the table's mask leaves out. Two members listed under one value by h and
    radius - h flips are within the radius; they are linked through the value's least member.
    ``radius`` is 1 or 2: then both meet after one flip at most, and a value lists 65 members at
    most. Buckets are never cut.
    """
    if radius not in (1, 2):
        raise ValueError("radius is 1 or 2")
    masks = covering_masks(radius)
    free = [[_signed(1 << b) for b in range(BITS) if not m >> b & 1] for m in masks]
    held = F.array(*[F.lit(_signed(m)) for m in masks])
    flips = F.array(*[F.split(F.lit(",".join(map(str, [0, *x]))), ",").cast("array<bigint>") for x in free])
    tables = prints.select("f", F.explode(F.sequence(F.lit(0), F.lit(len(masks) - 1))).alias("t"))
    keyed = tables.withColumn("key", F.col("f").bitwiseAND(F.get(held, F.col("t"))))
    shared = keyed.groupBy("t", "key").agg(F.min("f").alias("a"), F.max("f").alias("b")).where("a < b").select("t", "key")
    near = keyed.join(shared, ["t", "key"]).select(
        "f", "t", F.explode(F.transform(F.get(flips, F.col("t")), lambda x: F.col("f").bitwiseXOR(x))).alias("value")
    )
    if radius == 1:  # one flip joins a value and its neighbours, but two neighbours of a value are 2 apart
        met = near.groupBy("t", "value").agg(F.collect_set("f").alias("all")).where((F.size("all") > 1) & F.array_contains("all", F.col("value")))
        return met.select(F.explode("all").alias("u"), F.col("value").alias("v")).where("u != v").distinct()
    met = near.groupBy("t", "value").agg(F.collect_set("f").alias("all")).where(F.size("all") > 1)
    return met.select(F.explode("all").alias("u"), F.array_min("all").alias("v")).where("u != v").distinct()


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Documents link if their fingerprints differ in ``radius`` bits or fewer; component_id is the smallest
    doc_id that links reach. Equal fingerprints, also those of empty texts, are one node of the
    graph, so copies cost nothing. Repeated rows stay. A null id is in no component's
    minimum; a component of null ids alone has a null component_id. An empty table gives no rows.
    """
    prints = settle(fingerprints(docs, words))
    nodes = settle(prints.groupBy("f").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes.select("f"), radius))
    named = nodes.join(roots, nodes.f == roots.node, "left").select("f", "least", F.coalesce("root", "f").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.join(least, "root").select("f", "component_id")
    return prints.join(of, "f").select("doc_id", hex16(F.col("f")).alias("fingerprint"), "component_id")


def hex16(f: Column) -> Column:
    return F.lower(F.lpad(F.hex(f), 16, "0"))


#: 64-bit words of a sketch of a set, and the radius of the covering tables of each word.
SKETCH_WORDS, TABLE_RADIUS = 12, 3
#: Pairs that meet in a table are compared if the estimate of their likeness is at most this much under the one asked for.
DOUBT = 0.1
#: Edges of near copies that one task joins; more are contracted in rounds.
FEW_EDGES = 100_000
#: Odd multiplier that mixes the hashes of a shingle's words, and the id that stands for null in a join.
MIX, NO_ID = 0x9E3779B97F4A7C15, -(1 << 63)


def _set_of(text: str, words: int) -> np.ndarray:
    """The text's set of word shingles as sorted distinct 64-bit hashes.

    Words are split at ASCII white space after A-Z are lowered; a shorter text is one shingle, a text without
    words has none. A shingle's hash is a polynomial in the XXH64 of its words, finished by SplitMix64.
    """
    own = text.encode("utf-8", "replace").lower().split()
    if not own:
        return np.empty(0, np.uint64)
    hash_of = xxhash.xxh64_intdigest
    w = np.fromiter(map(hash_of, own), np.uint64, len(own))
    k = min(words, len(w))
    n = len(w) - k + 1
    with np.errstate(over="ignore"):
        z = w[:n].copy()
        for i in range(1, k):
            z = z * np.uint64(MIX) + w[i : i + n]
    return np.unique(_mixed(z, 1)[:, 0])


def _codes(sets: list[np.ndarray]) -> list:
    """Two longs for each set, equal for equal sets only (128 bits of XXH3), and its size."""
    whole = [xxhash.xxh3_128_digest(h.tobytes()) for h in sets]
    return [[int.from_bytes(d[i : i + 8], "little", signed=True) for d in whole] for i in (0, 8)] + [[len(h) for h in sets]]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    """Arrays of unsigned numbers as one column of lists of longs."""
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate([*arrays, np.empty(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _text_codes() -> list[Column]:
    """Two independent 64-bit hashes of the text."""
    text = text_or_empty()
    return [F.xxhash64(text).alias("text_hash"), F.xxhash64(F.lit(1), text).alias("text_other")]


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, text_hash, text_other, s, s_other, n): codes of each whole text and of its set of shingles, and the set's size."""
    coded = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_text_codes())
    made = lambda: lambda texts: _codes([_set_of(t, words) for t in texts])
    return over_texts(coded, made, "s long, s_other long, n int", ("doc_id", "text_hash", "text_other"))


def _hopeful(docs: DataFrame, nodes: DataFrame, words: int, similarity: float) -> DataFrame:
    """The nodes that may have a partner, by the first part of the shingle space."""
    top = int(setjoin.FIRST_SHARE * 2**64)

    def first_part(texts: list[str]) -> list:
        sets = [_set_of(t, words) for t in texts]
        own = [h[: np.searchsorted(h, np.uint64(top))] for h in sets]
        of = np.repeat(np.array(_codes(sets)[0], np.int64), list(map(len, own)))
        return [of, np.concatenate([*own, np.empty(0, np.uint64)]).view(np.int64)]

    # copies need not be left out: they have one code, and add nothing to a shingle's least and greatest
    alone = setjoin.alone(over_texts(docs, lambda: first_part, "node long, x long", ()))
    several = F.count("*").over(Window.partitionBy("s")) > 1  # sets whose first codes collide are not ruled out
    held = nodes.withColumn("several", several).join(alone.withColumnRenamed("node", "s"), "s", "left")
    return settle(held.where((F.col("n") > 0) & (F.col("several") | setjoin.may_have_partner(similarity))).select("node", "stands.*"))


def _profiles(docs: DataFrame, hopeful: DataFrame, words: int, similarity: float) -> DataFrame:
    """(node, n, own, shared, w): of sets that may have a partner, the number of shingles no other such set has, the others from rare to common, and a sketch."""

    def sets(texts: list[str]) -> list:
        own = [_set_of(t, words) for t in texts]
        return [_lists(own), _lists([np.array(_majority(_mixed(h, SKETCH_WORDS)), np.uint64) for h in own])]

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), "text", *_text_codes())
    texts = rows.join(broadcast_if_small(hopeful), ["id", "text_hash", "text_other"])
    found = over_texts(texts, lambda: sets, "h array<long>, w array<long>", ("node",))
    found = settle(found.dropDuplicates(["node"]).withColumn("n", F.size("h")))
    return settle(setjoin.profiles(found.select("node", "n", "h"), similarity).join(found.select("node", "w"), "node"))


def likeness(w: Column, n: Column, other_w: Column, other_n: Column) -> Column:
    """Estimated Jaccard similarity of two shingle sets from their sketches and sizes."""
    apart = F.aggregate(F.zip_with(w, other_w, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, d: s + d)
    shared = F.cos(apart * (math.pi / (BITS * SKETCH_WORDS))) * F.sqrt(n * other_n)
    return F.when(apart == 0, 1.0).otherwise(shared / (n + other_n - F.least(shared, n, other_n)))


def _met_in_tables(sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (u, v) of a set and a leader of the buckets that it shares in the covering tables of the sketch words.

    The leader of a bucket is the set with the least share of shingles of its own, which is the most likely
    to be the original of the others. Of the leaders that a set meets, it is paired with the one of the least share and
    with the one met in most tables. Pairs whose estimate is far too low are left out.
    """
    masks = covering_masks(TABLE_RADIUS)
    held = F.split(F.lit(",".join(str(_signed(m)) for m in masks)), ",").cast("array<bigint>")
    of_table = lambda k: F.xxhash64(k, F.get(F.col("w"), F.floor(k / len(masks)).cast("int")).bitwiseAND(F.get(held, k % len(masks))))
    keys = F.transform(F.sequence(F.lit(0), F.lit(len(masks) * SKETCH_WORDS - 1)), of_table)
    keyed = sets.select("node", F.struct((F.col("own") / F.col("n")).alias("share"), "node").alias("place"), F.explode(keys).alias("key"))
    leaders = keyed.groupBy("key").agg(F.min("place").alias("leader"), F.max("place").alias("last")).where("leader < last")
    met = keyed.join(leaders.select("key", "leader"), "key").where(F.col("node") != F.col("leader.node"))
    met = met.groupBy(F.col("node").alias("u"), "leader").agg(F.count("*").alias("tables"))
    both = F.array_distinct(F.array(F.min("leader")["node"], F.max(F.struct("tables", "leader"))["leader"]["node"]))
    met = met.groupBy("u").agg(both.alias("v")).select("u", F.explode("v").alias("v"))
    guess = likeness(F.col("w_u"), F.col("n_u"), F.col("w_v"), F.col("n_v"))
    return setjoin.with_both(sets, met, ["w", "n"]).where(guess >= similarity - DOUBT).select("u", "v")


def near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """Groups of documents whose sets of word shingles are alike: doc_id, text_hash (XXH64), class_id (the smallest doc_id).

    Groups are the components of all pairs of texts whose sets' Jaccard similarity is ``similarity`` or more. A
    sketch of a set has SKETCH_WORDS words of SimHash, each with covering tables: sets that differ in
    TABLE_RADIUS bits or fewer of any word surely meet, but at 0.8 about 15 % of all bits differ, so tables alone
    cannot promise every pair. They join most; setjoin.links settles the rest by an exact way, so no pair is
    lost. Only sets that may have a partner come that far: one with too many shingles of its own has none. Equal
    sets are one node, so copies cost nothing; texts without words are one group. Repeated rows stay; null ids
    are in no minimum; an empty table gives no rows.
    """
    found = settle(shingle_sets(docs, words))
    stands = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text_hash", "text_other")
    nodes = settle(found.groupBy("s", "s_other").agg(F.min(stands).alias("stands"), F.first("n").alias("n"), F.min("doc_id").alias("least")))
    nodes = settle(nodes.withColumn("node", F.monotonically_increasing_id()))  # numbers of written rows
    sets = _profiles(docs, _hopeful(docs, nodes, words, similarity), words, similarity)
    met = settle(setjoin.alike(sets, _met_in_tables(sets, similarity), similarity))
    linked = components(setjoin.links(sets, similarity, met, few=FEW_EDGES), FEW_EDGES)
    named = nodes.select("s", "s_other", "node", "least").join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = named.groupBy("root").agg(F.min("least").alias("class_id"))
    of = named.join(ids, "root").select("s", "s_other", "class_id")
    return found.join(of, ["s", "s_other"]).select("doc_id", "text_hash", "class_id")


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies, with all its columns.

    Of rows that repeat an id, one stays. Rows without an id stay only if no row of their group
    has one, and then one of each distinct text.
    """
    found = settle(near_copies(docs.select("doc_id", "text"), words, similarity))
    own = F.max(F.col("doc_id") == F.col("class_id"))
    named = settle(found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("_rows"), own.alias("_own")).where("_rows > 1 or not _own"))
    unnamed = found.where("doc_id is null and class_id is null").select(F.col("text_hash").alias("_kept_hash")).distinct()
    # few rows go, or stay once: they are listed, not those that stay
    once = docs.where("doc_id is not null").join(broadcast_if_small(named.select("doc_id")), "doc_id", "left_anti")
    again = docs.join(broadcast_if_small(named.where("_own").select("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    blank = docs.where(F.col("doc_id").isNull()).withColumn("_kept_text", text_or_empty())
    blank = blank.join(unnamed, F.xxhash64("_kept_text") == F.col("_kept_hash"), "left_semi").dropDuplicates(["_kept_text"])
    return once.unionByName(again).unionByName(blank.select(docs.columns))
