"""SpotSigs: signatures of content words that follow common words, compared as sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.llm import setjoin
from kinweave.llm.common import MAX_RANGES, ROWS_PER_RANGE, broadcast_if_small, key_ranges, range_of, settle, text_or_empty
from kinweave.llm.components import components

#: Anchors: common words of the corpus languages, lower case.
ANCHORS = (
    "a an the of and or to in on at by for with from as is are was were be been it that this "
    "der die das den dem des ein eine und oder zu von mit im in ist sind war auf für nicht sich "
    "le la les un une des du de et ou en au aux que qui dans pour est sont sur pas "
    "el los las del y o e un una por con para que es son se su lo"
).split()
#: Content words in a chain.
CHAIN = 3
#: A signature is 32 bits as a signed number, in the order of the unsigned one.
LOWEST = -(1 << 31)


def _code(*words: Column) -> Column:
    """The first 32 bits of an MD5 of words, those that are null left out."""
    return (F.conv(F.substring(F.md5(F.concat_ws(" ", *words).cast("binary")), 1, 8), 16, 10).cast("long") + LOWEST).cast("int")


def signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the sorted distinct signatures of a text column as an array of ints.

    Words are runs of letters and digits in lower case. At each anchor, and at the text's start, the
    next CHAIN content words (fewer at the end, one at least) make a signature with the anchor. A text
    without content words has one signature, of its words; one without words, of the text
    itself; an empty text has none. ``text`` must not be null.
    """
    split = df.withColumn("_w", F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    # the i-th anchor at word p has p - i content words before it
    marked = split.withColumn("_c", F.filter("_w", lambda w: ~w.isin(ANCHORS))).withColumn(
        "_p", F.filter(F.transform("_w", lambda w, i: F.when(w.isin(ANCHORS), i)), lambda p: p.isNotNull())
    )

    def chain(anchor: Column, at: Column) -> Column:
        return _code(anchor, *[F.get(F.col("_c"), at + k) for k in range(CHAIN)])

    own = F.transform("_p", lambda p, i: F.when(F.get(F.col("_c"), p - i).isNotNull(), chain(F.get(F.col("_w"), p), p - i)))
    start = (
        F.when(F.size("_c") > 0, chain(F.lit("^"), F.lit(0)))
        .when(F.size("_w") > 0, _code(F.lit("^"), F.array_join("_w", " ")))
        .when(F.length(text) > 0, _code(F.lit("^"), F.col(text)))
    )
    every = F.filter(F.concat(own, F.array(start)), lambda s: s.isNotNull())
    return marked.withColumn(out, F.array_sort(F.array_distinct(every))).drop("_w", "_c", "_p")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature arrays, 1 for two empty ones."""
    common = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(common / (F.size(a) + F.size(b) - common))


def fingerprint_of(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda s: F.lower(F.lpad(F.hex(s.cast("long") - LOWEST), 8, "0"))), ",")


def _codes_of(signature: str) -> list[Column]:
    """Two independent 64-bit hashes of a set."""
    return [F.xxhash64(signature).alias("s"), F.xxhash64(F.lit(1), signature).alias("s_other")]


def compare_documents(docs: DataFrame) -> DataFrame:
    """Fingerprint whole texts and their edited texts, and compare them.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by the first as
    many (or all) of the next document's, by descending doc_id (after the last: the first; null
    ids last; rows of one id by text). Result: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint (sorted signatures in hex, comma-joined), near_edited, near_next (likeness of
    the fingerprint to the edited text's and to the next document's), class_id (see near_duplicates). Null texts
    are empty, and empty fingerprints are alike (1). Only doc_id and text are read. Repeated rows stay; an empty
    table gives no rows.
    """
    classes = _classes(_sets(docs))
    splits = key_ranges(docs.select("doc_id"), "doc_id", ROWS_PER_RANGE, MAX_RANGES)
    ranged = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), range_of(F.col("doc_id"), splits).alias("_range")
    )
    order = Window.partitionBy("_range").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    dealt = signatures(ranged.repartition("_range"), "text", "sig")
    inside = dealt.select("*", F.lead("text").over(order).alias("_text"), F.lead("sig").over(order).alias("_sig"))
    # the first row of each range: at most MAX_RANGES ids, then as many texts
    heads = settle(ranged.groupBy("_range").agg(F.max("doc_id").alias("_id")))
    wanted = F.broadcast(heads.withColumnRenamed("_range", "_r"))
    texts = (
        ranged.join(wanted, (F.col("_range") == F.col("_r")) & F.col("doc_id").eqNullSafe(F.col("_id")))
        .groupBy("_range")
        .agg(F.min("text").alias("_head"))
    )
    top = heads.agg(F.max("_range")).first()[0]
    above = Window.orderBy("_range")  # over one row a range
    feeds = (
        heads.select("_range", F.lag("_range").over(above).alias("_from"))
        .select(F.col("_range").alias("_to"), F.coalesce("_from", F.lit(top)).alias("_from"))
    )
    first = signatures(texts.join(feeds, texts["_range"] == feeds["_from"]).select("_to", "_head"), "_head", "_head_sig")
    joined = inside.join(first, inside["_range"] == first["_to"], "left")
    half = F.floor(F.length("text") / 2).cast("int")
    following = F.coalesce("_text", "_head")
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr(following, F.lit(1), half))
    both = joined.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "sig",
        F.when(F.col("_text").isNull(), F.col("_head_sig")).otherwise(F.col("_sig")).alias("next_sig"),
        edited.alias("edited"),
    )
    both = both.select("*", *_codes_of("sig")).join(broadcast_if_small(classes), ["s", "s_other"], "left")
    return signatures(both, "edited", "edited_sig").select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint_of(F.col("sig")).alias("fingerprint"),
        fingerprint_of(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).cast("double").alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).cast("double").alias("near_next"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
    )


def _sets(docs: DataFrame) -> DataFrame:
    """(doc_id, s, s_other, sig) of each text, written out."""
    sets = signatures(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")), "text", "sig")
    return settle(sets.select("doc_id", *_codes_of("sig"), "sig"))


def _classes(sets: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The signature sets that stand for several documents, or are alike to others, with the class_id of all: (s, s_other, class_id)."""
    nodes = settle(sets.groupBy("s", "s_other").agg(F.first("sig").alias("h"), F.min("doc_id").alias("least"), F.count("*").alias("rows")))
    nodes = settle(nodes.withColumn("node", F.monotonically_increasing_id()).withColumn("n", F.size("h")))  # numbers of written rows
    top = LOWEST + int(setjoin.FIRST_SHARE * 2**32)
    part = nodes.select("node", F.explode(F.filter("h", lambda s: s < top)).alias("x"))
    held = nodes.join(setjoin.alone(part), "node", "left").where(setjoin.may_have_partner(threshold))
    profiles = settle(setjoin.profiles(settle(held.select("node", "n", "h")), threshold))
    linked = components(setjoin.links(profiles, threshold, tables=True))
    named = nodes.select("s", "s_other", "node", "least", "rows").join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = named.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("rows").alias("rows"))
    return settle(named.drop("rows").join(ids.where("rows > 1"), "root").select("s", "s_other", "class_id"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Classes of documents whose signature sets are alike: doc_id, class_id (its smallest doc_id).

    Classes are the components of all pairs of sets whose Jaccard similarity reaches the threshold. Equal sets are
    one node first. Sets are partitioned by length and meet by the signatures of their prefixes in the order of
    rarity; pairs that lengths and places rule out are not compared (see setjoin.links). Empty texts are
    alike. Null ids are left out of the minimum; a class of one document without an id has none. Repeated rows
    stay; an empty table gives no rows.
    """
    sets = _sets(docs)
    classes = _classes(sets, threshold)
    return sets.join(broadcast_if_small(classes), ["s", "s_other"], "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
