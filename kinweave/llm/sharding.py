"""Weighted rendezvous hashing of record keys over shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.llm.common import key_ranges, range_of, settle

#: Rows numbered together in one task.
SLOT_ROWS = 4096


def _scores(key: Column, weights: Sequence[float]) -> Column:
    """One (cost, shard) pair per shard; the smallest cost wins.

    The cost is ``-ln(u) / weight`` with u drawn from 52 bits of an MD5 of key and shard number, so
    each shard wins a share of the keys in proportion to its weight, and a shard's costs do not
    depend on which other shards exist.
    """
    held = F.split(F.lit(",".join(repr(float(w)) for w in weights)), ",").cast("array<double>")

    def cost(shard: Column) -> Column:
        bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), shard.cast("string")).cast("binary")), 1, 13), 16, 10)
        return F.struct(
            (-F.ln((bits.cast("double") + 0.5) / float(1 << 52)) / F.get(held, shard)).alias("cost"),
            shard.alias("shard"),
        )

    return F.transform(F.sequence(F.lit(0), F.lit(len(weights) - 1)), cost)


def rendezvous(df: DataFrame, key: str, shards: int | Sequence[float], grown: float = 1.0) -> DataFrame:
    """Add ``shard`` and ``grown_shard`` (the shard with one more shard of weight ``grown``).

    ``shards`` is a count of equal shards or a list of positive weights. Only the key and the
    shards decide, so equal keys share a shard and one more shard takes rows only into itself.
    A null key counts as the empty text. An empty table gives an empty result. Columns of these
    names in the input are replaced.
    """
    weights = [1.0] * shards if isinstance(shards, int) else list(shards)
    if not weights or min([*weights, grown]) <= 0:
        raise ValueError("shards need positive weights")
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    costs = df.drop("shard", "grown_shard", "_costs").withColumn("_costs", _scores(text, [*weights, grown]))
    return (
        costs.withColumn("shard", F.array_min(F.slice("_costs", 1, len(weights)))["shard"].cast("int"))
        .withColumn("grown_shard", F.array_min("_costs")["shard"].cast("int"))
        .drop("_costs")
    )


def shard_documents(docs: DataFrame, shards: int | Sequence[float] = 40, grown: float = 1.0) -> DataFrame:
    """Give each document a shard and a gapless place in it, in the order of doc_id.

    Result: doc_id, size (UTF-8 bytes plus 16; null text: 16), text_crc32 (null text: 0), law
    'key', shard, slot, grown_shard. Under this law equal texts with different ids may part. Places
    are numbered per shard and key range, then moved by the rows of the ranges before, so no task
    numbers a whole shard; rows without an id, which share a shard, are numbered by ranges of their checksums. Rows
    of one id have the places of one run, in the order of checksum and size; a null id comes first. Only
    doc_id and text are read. Repeated rows stay; an empty table gives no rows.
    """
    crc = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long")
    splits = key_ranges(docs.select("doc_id"), "doc_id", SLOT_ROWS)
    placed = rendezvous(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
            crc.alias("text_crc32"),
            F.when(F.col("doc_id").isNull(), (F.shiftright(crc, 24) - 256).cast("int")).otherwise(range_of(F.col("doc_id"), splits)).alias("part"),
        ),
        "doc_id",
        shards,
        grown,
    )
    placed = settle(placed)  # read by the counts and by the places
    before = (
        placed.groupBy("shard", "part")
        .count()
        .withColumn(
            "before",
            F.coalesce(
                F.sum("count").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
        .drop("count")
    )
    inside = Window.partitionBy("shard", "part").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    return (
        placed.withColumn("inside", F.row_number().over(inside))
        .join(before, ["shard", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("before") + F.col("inside") - 1).cast("long").alias("slot"),
            "grown_shard",
        )
    )
