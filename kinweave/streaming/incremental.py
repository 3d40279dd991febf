"""Linking a stream of new pool records to a fixed S1 table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinweave.operators import blocking
from kinweave.sources.entities import normalize


def match_batch(records: DataFrame, s1_keys: DataFrame, key_df: DataFrame, caps: blocking.Caps = blocking.Caps(), k: int = 50) -> DataFrame:
    """Candidates of new pool records against S1 keys, with the frequencies of the fitted pool: s1_id, cand_id, score, cand_rank.

    Keys that the fitted pool lacks count as keys of one record.
    """
    own = blocking.keys(normalize(records))
    known = own.join(key_df, blocking.KEY, "left").withColumn("df", F.coalesce("df", F.lit(1)))
    kept = blocking.allowed(known, caps).select(*blocking.KEY, "df").distinct()
    return blocking.top_k(blocking.evidence(s1_keys, own, kept), "score", k)


def follow(stream: DataFrame, s1_keys: DataFrame, key_df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, caps: blocking.Caps = blocking.Caps(), k: int = 50) -> StreamingQuery:
    """Start a query that passes each micro-batch's candidates to ``sink`` with the batch's number."""

    def on_batch(records: DataFrame, number: int) -> None:
        sink(match_batch(records, s1_keys, key_df, caps, k), number)

    return stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).start()
