"""Helpers shared by the text operators: shared-folder checkpoints, key ranges, text cleanup."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ROWS_PER_RANGE = 512
MAX_RANGES = 16384


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a local folder only where that is unset and all runs in one process, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="kinweave-"))
    return sc.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage of a result by a checkpoint in the folder all executors share."""
    _shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows of a table that is sent to all executors; a longer one is joined by a shuffle.
BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """A settled table of few short columns, marked for broadcast if it has BROADCAST_ROWS or fewer."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder all executors share, for a table that later steps read."""
    return f"{_shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def key_ranges(df: DataFrame, key: str, rows: int = ROWS_PER_RANGE, most: int = MAX_RANGES) -> list[int]:
    """Split points that cut a long key into ranges of about ``rows`` rows, at most ``most`` ranges.

    The points are approximate quantiles, so gaps and clusters of keys don't make ranges uneven.
    The driver receives at most ``most`` numbers, whatever the size of the table.
    """
    n = df.count()
    parts = min(most, max(1, math.ceil(n / rows)))
    if parts == 1:
        return []
    points = [i / parts for i in range(1, parts)]
    row = df.agg(F.percentile_approx(F.col(key), points, max(10_000, 4 * parts)).alias("p")).first()
    return sorted(set(row["p"] or []))


def range_of(key: Column, splits: list[int]) -> Column:
    """Number of split points that are at most ``key`` (null: 0), by binary search over a constant array."""
    if not splits:
        return F.lit(0)
    width = 1 << (len(splits)).bit_length()
    held = F.split(F.lit(",".join(map(str, splits))), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(width.bit_length()))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda lo, step: F.when(F.get(held, lo + step - 1) <= key, lo + step).otherwise(lo),
    )


#: Rows and bytes that a Python worker receives at once, so that long texts don't fill its memory.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Keep the batches that Python workers receive small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def over_texts(docs: DataFrame, of: Callable[[], Callable[[list[str]], Sequence]], schema: str, carried: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Apply a function to whole texts (null: empty) in batches: one row a text, or several.

    ``of`` is called once a task and gives the function, which takes a list of texts and returns the columns
    of ``schema`` that follow the ``carried`` ones; after them it may return the number of the text that each
    row is of, if texts have other than one row each. Carried columns (the id as a long) never leave Arrow, so
    large numbers stay whole beside nulls.
    """
    whole = StructType.fromDDL(", ".join([*[f"{c} long" for c in carried], schema]))
    wanted = to_arrow_schema(whole)
    own = len(wanted) - len(carried)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = of()
        for batch in batches:
            made = apply(batch.column(len(carried)).to_pylist())
            kept = [batch.column(k) for k in range(len(carried))]
            if len(made) > own:
                row = pa.array(made[own], pa.int64())
                kept = [c.take(row) for c in kept]
            rest = [m if isinstance(m, pa.Array) else pa.array(m, t) for m, t in zip(made, wanted.types[len(carried) :], strict=False)]
            yield pa.RecordBatch.from_arrays([*kept, *rest], schema=wanted)

    fed = docs.select(*[F.col(c).cast("long").alias(c) for c in carried], text_or_empty().alias("text"))
    return fed.mapInArrow(run, whole)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def crc_of_id(col: str = "doc_id") -> Column:
    """CRC-32 of the decimal text of an id (null: of the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))
