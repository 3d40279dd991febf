"""Quality scores from how well two zstandard dictionaries compress a text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinweave.llm.common import crc_of_id, settle, small_batches, text_or_empty

#: Labelled rows a class that the fit takes, and bytes of their whole texts that a dictionary is trained on, both by
#: the order of a hash of their ids: bounds of the driver's memory. A text of over a quarter of the bytes is not taken.
ROWS_PER_CLASS, BYTES_PER_CLASS = 4000, 16 << 20
#: Of those, the share whose texts fill the dictionaries; the others calibrate.
DICTIONARY_SHARE = 0.7
#: Bytes compressed at once, and bytes of a dictionary.
BLOCK, DICTIONARY = 512, 112 << 10
LEVEL = 3
#: A document is predicted good from this score on.
CUT = 0.3


@dataclass(frozen=True)
class Model:
    """Two dictionaries (None: no such rows) and the slope and intercept of the score's logit."""

    good: bytes | None
    bad: bytes | None
    slope: float
    intercept: float

    def scorer(self):
        if self.good is None or self.bad is None:
            return lambda text: 0.0
        own = [
            zstandard.ZstdCompressor(
                level=LEVEL,
                dict_data=zstandard.ZstdCompressionDict(d),
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            )
            for d in (self.good, self.bad)
        ]

        def difference(text: str) -> float:
            """Compressed size by the bad dictionary less that by the good one, a byte of text."""
            raw = text.encode("utf-8", "replace")
            gained = 0
            for lo in range(0, len(raw), BLOCK):
                block = raw[lo : lo + BLOCK]
                gained += len(own[1].compress(block)) - len(own[0].compress(block))
            return gained / max(1, len(raw))

        return difference


def _dictionary(samples: list[bytes]) -> bytes | None:
    """A trained dictionary; the samples themselves where there are too few to train one."""
    if not samples:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's calibration: slope and intercept by Newton steps on softened targets."""
    pos, neg = float(y.sum()), float(len(y) - y.sum())
    rate = (pos + 1) / (pos + neg + 2)
    w = np.array([0.0, np.log(rate / (1 - rate))])
    if not pos or not neg:
        return float(w[0]), float(w[1])
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    design = np.column_stack([x, np.ones_like(x)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -500, 500)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (target - p))
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def difference_of(text: Column, model: Model) -> Column:
    """The normalised difference of whole texts, 0 for an empty one."""

    small_batches(SparkSession.active())

    @F.pandas_udf("double")
    def difference(texts: pd.Series) -> pd.Series:
        of = model.scorer()
        return texts.map(of).astype("float64")

    return difference(text)


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_CLASS) -> Model:
    """Learn from labelled documents outside the held-out fold (CRC-32 of the id, modulo 5, is 0).

    At most ``rows`` labelled ids a class are taken, in the order of a hash; of labels that contradict each other 1
    counts, and of rows that repeat an id the least text. The whole texts of most of them, up to BYTES_PER_CLASS,
    make the dictionary of their class; the differences of the rest, whose texts no dictionary holds, calibrate
    the score. With no labels of one class the score is the smoothed share of label 1.
    """
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_of_id() % 5 != 0))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )
    order = F.xxhash64("doc_id")
    drawn = [known.where(F.col("quality") == q).orderBy(order, "doc_id").limit(rows) for q in (0, 1)]
    picked = drawn[0].unionByName(drawn[1])
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(picked), "doc_id")
    fills = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(100)) < round(100 * DICTIONARY_SHARE)
    texts = settle(texts.groupBy("doc_id", "quality").agg(F.min("text").alias("text")).withColumn("fills", fills))
    size = F.octet_length("text")
    whole = texts.where(F.col("fills") & size.between(1, BYTES_PER_CLASS // 4))
    so_far = F.sum(size).over(Window.partitionBy("quality").orderBy(order, "doc_id"))  # over at most ``rows`` rows
    filled = whole.withColumn("so_far", so_far).where(F.col("so_far") <= BYTES_PER_CLASS).select("doc_id", "quality", "text").collect()
    samples: dict[int, list[bytes]] = {0: [], 1: []}
    for row in sorted(filled, key=lambda r: r["doc_id"]):
        raw = row["text"].encode("utf-8", "replace")
        samples[row["quality"]] += [raw[lo : lo + BLOCK] for lo in range(0, len(raw), BLOCK)]
    good, bad = _dictionary(samples[1]), _dictionary(samples[0])
    draft = Model(good, bad, 0.0, 0.0)
    seen = texts.where(~F.col("fills")).select("doc_id", "quality", difference_of(F.col("text"), draft).alias("x")).collect()
    seen.sort(key=lambda r: (r["doc_id"], r["x"]))
    slope, intercept = _logistic(np.array([r["x"] for r in seen], float), np.array([r["quality"] for r in seen], float))
    return Model(good, bad, slope, intercept)


def score_of(text: Column, model: Model) -> Column:
    """Chance (0 to 1) that the text's quality label is 1."""
    return 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), difference_of(text, model) * model.slope + model.intercept))))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every whole text: doc_id, held_out, score, predicted (1 from CUT on).

    Only the text enters a score. A null or empty text has a difference of 0 and so the
    calibration's score there. Only doc_id and text are read. Repeated rows stay; an empty table gives no rows.
    """
    model = fit(docs, labels)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (crc_of_id() % 5 == 0).alias("held_out"),
        score_of(text_or_empty(), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score CUT or more, with all their columns."""
    model = fit(docs, labels)
    return docs.where(score_of(text_or_empty(), model) >= CUT)
