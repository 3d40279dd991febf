"""Sources and sinks: tab-separated records, id lists, truth tables, results, and a view over documents."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kinweave.functions import textnorm as tn
from kinweave.sources.store import Store

RECORD = StructType([StructField(c, StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH = StructType([StructField(c, StringType()) for c in ("source1_entity_id", "matched_entity_ids")])


def read_tsv(spark: SparkSession, path: str, schema: StructType = RECORD) -> DataFrame:
    """All columns as text; empty fields stay empty texts, and words such as N/A are text."""
    return spark.read.schema(schema).csv(path, sep="\t", header=True, quote='"', escape='"').na.fill("")


def read_ids(spark: SparkSession, path: str, name: str = "entity_id") -> DataFrame:
    """A file of one id a line, without a header."""
    return spark.read.text(path).select(F.trim("value").alias(name)).where(F.col(name) != "")


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A table of one or many parts; only the wanted columns are read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def head(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows with the smallest keys; all if n is 0."""
    return df.orderBy(key).limit(n) if n > 0 else df


def explode_truth(truth: DataFrame) -> DataFrame:
    """(s1_id, cand_id) pairs from rows with comma-joined matches."""
    ids = F.filter(F.split("matched_entity_ids", ","), lambda i: F.trim(i) != "")
    return truth.select(F.col("source1_entity_id").alias("s1_id"), F.explode(ids).alias("cand_id")).select("s1_id", F.trim("cand_id").alias("cand_id"))


def normalize(records: DataFrame) -> DataFrame:
    """Add the normalized columns to records: name_n, name_s, name_t, name_nt, addr_n, addr_t, stno."""
    named = records.withColumns({"name_n": tn.norm_text(F.col("business_name")), "addr_n": tn.norm_text(F.col("business_address"))})
    return named.withColumn("name_s", tn.strip_suffixes(F.col("name_n"))).withColumns(
        {
            "name_t": tn.token_bag(F.col("name_s")),
            "name_nt": tn.token_bag(F.col("name_n")),
            "addr_t": tn.token_bag(F.col("addr_n")),
            "stno": tn.street_number(F.col("addr_n")),
        }
    )


def pool(second: DataFrame, third: DataFrame) -> DataFrame:
    return second.unionByName(third)


#: Legal suffix by remainder of the id (part of the entity view).
_VIEW_SUFFIX = {0: " Inc.", 1: " LLC", 2: "", 3: " Pvt Ltd"}


def entity_view(documents: DataFrame) -> DataFrame:
    """Three sources of business records derived from a documents table.

    Result: src (S1, S2 or S3), entity_id, country, h (of the text; equal texts are true matches),
    business_name, business_address.
    """
    t = F.split(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ")), " ")
    n = F.col("doc_id")
    suffix = F.when(n % 4 == 0, _VIEW_SUFFIX[0]).when(n % 4 == 1, _VIEW_SUFFIX[1]).when(n % 4 == 2, _VIEW_SUFFIX[2]).otherwise(_VIEW_SUFFIX[3])
    src = F.when(n % 5 == 0, "S1").when(n % 5 <= 2, "S2").otherwise("S3")
    blank = (n % 5 != 0) & (n % 17 == 0)
    return documents.select(
        src.alias("src"),
        F.concat(src, F.lit("-"), n.cast("string")).alias("entity_id"),
        F.col("lang").alias("country"),
        F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("h"),
        F.concat(F.array_join(F.slice(t, 1, 5), " "), suffix).alias("business_name"),
        F.when(blank, "").otherwise(F.concat(F.col("n_chars").cast("string"), F.lit(" "), F.array_join(F.slice(t, 6, 8), " "))).alias("business_address"),
    )


def result_lists(population: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """One row per S1 id: its pairs' cand_id, distinct, by cand_rank, comma-joined; empty if it has none."""
    first = pairs.groupBy("s1_id", "cand_id").agg(F.min("cand_rank").alias("cand_rank"))
    lists = first.groupBy("s1_id").agg(F.array_sort(F.collect_list(F.struct("cand_rank", "cand_id"))).alias("c"))
    joined = population.select(F.col("entity_id").alias("s1_id")).join(lists, "s1_id", "left")
    return joined.select(F.col("s1_id").alias("source1_entity_id"), F.coalesce(F.array_join(F.col("c")["cand_id"], ","), F.lit("")).alias(name))


def write_tsv(df: DataFrame, path: str, single: bool = False) -> None:
    """Tab-separated UTF-8 with a header and line feeds: a folder of parts, or one file if ``single``.

    Either way the parts are written in parallel; one file is then put together from them by a stream through
    the driver, in their order.
    """
    written = lambda to, header: df.write.mode("overwrite").csv(to, sep="\t", header=header, lineSep="\n", emptyValue="", quote="")
    if not single:
        written(path, True)
        return
    store = Store(df.sparkSession)
    written(f"{path}.parts", False)
    store.join(f"{path}.parts", path, "\t".join(df.columns))
    store.remove(f"{path}.parts")


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_config(spark: SparkSession, path: str, config: Mapping) -> None:
    Store(spark).write(path, json.dumps(dict(config), sort_keys=True))


def read_config(spark: SparkSession, path: str) -> dict:
    return json.loads(Store(spark).read(path))


def dataset(spark: SparkSession, root: str, split: str) -> dict[str, str]:
    """Paths of a split ("train" or "test"): s1, s2, s3 and, if it is there, truth. Files lie in ``root`` or in a folder of the split's name below."""
    store = Store(spark)
    for base in (f"{root}/{split}", root):
        if store.exists(f"{base}/{split}_source1.tsv"):
            found = {f"s{n}": f"{base}/{split}_source{n}.tsv" for n in (1, 2, 3)}
            truth = f"{base}/{split}_ground_truth.tsv"
            return found | ({"truth": truth} if store.exists(truth) else {})
    raise FileNotFoundError(f"no {split}_source1.tsv in {root} or {root}/{split}")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(number, value) of a text file's lines, or of a folder's files in the order of their names, from 0.

    Lines are numbered inside the blocks that Spark reads; the driver sees nothing, and only one row a block is ordered in one task.
    """
    meta = F.col("_metadata")
    lines = spark.read.text(path).select("value", meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("id"))
    block = ["file", "block"]
    sizes = lines.groupBy(*block).agg(F.count("*").alias("lines"))
    before = F.coalesce(F.sum("lines").over(Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy(*block).orderBy("id"))
    return lines.withColumn("k", inside).join(sizes.select(*block, before.alias("before")), block).select((F.col("before") + F.col("k") - 1).alias("number"), "value")
