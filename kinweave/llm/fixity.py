"""WARC records and a Merkle audit of their replicas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.llm.common import settle

#: Children of one tree node, as a power of two.
FAN_BITS = 6
#: Keys whose records one archive file holds, and the file of records without a key.
FILE_KEYS, NO_KEY_FILE = 1024, -(1 << 62)


def warc_record(key: Column, url: Column, body: Column) -> Column:
    """Bytes of one WARC/1.1 resource record; null columns count as empty text."""
    blank = F.lit("")
    body = F.coalesce(body.cast("string"), blank)
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:record:"),
        F.coalesce(key.cast("string"), blank),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url.cast("string"), blank),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n")).cast("binary")


def file_of(key: Column, keys: int = FILE_KEYS) -> Column:
    """The archive file of a key: files hold ranges of ``keys`` numbers, negative ones before 0."""
    return F.coalesce(F.call_function("div", key - F.pmod(key, F.lit(keys)), F.lit(keys)), F.lit(NO_KEY_FILE))


def _up(position: Column) -> Column:
    return F.shiftright(position, FAN_BITS)


def manifest(records: DataFrame, keys: int = FILE_KEYS) -> DataFrame:
    """Leaves of the trees from columns ``key`` (long) and ``record`` (binary).

    Result: key, file (a range of ``keys`` keys), position and offset in the file, length, digest (SHA-256 hex).
    Records of a file stand in the order of key, then digest; those without a key have a file of their own.
    """
    rows = records.select(
        F.col("key").cast("long").alias("key"),
        F.octet_length("record").cast("long").alias("length"),
        F.sha2("record", 256).alias("digest"),
    ).withColumn("file", file_of(F.col("key"), keys))
    order = Window.partitionBy("file").orderBy(F.col("key").asc_nulls_first(), "digest")
    return rows.select(
        "key",
        "file",
        (F.row_number().over(order) - 1).cast("long").alias("position"),
        F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
        "length",
        "digest",
    )


def _parents(nodes: DataFrame, leaf: bool) -> DataFrame:
    """Hash runs of 2^FAN_BITS neighbours of a file into one node each."""
    own = F.concat_ws(":", "offset", "length", "digest") if leaf else F.concat_ws(":", "position", "digest")
    return (
        nodes.groupBy("file", _up(F.col("position")).alias("position"))
        .agg(F.array_sort(F.collect_list(F.struct("position", own.alias("own")))).alias("c"))
        .select("file", "position", F.sha2(F.array_join(F.col("c")["own"], "\n").cast("binary"), 256).alias("digest"))
    )


def _depth(last: int) -> int:
    """Levels that bring positions up to ``last`` to 0 (and the lowest ones to -1); 1 at least."""
    return max(1, -(-last.bit_length() // FAN_BITS))


def trees(leaves: DataFrame, last_record: int, last_file: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels inside files, up to a root per file, and levels over the files, up to one root.

    The last positions of records in a file and of files fix the depths, so that copies have like shapes.
    A node gathers 2^FAN_BITS children at most.
    """
    inside = [_parents(leaves, True)]
    for _ in range(_depth(last_record) - 1):
        inside.append(_parents(inside[-1], False))
    roots = inside[-1].select(F.lit(0).cast("long").alias("file"), F.col("file").alias("position"), "digest")
    over = [_parents(roots, False)]
    for _ in range(_depth(last_file) - 1):
        over.append(_parents(over[-1], False))
    return inside, over


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes whose digests differ or that only one side has."""
    other = b.withColumnRenamed("digest", "other")
    return a.join(other, ["file", "position"], "full").where(~F.col("digest").eqNullSafe(F.col("other"))).select("file", "position")


def _children(nodes: DataFrame, bad: DataFrame) -> DataFrame:
    up = bad.withColumnRenamed("position", "up")
    return nodes.withColumn("up", _up(F.col("position"))).join(up, ["file", "up"], "left_semi").drop("up")


def mismatches(left: DataFrame, right: DataFrame) -> DataFrame:
    """(file, run) of the runs of 2^FAN_BITS records on which two manifests differ, from the roots down."""
    far = F.when(F.col("file") > NO_KEY_FILE, F.abs("file"))
    most = left.unionByName(right).agg(F.max("position").alias("p"), F.max(far).alias("f")).first()
    shape = (most["p"] or 0, most["f"] or 0)
    (in_a, over_a), (in_b, over_b) = trees(left, *shape), trees(right, *shape)
    bad = _differing(over_a[-1], over_b[-1])
    for x, y in zip(over_a[-2::-1], over_b[-2::-1], strict=True):
        bad = _differing(_children(x, bad), _children(y, bad))
    groups = bad.select(F.col("position").alias("group"))
    of_group = lambda x: x.withColumn("group", _up(F.col("file"))).join(groups, "group", "left_semi").drop("group")
    bad = _differing(of_group(in_a[-1]), of_group(in_b[-1]))
    for x, y in zip(in_a[-2::-1], in_b[-2::-1], strict=True):
        bad = _differing(_children(x, bad), _children(y, bad))
    return bad.select("file", F.col("position").alias("run"))


def audit(primary: DataFrame, replica: DataFrame, keys: int = FILE_KEYS) -> DataFrame:
    """Compare two copies of the same archive; one row per record of either copy.

    Both inputs have ``key`` and ``record``; other columns are not read. Roots are compared first; below a mismatching
    node only its children are compared, down to runs of 2^FAN_BITS records, whose records are then matched
    by key and digest. Result: key, file, offset (where the record stands in the primary; in the replica if only
    that has it), length, digest (of the primary; null if only the replica has the record), run (the mismatching
    run of the file that the tree led to; null in runs that agree), status: 'intact' (same bytes, wherever
    they stand), 'corrupt' (the key is on both sides with other bytes), 'missing' (in the replica) or 'extra'
    (only there). Repeated rows of a key are matched one by one; null keys match each other; null records have
    null length and digest and match each other. Empty copies give no rows. ``keys`` is the range of a file,
    to be chosen by how dense the keys are: a file's records are ordered in one task.
    """
    left, right = settle(manifest(primary, keys)), settle(manifest(replica, keys))
    return _compare(left, right, settle(mismatches(left, right)))


RESULT = ("key", "file", "offset", "length", "digest", "run")


def _compare(left: DataFrame, right: DataFrame, bad: DataFrame) -> DataFrame:
    on = ["file", "run"]
    parts = [x.withColumn("run", _up(F.col("position"))) for x in (left, right)]
    fine = parts[0].join(bad, on, "left_anti").withColumn("run", F.lit(None).cast("long")).select(*RESULT, F.lit("intact").alias("status"))
    twin = Window.partitionBy("file", "key", "digest").orderBy("position")
    a, b = (x.join(bad, on, "left_semi").withColumn("twin", F.row_number().over(twin)) for x in parts)
    same = ["file", "key", "digest", "twin"]
    match = lambda x, y, how: x.join(y.select(*[F.col(c).alias(f"r_{c}") for c in same]), reduce(lambda p, q: p & q, [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in same]), how)
    kept = match(a, b, "left_semi")
    lost, new = match(a, b, "left_anti"), match(b, a, "left_anti")
    number = Window.partitionBy("file", "key").orderBy("position")
    lost, new = lost.withColumn("nth", F.row_number().over(number)), new.withColumn("nth", F.row_number().over(number))
    r = new.select(*[F.col(c).alias(f"r_{c}") for c in ("file", "key", "nth", "offset", "length", "run")])
    other = lost.join(
        r,
        (F.col("file") == F.col("r_file")) & F.col("key").eqNullSafe(F.col("r_key")) & (F.col("nth") == F.col("r_nth")),
        "full",
    ).select(
        F.when(F.col("nth").isNull(), F.col("r_key")).otherwise(F.col("key")).alias("key"),
        F.coalesce("file", "r_file").alias("file"),
        F.coalesce("offset", "r_offset").alias("offset"),
        F.coalesce("length", "r_length").alias("length"),
        "digest",
        F.coalesce("run", "r_run").alias("run"),
        F.when(F.col("r_nth").isNull(), "missing").when(F.col("nth").isNull(), "extra").otherwise("corrupt").alias("status"),
    )
    return fine.unionByName(kept.select(*RESULT, F.lit("intact").alias("status"))).unionByName(other)
