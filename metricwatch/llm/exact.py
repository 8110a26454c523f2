"""Exact duplicates by an extendible-hash index on shared files (built-in functions only).

The key of a text is a 64-bit hash; its leading bits, looked up in a directory, name its bucket. Bucket
prefixes grow a bit at a time (the directory doubles) until no bucket is over its capacity. Rows
with their texts are dealt out by the first cell of their bucket, in ranges, so a bucket and its
range of keys belong to one owner task. The owner decides what is equal: it groups the rows of a key by their
whole text, chains the texts whose keys collide, and writes the bucket's file. Every row then
finds its bucket by the directory, its chain by the key and its link of the chain by the digest of the bytes that were compared.

A text with very many copies would be a hot key of its owner. Keys are counted first (without
texts); rows of keys with more than a fixed part of all rows, of which there can be only so many, are
combined in the tasks that read them, so that the owner gets one row per text and task.

The directory is as deep as its longest bucket name, with at most 2**max_depth entries whatever the
input, so it is broadcast; a bucket still overfull at that depth keeps all its entries (a longer file, the same result).

Defined results: null counts as empty; of equal texts the row with the largest id stays (null ids
are the least); rows that repeat id and text are all marked as kept if their id is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metricwatch.llm.common import checkpoint, shared_path, text_of

#: Entries that a bucket may have before it is split, and the directory's largest depth in bits.
BUCKET_ENTRIES = 10_000
MAX_DEPTH = 18
#: Keys with over this part of all rows are combined before they go to their owner; there are fewer than its inverse.
HOT_PART = 1 / 5000


def _cell(key: Column, depth: int) -> Column:
    """The leading ``depth`` bits of a 64-bit key as a number."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("bigint")


def directory(entries: DataFrame, capacity: int = BUCKET_ENTRIES, max_depth: int = MAX_DEPTH) -> tuple[DataFrame, int]:
    """(cell, bucket) for every cell of as many leading bits as the longest bucket has, and that number of bits.

    Entries are counted under every prefix of every depth. A bucket is a prefix with at most
    ``capacity`` entries (or at the largest depth) whose half-as-long directory still was overfull.
    """
    cells = entries.groupBy(_cell(F.col("key"), max_depth).alias("cell")).agg(F.count("*").alias("n"))
    levels = cells.select("n", "cell", F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth"))
    held = levels.groupBy("depth", F.expr(f"shiftright(cell, {max_depth} - depth)").alias("prefix")).agg(F.sum("n").alias("held"))
    above = held.where(F.col("held") > capacity).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"))
    fits = held.where((F.col("held") <= capacity) | (F.col("depth") == max_depth)).withColumn("up", F.shiftright("prefix", 1))
    leaves = checkpoint(fits.where("depth > 0").join(above, ["depth", "up"], "left_semi").select("depth", "prefix").unionAll(
        fits.where("depth = 0").select("depth", "prefix")))
    depth = leaves.agg(F.coalesce(F.max("depth"), F.lit(0))).head()[0]
    name = F.concat(F.lpad(F.col("depth").cast("string"), 2, "0"), F.lit("-"), F.col("prefix").cast("string"))
    span = F.expr(f"sequence(shiftleft(prefix, {depth} - depth), shiftleft(prefix + 1, {depth} - depth) - 1)")
    return checkpoint(leaves.select(F.explode(span).alias("cell"), name.alias("bucket"))), depth


def build_index(docs: DataFrame, path: str, capacity: int = BUCKET_ENTRIES, max_depth: int = MAX_DEPTH,
                id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """Write the index of all distinct texts under ``path`` and return its directory, see :func:`directory`.

    Entries: bucket, key, link (place in the chain of its key), text_sha256, keep_id, group_size; see :func:`read_index`.
    """
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    keys = checkpoint(rows.groupBy("key").agg(F.count("*").alias("n")))
    cells, depth = directory(keys, capacity, max_depth)
    starts = F.broadcast(cells.withColumn("start", F.min("cell").over(W.partitionBy("bucket"))))  # at most 2**max_depth rows
    total = keys.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    hot = F.broadcast(keys.where(F.col("n") > max(1, total * HOT_PART)).select("key"))  # fewer than 1 / HOT_PART
    same = [F.max("id").alias("keep_id"), F.sum("n").alias("n")]
    single = rows.join(hot, "key", "left_anti").select("key", "text", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("n"))
    copies = rows.join(hot, "key", "left_semi").withColumn("n", F.lit(1)).groupBy("key", "text").agg(*same)
    routed = single.unionByName(copies).withColumn("cell", _cell(F.col("key"), depth)).join(starts, "cell").drop("cell")
    owners = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owned = routed.repartitionByRange(owners, "start")
    entries = owned.groupBy("start", "bucket", "key", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    chained = entries.select("start", "bucket", "key", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    chain = W.partitionBy("start", "bucket", "key").orderBy("text_sha256")
    chained.withColumn("link", F.row_number().over(chain)).drop("start").write.partitionBy("bucket").parquet(path)
    return cells, depth


def read_index(docs: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """The entries of the index at ``path``; ids are of the kind that ``docs`` has."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"key bigint, text_sha256 string, keep_id {kind}, group_size bigint, link int, bucket string"
    return docs.sparkSession.read.schema(schema).parquet(path)


def look_up(docs: DataFrame, index: DataFrame, cells: DataFrame, depth: int, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` that the index holds: id, keep_id, group_size, kept, text_sha256."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), F.sha2(text, 256).alias("text_sha256"))
    routed = rows.withColumn("cell", _cell(F.col("key"), depth)).join(F.broadcast(cells), "cell")  # at most 2**max_depth rows
    found = routed.join(index, ["bucket", "key", "text_sha256"])
    return found.select("id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = BUCKET_ENTRIES,
                     index_path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    path = index_path or shared_path(docs.sparkSession, "exact-index")
    cells, depth = build_index(docs, path, capacity, id_col=id_col, text_col=text_col)
    return look_up(docs, read_index(docs, path, id_col), cells, depth, id_col=id_col, text_col=text_col)
