"""What has been delivered (A5): an append-only ledger of acknowledged cards, so that none is sent twice.

A card's key is made of the alert it shows (domain, day, metric, method, type), so it is the same in
every run. Right after ``send`` has said yes, the task that sent the card puts a small file named by
its key into ``<path>/day=<day>/``; the files are the ledger. Before a delivery the cards are
anti-joined with the ledger of their days, and a task looks again just before each send, so a run
that died after some cards, a task that Spark repeats, and a rerun of the day all go on where the
last one stopped. Only a card whose receiver has accepted it while its task died before the file was there is sent again.

The path is any that pyarrow's file systems reach from the executors (a shared folder, HDFS, an object store).
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricwatch.functions.plan import cut_lineage

IDENTITY = ("domain", "day", "metric", "method", "type")
ENTRY = "card_key string, attempts int"


def card_key(df: DataFrame, identity: tuple[str, ...] = IDENTITY) -> Column:
    """The key of an alert's card, the same in every run; a missing part differs from an empty one."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in identity if c in df.columns]
    return F.sha2(F.to_json(F.array(*parts)), 256)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system of a path; Hadoop writes a local one as ``file:/...``."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


def acknowledged(df: DataFrame, path: str) -> DataFrame:
    """(card_key, attempts) of the ledger's entries of the days that ``df`` holds."""
    spark = df.sparkSession
    days = [r[0] for r in df.select(F.col("day").cast("string")).distinct().collect()]  # a run delivers one day, seldom more
    system, base = _open(path)
    held = [d for d in days if system.get_file_info(f"{base}/day={d}").type == fs.FileType.Directory]
    if not held:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).json([f"{path.rstrip('/')}/day={d}" for d in held])


def deliver_once(cards: DataFrame, send: Callable[[str, float], bool], path: str, attempts: int = 3, timeout: float = 30.0,
                 backoff: float = 0.0, card_col: str = "card") -> DataFrame:
    """A5 with a memory: sends the cards that the ledger at ``path`` doesn't hold, from the executors.

    Returns all cards with card_key, ``sent`` (now or before), ``sent_before``, ``attempts_used`` (of this call) and ``last_error``.
    A card that occurs twice is sent once. As in ``deliver`` an exception of ``send`` is a failed try.
    """
    keyed = cut_lineage(cards.withColumn("card_key", card_key(cards)))
    before = acknowledged(keyed, path).select("card_key").distinct()
    todo = keyed.dropDuplicates(["card_key"]).join(before, "card_key", "left_anti").select("card_key", F.col("day").cast("string"), card_col)
    schema = T.StructType([T.StructField("card_key", T.StringType()), T.StructField("now", T.BooleanType()),
                           T.StructField("attempts_used", T.IntegerType()), T.StructField("last_error", T.StringType())])

    def one(system: fs.FileSystem, base: str, key: str, day: str, card: str) -> tuple:
        entry = f"{base}/day={day}/{key}"
        if system.get_file_info(entry).type == fs.FileType.File:  # an earlier try of this task has sent it
            return key, True, 0, None
        error = None
        for n in range(1, attempts + 1):
            try:
                if send(card, timeout):
                    system.create_dir(f"{base}/day={day}", recursive=True)
                    with system.open_output_stream(entry) as out:
                        out.write((json.dumps({"card_key": key, "attempts": n}) + "\n").encode())
                    return key, True, n, None
                error = None
            except Exception as e:  # a failed try; retried up to ``attempts``
                error = f"{type(e).__name__}: {e}"
            if backoff and n < attempts:
                time.sleep(backoff * n)
        return key, False, attempts, error

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = _open(path.rstrip("/"))
        for pdf in batches:
            yield pd.DataFrame([one(system, base, *row) for row in pdf.itertuples(index=False, name=None)],
                               columns=schema.names).astype({"attempts_used": "int32"})

    told = cut_lineage(todo.mapInPandas(run, schema))
    out = keyed.join(told, "card_key", "left")
    earlier = F.col("now").isNull()  # not asked: the ledger had it
    return out.select(*cards.columns, "card_key", F.coalesce("now", F.lit(True)).alias("sent"), earlier.alias("sent_before"),
                      F.coalesce("attempts_used", F.lit(0)).alias("attempts_used"), "last_error")
