"""Small helpers of the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricwatch.session import ensure_checkpoint_dir

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def text_of(col: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def words_of(text: Column) -> Column:
    """All words of a text as an array, in order."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there (reliable, not local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path for ``name`` in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def hex_number(col: Column, digits: int = 7) -> Column:
    """The first hex digits of the MD5 of a string as a number: the same in any SQL engine."""
    return F.conv(F.substring(F.md5(col), 1, digits), 16, 10).cast("bigint")


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that :func:`shared_path` has named, once nothing reads it any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
