"""Tables by day in which a run's days change all at once or not at all (A3, L8, and stored gold and models).

Layout under the table's path::

    data/version=<id>/day=<day>/*.parquet    what one run has written
    manifest/<number>.json                   one file per commit: the valid version of every day

A run stages its rows in a folder of its own and then publishes the next manifest, which names that
folder for every day the run covers, also for days without rows. Readers follow the manifest with
the largest number, so a run that dies half-way is never seen, a rerun that finds nothing empties its
day, and of two runs of a day at the same time the one that commits last is valid as a whole. A
manifest is published under a number nobody has taken (hard link on a local disk, rename without
overwriting elsewhere); a run that loses the race takes over the other's days and tries the next.

Old versions stay for readers that have begun, until :func:`drop_old_versions` removes them, and so do old manifests.
A column named ``version`` is refused, as the folders' names have it.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ATTEMPTS = 100


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, place = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, place = _file_system(spark, path)
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _publish(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """A new file with the whole text, or False if the name is taken."""
    fs, place = _file_system(spark, folder)
    fs.mkdirs(place)
    if fs.getUri().getScheme() == "file":
        local = place.toUri().getPath()
        draft = os.path.join(local, f".{uuid.uuid4().hex}")
        with open(draft, "w") as out:
            out.write(text)
        try:
            os.link(draft, os.path.join(local, name))
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
    draft = f"{folder}/.{uuid.uuid4().hex}"
    fs, place = _file_system(spark, draft)
    stream = fs.create(place, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    goal = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    if not fs.exists(goal) and fs.rename(place, goal):
        return True
    fs.delete(place, False)
    return False


def manifest(spark: SparkSession, path: str) -> dict:
    """The last commit: number (0 before the first), schema (None before the first) and days (day -> version)."""
    names = [n for n in _names(spark, f"{path}/manifest") if n.endswith(".json")]
    if not names:
        return {"number": 0, "schema": None, "days": {}}
    return json.loads(_read_text(spark, f"{path}/manifest/{names[-1]}"))


def as_date(spark: SparkSession, day: Column | str | _dt.date) -> _dt.date:
    """A day as a date; a Column is computed once."""
    if isinstance(day, Column):
        return spark.range(1).select(day.cast("date")).head()[0]
    return day if isinstance(day, _dt.date) else _dt.date.fromisoformat(str(day))


def write_days(df: DataFrame, path: str, days: Iterable | None = None, files_per_day: int | None = None,
               identity: Iterable[str] = ()) -> dict:
    """Replace ``days`` of the table by the rows of ``df`` (column ``day``) and return the new manifest.

    ``days`` are the days that this run covers, with or without rows; by default those that ``df``
    holds. Rows of other days are not written. ``files_per_day`` deals a day's rows out by the ``identity`` columns.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if "version" in [c.lower() for c in df.columns]:
        raise ValueError("a column named version would be read as the name of the version's folder")
    covered = {as_date(spark, d) for d in days} if days is not None else None
    version = uuid.uuid4().hex
    if covered is not None:
        df = df.where(F.col("day").isin(sorted(covered)))
    if files_per_day:
        ident = [c for c in identity if c in df.columns]
        df = df.repartition(F.col("day"), F.pmod(F.xxhash64(*ident), F.lit(int(files_per_day))))
    df.write.partitionBy("day").parquet(f"{path}/data/version={version}")
    held = {n.removeprefix("day=") for n in _names(spark, f"{path}/data/version={version}") if n.startswith("day=")}
    covered = held if covered is None else {d.isoformat() for d in covered}
    for _ in range(ATTEMPTS):
        now = manifest(spark, path)
        valid = {d: v for d, v in now["days"].items() if d not in covered} | dict.fromkeys(held, version)
        new = {"number": now["number"] + 1, "schema": df.schema.json(), "days": valid}
        if _publish(spark, f"{path}/manifest", f"{new['number']:012d}.json", json.dumps(new)):
            return new
        time.sleep(0.01)
    raise RuntimeError(f"no commit to {path} in {ATTEMPTS} attempts")


def read_days(spark: SparkSession, path: str, start=None, end=None, schema: str | None = None) -> DataFrame:
    """The valid rows of the days from ``start`` to ``end`` (both included); only their folders are read.

    A table without a commit is read as plain Parquet by day, as earlier releases wrote it; if there
    is nothing at all, ``schema`` (DDL) names the columns of the empty result.
    """
    path = path.rstrip("/")
    low, high = (as_date(spark, d).isoformat() if d is not None else None for d in (start, end))
    wanted = lambda d: (low is None or d >= low) and (high is None or d <= high)
    now = manifest(spark, path)
    if now["schema"] is None:
        if schema is not None and not _names(spark, path):
            return spark.createDataFrame([], schema)
        df = spark.read.parquet(path)
        return df.where(F.lit(True) if low is None else F.col("day") >= F.lit(low).cast("date")).where(
            F.lit(True) if high is None else F.col("day") <= F.lit(high).cast("date"))
    from pyspark.sql.types import StructType
    kind = StructType.fromJson(json.loads(now["schema"]))
    paths = [f"{path}/data/version={v}/day={d}" for d, v in sorted(now["days"].items()) if wanted(d)]
    if not paths:
        return spark.createDataFrame([], kind)
    rows = spark.read.schema(kind).option("basePath", f"{path}/data").parquet(*paths)
    return rows.select(*kind.names)


def drop_old_versions(spark: SparkSession, path: str, older_than_seconds: float = 86400.0) -> int:
    """Remove the folders that no day of the manifest names and that are older; returns how many.

    Younger ones may belong to a run that has not committed, or to a reader that has begun. Manifests
    before the last one go at the same age: a run that still takes one of them for the last would have to be as old.
    """
    path = path.rstrip("/")
    valid = set(manifest(spark, path)["days"].values())
    gone = 0
    for name in _names(spark, f"{path}/data"):
        fs, place = _file_system(spark, f"{path}/data/{name}")
        age = time.time() - fs.getFileStatus(place).getModificationTime() / 1000
        if name.removeprefix("version=") not in valid and age > older_than_seconds:
            gone += bool(fs.delete(place, True))
    for name in [n for n in _names(spark, f"{path}/manifest") if n.endswith(".json")][:-1]:
        fs, place = _file_system(spark, f"{path}/manifest/{name}")
        if time.time() - fs.getFileStatus(place).getModificationTime() / 1000 > older_than_seconds:
            fs.delete(place, False)
    return gone
