"""Which days of the inputs have changed since gold was stored, and gold brought up to date for those alone.

A day's fingerprint per source is its number of rows and an order-free sum of row hashes, so it tells
late, corrected, repeated and withdrawn rows, whatever the order of files. Fingerprints cost one
scan of the few columns that gold uses and a partial aggregation to one row per source and day; only
the days whose fingerprint differs from the stored one (late rows, days that a run has skipped) are joined and
aggregated again. A changed dictionary changes every day.

``by="files"`` hashes the files that a day's rows lie in (path, size, time of the last change) instead of the rows, for
inputs read from files: the scan then reads the date column alone, or no column where the tables are partitioned by that
column. A file written anew with the same rows then counts as a change.

Each fingerprint names the version of gold that it belongs to. A day whose valid version is another one (two runs at
the same time, a run that died between the two commits) is aggregated again by the next run.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwatch.functions.columns import to_day
from metricwatch.functions.plan import cut_lineage
from metricwatch.operators.gold import build_gold
from metricwatch.sources.history import as_date, manifest, read_days, write_days
from metricwatch.sources.tables import analysis_window

PRINTS = "source string, day date, rows bigint, print string, gold_version string"


def _content(df: DataFrame, cols: Iterable[str]) -> list[Column]:
    """Number of rows, and the sum of their hashes as text: the same in any order, different for repeated rows."""
    marked = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]  # xxhash64 skips nulls
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*marked).cast("decimal(38,0)")).cast("string").alias("print")]


def day_fingerprints(sources: dict[str, tuple[DataFrame, str, list[str]]], cutoff, days: int = 65, salt: str = "",
                     by: str = "rows") -> DataFrame:
    """(source, day, rows, print) of name -> (rows, date column, columns that count), for the days of the window.

    ``salt`` is added to every print: what else the result of a day rests on. ``by`` is what is hashed: ``rows`` or ``files``.
    """
    if by not in ("rows", "files"):
        raise ValueError(f"fingerprints are made of rows or files, not of {by!r}")

    def of(name: str, df: DataFrame, date: str, cols: list[str]) -> DataFrame:
        if by == "files":
            cols = ["_file", "_size", "_time"]
            df = df.select(date, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size"),
                           F.col("_metadata.file_modification_time").alias("_time"))
        rows = analysis_window(df.select(*dict.fromkeys([date, *cols])), date, cutoff, days)
        prints = rows.groupBy(to_day(F.col(date)).alias("day")).agg(*_content(rows, dict.fromkeys([date, *cols])))
        return prints.select(F.lit(name).alias("source"), "day", "rows", F.concat(F.col("print"), F.lit(salt)).alias("print"))
    return reduce(DataFrame.unionByName, [of(name, *s) for name, s in sources.items()])


def changed_days(now: DataFrame, stored: DataFrame) -> DataFrame:
    """(source, day, change): ``new`` days without a stored fingerprint, ``changed`` ones, and ``gone`` ones without rows now."""
    kept = stored.select(F.col("source").alias("_s"), F.col("day").alias("_d"), F.col("rows").alias("_r"), F.col("print").alias("_p"))
    both = now.join(kept, (F.col("source") == F.col("_s")) & (F.col("day") == F.col("_d")), "full")
    change = (F.when(F.col("_s").isNull(), F.lit("new")).when(F.col("source").isNull(), F.lit("gone"))
              .when((F.col("rows") != F.col("_r")) | (F.col("print") != F.col("_p")), F.lit("changed")))
    return (both.select(F.coalesce("source", "_s").alias("source"), F.coalesce("day", "_d").alias("day"), change.alias("change"))
            .where("change IS NOT NULL"))


def only_days(df: DataFrame, date: str, days: list[_dt.date]) -> DataFrame:
    """The rows of some days, as ranges of neighbouring days that reach the scan."""
    runs: list[list[_dt.date]] = []
    for d in sorted(days):
        if runs and d - runs[-1][1] == _dt.timedelta(days=1):
            runs[-1][1] = d
        else:
            runs.append([d, d])
    near = [to_day(F.col(date)).between(F.lit(a), F.lit(b)) for a, b in runs]
    return df.where(reduce(lambda a, b: a | b, near, F.lit(False)) if near else F.lit(False))


def refresh_gold(web_raw: DataFrame, ads_raws: list[DataFrame], dictionary_raw: DataFrame, path: str, cutoff, days: int = 65, *,
                 web_cols: tuple[str, str, str, str] = ("propertyID", "date", "TotalConversions", "TotalSessions"),
                 ads_cols: tuple[str, str, str] = ("account_id", "date", "spend_gbp"),
                 dict_cols: tuple[str, str] = ("AccountID", "domain"), fingerprints: str = "rows") -> list[_dt.date]:
    """Bring the gold table at ``path`` up to date for the window and return the days that were aggregated again.

    Gold is committed before its fingerprints, so a run that dies in between only does the days again.
    ``fingerprints`` is what tells a changed day: its ``rows`` or the ``files`` they lie in.
    """
    spark = web_raw.sparkSession
    path, last = path.rstrip("/"), as_date(spark, cutoff)
    salt = dictionary_raw.select(*dict_cols).distinct().agg(*_content(dictionary_raw, dict_cols)).head()  # one row
    sources = {"web": (web_raw, web_cols[1], list(web_cols))} | {
        f"ads{k}": (a, ads_cols[1], list(ads_cols)) for k, a in enumerate(ads_raws)}
    now = cut_lineage(day_fingerprints(sources, last, days, f":{salt['rows']}:{salt['print']}", fingerprints))
    first = last - _dt.timedelta(days=days)
    stored = read_days(spark, f"{path}/fingerprints", first, last, PRINTS)
    if "gold_version" not in stored.columns:  # written by an earlier release
        stored = stored.withColumn("gold_version", F.lit(None).cast("string"))
    stored = _with_version(stored, manifest(spark, f"{path}/gold")["days"], first, last)
    stored = stored.where(F.col("gold_version").eqNullSafe(F.col("_valid"))).select("source", "day", "rows", "print")
    todo = sorted(r[0] for r in changed_days(now, stored).select("day").distinct().collect())  # at most the window's days
    if todo:
        raw = [only_days(a, ads_cols[1], todo) for a in ads_raws]
        gold = build_gold(only_days(web_raw, web_cols[1], todo), raw, dictionary_raw, last, days, web_cols=web_cols,
                          ads_cols=ads_cols, dict_cols=dict_cols)
        valid = write_days(gold, f"{path}/gold", todo)["days"]
        write_days(_with_version(now, valid, first, last).withColumnRenamed("_valid", "gold_version"), f"{path}/fingerprints", todo)
    return todo


def _with_version(prints: DataFrame, versions: dict[str, str], first: _dt.date, last: _dt.date) -> DataFrame:
    """``prints`` plus ``_valid``: the version of gold that is valid for their day, NULL for a day without rows."""
    held = [(_dt.date.fromisoformat(d), v) for d, v in versions.items() if first.isoformat() <= d <= last.isoformat()]  # a row per day
    valid = prints.sparkSession.createDataFrame(held, "_day date, _valid string")
    return prints.join(F.broadcast(valid), F.col("day") == F.col("_day"), "left").drop("_day")


def read_gold(spark, path: str, start=None, end=None) -> DataFrame:
    """Stored gold rows of a range of days."""
    return read_days(spark, f"{path.rstrip('/')}/gold", start, end, "domain string, day date, spend bigint, leads bigint, sessions bigint")
