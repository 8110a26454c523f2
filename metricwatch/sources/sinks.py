"""Sinks: alert history (A3, L8), run report (A4), delivery of cards."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricwatch.functions.plan import cut_lineage
from metricwatch.operators.alerts import retain
from metricwatch.sources.history import read_days, write_days


def write_alerts(df: DataFrame, path: str, files_per_day: int | None = 16, days=None) -> None:
    """Alerts into a history by day (partition pruning on read).

    ``days`` are the days that this run covers (default: those that ``df`` holds). Their rows are
    replaced, also by none, and all others stay, so a repeated run of a day neither doubles it nor
    keeps what it no longer finds. The change is committed at once (:mod:`metricwatch.sources.history`).

    ``files_per_day`` bounds the number of files written into each day folder: rows are hashed on
    their identity (domain, metric, method, type) into ``files_per_day`` salts per day, each
    (day, salt) group lands in one task, so a busy day is still written by up to
    ``files_per_day`` tasks in parallel and never by one.
    """
    write_days(df, path, days, files_per_day, ("domain", "metric", "method", "type"))


def read_alerts(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Read the history back for a day range; only the folders of those days are read."""
    return read_days(spark, path, start, end)


def retain_history(spark: SparkSession, path: str, out_path: str, cutoff, days: int = 30) -> None:
    """A6 on a stored history: write the retained window to ``out_path`` (a new folder)."""
    write_days(retain(read_days(spark, path), cutoff, days), out_path)


def write_report(report: DataFrame, path: str, mode: str = "append") -> None:
    """A4: the one-row run report as JSON lines."""
    report.coalesce(1).write.mode(mode).json(path)


def deliver(cards: DataFrame, send: Callable[[str, float], bool], attempts: int = 3,
            timeout: float = 30.0, backoff: float = 0.0, card_col: str = "card") -> DataFrame:
    """A5: send every card with ``send(card_json, timeout) -> bool`` from the executors.

    ``mapInPandas`` runs the sends partition by partition (no driver loop, no collect); each card
    is tried up to ``attempts`` times, an exception counts as a failed try. Adds ``sent`` (bool),
    ``attempts_used`` (int) and ``last_error`` (text of the last exception, if any). The sends run
    once, in this call: the result is checkpointed, so looking at it again sends nothing. Only a
    task that Spark itself repeats sends its cards again. Summarize with :func:`delivery_summary`.
    """
    schema = T.StructType([*cards.schema.fields, T.StructField("sent", T.BooleanType()),
                           T.StructField("attempts_used", T.IntegerType()),
                           T.StructField("last_error", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sent, used, errors = [], [], []
            for card in pdf[card_col].tolist():
                ok, n, error = False, 0, None
                while not ok and n < attempts:
                    n += 1
                    try:
                        ok = bool(send(card, timeout))
                    except Exception as e:  # a failed try; retried up to ``attempts``
                        ok, error = False, f"{type(e).__name__}: {e}"
                    if not ok and backoff and n < attempts:
                        time.sleep(backoff * n)
                sent.append(ok)
                used.append(n)
                errors.append(error)
            out = pdf.copy()
            out["sent"] = sent
            out["attempts_used"] = pd.Series(used, dtype="int32")
            out["last_error"] = errors
            yield out

    return cut_lineage(cards.mapInPandas(run, schema))


def delivery_summary(delivered: DataFrame) -> DataFrame:
    """One row, sent and total."""
    return delivered.agg(F.count_if(F.col("sent")).cast("bigint").alias("sent"),
                         F.count(F.lit(1)).cast("bigint").alias("total"))
