"""Decomposition and MAD bounds of series that are longer than a task.

:func:`metricwatch.operators.series.decompose` keeps a series in one window partition, which is right for
series bounded by the analysis window. Here a series of any length is cut into blocks of a fixed
number of rows, and no step gathers more than a block:

* positions: rows are sorted in ranges, numbered inside their range, and the counts of the ranges before are added;
* moving average: a block also gets the few rows next to it (a halo of half a period on either side);
* end lines and phase means: sums per block that are added up per series;
* exact medians: counts per value range narrow the range that holds the middle rank, round by round,
  until what is left fits in a task; every round is one aggregation for all series at once.

What is known per series (a dozen numbers) comes to the rows by (series, block), so a long series is no hot key.
Results equal ``decompose`` and ``mad_bounds`` up to the order of floating sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricwatch.functions.plan import cut_lineage
from metricwatch.operators.detect import MAD_FLOOR, MAD_SCALE
from metricwatch.operators.series import N, POS

ROWS_PER_BLOCK = 100_000
#: Ranges that are counted per round, and values that a task sorts at the end.
RANGES, LEFT_OVER = 1024, 10_000


def with_positions(df: DataFrame, key: list[str], order: str, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """E7 without a window over a series: ``df`` plus pos, n and _block (pos div rows_per_block); one row per key and order."""
    parts = max(1, -(-df.count() // rows_per_block))
    # written once: ranges are drawn by sampling, and the counts must be of the same ones
    lying = cut_lineage(df.repartitionByRange(parts, *key, order).withColumn("_range", F.spark_partition_id()))
    counts = lying.groupBy(*key, "_range").agg(F.count(F.lit(1)).alias("_n"))
    by_key = Window.partitionBy(*key)  # as many rows as the series has ranges
    before = counts.select(*[F.col(k).alias(f"_k_{k}") for k in key], F.col("_range").alias("_r"), F.sum("_n").over(by_key).alias(N), (F.sum("_n").over(
        by_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"))
    local = F.row_number().over(Window.partitionBy(*key, "_range").orderBy(order)) - 1
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key]
    at = lying.withColumn("_local", local).join(before, [*same, F.col("_range") == F.col("_r")])
    pos = (F.col("_before") + F.col("_local")).cast("bigint")
    return at.select(*df.columns, pos.alias(POS), F.col(N).cast("bigint").alias(N), F.floor(pos / F.lit(rows_per_block)).alias("_block"))


def attach(rows: DataFrame, known: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` (with _block) plus the columns of ``known`` (one row per key), joined by key and block."""
    cols = [c for c in known.columns if c not in key]
    blocks = rows.select(*key, "_block").distinct()
    k = known.select(*[F.col(x).alias(f"_k_{x}") for x in key], *cols)
    of_block = blocks.join(k, [F.col(x).eqNullSafe(F.col(f"_k_{x}")) for x in key]).select(
        *[F.col(f"_k_{x}") for x in key], F.col("_block").alias("_b"), *cols)
    same = [F.col(x).eqNullSafe(F.col(f"_k_{x}")) for x in key]
    return rows.join(of_block, [*same, F.col("_block") == F.col("_b")]).select(*rows.columns, *cols)


def decompose_blocks(df: DataFrame, key: list[str], order: str, value: str, period: int = 7,
                     rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """E1-E5 like ``decompose``, in blocks: adds pos, n, trend, seasonal, resid (and _block)."""
    if rows_per_block < period:
        raise ValueError("a block holds a period at least")
    h = period // 2
    cols = df.columns
    rows = cut_lineage(with_positions(df, key, order, rows_per_block))
    y, pos, n, posd = F.col(value).cast("double"), F.col(POS), F.col(N), F.col(POS).cast("double")
    # a row is also sent to the block before or after, if it is within half a period of it
    near = [F.when(F.floor((pos + d) / F.lit(rows_per_block)) != F.col("_block"), F.floor((pos + d) / F.lit(rows_per_block))) for d in (-h, h)]
    spread = rows.withColumn("_to", F.explode(F.array_compact(F.array(F.col("_block"), *near))))
    w = Window.partitionBy(*key, "_to").orderBy(POS)
    if period % 2:
        raw = F.avg(y).over(w.rowsBetween(-h, h))
    else:
        raw = (F.sum(y).over(w.rowsBetween(-h, h)) - F.lit(0.5) * (F.lag(y, h).over(w) + F.lead(y, h).over(w))) / F.lit(float(period))
    back, ok = n - 1 - h, n >= 2 * period
    inner = F.when((pos >= h) & (pos <= back) & ok, F.col("_raw"))
    rows = spread.withColumn("_raw", raw).where(F.col("_to") == F.col("_block")).select(*cols, POS, N, "_block", inner.alias("_t"))
    rows = cut_lineage(rows)
    ft = F.when((pos >= h) & (pos < F.least(F.lit(h + period), back)), F.col("_t"))
    bt = F.when((pos >= F.greatest(F.lit(h), back - period)) & (pos < back), F.col("_t"))
    ends = rows.groupBy(*key).agg(F.regr_slope(ft, posd).alias("_fs"), F.regr_intercept(ft, posd).alias("_fi"),
                                  F.regr_slope(bt, posd).alias("_bs"), F.regr_intercept(bt, posd).alias("_bi"))
    trend = (F.when(F.col("_t").isNotNull(), F.col("_t")).when(ok & (pos < h), F.col("_fs") * posd + F.col("_fi"))
             .when(ok & (pos > back), F.col("_bs") * posd + F.col("_bi")))
    rows = cut_lineage(attach(rows, ends, key).select(*cols, POS, N, "_block", trend.alias("trend")))
    phases = rows.groupBy(*key, (pos % period).alias("_p")).agg(F.avg(y - F.col("trend")).alias("_m"))
    season = phases.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("_p", "_m"))).alias("_means"),  # a period's rows
                                      (F.sum("_m") / F.lit(float(period))).alias("_grand"))
    rows = attach(rows, season, key).withColumn("seasonal", F.col("_means")[pos % period] - F.col("_grand"))
    return rows.select(*cols, POS, N, "trend", "seasonal", (y - F.col("trend") - F.col("seasonal")).alias("resid"), "_block")


def medians(rows: DataFrame, key: list[str], value: str, left_over: int = LEFT_OVER) -> DataFrame:
    """(key..., _median): the exact median of ``value`` per key; NULLs don't count, a key without values has none.

    ``rows`` needs _block and should be a checkpointed table, as it is read once per round.
    """
    x = F.col(value).cast("double")
    rows = rows.select(*key, "_block", x.alias("_x")).where("_x is not null")
    first = rows.groupBy(*key).agg(F.count("_x").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    ranks = F.array_distinct(F.array(F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)))  # the two middle ones, from 0
    # asked: the rank within the values from _lo to _hi, which are _n
    asked = cut_lineage(first.select(*key, F.explode(ranks).alias("_rank"), F.col("_rank").alias("_at"), "_lo", "_hi", "_n"))
    found = []
    while True:
        done = asked.where((F.col("_n") <= left_over) | (F.col("_lo") == F.col("_hi")))
        found.append(done)
        asked = asked.where((F.col("_n") > left_over) & (F.col("_lo") < F.col("_hi")))
        if asked.isEmpty():
            break
        asked = cut_lineage(_narrowed(rows, asked, key))
    out = None
    for done in found:
        same = done.where(F.col("_lo") == F.col("_hi")).select(*key, "_rank", F.col("_lo").alias("_v"))
        small = attach(rows, _nested(done.where(F.col("_lo") < F.col("_hi")), key), key)
        small = small.select(*key, "_x", F.explode("_asked").alias("a")).where(F.col("_x").between(F.col("a._lo"), F.col("a._hi")))
        listed = small.groupBy(*key, F.col("a._rank").alias("_rank"), F.col("a._at").alias("_at")).agg(F.sort_array(F.collect_list("_x")).alias("_all"))
        part = same.unionByName(listed.select(*key, "_rank", F.get("_all", F.col("_at").cast("int")).alias("_v")))
        out = part if out is None else out.unionByName(part)
    return out.groupBy(*key).agg(F.avg("_v").alias("_median"))


def _nested(asked: DataFrame, key: list[str]) -> DataFrame:
    """One row per key: its ranges (at most two) as an array."""
    return asked.groupBy(*key).agg(F.collect_list(F.struct("_rank", "_at", "_lo", "_hi", "_n")).alias("_asked"))


def _narrowed(rows: DataFrame, asked: DataFrame, key: list[str]) -> DataFrame:
    """Each range narrowed to the one of its RANGES parts that holds the rank, with the least and largest value there."""
    each = attach(rows, _nested(asked, key), key).select(*key, "_x", F.explode("_asked").alias("a"))
    each = each.where(F.col("_x").between(F.col("a._lo"), F.col("a._hi")))
    part = F.least(F.floor((F.col("_x") - F.col("a._lo")) / (F.col("a._hi") - F.col("a._lo")) * RANGES), F.lit(RANGES - 1))
    counts = each.groupBy(*key, F.col("a._rank").alias("_rank"), F.col("a._at").alias("_at"), part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    upto = F.sum("_n").over(Window.partitionBy(*key, "_rank").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
    told = counts.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_n"))  # at most RANGES rows
    held = told.where((F.col("_before") <= F.col("_at")) & (F.col("_at") < F.col("_upto")))
    return held.select(*key, "_rank", (F.col("_at") - F.col("_before")).alias("_at"), "_lo", "_hi", "_n")


def bounds_blocks(df: DataFrame, key: list[str], order: str, value: str, k: float = 3.2, period: int = 7, min_rows: int = 14,
                  rows_per_block: int = ROWS_PER_BLOCK, left_over: int = LEFT_OVER) -> DataFrame:
    """Like ``scored_series``, in blocks: decomposition, resid_median, mad, lower, upper and is_outlier of every row."""
    rows = cut_lineage(decompose_blocks(df, key, order, value, period, rows_per_block).where(F.col(N) >= max(min_rows, 2 * period)))
    middle = medians(rows, key, "resid", left_over).withColumnRenamed("_median", "resid_median")
    rows = cut_lineage(attach(rows, middle, key).withColumn("_off", F.abs(F.col("resid") - F.col("resid_median"))))
    spread = medians(rows, key, "_off", left_over)
    mad: Column = F.greatest(F.col("_median") * F.lit(MAD_SCALE), F.lit(MAD_FLOOR))
    out = attach(rows, spread, key).withColumn("mad", mad)
    far = F.lit(float(k)) * F.col("mad")
    out = out.withColumns({"lower": F.col("resid_median") - far, "upper": F.col("resid_median") + far})
    flag = (F.col("resid") > F.col("upper")) | (F.col("resid") < F.col("lower"))
    return out.withColumn("is_outlier", flag).drop("_block", "_off", "_median")
