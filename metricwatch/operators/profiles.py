"""Input profiles that add up (L5, D13): per input and day, exact counters and mergeable sketches.

A day's profile is one row: number of rows, of missing ids and values, sum, least and largest value, a
HyperLogLog sketch of the ids and a KLL sketch of the values (a few kB each, whatever the day's size).
Profiles are stored by day; a window's profile is the merge of its days and reads no raw rows, and a day is
compared with the one before it the same way.

Errors: the number of distinct ids is off by about 1.04 / sqrt(2^lg) relative (0.8 % at ``LG`` 14); a quantile's
rank is off by about 1 % of the rows (KLL with ``K`` 200 to 256), both after any number of merges. Counters are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LG, K = 14, 256
QUANTILES = (0.05, 0.5, 0.95)
COUNTERS = ("rows", "missing_ids", "missing_values", "low", "high", "total")


def day_profiles(df: DataFrame, name: str, id_col: str, day: Column | str, value_col: str) -> DataFrame:
    """(input, day, counters, id_sketch, value_sketch): one row per day of an input, by one partial aggregation.

    Sums are exact decimals (28 digits, 6 of them decimals). A day without any value has NULL low, high, total and value sketch.
    """
    day = F.col(day) if isinstance(day, str) else day
    rows = df.select(F.to_date(day).alias("day"), F.col(id_col).cast("string").alias("_id"), F.col(value_col).cast("double").alias("_v"),
                     F.col(value_col).cast("decimal(28,6)").alias("_d"))
    return rows.groupBy("day").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_id").isNull()).alias("missing_ids"), F.count_if(F.col("_v").isNull()).alias("missing_values"),
        F.min("_v").alias("low"), F.max("_v").alias("high"), F.sum("_d").cast("decimal(28,6)").alias("total"),
        F.hll_sketch_agg("_id", F.lit(LG)).alias("id_sketch"), F.kll_sketch_agg_double("_v", F.lit(K)).alias("value_sketch"),
    ).select(F.lit(name).alias("input"), "day", *COUNTERS, "id_sketch", F.when(F.col("rows") > F.col("missing_values"), F.col("value_sketch")).alias("value_sketch"))


def merge_profiles(profiles: DataFrame, by: tuple[str, ...] = ("input",)) -> DataFrame:
    """Profiles of many days as one per ``by``; nothing but profiles is read."""
    return profiles.groupBy(*by).agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("days"),
        *[F.sum(c).alias(c) for c in ("rows", "missing_ids", "missing_values")], F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("total").cast("decimal(28,6)").alias("total"), F.hll_union_agg("id_sketch").alias("id_sketch"),
        F.kll_merge_agg_double("value_sketch").alias("value_sketch"))


def _quantile(sketch: str, q: float) -> Column:
    return F.when(F.col(sketch).isNotNull(), F.kll_sketch_get_quantile_double(sketch, F.lit(q)))


def estimates(profiles: DataFrame) -> DataFrame:
    """Profiles with ``ids`` (distinct ones, estimated) and the quantiles q05, q50, q95 in place of the sketches."""
    return profiles.select(*[c for c in profiles.columns if not c.endswith("_sketch")], F.hll_sketch_estimate("id_sketch").alias("ids"),
                           *[_quantile("value_sketch", q).alias(f"q{round(100 * q):02d}") for q in QUANTILES])


def profile_changes(profiles: DataFrame, least: float = 0.5, most: float = 2.0) -> DataFrame:
    """Every day of an input next to the day before: rows, ids and median as multiples of it, and what is unusual.

    ``unusual`` lists rows, ids, median (a multiple below ``least`` or above ``most``) and missing_values (some, none the day
    before). The day before is the last one with a profile; the first day has NULL multiples.
    """
    e = estimates(profiles)
    w = Window.partitionBy("input").orderBy("day")  # a row per day
    names = {"rows": "rows", "ids": "ids", "median": "q50"}
    times = {f"{n}_times": F.try_divide(F.col(c).cast("double"), F.lag(c).over(w).cast("double")) for n, c in names.items()}
    e = e.withColumns(times | {"_missed": F.lag("missing_values").over(w)})
    odd = [F.when((F.col(f"{n}_times") < least) | (F.col(f"{n}_times") > most), F.lit(n)) for n in names]
    odd.append(F.when((F.col("missing_values") > 0) & (F.col("_missed") == 0), F.lit("missing_values")))
    return e.select("input", "day", "rows", "ids", "q50", *times, F.array_compact(F.array(*odd)).alias("unusual"))
