"""Precision, recall and F1 of alerts against labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricwatch.functions.plan import cut_lineage


def evaluate(alerts: DataFrame, labels: DataFrame, key: list[str] | None = None) -> DataFrame:
    """One row: tp, fp, fn, precision, recall, f1.

    ``labels`` has the key columns and ``is_anomaly``. Alerts and positive labels are reduced to
    distinct keys and full-outer-joined on (domain, day, metric) with NULL-safe equality, so a
    multivariate alert (metric NULL) matches a label for the whole day (metric NULL); the counts
    come from one aggregation. Ratios are NULL when their denominator is 0.
    """
    key = key or ["domain", "day", "metric"]
    a = alerts.select(*key).distinct().withColumn("_a", F.lit(True))
    lab = labels.filter(F.col("is_anomaly")).select(*[F.col(c).alias(f"_l_{c}") for c in key]).distinct() \
        .withColumn("_l", F.lit(True))
    cond = None
    for c in key:
        e = a[c].eqNullSafe(lab[f"_l_{c}"])
        cond = e if cond is None else cond & e
    j = a.join(lab, cond, "full")
    c = j.agg(
        F.count_if(F.col("_a") & F.col("_l")).cast("bigint").alias("tp"),
        F.count_if(F.col("_a") & F.col("_l").isNull()).cast("bigint").alias("fp"),
        F.count_if(F.col("_a").isNull() & F.col("_l")).cast("bigint").alias("fn"),
    )
    p = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))
    r = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double"))
    c = c.withColumn("precision", p).withColumn("recall", r)
    f1 = F.try_divide(F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return c.withColumn("f1", f1)


def precision_recall_curve(scored: DataFrame, score: str = "score", label: str = "is_anomaly") -> DataFrame:
    """L6 over all thresholds: per distinct score, highest first, what a cut at it (score >= threshold) would give.

    threshold, anomalies (at that very score), alerts, tp, fp, fn, precision, recall. Rows of one score are counted together, rows without a score
    only as missed anomalies. The order is global without a sort in one task: scores are dealt out in
    ranges, summed up inside each, and the counts of the ranges above are added (one row per range).
    """
    rows = scored.select(F.col(score).cast("double").alias("threshold"), F.coalesce(F.col(label), F.lit(False)).alias("_l"))
    each = rows.groupBy("threshold").agg(F.count(F.lit(1)).alias("_n"), F.count_if("_l").alias("_tp"))
    lying = cut_lineage(each.repartitionByRange(F.col("threshold").desc()).withColumn("_range", F.spark_partition_id()))
    counts = lying.where("threshold IS NOT NULL").groupBy("_range").agg(F.sum("_n").alias("_rn"), F.sum("_tp").alias("_rtp"))
    whole = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    above = counts.select("_range", F.coalesce(F.sum("_rn").over(whole), F.lit(0)).alias("_an"), F.coalesce(F.sum("_rtp").over(whole), F.lit(0)).alias("_atp"))
    total = lying.agg(F.coalesce(F.sum("_tp"), F.lit(0))).head()[0]
    upto = Window.partitionBy("_range").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    cut = lying.where("threshold IS NOT NULL").join(above, "_range").select(
        "threshold", F.col("_tp").alias("anomalies"), (F.sum("_n").over(upto) + F.col("_an")).alias("alerts"), (F.sum("_tp").over(upto) + F.col("_atp")).alias("tp"))
    tp, alerts = F.col("tp").cast("double"), F.col("alerts").cast("double")
    return cut.select("threshold", "anomalies", F.col("alerts").cast("bigint").alias("alerts"), F.col("tp").cast("bigint").alias("tp"),
                      (F.col("alerts") - F.col("tp")).cast("bigint").alias("fp"), (F.lit(total) - F.col("tp")).cast("bigint").alias("fn"),
                      (tp / alerts).alias("precision"), F.try_divide(tp, F.lit(float(total))).alias("recall"))


def average_precision(curve: DataFrame) -> DataFrame:
    """One row: the mean of the precision over the anomalies, each taken at its own score (missed ones count 0)."""
    return curve.agg(F.try_divide(F.sum(F.col("precision") * F.col("anomalies")), F.max(F.col("tp") + F.col("fn"))).alias("average_precision"))


def threshold_for(curve: DataFrame, precision: float) -> DataFrame:
    """One row: the lowest threshold whose precision is at least ``precision``, with its recall; NULLs if there is none."""
    best = F.max_by(F.struct("threshold", "precision", "recall"), "alerts")
    return curve.where(F.col("precision") >= precision).agg(best.alias("b")).select("b.*")
