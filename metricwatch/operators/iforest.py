"""Multivariate detector: isolation forest (F8-F12, D12, F14, F15) as window plans.

Method (Liu, Ting, Zhou 2008): each tree isolates rows by random axis-parallel splits; rows that
are isolated after few splits are anomalous. Here a tree is not an object but a column: every
row of a series is replicated once per tree (a bounded ``explode`` of the tree ids, not a join),
and level by level each row moves from node ``i`` to ``2i`` or ``2i + 1``. The split of a node
(feature and threshold) is a deterministic hashed draw of (seed, series, tree, node), so every row
in the node takes the same split without any coordination, and min/max of the features over
(series, tree, node) are window aggregates.

Plan shape: one hash exchange on the series key (done on the original rows, before the tree
replication), then one sort + window per level inside each partition, then a grouped average
that reuses the same partitioning. Series are bounded by the analysis window, so a partition
holds at most ``rows x trees`` rows per series.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricwatch.functions.columns import hash_draw_sql, node_hash_sql, unit_draw_sql

EULER_GAMMA = 0.5772156649015329


def avg_path_length(n: Column) -> Column:
    """c(n): average path length of an unsuccessful search in a binary search tree of n points."""
    nd = n.cast("double")
    general = F.lit(2.0) * (F.log(nd - 1.0) + F.lit(EULER_GAMMA)) - F.lit(2.0) * (nd - 1.0) / nd
    return F.when(n <= 1, F.lit(0.0)).when(n == 2, F.lit(1.0)).otherwise(general)


def standardize_columns(df: DataFrame, key: list[str], features: list[str], prefix: str = "") -> DataFrame:
    """(x - mean) / population std per series (NULL -> 0 first); a constant feature becomes 0.

    Writes ``prefix + feature``; with the default empty prefix the features are replaced.
    """
    w = Window.partitionBy(*key)
    def scaled(f: str) -> Column:
        x = F.coalesce(F.col(f).cast("double"), F.lit(0.0))
        sd = F.stddev_pop(x).over(w)
        return F.when(sd > 0, (x - F.avg(x).over(w)) / sd).otherwise(F.lit(0.0))
    return df.withColumns({prefix + f: scaled(f) for f in features})  # one select, one Window operator


def _shuffle_partitions(df: DataFrame) -> int:
    v = df.sparkSession.conf.get("spark.sql.shuffle.partitions", None)
    try:
        return int(v)
    except (TypeError, ValueError):
        return df.sparkSession.sparkContext.defaultParallelism


def iforest_scores(df: DataFrame, key: list[str], order: str, features: list[str],
                   trees: int = 100, sample: int = 256, seed: int = 42,
                   carry: list[str] | tuple[str, ...] = (), partitions: int | None = None) -> DataFrame:
    """F8 + F9: anomaly score in (0, 1] for every row of every series, higher = stranger.

    Features are doubles with NULL -> 0 (B6). Each tree is grown on ``min(n, sample)`` rows of
    its series (a hashed per-tree subsample when the series is longer), to depth
    ceil(log2(psi)); every row, sampled or not, is routed through the tree. Path length =
    depth + c(leaf size); score = 2^(-mean path / c(psi)).

    ``sample`` is the method's published parameter; with it the largest depth limit is
    ceil(log2(sample)), so that many levels are planned and a series of any length is scored.
    Rows are numbered within their series first: rows that repeat day and features keep a score each.

    ``partitions`` fixes the number of partitions of the key exchange (default: the session's
    ``spark.sql.shuffle.partitions``). The input of that exchange is small in bytes but each row
    becomes ``trees`` rows and ``levels`` windows afterwards, so letting AQE coalesce it by input
    size would put the whole forest in a handful of tasks; an exchange with an explicit count is
    left alone by AQE.

    Returns key..., order, features..., carry..., ``n``, ``psi``, ``mean_path``, ``score`` (NULL for a series of one row).
    """
    levels = max(1, math.ceil(math.log2(max(sample, 2))))
    q = lambda c: f"`{c}`"
    ks = ", ".join(q(c) for c in key)
    feats = [q(f) for f in features]
    # Expressions are SQL text (one parse per select instead of thousands of client round trips).
    draw = unit_draw_sql

    w_node = f"OVER (PARTITION BY {ks}, tree, _node)"

    base = df.select(*key, order, *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features],
                     *carry)
    # The only exchange of the plan: hash on the series key, on the un-replicated rows.
    base = base.repartition(partitions or _shuffle_partitions(df), *key)
    base = base.selectExpr("*", f"count(1) OVER (PARTITION BY {ks}) AS n")
    base = base.selectExpr("*", f"row_number() OVER (PARTITION BY {ks} ORDER BY {', '.join([q(order), *feats])}) AS _row")
    x = base.selectExpr(
        "*", f"least(n, {int(sample)}) AS psi",
        f"length(bin(CAST(greatest(least(n, {int(sample)}), 2) AS BIGINT) - 1)) AS _limit",
        f"explode(sequence(0, {int(trees) - 1})) AS tree")
    keep = [*[q(c) for c in key], q(order), *feats, *[q(c) for c in carry], "n", "_row", "psi", "_limit", "tree"]
    # rows of a series within the sample are all drawn: no hash for them
    sample_rank = (f"row_number() OVER (PARTITION BY {ks}, tree ORDER BY CASE WHEN n > {int(sample)} THEN "
                   f"{draw(str(int(seed)), *[q(c) for c in key], 'tree', q(order), repr('s'))} END, _row)")
    in_expr = f"(n <= {int(sample)} OR {sample_rank} <= {int(sample)})"
    x = x.selectExpr(*keep, f"{in_expr} AS _in",
                     "CAST(1 AS BIGINT) AS _node", "0 AS _depth", "false AS _done", "CAST(NULL AS BIGINT) AS _leaf")
    keep = keep + ["_in"]
    state = ["_node", "_depth", "_done", "_leaf"]

    spread = [f"(_mx{i} > _mn{i})" for i in range(len(features))]
    n_spread = "(" + " + ".join(f"CAST({sp} AS INT)" for sp in spread) + ")"
    stop = f"(_done OR _cnt <= 1 OR _depth >= _limit OR {n_spread} = 0)"
    # both draws of a node come from one hash: its first and its next 32 bits
    node_hash = node_hash_sql(str(int(seed)), *[q(c) for c in key], "tree", "_node")
    # the split feature is the pick-th feature that has spread in the node
    branches, before = [], "0"
    for i, f in enumerate(feats):
        branches.append(f"WHEN {spread[i]} AND ({before}) = floor(_pd * {n_spread}) THEN {f} > _mn{i} + _u * (_mx{i} - _mn{i})")
        before = f"{before} + CAST({spread[i]} AS INT)"
    right = "CASE " + " ".join(branches) + " ELSE false END"
    stats = [f"count(CASE WHEN _in THEN 1 END) {w_node} AS _cnt"]
    stats += [f"min(CASE WHEN _in THEN {f} END) {w_node} AS _mn{i}" for i, f in enumerate(feats)]
    stats += [f"max(CASE WHEN _in THEN {f} END) {w_node} AS _mx{i}" for i, f in enumerate(feats)]
    for _ in range(levels):
        # One Window operator per level: node size and per-feature min/max over the sampled rows.
        # The node's split draws depend only on (seed, series, tree, node); settled rows need none.
        x = x.selectExpr(*keep, *state, *stats, f"CASE WHEN NOT _done THEN {node_hash} END AS _h")
        x = x.selectExpr(*keep, *state, *[f"_{m}{i}" for m in ("mn", "mx") for i in range(len(feats))], "_cnt",
                         f"{hash_draw_sql('_h', 1)} AS _pd", f"{hash_draw_sql('_h', 9)} AS _u")
        x = x.selectExpr(
            *keep,
            f"CASE WHEN {stop} THEN _node ELSE _node * 2 + CAST({right} AS BIGINT) END AS _node",
            f"CASE WHEN {stop} THEN _depth ELSE _depth + 1 END AS _depth",
            f"{stop} AS _done",
            f"CASE WHEN NOT _done AND {stop} THEN _cnt ELSE _leaf END AS _leaf",
        )
    # rows still open after the last planned level take the size of the node they reached
    x = x.selectExpr(*keep, "_depth",
                     f"CASE WHEN _done THEN _leaf ELSE count(CASE WHEN _in THEN 1 END) {w_node} END AS _leaf")
    x = x.select(*[F.col(c.strip("`")) for c in keep],
                 (F.col("_depth").cast("double") + avg_path_length(F.col("_leaf"))).alias("_path"))

    scored = x.groupBy(*key, "_row").agg(*[F.first(c).alias(c) for c in (order, *features, *carry, "n", "psi")],
                                         F.avg("_path").alias("mean_path")).drop("_row")
    return scored.withColumn("score", F.pow(F.lit(2.0), -F.try_divide(F.col("mean_path"), avg_path_length(F.col("psi")))))


def iforest_alerts(df: DataFrame, key: list[str], order: str, features: list[str],
                   contamination: float = 0.01, min_rows: int = 10, latest_only: bool = False,
                   cutoff=None, percentile: float | None = None, standardize: bool = False,
                   trees: int = 100, sample: int = 256, seed: int = 42,
                   partitions: int | None = None) -> DataFrame:
    """F10-F12 (+ D12, F14, F15, B9-B11): rows whose score is strictly above the cut-off.

    Cut-off (D12) = exact linear percentile of the series' scores at 1 - contamination, or at
    ``percentile``/100 when given (F15). ``latest_only`` (DAILY) first drops rows after
    ``cutoff`` (B9), requires the series to end on ``cutoff`` (B10) and reports only that day.
    Score column: score - cut-off, 4 decimals (the negated decision value); NULL in the DAILY
    variant, as the reference reports no score there.
    """
    if latest_only:
        if cutoff is None:
            raise ValueError("latest_only needs a cutoff")
        c = cutoff if isinstance(cutoff, Column) else F.lit(
            cutoff if isinstance(cutoff, _dt.date) else _dt.date.fromisoformat(str(cutoff)))
        df = df.filter(F.col(order) <= c)
        df = df.withColumn("_last", F.max(order).over(Window.partitionBy(*key))).filter(F.col("_last") == c).drop("_last")
    raw = df.select(*key, order, *features)
    if standardize:
        z = [f"_z_{f}" for f in features]
        s = iforest_scores(standardize_columns(raw, key, features, prefix="_z_"), key, order, z, trees=trees,
                           sample=sample, seed=seed, carry=features, partitions=partitions)
    else:
        s = iforest_scores(raw, key, order, features, trees=trees, sample=sample, seed=seed,
                           partitions=partitions)
    q = 1.0 - contamination if percentile is None else percentile / 100.0
    bq = lambda c: f"`{c}`"
    ks = ", ".join(bq(c) for c in key)
    s = s.filter(F.col("n") >= F.lit(min_rows)).selectExpr(
        "*", f"percentile(score, {q!r}) OVER (PARTITION BY {ks}) AS cutoff_score",
        *([f"max({bq(order)}) OVER (PARTITION BY {ks}) AS _last"] if latest_only else []))
    if latest_only:
        s = s.filter(F.col(order) == F.col("_last"))
    s = s.filter(F.col("score") > F.col("cutoff_score"))
    score = "CAST(NULL AS DOUBLE)" if latest_only else "round(score - cutoff_score, 4)"
    param = f"Contam={contamination}" if percentile is None else f"P{percentile}"
    names = ", ".join(f"'{f}'" for f in features)
    pairs = ", ".join(f"'{f}', CAST({bq(f)} AS DOUBLE)" for f in features)
    return s.selectExpr(
        *[bq(c) for c in key], f"{bq(order)} AS day", "CAST(NULL AS STRING) AS metric", "'iforest' AS method",
        "'irregular' AS type", "CAST(NULL AS DOUBLE) AS value", f"{score} AS score",
        "CAST(NULL AS DOUBLE) AS relative_magnitude", f"array({names}) AS affected", f"map({pairs}) AS context",
        f"'{param}' AS params",
    )
