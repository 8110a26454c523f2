"""Isolation forest as a model that is fitted once, stored, and scores new rows without the old ones.

A model is one row per series: its trees as arrays in heap order (node 1 is the root, node i splits
into 2i and 2i + 1): split feature, threshold and the number of sampled rows in the node. It is
bounded by ``trees`` x 2 x ``sample`` nodes, whatever the length of the series.

Fitting: the sample of a tree (at most ``sample`` rows, an array) is split level by level with
array functions, every level one projection over the nodes of that level: no shuffle, sort or
window per level, and no Python. Splits are the hashed draws of :mod:`metricwatch.operators.iforest`
(series, tree, node), so scores equal ``iforest_scores`` on the same rows.

Scoring: a row walks the arrays of its series' trees in one projection after one join on the key.

Series of at most ``sample`` rows use all of them in every tree. Longer ones draw the rows with the
least hashed draws per tree; Spark keeps the least of every map task before it shuffles, so a
series of any length sends a bounded number of rows per task. Rows with a missing feature count as
0 there; a series without rows has no model, and rows whose series has none, or one fitted on a single row, get a NULL score.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricwatch.functions.columns import hash_draw_sql, node_hash_sql, unit_draw_sql
from metricwatch.operators.iforest import EULER_GAMMA

TREE = "array<struct<feature:array<int>,threshold:array<double>,size:array<int>>>"


def _q(c: str) -> str:
    return f"`{c}`"


def _c(n: str) -> str:
    """c(n), the average path length of an unsuccessful search among n points, as SQL text."""
    return (f"(CASE WHEN {n} <= 1 THEN 0D WHEN {n} = 2 THEN 1D "
            f"ELSE 2D * (ln({n} - 1D) + {EULER_GAMMA!r}D) - 2D * ({n} - 1D) / {n} END)")


def _samples(df: DataFrame, key: list[str], order: str, features: list[str], trees: int, sample: int, seed: int) -> DataFrame:
    """(key..., n, tree, rows): the sampled rows of every tree as an array of feature arrays."""
    x = ", ".join(f"coalesce(CAST({_q(f)} AS DOUBLE), 0D)" for f in features)
    rows = df.selectExpr(*map(_q, key), f"{_q(order)} AS _order", f"array({x}) AS _x")
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    same = [f"a.{_q(k)} <=> b.{_q(k)}" for k in key]
    joined = rows.alias("a").join(counts.alias("b"), F.expr(" AND ".join(same))).selectExpr(*[f"a.{_q(k)}" for k in key], "_order", "_x", "n")
    tree = f"explode(sequence(0, {int(trees) - 1})) AS tree"
    short = joined.where(f"n <= {int(sample)}").groupBy(*key, "n").agg(F.collect_list("_x").alias("rows")).selectExpr(
        *map(_q, key), "n", "rows", tree)
    drawn = joined.where(f"n > {int(sample)}").selectExpr("*", tree).selectExpr(
        "*", f"{unit_draw_sql(str(int(seed)), *map(_q, key), 'tree', '_order', repr('s'))} AS _draw")
    least = F.row_number().over(Window.partitionBy(*key, "tree").orderBy("_draw", "_order", "_x"))
    long = (drawn.withColumn("_at", least).where(F.col("_at") <= int(sample))
            .groupBy(*key, "n", "tree").agg(F.collect_list("_x").alias("rows")))
    return short.unionByName(long)


def iforest_fit(df: DataFrame, key: list[str], order: str, features: list[str], trees: int = 100, sample: int = 256,
                seed: int = 42) -> DataFrame:
    """F8: the model of every series: key..., features, n, psi, trees (array of feature, threshold and size arrays)."""
    levels = max(1, math.ceil(math.log2(max(sample, 2))))
    keep = [*map(_q, key), "n", "tree", "_limit"]
    x = _samples(df, key, order, features, trees, sample, seed).selectExpr(
        *map(_q, key), "n", "tree", f"length(bin(CAST(greatest(least(n, {int(sample)}), 2) AS BIGINT) - 1)) AS _limit", "array(rows) AS _nodes")
    d = range(len(features))
    spread = [f"(q.mx[{i}] > q.mn[{i}])" for i in d]
    n_spread = "(" + " + ".join(f"CAST({s} AS INT)" for s in spread) + ")"
    cases, before = [], "0"
    for i in d:  # the feature is the pick-th of those that have spread in the node
        cases.append(f"WHEN {spread[i]} AND ({before}) = floor({hash_draw_sql('q.h', 1)} * {n_spread}) THEN {i}")
        before = f"{before} + CAST({spread[i]} AS INT)"
    for level in range(levels):
        done = [f"_{c}{k}" for k in range(level) for c in "fts"]
        low = ", ".join(f"array_min(transform(r, x -> x[{i}]))" for i in d)
        high = ", ".join(f"array_max(transform(r, x -> x[{i}]))" for i in d)
        name = node_hash_sql(str(int(seed)), *map(_q, key), "tree", f"{2 ** level} + p")
        x = x.selectExpr(*keep, *done, f"""transform(_nodes, (r, p) -> CASE WHEN r IS NOT NULL THEN named_struct('rows', r, 'n', size(r),
            'mn', array({low}), 'mx', array({high}), 'h', CASE WHEN size(r) > 1 AND {level} < _limit THEN {name} END) END) AS _nodes""")
        x = x.selectExpr(*keep, *done, f"""transform(_nodes, q -> CASE WHEN q IS NOT NULL THEN named_struct('rows', q.rows, 'n', q.n, 'mn', q.mn,
            'mx', q.mx, 'u', {hash_draw_sql('q.h', 9)}, 'f', CASE WHEN q.h IS NULL THEN NULL {' '.join(cases)} END) END) AS _nodes""")
        x = x.selectExpr(*keep, *done, """transform(_nodes, q -> CASE WHEN q IS NOT NULL THEN named_struct('rows', q.rows, 'n', q.n, 'f', q.f,
            't', q.mn[q.f] + q.u * (q.mx[q.f] - q.mn[q.f])) END) AS _nodes""")
        x = x.selectExpr(*keep, *done, f"transform(_nodes, q -> q.f) AS _f{level}", f"transform(_nodes, q -> q.t) AS _t{level}",
                         f"transform(_nodes, q -> q.n) AS _s{level}",
                         """flatten(transform(_nodes, q -> CASE WHEN q.f IS NULL THEN array(NULL, NULL) ELSE array(
                            filter(q.rows, x -> NOT x[q.f] > q.t), filter(q.rows, x -> x[q.f] > q.t)) END)) AS _nodes""")
    parts = range(levels)
    nodes = "CAST(pow(2, _limit + 1) AS INT) - 1"  # deeper levels are empty
    built = [f"slice(concat({', '.join(f'_f{k}' for k in parts)}, transform(_nodes, r -> CAST(NULL AS INT))), 1, {nodes}) AS feature",
             f"slice(concat({', '.join(f'_t{k}' for k in parts)}, transform(_nodes, r -> CAST(NULL AS DOUBLE))), 1, {nodes}) AS threshold",
             f"slice(concat({', '.join(f'_s{k}' for k in parts)}, transform(_nodes, r -> CASE WHEN r IS NOT NULL THEN size(r) END)), 1, {nodes}) AS size"]
    each = x.selectExpr(*map(_q, key), "n", "tree", *built)
    model = each.groupBy(*key, "n").agg(F.collect_list(F.struct("tree", "feature", "threshold", "size")).alias("trees"))
    names = ", ".join(repr(f) for f in features)
    return model.selectExpr(*map(_q, key), f"array({names}) AS features", "n", f"least(n, {int(sample)}) AS psi",
                            f"CAST(transform(array_sort(trees), t -> named_struct('feature', t.feature, 'threshold', t.threshold, 'size', t.size)) AS {TREE}) AS trees")


def iforest_score(df: DataFrame, model: DataFrame, key: list[str], features: list[str], levels: int = 8) -> DataFrame:
    """``df`` plus n, psi, mean_path and score of its rows in their series' trees.

    ``levels`` is the depth that the model was fitted to: log2 of its sample (more does no harm).
    """
    m = model.selectExpr(*[f"{_q(k)} AS `_m_{k}`" for k in key], "n", "psi", "trees AS _trees")
    on = F.expr(" AND ".join(f"{_q(k)} <=> `_m_{k}`" for k in key))
    x = ", ".join(f"coalesce(CAST({_q(f)} AS DOUBLE), 0D)" for f in features)
    rows = df.selectExpr("*", f"array({x}) AS _x").join(m, on, "left")
    walk = f"""aggregate(sequence(1, {int(levels)}), 1, (i, l) -> CASE WHEN t.feature[i - 1] IS NULL THEN i
               ELSE 2 * i + CAST(_x[t.feature[i - 1]] > t.threshold[i - 1] AS INT) END)"""
    leaves = rows.selectExpr(*map(_q, df.columns), "n", "psi",
                             f"transform(_trees, t -> named_struct('at', {walk}, 'size', t.size)) AS _leaves")
    paths = leaves.selectExpr(*map(_q, df.columns), "n", "psi", "transform(_leaves, l -> named_struct('depth', length(bin(l.at)) - 1, "
                              "'size', CAST(l.size[l.at - 1] AS DOUBLE))) AS _leaves")
    total = f"aggregate(_leaves, 0D, (s, l) -> s + l.depth + {_c('l.size')})"
    scored = paths.selectExpr(*map(_q, df.columns), "n", "psi", f"{total} / size(_leaves) AS mean_path")
    return scored.selectExpr("*", f"pow(2D, -try_divide(mean_path, {_c('CAST(psi AS DOUBLE)')})) AS score")


def iforest_credit(df: DataFrame, model: DataFrame, key: list[str], features: list[str], levels: int = 8) -> DataFrame:
    """``df`` plus ``credit``: per feature (an array in their order) how much its splits have isolated the row.

    A split on the row's path credits its feature with log2 of how many times fewer sampled rows the row's side
    has (a side without any counts as half a row); credits are summed along the path and averaged over the trees.
    """
    m = model.selectExpr(*[f"{_q(k)} AS `_m_{k}`" for k in key], "trees AS _trees")
    on = F.expr(" AND ".join(f"{_q(k)} <=> `_m_{k}`" for k in key))
    x = ", ".join(f"coalesce(CAST({_q(f)} AS DOUBLE), 0D)" for f in features)
    rows = df.selectExpr("*", f"array({x}) AS _x").join(m, on, "left")
    zero = f"array_repeat(0D, {len(features)})"
    # one step: from node a.i to the side b the row is on, whose size the credit depends on
    step = """transform(array(2 * a.i + CAST(_x[t.feature[a.i - 1]] > t.threshold[a.i - 1] AS INT)), b -> named_struct('i', b, 'c',
              transform(a.c, (v, k) -> v + CASE WHEN k = t.feature[a.i - 1] THEN log2(t.size[a.i - 1] / greatest(t.size[b - 1], 0.5D)) ELSE 0D END)))[0]"""
    walk = (f"aggregate(sequence(1, {int(levels)}), named_struct('i', 1, 'c', {zero}), (a, l) -> "
            f"CASE WHEN t.feature[a.i - 1] IS NULL THEN a ELSE {step} END).c")
    each = rows.selectExpr(*map(_q, df.columns), f"transform(_trees, t -> {walk}) AS _credits")
    total = f"aggregate(_credits, {zero}, (s, c) -> transform(s, (v, k) -> v + c[k]))"
    return each.selectExpr(*map(_q, df.columns), f"CASE WHEN _credits IS NOT NULL THEN transform({total}, v -> v / size(_credits)) END AS credit")


def with_cutoff(model: DataFrame, scored: DataFrame, key: list[str], contamination: float = 0.01,
                percentile: float | None = None) -> DataFrame:
    """The model plus ``cutoff_score``: the exact linear percentile of the scores of the rows it was fitted on."""
    q = 1.0 - contamination if percentile is None else percentile / 100.0
    cut = scored.groupBy(*[F.col(k).alias(f"_c_{k}") for k in key]).agg(F.percentile("score", F.lit(q)).alias("cutoff_score"))
    on = F.expr(" AND ".join(f"{_q(k)} <=> `_c_{k}`" for k in key))
    return model.join(cut, on, "left").drop(*[f"_c_{k}" for k in key])


def iforest_model_alerts(df: DataFrame, model: DataFrame, key: list[str], order: str, features: list[str], min_rows: int = 20,
                         params: str = "model", levels: int = 8) -> DataFrame:
    """F10-F12 on new rows: those whose score is above their series' stored ``cutoff_score``; ``df`` holds the new rows only.

    ``affected`` names all features, those first that have isolated the row the most (:func:`iforest_credit`).
    """
    scored = iforest_score(df.select(*key, order, *features), model.select(*key, "n", "psi", "trees"), key, features, levels)
    cut = model.selectExpr(*[f"{_q(k)} AS `_c_{k}`" for k in key], "cutoff_score")
    on = F.expr(" AND ".join(f"{_q(k)} <=> `_c_{k}`" for k in key))
    found = scored.join(cut, on).where((F.col("n") >= min_rows) & (F.col("score") > F.col("cutoff_score")))
    credited = iforest_credit(found, model.select(*key, "trees"), key, features, levels)
    names = ", ".join(f"named_struct('c', -credit[{i}], 'i', {i}, 'f', {f!r})" for i, f in enumerate(features))
    pairs = ", ".join(f"'{f}', CAST({_q(f)} AS DOUBLE)" for f in features)
    return credited.selectExpr(
        *map(_q, key), f"{_q(order)} AS day", "CAST(NULL AS STRING) AS metric", "'iforest' AS method", "'irregular' AS type",
        "CAST(NULL AS DOUBLE) AS value", "round(score - cutoff_score, 4) AS score", "CAST(NULL AS DOUBLE) AS relative_magnitude",
        f"transform(array_sort(array({names})), a -> a.f) AS affected", f"map({pairs}) AS context", f"'{params}' AS params")
