"""Seasonal decomposition by robust Loess (E1-E5 in the form the documents of the job name), as window plans.

value = trend + seasonal + resid, like :func:`metricwatch.operators.series.decompose`, but

* the seasonal component is the weighted mean of its phase (a periodic season), centred to 0;
* the trend is a local straight line: at every row the ``span`` nearest rows, weighted by the tricube of their distance;
* rows with a large residual lose weight (bisquare of residual / (6 x median absolute residual)) in
  a fixed number of robustness ``rounds``, so an unusual day bends neither the trend nor the season of its neighbours.

A fixed number of Window operators per round does this on the one exchange by series key; a row's
neighbours come as a frame of at most 2 x span - 1 rows. Loess passes a constant on unchanged, so the centring of
the season and the frame are taken in one operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from metricwatch.operators.series import N, POS, calendar_fill

INNER = 2  # passes between season and trend in each round, as usual


def trend_span(period: int) -> int:
    """The usual span for a periodic season: the least odd number from 1.5 periods on."""
    span = -(-3 * period // 2)
    return span + 1 - span % 2


def _local_line(frame: str, span: int) -> list[str]:
    """SQL text of three projections: weighted neighbours, their sums, and the line's value at the row."""
    left = f"greatest(0, least({POS} - {span // 2}, {N} - {span}))"
    right = f"least({N} - 1, {left} + {span - 1})"
    far = f"(greatest({POS} - {left}, {right} - {POS}) + greatest(0, {span} - {N}) div 2)"
    near = (f"transform(filter({frame}, e -> e.p BETWEEN {left} AND {right}), e -> named_struct('x', CAST(e.p - {POS} AS DOUBLE), 'z', e.z, "
            f"'w', e.w * pow(greatest(0D, 1D - pow(abs(e.p - {POS}) / {far}, 3)), 3)))")
    sums = ("aggregate(_near, named_struct('s0', 0D, 's1', 0D, 's2', 0D, 't0', 0D, 't1', 0D), (a, e) -> named_struct("
            "'s0', a.s0 + e.w, 's1', a.s1 + e.w * e.x, 's2', a.s2 + e.w * e.x * e.x, 't0', a.t0 + e.w * e.z, 't1', a.t1 + e.w * e.x * e.z))")
    square = "(_sums.s2 - _sums.s1 * _sums.s1 / _sums.s0)"
    value = (f"CASE WHEN _sums.s0 <= 1e-12 THEN _z WHEN {square} <= 1e-9 THEN _sums.t0 / _sums.s0 ELSE _sums.t0 / _sums.s0 "
             f"- _sums.s1 / _sums.s0 * (_sums.t1 - _sums.s1 * _sums.t0 / _sums.s0) / {square} END")
    return [near, sums, value]


def loess_decompose(df: DataFrame, key: list[str], order: str, value: str, period: int = 7, rounds: int = 2,
                    span: int | None = None, fill_calendar: bool = False) -> DataFrame:
    """E1-E5 by robust Loess: adds ``pos``, ``n``, ``trend``, ``seasonal``, ``resid`` and ``weight`` (the last round's, 0 to 1).

    ``rounds=0`` is plain Loess. A series with fewer than 2 x period rows gets NULL components. Rows with
    a missing value get none and weigh nothing; a phase or a neighbourhood without weight takes the plain mean, or the value itself.
    """
    if fill_calendar:
        df = calendar_fill(df, key, order, value)
    span = span or trend_span(period)
    if span % 2 == 0 or span < 3:
        raise ValueError("the span must be odd, 3 at least")
    cols = [f"`{c}`" for c in df.columns]
    ks = ", ".join(f"`{k}`" for k in key)
    by_row, phase = f"PARTITION BY {ks} ORDER BY {POS}", f"OVER (PARTITION BY {ks}, _phase)"
    whole = f"OVER ({by_row} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    x = df.selectExpr(*cols, f"CAST(row_number() OVER (PARTITION BY {ks} ORDER BY `{order}`) - 1 AS BIGINT) AS {POS}",
                      f"count(1) OVER (PARTITION BY {ks}) AS {N}", f"CAST(`{value}` AS DOUBLE) AS _y")
    kept = [*cols, POS, N, "_y", "_phase", "_rho"]
    x = x.selectExpr(*cols, POS, N, "_y", f"{POS} % {period} AS _phase", "CASE WHEN _y IS NULL THEN 0D ELSE 1D END AS _rho", "0D AS _trend")
    near, sums, line = _local_line("_frame", span)
    for done in range(rounds + 1):
        for _ in range(INNER):
            x = x.selectExpr(*kept, f"coalesce(sum(_rho * (_y - _trend)) {phase} / nullif(sum(_rho) {phase}, 0D), avg(_y - _trend) {phase}) AS _pm",
                             f"count(1) {phase} AS _pc")
            x = x.selectExpr(*kept, "_pm", "coalesce(_y - _pm, 0D) AS _z", "_pc")
            x = x.selectExpr(*kept, "_pm", "_z", f"sum(_pm / _pc) {whole} / {float(period)}D AS _mean",
                             f"collect_list(named_struct('p', {POS}, 'w', _rho, 'z', _z)) OVER ({by_row} ROWS BETWEEN {span - 1} PRECEDING "
                             f"AND {span - 1} FOLLOWING) AS _frame")
            x = x.selectExpr(*kept, "_pm", "_z", "_mean", f"{near} AS _near").selectExpr(*kept, "_pm", "_z", "_mean", f"{sums} AS _sums")
            x = x.selectExpr(*kept, "_pm - _mean AS _season", f"{line} + _mean AS _trend")
        if done < rounds:
            x = x.selectExpr(*kept, "_trend", "abs(_y - _trend - _season) AS _off")
            x = x.selectExpr(*kept, "_trend", "_off", f"6D * median(_off) OVER (PARTITION BY {ks}) AS _far")
            rho = "CASE WHEN _y IS NULL THEN 0D WHEN _far <= 1e-12 THEN 1D ELSE pow(greatest(0D, 1D - pow(_off / _far, 2)), 2) END"
            x = x.selectExpr(*[c for c in kept if c != "_rho"], "_trend", f"{rho} AS _rho")
    ok = f"{N} >= {2 * period}"
    return x.selectExpr(*cols, POS, N, f"CASE WHEN {ok} THEN _trend END AS trend", f"CASE WHEN {ok} THEN _season END AS seasonal",
                        f"CASE WHEN {ok} THEN _y - _trend - _season END AS resid", f"CASE WHEN {ok} THEN _rho END AS weight")
