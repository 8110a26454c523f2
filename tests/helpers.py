"""Brute-force references for the tests (plain numpy/pandas, one series at a time)."""

from __future__ import annotations

import numpy as np


def classical_decompose(y: np.ndarray, period: int = 7):
    """Additive decomposition: centred moving average, ends extended by least-squares lines
    through the `period` nearest defined trend points, centred phase means."""
    y = np.asarray(y, dtype=float)
    n = len(y)
    h = period // 2
    if period % 2:
        filt = np.ones(period) / period
    else:
        filt = np.r_[0.5, np.ones(period - 1), 0.5] / period
    trend = np.full(n, np.nan)
    for i in range(h, n - h):
        trend[i] = np.dot(y[i - h:i + h + 1], filt)
    front, back = h, n - 1 - h
    fl = min(front + period, back)
    k, c = np.polyfit(np.arange(front, fl), trend[front:fl], 1)
    trend[:front] = k * np.arange(0, front) + c
    bf = max(front, back - period)
    k, c = np.polyfit(np.arange(bf, back), trend[bf:back], 1)
    trend[back + 1:] = k * np.arange(back + 1, n) + c
    det = y - trend
    pm = np.array([det[i::period].mean() for i in range(period)])
    pm -= pm.mean()
    seasonal = np.tile(pm, n // period + 1)[:n]
    return trend, seasonal, y - trend - seasonal


def mad_flags(resid: np.ndarray, k: float):
    med = np.median(resid)
    mad = max(np.median(np.abs(resid - med)) * 1.4826, 1e-6)
    return med, mad, (resid > med + k * mad) | (resid < med - k * mad)


def isolation_scores(key, rows, trees=100, sample=256, seed=42):
    """Isolation forest over one series, node by node. rows: (order text, [features]) in order; scores in that order.

    A node's two draws are the first and the next 32 bits of the md5 of seed|key|tree|node; a tree
    of a long series grows on the rows with the least draw, and every row is routed through it.
    """
    import hashlib
    import math

    def draws(*parts):
        h = hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()
        return int(h[:8], 16) / 2 ** 32, int(h[8:16], 16) / 2 ** 32

    def c(n):
        return 0.0 if n <= 1 else 1.0 if n == 2 else 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n

    n = len(rows)
    psi = min(n, sample)
    limit = (max(psi, 2) - 1).bit_length()
    paths = [[] for _ in rows]

    def grow(tree, node, depth, drawn, routed):
        spread = [(min(rows[i][1][f] for i in drawn), max(rows[i][1][f] for i in drawn), f)
                  for f in range(len(rows[0][1]))] if drawn else []
        spread = [x for x in spread if x[1] > x[0]]
        if len(drawn) <= 1 or depth >= limit or not spread:
            for i in routed:
                paths[i].append(depth + c(len(drawn)))
            return
        pick, cut = draws(seed, key, tree, node)
        low, high, f = spread[math.floor(pick * len(spread))]
        right = lambda i: rows[i][1][f] > low + cut * (high - low)
        for side in (False, True):
            grow(tree, 2 * node + side, depth + 1, [i for i in drawn if right(i) == side], [i for i in routed if right(i) == side])

    for tree in range(trees):
        order = range(n)
        if n > sample:
            order = sorted(order, key=lambda i: (draws(seed, key, tree, rows[i][0], "s")[0], i))[:sample]
        grow(tree, 1, 0, list(order), list(range(n)))
    return [2 ** (-(sum(p) / len(p)) / c(psi)) for p in paths]


def robust_loess(y, period=7, span=11, rounds=2):
    """Robust Loess decomposition, row by row: trend, seasonal, resid, weight. NaN values weigh nothing."""
    y = np.asarray(y, float)
    n, phase = len(y), np.arange(len(y)) % period
    known = ~np.isnan(y)
    rho, trend = known.astype(float), np.zeros(n)
    for done in range(rounds + 1):
        for _ in range(2):
            means = np.zeros(period)
            for p in range(period):
                at = (phase == p) & known
                w = rho[at] if rho[at].sum() > 0 else np.ones(at.sum())
                means[p] = np.average((y - trend)[at], weights=w)
            season = (means - means.mean())[phase]
            z = np.where(known, y - season, 0.0)
            fitted = np.empty(n)
            for i in range(n):
                left = max(0, min(i - span // 2, n - span))
                right = min(n - 1, left + span - 1)
                far = max(i - left, right - i) + max(0, span - n) // 2
                x = np.arange(left, right + 1) - i
                w = rho[left:right + 1] * np.maximum(0, 1 - (np.abs(x) / far) ** 3) ** 3
                if w.sum() <= 1e-12:
                    fitted[i] = z[i]
                elif np.count_nonzero(w) < 2:
                    fitted[i] = np.average(z[left:right + 1], weights=w)
                else:
                    design = np.stack([np.ones(len(x)), x], 1) * np.sqrt(w)[:, None]
                    fitted[i] = np.linalg.lstsq(design, z[left:right + 1] * np.sqrt(w), rcond=None)[0][0]
            trend = fitted
        if done < rounds:
            off = np.abs(y - trend - season)
            far = 6 * np.median(off[known])
            rho = np.where(known, 1.0 if far <= 1e-12 else np.maximum(0, 1 - (off / far) ** 2) ** 2, 0.0)
    return trend, season, y - trend - season, rho
