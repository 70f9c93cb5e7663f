"""Seasonal ARIMA regressions of many series at once: Kalman filter and likelihood.

The state holds a companion form of the ARMA part and the last levels that the
differences need. Levels start without knowledge (a very large variance), the
ARMA part in its stationary distribution, so the likelihood is the exact Gaussian
one of what the differences leave. A period without a value passes through the
filter without an update. Scale and regression weights are solved for inside the
likelihood; a batched quasi-Newton search finds the rest.

Arrays have one row per series; the recursion runs over time for all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Variance of a start level, in units of the scaled series, and from where on an innovation only tells a start level.
DIFFUSE, _UNKNOWN = 1e8, 1e4
#: Autoregressive and moving-average weights lie inside these bounds, where the process is stationary and invertible.
_BOUND = 0.98
_STEP, _STEPS = 1e-5, np.array([1.0, 0.4, 0.1, 0.02])


@dataclass(frozen=True)
class Shape:
    """Orders 0 or 1 of the ARIMA and of its seasonal part; ``season`` 0 stands for none."""

    order: tuple[int, int, int] = (1, 1, 1)
    seasonal: tuple[int, int, int] = (1, 1, 1)
    season: int = 12

    def without_season(self) -> Shape:
        return Shape(self.order, (0, 0, 0), 0)

    @property
    def weights(self) -> int:
        return self.order[0] + self.order[2] + self.seasonal[0] + self.seasonal[2]

    @property
    def lost(self) -> int:
        """Observations that only tell the start levels."""
        return self.order[1] + self.season * self.seasonal[1]

    def differences(self) -> list[tuple[int, float]]:
        """(lag, weight) of the past levels that a level is built on."""
        poly = np.array([1.0])
        if self.order[1]:
            poly = np.convolve(poly, [1.0, -1.0])
        if self.seasonal[1]:
            poly = np.convolve(poly, [1.0, *[0.0] * (self.season - 1), -1.0])
        return [(lag, -c) for lag, c in enumerate(poly) if lag and c]

    def polynomials(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Autoregressive weights of lags 1 to r, and moving-average weights of lags 0 to r - 1, per row of ``w``."""
        (p, _, q), (sp, _, sq), s = self.order, self.seasonal, self.season
        r = max(p + s * sp, q + s * sq + 1)
        ar, ma = np.zeros((len(w), r + 1)), np.zeros((len(w), r + 1))
        ar[:, 0] = ma[:, 0] = 1
        columns = iter(w.T)
        for poly, sign, lags in ((ar, -1, (p, s * sp)), (ma, 1, (q, s * sq))):
            for lag in filter(None, lags):
                poly[:, lag:] += sign * next(columns)[:, None] * poly[:, : r + 1 - lag].copy()
        return -ar[:, 1:], ma[:, :r]


def _stationary(ar: np.ndarray, ma: np.ndarray) -> np.ndarray:
    """Covariance of the companion state, as the sum of all past shocks' effects, doubled in each step."""
    r = ar.shape[1]
    step = np.zeros((len(ar), r, r))
    step[:, :, 0] = ar
    step[:, np.arange(r - 1), np.arange(1, r)] = 1
    total = ma[:, :, None] * ma[:, None, :]
    for _ in range(15):
        total = total + step @ total @ step.transpose(0, 2, 1)
        step = step @ step
    return total


def filtered(shape: Shape, w: np.ndarray, y: np.ndarray, seen: np.ndarray, keep: bool = False):
    """Sums of products of innovations over their variance, log variances and count; with ``keep`` the predictions.

    ``y`` is series x period x column; every column passes the same filter, as
    its gains depend on the weights ``w`` and on what is ``seen`` alone.
    """
    ar, ma = shape.polynomials(w)
    past = shape.differences()
    count, periods, columns = y.shape
    r, levels = ar.shape[1], max((lag for lag, _ in past), default=0)
    a = np.zeros((count, r + levels, columns))
    p = np.zeros((count, r + levels, r + levels))
    p[:, :r, :r] = _stationary(ar, ma)
    p[:, np.arange(r, r + levels), np.arange(r, r + levels)] = DIFFUSE
    shocks = ma[:, :, None] * ma[:, None, :]
    sums, logs, number = np.zeros((count, columns, columns)), np.zeros(count), np.zeros(count)
    predicted = np.zeros(y.shape) if keep else None

    def observed(rows):  # what the state says of the level
        return rows[:, 0] + sum(c * rows[:, r + lag - 1] for lag, c in past)

    def moved(rows, level):  # the state one period on: ARMA part, newest level, older levels
        out = np.empty_like(rows)
        out[:, :r] = ar[:, :, None] * rows[:, :1]
        out[:, : r - 1] += rows[:, 1:r]
        if levels:
            out[:, r] = level
            out[:, r + 1 :] = rows[:, r : r + levels - 1]
        return out

    for t in range(periods):
        expected = observed(a)
        if keep:
            predicted[:, t] = expected
        z = observed(p)  # covariance of the level with the state
        f = np.maximum(z[:, 0] + sum(c * z[:, r + lag - 1] for lag, c in past), 1e-12)
        now = seen[:, t]
        v = np.where(now[:, None], y[:, t] - expected, 0.0)
        told = now & (f < _UNKNOWN)
        weight = np.where(told, 1 / f, 0.0)
        sums += (v * weight[:, None])[:, :, None] * v[:, None, :]
        logs += np.where(told, np.log(f), 0.0)
        number += told
        gain = np.where(now[:, None], z / f[:, None], 0.0)
        a += gain[:, :, None] * v[:, None, :]
        p -= gain[:, :, None] * z[:, None, :]
        # a seen level is known exactly, whatever rounding leaves of its variance
        a = moved(a, np.where(now[:, None], y[:, t], observed(a)))
        half = moved(p, np.where(now[:, None], 0.0, observed(p))).transpose(0, 2, 1)
        p = moved(half, np.where(now[:, None], 0.0, observed(half)))
        p[:, :r, :r] += shocks
    return sums, logs, number, predicted


def _solved(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Regression weights of the first column on the others, and the weighted sum of squares they leave."""
    xx, xy = sums[:, 1:, 1:], sums[:, 1:, 0]
    if not xy.shape[1]:
        return xy, sums[:, 0, 0]
    beta = (np.linalg.pinv(xx, rcond=1e-9, hermitian=True) @ xy[:, :, None])[:, :, 0]
    return beta, np.maximum(sums[:, 0, 0] - (beta * xy).sum(axis=1), 0.0)


def deviance(shape: Shape, free: np.ndarray, y: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Minus twice the log likelihood per observation, but for a constant, with the best scale and regression."""
    sums, logs, number, _ = filtered(shape, _BOUND * np.tanh(free), y, seen)
    _, rest = _solved(sums)
    n = np.maximum(number, 1)
    return np.log(np.maximum(rest / n, 1e-14)) + logs / n


def searched(shape: Shape, y: np.ndarray, seen: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Weights of greatest likelihood per series, by quasi-Newton steps from the best of a few starts."""
    count, k = len(y), shape.weights
    if not k:
        return np.zeros((count, 0))
    value = lambda free, i: deviance(shape, free, y[i], seen[i])
    every = np.arange(count)
    starts = np.array([[0.0] * k, [-0.5] * k, [0.4 if i < k // 2 else -0.6 for i in range(k)], [-0.3 if i < k // 2 else 0.5 for i in range(k)]])
    tried = np.stack([value(np.broadcast_to(s, (count, k)), every) for s in starts])
    x, best = starts[tried.argmin(axis=0)].copy(), tried.min(axis=0)
    h = np.broadcast_to(np.eye(k), (count, k, k)).copy()

    def slopes(i):
        moved = x[i][:, None, :] + _STEP * np.eye(k)
        return (value(moved.reshape(-1, k), np.repeat(i, k)).reshape(-1, k) - best[i][:, None]) / _STEP

    live = every
    g = np.zeros((count, k))
    g[live] = slopes(live)
    for _ in range(rounds):
        way = -(h[live] @ g[live][:, :, None])[:, :, 0]
        uphill = (way * g[live]).sum(axis=1) >= 0
        way[uphill] = -g[live][uphill]
        way /= np.maximum(1.0, np.abs(way).max(axis=1) / 1.5)[:, None]
        ahead = x[live][:, None, :] + _STEPS[:, None] * way[:, None, :]
        found = value(np.clip(ahead, -6, 6).reshape(-1, k), np.repeat(live, len(_STEPS))).reshape(-1, len(_STEPS))
        which = found.argmin(axis=1)
        gain = best[live] - found[np.arange(len(live)), which]
        better = gain > 1e-9
        plain = (h[live] == np.eye(k)).all(axis=(1, 2))
        again = live[~better & ~plain]  # once more, straight downhill
        h[again] = np.eye(k)
        moving, which = live[better], which[better]
        new = np.clip(ahead[better][np.arange(len(moving)), which], -6, 6)
        step, old = new - x[moving], g[moving]
        x[moving], best[moving] = new, found[better][np.arange(len(moving)), which]
        g[moving] = slopes(moving)
        turn = g[moving] - old
        curve = (step * turn).sum(axis=1)
        sound = curve > 1e-10
        rho = np.where(sound, 1 / np.where(sound, curve, 1.0), 0.0)[:, None, None]
        left = np.eye(k) - rho * step[:, :, None] * turn[:, None, :]
        updated = left @ h[moving] @ left.transpose(0, 2, 1) + rho * step[:, :, None] * step[:, None, :]
        h[moving] = np.where(sound[:, None, None], updated, np.eye(k))
        live = np.concatenate([moving[gain[better] > 1e-7], again])
        if not len(live):
            break
    return _BOUND * np.tanh(x)


def fitted(shape: Shape, y: np.ndarray, x: np.ndarray, seen: np.ndarray) -> dict[str, np.ndarray]:
    """Greatest-likelihood fit of every series: weights, beta, sigma2, loglik and the path of the noise.

    ``y`` is series x period, ``x`` series x period x variable (any numbers where
    a period is not ``seen``). The path is the noise as expected from the periods
    before, and beyond the last seen period its forecast.
    """
    held = np.where(seen, y, 0.0)
    first = held[np.arange(len(y)), seen.argmax(axis=1)]
    level = np.where(seen, y - first[:, None], 0.0)
    scale = np.sqrt((level**2).sum(axis=1) / np.maximum(seen.sum(axis=1), 1))
    scale[scale == 0] = 1.0
    size = np.sqrt((np.where(seen[:, :, None], x, 0.0) ** 2).sum(axis=1))
    size[size == 0] = 1.0
    every = np.concatenate([(level / scale[:, None])[:, :, None], np.where(seen[:, :, None], x, 0.0) / size[:, None, :]], axis=2)
    w = searched(shape, every, seen)
    sums, logs, n, predicted = filtered(shape, w, every, seen, keep=True)
    beta, rest = _solved(sums)
    sigma2 = rest / np.maximum(n, 1)
    with np.errstate(divide="ignore"):
        loglik = -0.5 * (n * (np.log(2 * np.pi * sigma2) + 1) + logs) - n * np.log(scale)
    noise = predicted[:, :, 0] - (predicted[:, :, 1:] * beta[:, None, :]).sum(axis=2)
    return {
        "weights": w,
        "beta": beta * scale[:, None] / size,
        "sigma2": sigma2 * scale**2,
        "loglik": loglik,
        "n": n,
        "path": noise * scale[:, None] + first[:, None],
    }
