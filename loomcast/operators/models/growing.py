"""Regression trees of many series at once, from sums of gradient and curvature.

A task is one tree of one series. In each step the rows of every task are put in
order of (node, value) for every variable; running sums of gradient and
curvature then give the gain of every split of every node. Trees grow level by
level, or leaf by leaf from the one with the largest gain.

A forest is held as flat arrays of nodes: ``feature`` (-1 for a leaf),
``threshold`` (at most goes left), ``left``, ``right``, ``value``, ``cover`` (sum of
curvature), and ``roots``, the first node of each tree.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import factorial

import numpy as np

#: Gains that differ by less than this share are a tie.
_TIE = 1e-9
FIELDS = ("feature", "threshold", "left", "right", "value", "cover")


@dataclass(frozen=True)
class Growth:
    """When a node is split: penalty on its value, least curvature and rows of a child, depth, and leaves of a tree
    that grows leaf by leaf (0: level by level)."""

    penalty: float = 0.0
    least_curvature: float = 0.0
    least_rows: int = 1
    depth: int | None = None
    leaves: int = 0


def grow(x: np.ndarray, of: np.ndarray, g: np.ndarray, h: np.ndarray, how: Growth) -> dict[str, np.ndarray]:
    """One tree per task: arrays of task x node (``size`` used of each), and ``gain`` of each split.

    ``x`` is series x row x variable, ``of`` the series of each task, ``g`` and ``h``
    (task x row) gradient and curvature; rows without curvature
    play no part, but that a cut lies in the middle between two neighbours of either kind.
    """
    tasks, n = g.shape
    order = np.argsort(x, axis=1, kind="stable").transpose(0, 2, 1)[of]  # task x variable x place
    tree = {f: np.zeros((tasks, 2 * n + 1), np.int64 if f in ("feature", "left", "right") else float) for f in (*FIELDS, "gain")}
    tree["feature"][:] = -1
    node = np.zeros((tasks, n), np.int16 if n < 16_000 else np.int64)
    level, size = np.zeros((tasks, 2 * n + 1), np.int64), np.ones(tasks, np.int64)
    tree["cover"][:, 0] = h.sum(axis=1)
    tree["value"][:, 0] = -g.sum(axis=1) / np.maximum(tree["cover"][:, 0] + how.penalty, 1e-300)
    there = (h > 0).astype(float)
    live = np.arange(tasks)
    while len(live):
        task, split = _best_splits(x, of[live], order[live], node[live], g[live], h[live], there[live], how)
        task = live[task]
        allowed = split["gain"] > 1e-12 * np.maximum(1.0, np.abs(split["scale"]))
        if how.depth is not None:
            allowed &= level[task, split["node"]] < how.depth
        if how.leaves:
            allowed &= (size[task] + 1) // 2 < how.leaves
            ranked = np.lexsort((split["node"], -split["gain"], ~allowed, task))  # the best leaf of each task
            first = ranked[np.flatnonzero(np.diff(task[ranked], prepend=-1))]
            best = np.zeros(len(task), bool)
            best[first] = True
            allowed &= best
        task, split = task[allowed], {k: v[allowed] for k, v in split.items()}
        if not len(task):
            break
        place = np.arange(len(task)) - np.searchsorted(task, task)  # splits of one task in turn
        left = size[task] + 2 * place
        parent = split["node"]
        for name, v in (("feature", split["feature"]), ("threshold", split["threshold"]), ("left", left), ("right", left + 1), ("gain", split["gain"])):
            tree[name][task, parent] = v
        for child, side in ((left, "left"), (left + 1, "right")):
            tree["cover"][task, child] = split[f"h_{side}"]
            tree["value"][task, child] = -split[f"g_{side}"] / (split[f"h_{side}"] + how.penalty)
            level[task, child] = level[task, parent] + 1
        live, added = np.unique(task, return_counts=True)
        size[live] += 2 * added
        own = node[live].astype(np.int64)
        feature = np.take_along_axis(tree["feature"][live], own, 1)
        value = np.take_along_axis(x[of[live]], np.maximum(feature, 0)[:, :, None], 2)[:, :, 0]
        below = np.where(value <= np.take_along_axis(tree["threshold"][live], own, 1), 0, 1)
        node[live] = np.where(feature >= 0, np.take_along_axis(tree["left"][live], own, 1) + below, own)
    return tree | {"size": size, "node": node}


def _best_splits(x, of, order, node, g, h, there, how: Growth) -> tuple[np.ndarray, dict]:
    """The best split of each (task, node): tasks in rising order, and what the split is.

    Ties go to the lower place in the order of values, then to the first variable.
    """
    tasks, variables, n = order.shape
    nodes = np.take_along_axis(np.broadcast_to(node[:, None, :], order.shape), order, 2)
    row = np.take_along_axis(order, np.argsort(nodes, axis=2, kind="stable"), 2)
    at = np.sort(node, axis=1)
    begins = np.concatenate([np.ones((tasks, 1), bool), at[:, 1:] != at[:, :-1]], axis=1)
    start = np.maximum.accumulate(np.where(begins, np.arange(n), 0), axis=1)
    ends = np.concatenate([begins[:, 1:], np.ones((tasks, 1), bool)], axis=1)
    end = np.minimum.accumulate(np.where(ends, np.arange(n), n)[:, ::-1], axis=1)[:, ::-1]

    def sums(v):
        """Sum up to each place within its node, and that of the whole node."""
        run = np.cumsum(np.take_along_axis(np.broadcast_to(v[:, None, :], row.shape), row, 2), axis=2)
        run = np.concatenate([np.zeros((tasks, variables, 1)), run], axis=2)
        wide = lambda i: np.broadcast_to(i[:, None, :], row.shape)
        base = np.take_along_axis(run, wide(start), 2)
        return run[:, :, 1:] - base, np.take_along_axis(run, wide(end) + 1, 2) - base

    (gl, gt), (hl, ht), (nl, nt) = sums(g), sums(h), sums(there)
    gr, hr = gt - gl, ht - hl
    values = np.take_along_axis(x.transpose(0, 2, 1)[of], row, 2)
    changes = np.concatenate([values[:, :, 1:] > values[:, :, :-1], np.zeros((tasks, variables, 1), bool)], axis=2)
    possible = changes & ~ends[:, None, :] & (nl >= how.least_rows) & (nt - nl >= how.least_rows)
    possible &= (hl >= max(how.least_curvature, 1e-12)) & (hr >= max(how.least_curvature, 1e-12))
    part = lambda a, b: a * a / np.maximum(b + how.penalty, 1e-300)
    whole = part(gt, ht)
    gain = np.where(possible, part(gl, hl) + part(gr, hr) - whole, -np.inf)
    best = gain.max(axis=1).ravel()
    first = np.flatnonzero(begins.ravel())
    most = np.maximum.reduceat(best, first)
    enough = np.where(most > 0, most * (1 - _TIE), most)  # two ways to split the same rows differ by rounding only
    where = np.where(best >= np.repeat(enough, np.diff([*first, tasks * n])), np.arange(tasks * n), tasks * n)
    found = np.minimum.reduceat(where, first)
    task, place = found // n, found % n
    f = (gain[task, :, place] >= enough[:, None]).argmax(axis=1)
    pick = lambda a: a[task, f, place]
    lower, upper = pick(values), values[task, f, np.minimum(place + 1, n - 1)]
    with np.errstate(invalid="ignore"):
        middle = lower + (upper - lower) / 2
    return task, {
        "node": at[task, place].astype(np.int64),
        "gain": most,
        "scale": pick(whole),
        "feature": f,
        "threshold": np.where(middle < upper, middle, lower),
        **{"g_left": pick(gl), "h_left": pick(hl), "g_right": pick(gr), "h_right": pick(hr)},
    }


def flat(tree: dict[str, np.ndarray], task: int) -> dict[str, np.ndarray]:
    """The nodes of one task's tree."""
    return {f: tree[f][task, : tree["size"][task]] for f in (*FIELDS, "gain")}


def joined(trees: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Trees as one forest of flat arrays."""
    size = np.array([len(t["feature"]) for t in trees])
    roots = np.cumsum(size) - size
    out = {f: np.concatenate([t[f] for t in trees]) for f in FIELDS}
    shift = np.repeat(roots, size)
    inner = out["feature"] >= 0
    for side in ("left", "right"):
        out[side] = np.where(inner, out[side] + shift, 0)
    return out | {"roots": roots}


def forest_of(x: np.ndarray, y: np.ndarray, weight: np.ndarray, draws: np.ndarray, how: Growth) -> list[dict]:
    """Per series the mean of trees on ``draws`` (series x tree x row: how often each row counts), and importances."""
    series, trees, n = draws.shape
    h = (draws * weight[:, None, :]).reshape(series * trees, n).astype(float)
    of = np.repeat(np.arange(series), trees)
    tree = grow(x, of, -h * y[of], h, how)
    out = []
    for s in range(series):
        own = [flat(tree, s * trees + k) for k in range(trees)]
        share = np.zeros(x.shape[2])
        for t in own:
            t["value"] = t["value"] / trees
            gains = np.bincount(t["feature"][t["feature"] >= 0], t["gain"][t["feature"] >= 0], x.shape[2])
            share += gains / gains.sum() if gains.sum() > 0 else 0.0
        out.append(joined(own) | {"base": 0.0, "importance": share / share.sum() if share.sum() > 0 else share})
    return out


def boosted(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int, rate: float, how: Growth) -> list[dict]:
    """Per series a start value and trees that each fit what the earlier ones leave of a squared error."""
    series = len(x)
    base = (y * weight).sum(axis=1) / np.maximum(weight.sum(axis=1), 1e-300)
    now, of, made = np.repeat(base[:, None], y.shape[1], axis=1), np.arange(series), [[] for _ in range(series)]
    for _ in range(rounds):
        tree = grow(x, of, (now - y) * weight, weight, how)
        tree["value"] *= rate
        now = now + np.take_along_axis(tree["value"], tree["node"].astype(np.int64), 1)
        for s in range(series):
            made[s].append(flat(tree, s))
        if (tree["size"] == 1).all():
            break  # nothing is left to split
    return [joined(trees) | {"base": float(b)} for trees, b in zip(made, base, strict=True)]


def predicted(forest: dict, x: np.ndarray) -> np.ndarray:
    """The forest's value for each row of ``x``."""
    at = np.broadcast_to(forest["roots"], (len(x), len(forest["roots"])))
    while True:
        feature = forest["feature"][at]
        inner = feature >= 0
        if not inner.any():
            return forest["base"] + forest["value"][at].sum(axis=1)
        goes_left = np.take_along_axis(x, np.maximum(feature, 0), 1) <= forest["threshold"][at]
        at = np.where(inner, np.where(goes_left, forest["left"][at], forest["right"][at]), at)


def leaves(forest: dict, variables: int) -> tuple[np.ndarray, ...]:
    """Value, and per variable the bounds and the share of training weight that the leaf's path keeps, of every leaf.

    The share is the product of the children's parts of their parent's cover over
    the splits on that variable.
    """
    count = len(forest["feature"])
    low, high, share = np.full((count, variables), -np.inf), np.full((count, variables), np.inf), np.ones((count, variables))
    level = forest["roots"]
    while len(level):
        inner = level[forest["feature"][level] >= 0]
        f, cut = forest["feature"][inner], forest["threshold"][inner]
        for side in ("left", "right"):
            child = forest[side][inner]
            low[child], high[child], share[child] = low[inner], high[inner], share[inner]
            share[child, f] *= forest["cover"][child] / forest["cover"][inner]
        high[forest["left"][inner], f] = np.minimum(high[inner, f], cut)
        low[forest["right"][inner], f] = np.maximum(low[inner, f], cut)
        level = np.concatenate([forest["left"][inner], forest["right"][inner]])
    ends = forest["feature"] < 0
    return forest["value"][ends], low[ends], high[ends], share[ends]


def attributed(forest: dict, x: np.ndarray, most: int = 1 << 21) -> tuple[np.ndarray, float]:
    """Shapley value of each variable for each row, and the expected value they start from.

    A variable outside a coalition goes both ways at its splits, weighed by
    training cover. In the game of one leaf a member counts 1 or 0 as its value
    keeps to the path, another the share of its splits, so a leaf's part follows
    from the coefficients of a product of one linear factor per variable.
    """
    variables = x.shape[1]
    value, low, high, share = leaves(forest, variables)
    out = np.zeros(x.shape)
    for first in range(0, len(x), max(1, most // max(1, len(value) * variables))):
        rows = x[first : first + max(1, most // max(1, len(value) * variables))]
        keeps = ((rows[:, None, :] > low) & (rows[:, None, :] <= high)).astype(float)
        for i in range(variables):
            played = np.flatnonzero((share[:, i] < 1) & (value != 0))  # leaves whose path has a split on it
            if not len(played):
                continue
            poly = np.ones((len(rows), len(played), 1))
            for j in range(variables):
                if j != i:
                    wider = np.zeros((*poly.shape[:2], poly.shape[2] + 1))
                    wider[:, :, :-1] += poly * share[played, j][:, None]
                    wider[:, :, 1:] += poly * keeps[:, played, j][:, :, None]
                    poly = wider
            weight = [factorial(k) * factorial(variables - 1 - k) / factorial(variables) for k in range(variables)]
            part = (poly @ np.array(weight)) * (keeps[:, played, i] - share[played, i])
            out[first : first + len(rows), i] += part @ value[played]
    return out, forest["base"] + float((value * share.prod(axis=1)).sum())
