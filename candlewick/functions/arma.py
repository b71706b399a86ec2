"""Conditional sums of squares of ARMA models over blocks of a series.

Prediction errors are linear in the errors before a block, so a block can be read without knowing them:
it is read once for its data and once for each unit error before it. Sums over blocks then compose
exactly, whatever their size.
"""

from __future__ import annotations

from itertools import product
from math import comb

import numpy as np

# Candidates are points of a lattice: partial autocorrelations in units of UNIT, at most LIMIT units. The
# first lattice has seven points for each coefficient; the search then goes to the neighbours of the best
# point at ever finer spacings.
UNIT = 0.9 / 81
LIMIT = 88
SPACINGS = (27, 9, 3, 1)
# Costs that agree to this many digits of their logarithm tie; the point nearest to zero wins.
DIGITS = 9


def first_points(size: int) -> np.ndarray:
    """The coarse lattice."""
    return _moves(range(-3, 4), size) * SPACINGS[0]


def _moves(steps, size: int) -> np.ndarray:
    return np.array(list(product(steps, repeat=size)), dtype=np.int64).reshape(len(steps) ** size, size)


def neighbours(points: np.ndarray, spacing: int) -> np.ndarray:
    """All distinct points next to the given ones."""
    size = points.shape[1]
    if size == 0:
        return points[:1]
    near = points[:, None, :] + spacing * _moves((-1, 0, 1), size)[None]
    return np.unique(np.clip(near, -LIMIT, LIMIT).reshape(-1, size), axis=0)


def coefficients(points: np.ndarray) -> np.ndarray:
    """Coefficients of a stationary process from its partial autocorrelations (Levinson)."""
    partial = UNIT * points
    result = np.zeros(partial.shape)
    for k in range(partial.shape[-1]):
        reflection = partial[..., k : k + 1]
        previous = result[..., :k]
        result[..., :k] = previous - reflection * previous[..., ::-1]
        result[..., k] = partial[..., k]
    return result


def split(points: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Autoregressive and moving-average coefficients of points."""
    return coefficients(points[..., :p]), -coefficients(points[..., p:])


def read_blocks(
    values: np.ndarray, there: np.ndarray, active: np.ndarray, points: np.ndarray, p: int, q: int, mean: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Sums of products (block, candidate, K, K) and last errors (block, candidate, K, q) of K readings.

    `values` (block, p + time) begins with the p values before the block; `there` is 0 where a series has
    no value, `active` says which times count. Readings: the data, each unit error before the block, and
    the response to a mean of one if `mean`.
    """
    phi, theta = split(points, p)
    blocks, candidates = points.shape[:2]
    readings = 1 + q + mean
    sums = np.zeros((blocks, candidates, readings, readings))
    errors = np.zeros((blocks, candidates, readings, q))
    for j in range(q):
        errors[:, :, 1 + j, j] = 1.0
    for t in range(active.shape[1]):
        now = p + t
        new = np.zeros((blocks, candidates, readings))
        lags = slice(now - p, now)
        new[:, :, 0] = values[:, None, now] - (phi * values[:, None, lags][..., ::-1]).sum(axis=-1)
        if mean:
            new[:, :, -1] = -(there[:, None, now] - (phi * there[:, None, lags][..., ::-1]).sum(axis=-1))
        new -= (theta[:, :, None, :] * errors).sum(axis=-1)
        go = active[:, t]
        new[~go] = 0.0
        sums += new[..., :, None] * new[..., None, :]
        if q:
            shifted = np.concatenate((new[..., None], errors[..., :-1]), axis=-1)
            errors = np.where(go[:, None, None, None], shifted, errors)
    return sums, errors


def folded(parts: list[tuple[np.ndarray, np.ndarray]], mean: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sums and last errors of neighbouring blocks as those of one block.

    The errors after a block are linear in the readings before it, so the next block's sums can be written in the
    readings of the first.
    """
    sums, errors = parts[0]
    for next_sums, next_errors in parts[1:]:
        through = np.zeros(sums.shape)
        through[:, 0, 0] = 1.0
        through[:, :, 1 : 1 + errors.shape[-1]] = errors
        if mean:
            through[:, -1, -1] = 1.0
        sums = sums + through @ next_sums @ through.transpose(0, 2, 1)
        errors = through @ next_errors
    return sums, errors


def roll(
    parts: list[tuple[np.ndarray, np.ndarray]],
    before: tuple[int, float],
    tail: np.ndarray,
    points: np.ndarray,
    holdout: int,
    order: tuple[int, int, int],
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best point, its cost and the next change for each step of the holdout.

    `parts` are the blocks' sums and errors in order, `before` the number and sum of their changes, `tail`
    the closes from d + p rows before the holdout on. Step k knows all before it; with d = 0 the mean of
    what it knows is taken off.
    """
    p, d, q = order
    changes = np.diff(tail, n=d)
    phi, theta = split(points, p)
    known = changes[p:]  # the first one is the holdout's
    count, total = before
    through = np.concatenate(([0.0], np.cumsum(known[:-1])))
    centre = (total + through) / (count + np.arange(holdout)) if d == 0 else np.zeros(holdout)
    shape = (holdout, len(points))
    cost, errors = np.zeros(shape), np.zeros((*shape, q))
    for sums, last in parts:
        weights = np.concatenate((np.ones((*shape, 1)), errors), axis=-1)
        if d == 0:
            weights = np.concatenate((weights, np.broadcast_to(centre[:, None, None], (*shape, 1))), axis=-1)
        cost += np.einsum("sck,ckl,scl->sc", weights, sums, weights)
        errors = np.einsum("sck,ckq->scq", weights, last)
    best, costs, ahead = [], np.zeros(holdout), np.zeros(holdout)
    size = np.abs(points).sum(axis=1)
    keys = [points[:, i] for i in range(points.shape[1])][::-1]
    for k in range(holdout):
        # A line of the state for every step: those after k still have to read change k.
        lags = changes[k : k + p][::-1]
        base = centre[:, None] + (phi[None] * (lags - centre[:, None, None])).sum(axis=-1)
        guess = base + (theta[None] * errors).sum(axis=-1)
        with np.errstate(divide="ignore", invalid="ignore"):
            rank = np.round(np.log(np.maximum(cost[k], 1e-300)), DIGITS)
        pick = np.lexsort((*keys, size, rank))[0]
        best.append(points[pick])
        costs[k], ahead[k] = cost[k, pick], guess[k, pick]
        error = changes[p + k] - guess
        cost = cost + error**2
        if q:
            errors = np.concatenate((error[..., None], errors[..., :-1]), axis=-1)
    return np.array(best).reshape(holdout, points.shape[1]), costs, ahead


def carried(closes: np.ndarray, at: np.ndarray, d: int) -> np.ndarray:
    """What undoing `d` differences adds at rows `at`: minus the sum of (-1)^k C(d, k) y[t-k]."""
    terms = [(-1) ** (k + 1) * comb(d, k) * closes[at - k] for k in range(1, d + 1)]
    return np.sum(terms, axis=0) if terms else np.zeros(len(at))
