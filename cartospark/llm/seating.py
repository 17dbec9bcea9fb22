"""Draws of the Pitman-Yor sampler, each a function of a 64-bit key: the same on any machine, in any order.

Tables of a dish.  Given an auxiliary variable x ~ Gamma(strength / discount + tables of the restaurant), the tables
of its dishes are independent of one another: a dish with c customers and base probability g has t tables with a
probability proportional to ``y**t * S(c, t)``, y = discount * x * g, S being the generalised Stirling numbers.
Up to EXACT customers this is drawn from the weights themselves.  Beyond, t is the number of blocks of a Poisson
number of blocks with total size c, and its mean and variance come from the saddle point z of
``y * z * (1 - z)**(discount - 1) = c``: a binomial of that mean and variance, plus one, is drawn by inversion on
steps of at most an eighth of its standard deviation.
"""

from __future__ import annotations

import numpy as np

from . import kernels as K

#: Customers up to which tables are drawn from exact weights.
EXACT = 64
_NODES = 128


def key(h: np.ndarray, *streams: int) -> np.ndarray:
    """Keys for elements with these hashes, one stream of random numbers each."""
    out = np.asarray(h, dtype=K.U)
    for s in streams:
        out = K.mix(out + K.mix(np.array([(s + 1) * 0xA0761D6478BD642F & (1 << 64) - 1], dtype=K.U)))
    return out


def uniform(keys: np.ndarray, stream: int = 0) -> np.ndarray:
    """Numbers strictly between 0 and 1."""
    return ((key(keys, stream) >> K.U(11)).astype(np.float64) + 0.5) * 2.0**-53


def gamma(shape: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Gamma variates by squeezed rejection from a cubed normal; small shapes are lifted by one."""
    shape = np.broadcast_to(np.asarray(shape, dtype=np.float64), keys.shape)
    d = np.where(shape < 1, shape + 1, shape) - 1 / 3
    out, todo, stream = np.empty(len(keys)), np.arange(len(keys)), 1
    while len(todo):
        k, at = keys[todo], d[todo]
        x = np.sqrt(-2 * np.log(uniform(k, stream))) * np.cos(2 * np.pi * uniform(k, stream + 1))
        v = (1 + x / np.sqrt(9 * at)) ** 3
        with np.errstate(invalid="ignore", divide="ignore"):
            good = (v > 0) & (np.log(uniform(k, stream + 2)) < 0.5 * x * x + at - at * v + at * np.log(v))
        out[todo[good]] = (at * v)[good]
        todo, stream = todo[~good], stream + 3
    small = shape < 1
    out[small] *= uniform(keys[small]) ** (1 / shape[small])
    return out


def stirling(discount: float) -> np.ndarray:
    """log S(c, t) for c, t <= EXACT, with S(c + 1, t) = S(c, t - 1) + (c - discount * t) * S(c, t)."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[1, 1] = 0.0
    with np.errstate(divide="ignore"):
        for c in range(1, EXACT):
            t = np.arange(1, c + 2)
            out[c + 1, 1 : c + 2] = np.logaddexp(out[c, t - 1], np.log(np.maximum(c - discount * t, 0)) + out[c, t])
    return out


def _log_gamma(x: np.ndarray) -> np.ndarray:
    y = x + 4
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) - np.log(x * (x + 1) * (x + 2) * (x + 3))


def _beyond(c: np.ndarray, y: np.ndarray, discount: float, u: np.ndarray) -> np.ndarray:
    """Tables of dishes with many customers, from uniform numbers u."""
    lo, hi = np.full(len(c), -200.0), np.full(len(c), 200.0)
    for _ in range(60):
        q = (lo + hi) / 2  # z = 1 / (1 + exp(-q))
        below = np.log(y) - np.logaddexp(0, -q) + (1 - discount) * np.logaddexp(0, q) < np.log(c)
        lo, hi = np.where(below, q, lo), np.where(below, hi, q)
    mean = y / discount * -np.expm1(-discount * np.logaddexp(0, q))
    p = np.clip(c / (mean * (1 + (1 - discount) * np.exp(np.minimum(q, 200)))), 1e-9, 1 - 1e-9)
    mean = np.maximum(mean * (c - 1) / c, 1e-9)
    n = np.maximum(mean / p, 1.0)
    p = np.minimum(mean / n, 1 - 1e-9)
    spread = np.sqrt(mean * (1 - p))
    low = np.maximum(np.floor(mean - 8 * spread - 2), 0)
    high = np.minimum(np.minimum(np.ceil(mean + 8 * spread + 8), np.floor(n)), c - 1)
    step = np.maximum(np.ceil((high - low) / (_NODES - 1)), 1)
    k = low[:, None] + step[:, None] * np.arange(_NODES)
    inside = k <= high[:, None]
    k = np.where(inside, k, low[:, None])
    n, p = n[:, None], p[:, None]
    log = k * np.log(p) + (n - k) * np.log1p(-p) - _log_gamma(k + 1) - _log_gamma(n - k + 1)
    log = np.where(inside, log, -np.inf)
    weight = np.cumsum(np.exp(log - log.max(axis=1, keepdims=True)), axis=1)
    at = (weight < u[:, None] * weight[:, -1:]).sum(axis=1)
    return 1 + k[np.arange(len(c)), at].astype(np.int64)


def seat(counts: np.ndarray, y: np.ndarray, discount: float, table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Tables of dishes with these customers; table: the result of :func:`stirling`."""
    out = np.minimum(counts, 1).astype(np.int64)
    u = uniform(keys)
    order = np.argsort(counts, kind="stable")
    at = np.searchsorted(counts[order], np.arange(2, EXACT + 2))
    for c in range(2, EXACT + 1):
        same = order[at[c - 2] : at[c - 1]]
        rows = max(1, (1 << 20) // c)
        for lo in range(0, len(same), rows):
            some = same[lo : lo + rows]
            log = np.arange(1, c + 1) * np.log(y[some, None]) + table[c, 1 : c + 1]
            weight = np.cumsum(np.exp(log - log.max(axis=1, keepdims=True)), axis=1)
            out[some] = 1 + (weight < u[some, None] * weight[:, -1:]).sum(axis=1)
    large = order[at[-1] :]
    for lo in range(0, len(large), 4096):
        some = large[lo : lo + 4096]
        out[some] = _beyond(counts[some].astype(np.float64), y[some], discount, u[some])
    return out
