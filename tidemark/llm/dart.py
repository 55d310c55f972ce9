"""DartMinHash signatures of weighted sets, in numpy, for many sets at once.

Every element owns an infinite strip of (weight, rank) space. Hashing throws darts into it with density one: the
strip is cut into regions (weights [0,1), [1,2), [2,4), ... by ranks [0,R), [R,2R), [2R,4R), ...), the number of darts
of a region is Poisson with the region's area as its mean, and each dart has a weight, a rank and a coordinate out of
k, all derived from hashes of element and region. A set sees the darts below its elements' weights; for each
coordinate it keeps the earliest, the dart of lowest rank. Two sets agree in a coordinate with a probability of their
generalised Jaccard similarity. Only darts up to a rank of about (k ln k + 2k) / total weight are thrown, so the cost is
the number of elements plus that of darts, not their product with k; sets with a coordinate left empty are thrown
again to twice the rank.
"""

from __future__ import annotations

import math

import numpy as np

FIRST_RANK = 1 / 16     # height of the lowest region

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * (1.0 / (1 << 53))


_CDF: dict[float, np.ndarray] = {}


def _poisson(mean: float, u: np.ndarray) -> np.ndarray:
    """Inverse of the Poisson distribution function at u."""
    if mean not in _CDF:
        top = int(mean + 12 * math.sqrt(mean) + 20)
        logs = [i * math.log(mean) - mean - math.lgamma(i + 1) for i in range(top)]
        _CDF[mean] = np.cumsum(np.exp(logs))
    return np.searchsorted(_CDF[mean], u, side="right")


def _throw(of: np.ndarray, element: np.ndarray, weight: np.ndarray, reach: np.ndarray, k: int):
    """Darts that the sets see: packed (set, coordinate, rank) keys for sorting, and the darts' names."""
    keys, names = [], []
    layer, low_w, width_w = 0, 0.0, 1.0
    while True:
        heavy = np.flatnonzero(weight > low_w)
        if not len(heavy):
            break
        step, low_r, width_r = 0, 0.0, FIRST_RANK
        while True:
            idx = heavy[reach[of[heavy]] > low_r]
            if not len(idx):
                break
            region = mix(element[idx] + np.uint64((layer * 64 + step + 1) * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
            many = _poisson(width_w * width_r, _unit(region))
            hit = np.flatnonzero(many)
            n = many[hit]
            at = np.repeat(idx[hit], n)
            no = (np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)).astype(np.uint64)
            dart = mix(np.repeat(region[hit], n) + (no + np.uint64(1)) * _GOLD)
            second = mix(dart + _GOLD)
            third = mix(second + _GOLD)
            sets = of[at]
            rank = low_r + _unit(second) * width_r
            seen = (low_w + _unit(dart) * width_w < weight[at]) & (rank < reach[sets])
            sets, rank = sets[seen], rank[seen]
            place = sets.astype(np.uint64) * np.uint64(k) + third[seen] % np.uint64(k)
            keys.append((place << np.uint64(36)) | (rank / reach[sets] * (1 << 36)).astype(np.uint64))
            names.append(dart[seen])
            low_r, width_r, step = low_r + width_r, (width_r if step == 0 else width_r * 2), step + 1
        low_w, width_w, layer = low_w + width_w, (width_w if layer == 0 else width_w * 2), layer + 1
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(keys), np.concatenate(names)


def signatures(of: np.ndarray, element: np.ndarray, weight: np.ndarray, sets: int, k: int) -> np.ndarray:
    """(sets, k) names of the earliest darts; of, element, weight: the set, hash and weight of each element.

    At most 2^27 / k sets at once; every set has at least one element of positive weight.
    """
    sig = np.zeros((sets, k), dtype=np.uint64)
    total = np.bincount(of, weights=weight, minlength=sets)
    reach = (k * math.log(k) + 2 * k) / np.maximum(total, 1e-12)
    todo = np.arange(sets)
    while len(todo):
        back = np.full(sets, -1)
        back[todo] = np.arange(len(todo))
        mine = np.flatnonzero(back[of] >= 0)
        key, name = _throw(back[of[mine]], element[mine], weight[mine], reach[todo], k)
        order = np.argsort(key)
        place = (key[order] >> np.uint64(36)).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        part = np.zeros(len(todo) * k, dtype=np.uint64)
        full = np.zeros(len(todo) * k, dtype=bool)
        part[place[first]] = name[order[first]]
        full[place[first]] = True
        sig[todo] = part.reshape(-1, k)
        missing = ~full.reshape(-1, k).all(axis=1)
        todo = todo[missing]
        reach[todo] *= 2
    return sig
