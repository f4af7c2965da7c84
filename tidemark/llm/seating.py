"""Seating of customers in Pitman-Yor restaurants: the core of ``pitman_yor`` and ``word_contexts``."""

from __future__ import annotations

import numpy as np


def seat(n: np.ndarray, strength: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables that ``n`` customers of each dish take, one after the other.

    A new table has weight ``strength``, the taken ones customers - d * tables.  From
    the 64th customer on, blocks of an eighth of those seated draw their new
    tables at once.
    """
    out = np.zeros(n.shape)
    at = np.flatnonzero(n)
    n, strength = n.ravel()[at], np.broadcast_to(strength, n.shape).ravel()[at]
    seated, tables = np.ones(len(at)), np.ones(len(at))
    while True:
        go = seated < n
        if not go.all():  # those that are done leave
            out.ravel()[at[~go]] = tables[~go]
            at, n, strength, seated, tables = at[go], n[go], strength[go], seated[go], tables[go]
        if not len(at):
            return out
        block = np.minimum(n - seated, np.where(seated >= 64, np.floor(seated / 8), 1))
        p = strength / (strength + np.maximum(seated - d * tables, 1e-9))
        tables += rng.binomial(block.astype(np.int64), np.clip(p, 0, 1))
        seated += block
