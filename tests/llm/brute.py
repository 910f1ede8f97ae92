"""Plain versions to compare with."""

import math


def brute_removed(rows, split, length):
    """What a window of an equal one in a smaller document covers; rows: (id or None, text)."""
    order = [(math.inf if i is None else i, split(t or "")) for i, t in rows]
    least = {}
    for i, units in order:
        for k in range(len(units) - length + 1):
            w = tuple(units[k:k + length])
            least[w] = min(least.get(w, math.inf), i)
    out = []
    for i, units in order:
        gone = [False] * len(units)
        for k in range(len(units) - length + 1):
            if least[tuple(units[k:k + length])] < i:
                gone[k:k + length] = [True] * length
        out.append((i, units, gone))
    return out
