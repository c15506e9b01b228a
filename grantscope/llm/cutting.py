"""Cutting stock by column generation: which lengths share a sequence, from a histogram of lengths.

The work depends on the number of distinct lengths (below the capacity), not on the number of pieces, so it
runs on the driver on a histogram that Spark has counted.
"""

from __future__ import annotations

import numpy as np

#: A pattern is how often each length (by position) stands in a sequence.
Pattern = tuple[tuple[int, int], ...]
EPS = 1e-9


def best_pattern(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the most value in ``capacity``, and how often each length is taken.

    ``lengths`` are distinct and rising.
    """
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if n := fits[c]:
            total = values[:n] + best[c - lengths[:n]]
            i = int(total.argmax())
            if total[i] > best[c] + EPS:
                best[c], choice[c] = total[i], i
    taken, c = np.zeros(len(lengths)), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            taken[choice[c]] += 1
            c -= lengths[choice[c]]
    return float(best[capacity]), taken


def first_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A feasible start: longest lengths first, each pattern used until one of its lengths has no demand left.

    No later pattern holds that length, so the columns are triangular in this order and form a basis.
    """
    m, left, alive = len(lengths), demand.copy(), np.ones(len(lengths), bool)
    columns, used = np.zeros((m, m)), np.zeros(m)
    for k in range(m):
        room, column = capacity, columns[:, k]
        for i in range(m - 1, -1, -1):
            if alive[i] and lengths[i] <= room:
                column[i] = room // lengths[i]
                room -= int(column[i]) * int(lengths[i])
        held = np.flatnonzero(column)
        ratio = left[held] / column[held]
        out = int(ratio.argmin())
        used[k] = ratio[out]
        left[held] -= used[k] * column[held]
        alive[held[out]] = False
        np.maximum(left, 0.0, out=left)
    return columns, used


def fractional_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float,
                        max_columns: int) -> tuple[np.ndarray, np.ndarray]:
    """The linear program by the revised simplex method: patterns (a column each) and how often each is used.

    Every length's demand is met exactly. A new column is priced by the knapsack under the rows' dual values; the
    bounds (all tokens over the capacity, value of all demand over the best column's value) end it once ``gap``
    proves that little is left to gain.
    Any step's solution meets the demand, so ``max_columns`` costs padding at worst, never pieces.
    """
    columns, used = first_patterns(lengths, demand, capacity)
    inverse = np.linalg.inv(columns)
    volume = lengths @ demand / capacity
    for step in range(max_columns):
        enough = max(gap * used.sum(), 1.0)  # less than a sequence is lost in rounding anyway
        if used.sum() - volume <= enough:
            break
        if step and step % 200 == 0:  # against rounding errors
            inverse = np.linalg.inv(columns)
            used = np.maximum(inverse @ demand, 0.0)
        duals = inverse.sum(axis=0)
        value, column = best_pattern(lengths, duals, capacity)
        if value <= 1 + 1e-7 or used.sum() - duals @ demand / value <= enough:
            break
        change = inverse @ column
        grows = change > EPS
        ratio = np.where(grows, used / np.where(grows, change, 1.0), np.inf)
        out = int(ratio.argmin())
        used = np.maximum(used - ratio[out] * change, 0.0)
        used[out] = ratio[out]
        columns[:, out] = column
        pivot = inverse[out] / change[out]
        inverse -= np.outer(change, pivot)
        inverse[out] = pivot
    return columns, used


def pack_rest(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Sequences for the few pieces that rounding leaves: longest first, each into the fullest sequence it fits."""
    open_at: list[list[dict[int, int]]] = [[] for _ in range(capacity + 1)]  # by room left
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        for _ in range(int(counts[i])):
            room = next((r for r in range(size, capacity + 1) if open_at[r]), None)
            sequence = open_at[room].pop() if room is not None else {}
            sequence[i] = sequence.get(i, 0) + 1
            open_at[(capacity if room is None else room) - size].append(sequence)
    return [tuple(sorted(s.items())) for same in open_at for s in same]


def cut_stock(histogram: dict[int, int], capacity: int, gap: float = 0.001, max_columns: int = 1000) -> list[tuple[Pattern, int]]:
    """Patterns of (length, times) with how often each is used; together they hold each length as often as counted."""
    if not histogram:
        return []
    lengths = np.array(sorted(histogram))
    demand = np.array([histogram[n] for n in lengths.tolist()], float)
    columns, used = fractional_patterns(lengths, demand, capacity, gap, max_columns)
    times = np.floor(used + 1e-6).astype(np.int64)
    left = demand.astype(np.int64) - (columns.astype(np.int64) @ times)
    while (short := np.flatnonzero(left < 0)).size:  # rounding errors only: give back a pattern
        p = int(np.flatnonzero((columns[short[0]] > 0) & (times > 0))[0])
        times[p] -= 1
        left = left + columns[:, p].astype(np.int64)
    whole = [(tuple((i, int(columns[i, p])) for i in np.flatnonzero(columns[:, p]).tolist()), int(times[p]))
             for p in np.flatnonzero(times).tolist()]
    rest: dict[Pattern, int] = {}
    for pattern in pack_rest(lengths, left, capacity):
        rest[pattern] = rest.get(pattern, 0) + 1
    return [(tuple((int(lengths[i]), k) for i, k in pattern), n) for pattern, n in [*whole, *rest.items()]]
