"""Cutting stock over a histogram of lengths, by column generation.

Items of lengths 1 to ``capacity - 1`` with integer demands are to fill
sequences. A pattern is a multiset of lengths of total at most ``capacity``;
it costs ``capacity``, or its total where that is a power of two (such a
sequence needs no padding). The linear program chooses how often to use
which pattern; a knapsack dynamic program over the dual prices finds the
pattern that would lower the cost most, until none does or the bound on what
is left to gain falls under ``tolerance``. Its size depends on the number of
distinct lengths alone, never on the number of items.
"""

from __future__ import annotations

import numpy as np

Pattern = dict[int, int]  # length -> how many


def pattern_cost(total: int, capacity: int) -> int:
    return total if total & (total - 1) == 0 else capacity


def greedy(demand: dict[int, int], capacity: int) -> list[tuple[Pattern, int, int]]:
    """Best-fit decreasing on the histogram: (pattern, times, the length it uses up).

    Each step fills one sequence with the longest lengths that still fit and
    repeats it as often as the demand allows.
    """
    left = dict(demand)
    lengths = sorted(left, reverse=True)
    out = []
    while lengths:
        pattern: Pattern = {}
        room, start = capacity, 0
        while start < len(lengths) and room >= lengths[-1]:
            low, high = start, len(lengths)
            while low < high:  # first length that fits
                mid = (low + high) // 2
                low, high = (mid + 1, high) if lengths[mid] > room else (low, mid)
            if low == len(lengths):
                break
            size = lengths[low]
            count = min(room // size, left[size])
            pattern[size] = count
            room -= count * size
            start = low + 1
        times = min(left[s] // c for s, c in pattern.items())
        used_up = None
        for s, c in pattern.items():
            left[s] -= c * times
            if not left[s] and used_up is None:
                used_up = s
        if used_up is None:  # a length has fewer left than the pattern takes
            used_up = min(pattern, key=lambda s: left[s])
            out.append((pattern, times, 0))
            continue
        out.append((pattern, times, used_up))
        lengths = [s for s in lengths if left[s]]
    return out


def price(worth: np.ndarray, capacity: int) -> tuple[float, Pattern]:
    """(reduced cost, pattern) of the best pattern, by knapsack dynamic programming.

    ``worth[s]`` is the dual price of length s (minus infinity where there is no such item).
    """
    back = np.full(capacity + 1, -np.inf)  # back[capacity - t]: best value of an exact total t
    back[capacity] = 0.0
    choice = [0] * (capacity + 1)
    for total in range(1, capacity + 1):
        options = back[capacity - total + 1:] + worth[1:total + 1]
        best = int(options.argmax())
        back[capacity - total], choice[total] = options[best], best + 1
    cost = np.array([pattern_cost(t, capacity) for t in range(1, capacity + 1)], float)
    reduced = cost - back[::-1][1:]
    total = int(np.argmin(reduced)) + 1
    result, pattern = float(reduced[total - 1]), {}
    while total:
        size = choice[total]
        pattern[size] = pattern.get(size, 0) + 1
        total -= size
    return result, pattern


def solve(demand: dict[int, int], capacity: int, tolerance: float = 1e-4,
          max_columns: int = 600) -> tuple[list[Pattern], np.ndarray]:
    """(patterns, fractional times) of a solution of the linear program that meets the demand exactly.

    The start is the greedy packing's patterns: each uses up one length, so
    together they are a triangular basis. Every round prices a column and
    exchanges it for the one that leaves first.
    """
    lengths = np.array(sorted(demand), np.int64)
    place = {int(s): i for i, s in enumerate(lengths)}
    m = len(lengths)
    need = np.array([demand[int(s)] for s in lengths], float)
    basis: list[Pattern] = [{int(s): 1} for s in lengths]
    inverse, times = np.eye(m), need.copy()
    costs = np.array([pattern_cost(int(s), capacity) for s in lengths], float)
    prices = costs.copy()

    def direction(pattern: Pattern) -> np.ndarray:
        return inverse[:, [place[s] for s in pattern]] @ np.array(list(pattern.values()), float)

    def exchange(pattern: Pattern, entering: np.ndarray, out: int) -> None:
        """Puts ``pattern`` in the place of basis column ``out``; only rows that change are touched."""
        nonlocal prices
        cost = pattern_cost(sum(s * c for s, c in pattern.items()), capacity)
        touched = np.flatnonzero(np.abs(entering) > 1e-12)
        reduced = cost - costs[touched] @ entering[touched]
        step = times[out] / entering[out]
        times[touched] -= step * entering[touched]
        times[out] = step
        row = inverse[out] / entering[out]
        filled = np.flatnonzero(row)
        inverse[np.ix_(touched, filled)] -= np.outer(entering[touched], row[filled])
        inverse[out] = row
        prices = prices + reduced * row
        basis[out], costs[out] = pattern, cost

    for pattern, _, used_up in greedy(demand, capacity):
        if used_up:
            entering = direction(pattern)
            if abs(entering[place[used_up]]) > 1e-9:
                exchange(pattern, entering, place[used_up])
    if (times < -1e-6 * need.max()).any():  # not feasible after repeats by halves: start from single lengths
        basis, inverse, times = [{int(s): 1} for s in lengths], np.eye(m), need.copy()
        costs = np.array([pattern_cost(int(s), capacity) for s in lengths], float)
        prices = costs.copy()
    np.maximum(times, 0, out=times)
    worth = np.full(capacity + 1, -np.inf)
    for _ in range(max_columns):
        worth[lengths] = prices
        reduced, pattern = price(worth, capacity)
        # each sequence lowers the cost by -reduced at most, and no solution uses more than this many
        if -reduced * times.sum() <= tolerance * (costs @ times):
            break
        entering = direction(pattern)
        usable = np.flatnonzero(entering > 1e-9)
        if not usable.size:
            break
        exchange(pattern, entering, int(usable[np.argmin(times[usable] / entering[usable])]))
        np.maximum(times, 0, out=times)
    return basis, times


def whole_patterns(demand: dict[int, int], capacity: int, spare: int = 16) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """(patterns with whole times, demand left over).

    The program's times are rounded down; what is left (less than one
    sequence per pattern) is packed greedily, keeping sequences that lack at
    most ``spare`` tokens. The rest is for the caller to cut.
    """
    demand = {s: n for s, n in demand.items() if n}
    if not demand:
        return [], {}
    left, out = dict(demand), []

    def take(pattern: Pattern, times: int) -> None:
        times = min([times, *[left[s] // c for s, c in pattern.items()]])
        if times > 0:
            out.append((pattern, times))
            for s, c in pattern.items():
                left[s] -= c * times

    basis, times = solve(demand, capacity)
    for pattern, x in zip(basis, np.floor(times + 1e-6).astype(np.int64).tolist(), strict=True):
        if x and pattern_cost(total := sum(s * c for s, c in pattern.items()), capacity) - total <= spare:
            take(pattern, x)
    for pattern, x, _ in greedy({s: n for s, n in left.items() if n}, capacity):
        if x and pattern_cost(total := sum(s * c for s, c in pattern.items()), capacity) - total <= spare:
            take(pattern, x)
    return out, {s: n for s, n in left.items() if n}
