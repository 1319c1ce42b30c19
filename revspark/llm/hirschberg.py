"""Cheapest repair of a sequence of turns, by Hirschberg's divide and conquer.

A conversation is a byte a row (``code``): what its role begins with and its first fault. A repair
walks through four states, what the repaired conversation ends with: nothing, system, user,
assistant. Each row is kept, given another role or deleted; empty turns may be put in before it. The
repaired roles must read ``(s?(ua)+)?``, so the state says which of user and assistant comes next,
and an audit (the edits' initials in order) fixes its own path.

``repair`` finds the cheapest audit, the ASCII-least of equally cheap ones. A segment is halved; a
forward vector of four costs (to every state after the left half) and a backward one (from every
state before the right half) meet in the middle. The states with the least sum are the optimal
crossings. With one, both halves are solved on their own; with several, the halves are solved for
each and the crossing whose joined audit is least is taken. Equally cheap audits of one segment
between the same states never are each other's prefix (the longer one would have paid for more
inserted turns), so the least audit of a whole is made of least audits of its halves. A segment is
solved for at most 16 pairs of states at a time and its vectors are not kept: space is linear.
"""

from __future__ import annotations

import numpy as np

# ---- fixed values: edits and their costs, states, faults and initials -------------------------
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"  # any other one is coded as 3
CLEAN, TRUNCATED, BLANK, DUPLICATE = range(4)
FIRST_CODE = 65  # code: 65 + 4 * initial + fault, a letter from A to P
# ------------------------------------------------------------------------------------------------
STATES = range(4)
NEVER = 1 << 40
BLOCK = 1 << 14  # rows whose step tables are held at a time


def added(state: int) -> int:
    """The state after a turn of the role that must come next."""
    return ASSISTANT if state == USER else USER


def kept(state: int, initial: int) -> int | None:
    """The state after a row that keeps its role, if it may stand there."""
    if initial == 0:
        return SYSTEM if state == NOTHING else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def _row_paths(code: int) -> list[list[tuple[int, str] | None]]:
    """Least (cost, audit) of one row, with what is inserted before it, between all states."""
    initial, fault = divmod(code - FIRST_CODE, 4)
    out: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in STATES]
    for start in STATES:
        state, cost, audit = start, 0, ""
        for _ in range(3):  # a third inserted turn would only go round once more
            edits = [(state, DELETE_COST, DELETE)]
            if fault in (CLEAN, TRUNCATED):
                late = TRUNCATED_COST if fault == TRUNCATED else 0
                edits.append((added(state), REROLE_COST + late, REROLE))
                after = kept(state, initial)
                if after is not None:
                    edits.append((after, late, KEEP))
            for end, more, letter in edits:
                found = (cost + more, audit + letter)
                if out[start][end] is None or found < out[start][end]:
                    out[start][end] = found
            state, cost, audit = added(state), cost + INSERT_COST, audit + INSERT
    return out


ROWS = [_row_paths(FIRST_CODE + c) for c in range(16)]
STEPS = np.array([[[NEVER if p is None else p[0] for p in row] for row in rows] for rows in ROWS])
ENDS = {NOTHING: (0, ""), ASSISTANT: (0, ""), USER: (INSERT_COST, INSERT),
        SYSTEM: (2 * INSERT_COST, 2 * INSERT)}


def _product(steps: np.ndarray) -> np.ndarray:
    """Costs between all states over all rows: tables of neighbours are joined, again and again."""
    while len(steps) > 1:
        odd = steps[-1:] if len(steps) % 2 else steps[:0]
        left, right = steps[0:len(steps) - len(odd):2], steps[1::2]
        joined = (left[:, :, :, None] + right[:, None, :, :]).min(axis=2)
        steps = np.concatenate([np.minimum(joined, NEVER), odd])
    return steps[0]


def _forward(codes: bytes, a: int, b: int, costs: list[int]) -> list[int]:
    if b - a <= 32:
        for code in codes[a:b]:
            rows = _COSTS[code - FIRST_CODE]
            costs = [min(costs[s] + rows[s][e] for s in STATES) for e in STATES]
        return costs
    vector = np.array(costs)
    for at in range(a, b, BLOCK):
        some = np.frombuffer(codes, np.uint8, min(BLOCK, b - at), at) - FIRST_CODE
        vector = np.minimum((vector[:, None] + _product(STEPS[some])).min(axis=0), NEVER)
    return vector.tolist()


def _backward(codes: bytes, a: int, b: int, costs: list[int]) -> list[int]:
    if b - a <= 32:
        for code in reversed(codes[a:b]):
            rows = _COSTS[code - FIRST_CODE]
            costs = [min(rows[s][e] + costs[e] for e in STATES) for s in STATES]
        return costs
    vector = np.array(costs)
    for stop in range(b, a, -BLOCK):
        at = max(a, stop - BLOCK)
        some = np.frombuffer(codes, np.uint8, stop - at, at) - FIRST_CODE
        vector = np.minimum((_product(STEPS[some]) + vector[None, :]).min(axis=1), NEVER)
    return vector.tolist()


_COSTS = STEPS.tolist()
_UNIT = [[0 if s == e else NEVER for e in STATES] for s in STATES]


def _solve(codes: bytes, a: int, b: int, wanted: set[tuple[int, int]]) -> dict:
    """The least audit of rows a to b for each wanted (state before, state after)."""
    if b - a == 1:
        rows = ROWS[codes[a] - FIRST_CODE]
        return {pair: rows[pair[0]][pair[1]][1] for pair in wanted}
    middle = (a + b) // 2
    forward = {s: _forward(codes, a, middle, _UNIT[s]) for s in {s for s, _ in wanted}}
    backward = {e: _backward(codes, middle, b, _UNIT[e]) for e in {e for _, e in wanted}}
    crossings = {}
    for s, e in wanted:
        sums = [x + y for x, y in zip(forward[s], backward[e])]
        least = min(sums)
        crossings[s, e] = [c for c in STATES if sums[c] == least]
    left = _solve(codes, a, middle, {(s, c) for (s, _), cs in crossings.items() for c in cs})
    right = _solve(codes, middle, b, {(c, e) for (_, e), cs in crossings.items() for c in cs})
    return {(s, e): min(left[s, c] + right[c, e] for c in cs) for (s, e), cs in crossings.items()}


def repair(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair; of equally cheap ones the ASCII-least audit."""
    if not codes:
        return 0, ""
    costs = _forward(codes, 0, len(codes), _UNIT[NOTHING])
    totals = [costs[s] + ENDS[s][0] for s in STATES]
    least = min(totals)
    last = [s for s in STATES if totals[s] == least]
    found = _solve(codes, 0, len(codes), {(NOTHING, s) for s in last})
    return least, min(found[NOTHING, s] + ENDS[s][1] for s in last)
