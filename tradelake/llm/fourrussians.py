"""Cheapest edits of a sequence of rows into legal turns, by precomputed tables over blocks of rows.

A legal sequence of role initials is empty, or an optional `s` and then `ua` once or more. Four states tell what may
come next. What an ending costs from each state is a vector of four numbers; its differences are bounded, so that
there are few vectors once the least number is taken off. For every such vector and every block of LENGTH rows a
table holds the vector before the block and the cost taken off: a sequence is worked through from its end, one
look-up per block. The edits are then read forwards, from the vectors inside each block, which are found by expanding
the block backwards from the vector at its end.
"""

from __future__ import annotations

from functools import cache

import numpy as np

KEEP, INSERT, REROLE, DELETE, CUT = 0, 3, 3, 4, 3
START, SYSTEM, USER, DONE = range(4)
# State after each initial; initials that are not there are illegal in the state.
AFTER = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": DONE}, {"u": USER}]
# The one initial that an inserted row or a row given a new role can have in each state.
NEEDED = "uuau"
ROLES = {"u": "user", "a": "assistant"}
# Symbols: two for each initial, the second for rows whose text is cut off; a row that has to go; no row.
INITIALS = "sua"
GONE, NONE = 8, 9
SYMBOLS = 10
LENGTH = 4


def symbol(initial: str, cut: bool) -> int:
    return 2 * (INITIALS.index(initial) if initial and initial in INITIALS else 3) + cut


def initial_of(symbol: int) -> str:
    return INITIALS[symbol // 2] if symbol < 6 else ""


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    costs = list(costs)
    for _ in range(3):
        costs = [min(c, INSERT + costs[AFTER[q][NEEDED[q]]]) for q, c in enumerate(costs)]
    return tuple(costs)


def before(costs: tuple[int, ...], row: int) -> tuple[int, ...]:
    """What an ending costs from each state, given what it costs after its first row."""
    if row == NONE:
        return costs
    out = [DELETE + c for c in costs]
    if row != GONE:
        extra, initial = CUT * (row % 2), initial_of(row)
        for q in range(4):
            out[q] = min(out[q], REROLE + extra + costs[AFTER[q][NEEDED[q]]])
            if initial in AFTER[q]:
                out[q] = min(out[q], KEEP + extra + costs[AFTER[q][initial]])
    return _with_inserts(out)


END = _with_inserts([0, 99, 99, 0])


class Tables:
    def __init__(self, length: int = LENGTH):
        self.length = length
        number, vectors, steps = {END: 0}, [END], []
        for vector in vectors:  # grows while there are new ones
            row = []
            for x in range(SYMBOLS):
                found = before(vector, x)
                least = min(found)
                rest = tuple(c - least for c in found)
                if rest not in number:
                    number[rest] = len(vectors)
                    vectors.append(rest)
                row.append((number[rest], least))
            steps.append(row)
        self.vectors = vectors
        self.next = np.array([[n for n, _ in row] for row in steps], np.int32)
        self.cost = np.array([[c for _, c in row] for row in steps], np.int32)
        self.steps = steps
        # Of the last rows of a block, one more at a time: first symbol, then the others.
        nexts, costs = self.next, self.cost
        for _ in range(length - 1):
            further = self.cost[nexts] + costs[:, :, None]
            nexts, costs = (x.transpose(0, 2, 1).reshape(len(vectors), -1) for x in (self.next[nexts], further))
        self.block_next, self.block_cost = np.ascontiguousarray(nexts), np.ascontiguousarray(costs)

    def blocks(self, rows: np.ndarray) -> np.ndarray:
        """The number of each block; the first one is filled up with no rows in front."""
        padded = np.concatenate([np.full(-len(rows) % self.length, NONE), rows]).reshape(-1, self.length)
        return padded @ SYMBOLS ** np.arange(self.length - 1, -1, -1)

    def fold(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every vector at the end of the rows: the vector before them, and the cost taken off."""
        at, cost = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        for block in self.blocks(rows)[::-1].tolist():
            cost += self.block_cost[at, block]
            at = self.block_next[at, block]
        return at, cost

    def trace(self, rows: np.ndarray, state: int, end: int, last: bool) -> tuple[int, str]:
        """The state after the rows and the least of the cheapest edits' initials, from a state on to the vector `end`.

        Inserts go before the row they come with; those after the last row of all are told if `last`. The order of the
        initials is D, I, K, R.
        """
        blocks = self.blocks(rows).tolist()
        ends = [end]
        for block in reversed(blocks[1:]):
            ends.append(int(self.block_next[ends[-1], block]))
        out, first, plain = [], len(rows) - self.length * len(blocks), rows.tolist()
        for end_of_block in reversed(ends):
            part = plain[max(first, 0) : first + self.length]
            first += self.length
            # Expanded from its end: for each row the vector after it, the vector before it, and the cost taken off.
            places, after = [], end_of_block
            for x in reversed(part):
                known, least = self.steps[after][x]
                places.append((self.vectors[after], self.vectors[known], least, x))
                after = known
            for behind, here, least, x in reversed(places):
                while True:
                    if here[state] + least == DELETE + behind[state]:
                        out.append("D")
                        break
                    needed = AFTER[state][NEEDED[state]]
                    if here[state] == INSERT + here[needed]:
                        out.append("I")
                        state = needed
                        continue
                    extra, kept = CUT * (x % 2), AFTER[state].get(initial_of(x))
                    if kept is not None and here[state] + least == KEEP + extra + behind[kept]:
                        out.append("K")
                        state = kept
                    else:
                        out.append("R")
                        state = needed
                    break
        while last and state in (SYSTEM, USER):
            out.append("I")
            state = AFTER[state][NEEDED[state]]
        return state, "".join(out)


@cache
def tables(length: int = LENGTH) -> Tables:
    """Built once per process."""
    return Tables(length)
