"""Byte-pair merging of many words at once.

Words of one length form a matrix of symbols. In each round every word merges its best pair, the leftmost among
equals, until no word has a pair left. A word's result does not depend on the words it shares a matrix with. A round
copies the matrix, so words of more than LONG symbols are merged one by one, as linked symbols with a heap of pairs:
the same merges in the same order, in time that grows with the word times its logarithm.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

NONE = np.int32(2**31 - 1)
# Symbols of one matrix; longer words are merged in matrices of fewer rows.
CELLS = 2_000_000
LONG = 200


class Merger:
    def __init__(self, left: list[int], right: list[int], rank: list[int], merged: list[int]):
        """Pairs of symbols, their rank (lower merges first) and the symbol they become. Symbols are below 2^31."""
        keys = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.int64(2**62))
        self.rank = np.append(np.array(rank, np.int32)[order], NONE)
        self.merged = np.append(np.array(merged, np.int32)[order], np.int32(-1))
        self.pairs: dict[int, tuple[int, int]] = {}

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; NONE where the pair does not merge or a side is missing (negative)."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at = np.searchsorted(self.keys[:-1], keys)
        hit = (self.keys[at] == keys) & (right >= 0)
        return np.where(hit, self.rank[at], NONE), self.merged[at]

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged symbols of all words one after another, and their number per word; words come one after another too."""
        starts = np.concatenate([[0], np.cumsum(lengths)])
        counts = lengths.astype(np.int64).copy()
        out = symbols.astype(np.int32).copy()
        order = np.argsort(lengths, kind="stable")
        of = lengths[order]
        for length in np.unique(of[of > 1]):
            rows = order[np.searchsorted(of, length) : np.searchsorted(of, length, "right")]
            if length > LONG:
                for row in rows.tolist():
                    done = self.merge_long(out[starts[row] : starts[row + 1]])
                    counts[row] = len(done)
                    out[starts[row] : starts[row] + len(done)] = done
                continue
            step = max(1, CELLS // int(length))
            for i in range(0, len(rows), step):
                some = rows[i : i + step]
                cells = starts[some][:, None] + np.arange(length)
                done = self._rounds(out[cells])
                out[cells] = done
                counts[some] = (done >= 0).sum(1)
        inside = np.arange(len(out)) - np.repeat(starts[:-1], lengths) < np.repeat(counts, lengths)
        return out[inside], counts

    def merge_long(self, symbols: np.ndarray) -> list[int]:
        """Merged symbols of one word."""
        if not self.pairs:
            self.pairs = dict(zip(self.keys[:-1].tolist(), zip(self.rank[:-1].tolist(), self.merged[:-1].tolist(), strict=True), strict=True))
        pair, symbol, n = self.pairs.get, symbols.tolist(), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, _ = self.look_up(symbols[:-1], symbols[1:])
        heap = [(r, i) for i, r in enumerate(rank.tolist()) if r < NONE]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            found = pair((symbol[i] << 32) | symbol[j]) if symbol[i] >= 0 and j < n else None
            if found is None or found[0] != r:
                continue  # one of the two has been merged since
            symbol[i], symbol[j] = found[1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if right := pair((symbol[i] << 32) | symbol[after[i]]):
                    heapq.heappush(heap, (right[0], i))
            if before[i] >= 0 and (left := pair((symbol[before[i]] << 32) | symbol[i])):
                heapq.heappush(heap, (left[0], before[i]))
        return [s for s in symbol if s >= 0]

    def _rounds(self, s: np.ndarray) -> np.ndarray:
        result = s.copy()
        rows = np.arange(len(s))
        rank, merged = self.look_up(s[:, :-1].ravel(), s[:, 1:].ravel())
        rank, merged = rank.reshape(len(s), -1), merged.reshape(len(s), -1)
        columns = np.arange(s.shape[1])
        while len(rows):
            at = rank.argmin(1)
            here = np.arange(len(rows))
            live = rank[here, at] < NONE
            if not live.all():
                result[rows[~live], : s.shape[1]] = s[~live]
                result[rows[~live], s.shape[1] :] = -1
                rows, s, rank, merged, at = rows[live], s[live], rank[live], merged[live], at[live]
                here = np.arange(len(rows))
                if not len(rows):
                    break
            s[here, at] = merged[here, at]
            past = columns[None, : s.shape[1] - 1] > at[:, None]
            s = np.where(past, s[:, 1:], s[:, :-1])  # one symbol less in every word
            if s.shape[1] == 1:
                result[rows, 0], result[rows, 1:] = s[:, 0], -1
                break
            past = past[:, : s.shape[1] - 1]
            rank, merged = np.where(past, rank[:, 1:], rank[:, :-1]), np.where(past, merged[:, 1:], merged[:, :-1])
            for first in (at, at - 1):
                ok = np.flatnonzero((first >= 0) & (first < s.shape[1] - 1))
                r, m = self.look_up(s[ok, first[ok]], s[ok, first[ok] + 1])
                rank[ok, first[ok]], merged[ok, first[ok]] = r, m
        return result


def some(texts: list, most: int = 1_000_000) -> Iterator[list]:
    """The texts in runs of about `most` characters, so that what is built per run stays small."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run
