"""A minimal acyclic transducer: sorted terms to their ordinals, as flat arrays.

Terms come in order of their bytes; a state is settled as soon as no later term can
change it, and states with the same arcs and finality are one.  Each arc carries how
many terms come before those behind it, so the sum along a term's path is its ordinal.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


class Transducer:
    """keys: state and byte of each arc (state * 256 + byte), rising; target and skip of each; final: which states end a term."""

    def __init__(self, keys: np.ndarray, target: np.ndarray, skip: np.ndarray, final: np.ndarray):
        self.keys, self.target, self.skip, self.final = keys, target, skip, final
        self.root = len(final) - 1

    @classmethod
    def of(cls, terms: Iterable[bytes]) -> Transducer:
        """From different terms in rising order of their bytes."""
        known: dict[tuple, int] = {}
        states: list[tuple] = []

        def settled(end: bool, arcs: list[list[int]]) -> int:
            state = (end, tuple(map(tuple, arcs)))
            if state not in known:
                known[state] = len(states)
                states.append(state)
            return known[state]

        path: list[list] = [[False, []]]  # the last term's states that may still change: does a term end here, [byte, target] of each arc
        last: bytes | None = None

        def settle(depth: int) -> None:
            while len(path) > depth + 1:
                end, arcs = path.pop()
                path[-1][1][-1][1] = settled(end, arcs)

        for term in terms:
            if last is not None and term <= last:
                raise ValueError("terms must be different and in rising order")
            common = 0
            for a, b in zip(term, last or b"", strict=False):
                if a != b:
                    break
                common += 1
            settle(common)
            for byte in term[common:]:
                path[-1][1].append([byte, -1])
                path.append([False, []])
            path[-1][0], last = True, term
        settle(0)
        settled(*path[0]) if states or last is not None else states.append((False, ()))
        below = np.zeros(len(states), dtype=np.int64)  # terms from each state on
        keys, target, skip = [], [], []
        for n, (end, arcs) in enumerate(states):  # targets come before the states that lead to them
            before = int(end)
            for byte, to in arcs:
                keys.append(n << 8 | byte)
                target.append(to)
                skip.append(before)
                before += int(below[to])
            below[n] = before
        return cls(np.array(keys, np.int64), np.array(target, np.int32), np.array(skip, np.int64), np.array([end for end, _ in states], bool))

    def ordinals(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each byte range of buf its ordinal, or -1; all ranges go through the states side by side."""
        out = np.full(len(starts), -1, dtype=np.int64)
        who = np.arange(len(starts))
        state = np.full(len(starts), self.root, dtype=np.int64)
        total = np.zeros(len(starts), dtype=np.int64)
        at, ends = np.asarray(starts, np.int64), np.asarray(ends, np.int64)
        while len(who):
            over = at == ends
            if over.any():
                right = over & self.final[state]
                out[who[right]] = total[right]
                on = ~over
                who, state, total, at, ends = who[on], state[on], total[on], at[on], ends[on]
            if not len(self.keys) or not len(who):
                break
            wanted = state << 8 | buf[at]
            k = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            on = self.keys[k] == wanted
            k = k[on]
            who, total, at, ends = who[on], total[on] + self.skip[k], at[on] + 1, ends[on]
            state = self.target[k].astype(np.int64)
        return out

    def stored(self) -> tuple[bytes, bytes, bytes, bytes]:
        return self.keys.tobytes(), self.target.tobytes(), self.skip.tobytes(), self.final.tobytes()

    @classmethod
    def loaded(cls, keys: bytes, target: bytes, skip: bytes, final: bytes) -> Transducer:
        return cls(np.frombuffer(keys, np.int64), np.frombuffer(target, np.int32), np.frombuffer(skip, np.int64), np.frombuffer(final, bool))
