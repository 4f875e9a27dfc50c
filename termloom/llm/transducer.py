"""Minimal acyclic transducers: sorted words in, the rank of each word out.

A transducer is built from words in ascending byte order, one after the other: what the next word does not share with
the last one can change no more, so its states are looked up among those kept and merged with equal ones. Each arc
carries the number of words that come before all words through it, among those of its state; summed along
the way of a word, these make its place in the sorted list.

States are stored as arrays: the arcs of a state lie together, ordered by byte, and a bitmap of 256 bits per state says
which bytes it has arcs for, so an arc is found by counting bits. Many words are stepped through side by side.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


class Transducer:
    """Arrays: first arc of each state and one more, whether it ends a word, and byte, target and output per arc."""

    FIELDS = (("first", "<i4"), ("final", "u1"), ("label", "u1"), ("target", "<i4"), ("out", "<i4"))

    def __init__(self, first, final, label, target, out):
        self.first, self.final, self.label, self.target, self.out = first, final, label, target, out

    @property
    def root(self) -> int:
        return len(self.final) - 1

    @classmethod
    def of(cls, words: Iterable[bytes]) -> Transducer:
        """From distinct words in ascending order."""
        kept: dict[tuple, int] = {}
        below: list[int] = []  # words that can be finished from a state
        states: list[tuple] = []
        open_: list[list] = [[False, []]]  # states along the last word: whether it ends one, and arcs
        last = b""

        def close(depth: int) -> None:
            """Settle the states of the last word that lie deeper."""
            while len(open_) - 1 > depth:
                final, arcs = open_.pop()
                state = settle(final, arcs)
                open_[-1][1].append((last[len(open_) - 1], state))

        def settle(final: bool, arcs: list) -> int:
            key = (final, tuple(arcs))
            if key not in kept:
                kept[key] = len(states)
                states.append(key)
                below.append(final + sum(below[target] for _, target in arcs))
            return kept[key]

        for word in words:
            shared, least = 0, min(len(word), len(last))
            while shared < least and word[shared] == last[shared]:
                shared += 1
            close(shared)
            open_.extend([False, []] for _ in range(len(word) - shared))
            open_[-1][0] = True
            last = word
        close(0)
        # The root stands last, even if a state below is equal to it.
        states.append((open_[0][0], tuple(open_[0][1])))
        first, label, target, out = [0], [], [], []
        for final, arcs in states:
            seen = int(final)
            for byte, to in arcs:
                label.append(byte)
                target.append(to)
                out.append(seen)
                seen += below[to]
            first.append(len(label))
        columns = (first, [f for f, _ in states], label, target, out)
        return cls(*(np.array(c, t) for c, (_, t) in zip(columns, cls.FIELDS)))

    def to_bytes(self) -> bytes:
        head = np.array([len(self.final), len(self.label)], "<i8").tobytes()
        return head + b"".join(getattr(self, name).tobytes() for name, _ in self.FIELDS)

    @classmethod
    def from_bytes(cls, stored: bytes) -> Transducer:
        n_states, n_arcs = (int(x) for x in np.frombuffer(stored, "<i8", 2))
        at, columns = 16, []
        for name, kind in cls.FIELDS:
            n = n_states + (name == "first") if name in ("first", "final") else n_arcs
            columns.append(np.frombuffer(stored, kind, n, at))
            at += columns[-1].nbytes
        return cls(*columns)

    def word(self, rank: int) -> bytes:
        """The word at a place of the sorted list."""
        state, found = self.root, bytearray()
        while not (self.final[state] and rank == 0):
            arcs = slice(self.first[state], self.first[state + 1])
            at = int(np.searchsorted(self.out[arcs], rank, side="right")) - 1 + int(self.first[state])
            rank -= int(self.out[at])
            found.append(self.label[at])
            state = self.target[at]
        return bytes(found)


class Stepper:
    """Several transducers joined into one set of arrays; each is entered at its own root."""

    def __init__(self, transducers: list[Transducer]):
        states = np.cumsum([0] + [len(t.final) for t in transducers])
        arcs = np.cumsum([0] + [len(t.label) for t in transducers])
        self.roots = states[1:] - 1

        def joined(parts: list, kind) -> np.ndarray:
            return np.concatenate([*parts, np.zeros(0)]).astype(kind)

        self.first = joined([t.first[:-1] + a for t, a in zip(transducers, arcs)], np.int64)
        self.final = joined([t.final for t in transducers], bool)
        self.target = joined([t.target + s for t, s in zip(transducers, states)], np.int32)
        self.out = joined([t.out for t in transducers], np.int32)
        label = joined([t.label for t in transducers], np.uint8)
        owner = np.repeat(np.arange(len(self.first)), np.diff(self.first, append=len(label)))
        self.bits = np.zeros((len(self.first), 4), np.uint64)
        np.bitwise_or.at(self.bits, (owner, label >> 6), np.uint64(1) << (label & 63).astype(np.uint64))
        counts = np.bitwise_count(self.bits).astype(np.int16)
        self.before = np.cumsum(counts, axis=1, dtype=np.int16) - counts

    def ranks(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, root: np.ndarray) -> np.ndarray:
        """Rank of each word of ``data`` in the transducer with this root; -1 where it has no such word."""
        found = np.full(len(start), -1, np.int64)
        alive, state, rank = np.arange(len(start)), root.astype(np.int64), np.zeros(len(start), np.int64)
        step = 0
        while len(alive):
            ended = length[alive] == step
            if ended.any():
                good = ended & self.final[state]
                found[alive[good]] = rank[good]
                alive, state, rank = alive[~ended], state[~ended], rank[~ended]
            byte = data[start[alive] + step]
            quarter, low = byte >> 6, (byte & 63).astype(np.uint64)
            bits = self.bits[state, quarter]
            has = (bits >> low) & np.uint64(1) == 1
            alive, state, rank, quarter, low, bits = (x[has] for x in (alive, state, rank, quarter, low, bits))
            ahead = np.bitwise_count(bits & ((np.uint64(1) << low) - np.uint64(1)))
            arc = self.first[state] + self.before[state, quarter] + ahead
            rank = rank + self.out[arc]
            state = self.target[arc].astype(np.int64)
            step += 1
        return found
