"""A minimal acyclic transducer from byte strings to numbers, kept as flat arrays that can be memory-mapped.

Words that end alike share their states.  Every transition carries how many words come before those it
leads to, so the sum along a path is the word's place in sorted order; outputs are looked up by it.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

_HEADER = 4


class Automaton:
    """Built by ``compiled``; ``places`` looks up many words at once."""

    def __init__(self, data):
        self.data = data
        n_edges, n_words, n_output, _ = np.frombuffer(data, "<i8", _HEADER)
        at = 8 * _HEADER
        parts = []
        for kind, n in (("<i8", n_edges), ("<i4", n_edges), ("<i4", n_edges), ("<i4", n_words + 1), ("<u4", n_output)):
            parts.append(np.frombuffer(data, kind, n, at))
            at += parts[-1].nbytes
        # a transition's key is its state times 256 plus its byte; a negative target stands for a final state
        self.keys, self.targets, self.before, self.output_at, self.outputs = parts

    @classmethod
    def mapped(cls, content: bytes) -> Automaton:
        """Put the content into a nameless file of this process and map it."""
        with tempfile.TemporaryFile() as file:
            file.write(content)
            file.flush()
            return cls(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of every word, -1 for those that are not in the automaton."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        places = np.full(len(words), -1, dtype=np.int64)
        if not len(self.keys):
            return places
        text = np.frombuffer(b"".join(words) + b"\0", dtype=np.uint8)
        starts = np.cumsum(lengths) - lengths
        alive, states, sums = np.arange(len(words)), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        alive = alive[lengths > 0]
        states, sums = states[alive], sums[alive]
        step = 0
        while len(alive):
            wanted = states * 256 + text[starts[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            found = self.keys[at] == wanted
            alive, at, sums = alive[found], at[found], sums[found]
            sums = sums + self.before[at]
            target = self.targets[at].astype(np.int64)
            step += 1
            ended = lengths[alive] == step
            final = ended & (target < 0)
            places[alive[final]] = sums[final]
            go = ~ended
            # the word that ends in a final state comes before those that go on from it
            alive, sums, target = alive[go], sums[go] + (target[go] < 0), target[go]
            states = np.abs(target) - 1
        return places

    def output(self, place: int) -> bytes:
        return self.outputs[self.output_at[place] : self.output_at[place + 1]].tobytes()


def compiled(words: dict[bytes, list[int]]) -> bytes:
    """The content of the automaton of non-empty words and their outputs."""
    ordered = sorted(words)
    # States by their right language: a finished state is known by whether it is final and where it leads.
    known: dict[tuple, int] = {}
    edges: list[tuple] = []
    counts: list[int] = []

    def finished(node: list) -> int:
        key = (node[0], tuple(node[1]))
        state = known.get(key)
        if state is None:
            state = known[key] = len(counts)
            counts.append(node[0] + sum(counts[target] for _, target in node[1]))
            edges.append(key)
        return state

    path: list[list] = [[False, []]]
    letters: list[int] = []
    previous = b""
    for word in [*ordered, b""]:
        same = 0
        while same < min(len(word), len(previous)) and word[same] == previous[same]:
            same += 1
        while len(path) > same + 1:
            state = finished(path.pop())
            path[-1][1].append((letters.pop(), state))
        for byte in word[same:]:
            path.append([False, []])
            letters.append(byte)
        if word:
            path[-1][0] = True
        previous = word
    root = finished(path[0])
    # The root becomes state 0, so that targets, counted from 1, can carry the mark of final states as a sign.
    number = {root: 0}
    for state in range(len(counts)):
        number.setdefault(state, len(number))
    rows = []
    for state, (_, leads) in enumerate(edges):
        before = 0
        for byte, target in leads:
            sign = -1 if edges[target][0] else 1
            rows.append((number[state] * 256 + byte, sign * (number[target] + 1), before))
            before += counts[target]
    rows.sort()
    outputs = [words[w] for w in ordered]
    flat = np.array([i for ids in outputs for i in ids], dtype="<u4")
    columns = list(zip(*rows)) or [(), (), ()]
    return b"".join(
        (
            np.array([len(rows), len(ordered), len(flat), 0], "<i8").tobytes(),
            np.array(columns[0], "<i8").tobytes(),
            np.array(columns[1], "<i4").tobytes(),
            np.array(columns[2], "<i4").tobytes(),
            np.cumsum([0, *map(len, outputs)]).astype("<i4").tobytes(),
            flat.tobytes(),
        )
    )
