"""Minimal acyclic transducer from words to lists of ids, stored as flat arrays that can be memory-mapped."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np

_MAGIC = 0x5A464C58


def compile_lexicon(entries: Iterable[tuple[bytes, Sequence[int]]]) -> bytes:
    """Bytes of the automaton for distinct words (empty ones are left out).

    Words are added in sorted order and each state is merged with an equal finished one as soon as no
    later word can change it, so all words share their suffixes as well as their prefixes. An arc's
    output is the number of words that sort before the ones below it; outputs add up along a path to the
    word's place in the sorted order, which finds its ids. States hold one arc key each per label.
    """
    words = sorted((w, tuple(ids)) for w, ids in dict(entries).items() if w)
    register: dict[tuple, int] = {}
    final: list[int] = []  # per finished state: 1 if a word ends there
    arcs: list[tuple] = []  # per finished state: ((label, target), ...)
    below: list[int] = []  # per finished state: words that end at it or later

    def finish(node: tuple[bool, list]) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(arcs)
            final.append(int(node[0]))
            arcs.append(key[1])
            below.append(int(node[0]) + sum(below[t] for _, t in key[1]))
        return register[key]

    path: list[list] = [[False, []]]  # open states along the previous word: [final, arcs]
    before = b""
    for word, _ in words:
        same = 0
        while same < min(len(word), len(before)) and word[same] == before[same]:
            same += 1
        while len(path) > same + 1:
            done = path.pop()
            path[-1][1].append((before[len(path) - 1], finish((done[0], done[1]))))
        path.extend([False, []] for _ in range(len(word) - same))
        path[-1][0] = True
        before = word
    while len(path) > 1:
        done = path.pop()
        path[-1][1].append((before[len(path) - 1], finish((done[0], done[1]))))
    root = finish((path[0][0], path[0][1]))

    keys, targets, outputs = [], [], []
    for state, out in enumerate(arcs):
        passed = final[state]
        for label, target in out:
            keys.append(state * 256 + label)
            targets.append(target)
            outputs.append(passed)
            passed += below[target]
    ids = np.array([i for _, x in words for i in x], "<u4")
    starts = np.cumsum([0, *(len(x) for _, x in words)])
    head = np.array([_MAGIC, root, len(arcs), len(keys), len(words), len(ids)], "<i8")
    parts = [head, np.array(keys, "<i8"), starts.astype("<i8"), np.array(targets, "<i4"), np.array(outputs, "<i4")]
    parts += [ids, np.array(final, "u1")]
    return b"".join(p.tobytes() for p in parts)


class Lexicon:
    """The compiled automaton, read in place from a file."""

    def __init__(self, path: str):
        data = np.asarray(np.memmap(path, "u1", "r"))  # still the mapped pages, with cheap slices
        magic, self.root, states, n_arcs, n_words, n_ids = (int(x) for x in data[:48].view("<i8"))
        if magic != _MAGIC:
            raise ValueError(f"{path} is no lexicon")
        at = 48

        def part(n: int, kind: str) -> np.ndarray:
            nonlocal at
            size = n * np.dtype(kind).itemsize
            at += size
            return data[at - size : at].view(kind)

        self.keys, self.starts = part(n_arcs, "<i8"), part(n_words + 1, "<i8")
        self.targets, self.outputs = part(n_arcs, "<i4"), part(n_arcs, "<i4")
        self.ids, self.final = part(n_ids, "<u4"), part(states, "u1")
        self._bytes = memoryview(self.ids.view("u1"))

    def find(self, words: Sequence[bytes]) -> list[bytes | None]:
        """Ids (little-endian 32-bit) of each word, None for words that are not in the lexicon.

        All words walk the automaton together, one byte a step, so a step is a few array operations.
        """
        found: list[bytes | None] = [None] * len(words)
        if not len(self.keys) or not words:
            return found
        sizes = np.fromiter(map(len, words), "i8", len(words))
        text = np.frombuffer(b"".join(words), "u1")
        begin = np.cumsum(sizes) - sizes
        live = np.flatnonzero(sizes)
        state, place = np.full(len(live), self.root, "i8"), np.zeros(len(live), "i8")
        step = 0
        while len(live):
            key = state * 256 + text[begin[live] + step]
            arc = np.searchsorted(self.keys, key)
            ok = self.keys[np.minimum(arc, len(self.keys) - 1)] == key
            live, arc, place = live[ok], arc[ok], place[ok]
            state, place = self.targets[arc].astype("i8"), place + self.outputs[arc]
            step += 1
            ends = sizes[live] == step
            hit = ends & (self.final[state] == 1)
            p = place[hit]
            for i, a, b in zip(live[hit].tolist(), (4 * self.starts[p]).tolist(), (4 * self.starts[p + 1]).tolist()):
                found[i] = self._bytes[a:b].tobytes()
            live, state, place = live[~ends], state[~ends], place[~ends]
        return found
