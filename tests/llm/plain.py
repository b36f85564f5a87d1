"""Slow, obvious versions of the operators, for small inputs."""

import collections
import hashlib
import re

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Classes:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(A_TO_Z))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near_classes(texts, k, percent):
    """{id: (set size, smallest id of the class)}"""
    sets, holders = {i: shingles(t, k) for i, t in texts.items()}, collections.defaultdict(list)
    classes = Classes(sets)
    for i in sorted(sets):
        common = collections.Counter()
        for s in sets[i]:
            common.update(holders[s])
            holders[s].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                classes.join(i, j)
    return {i: (len(sets[i]), classes.find(i)) for i in sets}


def repeat_spans(texts, window):
    """{id: covered byte runs}"""
    raw = {i: (t or "").encode() for i, t in texts.items()}
    seen = collections.Counter(b[i : i + window] for b in raw.values() for i in range(len(b) - window + 1))
    out = {}
    for k, b in raw.items():
        spans = []
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + window
                else:
                    spans.append([i, i + window])
        out[k] = [tuple(s) for s in spans]
    return out


def cut_out(raw, spans):
    keep = bytearray(b"\1" * len(raw))
    for a, b in spans:
        keep[a:b] = bytes(b - a)
    return bytes(x for x, k in zip(raw, keep) if k)


def exact_groups(texts):
    """{id: (keep id, size, digest)}"""
    groups = collections.defaultdict(list)
    for i, t in texts.items():
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()].append(i)
    return {i: (min(g), len(g), d) for d, g in groups.items() for i in g}
