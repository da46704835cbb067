"""Minimal acyclic transducer: words to numbers, with shared prefixes and suffixes.

Built from sorted words by incremental minimisation. Each transition carries
the number of words that come before it; their sum along a path is the word's
number, and the number leads to its ids. The whole lies in one flat array, so
tasks map the file into memory and share its pages.
"""

from __future__ import annotations

import io

import numpy as np

_MAGIC = 20_260_101


def compile_lexicon(words: list[bytes], ids: list[list[int]]) -> np.ndarray:
    """One int64 array of the transducer of ``words`` (sorted, distinct, not empty) and their ids."""
    finals: list[bool] = [False]
    edges: list[dict[int, int]] = [{}]
    register: dict[tuple, int] = {}
    path = [0]  # states along the last word
    last = b""

    def freeze(down_to: int) -> None:
        while len(path) - 1 > down_to:
            state, char = path.pop(), last[len(path) - 1]
            shape = (finals[state], tuple(edges[state].items()))
            edges[path[-1]][char] = register.setdefault(shape, state)

    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        freeze(common)
        for char in word[common:]:
            finals.append(False)
            edges.append({})
            edges[path[-1]][char] = len(edges) - 1
            path.append(len(edges) - 1)
        finals[path[-1]] = True
        last = word
    freeze(0)

    reached, stack, order = {0}, [0], []
    while stack:  # reachable states
        s = stack.pop()
        order.append(s)
        for t in edges[s].values():
            if t not in reached:
                reached.add(t)
                stack.append(t)
    below: dict[int, int] = {}
    for root in order:
        todo = [root]
        while todo:
            s = todo[-1]
            missing = [t for t in edges[s].values() if t not in below]
            if missing:
                todo.extend(missing)
                continue
            todo.pop()
            below[s] = int(finals[s]) + sum(below[t] for t in edges[s].values())
    new = {s: i for i, s in enumerate(order)}
    keys, targets, outputs = [], [], []
    for s in order:
        ahead = int(finals[s])
        for char, t in sorted(edges[s].items()):
            keys.append(new[s] * 256 + char)
            targets.append(new[t])
            outputs.append(ahead)
            ahead += below[t]
    keys_, targets_, outputs_ = (np.array(x, np.int64) for x in (keys, targets, outputs))
    by = np.argsort(keys_)
    final = np.array([finals[s] for s in order], np.int64)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int64)
    flat = np.array([i for x in ids for i in x], np.int64)
    head = np.array([_MAGIC, len(keys_), len(final), len(words), len(flat), max(map(len, words), default=0)], np.int64)
    return np.concatenate((head, keys_[by], targets_[by], outputs_[by], final, offsets, flat))


class Transducer:
    """Looks many words up at once in a (memory-mapped) compiled lexicon."""

    def __init__(self, flat: np.ndarray) -> None:
        magic, edges, states, words, ids, self.longest = (int(x) for x in flat[:6])
        if magic != _MAGIC:
            raise ValueError("no lexicon")
        ends = 6 + np.cumsum([edges, edges, edges, states, words + 1, ids])
        self.keys, self.targets, self.outputs, self.final, self.offsets, self.ids = (flat[b - n : b] for b, n in zip(ends, (edges, edges, edges, states, words + 1, ids), strict=True))
        self.states = states

    @classmethod
    def load(cls, path: str) -> Transducer:
        return cls(np.load(path, mmap_mode="r"))

    def find(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the words, -1 for words that aren't in the lexicon."""
        sizes = np.array([len(w) for w in words], np.int64)
        number = np.full(len(words), -1, np.int64)
        if not len(self.keys):
            return number
        text = np.frombuffer(b"".join(words), np.uint8)
        at = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        live = np.flatnonzero((sizes > 0) & (sizes <= self.longest))
        state, total = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64)
        for step in range(self.longest):
            if not len(live):
                break
            key = state * 256 + text[at[live] + step]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[edge] == key
            live, edge = live[there], edge[there]
            state, total = self.targets[edge], total[there] + self.outputs[edge]
            ended = sizes[live] == step + 1
            done = ended & (self.final[state] == 1)
            number[live[done]] = total[done]
            live, state, total = live[~ended], state[~ended], total[~ended]
        return number


def to_bytes(flat: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, flat)
    return out.getvalue()
