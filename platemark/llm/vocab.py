"""Public byte-level vocabularies: ranks, the splitting pattern, exact merges."""

from __future__ import annotations

import base64
import heapq
import os
from functools import lru_cache

import regex

#: Folder of the vocabulary files; the environment may name another.
FOLDER = os.environ.get("PLATEMARK_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE_50K = "byte_bpe_50k.tiktoken"
#: White space as the pattern means it (fixed values; the regex module's own class has four control characters more).
_WS = r"\t-\r \x85\xa0  -     　"
#: The public pattern of the vocabulary (fixed value) with white space spelled out.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"


def vocabulary_path(name: str = BYTE_BPE_50K, folder: str | None = None) -> str:
    return os.path.join(folder or FOLDER, name)


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ids, from a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=1)
def splitter() -> regex.Pattern:
    return regex.compile(PATTERN)


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: always merges the leftmost pair of the lowest rank, exactly, in O(n log n)."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    if n < 2:
        return [ranks[word]] if n else []
    end = list(range(1, n + 1))  # of the part that begins here
    after = list(range(1, n)) + [-1]
    before = [-1, *range(n - 1)]
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j < 0 or end[j] != stop:
            continue
        end[i], after[i], alive[j] = stop, after[j], False
        if after[j] >= 0:
            k = after[j]
            before[k] = i
            if (r := ranks.get(word[i : end[k]])) is not None:
                heapq.heappush(heap, (r, i, end[k]))
        p = before[i]
        if p >= 0 and (r := ranks.get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i >= 0:
        out.append(ranks[word[i : end[i]]])
        i = after[i]
    return out
