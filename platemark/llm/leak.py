"""Evaluation texts in training text.

Each task builds FM-indexes over shards of its documents: words become
symbols (those no evaluation item has share one), a shard's words one
sequence. Every phrase of SEED words of every item is searched backward in
it, through wavelet-tree ranks; sampled suffix positions give the places. A
document and item with too few places to hold a passage are left; around each
place of the others an alignment finds the best passage over single changed,
missing or added words. Spans that overlap are merged per document and item.

The evaluation items are the stated query set; their compiled form is sent to
all tasks, in blocks of a bounded size. Documents never move: no shuffle, no
join, and what a task holds at once is one shard.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platemark.llm.fmindex import FMIndex

#: A passage spans at least so many words of the item; of its words and edits at least this share are unchanged words.
PASSAGE, UNCHANGED = 14, 0.8
#: An edit takes back as many matches as that share asks for (0.8: four), so a passage scores at least 0.
EDIT = round(UNCHANGED / (1 - UNCHANGED))
#: Words of a search phrase.
SEED = 3
#: Least matches of a passage, and least phrases among them: m matches with e <= m / 4 edits form at most e + 1 runs,
#: which hold m - (SEED - 1) * (e + 1) phrases or more.
LEAST_MATCHES, LEAST_PHRASES = 12, 4
#: How an alignment goes on from a matched pair: to the next words, or over a changed, a missing or an added word.
STEPS = ((1, 1, 0), (2, 2, 1), (2, 1, 1), (1, 2, 1))
#: Words of a shard; a longer document is a shard of its own.
SHARD = 1_000_000
#: Characters of items that are searched for at once; more are taken in blocks, one pass over the documents each.
BLOCK_CHARS = 20_000_000
BREAK, OTHER = 1, 2  # between documents; any word no item has

#: Markup that separates words and is none itself (fixed values); a square tag's value ends at the next bracket of its line.
_TAG = re.compile(r"<[/!]?[a-zA-Z][^<>]*+>")
_BB = re.compile(
    r"\[/?(?:b|i|u|s|url|img|size|color|colour|quote|list|code|font|center|left|right|spoiler|table|tr|td|th|hr|email|sup|sub|li|ul|ol|\*)([=\]])",
    re.IGNORECASE,
)
_ENDS_TAG = re.compile(r"[\]\n]")
_WORDS = re.compile(r"[^\W_]+")
_ENTITY = re.compile(r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,30});")
#: UTF-8 read as Latin-1 or Windows-1252: two or three such characters in a row.
_MOJIBAKE = re.compile("[Â-ß][\u0080-¿ŒœŠšŸŽžƒˆ˜–-•…‰‹›€™]|[à-ï][\u0080-¿ŒœŠšŸŽžƒˆ˜–-•…‰‹›€™]{2}")

_HARD = re.compile(f"&amp;{_ENTITY.pattern[1:]}|{_ENTITY.pattern}|{_MOJIBAKE.pattern}")


def _repair(m: re.Match) -> str:
    """The character that UTF-8 bytes stand for which were read as single-byte characters; else as it is."""
    raw = bytearray()
    for c in m[0]:
        try:
            raw += c.encode("cp1252")
        except UnicodeEncodeError:
            raw += c.encode("latin-1", "replace")
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return m[0]


def without_markup(text: str) -> str:
    """The text with blanks where it had tags; every other character stays in its place. Linear in the text."""
    if "<" in text:
        text = _TAG.sub(lambda m: " " * len(m[0]), text)
    if "[" not in text:
        return text
    out, last, end = [], 0, -1
    for m in _BB.finditer(text):
        if m.start() < last:
            continue
        stop = m.end()
        if m[1] == "=":
            if end < m.end():
                close = _ENDS_TAG.search(text, m.end())
                end = close.start() if close else len(text)
            if text[end : end + 1] != "]":
                continue
            stop = end + 1
        out += [text[last : m.start()], " " * (stop - m.start())]
        last = stop
    return "".join([*out, text[last:]])


def _resolved(m: re.Match) -> str:
    return html.unescape(html.unescape(m[0])) if m[0][0] == "&" else _repair(m)


class _WithoutMarks(dict):
    """For ``str.translate``: takes out accents that stand alone and invisible characters; each is looked up once."""

    def __missing__(self, code: int) -> int | None:
        kept = self[code] = None if unicodedata.category(chr(code)) in ("Cf", "Mn") else code
        return kept


_NO_MARKS = _WithoutMarks()


def words_of(text: str) -> list[str]:
    """Folded words: no case, accents, markup, entities, mojibake or invisible characters."""
    if not text.isascii() or "&" in text:
        text = _HARD.sub(_resolved, text)
        if not text.isascii():
            # Accents are taken off the whole text at once; what words are made of stays in place.
            text = unicodedata.normalize("NFKD", text).translate(_NO_MARKS)
    return _WORDS.findall(without_markup(text).casefold())


def places_of(text: str) -> list[tuple[int, int]]:
    """Begin and end in ``text`` of each word of ``words_of(text)``."""
    out: list[str] = []
    begin: list[int] = []
    end: list[int] = []

    def put(piece: str, start: int, stop: int) -> None:
        """``piece`` came from text[start:stop], character by character if it is as long."""
        same = len(piece) == stop - start
        for i, c in enumerate(piece):
            for d in unicodedata.normalize("NFKD", c).translate(_NO_MARKS):
                out.append(d)
                begin.append(start + i if same else start)
                end.append(start + i + 1 if same else stop)

    last = 0
    for m in _HARD.finditer(text):
        put(text[last : m.start()], last, m.start())
        put(_resolved(m), m.start(), m.end())
        last = m.end()
    put(text[last:], last, len(text))
    return [(begin[m.start()], end[m.end() - 1]) for m in _WORDS.finditer(without_markup("".join(out)))]


class Items:
    """Evaluation items as symbols, with all their search phrases and where each stands."""

    def __init__(self, rows: list[tuple[object, str | None]]) -> None:
        self.symbol: dict[str, int] = {}
        self.ids: list = []
        self.words: list[list[int]] = []
        for item, text in rows:
            words = [self.symbol.setdefault(w, len(self.symbol) + 3) for w in words_of(text or "")]
            if len(words) >= PASSAGE:
                self.ids.append(item)
                self.words.append(words)
        self.symbols = len(self.symbol) + 3
        seeds: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for n, words in enumerate(self.words):
            for i in range(len(words) - SEED + 1):
                seeds.setdefault(tuple(words[i : i + SEED]), []).append((n, i))
        self.phrases = np.array(list(seeds), np.int64).reshape(-1, SEED)
        self.first = np.concatenate(([0], np.cumsum([len(p) for p in seeds.values()]))).astype(np.int64)
        places = np.array([p for of in seeds.values() for p in of], np.int64).reshape(-1, 2)
        self.item, self.at = places[:, 0], places[:, 1]


Cell = tuple[int, int]


def _reach(item: list[int], doc: list[int], cell: Cell, step: int) -> dict[Cell, tuple[int, int, Cell | None]]:
    """Matched pairs an alignment can reach from ``cell`` on, in the direction of ``step``.

    Each with the best (matches, edits), counted without ``cell``, and the
    pair before it. Rows follow one another, so every pair is final when its
    successors are reached.
    """
    n, m = len(item), len(doc)
    best: dict[Cell, tuple[int, int, Cell | None]] = {cell: (0, 0, None)}
    rows: dict[int, list[int]] = {cell[0]: [cell[1]]}
    i = cell[0]
    while i in rows or i + step in rows:
        for j in sorted(rows.get(i, ()), reverse=step < 0):
            matches, edits, _ = best[i, j]
            for di, dj, edit in STEPS:
                a, b = i + step * di, j + step * dj
                if 0 <= a < n and 0 <= b < m and item[a] == doc[b]:
                    known = best.get((a, b))
                    if known is None:
                        rows.setdefault(a, []).append(b)
                    if known is None or (matches + 1 - EDIT * (edits + edit), matches) > (known[0] - EDIT * known[1], known[0] - 1):
                        best[a, b] = (matches + 1, edits + edit, (i, j))
        i += step
    return best


def passage_at(item: list[int], doc: list[int], cell: Cell) -> list[Cell] | None:
    """The matched pairs of the best passage through the matched pair ``cell``; None if there is none.

    A passage spans PASSAGE words of the item or more and scores at least 0
    (a match counts 1, an edit -EDIT). The one with the most matches less two
    per edit is preferred, if that is one.
    """
    sides = [_reach(item, doc, cell, -1), _reach(item, doc, cell, 1)]

    def good(left: Cell, right: Cell) -> bool:
        (m1, e1, _), (m2, e2, _) = sides[0][left], sides[1][right]
        return right[0] - left[0] + 1 >= PASSAGE and m1 + m2 + 1 >= EDIT * (e1 + e2)

    ends = None
    for cost in (2, EDIT):
        pair = [max(side, key=lambda c: (side[c][0] - cost * side[c][1], abs(c[0] - cell[0]))) for side in sides]  # noqa: B023
        if good(*pair):
            ends = pair
            break
    if ends is None:  # the best score is of too few words: for each left end the best right end that is far enough
        right = sorted(sides[1], key=lambda c: c[0])
        best = list(right)
        for k in range(len(best) - 2, -1, -1):
            a, b = best[k], best[k + 1]
            if sides[1][b][0] - EDIT * sides[1][b][1] > sides[1][a][0] - EDIT * sides[1][a][1]:
                best[k] = b
        first = [c[0] for c in right]
        for left in sides[0]:
            k = bisect_left(first, left[0] + PASSAGE - 1)
            if k < len(best) and good(left, best[k]):
                ends = [left, best[k]]
                break
    if ends is None:
        return None
    pairs: list[Cell] = []
    for side, end in zip(sides, ends, strict=True):
        c: Cell | None = end
        while c is not None:
            pairs.append(c)
            c = side[c][2]
    return sorted(set(pairs))


def shard_hits(docs: list[list[int]], items: Items) -> dict[tuple[int, int], list[list[int]]]:
    """(document, item) to its passages: the places in the document of each one's matched words."""
    sizes = np.array([len(d) + 1 for d in docs], np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    text = np.full(int(sizes.sum()), BREAK, np.int64)
    for b, d in zip(begin, docs, strict=True):
        text[b : b + len(d)] = d
    if not len(items.phrases) or not len(text):
        return {}
    # Only words of items in runs of a phrase's length can be found: the index is over these, a break after each run.
    turns = np.flatnonzero(np.diff(np.concatenate(([False], text > OTHER)).astype(np.int8)))
    first, stop = turns[::2], turns[1::2]  # every document ends with a break, so every run ends
    first, stop = first[stop - first >= SEED], stop[stop - first >= SEED]
    size = stop - first + 1
    kept = np.repeat(first - np.concatenate(([0], np.cumsum(size)))[:-1], size) + np.arange(int(size.sum()))
    if not len(kept):
        return {}
    runs = text[kept]
    runs[np.cumsum(size) - 1] = BREAK
    index = FMIndex(runs, items.symbols)
    low, high = index.search(items.phrases)
    hit = np.flatnonzero(high > low)
    count = (high - low)[hit]
    rows = np.repeat(low[hit] - np.concatenate(([0], np.cumsum(count)))[:-1], count) + np.arange(int(count.sum()))
    where, phrase = kept[index.locate(rows)], np.repeat(hit, count)
    doc = np.searchsorted(begin, where, "right") - 1
    # Each occurrence stands for every place of its phrase in the items.
    many = items.first[phrase + 1] - items.first[phrase]
    each = np.repeat(np.arange(len(phrase)), many)
    place = np.repeat(items.first[phrase] - np.concatenate(([0], np.cumsum(many)))[:-1], many) + np.arange(int(many.sum()))
    doc, word, item, at = doc[each], (where - begin[doc])[each], items.item[place], items.at[place]
    pair = doc * len(items.words) + item
    _, number, hits = np.unique(pair, return_inverse=True, return_counts=True)
    enough = np.flatnonzero(hits[number] >= LEAST_PHRASES)
    enough = enough[np.lexsort((at[enough], word[enough], pair[enough]))]
    found: dict[tuple[int, int], list[list[int]]] = {}
    now, known = None, set()
    for d, n, i, w in zip(doc[enough].tolist(), item[enough].tolist(), at[enough].tolist(), word[enough].tolist(), strict=True):
        if (d, n) != now:
            now, known = (d, n), set()
        if (i, w) in known:  # inside a passage that is found already
            continue
        pairs = passage_at(items.words[n], docs[d], (i, w))
        if pairs:
            known.update(pairs)
            found.setdefault((d, n), []).append([j for _, j in pairs])
    return found


def merged(passages: list[list[int]]) -> list[tuple[int, int, int]]:
    """(first, last, matched) of passages, overlapping and adjoining ones as one; each word of a document counts once."""
    out: list[tuple[int, int, set[int]]] = []
    for words in sorted(passages, key=lambda p: (p[0], p[-1])):
        if out and words[0] <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(words[-1], out[-1][1]), out[-1][2] | set(words))
        else:
            out.append((words[0], words[-1], set(words)))
    return [(first, last, len(matched)) for first, last, matched in out]


def leaked_passages(df: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str) -> DataFrame:
    """(``key``, ``item_key``, first_word, last_word, matched, start_char, end_char): each merged passage of an item in a document.

    The characters start_char to end_char (0-based, end excluded) of the text
    are what a removal takes out. Words are compared without case, accents,
    punctuation, markup and invisible characters. Null, empty and blank texts
    hold nothing; items of fewer than PASSAGE words have no passage. Repeated
    documents are reported each, repeated items as well. Texts of any length
    are searched whole. Items of more than BLOCK_CHARS characters in all are
    searched for in as many blocks. Empty tables give an empty result; other
    columns are not read.
    """
    blocks = (items.agg(F.sum(F.length(item_text))).first()[0] or 0) // BLOCK_CHARS + 1
    block = F.pmod(F.xxhash64(item_key, item_text), F.lit(blocks))
    parts = [_passages_of(df, key, text, items.filter(block == b), item_key, item_text) for b in range(blocks)]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _passages_of(df: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str) -> DataFrame:
    rows = sorted((tuple(r) for r in items.select(item_key, item_text).collect()), key=lambda r: (str(r[0]), r[1] or ""))
    shared = df.sparkSession.sparkContext.broadcast(Items(rows))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        ids: list = []
        texts: list[str] = []
        docs: list[list[int]] = []
        size = 0

        def flush() -> Iterator[pd.DataFrame]:
            out, spot = [], {}
            for (d, n), passages in shard_hits(docs, known).items():
                if d not in spot:
                    spot[d] = places_of(texts[d])
                for first, last, matched in merged(passages):
                    out.append((ids[d], known.ids[n], first, last, matched, spot[d][first][0], spot[d][last][1]))
            if out:
                yield pd.DataFrame(out, columns=["id", "item", "first_word", "last_word", "matched", "start_char", "end_char"])

        symbol = known.symbol.get
        for batch in batches:
            for i, t in zip(batch["id"], batch["t"], strict=True):
                words = [symbol(w, OTHER) for w in words_of(t)]
                if len(words) < LEAST_MATCHES:
                    continue
                ids.append(i)
                texts.append(t)
                docs.append(words)
                size += len(words)
                if size >= SHARD:
                    yield from flush()
                    ids, texts, docs, size = [], [], [], 0
        if docs:
            yield from flush()

    kinds = dict(df.dtypes)[key], dict(items.dtypes)[item_key]
    documents = df.select(F.col(key).alias("id"), F.col(text).alias("t")).filter(F.col("t") != "")
    out = documents.mapInPandas(run, f"id {kinds[0]}, item {kinds[1]}, first_word int, last_word int, matched int, start_char bigint, end_char bigint")
    return out.toDF(key, item_key, "first_word", "last_word", "matched", "start_char", "end_char")


def leaks(passages: DataFrame, key: str, item_key: str) -> DataFrame:
    """(``key``, ``item_key``), once for each document and item."""
    return passages.select(key, item_key).distinct()
