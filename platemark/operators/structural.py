"""Structural index of JSON texts: bitmaps, depths by prefix sums, spans.

A batch of texts is one byte array. Bitmaps of quotes (less the escaped ones),
brackets and delimiters give the tokens; the parity of the quotes tells what
is inside a string; prefix sums of the brackets give every token's depth; a
search in (depth, position) order gives its container, the container's commas
before it its place. Which texts are complete JSON is decided by the same
arrays. All of it runs over the whole batch at once; spans come out as Arrow
arrays, gathered in one go. Python only touches strings with escapes.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

OBJ, ARR, END_OBJ, END_ARR, COLON, COMMA, STR, SCALAR, KEY = range(9)
LITERAL = r"^(?:true|false|null|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)$"
_KIND = np.full(256, SCALAR, np.int8)
for _char, _kind in zip(b'{[}]:,"', (OBJ, ARR, END_OBJ, END_ARR, COLON, COMMA, STR), strict=True):
    _KIND[_char] = _kind
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\r\n")] = True
_STRUCTURE = np.zeros(256, bool)
_STRUCTURE[list(b"{}[]:,")] = True
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdefABCDEF")] = True
_ESCAPE = np.zeros(256, bool)
_ESCAPE[list(b'"\\/bfnrtu')] = True


class StructuralIndex:
    """Tokens of many JSON texts.

    For token i: ``kind``, ``doc``, ``level`` (of the container it lies in),
    ``start`` and ``stop`` of its bytes, ``parent`` (token of its container,
    -1 at the top), ``place`` (0-based, among the container's members) and
    ``key`` (number of its key in ``wanted``, -1 if none of them). ``value``
    marks tokens that begin a value of a complete text, ``ok`` the complete
    texts. Of members of one object with the same wanted key the last counts.
    """

    def __init__(self, texts: list[bytes], wanted: list[bytes]) -> None:
        sizes = np.array([len(t) for t in texts], np.int64)
        self.bytes = b"\n".join(texts) + b"\n"
        buf = self.buf = np.frombuffer(self.bytes, np.uint8)
        n, docs = len(buf), len(texts)
        begin = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
        small = np.int32 if n < 2**31 - 1 else np.int64  # of arrays as long as the texts
        doc_of = np.repeat(np.arange(docs, dtype=small), sizes + 1)
        at = np.arange(n, dtype=small)

        slash = buf == 92
        last_other = np.maximum.accumulate(np.where(slash, small(-1), at))
        escaped = np.zeros(n, bool)
        escaped[1:] = (at - last_other)[:-1] & 1  # an odd number of backslashes just before
        del at, last_other
        quote = (buf == 34) & ~escaped
        count = np.cumsum(quote, dtype=small)
        before = np.concatenate(([0], count))[begin]
        inside = (count - before.astype(small)[doc_of]) & 1 == 1  # from an opening quote to before the closing one
        within = inside & ~quote
        ok = ~np.bincount(doc_of[(buf < 32) & within], minlength=docs).astype(bool)
        ok &= (np.concatenate(([0], count))[begin + sizes] - before) % 2 == 0
        ok &= ~np.bincount(doc_of[escaped & within & ~_ESCAPE[buf]], minlength=docs).astype(bool)
        unicode_at = np.flatnonzero(escaped & within & (buf == 117))
        for step in (1, 2, 3, 4):
            there = np.minimum(unicode_at + step, n - 1)
            ok &= ~np.bincount(doc_of[unicode_at[~_HEX[buf[there]]]], minlength=docs).astype(bool)

        outside = ~inside & ~quote
        structure = outside & _STRUCTURE[buf]
        scalar = outside & ~structure & ~_SPACE[buf]
        first = scalar & ~np.concatenate(([False], scalar[:-1]))
        opening = quote & inside
        start = self.start = np.flatnonzero(structure | first | opening)
        kind = self.kind = np.where(scalar[start], SCALAR, _KIND[buf[start]]).astype(np.int8)
        doc = self.doc = doc_of[start]
        m = len(start)

        stop = start + 1
        closing = np.flatnonzero(quote & ~inside)
        if not m:  # nothing but white space: no text is complete
            self.level, self.parent, self.place, self.key, self.lists = (np.zeros(0, np.int64) for _ in range(5))
            self.stop, self.value, self.ok, self.slashes = stop, np.zeros(0, bool), np.zeros(docs, bool), np.zeros(n + 1, np.int64)
            return
        strings = np.flatnonzero(kind == STR)
        stop[strings] = closing[np.minimum(np.searchsorted(closing, start[strings]), max(len(closing) - 1, 0))] + 1 if len(closing) else start[strings] + 1
        last = np.flatnonzero(scalar & ~np.concatenate((scalar[1:], [False])))
        scalars = np.flatnonzero(kind == SCALAR)
        stop[scalars] = last[np.searchsorted(last, start[scalars])] + 1
        self.stop = stop

        opens, closes = (kind == OBJ) | (kind == ARR), (kind == END_OBJ) | (kind == END_ARR)
        step = opens.astype(np.int64) - closes
        depth = np.cumsum(step)
        first_token = np.searchsorted(start, begin)
        base = np.concatenate(([0], depth))[first_token]
        level = self.level = depth - base[doc] - opens
        ends = np.concatenate(([0], depth))[np.searchsorted(start, begin + sizes)] - base
        ok &= (ends == 0) & ~np.bincount(doc[level < 0], minlength=docs).astype(bool)

        order = np.lexsort((np.arange(m), level, doc))  # by text, depth and position
        nxt = order[1:]
        open_first = opens[order[:-1]]
        wrong = open_first & ((doc[nxt] != doc[order[:-1]]) | (level[nxt] != level[order[:-1]]) | (kind[nxt] != kind[order[:-1]] + 2))
        ok &= ~np.bincount(doc[order[:-1][wrong]], minlength=docs).astype(bool)
        if opens[order[-1]]:
            ok[doc[order[-1]]] = False

        rank = np.arange(m)
        wide = np.int64(m + 1)
        open_keys = np.sort(np.maximum(level[opens], 0) * wide + rank[opens])
        holder = np.maximum(level - 1, 0) * wide + rank
        where = np.searchsorted(open_keys, holder) - 1
        parent = np.where((level > 0) & (where >= 0), open_keys[np.maximum(where, 0)] % wide if len(open_keys) else -1, -1)
        self.parent = parent = parent.astype(np.int64)

        # Grammar: what may follow what, by the container of the gap between.
        prev = np.concatenate(([-1], rank[:-1]))
        new = np.zeros(m, bool)
        new[first_token[first_token < m]] = True
        pk = np.where(new, -1, kind[prev])
        gap = np.where(new, -1, np.where(opens[prev], prev, parent[prev]))
        gap_kind = np.where(gap >= 0, kind[gap], -1)
        is_key = (kind == STR) & (gap_kind == OBJ) & ((pk == OBJ) | (pk == COMMA))
        after_key = np.where(new, False, is_key[prev])
        ended = ((pk == STR) & ~after_key) | (pk == SCALAR) | (pk == END_OBJ) | (pk == END_ARR)
        begins = (kind == OBJ) | (kind == ARR) | (kind == STR) | (kind == SCALAR)
        fine = (pk == -1) & begins
        fine |= (pk == OBJ) & (is_key | (kind == END_OBJ))
        fine |= (pk == ARR) & (begins | (kind == END_ARR))
        fine |= (pk == COLON) & begins
        fine |= (pk == COMMA) & np.where(gap_kind == OBJ, is_key, (gap_kind == ARR) & begins)
        fine |= after_key & (kind == COLON)
        fine |= ended & (gap_kind >= 0) & ((kind == COMMA) | (kind == gap_kind + 2))
        ok &= ~np.bincount(doc[~fine], minlength=docs).astype(bool)
        has_tokens = np.bincount(doc, minlength=docs) > 0
        final = np.searchsorted(start, begin + sizes) - 1
        ok &= has_tokens
        ok &= ~has_tokens | np.isin(kind[np.maximum(final, 0)], (STR, SCALAR, END_OBJ, END_ARR))
        good = pc.match_substring_regex(self._slices(start[scalars], stop[scalars]), LITERAL).to_numpy(zero_copy_only=False).astype(bool)
        ok[doc[scalars[~good]]] = False
        self.ok = ok

        value = self.value = begins & ~is_key & ok[doc]
        commas = np.sort(np.maximum(level[kind == COMMA], 0) * wide + rank[kind == COMMA])
        self.place = np.searchsorted(commas, np.maximum(level, 0) * wide + rank) - np.searchsorted(commas, np.maximum(level, 0) * wide + np.maximum(parent, 0))

        self.slashes = np.concatenate((np.zeros(1, small), np.cumsum(slash, dtype=small)))
        lists = np.concatenate(([0], np.cumsum((kind == ARR).astype(np.int64) - (kind == END_ARR))))
        self.lists = lists[:-1] - lists[first_token[doc]]
        self.key = np.full(m, -1, np.int64)
        keyed = np.flatnonzero(value & (pk == COLON))
        names = keyed - 2
        length = stop[names] - start[names] - 2
        number = np.full(len(keyed), -1, np.int64)
        for k, w in enumerate(wanted):
            same = length == len(w)
            for j, char in enumerate(w):
                same[same] = buf[start[names[same]] + 1 + j] == char
            number[same] = k
        for i in np.flatnonzero(self._has_escape(names)):
            try:
                number[i] = wanted.index(json.loads(self.bytes[start[names[i]] : stop[names[i]]]).encode("utf-8", "surrogatepass"))
            except ValueError:
                number[i] = -1
        self.key[keyed] = number
        some = np.flatnonzero(self.key >= 0)
        pair = self.parent[some] * len(wanted) + self.key[some]
        _, final_of = np.unique(pair[::-1], return_index=True)
        keep = np.zeros(len(some), bool)
        keep[len(some) - 1 - final_of] = True
        self.key[some[~keep]] = -1

    def _has_escape(self, tokens: np.ndarray) -> np.ndarray:
        return self.slashes[self.stop[tokens]] > self.slashes[self.start[tokens]]

    def _slices(self, begin: np.ndarray, end: np.ndarray, null: np.ndarray | None = None) -> pa.BinaryArray:
        """Bytes begin..end of each pair as one Arrow array."""
        size = np.maximum(end - begin, 0)
        offsets = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])
        valid = None if null is None else pa.py_buffer(np.packbits(~null, bitorder="little").tobytes())
        return pa.Array.from_buffers(pa.large_binary(), len(size), [valid, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.buf[at])])

    def key_text(self, token: int) -> bytes:
        """The name under which an object holds the value ``token``."""
        raw = self.bytes[self.start[token - 2] : self.stop[token - 2]]
        return json.loads(raw).encode("utf-8", "surrogatepass") if b"\\" in raw else raw[1:-1]

    def texts(self, tokens: np.ndarray) -> pa.Array:
        """Texts of strings and scalars; null as null, containers and the token -1 as ''."""
        there = np.maximum(tokens, 0)
        kind = np.where(tokens < 0, OBJ, self.kind[there])
        quoted, plain = kind == STR, kind == SCALAR
        begin, end = self.start[there] + quoted, self.stop[there] - quoted
        null = plain & (self.buf[self.start[there]] == 110)
        out = self._slices(begin, np.where((quoted | plain) & ~null, end, begin), null).cast(pa.large_string())
        hard = quoted & self._has_escape(there)
        if hard.any():
            found = [json.loads(self.bytes[self.start[t] : self.stop[t]]).encode("utf-8", "replace").decode() for t in tokens[hard].tolist()]
            out = pc.replace_with_mask(out, pa.array(hard), pa.array(found, pa.large_string()))
        return out

    def is_null(self, tokens: np.ndarray) -> np.ndarray:
        """Which of the tokens are null."""
        at = self.start[tokens]
        return (self.kind[tokens] == SCALAR) & (self.buf[at] == 110)
