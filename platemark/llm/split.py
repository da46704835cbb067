"""Splitting oversized texts at natural boundaries, by lexical cohesion.

A text of more tokens than the limit is cut into consecutive pieces. Where it
can be cut is where a paragraph, a line, a quotation or a sentence ends; how
well, is told by sliding blocks: the similarity of the words before and after
a boundary, whose valleys mark changes of topic. In each window of admissible
sizes the deepest valley is taken; how strong a boundary is (paragraph, line,
sentence) and at last how far it lies only decide between equal depths.
Where a window has none of these the last end of a clause in it is taken, else
the last word boundary, and inside one endless word the last whole character. The next piece
begins the overlap's tokens before the cut.

Every text is handled by itself, so nothing is shuffled; texts of no more
bytes than the limit can't have more tokens and never leave the JVM.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from platemark.llm import vocab

#: Most tokens of a piece, tokens two consecutive pieces share, and least tokens of a piece that a window admits.
LIMIT, OVERLAP, LEAST = 512, 48, 256
#: Words of a block on either side of a boundary.
BLOCK = 40
#: Boundaries whose blocks are compared at once.
AT_ONCE = 256
#: Natural boundaries, weakest first.
NATURAL = ("sentence", "line", "paragraph")
_KIND = {kind: i for i, kind in enumerate(NATURAL)}
PIECES = "piece_no int, start_char bigint, end_char bigint, n_tokens int, n_shared int, cut string, depth double, depth_rank int, n_boundaries int, text string"

#: What ends a paragraph, a line and a sentence; a cut comes after the match.
_ENDS = re.compile(
    r"(?P<paragraph>(?:\r?\n[ \t]*){2,}|(?:<br ?/?>[ \t]*){2,}|</(?:p|blockquote|div|ul|ol|table)>|\[/(?:quote|list|code)\]|<hr ?/?>)"
    r"|(?P<line>\r?\n|<br ?/?>|</li>)"
    r"|(?P<sentence>(?:[.!?…]+|:\))[\"'”’»)\]]*(?=\s)|[。！？]+[」』）]*)",
    re.IGNORECASE,
)
#: Characters one of those can begin with: only there they are tried.
_BEGINS = re.compile(r"[\r\n<\[.!?…:。！？]")
#: What ends a clause (fixed values): tried where a window has no stronger boundary.
CLAUSE = frozenset(",;:|\u3001\uff0c\uff1b\uff1a")
_WORD = re.compile(r"[^\W\d_]+")
_LONG_WORD = re.compile(r"[^\W\d_]{4,}")
_WIDE = re.compile(r"[぀-ヿ㐀-鿿가-힯]")


def _boundaries(text: str) -> list[tuple[int, int]]:
    """(place, kind) of all natural boundaries, as ``_ENDS`` finds them one after the other."""
    found, at = [], 0
    while begin := _BEGINS.search(text, at):
        m = _ENDS.match(text, begin.start())
        if m:
            found.append((m.end(), _KIND[m.lastgroup]))
        at = m.end() if m else begin.end()
    return found


def _terms(text: str, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words that carry meaning, and how many of them stand before each place.

    Words have four letters or more; of scripts without spaces pairs of
    characters are taken. No word goes on over a place.
    """
    wide = not text.isascii() and _WIDE.search(text) is not None
    words: list[str] = []
    before = np.zeros(len(places), np.int64)
    start = 0
    for n, place in enumerate([*places.tolist(), len(text)]):
        if wide:
            for w in _WORD.findall(text, start, place):
                if _WIDE.search(w):
                    words += [w[i : i + 2] for i in range(max(1, len(w) - 1))]
                elif len(w) > 3:
                    words.append(w)
        else:
            words += _LONG_WORD.findall(text, start, place)
        start = place
        if n < len(places):
            before[n] = len(words)
    folded: dict[str, int] = {}
    number = {w: folded.setdefault(unicodedata.normalize("NFKC", w).casefold(), len(folded)) for w in dict.fromkeys(words)}
    return np.fromiter(map(number.__getitem__, words), np.int32, len(words)), before


def cohesion_depths(text: str, places: np.ndarray) -> np.ndarray:
    """Depth of the valley of lexical cohesion at each place: how far similarity rises on both sides of it.

    Similarity is the cosine of the words of the blocks before and after. The
    products of counts are numbers of equal pairs, which are counted for many
    boundaries at once.
    """
    words, at = _terms(text, places)
    # Beyond both ends there are numbers no word has, different in either block.
    padded = np.concatenate((np.full(BLOCK, -1, np.int32), words, np.full(BLOCK, -2, np.int32)))
    blocks = np.lib.stride_tricks.sliding_window_view(padded, BLOCK)
    scores = np.zeros(len(places))
    for first in range(0, len(places), AT_ONCE):
        i = at[first : first + AT_ONCE]
        left, right = blocks[i], blocks[i + BLOCK]
        pairs = lambda a, b: (a[:, :, None] == b[:, None, :]).sum((1, 2), dtype=np.int64)
        of_left = pairs(left, left) - np.maximum(BLOCK - i, 0) ** 2
        of_right = pairs(right, right) - np.maximum(BLOCK - (len(words) - i), 0) ** 2
        norm = np.sqrt((of_left * of_right).astype(float))
        scores[first : first + AT_ONCE] = np.divide(pairs(left, right), norm, out=np.zeros(len(i)), where=norm > 0)
    # The peak reached by climbing left (right) from a place is the neighbour's peak if the neighbour isn't lower.
    level = scores.tolist()
    left_peak, right_peak = level[:], level[:]
    for n in range(1, len(level)):
        if level[n - 1] >= level[n]:
            left_peak[n] = left_peak[n - 1]
    for n in range(len(level) - 2, -1, -1):
        if level[n + 1] >= level[n]:
            right_peak[n] = right_peak[n + 1]
    return np.array(left_peak) + np.array(right_peak) - 2 * scores


class Classes:
    """Which characters are blank, letters or digits, or end a clause; each code point is looked up once."""

    BLANK, WORD, CLAUSE, KNOWN = 1, 2, 4, 8

    def __init__(self) -> None:
        self.of = np.zeros(0x110000, np.uint8)

    def __call__(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        found = self.of[codes]
        if not found.all():
            for code in np.unique(codes[found == 0]).tolist():
                c = chr(code)
                self.of[code] = self.KNOWN | c.isspace() * self.BLANK | c.isalnum() * self.WORD | (c in CLAUSE) * self.CLAUSE
            found = self.of[codes]
        return found


_classes = Classes()


def split_text(text: str, encode: Callable[[str], list[int]], sizes: np.ndarray, limit: int = LIMIT, overlap: int = OVERLAP, least: int = LEAST) -> list[tuple]:
    """Pieces (in the columns of PIECES) of a text over the limit; none of one within it.

    ``sizes`` are the bytes of each token id. ``cut`` tells at what the piece
    ends: paragraph, line, sentence, clause, word, character or end. At the
    first three ``depth`` is the valley's, ``depth_rank`` its place among the
    ``n_boundaries`` valleys of the window (1 the deepest, equal ones alike).
    """
    ids = encode(text)
    if len(ids) <= limit:
        return []
    raw = np.frombuffer(text.encode(), np.uint8)
    begins = (raw & 0xC0) != 0x80  # bytes that begin a character
    edge = np.concatenate(([0], np.cumsum(sizes[np.array(ids)])))  # byte at which token i begins
    edge_char = np.concatenate(([0], np.cumsum(begins)))[edge]  # characters begun before it
    whole = np.append(begins, True)[edge]  # tokens that begin with a character
    classes = _classes(text)
    # Up to any character, how many weren't blank: a stretch is blank if that doesn't change.
    solid = np.concatenate(([0], np.cumsum((classes & Classes.BLANK) == 0)))
    n = len(ids)

    # Natural boundaries, as token edges: right at the cut, or with nothing but white space between.
    found = _boundaries(text)
    natural, strength = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if found:
        ends, kinds = np.array(found, np.int64).T
        after = np.searchsorted(edge_char, ends)
        inside = np.minimum(after, n)
        good = (after < n) & whole[inside] & (solid[edge_char[inside]] == solid[ends])
        before = np.maximum(after - 1, 0)  # the edge before: white space that belongs to the next word
        other = ~good & (before > 0) & whole[before] & (kinds > 0) & (solid[edge_char[before]] == solid[ends])
        edges = np.where(good, after, before)[good | other]
        kinds = kinds[good | other]
        by = np.lexsort((-kinds, edges))
        natural, first = np.unique(edges[by], return_index=True)
        strength = kinds[by][first]
        natural, strength = natural[natural > 0], strength[natural > 0]
    depths = cohesion_depths(text, edge_char[natural])
    inner = np.append((classes & Classes.WORD) > 0, False)
    clause = np.append((classes & Classes.CLAUSE) > 0, False)
    last, here = np.maximum(edge_char - 1, 0), np.minimum(edge_char, len(text))
    starts_word = whole & ~(inner[last] & inner[here])
    starts_clause = whole & clause[last] & ~clause[here]

    def cut_before(start: int, most: int) -> tuple[int, str, float | None, int | None, int | None]:
        for low in (start + least, start + overlap + 1):
            a, b = np.searchsorted(natural, low), np.searchsorted(natural, most, "right")
            if a < b:
                best = a + np.lexsort((natural[a:b], strength[a:b], depths[a:b]))[-1]
                return int(natural[best]), NATURAL[strength[best]], float(depths[best]), int((depths[a:b] > depths[best]).sum()) + 1, int(b - a)
        for good, kind, low in ((starts_clause, "clause", start + least), (starts_word, "word", start + overlap + 1), (whole, "character", start + overlap + 1)):
            there = np.flatnonzero(good[low : most + 1])
            if len(there):
                return int(there[-1]) + low, kind, None, None, None
        return most, "character", None, None, None

    pieces, start, shared = [], 0, 0
    while True:
        most = min(start + limit, n)
        while True:
            stop, *how = (n, "end", None, None, None) if most == n else cut_before(start, most)
            piece = text[edge_char[start] : edge_char[stop]]
            tokens = len(encode(piece))
            if tokens <= limit:
                break
            most = min(most, stop) - max(1, tokens - limit)  # cut elsewhere, its encoding is longer
        pieces.append((len(pieces), int(edge_char[start]), int(edge_char[stop]), tokens, shared, *how, piece))
        if stop == n:
            return pieces
        follow = stop - overlap
        while follow > start and not whole[follow]:
            follow -= 1
        start, shared = (follow, stop - follow) if follow > start else (stop, 0)


def split_oversized(df: DataFrame, key: str, text: str, vocabulary: str | None = None, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(``key``, piece_no, start_char, end_char, n_tokens, n_shared, cut, depth, depth_rank, n_boundaries, text) of every text of more than ``limit`` tokens.

    The pieces cover the text; ``text`` is its characters start_char to
    end_char. ``n_tokens`` is the length of the piece's own encoding and never
    over the limit. Consecutive pieces share ``overlap`` tokens of the text's
    encoding, or as many more as it takes not to cut a character; ``n_shared``
    tells how many a piece shares with the one before. Null, empty,
    blank and small texts give no row (white space counts as tokens like
    anything else); repeated rows give their pieces each; texts of any length
    are split whole. An empty table gives an empty result; other columns are
    not read.
    """
    ranks = vocab.load_ranks(vocabulary or vocab.vocabulary_path())
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encode = tiktoken.Encoding("byte_bpe", pat_str=vocab.PATTERN, mergeable_ranks=shared.value, special_tokens={}).encode_ordinary
        sizes = np.zeros(max(shared.value.values()) + 1, np.int64)
        for token, rank in shared.value.items():
            sizes[rank] = len(token)
        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            rows: list[tuple] = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows += [(i, *piece) for piece in split_text(t, encode, sizes, limit, overlap, min(LEAST, limit // 2))]
                if len(rows) > 2000:
                    yield table(rows)
                    rows = []
            if rows:
                yield table(rows)

    names = ["id", *[c.split()[0] for c in PIECES.split(", ")]]
    kind = dict(df.dtypes)[key]
    large = df.select(F.col(key).alias("id"), F.col(text).alias("t")).filter(F.octet_length("t") > limit)
    schema = to_arrow_schema(T._parse_datatype_string(f"id {kind}, {PIECES}"))
    return large.mapInArrow(run, f"id {kind}, {PIECES}").toDF(key, *names[1:])
