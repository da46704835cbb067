import random
from collections import Counter

import numpy as np
import pytest

from platemark.llm import split, vocab


@pytest.fixture(scope="module")
def tools(ranks):
    tiktoken = pytest.importorskip("tiktoken")
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, sizes


SENTENCE = "The quiet ferry crosses the cold harbour every morning before the market opens. "
TEXTS = [
    SENTENCE * 100, (SENTENCE * 5 + "\n\n") * 30, "x" * 20_000, "漢" * 4000, "🚲" * 3000, " " * 9000, "word " * 4000, "a\n" * 3000, "<p>" + "b c " * 200 + "</p>" * 2 + SENTENCE * 40, "これは文です。" * 600,
]


@pytest.mark.parametrize("n", range(len(TEXTS)))
def test_pieces(tools, n):
    encode, sizes = tools
    text = TEXTS[n]
    pieces = split.split_text(text, encode, sizes)
    assert bool(pieces) == (len(encode(text)) > split.LIMIT)
    if not pieces:
        return
    assert pieces[0][1] == 0 and pieces[-1][2] == len(text) and pieces[-1][5] == "end"
    ids, at = encode(text), np.concatenate(([0], np.cumsum(sizes[np.array(encode(text))])))
    for _, start, end, tokens, *_, piece in pieces:
        assert piece == text[start:end] and tokens == len(encode(piece)) <= split.LIMIT
    assert [p[0] for p in pieces] == list(range(len(pieces)))
    for a, b in zip(pieces, pieces[1:], strict=False):
        assert a[1] < b[1] < a[2] < b[2]
        first, last = np.searchsorted(at, [len(text[: b[1]].encode()), len(text[: a[2]].encode())])
        assert split.OVERLAP <= last - first == b[4] <= split.OVERLAP + 4
    assert len(ids) > split.LIMIT


def test_natural_cuts(tools):
    text = (SENTENCE * 6 + "\n\n") * 20
    assert {p[5] for p in split.split_text(text, *tools)[:-1]} == {"paragraph"}
    assert {p[5] for p in split.split_text(SENTENCE * 200, *tools)[:-1]} == {"sentence"}
    assert {p[5] for p in split.split_text("word " * 4000, *tools)[:-1]} == {"word"}
    assert {p[5] for p in split.split_text("x" * 20_000, *tools)[:-1]} == {"character"}
    assert {p[5] for p in split.split_text("never_ending|line_" * 2000, *tools)[:-1]} == {"clause"}
    assert {p[5] for p in split.split_text("never_ending_line_" * 2000, *tools)[:-1]} == {"word"}


def test_the_deepest_valley_is_taken(tools):
    boats, bread = "Sailors repair wooden boats beside the harbour. ", "Bakers knead fresh dough inside warm kitchens. "
    text = boats * 42 + bread * 60
    assert split.split_text(text, *tools)[0][-1].strip() == (boats * 42).strip()


def plain_depths(text, places):
    """Depths by counting words, one boundary after the other."""
    words, before = split._terms(text, places)
    scores = []
    for i in before.tolist():
        left, right = Counter(words[max(0, i - split.BLOCK) : i].tolist()), Counter(words[i : i + split.BLOCK].tolist())
        norm = sum(v * v for v in left.values()) * sum(v * v for v in right.values())
        scores.append(sum(v * right[t] for t, v in left.items()) / norm**0.5 if norm else 0.0)
    out = []
    for n, s in enumerate(scores):
        a = b = n
        while a > 0 and scores[a - 1] >= scores[a]:
            a -= 1
        while b < len(scores) - 1 and scores[b + 1] >= scores[b]:
            b += 1
        out.append(scores[a] + scores[b] - 2 * s)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_depths_equal_plain_counting(seed):
    rng = random.Random(seed)
    text = " ".join(rng.choice(["alpha", "beta", "gamma", "delta.", "of", "Straße", "文字列です", "12"]) for _ in range(rng.choice([0, 3, 60, 900])))
    places = np.array(sorted(rng.sample(range(len(text) + 1), min(len(text), 300))), np.int64)
    assert split.cohesion_depths(text, places) == pytest.approx(plain_depths(text, places))


def test_a_weaker_boundary_at_a_deeper_valley_wins(tools):
    """A sentence end between two topics beats the paragraph end within one; of equal depths the stronger is taken."""
    boats, bread = "Sailors repair wooden boats beside the harbour. ", "Bakers knead fresh dough inside warm kitchens. "
    text = boats * 36 + "\n\n" + boats * 5 + bread * 60
    first = split.split_text(text, *tools)[0]
    assert first[5] == "sentence" and first[7] == 1 and first[-1].strip().endswith(boats.strip()) and first[-1].count("Sailors") == 41
    assert split.split_text((SENTENCE * 30 + "\n\n") * 3, *tools)[0][5] == "paragraph"


def test_boundaries_are_those_of_the_pattern():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["a", " ", "\n", "\r\n", "\t", ".", "!", "...", ":)", ":", "。", "」", "<br>", "<BR />", "</P>", "</li>", "[/quote]", "[/", "<hr>", '"', ")", "…"]) for _ in range(60))
        assert split._boundaries(text) == [(m.end(), split._KIND[m.lastgroup]) for m in split._ENDS.finditer(text)]


def test_depths():
    assert split.cohesion_depths("", np.zeros(0, np.int64)).tolist() == []
    text = "alpha beta gamma. " * 9 + "delta epsilon zeta. " * 9
    places = [i + 1 for i, c in enumerate(text) if c == "."]
    assert int(np.argmax(split.cohesion_depths(text, np.array(places)))) == 8


def test_limits(tools):
    encode, sizes = tools
    exact = next(t for n in range(400, 600) if len(encode(t := "a " * n)) == 512)
    assert split.split_text(exact, encode, sizes) == []
    assert len(split.split_text(exact + "a ", encode, sizes)) == 2
    assert all(p[3] <= 64 for p in split.split_text(SENTENCE * 50, encode, sizes, limit=64, overlap=8, least=32))


def test_tables(spark, ranks):
    rows = [(1, SENTENCE * 100, 5), (2, None, 5), (3, "", 5), (4, "small", 5), (1, SENTENCE * 100, 5), (5, " " * 2000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece_no int")
    got = split.split_oversized(df, "doc_id", "text")
    count = {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert set(count) == {1, 5} and count[1] % 2 == 0
    assert split.split_oversized(df.limit(0), "doc_id", "text").count() == 0
