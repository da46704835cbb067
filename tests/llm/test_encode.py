import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from platemark.llm import encode, vocab
from platemark.llm.transducer import Transducer, compile_lexicon


@pytest.fixture(scope="module")
def public(ranks):
    tiktoken = pytest.importorskip("tiktoken")
    plain = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("own", pat_str=plain, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def lists(encoder, texts):
    offsets, ids = encoder(texts)
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)]


TEXTS = [None, "", " ", "  \n\t ", "hello hello", "<|endoftext|> is text", "it's we'll 'S", "日本語のテキスト 漢字", "🚲🚧 x\u200by", "a\u0301 é", "\x00\x1c\x1f\x85\xa0\u2028", "x" * 50_000, " " * 3000 + "y", "'" * 999, "1" * 777, "\U0010ffff\ue000"]


def test_equals_the_public_encoder(ranks, public):
    assert lists(encode.Encoder(ranks), TEXTS) == [public(t or "") for t in TEXTS]


def test_the_lexicon_changes_nothing(ranks, public):
    words = sorted({w.encode() for t in TEXTS if t for w in vocab.splitter().findall(t) if len(w) < 40})
    lexicon = Transducer(compile_lexicon(words[::2], [vocab.merge(w, ranks) for w in words[::2]]))
    assert lists(encode.Encoder(ranks, lexicon), TEXTS) == [public(t or "") for t in TEXTS]


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60))
def test_any_text(ranks, public, text):
    assert lists(encode.Encoder(ranks), [text]) == [public(text)]


def test_transducer_is_exact_and_shares_suffixes():
    rng = random.Random(2)
    words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 7))) for _ in range(400)} | {b"walking", b"talking", b"stalking"})
    t = Transducer(compile_lexicon(words, [[i, i] for i in range(len(words))]))
    assert t.find(words).tolist() == list(range(len(words)))
    others = [w + b"d" for w in words] + [b"", b"zz", b"walkin", b"\xff" * 99]
    assert set(t.find(others).tolist()) == {-1}
    assert t.ids[t.offsets[5] : t.offsets[6]].tolist() == [5, 5]
    assert Transducer(compile_lexicon([b"walking", b"talking"][::-1], [[1], [2]])).states == 8
    assert Transducer(compile_lexicon([], [])).find([b"a", b""]).tolist() == [-1, -1]


def test_tables(spark, ranks, public):
    rows = [(i, t, "x", [1]) for i, t in enumerate(TEXTS)] + [(4, "hello hello", "y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, t string, ids array<int>")
    got = sorted((r.doc_id, r.ids) for r in encode.encode_corpus(df, "doc_id", "text").collect())
    assert got == sorted((i, public(t or "")) for i, t, *_ in rows)
    assert encode.encode_corpus(df.limit(0), "doc_id", "text").count() == 0


def test_words_of_all_texts_are_counted(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, None), (3, "a b a"), (4, "")], "doc_id long, text string")
    assert {(r.word, r.n) for r in encode.word_counts(df, "text").collect()} == {("a", 2), (" b", 2), (" a", 2)}


def test_counts_equal_the_encoders_own_splitting(spark):
    texts = ["It's a déjà vu,\u00a0isn't it?  1234 \r\n\t 漢字 かな 한국어 🚲🚲 x\u0085y \u3000", "über  \n\n ÀB c9d", "", " "]
    own = Counter(w for t in texts for w in vocab.splitter().findall(t))
    assert {r.word: r.n for r in encode.word_counts(spark.createDataFrame([(t,) for t in texts], "text string"), "text").collect()} == own


def test_long_texts_are_counted_in_stretches(spark, monkeypatch, ranks):
    monkeypatch.setattr(encode, "STRETCH", 10)
    text = "abc de fgh " * 20
    df = spark.createDataFrame([(1, text), (2, "tiny")], "doc_id long, text string")
    assert sum(len(r.word) * r.n for r in encode.word_counts(df, "text").collect()) == len(text) + 4
    assert {r.doc_id: r.ids for r in encode.encode_corpus(df, "doc_id", "text").collect()}[1] == encode.Encoder(ranks)([text])[1].tolist()


def test_spans():
    assert encode._spans(np.array([5, 9, 2]), np.array([2, 0, 3])).tolist() == [5, 6, 2, 3, 4]
