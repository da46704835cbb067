import random

import numpy as np
import pytest

from platemark.llm import leak
from platemark.llm.fmindex import FMIndex, suffix_array

rng = random.Random(11)
VOCABULARY = [f"w{i}" for i in range(400)]
ITEM = [rng.choice(VOCABULARY) for _ in range(40)]
OTHER_ITEM = [rng.choice(VOCABULARY) for _ in range(30)]


@pytest.mark.parametrize("n", [1, 2, 7, 60, 900])
@pytest.mark.parametrize("k", [1, 2, 5])
def test_index_equals_brute_force(n, k):
    text = np.random.default_rng(n * k).integers(1, k + 1, n)
    full = np.concatenate((text, [0]))
    assert suffix_array(full).tolist() == sorted(range(n + 1), key=lambda i: full[i:].tolist())
    index = FMIndex(text, k + 1, sample=4)
    for size in (1, 2, 3):
        if n >= size:
            phrases = np.array([text[i : i + size] for i in range(n - size + 1)][:30])
            for p, low, high in zip(phrases, *index.search(phrases), strict=True):
                assert sorted(index.locate(np.arange(low, high)).tolist()) == [i for i in range(n - size + 1) if (text[i : i + size] == p).all()]


def edited(words, every, kind):
    out = []
    for i, w in enumerate(words):
        if i % every == every - 1:
            out += {"change": ["zzz"], "drop": [], "add": [w, "zzz"]}[kind]
        else:
            out.append(w)
    return out


FILL = ["something", "else", "entirely"] * 9


@pytest.mark.parametrize("passage,leaks", [
    (ITEM, True), (ITEM[:14], True), (ITEM[-14:], True), (ITEM[10:26], True), (ITEM[:11], False), (ITEM[5:13] + ["q"] * 9 + ITEM[20:28], False),
    (edited(ITEM, 9, "change"), True), (edited(ITEM, 9, "drop"), True), (edited(ITEM, 9, "add"), True), (edited(ITEM, 3, "change"), False), (sorted(ITEM), False), (ITEM[::-1], False), ([], False),
])
def test_passages(passage, leaks):
    items = leak.Items([(7, " ".join(ITEM)), (8, " ".join(OTHER_ITEM)), (9, "too short"), (10, None)])
    doc = [items.symbol.get(w, leak.OTHER) for w in FILL + passage + FILL]
    assert (set(leak.shard_hits([doc, []], items)) == {(0, 0)}) is leaks


def found_in(words, items):
    doc = [items.symbol.get(w, leak.OTHER) for w in words]
    return {n for _, n in leak.shard_hits([doc], items)}


@pytest.mark.parametrize("kind", ["change", "drop", "add"])
@pytest.mark.parametrize("at", range(1, 13))
def test_an_edit_at_any_inner_place_of_fourteen_words(kind, at):
    items = leak.Items([(7, " ".join(ITEM))])
    passage = ITEM[12:26]
    passage[at : at + 1] = {"change": ["zzz"], "drop": [], "add": [passage[at], "zzz"]}[kind]
    assert found_in(FILL + passage + FILL, items) == {0}


@pytest.mark.parametrize("edits", [[3, 5], [3, 5, 7], [2, 9, 11, 13]])
def test_edits_one_word_apart(edits):
    items = leak.Items([(7, " ".join(ITEM))])
    passage = ITEM[5:25]
    for i in edits:
        passage[i] = "zzz"
    assert found_in(FILL + passage + FILL, items) == {0}


def test_recall_of_edited_and_precision_on_shuffled_passages():
    r = random.Random(5)
    common = [f"c{i}" for i in range(30)]
    texts = [[r.choice(common) if r.random() < 0.4 else r.choice(VOCABULARY) for _ in range(r.randrange(20, 120))] for _ in range(60)]
    items = leak.Items([(n, " ".join(t)) for n, t in enumerate(texts)])
    planted = found = wrong = 0
    for _ in range(1500):
        n = r.randrange(len(texts))
        size = r.randrange(14, min(60, len(texts[n])) + 1)
        at = r.randrange(len(texts[n]) - size + 1)
        piece = texts[n][at : at + size]
        places = list(range(1, size - 1))
        r.shuffle(places)
        chosen: list[int] = []
        for p in places:
            if len(chosen) < r.uniform(0.01, 0.15) * size and all(abs(p - q) > 1 for q in chosen):
                chosen.append(p)
        if len(chosen) > 0.15 * size:
            chosen.pop()
        words = []
        for i, w in enumerate(piece):
            words += {"change": [r.choice(common + ["zzz"])], "drop": [], "add": [w, r.choice(common)]}[r.choice(["change", "drop", "add"])] if i in chosen else [w]
        noise = [r.choice(common) if r.random() < 0.4 else f"n{r.randrange(900)}" for _ in range(80)]
        planted += 1
        found += n in found_in(noise[:40] + words + noise[40:], items)
        mixed = piece[:]
        r.shuffle(mixed)
        wrong += bool(found_in(noise[:40] + mixed + noise[40:], items))
    assert found >= 0.99 * planted and wrong <= 0.01 * planted


def holds_passage(item, doc):
    """By definition: some path of matched pairs over single edits that spans enough words with few enough edits."""
    best = {}
    for i in range(len(item)):
        for j in range(len(doc)):
            if item[i] != doc[j]:
                continue
            here = {i: 1}  # first item word of the path to its best score
            for di, dj, edit in leak.STEPS:
                for a, score in best.get((i - di, j - dj), {}).items():
                    here[a] = max(here.get(a, -999), score + 1 - leak.EDIT * edit)
            best[i, j] = here
            if any(i - a + 1 >= leak.PASSAGE and score >= 0 for a, score in here.items()):
                return True
    return False


def test_equals_the_definition():
    r = random.Random(3)
    both = 0
    for k in range(600):
        letters = "abcd" if k % 2 else "abcdefghijklmnop"
        item = [r.choice(letters) for _ in range(r.randrange(14, 34))]
        doc = [r.choice(letters) if r.random() < 0.18 else w for w in item[r.randrange(6) :]] if k % 3 else [r.choice(letters) for _ in range(40)]
        items = leak.Items([(1, " ".join(item))])
        expected = holds_passage(item, doc)
        both += expected
        assert (found_in(doc, items) == {0}) == expected, (item, doc)
    assert 100 < both < 500


def test_writing_does_not_matter():
    text = "> <b>Über</b> die&nbsp;Br\u00fccke, [i]sagt[/i] er:\r\n> &quot;caf\u00e9\u200bs&quot; na\u0131ve\u2014Stra\u00dfe caf&eacute; cafÃ© 4&#39;5 x[quote=w.2]y"
    assert leak.words_of(text) == ["uber", "die", "brucke", "sagt", "er", "cafes", "naıve", "strasse", "cafe", "cafe", "4", "5", "x", "y"]
    assert leak.words_of("") == [] and leak.words_of("<br>") == []


def test_markup_of_any_length():
    long = "x" * 5000
    for text in (f"a <a href={long}>b</a> c", f"a [url=http://{long}]b[/url] c", f"a [quote={long} y]b c", "a [url=[i] b [url=\n] c", "a <b b <b> c"):
        words = leak.words_of(text)
        assert words[0] == "a" and words[-1] == "c" and len(leak.places_of(text)) == len(words)
    assert leak.words_of(f"a <a href={long}>b</a> [url={long}]c[/url]") == ["a", "b", "c"]
    assert len(leak.words_of("[url=" * 200_000)) == 200_000  # in linear time
    assert len(leak.words_of("<a " * 200_000)) == 200_000


def test_places_lead_back_to_the_text():
    for text in ("\uff1cb\uff1eq\uff1c/b\uff1e r", "[quote=\u00bd x]y \u00bd[/quote]","a <b>bc</b> d&eacute;f", "x\u200by \u00bd cafÃ© [b]z[/b]", "&amp;quot;q&amp;quot; r", "ﬁne ﬂow ９"):
        places = leak.places_of(text)
        words = leak.words_of(text)
        assert len(places) == len(words)
        assert [leak.words_of(text[a:b])[0] for a, b in places if leak.words_of(text[a:b])][:1] == words[:1]


def test_tables(spark):
    item = " ".join(ITEM)
    rows = [(1, "noise " + item.upper() + " noise", 9), (2, None, 9), (3, "", 9), (4, "short", 9), (5, item + " filler " * 50 + item, 9), (1, "noise " + item.upper() + " noise", 9), (6, "word " * 200_000 + item, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(70, item, 1), (71, item, 1), (72, None, 1)], "item_id long, item_text string, doc_id int")
    passages = leak.leaked_passages(df, "doc_id", "text", items, "item_id", "item_text")
    assert sorted(tuple(r) for r in leak.leaks(passages, "doc_id", "item_id").collect()) == sorted((d, i) for d in (1, 5, 6) for i in (70, 71))
    spans = sorted((r.first_word, r.last_word) for r in passages.filter("doc_id = 5 AND item_id = 70").collect())
    assert spans == [(0, 39), (90, 129)]
    for r in passages.filter("doc_id < 6").collect():
        text = next(t for d, t, _ in rows if d == r.doc_id)
        assert text[r.start_char : r.end_char].casefold() == item.casefold() and r.matched == len(ITEM)
    assert leak.leaked_passages(df.limit(0), "doc_id", "text", items, "item_id", "item_text").count() == 0
    assert leak.leaked_passages(df, "doc_id", "text", items.limit(0), "item_id", "item_text").count() == 0


def test_spans_are_merged():
    assert leak.merged([[5, 6, 9], [0, 4], [20, 21, 30], [22, 25]]) == [(0, 9, 5), (20, 30, 5)]


def test_items_in_blocks_find_the_same(spark, monkeypatch):
    texts = [" ".join(rng.choice(VOCABULARY) for _ in range(20)) for _ in range(9)]
    df = spark.createDataFrame([(i, f"fill {t} fill") for i, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, item_text string")
    monkeypatch.setattr(leak, "BLOCK_CHARS", 300)
    got = leak.leaks(leak.leaked_passages(df, "doc_id", "text", items, "item_id", "item_text"), "doc_id", "item_id").collect()
    assert sorted(tuple(r) for r in got) == [(i, i) for i in range(9)]


def test_small_shards_find_the_same(spark, monkeypatch):
    item = " ".join(ITEM)
    df = spark.createDataFrame([(i, ("fill " * i + item) if i % 3 == 0 else "fill " * 30) for i in range(60)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, item_text string")
    found = lambda: sorted(r.doc_id for r in leak.leaks(leak.leaked_passages(df, "doc_id", "text", items, "item_id", "item_text"), "doc_id", "item_id").collect())
    assert found() == list(range(0, 60, 3))
