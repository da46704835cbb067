import re
import unicodedata
from collections import Counter, defaultdict
from itertools import pairwise

import pytest
import tiktoken
from helpers import FOLDER, connect, rows, sql_rows
from llm.test_leak import holds_passage

from platemark.llm import canonical, leak, queries, split, vocab


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    expected, columns = sql_rows(connect(), queries.oracle_sql()[name])
    df = queries.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == columns and rows(df) == expected


def result(spark, name):
    return queries.queries()[name](spark, FOLDER).collect()


def source(sql):
    con = connect()
    return con.sql(sql).fetchall()


@pytest.fixture(scope="module")
def encode(ranks):
    return tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_p6_equals_the_public_encoder(spark, encode):
    assert {r.doc_id: r.ids for r in result(spark, "p6_ids")} == {d: encode(t or "") for d, t in source("SELECT doc_id, text FROM documents")}


def test_p8_splits_what_is_too_long(spark, encode):
    texts = {d: t for d, t in source("SELECT doc_id, text FROM documents") if len(encode(t or "")) > split.LIMIT}
    assert sorted(r.doc_id for r in result(spark, "p8_found")) == sorted(texts)
    pieces = {}
    for r in sorted(result(spark, "p8_pieces"), key=lambda r: r.piece_no):
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(texts)
    for d, of in pieces.items():
        assert [p.piece_no for p in of] == list(range(len(of)))
        assert all(p.text == texts[d][p.start_char : p.end_char] and p.n_tokens == len(encode(p.text)) <= split.LIMIT for p in of)
        assert of[0].start_char == 0 and of[-1].end_char == len(texts[d]) and all(a.start_char < b.start_char <= a.end_char < b.end_char for a, b in pairwise(of))
    cuts = result(spark, "p8_cuts")
    assert {(r.doc_id, r.piece_no, r.end_char, r.cut) for r in cuts} == {(p.doc_id, p.piece_no, p.end_char, p.cut) for of in pieces.values() for p in of}
    assert all((r.depth_rank == 1) == (r.cut in split.NATURAL) for r in cuts)


def test_p7_equals_the_definition(spark):
    items = {i: leak.words_of(t or "") for i, t in source("SELECT item_id, item_text FROM eval_items")}
    phrases = defaultdict(set)
    for i, words in items.items():
        for k in range(len(words) - 2):
            phrases[tuple(words[k : k + 3])].add(i)
    expected = set()
    for d, t in source("SELECT doc_id, text FROM documents"):
        words = leak.words_of(t or "")
        shared = Counter(i for k in range(len(words) - 2) for i in phrases.get(tuple(words[k : k + 3]), ()))
        expected |= {(d, i) for i, n in shared.items() if n > 1 and holds_passage(items[i], words)}
    assert {tuple(r) for r in result(spark, "p7_found")} == expected and len(expected) > 0
    passages = result(spark, "p7_passages")
    assert {(r.doc_id, r.item_id) for r in passages} == expected
    texts = dict(source("SELECT doc_id, text FROM documents"))
    for r in passages:
        assert len(set(leak.words_of(texts[r.doc_id][r.start_char : r.end_char])) & set(items[r.item_id])) > 0 and r.last_word - r.first_word + 1 >= r.matched >= leak.LEAST_MATCHES
    assert {(r.item_id, r.n_documents) for r in result(spark, "p7_items")} == set(Counter(i for _, i in expected).items())


def meant(value, entries):
    """What a value means, by trying every entry one after the other."""
    words = canonical.plain(value)
    if not words:
        return ""
    names, folded, described, lows = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    for code, description in entries:
        low = code.lower().strip()
        parts = [p for p in canonical.CODE.fullmatch(low).groups() if p]
        for name in (canonical.plain(code), " ".join(parts), " ".join("".join(parts))):
            names[name].add(code)
        folded[canonical.plain(code).replace(" ", "").translate(canonical.LOOK_ALIKE)].add(code)
        lows[low].add(code)
        if description:
            names[canonical.plain(description)].add(code)
            described[frozenset(canonical.plain(description).split())].add(code)
    found = []
    for name, codes in names.items():
        at = f" {words} ".find(f" {name} ")
        while at >= 0:
            before, after = f" {words} "[:at].rsplit(" ", 1)[-1], f" {words} "[at + len(name) + 2 :].split(" ", 1)[0]
            if len(codes) == 1 and (name.replace(" ", "").isalpha() or not (before.isdigit() or after.isdigit())):
                found.append((-len(name), at, 0, next(iter(codes))))
            at = f" {words} ".find(f" {name} ", at + 1)
    closed = words.replace(" ", "")
    alias = folded.get(closed.translate(canonical.LOOK_ALIKE), ())
    if len(alias) == 1 and not closed.isdigit():
        found.append((-len(words), 0, 1, next(iter(alias))))
    if found:
        return min(found)[-1]
    for left_out in (frozenset(), canonical.FILLERS):
        own, best = set(words.split()) - left_out, {}
        vocabulary = {t for d in described for t in d}
        near = {t: {t: 1.0} if t in vocabulary else {o: 0.9 for o in vocabulary if (len(t) > 2 or t.isalpha()) and canonical.one_step(t, o, swap=True)} for t in own}
        for d, codes in described.items():
            gains, used = 0.0, set()
            for _t, of in sorted(near.items(), key=lambda x: -max(x[1].values(), default=0)):
                pair = max(((g, o) for o, g in of.items() if o in d - left_out and o not in used), default=None)
                if pair:
                    gains, used = gains + pair[0], used | {pair[1]}
            for c in codes:
                best[c] = max(best.get(c, 0), gains / (len(own) + len(d - left_out) - len(used)))
        top = max(best.values())
        if top >= canonical.SIMILAR and [*best.values()].count(top) == 1:
            return max(best, key=best.get)
    low = value.lower().strip()
    bare = re.sub(r"[^a-z0-9]+", ".", re.sub(r"[^a-z0-9]+(?=[a-z]|$)|^[^a-z0-9]+|(?<=[a-z])[^a-z0-9]+", "", low))
    if canonical.CODE_LIKE.fullmatch(bare):
        for form in (bare, low):
            codes = {c for other, of in lows.items() for c in of if canonical.one_step(form, other, swap=False)}
            if codes:
                return next(iter(codes)) if len(codes) == 1 else ""
    return ""


def test_p4_equals_trying_every_entry(spark):
    entries = source("SELECT DISTINCT code, description FROM sign_legend")
    rows = [(i, v) for i, v in source("SELECT row_id, code FROM page_4_signs") if v and v.strip()]
    known = {v: meant(unicodedata.normalize("NFKC", v), entries) for v in {v for _, v in rows}}
    got = {r.row_id: r.legend_code for r in result(spark, "p4_found")}
    assert got == {i: known[v] for i, v in rows}
    assert {r.code: r.n_rows for r in result(spark, "p4_unmatched")} == Counter(v for _, v in rows if not known[v])
    steps = {r.step: r.n_rows for r in result(spark, "p4_steps")}
    assert sum(steps.values()) == len(rows) and steps["none"] == sum(not known[v] for _, v in rows) and steps["mention"] > len(rows) / 2


def test_every_query_is_held_against_something():
    tested = {"p6_ids", "p8_found", "p8_pieces", "p8_cuts", "p7_found", "p7_passages", "p7_items", "p4_found", "p4_unmatched", "p4_steps"}
    assert set(queries.queries()) == set(queries.oracle_sql()) | tested


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_no_pairing_of_whole_tables(spark, name):
    text = queries.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name,exchanges", [("p4_found", 0), ("p6_ids", 0), ("p7_passages", 0), ("p8_found", 0)])
def test_texts_are_not_shuffled(spark, name, exchanges):
    text = queries.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == exchanges
