import json
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from platemark.operators.nested import _flat, flatten_cells, flatten_json_plainly, flatten_payloads

LABELS = ["record_id", "cell_no", "child", "child_no", "label"]
RICH = json.dumps([{"approval_state": 'a"b\\', "geometry": {"margin": [1, "2", None, 4], "padding": "3", "hints": [{"margin": {"top": 9}}]}, "provenance": {"history": [None, {"event_type": "x"}, "s"]}, "reviewers": [{"history": [{"event_type": "login"}]}]}, None, 5, {"geometry": {"margin": {"top": 1, "left": "n/a"}}, "provenance": {"history": {"event_type": None}}}])
TEXTS = [
    RICH, json.dumps(RICH), '{"a":{"cells":[{}]},"cells":null}', '""', '"[{}]"', "[]", "{}", "", "   ", "[1,]", '{"cells":[{"approval_state":"x","approval_state":"y"}]}',
    '[{"geometry":{"margin":NaN}}]', '[{"a":"\\u00e9\\uD83D"}]', "[tru]", "[01]", '[{"\\u0061pproval_state":"q"}]', '{"cells":[[{}]]}', "[{}]]", "[{}}", "[{]", '"a" "b"', "[1 2]", '{"a" 1}',
    '{"a":1 "b":2}', "[\t{}]", '["\t"]', "[[[[[[[[]]]]]]]]", '{"cells":{"cells":[{}]}}', '{"document":{"cells":[{"approval_state":"ü ✓"}]},"sent_by":"x"}', "nul", "{", "\\", '"', '[{"a":"\\"]}"}]',
]


def flat(texts):
    found = defaultdict(list)
    for batch in _flat(np.arange(len(texts)), [t.encode() for t in texts]):
        for r in batch.to_pylist():
            found[r["record_id"]].append(tuple(r[c] for c in LABELS[1:]))
    return [sorted(found[i], key=str) for i in range(len(texts))]


def test_equals_a_parser():
    assert flat(TEXTS) == [sorted(flatten_json_plainly(t), key=str) for t in TEXTS]


def test_equals_a_parser_on_damaged_texts():
    rng = random.Random(7)
    texts = []
    for _ in range(3000):
        s = list(rng.choice(TEXTS[:3] + TEXTS[10:11]))
        for _ in range(rng.choice([1, 2])):
            i = rng.randrange(len(s))
            s[i : i + rng.randrange(2)] = rng.choice(["", *'{}[],:"\\0 nt'])
        texts.append("".join(s))
    assert flat(texts) == [sorted(flatten_json_plainly(t), key=str) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet='{}[],:"\\ntru01. e-cels', max_size=25), min_size=1, max_size=6))
def test_any_characters(texts):
    assert flat(texts) == [sorted(flatten_json_plainly(t), key=str) for t in texts]


def wrapped(value, depth, name="document"):
    for i in range(depth):
        value = {"before": i, name: value, "after": [{"cells": [1, 2, 3]}]}
    return value


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 50), st.integers(0, 10))
def test_any_depth_of_wrapping_and_quoting(depth, quoted):
    text = json.dumps(wrapped({"cells": json.loads(RICH)}, depth))
    for _ in range(quoted):
        text = json.dumps(text)
    assert flat([text, "[{}]"]) == [sorted(flatten_json_plainly(t), key=str) for t in (RICH, "[{}]")]


WRAPPERS = st.recursive(st.sampled_from([1, None, "s", [], [{"cells": [5]}]]), lambda inner: st.lists(st.tuples(st.sampled_from(["cells", "a", "b", "\u00e9"]), inner), max_size=4).map(dict), max_leaves=12)


def repeated(value, rng):
    """JSON text with some members of objects written twice."""
    if not isinstance(value, dict):
        return json.dumps(value)
    members = [f"{json.dumps(k)}:{repeated(v, rng)}" for k, v in value.items()]
    members += [f"{json.dumps(k)}:{repeated(v, rng)}" for k, v in value.items() if rng.random() < 0.3]
    rng.shuffle(members)
    return "{" + ",".join(members) + "}"


@settings(max_examples=300, deadline=None)
@given(st.lists(WRAPPERS, min_size=1, max_size=4), st.integers(0, 99))
def test_which_list_of_cells(values, seed):
    texts = [repeated(v, random.Random(seed)) for v in values]
    assert flat(texts) == [sorted(flatten_json_plainly(t), key=str) for t in texts]


def test_long_and_deep_texts():
    long = json.dumps([{"approval_state": "s" * 300_000, "provenance": {"history": [{"event_type": "e"}] * 5000}}])
    deep = "[" * 5000 + "]" * 5000
    assert flat([long])[0] == sorted(flatten_json_plainly(long), key=str)
    assert flat([deep])[0] == [(0, "cell", 0, "")]


def test_payloads_as_a_table(spark):
    df = spark.createDataFrame([(1, RICH, "x"), (2, None, "y"), (3, "[{}", "z"), (1, RICH, "x")], "id long, t string, label string")
    got = flatten_payloads(df, "id", "t")
    assert got.filter("record_id <> 1").count() == 0
    assert got.count() == 2 * len(flatten_json_plainly(RICH))
    assert flatten_payloads(df.limit(0), "id", "t").count() == 0


def test_sides_have_values(spark):
    got = {(r.child, r.label): r.value for r in flatten_payloads(spark.createDataFrame([(1, RICH)], "id long, t string"), "id", "t").filter("cell_no = 0 AND child <> 'cell' AND child <> 'history'").collect()}
    assert got[("margin", "right")] == 2.0 and got[("padding", "left")] == 3.0 and ("margin", "bottom") not in got


@pytest.mark.parametrize("geometry,expected", [("null", 0), ("named_struct('margin', named_struct('top', 1D, 'right', double('NaN'), 'bottom', null, 'left', 2D), 'padding', null)", 2)])
def test_typed_cells(spark, geometry, expected):
    side = "struct<top: double, right: double, bottom: double, left: double>"
    df = spark.sql(f"""SELECT 7L AS row_id, 'x' AS cell_no, CAST(null AS string) AS approval_state, CAST({geometry} AS struct<margin: {side}, padding: {side}>) AS geometry,
      named_struct('history', array(null, named_struct('event_type', 'a'), named_struct('event_type', CAST(null AS string)))) AS provenance""")
    got = sorted((r.child, r.child_no, r.label) for r in flatten_cells(df, "row_id").collect())
    assert got[0] == ("cell", 0, "") and got[1:3] == [("history", 1, "a"), ("history", 2, "")] and len(got) == 3 + expected
    assert flatten_cells(df.limit(0), "row_id").count() == 0
