import pytest

from platemark.llm import canonical as c

LEGEND = [("R1", "Stop here for boats"), ("R1.2", "Give way for trams"), ("R1.3", "Give way for ducks"), ("HX712", "Slippery tractor for sledges"), ("KET306.4", "Northern museum for ducks"), ("UV874", "Quiet pavement for ducks"), ("UV518", "Oval tent"), ("UV458", "Shared name"), ("K9", "Shared name"), (None, "x"), ("", "y"), ("R1", "Second wording for boats")]


@pytest.fixture(scope="module")
def match():
    return c.CanonicalMatcher(LEGEND)


@pytest.mark.parametrize("value,code", [
    ("R1", "R1"), (" r1 ", "R1"), ("r_1_2", "R1.2"), ("R 1.2", "R1.2"), ("R1,2", "R1.2"), ("(R1.2)", "R1.2"), ("# R1", "R1"), ("R1.", "R1"), ("R–1–3", "R1.3"), ("Ｒ１．２", "R1.2"), ("H X 7 1 2", "HX712"), ("KET 306 4", "KET306.4"),
    ("RI.2", "R1.2"), ("R1.Z", "R1.2"), ("HX7l2", "HX712"), ("UVB74", "UV874"), ("HXX712", "HX712"), ("HX12", "HX712"), ("NX712", "HX712"), ("HX7112", "HX712"), ("UV548", "UV518"), ("KET306.", "KET306.4"),
    ("SLIPPERY TRACTOR FOR SLEDGES", "HX712"), ("Slippery tractor (sledges)", "HX712"), ("Slipppery tractor for sledges", "HX712"), ("Slippery tractor ofr sledges", "HX712"), ("hx712 Slippery tractor for sledges", "HX712"),
    ("see Quiet pavement for ducks - uv874", "UV874"), ("second wording for boats", "R1"), ("Give way for trams", "R1.2"),
    ("", ""), ("  ", ""), ("?", ""), ("UNKNOWN_29", ""), ("283534928", ""), ("HX712345", ""), ("HX712.9 9", ""), ("row cut off", ""), ("Shared name", ""), ("Give way", ""), ("way", ""), ("Slippery goat for trams", ""),
])
def test_values(match, value, code):
    assert match(value) == code
    assert match.decided(value) == c.decide(match.evidence(value))


def test_longest_mention_wins(match):
    assert match("R1 but rather Quiet pavement for ducks") == "UV874"


def test_a_very_long_value(match):
    assert match("ab cd " * 100_000 + "Quiet pavement for ducks " + "ef " * 100_000) == "UV874"


def test_tables(spark):
    rows = [(1, "R1", "a"), (2, None, "b"), (3, " ", "c"), (4, "nothing", "d"), (1, "R1", "a"), (5, " ", "e")]
    df = spark.createDataFrame(rows, "row_id long, code string, legend_code string")
    legend = spark.createDataFrame(LEGEND + LEGEND, "code string, description string")
    got = sorted(tuple(r) for r in c.map_to_canonical(df, "row_id", "code", legend, "code", "description").collect())
    assert got == [(1, "R1"), (1, "R1"), (4, "")]
    assert c.map_to_canonical(df.limit(0), "row_id", "code", legend, "code", "description").count() == 0
    assert {r.legend_code for r in c.map_to_canonical(df, "row_id", "code", legend.limit(0), "code", "description").collect()} == {""}


def test_a_list_in_blocks_gives_the_same(spark, monkeypatch):
    values = ["R1", "r_1_2", "HX7l2", "UVB74", "HXX712", "Slipppery tractor for sledges", "Shared name", "Give way", "see Quiet pavement for ducks - uv874", "K9", "nothing", "R1"]
    df = spark.createDataFrame(list(enumerate(values)), "row_id long, code string")
    legend = spark.createDataFrame(LEGEND, "code string, description string")
    whole = sorted(tuple(r) for r in c.map_to_canonical(df, "row_id", "code", legend, "code", "description", with_step=True).collect())
    monkeypatch.setattr(c, "BLOCK", 3)
    assert sorted(tuple(r) for r in c.map_to_canonical(df, "row_id", "code", legend, "code", "description", with_step=True).collect()) == whole


@pytest.mark.parametrize("value,step", [("R1", "mention"), ("M1.l", "alias"), ("H X 7 1 2", "mention"), ("R12", "alias"), ("Slippery tractor (sledges)", "similar"), ("HXX712", "keystroke"), ("row cut off", "none"), ("283534928", "none")])
def test_what_decides(value, step):
    match = c.CanonicalMatcher([*LEGEND, ("M1", None), ("M1.1", None)])
    assert c.decide(match.evidence(value))[1] == step


def test_short_codes_are_corrected_where_only_one_is_near():
    match = c.CanonicalMatcher([("R1", None), ("XY7", None)])
    assert match("XYY7") == "XY7" and match("XQ7") == "XY7" and match("RR1") == "R1" and c.CanonicalMatcher([("R1", None), ("R2", None)])("R3") == ""
