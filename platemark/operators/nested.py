"""Deeply nested records as flat tables that keep parent-child links.

A flat row is (record_id, cell_no, child, child_no, label, value): the cell
``cell_no`` of the record ``record_id``, or one of the cell's box sides or
history entries. Children carry the keys of their cell, cells those of their
record, so the tables join back on (record_id) and (record_id, cell_no).

Typed nested columns are taken apart by one generator; JSON text by the
structural index. Neither moves a row to another partition.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platemark.operators.structural import ARR, OBJ, SCALAR, STR, StructuralIndex

SIDES = ("top", "right", "bottom", "left")
BOXES = ("margin", "padding")
FLAT = "record_id bigint, cell_no int, child string, child_no int, label string, value double"
WANTED = [b"cells", b"approval_state", b"geometry", b"provenance", b"history", b"event_type", b"margin", b"padding", b"top", b"right", b"bottom", b"left"]
CELLS, STATE, GEOMETRY, PROVENANCE, HISTORY, EVENT, MARGIN, PADDING, TOP = range(9)
#: A number, or text that is one.
NUMERIC = re.compile(r"[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?")
#: Bytes of JSON text indexed at once; a single longer text is indexed alone.
CHUNK = 1_000_000
CHILDREN = ("cell", *BOXES, "history")
ARROW = pa.schema([("record_id", pa.int64()), ("cell_no", pa.int32()), ("child", pa.string()), ("child_no", pa.int32()), ("label", pa.string()), ("value", pa.float64())])


def flatten_cells(df: DataFrame, record: str) -> DataFrame:
    """Flat rows of typed cells, one cell per record (cell_no 0).

    A null geometry, box, provenance or history has no children; a null or
    NaN side is none; null history entries keep their place but give no row;
    a null state or event type is ''. An empty table gives an empty result,
    further columns are not read.
    """

    def row(child: str, number: Column, label: Column, value: Column) -> Column:
        return F.struct(F.lit(child).alias("child"), number.alias("child_no"), label.alias("label"), value.cast("double").alias("value"))

    none = F.lit(None).cast("double")
    zero = F.lit(0)
    cell = F.array(row("cell", zero, F.coalesce(F.col("approval_state"), F.lit("")), none))
    sides = F.array(*[row(box, zero, F.lit(side), F.col(f"geometry.{box}.{side}")) for box in BOXES for side in SIDES])
    sides = F.filter(sides, lambda s: s["value"].isNotNull() & ~F.isnan(s["value"]))
    entries = F.filter(
        F.transform("provenance.history", lambda e, i: F.when(e.isNotNull(), row("history", i, F.coalesce(e["event_type"], F.lit("")), none))),
        lambda e: e.isNotNull(),
    )
    entries = F.coalesce(entries, F.filter(cell, lambda _: F.lit(False)))
    return df.select(F.col(record).cast("long").alias("record_id"), F.lit(0).alias("cell_no"), F.inline(F.concat(cell, sides, entries)))


def flatten_payloads(df: DataFrame, record: str, payload: str) -> DataFrame:
    """Flat rows of cells in JSON texts, whose list of cells is bare or wrapped.

    The list is the text's top value, or the outermost member ``cells`` that
    is a list, below objects only (however many); of several on one level the
    first. The whole may itself be quoted as a JSON string, and that again, as
    often as it likes. Texts that aren't complete JSON (by its strict
    grammar), are null or empty, or have no list of cells, give no rows. Of
    repeated keys the last counts. Repeated records are flattened each. Very
    long texts are indexed alone, whole. Further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < len(texts):
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, "right")))
                yield from _flat(batch.column(0).slice(at, stop - at).to_numpy(zero_copy_only=False), texts.slice(at, stop - at).to_pylist())
                at = stop

    rows = df.select(F.col(record).cast("long").alias("id"), F.col(payload).cast("string").alias("t")).filter(F.col("t").isNotNull() & F.col("id").isNotNull())
    return rows.mapInArrow(run, FLAT)


def _flat(ids: np.ndarray, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    while len(texts):  # texts that are quoted come again without their quotes; each time they get shorter
        index = StructuralIndex(texts, WANTED)
        yield _rows(index, ids)
        quoted = np.flatnonzero(index.value & (index.level == 0) & (index.kind == STR))
        ids = ids[index.doc[quoted]]
        texts = [t.encode() for t in index.texts(quoted).to_pylist()]


def _lists_of_cells(x: StructuralIndex) -> np.ndarray:
    """The token of each text's list of cells."""
    lists = np.flatnonzero(x.value & (x.kind == ARR) & (x.lists == 0) & ((x.level == 0) | (x.key == CELLS)))
    # Below a wrapper that is itself repeated under one key only the last counts.
    deep = np.unique(x.doc[lists[x.level[lists] > 1]])
    if len(deep):
        last: dict[tuple[int, bytes], int] = {}
        wrappers = np.flatnonzero(x.value & (x.lists == 0) & (x.level > 0) & np.isin(x.doc, deep)).tolist()
        for t in wrappers:
            last[(int(x.parent[t]), x.key_text(t))] = t
        counts = set(last.values())
        dead: set[int] = set()
        for t in wrappers:  # a container comes before what it holds
            if t not in counts or int(x.parent[t]) in dead:
                dead.add(t)
        lists = np.array([t for t in lists.tolist() if t not in dead], np.int64)
    lists = lists[np.lexsort((lists, x.level[lists], x.doc[lists]))]
    return lists[np.unique(x.doc[lists], return_index=True)[1]]


def _rows(x: StructuralIndex, ids: np.ndarray) -> pa.RecordBatch:
    m = len(x.kind)
    value, parent, key, kind = x.value, x.parent, x.key, x.kind
    under = parent >= 0
    up = np.maximum(parent, 0)

    def flags(tokens: np.ndarray) -> np.ndarray:
        f = np.zeros(m + 1, bool)
        f[tokens] = True
        return f

    cells = np.flatnonzero(value & under & flags(_lists_of_cells(x))[up])
    cells = cells[~x.is_null(cells)]
    owner = np.full(m + 1, -1, np.int64)  # the cell that a token of interest belongs to
    owner[cells] = cells

    def members(of: np.ndarray, name: int) -> np.ndarray:
        found = np.flatnonzero(value & under & (key == name) & of[up])
        owner[found] = owner[parent[found]]
        return found

    def labels(of: np.ndarray, tokens: np.ndarray) -> pa.Array:
        """Text of the member (one of ``tokens``) of each token of ``of``; '' where there is none."""
        member = np.full(m + 1, -1, np.int64)
        member[parent[tokens]] = tokens
        return pc.fill_null(x.texts(member[of]), "")

    is_cell = flags(cells)
    zeros = np.zeros(len(cells), np.int64)
    out = [(cells, 0, zeros, labels(cells, members(is_cell, STATE)), np.full(len(cells), np.nan))]

    geometry = flags(members(is_cell, GEOMETRY))
    for number, name in ((1, MARGIN), (2, PADDING)):
        boxes = members(geometry, name)
        one = boxes[(kind[boxes] == STR) | (kind[boxes] == SCALAR)]
        known = flags(boxes)
        tokens, side = [], []
        for s in range(len(SIDES)):
            named = members(known & np.append(kind == OBJ, False), TOP + s)
            listed = np.flatnonzero(value & under & known[up] & (kind[up] == ARR) & (x.place == s))
            owner[listed] = owner[parent[listed]]
            tokens += [one, named, listed]
            side.append(np.full(len(one) + len(named) + len(listed), s))
        token, sides = np.concatenate(tokens), np.concatenate(side)
        numbers = _numbers(x, token)
        there = ~np.isnan(numbers)
        out.append((owner[token[there]], number, np.zeros(int(there.sum()), np.int64), pa.array(SIDES, pa.large_string()).take(pa.array(sides[there])), numbers[there]))

    histories = members(flags(members(is_cell, PROVENANCE)), HISTORY)
    in_lists = np.flatnonzero(value & under & flags(histories[kind[histories] == ARR])[up])
    owner[in_lists] = owner[parent[in_lists]]
    single = histories[kind[histories] != ARR]
    entries = np.concatenate((in_lists, single))
    place = np.concatenate((x.place[in_lists], np.zeros(len(single), np.int64)))
    there = ~x.is_null(entries)
    entries, place = entries[there], place[there]
    out.append((owner[entries], 3, place, labels(entries, members(flags(entries), EVENT)), np.full(len(entries), np.nan)))

    of = np.concatenate([c for c, *_ in out])
    child = pa.array(CHILDREN).take(pa.array(np.repeat([n for _, n, *_ in out], [len(c) for c, *_ in out])))
    values = np.concatenate([v for *_, v in out])
    columns = [
        pa.array(ids[x.doc[of]], pa.int64()), pa.array(x.place[of].astype(np.int32)), child, pa.array(np.concatenate([p for _, _, p, _, _ in out]).astype(np.int32)),
        pa.concat_arrays([t for *_, t, _ in out]).cast(pa.string()), pa.array(values, mask=np.isnan(values)),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=ARROW)


def _numbers(x: StructuralIndex, tokens: np.ndarray) -> np.ndarray:
    """Values of numbers, and of texts that are one; NaN for all else."""
    texts = pc.utf8_trim_whitespace(x.texts(tokens))
    numeric = pc.fill_null(pc.match_substring_regex(texts, f"^(?:{NUMERIC.pattern})$"), False)
    numeric = pc.and_(numeric, pa.array((x.kind[tokens] == STR) | (x.kind[tokens] == SCALAR), pa.bool_()))
    return pc.if_else(numeric, texts, None).cast(pa.float64()).to_numpy(zero_copy_only=False)


def flatten_json_plainly(text: str | None) -> list[tuple[int, str, int, str]]:
    """The same rows by a parser, one text at a time: what tests hold the operator against."""

    def strict(_: str) -> None:
        raise ValueError

    def number(v: object) -> bool:
        return not isinstance(v, bool) and (isinstance(v, int | float) or isinstance(v, str) and NUMERIC.fullmatch(v.strip()) is not None)

    def last_of(pairs: list[tuple[str, object]]) -> dict:
        """Of repeated keys the last, in its own place."""
        o: dict = {}
        for k, v in pairs:
            o.pop(k, None)
            o[k] = v
        return o

    def find(v: object) -> list | None:
        level = [v]
        while level:
            for o in level:
                if isinstance(o, dict) and isinstance(o.get("cells"), list):
                    return o["cells"]
            level = [m for o in level if isinstance(o, dict) for m in o.values()]
        return None

    v: object = text or ""
    while isinstance(v, str):
        try:
            v = json.loads(v, parse_constant=strict, object_pairs_hook=last_of)
        except ValueError:
            return []
    rows: list[tuple[int, str, int, str]] = []
    for no, c in enumerate((v if isinstance(v, list) else find(v)) or []):
        if c is None:
            continue
        get = c.get if isinstance(c, dict) else lambda _: None
        rows.append((no, "cell", 0, get("approval_state") or ""))
        g = get("geometry") if isinstance(get("geometry"), dict) else {}
        for box in BOXES:
            b = g.get(box)
            sides = [b.get(s) for s in SIDES] if isinstance(b, dict) else (b + [None] * 4)[:4] if isinstance(b, list) else [b] * 4
            rows += [(no, box, 0, s) for s, v2 in zip(SIDES, sides, strict=True) if number(v2)]
        p = get("provenance") if isinstance(get("provenance"), dict) else {}
        h = p.get("history")
        for i, e in enumerate(h if isinstance(h, list) else [h]):
            if e is not None:
                rows.append((no, "history", i, (e.get("event_type") if isinstance(e, dict) else "") or ""))
    return rows
