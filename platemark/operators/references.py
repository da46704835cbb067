"""References to records that don't exist: missing, deleted, or arriving later.

A reference is one or more columns of a child that name a key of a parent.
Rows are grouped by the null mask of a reference's columns; each mask is held
against the parent's keys on the columns it has, under the declared match
semantics:

* ``simple``: a reference with any null is none and isn't checked;
* ``partial``: the columns that are there must occur together in some parent;
* ``full``: a reference with some but not all nulls fails as ``partial_key``.

A mask that only asks for existence is an anti-join. Where times or deletion
count as well, parents are aggregated to one row per key and joined. All masks
of all parents that are small (counted, not assumed) are broadcast and held
against one read of the child, so a hot key moves nothing. Beyond that bound
each mask that occurs is joined for itself; keys that hold more than a
thousandth of all references are salted on both sides.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platemark.operators import sizing


@dataclass(frozen=True)
class Reference:
    """``columns`` of the child, in order, name ``parent_columns`` of ``parent``."""

    name: str
    columns: tuple[str, ...]
    parent: DataFrame = field(repr=False)
    parent_columns: tuple[str, ...]
    created: Column | None = None
    deleted: Column | None = None
    match: str = "simple"


def norm_key(c: Column | str) -> Column:
    """Keys are equal without case and outer white space; blank is null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.lower(F.regexp_replace(c.cast("string"), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")), F.lit(""))


def utc_time(c: Column | str) -> Column:
    """ISO 8601 text, however written, as a timestamp in UTC without a zone; text without a zone is UTC; else null."""
    c = F.trim(F.col(c) if isinstance(c, str) else c)
    c = F.regexp_replace(c, r"([+-]\d{2})(\d{2})$", "$1:$2")
    c = F.when(c.rlike(r"(?i)(z|[+-]\d{2}:\d{2})$") & c.rlike(r"\d[T ]\d"), c).when(c.rlike(r"^\d{4}-"), F.concat(c, F.when(c.rlike(r"[T ]\d"), "Z").otherwise("T00:00:00Z")))
    return F.timestamp_micros(F.unix_micros(F.try_to_timestamp(c))).cast("timestamp").alias("t")


def month_of(t: Column) -> Column:
    """'YYYY-MM' in UTC of a timestamp, whatever the session's zone."""
    return F.date_format(F.to_timestamp_ntz(F.convert_timezone(F.current_timezone(), F.lit("UTC"), t.cast("timestamp_ntz"))), "yyyy-MM")


def failing_references(child: DataFrame, row: str, created: Column, references: list[Reference]) -> DataFrame:
    """(row_id, ref_field, kind, created): one row for each failing reference of each row.

    ``kind`` is the first that fits of ``partial_key`` (match full only),
    ``missing``, ``deleted`` (all parents of the key are deleted) and ``late``
    (the earliest ``created`` of the key's parents is later than the child's;
    a null time is never late). Null and blank keys are no references, a row
    whose reference is all null is never reported, repeated rows are reported
    each, empty tables give no rows. Other columns are not read.
    """
    parts = []
    sizes = [ref.parent.count() for ref in references]
    small = [ref for ref, n in zip(references, sizes, strict=True) if n <= sizing.SMALL]
    if small:
        parts.append(_against_small(child, row, created, small))
    parts += [_against_large(child, row, created, ref, n) for ref, n in zip(references, sizes, strict=True) if n > sizing.SMALL]
    return reduce(DataFrame.unionByName, parts)


def _keys(ref: Reference) -> list[str]:
    return [f"k{i}" for i in range(len(ref.columns))]


def _masks(ref: Reference) -> list[int]:
    """The null masks (bits of the columns that are there) that are held against the parent."""
    whole = (1 << len(ref.columns)) - 1
    return list(range(1, whole + 1)) if ref.match == "partial" else [whole]


def _known(ref: Reference, mask: int) -> tuple[list[str], DataFrame]:
    """The columns of a mask, and the parent's keys on them: one row each, with ``born`` and ``gone``."""
    on = [k for i, k in enumerate(_keys(ref)) if mask >> i & 1]
    parent = ref.parent.select(
        *[norm_key(c).alias(k) for c, k in zip(ref.parent_columns, _keys(ref), strict=True) if k in on],
        (ref.created if ref.created is not None else F.lit(None).cast("timestamp")).alias("born"),
        F.coalesce(ref.deleted if ref.deleted is not None else F.lit(False), F.lit(False)).alias("gone"),
    ).dropna(subset=on)
    return on, parent.groupBy(*on).agg(F.min("born").alias("born"), F.min("gone").alias("gone"))


def _rows(child: DataFrame, row: str, created: Column, refs: list[Reference]) -> DataFrame:
    """row_id, created, and for reference number r its keys r_k0, r_k1, ... and its mask r_mask."""
    columns = {f"{r}_{k}": norm_key(c) for r, ref in enumerate(refs) for c, k in zip(ref.columns, _keys(ref), strict=True)}
    rows = child.select(F.col(row).alias("row_id"), created.alias("created"), *[c.alias(n) for n, c in columns.items()])
    mask = lambda r, ref: sum((F.when(F.col(f"{r}_{k}").isNotNull(), 1 << i).otherwise(0) for i, k in enumerate(_keys(ref))), F.lit(0))
    return rows.withColumns({f"{r}_mask": mask(r, ref) for r, ref in enumerate(refs)})


def _partial_key(ref: Reference, mask: Column) -> Column:
    whole = (1 << len(ref.columns)) - 1
    return (mask > 0) & (mask < whole) if ref.match == "full" else F.lit(False)


def _against_small(child: DataFrame, row: str, created: Column, refs: list[Reference]) -> DataFrame:
    rows, found = _rows(child, row, created, refs), []
    for r, ref in enumerate(refs):
        kind = F.when(_partial_key(ref, F.col(f"{r}_mask")), "partial_key")
        for m in _masks(ref):
            on, known = _known(ref, m)
            # The keys of rows with another mask are null here, so they meet nothing.
            mine = F.col(f"{r}_mask") == m
            rows = rows.withColumns({f"on_{k}": F.when(mine, F.col(f"{r}_{k}")) for k in on})
            tag = f"{r}_{m}"
            known = known.select(*[F.col(k).alias(f"on_{k}") for k in on], F.col("born").alias(f"born_{tag}"), F.col("gone").alias(f"gone_{tag}"), F.lit(True).alias(f"there_{tag}"))
            rows = rows.join(F.broadcast(known), [f"on_{k}" for k in on], "left").drop(*[f"on_{k}" for k in on])
            kind = kind.when(mine & F.col(f"there_{tag}").isNull(), "missing").when(F.col(f"gone_{tag}"), "deleted").when(F.col(f"born_{tag}") > F.col("created"), "late")
        found.append(F.struct(F.lit(ref.name).alias("ref_field"), kind.alias("kind")))
    failing = F.filter(F.array(*found), lambda x: x["kind"].isNotNull())
    return rows.select("row_id", F.inline(failing), "created").select("row_id", "ref_field", "kind", "created")


def _against_large(child: DataFrame, row: str, created: Column, ref: Reference, parents: int) -> DataFrame:
    rows = _rows(child, row, created, [ref])
    masks = _masks(ref)
    if len(masks) > 1:  # only masks that occur are joined
        there = {r["0_mask"] for r in rows.select("0_mask").distinct().collect()}
        masks = [m for m in masks if m in there] or masks[:1]
    plain = ref.created is None and ref.deleted is None
    found = []
    for m in masks:
        on, known = _known(ref, m)
        mine = rows.filter(F.col("0_mask") == m).select("row_id", "created", *[F.col(f"0_{k}").alias(k) for k in on])
        if plain:
            held = sizing.lookup(mine, known.select(*on), on, spread_by="row_id", parent_rows=parents, how="left_anti").withColumn("kind", F.lit("missing"))
        else:
            kind = F.when(F.col("there").isNull(), "missing").when(F.col("gone"), "deleted").when(F.col("born") > F.col("created"), "late")
            held = sizing.lookup(mine, known.withColumn("there", F.lit(True)), on, spread_by="row_id", parent_rows=parents).withColumn("kind", kind)
        found.append(held.filter(F.col("kind").isNotNull()).select("row_id", F.lit(ref.name).alias("ref_field"), "kind", "created"))
    if ref.match == "full":
        some = rows.filter(_partial_key(ref, F.col("0_mask")))
        found.append(some.select("row_id", F.lit(ref.name).alias("ref_field"), F.lit("partial_key").alias("kind"), "created"))
    return reduce(DataFrame.unionByName, found)


def registry_failures(cells: DataFrame, positions: DataFrame, pages: DataFrame, editions: DataFrame) -> DataFrame:
    """(table_name, row_id, ref_field, kind, month_key) as TESTDATA.md states problem 3."""
    set_at = norm_key("deleted_at").isNotNull()
    page = Reference("page_id", ("page_id",), pages, ("page_id",), utc_time("created_at"), set_at)
    edition = Reference("edition_id", ("edition_id",), editions, ("edition_id",), utc_time("created_at"), set_at)
    cell = Reference("reference_cell_id", ("reference_cell_id",), cells, ("reference_cell_id",), utc_time("created_at"), F.col("archived"))
    of_cells = failing_references(cells, "row_id", utc_time("created_at"), [page, edition]).withColumn("table_name", F.lit("reference_cells"))
    of_positions = failing_references(positions, "row_id", utc_time("created_at"), [cell]).withColumn("table_name", F.lit("reference_positions"))
    return of_cells.unionByName(of_positions).select("table_name", "row_id", "ref_field", "kind", month_of(F.col("created")).alias("month_key"))
