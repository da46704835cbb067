"""Best representative of each duplicate group, by skyline selection.

Each record has a completeness (which of the wanted fields it offers, or how
many), a trust, a recency and an id. A record dominates another if it is at
least as complete, as trusted and as recent, has no greater id, and is better
in one of the four. Layer 1 are the records nobody dominates, layer k+1 those
that only records of the layers up to k dominate. Every field is taken from
the first layer that offers it, and there from the first record by the
lexicographic policy; so fields the skyline lacks are filled from the layers
below it, one after the other.

A group may hold a third of all rows, so nothing collects a group. Of records
that offer the same fields and are equally trusted only the policy's first is
a candidate; one mergeable aggregation, combined before the shuffle, finds it.
What a group brings to the skyline is at most (2 ** fields) x (distinct trust
levels) records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platemark.operators.sizing import small_or_shuffled

#: Stand-ins for "not known", compared without case and outer white space (a parameter of ``best_labels``).
STAND_INS = ("unknown", "tbd", "n/a", "none", "no description")
#: What records are compared by, in the order of the default policy.
POLICY = ("trust", "recency", "id", "completeness")
#: UNKNOWN with a running number.
NUMBERED_UNKNOWN = r"^unknown[ _-]*[0-9]+$"
#: Page, kind word, index and letter of a crop's filename, after the last slash.
CROP = r"^\s*page[\s_-]*0*([0-9]+)[\s_-]+([a-z]+)[\s_-]+0*([0-9]+)([a-z]?)(?:[^a-z0-9]|$)"
LOWEST_TRUST = -(2**31)


def says_something(value: Column, stand_ins: Sequence[str] = STAND_INS) -> Column:
    """False for null, blank, letterless and digitless values and stand-ins for "not known"."""
    v = F.lower(F.regexp_replace(value, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    return F.coalesce(v.rlike(r"[\p{L}\p{N}]") & ~v.isin(list(stand_ins)) & ~v.rlike(NUMBERED_UNKNOWN), F.lit(False))


def crop_name(filename: Column) -> Column:
    """``page/kind/index/letter`` of a filename however it is written; null if it names no crop."""
    f = F.lower(filename)
    for code, char in (("%20", " "), ("%5f", "_"), ("%2d", "-"), ("%2f", "/")):
        f = F.replace(f, F.lit(code), F.lit(char))
    f = F.regexp_replace(F.replace(f, F.lit("\\"), F.lit("/")), r"(?s)^.*/", "")
    return F.nullif(F.regexp_replace(f, rf"(?s){CROP}.*$|^.*$", "$1/$2/$3/$4"), F.lit("///"))


def skyline_survivors(df: DataFrame, key: str, fields: dict[str, Column], trust: str, recency: str, record: str, policy: Sequence[str] = POLICY, completeness: str = "fields") -> DataFrame:
    """One row per group: ``key``, ``first_id``, ``n``, and ``<field>_id``, ``<field>`` and ``<field>_layer`` for each field.

    ``fields`` maps a column to the condition under which it offers a value.
    ``completeness`` "fields" compares which fields are offered (more complete
    is a superset), "count" how many; with "fields" whoever dominates a record
    offers what it offers, so every field comes from layer 1. ``policy`` orders
    all of POLICY. ``<field>_id`` is 0 and ``<field>`` and its layer null where
    no record offers one. Null trust is below any other, null recency is the
    oldest, the smaller ``record`` is better; repeated records are one. Rows
    with a null key form no group and are left out; an empty table gives an
    empty result. Columns of ``df`` other than those named are ignored,
    whatever they are called.
    """
    if sorted(policy) != sorted(POLICY) or completeness not in ("fields", "count"):
        raise ValueError(f"a policy orders {POLICY}, completeness is fields or count")
    names = list(fields)
    mask = sum((F.when(cond, 1 << i).otherwise(0) for i, cond in enumerate(fields.values())), F.lit(0))
    flat = df.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("k"), mask.alias("mask"), F.coalesce(F.col(trust), F.lit(LOWEST_TRUST)).cast("int").alias("trust"),
        F.col(recency).alias("at"), F.bitwise_not(F.col(record).cast("long")).alias("nid"), *[F.col(c).cast("string").alias(f"v{i}") for i, c in enumerate(names)],
    )
    column = {"trust": "trust", "recency": "at", "id": "nid", "completeness": "offered"}
    values = [f"v{i}" for i in range(len(names))]
    within = [column[p] for p in policy if p in ("recency", "id")]
    picked = F.max(F.struct(*within, *values)).alias("m")
    reps = flat.groupBy("k", "mask", "trust").agg(picked, F.count(F.lit(1)).alias("n"), F.max("nid").alias("first"))
    parts = {"trust": F.col("trust"), "at": F.col("m.at"), "nid": F.col("m.nid"), "offered": F.bit_count("mask")}
    rep = F.struct(*[parts[column[p]].alias(column[p]) for p in policy], "mask", *[F.col(f"m.{v}").alias(v) for v in values])
    groups = reps.groupBy("k").agg(F.sum("n").alias("n"), F.bitwise_not(F.max("first")).alias("first_id"), F.sort_array(F.collect_list(rep), asc=False).alias("reps"))
    # Dominators come first in the order of any policy, so one fold gives all layers.
    kinds = {"trust": "int", "at": dict(df.dtypes)[recency], "nid": "bigint", "offered": "int"}
    schema = ", ".join([*[f"{column[p]}: {kinds[column[p]]}" for p in policy], "mask: int", *[f"{v}: string" for v in values], "layer: int"])
    empty = F.expr(f"cast(array() as array<struct<{schema}>>)")
    layered = groups.withColumn("reps", F.aggregate("reps", empty, lambda done, new: _with_layer(done, new, completeness)))
    out = [F.col("k").alias(key), "first_id", "n"]
    for i, c in enumerate(names):
        best = _first_of_best_layer(1 << i)
        out += [F.coalesce(F.bitwise_not(best["nid"]), F.lit(0)).cast("long").alias(f"{c}_id"), best[f"v{i}"].alias(c), best["layer"].alias(f"{c}_layer")]
    return layered.select(*out)


def _first_of_best_layer(bit: int) -> Column:
    """Of the records in ``reps`` that offer the field, the policy's first in the lowest layer."""
    offering = F.filter("reps", lambda r: r["mask"].bitwiseAND(bit) != 0)
    lowest = F.array_min(F.transform(offering, lambda r: r["layer"]))
    return F.get(F.filter(offering, lambda r: r["layer"] == lowest), F.lit(0))


def _with_layer(done: Column, new: Column, completeness: str) -> Column:
    """``done`` and the record ``new``, one layer below the lowest of those that dominate it."""

    def dominates(old: Column) -> Column:
        as_full = old["mask"].bitwiseAND(new["mask"]) == new["mask"] if completeness == "fields" else old["offered"] >= new["offered"]
        as_late = new["at"].isNull() | F.coalesce(old["at"] >= new["at"], F.lit(False))
        better = (old["mask"] != new["mask"]) if completeness == "fields" else (old["offered"] > new["offered"])
        better = better | (old["trust"] > new["trust"]) | ~old["at"].eqNullSafe(new["at"]) | (old["nid"] > new["nid"])
        return as_full & (old["trust"] >= new["trust"]) & as_late & (old["nid"] >= new["nid"]) & better

    above = F.array_max(F.transform(F.filter(done, dominates), lambda x: x["layer"]))
    return F.concat(done, F.array(new.withField("layer", F.coalesce(above, F.lit(0)) + 1)))


def best_labels(mappings: DataFrame, sources: DataFrame, stand_ins: Sequence[str] = STAND_INS) -> DataFrame:
    """Survivors of all crops with two or more records: crop, first_id, n, code_id, code, description_id, description."""
    trust = small_or_shuffled(sources.groupBy("label_source").agg(F.max("trust").alias("source_trust")), 10_000)
    records = (
        mappings.select("mapping_id", crop_name(F.col("filename")).alias("crop"), "code", "description", "label_source", "updated_at")
        .filter(F.col("crop").isNotNull())
        .join(trust, "label_source", "left")
    )
    fields = {c: says_something(F.col(c), stand_ins) for c in ("code", "description")}
    best = skyline_survivors(records, "crop", fields, "source_trust", "updated_at", "mapping_id").filter("n >= 2")
    return best.select("crop", "first_id", "n", "code_id", "code", "description_id", "description")
