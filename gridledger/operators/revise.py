"""Comparing two revisions of a section, validated updates, appending, and the issue log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.functions.coerce import SPARK_TYPE, coerce, is_strictly_increasing
from gridledger.lookup import OBSOLETE_MIPS


def revision_diff(left: DataFrame, right: DataFrame, attrs: Sequence[str], key: str = "uid") -> DataFrame:
    """``(key, status, changed)``: only_left, only_right or changed, with the names of the changed attributes.

    An absent value differs from any present one.
    """
    side = lambda df, name: df.select(key, F.struct(*attrs).alias(name))
    both = side(left, "l").join(side(right, "r"), key, "full_outer")
    names = F.array_compact(F.array(*[F.when(~F.col(f"l.{a}").eqNullSafe(F.col(f"r.{a}")), F.lit(a)) for a in attrs]))
    status = F.when(F.col("r").isNull(), "only_left").when(F.col("l").isNull(), "only_right").when(F.size(names) > 0, "changed")
    return (both.select(key, status.alias("status"), F.when(status == "changed", names).alias("changed"))
            .where(F.col("status").isNotNull()))


def diff_summary(diff: DataFrame) -> DataFrame:
    return diff.groupBy("status").agg(F.count(F.lit(1)).alias("records"))


def attribute_changes(diff: DataFrame) -> DataFrame:
    """How many records changed in each attribute."""
    return diff.select(F.explode("changed").alias("attr")).groupBy("attr").agg(F.count(F.lit(1)).alias("records"))


def diff_listing(diff: DataFrame, left: DataFrame, right: DataFrame, form: str = "short") -> DataFrame:
    """Lines of a comparison: added and removed records, and with ``long`` the changed ones."""
    if form not in ("short", "long"):
        raise ValueError(f"the form of a listing is short or long, not {form}")
    kept = diff if form == "long" else diff.where(F.col("status") != "changed")
    labels = left.select("uid", F.col("label").alias("l")).join(right.select("uid", F.col("label").alias("r")), "uid", "full_outer")
    label = F.coalesce("l", "r")
    line = F.when(F.col("status") == "changed", F.concat(F.lit("Changed: "), F.col("uid").cast("string"), F.lit(" ["), label, F.lit("], "), F.array_join("changed", ",")))
    line = line.otherwise(F.concat(F.when(F.col("status") == "only_left", "Only in left: ").otherwise("Only in right: "),
                                   F.col("uid").cast("string"), F.lit(" ["), label, F.lit("]")))
    return kept.join(labels, "uid").select("uid", "status", line.alias("line"))


# --- updates -------------------------------------------------------------------------------------------

_GIVEN = {"string": "text", "bigint": "integer", "double": "float", "boolean": "boolean"}


def _expected(declared: Column) -> Column:
    """The kind of value a declared type takes: text, integer, float, boolean, or one of these with `` list``."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, spark_type in SPARK_TYPE.items():
        element = spark_type.removeprefix("array<").removesuffix(">")
        kind = _GIVEN[element] + (" list" if spark_type.startswith("array") else "")
        out = out.when(declared == name, F.lit(kind))
    return out


def update_violations(updates: DataFrame, index: DataFrame, attributes: DataFrame) -> DataFrame:
    """``(uid, attr, code)`` of every fault in a batch of updates.

    ``updates(uid, attr, op, given, value)``: op is set or delete, given the kind of the value, value its text with blanks
    between list elements.  ``index(uid, section)``, ``attributes(section, label, type, required)``.
    Codes: uid, delete unknown, delete required, unknown, type, list type, not increasing.
    """
    places = index.groupBy("uid").agg(F.count(F.lit(1)).alias("matches"), F.min("section").alias("section"))
    attrs = attributes.select("section", F.col("label").alias("attr"), F.regexp_replace("type", "^aa:", "").alias("declared"), "required")
    u = updates.join(places, ["uid"], "left").join(attrs, ["section", "attr"], "left")
    known = F.col("declared").isNotNull()
    expected = _expected(F.col("declared"))
    numbers = F.transform(F.split("value", " "), lambda w: w.try_cast("bigint"))
    set_ = F.col("op") == "set"
    code = (
        F.when(F.coalesce(F.col("matches"), F.lit(0)) != 1, "uid")
        .when(~set_ & ~known, "delete unknown")
        .when(~set_ & F.col("required"), "delete required")
        .when(~set_, F.lit(None))
        .when(~known, "unknown")
        .when(expected.endswith("list") & (F.col("given") != expected), "list type")
        .when(F.col("given") != expected, "type")
        .when((F.col("declared") == "st__integerListMonInc") & ~is_strictly_increasing(numbers), "not increasing")
    )
    return u.select("uid", "attr", code.alias("code")).where(F.col("code").isNotNull())


def valid_updates(updates: DataFrame, violations: DataFrame) -> DataFrame:
    """The updates of records without any fault: a record is changed as a whole or not at all."""
    kept = updates.where(F.col("op") == "set")
    return kept.join(violations.select("uid").distinct(), ["uid"], "left_anti")


def apply_updates(section: DataFrame, updates: DataFrame, types: dict[str, str]) -> DataFrame:
    """The section with the new values; attributes are only set, deletions are validated but leave the record as it is.

    With a column ``position`` the last of several values of an attribute counts, without one the largest text."""
    names = [c for c in section.columns if c != "uid" and c in types]
    order = [F.col("position")] if "position" in updates.columns else []
    new = updates.where(F.col("attr").isin(names)).groupBy("uid").agg(
        *[F.max(F.when(F.col("attr") == a, F.struct(*order, F.lit(True).alias("set"), F.col("value")))).alias(f"_{a}") for a in names])
    cols = [F.when(F.col(f"_{c}.set"), coerce(F.col(f"_{c}.value"), types[c]).cast(section.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c in names else F.col(c) for c in section.columns]
    return section.join(new, "uid", "left").select(*cols)


def append_records(section: DataFrame, records: DataFrame) -> DataFrame:
    return section.unionByName(records, allowMissingColumns=True)


def current_mips(mips: DataFrame) -> DataFrame:
    """Projects without the obsolete ones."""
    return mips.where(~F.col("label").isin(OBSOLETE_MIPS))


# --- issues --------------------------------------------------------------------------------------------

def issue_log(issues: DataFrame) -> DataFrame:
    """``(code, message)`` once each, in order."""
    return issues.select("code", "message").distinct().orderBy("code", "message")


def issue_counts(issues: DataFrame) -> DataFrame:
    """Distinct messages per code."""
    return issues.select("code", "message").distinct().groupBy("code").agg(F.count(F.lit(1)).alias("messages"))
