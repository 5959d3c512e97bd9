"""Typed reading and writing of attribute texts, with a problem code instead of an exception."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTEGER_TEXT = r"^-{0,1}[0-9]+$"

# declared type -> Spark type
SPARK_TYPE = {
    "xs:string": "string", "xs:duration": "string", "st__uid": "string",
    "st__fortranType": "string", "st__sliceType": "string", "st__configurationType": "string",
    "xs:boolean": "boolean", "xs:integer": "bigint", "xs:float": "double",
    "st__integerList": "array<bigint>", "st__integerListMonInc": "array<bigint>",
    "st__floatList": "array<double>", "st__floatListMonInc": "array<double>", "st__stringList": "array<string>",
}


def base_type(declared: str) -> str:
    """Type name without its namespace prefix."""
    return declared.split(":", 1)[1] if declared.startswith("aa:") else declared


def is_integer_text(v: Column) -> Column:
    return v.rlike(INTEGER_TEXT)


def integer_problem(v: Column) -> Column:
    """Why a text is not a plain integer; NULL if it is one."""
    return F.when(v.isNull(), "NOT STRING").when(~is_integer_text(v), "not an integer")


def _to_integer(v: Column) -> Column:
    """Integer text as it is, otherwise a number cut towards zero, otherwise NULL."""
    return F.when(is_integer_text(v), v.try_cast("bigint")).otherwise(v.try_cast("double").try_cast("bigint"))


def _words(v: Column) -> Column:
    return F.filter(F.split(F.trim(v), r"\s+"), lambda w: w != "")


def coerce(v: Column, declared: str) -> Column:
    """The value of an attribute text of a declared type; NULL where it cannot be read."""
    t = base_type(declared)
    if t == "xs:boolean":
        return v.isin("true", "1")
    if t == "xs:integer":
        blank = F.trim(v).isin("", "[]")
        return F.when(blank, F.lit(0).cast("bigint")).otherwise(_to_integer(F.trim(v)))
    if t == "xs:float":
        return F.when(v != "", v.try_cast("double"))
    if t in ("st__integerList", "st__integerListMonInc"):
        return F.transform(_words(v), _to_integer)
    if t in ("st__floatList", "st__floatListMonInc"):
        return F.transform(_words(v), lambda w: w.try_cast("double"))
    if t == "st__stringList":
        return F.when(v.contains(" "), _words(v)).otherwise(F.array(v))
    return v


def is_non_decreasing(xs: Column) -> Column:
    return F.sort_array(xs).eqNullSafe(xs)


def is_strictly_increasing(xs: Column) -> Column:
    return is_non_decreasing(xs) & (F.size(F.array_distinct(xs)) == F.size(xs))


def coercion_problem(v: Column, declared: str) -> Column:
    """Code of what is wrong with an attribute text, NULL if nothing is."""
    t = base_type(declared)
    none = F.lit(None).cast("string")
    if t not in SPARK_TYPE:
        return F.when(v.isNotNull(), "unknown type")
    if t == "xs:integer":
        x = F.trim(v)
        return (F.when(v.isNull() | is_integer_text(v), none)
                .when(x.isin("", "[]"), "blank integer set to 0")
                .when(_to_integer(x).isNull(), "integer unreadable")
                .otherwise("integer cut from number"))
    if t == "xs:float":
        return F.when((v != "") & v.try_cast("double").isNull(), "float unreadable")
    if t.endswith("List") or t.endswith("ListMonInc"):
        xs = coerce(v, declared)
        bad = F.exists(xs, lambda x: x.isNull())
        out = F.when(bad, "list unreadable")
        if t == "st__integerListMonInc":
            out = out.when(~is_non_decreasing(xs), "list decreases")
        if t in ("st__integerList", "st__integerListMonInc"):
            out = out.when(F.exists(_words(v), lambda w: ~is_integer_text(w)), "integer list cut from numbers")
        return out
    if t == "st__uid":
        return F.when(~v.rlike(r"^[a-zA-Z0-9:_.+\-]+$"), "bad uid")
    return none


def typed(df: DataFrame, types: dict[str, str], required: dict[str, str | None] | None = None) -> DataFrame:
    """The typed table of a section read as text.

    ``types`` maps attributes to declared types; ``required`` maps the required ones to their default text, where None
    stands for the general default of an unset attribute.
    """
    required = required or {}
    out = []
    for name, declared in types.items():
        if name in df.columns:
            v = F.col(f"`{name}`").cast("string")
        else:
            v = F.lit(None).cast("string")
        x = coerce(v, declared)
        if name in required and name != "uid" and SPARK_TYPE.get(base_type(declared), "string") == "string":
            x = F.coalesce(x, F.lit(required[name] or "__unset__"))
        out.append(x.cast(SPARK_TYPE.get(base_type(declared), "string")).alias(name))
    return df.select(*out)


def violations(df: DataFrame, section: str, types: dict[str, str], required: dict[str, str | None] | None = None) -> DataFrame:
    """One row per attribute text that could not be taken as it is: section, uid, attr, value, problem."""
    required = required or {}
    checks = []
    for name, declared in types.items():
        present = name in df.columns
        v = F.col(f"`{name}`").cast("string") if present else F.lit(None).cast("string")
        problem = coercion_problem(v, declared)
        if name in required:
            problem = F.when(v.isNull(), "missing uid" if name == "uid" else "required attribute absent").otherwise(problem)
        checks.append(F.struct(F.lit(name).alias("attr"), v.alias("value"), problem.alias("problem")))
    uid = F.col("uid").cast("string") if "uid" in df.columns else F.lit(None).cast("string")
    return (
        df.select(uid.alias("uid"), F.explode(F.array(*checks)).alias("c"))
        .where(F.col("c.problem").isNotNull())
        .select(F.lit(section).alias("section"), "uid", "c.attr", "c.value", "c.problem")
    )


def to_text(x: Column, declared: str) -> Column:
    """The attribute text of a typed value; lists are joined by blanks."""
    t = base_type(declared)
    if t.startswith("st__") and "List" in t:
        return F.array_join(F.transform(x, lambda e: e.cast("string")), " ")
    return x.cast("string")
