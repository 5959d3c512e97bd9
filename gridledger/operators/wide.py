"""The denormalised variable table, quality ranges, priorities of variables, and table order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.functions.text import table_class
from gridledger.lookup import UNSET
from gridledger.operators.expand import link_experiments, meet_by_experiment, with_link
from gridledger.operators.links import broken_parts
from gridledger.scale import string_set

QC_VALUES = ["valid_min", "valid_max", "ok_min_mean_abs", "ok_max_mean_abs"]


def quality_text(value: Column, status: Column) -> Column:
    """``value s`` with the first letter of the status, blank without a value."""
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat_ws(" ", value.cast("string"), F.substring(status, 1, 1)))


def first_quality_range(qc: DataFrame) -> DataFrame:
    """The first range record of each variable as text columns."""
    have = [c for c in QC_VALUES if c in qc.columns]
    first = qc.groupBy("vid").agg(F.min(F.struct("uid", *have, *[f"{c}_status" for c in have])).alias("q"))
    texts = [quality_text(F.col(f"q.{c}"), F.col(f"q.{c}_status")).alias(c) if c in have else F.lit("").alias(c) for c in QC_VALUES]
    return first.select("vid", *texts)


def dimension_text(*parts: Column) -> Column:
    """All dimensions separated by blanks; an absent part is skipped, an empty one leaves its blank."""
    return F.concat_ws(" ", *[F.array_join(F.split(p, r"\|"), " ") for p in parts])


def other_text(own: Column, general: Column) -> Column:
    """The variable's text only where it says something else than the general one."""
    return F.when(own != general, own).otherwise("")


def star(variables: DataFrame, var: DataFrame, structures: DataFrame, shapes: DataFrame, times: DataFrame) -> DataFrame:
    """Variables with the records they point to; ``broken`` names what could not be resolved."""
    v = var.select(F.col("uid").alias("vid"), F.col("label").alias("var_label"), F.col("title").alias("var_title"), "units",
                   F.col("description").alias("var_description"), "sn")
    s = structures.select(F.col("uid").alias("stid"), "spid", "tmid", "odims", "coords", "cell_methods", "cell_measures", F.col("title").alias("structure_title"))
    sp = shapes.select(F.col("uid").alias("spid"), F.col("dimensions").alias("space_dims"))
    tm = times.select(F.col("uid").alias("tmid"), F.col("dimensions").alias("time_dims"))
    s = s.join(sp, "spid", "left").join(tm, "tmid", "left")
    joined = variables.join(v, ["vid"], "left")
    joined = joined.join(s, ["stid"], "left")
    return broken_parts(joined, {
        "var": F.col("var_label").isNotNull(), "struct": F.col("structure_title").isNotNull(),
        "time": F.col("time_dims").isNotNull(), "spatial": F.col("space_dims").isNotNull()})


def wide_table(variables: DataFrame, var: DataFrame, structures: DataFrame, shapes: DataFrame, times: DataFrame, qc: DataFrame,
               priorities: DataFrame | None = None) -> DataFrame:
    """One row per resolved variable.  ``priorities(vid, priority)`` replaces the default priority where it has a row."""
    rows = star(variables, var, structures, shapes, times).where(F.col("broken").isNull())
    rows = rows.join(first_quality_range(qc).withColumnRenamed("vid", "uid"), "uid", "left")
    priority = F.col("default_priority")
    if priorities is not None:
        rows = rows.join(priorities.select(F.col("vid").alias("uid"), F.col("priority").alias("_p")), "uid", "left")
        priority = F.coalesce("_p", "default_priority")
    return rows.select(
        "mip_table", priority.alias("priority"), F.col("var_title").alias("long_name"), "units",
        F.col("var_description").alias("description"), other_text(F.col("description"), F.col("var_description")).alias("comment"),
        F.col("var_label").alias("variable_name"), F.col("sn").alias("standard_name"), "cell_methods", "positive", "type",
        dimension_text(F.col("space_dims"), F.col("odims"), F.col("time_dims"), F.col("coords")).alias("dimensions"),
        F.col("label").alias("cmor_name"), "modeling_realm", "frequency", "cell_measures", "prov", "prov_note", "row_index", "uid", "vid", "stid", "structure_title",
        *[F.coalesce(c, F.lit("")).alias(c) for c in QC_VALUES])


def in_table_order(wide: DataFrame) -> DataFrame:
    """Ordinary tables first, the annex ones last; inside a table by provenance, row and label."""
    return wide.orderBy(table_class(F.col("mip_table")), "mip_table", "prov", "row_index", "cmor_name", "uid")


def quantity_records(variables: DataFrame, var: DataFrame) -> DataFrame:
    """The quantities that some variables belong to, by standard name and label."""
    used = variables.select(F.col("vid").alias("uid")).distinct()
    return var.join(used, "uid", "left_semi").select("title", "units", "description", "label", "sn").orderBy("sn", "label")


def with_mips(wide: DataFrame, covered: DataFrame, name: str = "mips") -> DataFrame:
    """Adds the requesting projects, a closed vocabulary, as sorted text."""
    m = covered.groupBy(F.col("vid").alias("uid")).agg(string_set("mip").alias(name))
    return wide.join(m, "uid", "left").withColumn(name, F.coalesce(name, F.lit("")))


# --- priorities ----------------------------------------------------------------------------------------

def lowest_priorities(links: DataFrame, items: DataFrame, experiments: DataFrame, request_vars: DataFrame) -> DataFrame:
    """``(mip, expt, vid, priority)``: lowest priority value among the links of a project that serve an experiment."""
    served = with_link(link_experiments(items, experiments), links, "mip", "refid")
    groups = served.select("mip", "expt", "refid").distinct()
    rv = request_vars.groupBy(F.col("vgid").alias("refid"), "vid").agg(F.min("priority").alias("priority"))
    pairs = meet_by_experiment(groups, rv, request_vars)
    return pairs.groupBy("mip", "expt", "_share", "vid").agg(F.min("priority").alias("priority")).drop("_share")


def rank_variables(variables: DataFrame, var: DataFrame, request_vars: DataFrame, placeholder: Column) -> DataFrame:
    """Per quantity: lowest priority value of its variables as a key, with x if its standard name is a placeholder, and
    its realms; quantities without a request are left out."""
    low = request_vars.groupBy(F.col("vid").alias("uid")).agg(F.min("priority").alias("priority"))
    v = variables.select("uid", "vid", "modeling_realm").join(low, "uid", "left")
    best = v.groupBy("vid").agg(F.min("priority").alias("priority"))
    realms = v.select("vid", F.explode(F.split("modeling_realm", " ")).alias("realm")).where(~F.col("realm").isin("", UNSET))
    realms = realms.groupBy("vid").agg(string_set("realm", " ").alias("realms"))
    return (var.join(best, var["uid"] == best["vid"]).drop("vid").join(realms, var["uid"] == realms["vid"], "left").drop("vid")
            .where(F.col("priority").isNotNull())
            .select("label", F.concat(F.col("priority").cast("string"), F.when(placeholder, "x").otherwise("")).alias("key"),
                    F.coalesce("realms", F.lit("")).alias("realms")))


def two_lowest(request_vars: DataFrame) -> DataFrame:
    """``(vid, p1, p2)``: the two lowest priority values of variables with at least two requests.

    Requests are counted per priority value first, so a popular variable brings a few rows, not all its requests.
    """
    counted = request_vars.groupBy("vid", "priority").agg(F.count(F.lit(1)).alias("n"))
    per = counted.groupBy("vid").agg(F.sort_array(F.collect_list(F.struct("priority", "n"))).alias("p"), F.sum("n").alias("n"))
    first = F.get("p", F.lit(0))
    second = F.when(first["n"] > 1, first["priority"]).otherwise(F.get("p", F.lit(1))["priority"])
    return per.where(F.col("n") > 1).select("vid", first["priority"].alias("p1"), second.alias("p2"))


def rank_table_variables(variables: DataFrame, var: DataFrame, request_vars: DataFrame, placeholder: Column) -> DataFrame:
    """Variables by their two lowest priority values, ``p1-p2``, with x if the standard name is a placeholder."""
    names = var.select(F.col("uid").alias("vid"), F.col("label").alias("var_label"), placeholder.alias("_x"))
    v = variables.select("uid", "vid", "mip_table", "label").join(names, ["vid"])
    two = two_lowest(request_vars).withColumnRenamed("vid", "uid")
    key = F.concat(F.col("p1").cast("string"), F.lit("-"), F.col("p2").cast("string"), F.when(F.col("_x"), "x").otherwise(""))
    return v.join(two, "uid").select("uid", F.concat_ws(".", "mip_table", "label").alias("variable"), "var_label", key.alias("key"))


def title_mismatch(variables: DataFrame, var: DataFrame) -> DataFrame:
    """Variables whose title is not that of their quantity."""
    v = var.select(F.col("uid").alias("vid"), F.col("title").alias("var_title"))
    return variables.join(v, ["vid"]).where(F.col("title") != F.col("var_title")).select(
        "uid", F.concat_ws(".", "mip_table", "label").alias("variable"), "title", "var_title")


def realm_counts(variables: DataFrame, var: DataFrame) -> DataFrame:
    """Per realm word: distinct variables, quantities and standard names."""
    v = variables.select("uid", "vid", F.explode(F.split("modeling_realm", r"\s+")).alias("realm"))
    v = v.join(var.select(F.col("uid").alias("vid"), "sn"), ["vid"], "left")
    # one row per variable, then per quantity, then per standard name, each counted plainly
    n = v.select("realm", "uid", "vid", "sn").distinct()
    counts = [n.select("realm", c).distinct().groupBy("realm").agg(F.count(c).alias(name)) for c, name in (("uid", "variables"), ("vid", "quantities"), ("sn", "standard_names"))]
    return counts[0].join(counts[1], "realm").join(counts[2], "realm")
