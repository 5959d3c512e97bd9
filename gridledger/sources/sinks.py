"""Writing tables: wide text tables, outputs by project and experiment, row notation, rewrite rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.functions.coerce import to_text
from gridledger.functions.text import table_class

SIMPLE_NAME = r"^[a-zA-Z][a-zA-Z0-9]*$"


def write_wide_text(wide: DataFrame, path: str) -> None:
    """Tab-separated text per table, the table name as the first column and double quotes as single ones."""
    texts = [F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'), F.lit("'")).alias(c) for c in wide.columns]
    rows = wide.select(*texts).withColumn("table", F.col("mip_table"))
    # range partitioning keeps a table together where it is small and cuts it where it is large
    rows = rows.repartitionByRange("table", "prov", "row_index", "cmor_name").sortWithinPartitions(
        table_class(F.col("table")), "table", "prov", "row_index", "cmor_name")
    rows.write.partitionBy("table").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).mode("errorifexists").csv(path)


def write_by_request(df: DataFrame, path: str, *keys: str) -> None:
    """Files by project and experiment; a large combination is written by several tasks."""
    df.repartitionByRange(*keys, *[c for c in df.columns if c not in keys][:1]).write.partitionBy(*keys).mode("errorifexists").parquet(path)


def used_variable_rows(var: DataFrame, variables: DataFrame) -> DataFrame:
    """Label with uid, standard name, title, units and description of the quantities in use, safe for quoting."""
    safe = lambda c: F.replace(c, F.lit('"'), F.lit("'"))
    used = var.join(variables.select(F.col("vid").alias("uid")).distinct(), "uid", "left_semi")
    return used.select(
        safe(F.concat_ws(" ", "label", "uid")).alias("var"), safe(F.col("sn")).alias("sn"), safe(F.col("title")).alias("ln"),
        safe(F.col("units")).alias("u"), safe(F.col("description")).alias("d"), "uid")


def write_rows(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)


def rewrite_rule(label: Column, uid: Column, base: str) -> Column:
    return F.format_string(f"RewriteRule ^%s$ {base}/%s.html", label, uid.cast("string"))


def rewrite_rules(var: DataFrame, base: str) -> tuple[DataFrame, DataFrame]:
    """Rules for quantities with a simple label, and the labels that are not simple."""
    simple = F.col("label").rlike(SIMPLE_NAME)
    return var.where(simple).select(rewrite_rule(F.col("label"), F.col("uid"), base).alias("value")), var.where(~simple).select("label")


def write_lines(df: DataFrame, path: str) -> None:
    df.select("value").write.mode("errorifexists").text(path)


def attribute_texts(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Typed columns back as attribute texts."""
    return df.select(*[to_text(F.col(c), types[c]).alias(c) if c in types else F.col(c).cast("string").alias(c) for c in df.columns])
