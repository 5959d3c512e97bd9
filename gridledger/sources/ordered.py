"""Large text documents read by many tasks at once, with the order of their lines or tags kept.

Spark cuts files into blocks and reads them apart. A piece of text (a line, or a tag with the text behind it) has its place: the
file, the block and its turn within the block. What depends on all that stands before a piece is found in two steps: a summary with one row
per block, summed up or carried on over the blocks, and a window within each block. No step takes a document whole.

A document is one file, or a folder whose files in the order of their names are its parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK = ["file", "block"]
_NAME = r"^(/?[\p{L}_:][\p{L}\p{N}_:.\-]*)"
_HEAD = r"""^((?:[^>"'/]++|/(?!>)|"[^"]*+"|'[^']*+')*+)/?>"""


def _before():
    """The blocks before a block; there is one row per block."""
    return Window.orderBy(*BLOCK).rowsBetween(Window.unboundedPreceding, -1)


def pieces(spark: SparkSession, path: str | list[str], sep: str | None = None) -> DataFrame:
    """``file, block, seq, value`` of the lines of a text, or of what stands between the separators."""
    reader = spark.read.option("lineSep", sep) if sep else spark.read
    return reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                    F.monotonically_increasing_id().alias("seq"), "value")


def numbered(rows: DataFrame) -> DataFrame:
    """All pieces of a document with their number ``line``, from 0."""
    blocks = rows.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    starts = blocks.select(*BLOCK, (F.coalesce(F.sum("n").over(_before()), F.lit(0)) - F.col("first")).alias("start"))
    return rows.join(starts, BLOCK).select(*rows.columns, (F.col("start") + F.col("seq")).alias("line"))


def carried(rows: DataFrame, marker: Column, name: str, inclusive: bool = True) -> DataFrame:
    """The rows with the last ``marker`` that is not null, at or (not ``inclusive``) before each of them in the document, as ``name``."""
    marked = rows.withColumn(name, marker)
    last = F.max(F.when(F.col(name).isNotNull(), F.struct("seq", name)))[name]
    blocks = marked.groupBy(*BLOCK).agg(last.alias("_last"))
    before = blocks.select(*BLOCK, F.last("_last", ignorenulls=True).over(_before()).alias("_before"))
    window = Window.partitionBy(*BLOCK).orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    here = marked.withColumn(name, F.last(name, ignorenulls=True).over(window))
    return here.join(before, BLOCK).withColumn(name, F.coalesce(name, "_before")).drop("_before")


def tags(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The tags of an XML document, ``file, block, seq, name, head``; the name of an end tag begins with a slash.

    ``head`` is the tag's text up to its end, for ``attributes``. Tags within comments and CDATA sections are left out; a document
    that is not well formed gives what looks like tags.
    """
    v = F.col("value")
    comment = F.when(v.startswith("!--"), ~v.contains("-->")).when(v.contains("-->"), F.lit(False))
    data = F.when(v.startswith("![CDATA["), ~v.contains("]]>")).when(v.contains("]]>"), F.lit(False))
    rows = carried(carried(pieces(spark, path, "<"), comment, "_comment", False), data, "_data", False)
    name = F.regexp_extract("value", _NAME, 1)
    seen = rows.where(~F.coalesce("_comment", F.lit(False)) & ~F.coalesce("_data", F.lit(False)) & (name != ""))
    return seen.select(*BLOCK, "seq", name.alias("name"), F.regexp_extract("value", _HEAD, 1).alias("head"))


def attributes(head: Column, names: list[str]) -> Column:
    """The attributes of a tag as a struct of texts, ``_`` before each name; one that is absent is null."""
    return F.from_xml(F.concat(F.lit("<"), head, F.lit("/>")), ", ".join(f"`_{n}` string" for n in names))


def within(rows: DataFrame, kind: str, enclosing: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(inner, outer)`` out of ``tags``: those named ``kind`` inside of enclosing elements, and the start tags of those elements.

    Both have the place ``at``, ``name`` and ``head`` of the enclosing element; an inner row has its own ``place`` and ``inner_head``.
    """
    at = F.struct(*BLOCK, "seq")
    starts = F.struct(at.alias("at"), F.col("name").alias("name"), F.col("head").alias("head"))
    ended = F.lit(None).cast("struct<at:struct<file:string,block:bigint,seq:bigint>,name:string,head:string>")
    ended = F.struct(*[ended[c].alias(c) for c in ("at", "name", "head")])
    marker = F.when(F.col("name").isin(enclosing), starts).when(F.col("name").isin([f"/{n}" for n in enclosing]), ended)
    found = carried(rows, marker, "outer").where((F.col("name") == kind) & F.col("outer.name").isNotNull())
    outer = rows.where(F.col("name").isin(enclosing)).select(at.alias("at"), "name", "head")
    return found.select(at.alias("place"), F.col("head").alias("inner_head"), "outer.at", "outer.name", "outer.head"), outer
