"""Reading catalogue documents: schema definitions, sections, manifests, versions and small side tables.

A section is declared by the definition document, so its schema is data.  The attributes of the sections that are loaded are the only thing
read on the driver, to name the columns; records stay in Spark.  Documents are read tag by tag (``ordered``), by as many tasks as
they have blocks, whatever the size of a section; all sections of a document come from one scan.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.functions.coerce import typed, violations
from gridledger.operators.links import edges, uid_index, union_all
from gridledger.session import shared_dir
from gridledger.sources import ordered as O

_SECTION_HEAD = ["label", "title", "id", "uid", "itemLabelMode", "level", "maxOccurs", "labUnique", "description"]
_ATTRIBUTE = ["label", "title", "type", "useClass", "techNote", "description", "uid", "required"]


_DOCUMENT_HEAD = ["label", "title", "uid", "id", "useClass"]


def rows(spark: SparkSession, values: list[tuple], names: list[str]) -> DataFrame:
    """A table of literal rows."""
    return spark.createDataFrame(values, names)


# --- schema documents ----------------------------------------------------------------------------------

def read_definition(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(meta_section, meta_attribute)`` of a definition document; an attribute without a type is text and is required
    unless marked 0 or false."""
    inner, outer = O.within(O.tags(spark, path), "rowAttribute", ["table"])
    names = lambda a, cols: [F.col(f"{a}._{c}").alias(c) for c in cols]
    sections = outer.select(O.attributes(F.col("head"), _SECTION_HEAD).alias("a")).select(*names("a", _SECTION_HEAD))
    found = inner.select(O.attributes(F.col("head"), ["label"])["_label"].alias("section"), "place", O.attributes(F.col("inner_head"), _ATTRIBUTE).alias("a"))
    a = found.select("section", "place", *names("a", _ATTRIBUTE))
    a = a.withColumns({"type": F.coalesce("type", F.lit("xs:string")), "required": ~F.coalesce("required", F.lit("1")).isin("0", "false")})
    # a repeated declaration replaces the earlier one
    last = a.groupBy("section", "label").agg(F.max(F.struct("place", *[c for c in _ATTRIBUTE if c != "label"])).alias("r"))
    return sections, last.select("section", "label", "r.*").drop("place")


def read_block_schema(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated table of core attributes: two lines to skip, a header, flags as 1, short lines padded."""
    lines = O.numbered(O.pieces(spark, path))
    names = [n.strip() for n in lines.where(F.col("line") == 2).head()["value"].split("\t")]
    parts = F.split(F.rtrim("value"), "\t")
    last = len(names) - 1
    cell = lambda i: F.coalesce(F.get(parts, F.lit(i)), F.lit(""))
    # a short line has its flag as its last cell
    flag = F.element_at(parts, -1) == "1"
    out = [(F.when(F.size(parts) <= i, F.lit("")).otherwise(F.when(F.size(parts) - 1 == i, flag.cast("string")).otherwise(cell(i)))).alias(n)
           if i != last else F.when(F.size(parts) > last, flag).otherwise(F.lit(False)).alias(n) for i, n in enumerate(names)]
    return lines.where((F.col("line") > 2) & (F.trim("value") != "")).select(*out)


def list_sections(sections: DataFrame) -> DataFrame:
    return sections.select("title", "label").orderBy("title", "label")


def section_attributes(attributes: DataFrame, section: str) -> DataFrame:
    return attributes.where(F.col("section") == section).select("label").orderBy("label")


def attribute_definition(sections: DataFrame, attributes: DataFrame, query: str) -> DataFrame:
    """``section`` or ``section:attribute``: one row with the finding, or with help on what exists."""
    section, _, attr = query.partition(":")
    own = attributes.where(F.col("section") == section)
    asked = own.where(F.col("label") == attr)
    one = sections.sparkSession.range(1).select(          # a single row, filled by scalar subqueries
        F.lit(query).alias("query"),
        sections.where(F.col("label") == section).agg(F.max("title")).scalar().alias("section_title"),
        asked.agg(F.max("title")).scalar().alias("title"), asked.agg(F.max("description")).scalar().alias("description"),
        own.agg(F.array_join(F.sort_array(F.collect_set("label")), " ")).scalar().alias("attributes"))
    finding = (F.when(F.col("section_title").isNull(), "unknown section")
               .when(F.lit(attr == ""), "section").when(F.col("title").isNull(), "attribute not found").otherwise("attribute"))
    return one.select("query", finding.alias("finding"), "section_title", "title", "description", "attributes")


# --- documents -----------------------------------------------------------------------------------------

@dataclass
class SectionSchema:
    """Declared types, required attributes and link attributes of one section."""

    types: dict[str, str]
    required: dict[str, str | None]
    links: dict[str, str]


def section_schemas(attributes: DataFrame) -> dict[str, SectionSchema]:
    out: dict[str, SectionSchema] = {}
    for r in attributes.select("section", "label", "type", "useClass", "required").collect():   # bounded by the definition
        s = out.setdefault(r["section"], SectionSchema({}, {}, {}))
        s.types[r["label"]] = r["type"]
        if r["required"]:
            s.required[r["label"]] = None
        if r["useClass"] in ("internalLink", "internalLinkList"):
            s.links[r["label"]] = "list" if r["useClass"].endswith("List") else "scalar"
    return out


def read_records(spark: SparkSession, path: str, attributes: dict[str, list[str]]) -> tuple[DataFrame, DataFrame]:
    """``(records as text, section heads)`` of all sections of a document at once.

    ``attributes`` names the attributes of each section. A record has its ``section`` and the attributes of all of them, null where
    it has none; a head has how many ``records`` its element holds.
    """
    every = sorted({a for names in attributes.values() for a in names})
    inner, outer = O.within(O.tags(spark, path), "item", sorted(attributes))
    records = inner.select(F.col("name").alias("section"), O.attributes(F.col("inner_head"), every).alias("i"))
    sizes = inner.groupBy("at").agg(F.count(F.lit(1)).alias("records"))
    head = outer.join(sizes, "at", "left").select(O.attributes(F.col("head"), _DOCUMENT_HEAD).alias("a"), F.coalesce("records", F.lit(0)).alias("records"))
    return (records.select("section", *[F.col(f"i._{a}").alias(f"_{a}") for a in every]),
            head.select(*[F.col(f"a._{c}").alias(c) for c in _DOCUMENT_HEAD], "records"))


def read_section(spark: SparkSession, path: str, section: str, schema: SectionSchema) -> tuple[DataFrame, DataFrame]:
    """``(records as text, section heads)`` of one section; the text table goes through ``typed`` and ``violations``."""
    records, head = read_records(spark, path, {section: list(schema.types)})
    return records.select(*[F.col(f"_{a}").alias(a) for a in schema.types]), head


def repeated_sections(heads: DataFrame) -> DataFrame:
    """Sections that a document holds more than once, which is not allowed."""
    return heads.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


@dataclass
class Collection:
    """The typed sections of a set of documents with their links, index and problems."""

    meta_section: DataFrame
    meta_attribute: DataFrame
    sections: dict[str, DataFrame]
    problems: DataFrame | None
    links: DataFrame | None
    index: DataFrame | None


def read_manifest(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(document, definition) pairs; the first line is a title."""
    lines = [r["value"] for r in O.numbered(O.pieces(spark, path)).orderBy("line").collect()]    # a list of a few files
    pairs = [line.split() for line in lines[1:] if line.strip()]
    for p in pairs:
        if len(p) < 2:
            raise ValueError(f"cannot read the manifest line {p}")
    return [(p[0], p[1]) for p in pairs]


def load(spark: SparkSession, pairs: list[tuple[str | None, str]], schema_only: bool = False) -> Collection:
    """One collection out of several (document, definition) pairs; ``schema_only`` reads the definitions alone.

    A document is scanned once: its records are kept in the shared folder by section, and the sections read from there.
    """
    definitions = [read_definition(spark, d) for _, d in pairs]
    meta_section = union_all([s for s, _ in definitions])
    meta_attribute = union_all([a for _, a in definitions])
    if schema_only:
        return Collection(meta_section, meta_attribute, {}, None, None, None)
    parts: dict[str, list[DataFrame]] = {}
    problems, kinds = [], {}
    for (doc, _), (_, attributes) in zip(pairs, definitions):
        schemas = {name: x for name, x in section_schemas(attributes).items() if not name.startswith("__")}
        records, _ = read_records(spark, doc, {name: list(x.types) for name, x in schemas.items()})
        folder = f"{shared_dir(spark)}/gridledger-records-{uuid.uuid4().hex}"
        records.write.partitionBy("section").parquet(folder)
        kept = spark.read.schema(records.schema).parquet(folder)
        for name, schema in schemas.items():
            text = kept.where(F.col("section") == name).select(*[F.col(f"_{a}").alias(a) for a in schema.types])
            parts.setdefault(name, []).append(typed(text, schema.types, schema.required))
            problems.append(violations(text, name, schema.types, schema.required))
            if schema.links:
                kinds.setdefault(name, {}).update(schema.links)
    # a section that several documents hold is one section; an attribute that a document does not declare is unset there
    sections = {name: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found) for name, found in parts.items()}
    links = edges(sections, kinds) if kinds else None
    return Collection(meta_section, meta_attribute, sections, union_all(problems), links, uid_index(sections))


def read_versions(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(document, version)`` from the version element of each document."""
    line = spark.read.text(paths).select(F.input_file_name().alias("document"), F.regexp_extract("value", r"<pav:version>([^<]*)</pav:version>", 1).alias("version"))
    found = line.groupBy("document").agg(F.max("version").alias("version"))          # lines without one are empty
    return found


def version_conflict(versions: DataFrame) -> DataFrame:
    """How many versions meet in one load, and whether that is a conflict."""
    n = versions.agg(F.count_distinct("version").alias("versions"))
    return n.select("versions", (F.col("versions") > 1).alias("conflict"))


def pick_version(table: DataFrame, version: str | None = None) -> DataFrame:
    """The rows of one version of a table partitioned by ``version``, the newest without a choice."""
    if version is None:
        return table.where(F.col("version") == table.agg(F.max("version")).scalar())
    return table.where(F.col("version") == version)


def read_info_rows(spark: SparkSession, path: str) -> DataFrame:
    """Two tab-separated columns: name and explanation."""
    return spark.read.csv(path, sep="\t", schema="name string, text string", quote="")
