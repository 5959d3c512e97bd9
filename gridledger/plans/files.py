"""Queries that write a section or table with a sink and read it back with the matching source.

The files go to a new folder below the shared one, so that every executor reaches them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.functions.coerce import integer_problem, to_text, typed, violations
from gridledger.operators.links import union_all
from gridledger.plans.registry import query
from gridledger.plans.roles import Catalogue
from gridledger.plans.tables import STAR, wide
from gridledger.session import shared_dir
from gridledger.sources import catalog as C
from gridledger.sources import sinks as K


def new_folder(cat: Catalogue, name: str) -> str:
    return f"{shared_dir(cat.spark)}/gridledger-{name}-{uuid.uuid4().hex}"


VARIABLE = C.SectionSchema(
    types={"uid": "aa:st__uid", "vid": "xs:string", "label": "xs:string", "frequency": "xs:string", "rowIndex": "xs:integer", "levels": "aa:st__integerListMonInc",
           "active": "xs:boolean", "note": "xs:string"},
    required={"uid": None, "label": None, "rowIndex": None}, links={"vid": "scalar"})


def as_document(cat: Catalogue) -> str:
    """Variables as catalogue documents, as many as tasks, each with one section of any size."""
    v = cat["x_cmorvar"]
    odd = F.col("row_index") % 2 == 1
    items = v.select(F.concat(F.lit("v"), F.col("uid").cast("string")).alias("_uid"), F.col("vid").alias("_vid"), F.col("label").alias("_label"),
                     F.col("frequency").alias("_frequency"), F.when(F.col("row_index") % 7 == 0, "").when(F.col("row_index") % 7 == 1, "n/a").otherwise(F.col("row_index").cast("string")).alias("_rowIndex"),
                     F.concat_ws(" ", (F.col("row_index") % 5).cast("string"), F.lit("3")).alias("_levels"), F.when(odd, "true").otherwise("0").alias("_active"),
                     F.when(odd, F.col("title")).alias("_note"))
    folder = new_folder(cat, "documents")
    items.write.format("xml").option("rootTag", "CMORvar").option("rowTag", "item").option("declaration", "").save(folder)
    return folder


@query("xml_catalogue_scan", """
SELECT concat('v', uid) AS uid, vid, label, frequency, CASE WHEN row_index % 7 = 0 THEN 0 WHEN row_index % 7 = 1 THEN NULL ELSE row_index END AS "rowIndex",
 concat(row_index % 5, ' 3') AS levels, row_index % 2 = 1 AS active, CASE WHEN row_index % 2 = 1 THEN title END AS note FROM x_cmorvar""")
def xml_catalogue_scan(cat):
    text, _ = C.read_section(cat.spark, as_document(cat), "CMORvar", VARIABLE)
    section = typed(text, VARIABLE.types, VARIABLE.required)
    return section.withColumn("levels", to_text(F.col("levels"), VARIABLE.types["levels"]))


@query("xml_catalogue_problems", """
SELECT attr, problem, count(*) AS n FROM (
 SELECT 'rowIndex' AS attr, CASE WHEN row_index % 7 = 0 THEN 'blank integer set to 0' WHEN row_index % 7 = 1 THEN 'integer unreadable' END AS problem FROM x_cmorvar
 UNION ALL SELECT 'levels', CASE WHEN row_index % 5 > 3 THEN 'list decreases' END FROM x_cmorvar) WHERE problem IS NOT NULL GROUP BY attr, problem""")
def xml_catalogue_problems(cat):
    text, _ = C.read_section(cat.spark, as_document(cat), "CMORvar", VARIABLE)
    return violations(text, "CMORvar", VARIABLE.types, VARIABLE.required).groupBy("attr", "problem").agg(F.count(F.lit(1)).alias("n"))


@query("sink_wide_text", f"""
WITH {STAR} SELECT mip_table AS "table", uid, priority, dimensions, replace(comment, '"', '''') AS comment, valid_max FROM w""")
def sink_wide_text(cat):
    folder = new_folder(cat, "wide")
    K.write_wide_text(wide(cat), folder)
    back = cat.spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(folder)
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return back.select(F.col("table").cast("string").alias("table"), F.col("uid").cast("bigint").alias("uid"), F.col("priority").cast("bigint").alias("priority"),
                       text("dimensions"), text("comment"), text("valid_max"))


@query("sink_by_request", """
SELECT l.mip, l.objective AS experiment, count(*) AS links FROM x_request_link l GROUP BY l.mip, l.objective""")
def sink_by_request(cat):
    folder = new_folder(cat, "requests")
    links: DataFrame = cat["x_request_link"].select("mip", F.col("objective").alias("experiment"), "uid")
    K.write_by_request(links, folder, "mip", "experiment")
    return cat.spark.read.parquet(folder).groupBy(F.col("mip").cast("string").alias("mip"), F.col("experiment").cast("string").alias("experiment")).agg(
        F.count(F.lit(1)).alias("links"))


@query("sink_lines", """
SELECT concat('RewriteRule ^', replace(c_name, '#', ''), '$ http://catalogue.example/u/', c_custkey, '.html') AS value FROM customer""")
def sink_lines(cat):
    folder = new_folder(cat, "lines")
    names = cat["customer"].select(F.replace("c_name", F.lit("#"), F.lit("")).alias("label"), F.col("c_custkey").alias("uid"))
    rules, _ = K.rewrite_rules(names, "http://catalogue.example/u")
    K.write_lines(rules, folder)
    return cat.spark.read.text(folder)


@query("sink_rows", """
SELECT concat(label, ' ', uid) AS var, sn, title AS ln, units AS u, description AS d, uid FROM x_var WHERE uid IN (SELECT vid FROM x_cmorvar)""")
def sink_rows(cat):
    folder = new_folder(cat, "rows")
    K.write_rows(K.used_variable_rows(cat["x_var"], cat["x_cmorvar"]), folder)
    return cat.spark.read.schema("var string, sn string, ln string, u string, d string, uid string").json(folder)


# --- definitions, manifests and side tables ------------------------------------------------------------

def text_document(cat: Catalogue, name: str, lines: DataFrame) -> str:
    """``lines(value)`` with the columns that order them as a folder of text files, whose names continue that order."""
    order = [c for c in lines.columns if c != "value"]
    folder = new_folder(cat, name)
    tasks = int(cat.spark.conf.get("spark.sql.shuffle.partitions"))
    lines.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("value").write.text(folder)
    return folder


ATTRIBUTES_A_SECTION = 50

# fifty parts are the attributes of a section
DEFINED = """d AS (SELECT p_partkey AS k, floor(p_partkey / 50) AS s, concat('s', CAST(floor(p_partkey / 50) AS BIGINT)) AS section, concat('a', p_partkey) AS label, p_name AS name FROM part)"""


def definition_document(cat: Catalogue) -> str:
    """Parts as attributes and fifty neighbours as a section, as one definition document."""
    k = F.col("p_partkey")
    s = F.floor(k / ATTRIBUTES_A_SECTION)
    escaped = F.replace(F.replace("p_name", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    kind = F.when(k % 3 == 1, ' type="xs:integer"').when(k % 3 == 2, ' type="aa:st__uid"').otherwise("")
    attribute = F.concat(F.format_string(' <rowAttribute label="a%d" title="Part %d"', k, k), kind, F.when(k % 2 == 0, ' required="0"').otherwise(""),
                         F.lit(' description="about '), escaped, F.lit('"/>'))
    sections = cat["part"].select(s.alias("s")).distinct()
    start = sections.select("s", F.lit(0).alias("turn"), F.lit(0).cast("bigint").alias("k"), F.format_string('<table label="s%d" title="1.%d section">', "s", "s").alias("value"))
    end = sections.select("s", F.lit(2).alias("turn"), F.lit(0).cast("bigint").alias("k"), F.lit("</table>").alias("value"))
    inner = cat["part"].select(s.alias("s"), F.lit(1).alias("turn"), k.cast("bigint").alias("k"), attribute.alias("value"))
    return text_document(cat, "definition", start.unionByName(inner).unionByName(end))


@query("definition_sections", f"WITH {DEFINED} SELECT DISTINCT concat('1.', CAST(s AS BIGINT), ' section') AS title, section AS label FROM d")
def definition_sections(cat):
    return C.list_sections(C.read_definition(cat.spark, definition_document(cat))[0])


@query("definition_attributes", f"""
WITH {DEFINED} SELECT section, label, CASE k % 3 WHEN 1 THEN 'xs:integer' WHEN 2 THEN 'aa:st__uid' ELSE 'xs:string' END AS type, concat('about ', name) AS description,
 k % 2 <> 0 AS required FROM d""")
def definition_attributes(cat):
    return C.read_definition(cat.spark, definition_document(cat))[1].select("section", "label", "type", "description", "required")


@query("attribute_definitions", f"""
WITH {DEFINED}, a AS (SELECT * FROM d WHERE section = 's1'), l AS (SELECT string_agg(label, ' ' ORDER BY label) AS names FROM a)
SELECT 's1' AS query, 'section' AS finding, '1.1 section' AS section_title, CAST(NULL AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS description, names AS attributes FROM l
UNION ALL SELECT 's1:none', 'attribute not found', '1.1 section', NULL, NULL, names FROM l
UNION ALL SELECT 's1:a60', 'attribute', '1.1 section', concat('Part ', k), concat('about ', name), names FROM l, a WHERE label = 'a60'
UNION ALL SELECT 'nowhere', 'unknown section', NULL, NULL, NULL, '' """)
def attribute_definitions(cat):
    sections, attributes = C.read_definition(cat.spark, definition_document(cat))
    return union_all([C.attribute_definition(sections, attributes, q) for q in ("s1", "s1:none", "s1:a60", "nowhere")])


@query("section_attribute_list", f"WITH {DEFINED} SELECT label FROM d WHERE section = 's2'")
def section_attribute_list(cat):
    return C.section_attributes(C.read_definition(cat.spark, definition_document(cat))[1], "s2")


@query("schema_only_load", f"WITH {DEFINED} SELECT section, count(*) AS attributes FROM d GROUP BY section")
def schema_only_load(cat):
    got = C.load(cat.spark, [(None, definition_document(cat))], schema_only=True)
    return got.meta_attribute.groupBy("section").agg(F.count(F.lit(1)).alias("attributes"))


def _halves(cat: Catalogue) -> list[str]:
    """The variables in two documents with the same section."""
    out = []
    for odd in (0, 1):
        v = cat["x_cmorvar"].where(F.col("uid") % 2 == odd)
        items = v.select(F.concat(F.lit("v"), F.col("uid").cast("string")).alias("_uid"), F.col("vid").alias("_vid"), F.col("label").alias("_label"), F.col("row_index").cast("string").alias("_rank"))
        folder = new_folder(cat, "half")
        items.write.format("xml").option("rootTag", "CMORvar").option("rowTag", "item").option("declaration", "").save(folder)
        out.append(folder)
    return out


def _variable_definition(cat: Catalogue) -> str:
    text = lambda name, kind, use=None: F.struct(F.lit(name).alias("_label"), F.lit(kind).alias("_type"), F.lit(use).cast("string").alias("_useClass"))
    attributes = F.array(text("uid", "aa:st__uid"), text("vid", "xs:string", "internalLink"), text("label", "xs:string"), text("rank", "xs:integer"))
    folder = new_folder(cat, "definition")
    one = cat.spark.range(1).select(F.lit("CMORvar").alias("_label"), F.lit("1 Variables").alias("_title"), attributes.alias("rowAttribute"))
    one.write.format("xml").option("rootTag", "tables").option("rowTag", "table").option("declaration", "").save(folder)
    return folder


@query("manifest_load", """
SELECT 'record' AS kind, concat('v', uid) AS uid, label AS value, row_index AS rank FROM x_cmorvar
UNION ALL SELECT 'link', concat('v', uid), vid, NULL FROM x_cmorvar""")
def manifest_load(cat):
    definition = _variable_definition(cat)
    lines = [(0, "## two documents")] + [(k + 1, f"{doc} {definition}") for k, doc in enumerate(_halves(cat))]
    pairs = C.read_manifest(cat.spark, text_document(cat, "manifest", C.rows(cat.spark, lines, ["k", "value"])))
    got = C.load(cat.spark, pairs)
    records = got.sections["CMORvar"].select(F.lit("record").alias("kind"), "uid", F.col("label").alias("value"), "rank")
    return records.unionByName(got.links.select(F.lit("link").alias("kind"), F.col("src_uid").alias("uid"), F.col("dst_uid").alias("value"), F.lit(None).cast("bigint").alias("rank")))


@query("document_versions", """
WITH d AS (SELECT floor(c_custkey / 500) AS d, concat('01.00.', min(c_custkey) % 4) AS version FROM customer GROUP BY 1)
SELECT version, count(*) AS documents, (SELECT count(DISTINCT version) FROM d) AS versions, (SELECT count(DISTINCT version) > 1 FROM d) AS conflict FROM d GROUP BY version""")
def document_versions(cat):
    # a document for five hundred customers, with its version in one of its lines
    c = cat["customer"].select(F.floor(F.col("c_custkey") / 500).alias("doc"), F.col("c_custkey").alias("k"))
    line = F.format_string('<item uid="%d"/>', "k")
    version = c.groupBy("doc").agg(F.min("k").alias("k")).select("doc", F.concat(F.lit("<pav:version>01.00."), (F.col("k") % 4).cast("string"), F.lit("</pav:version>")).alias("value"))
    folder = new_folder(cat, "documents")
    lines = version.unionByName(c.select("doc", line.alias("value")))
    lines.repartition("doc").write.partitionBy("doc").text(folder)
    versions = C.read_versions(cat.spark, [folder])
    found = versions.groupBy("version").agg(F.count(F.lit(1)).alias("documents"))
    conflict = C.version_conflict(versions)
    return found.select("version", "documents", conflict.select("versions").scalar().alias("versions"), conflict.select("conflict").scalar().alias("conflict"))


@query("newest_version", "SELECT c_custkey, concat('v', c_custkey % 3) AS version FROM customer WHERE c_custkey % 3 = (SELECT max(c_custkey % 3) FROM customer)")
def newest_version(cat):
    folder = new_folder(cat, "versions")
    c = cat["customer"].select("c_custkey", F.concat(F.lit("v"), (F.col("c_custkey") % 3).cast("string")).alias("version"))
    c.write.partitionBy("version").parquet(folder)
    return C.pick_version(cat.spark.read.parquet(folder)).select("c_custkey", F.col("version").cast("string").alias("version"))


@query("info_rows", "SELECT p_name AS name, concat('part \"', p_partkey, '\"') AS text FROM part")
def info_rows(cat):
    line = F.concat("p_name", F.lit('\tpart "'), F.col("p_partkey").cast("string"), F.lit('"'))
    return C.read_info_rows(cat.spark, text_document(cat, "info", cat["part"].select(F.col("p_partkey").alias("k"), line.alias("value"))))


@query("block_schema", """
SELECT p_name AS name, p_brand AS kind, p_partkey % 2 = 0 AS core FROM part""")
def block_schema(cat):
    k = F.col("p_partkey")
    cells = F.concat_ws("\t", "p_name", "p_brand", F.when(k % 2 == 0, "1").otherwise("0"))
    head = C.rows(cat.spark, [(-3, "core attributes"), (-2, "----"), (-1, "name\tkind\tcore")], ["k", "value"])
    return C.read_block_schema(cat.spark, text_document(cat, "block", head.unionByName(cat["part"].select(k.cast("bigint").alias("k"), cells.alias("value")))))


@query("integer_problems", """
SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 2 THEN 'not an integer' WHEN 3 THEN 'not an integer' WHEN 4 THEN 'NOT STRING' END AS problem FROM lineitem""")
def integer_problems(cat):
    n = F.col("l_linenumber")
    key = F.col("l_partkey").cast("string")
    text = F.when(n == 2, F.concat(key, F.lit(".5"))).when(n == 3, F.concat(F.lit("x"), key)).when(n != 4, key)
    return cat["lineitem"].select("l_orderkey", "l_linenumber", integer_problem(text).alias("problem"))
