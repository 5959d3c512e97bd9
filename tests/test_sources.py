import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridledger.session import materialise, shared_dir
from gridledger.sources import catalog as C
from gridledger.sources import sinks as K

DEFINITION = """<?xml version="1.0" ?>
<doc xmlns="urn:example:framework">
<table label="var" uid="SECTION:var" title="1.2 Quantity" id="v" itemLabelMode="def" level="0" maxOccurs="1" labUnique="Yes" description="Quantities">
 <rowAttribute label="uid" type="aa:st__uid" title="Identifier" useClass="recordId" required="true"/>
 <rowAttribute label="label" title="Label" required="true"/>
 <rowAttribute label="label" type="xs:string" title="Record label" description="Short name" useClass="" required="true"/>
 <rowAttribute label="sn" type="xs:string" title="Name" useClass="internalLink" required="false"/>
 <rowAttribute label="rank" type="xs:integer" title="Rank" required="0"/>
</table>
<table label="name" uid="SECTION:name" title="1.10 Name" id="n" itemLabelMode="def" level="0" maxOccurs="1" labUnique="Yes" description="Names">
 <rowAttribute label="uid" type="aa:st__uid" title="Identifier"/>
 <rowAttribute label="label" type="xs:string" title="Label"/>
 <rowAttribute label="users" type="aa:st__stringList" title="Users" useClass="internalLinkList" required="false"/>
</table>
</doc>"""

DOCUMENT = """<?xml version="1.0" ?>
<document xmlns:pav="http://purl.org/pav/2.3" xmlns="urn:example:a">
<prologue><pav:version>01.00.{v}</pav:version></prologue>
<main>
<var label="var" uid="SECTION:var" useClass="vocab" title="1.2 Quantity" id="v">
 <item uid="v1" label="tas" sn="n1" rank="3"/>
 <item uid="v2" label="pr" sn="gone" rank="x"/>
 <item uid="v3" sn="n1"/>
</var>
<name label="name" uid="SECTION:name" useClass="vocab" title="1.10 Name" id="n">
 <item uid="n1" label="air" users="v1 v2"/>
</name>
</main>
</document>"""


@pytest.fixture
def docs(tmp_path):
    (tmp_path / "defn.xml").write_text(DEFINITION)
    (tmp_path / "doc.xml").write_text(DOCUMENT.replace("{v}", "33"))
    (tmp_path / "doc2.xml").write_text(DOCUMENT.replace("{v}", "34"))
    (tmp_path / "manifest.txt").write_text(f"## documents\n{tmp_path}/doc.xml {tmp_path}/defn.xml\n")
    return tmp_path


def test_definition(spark, docs):
    sections, attributes = C.read_definition(spark, str(docs / "defn.xml"))
    assert rows(C.list_sections(sections)) == [("1.10 Name", "name"), ("1.2 Quantity", "var")]
    assert rows(C.section_attributes(attributes, "var")) == [("label",), ("rank",), ("sn",), ("uid",)]
    assert rows(attributes.where("section = 'var'"), "label", "type", "required") == [
        ("label", "xs:string", True), ("rank", "xs:integer", False), ("sn", "xs:string", False), ("uid", "aa:st__uid", True)]
    ask = lambda q: rows(C.attribute_definition(sections, attributes, q), "finding", "title", "attributes")
    assert ask("var:label") == [("attribute", "Record label", "label rank sn uid")]
    assert ask("var:none") == [("attribute not found", None, "label rank sn uid")] and ask("zzz")[0][0] == "unknown section" and ask("name")[0][0] == "section"


def test_collection(spark, docs):
    pairs = C.read_manifest(spark, str(docs / "manifest.txt"))
    got = C.load(spark, pairs)
    assert rows(got.sections["var"], "uid", "label", "sn", "rank") == [("v1", "tas", "n1", 3), ("v2", "pr", "gone", None), ("v3", "__unset__", "n1", None)]
    assert rows(got.sections["name"], "uid", "users") == [("n1", ["v1", "v2"])]
    assert rows(got.problems, "uid", "attr", "problem") == [("v2", "rank", "integer unreadable"), ("v3", "label", "required attribute absent")]
    assert rows(got.links, "src_uid", "dst_uid") == [("n1", "v1"), ("n1", "v2"), ("v1", "n1"), ("v2", "gone"), ("v3", "n1")]
    assert rows(got.index, "uid", "section") == [("n1", "name"), ("v1", "var"), ("v2", "var"), ("v3", "var")]
    _, head = C.read_section(spark, pairs[0][0], "var", C.section_schemas(got.meta_attribute)["var"])
    assert rows(head, "label", "title", "records") == [("var", "1.2 Quantity", 3)] and rows(C.repeated_sections(head.union(head))) == [("var", 2)]
    both = C.load(spark, [pairs[0], (str(docs / "doc2.xml"), pairs[0][1])])            # two documents with the same sections
    assert both.sections["var"].count() == 6 and both.sections["name"].count() == 2 and both.index.count() == 8
    only = C.load(spark, pairs, schema_only=True)
    assert only.sections == {} and only.meta_section.count() == 2


def test_texts_again(spark, docs):
    got = C.load(spark, [(str(docs / "doc.xml"), str(docs / "defn.xml"))])
    types = C.section_schemas(got.meta_attribute)["name"].types
    assert rows(K.attribute_texts(got.sections["name"], types), "uid", "users") == [("n1", "v1 v2")]


def test_versions(spark, docs, table):
    one, two = (C.read_versions(spark, [str(docs / n) for n in names]) for names in (["doc.xml"], ["doc.xml", "doc2.xml"]))
    assert rows(C.version_conflict(one)) == [(1, False)] and rows(C.version_conflict(two)) == [(2, True)]
    t = table("uid string, version string", [("a", "01.00.32"), ("a", "01.00.33")])
    assert rows(C.pick_version(t)) == [("a", "01.00.33")] and rows(C.pick_version(t, "01.00.32")) == [("a", "01.00.32")]


def test_small_text_tables(spark, tmp_path):
    (tmp_path / "block.tsv").write_text("Block definition\t\t\n\t\t\nlabel\ttitle\trequired\nuid\tIdentifier\t1\nnote\tNote\t0\nshort\t1\n")
    assert rows(C.read_block_schema(spark, str(tmp_path / "block.tsv"))) == [("note", "Note", False), ("short", "true", False), ("uid", "Identifier", True)]
    (tmp_path / "info.tsv").write_text("Column A\tShape\nColumn B\tNumber of values\n")
    assert rows(C.read_info_rows(spark, str(tmp_path / "info.tsv"))) == [("Column A", "Shape"), ("Column B", "Number of values")]
    (tmp_path / "bad.txt").write_text("title\nonly-one\n")
    with pytest.raises(ValueError):
        C.read_manifest(spark, str(tmp_path / "bad.txt"))
    assert rows(C.rows(spark, [(1, "Hello"), (2, "World")], ["id", "message"])) == [(1, "Hello"), (2, "World")]


def test_sinks(spark, table, tmp_path):
    wide = table("mip_table string, prov string, row_index bigint, cmor_name string, description string", [("Amon", "p", 2, "tas", 'the "air"'), ("emDay", "p", 1, "pr", None)])
    K.write_wide_text(wide, str(tmp_path / "wide"))
    back = spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "wide"))
    assert rows(back, "table", "cmor_name", "description") == [("Amon", "tas", "the 'air'"), ("emDay", "pr", None)]
    by = table("mip string, experiment string, volume double", [("m1", "e1", 1.0), ("m1", "e2", 2.0)])
    K.write_by_request(by, str(tmp_path / "by"), "mip", "experiment")
    assert (tmp_path / "by" / "mip=m1" / "experiment=e2").exists() and rows(spark.read.parquet(str(tmp_path / "by")), "experiment", "volume") == [("e1", 1.0), ("e2", 2.0)]
    var = table("uid string, label string, sn string, title string, units string, description string", [("u1", "tas", "n", "T", "K", 'say "x"'), ("u2", "a-b", "n", "T", "K", "d")])
    used = K.used_variable_rows(var, table("vid string", [("u1",), ("u1",)]))
    K.write_rows(used, str(tmp_path / "js"))
    assert rows(spark.read.json(str(tmp_path / "js")), "var", "d") == [("tas u1", "say 'x'")]
    rules, rejected = K.rewrite_rules(var, "http://x.example/u")
    K.write_lines(rules, str(tmp_path / "rules"))
    assert rows(spark.read.text(str(tmp_path / "rules"))) == [("RewriteRule ^tas$ http://x.example/u/u1.html",)] and rows(rejected) == [("a-b",)]


def test_shared_folder_and_materialise(spark):
    folder = shared_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    df = materialise(spark.range(5).withColumn("x", F.col("id") * 2))
    assert df.count() == 5 and spark.sparkContext.getCheckpointDir() is not None


# --- large documents -----------------------------------------------------------------------------------

@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_one_large_section_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    item = """ <item uid="v{0}" label='say "{0}" > &#233;&amp;'\n  rank="{0}"/>\n"""
    with open(tmp_path / "big.xml", "w") as f:
        f.write('<?xml version="1.0"?>\n<main>\n<!-- <var> <item uid="comment"/> </var> -->\n<name label="name">\n <item uid="n1"/>\n</name>\n<item uid="outside"/>\n<var label="var" title="Quantity">\n')
        for i in range(20_000):
            f.write(item.format(i))
            if i == 7000:
                f.write("<!-- " + "<item uid='hidden'/>\n" * 3000 + "-->\n<![CDATA[ <item uid='data'/> </var> ]]>")
        f.write("</var>\n<name label=\"name\"><item uid=\"n2\"/></name><var/><empty/></main>")
    from gridledger.sources import ordered as O
    assert O.pieces(spark, str(tmp_path / "big.xml"), "<").rdd.getNumPartitions() > 20
    records, heads = C.read_records(spark, str(tmp_path / "big.xml"), {"var": ["uid", "label", "rank"], "name": ["uid"]})
    found = rows(records.groupBy("section").agg(F.count("*").alias("n"), F.sum(F.col("_rank").cast("long")).alias("s"), F.count_distinct("_uid").alias("u")))
    assert found == [("name", 2, None, 2), ("var", 20_000, sum(range(20_000)), 20_000)]
    assert rows(records.where("_uid = 'v77'"), "_label") == [('say "77" > é&',)]
    assert rows(heads, "label", "title", "records") == [(None, None, 0), ("name", None, 1), ("name", None, 1), ("var", "Quantity", 20_000)]


def test_lines_are_numbered_over_blocks_and_files(spark, tmp_path, small_blocks):
    from gridledger.sources import ordered as O
    (tmp_path / "doc").mkdir()
    for part, lines in enumerate([9000, 0, 1, 5000]):
        (tmp_path / "doc" / f"part-{part:05}").write_text("".join(f"{part} {i} {'x' * (i % 50)}\n" for i in range(lines)))
    found = O.numbered(O.pieces(spark, str(tmp_path / "doc")))
    assert found.rdd.getNumPartitions() > 1 or found.count() > 0
    got = [r["value"].split()[:2] for r in found.orderBy("line").select("value", "line").collect()]
    assert got == [["0", str(i)] for i in range(9000)] + [["2", "0"]] + [["3", str(i)] for i in range(5000)]
    assert [r["line"] for r in found.select("line").orderBy("line").collect()] == list(range(14_001))


def test_sections_of_a_document_come_from_one_scan(spark, docs):
    got = C.load(spark, C.read_manifest(spark, str(docs / "manifest.txt")))
    for section in got.sections.values():
        assert not [f for f in section.inputFiles() if f.endswith(".xml")]
