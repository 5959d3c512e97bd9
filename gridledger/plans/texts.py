"""Queries on text columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridledger.functions import text as C
from gridledger.plans.registry import query
from gridledger.plans.volumes import per_variable
from gridledger.plans import sqltext as Q
from gridledger.sources.sinks import rewrite_rules, used_variable_rows


@query("clean_text", """
SELECT doc_id, md5(replace(translate(text, '–—“”‘’◦²³', '--""''''o23'), '…', '...')) AS plain,
 md5(replace(replace(replace(translate(text, '–—“”‘’◦²³', '--""''''o23'), '…', '...'), '"', ''''), chr(10), ';;')) AS script FROM documents""")
def clean_text(cat):
    t = F.col("text")
    return cat["documents"].select("doc_id", F.md5(C.plain_text(t)).alias("plain"), F.md5(C.plain_text(t, for_script=True)).alias("script"))


@query("markup", """
SELECT l_orderkey, l_linenumber, l_partkey, concat('see <a href=u/part.html>part</a> at <a href=http://x.example/', l_partkey, '>line ', l_linenumber, '</a> {', l_suppkey, '}') AS html FROM lineitem""")
def markup(cat):
    raw = F.format_string("see {part} at [http://x.example/%d line %d] {%d}", "l_partkey", "l_linenumber", "l_suppkey")
    return cat["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", C.markup_links(raw, "u/").alias("html"))


def label_sql(v: str, largest: str = "") -> str:
    """The label of a double, by the formats of the other engine."""
    return f"""CASE WHEN {v} < 1e9 THEN concat(CAST(trunc({v} * 1e-6) AS BIGINT), 'M') WHEN {v} < 1e12 THEN concat(CAST(trunc({v} * 1e-9) AS BIGINT), 'G')
 WHEN {v} < 1e13 THEN format('{{:3.1f}}T', {v} * 1e-12) WHEN {v} < 1e15 THEN format('{{:3d}}T', CAST(trunc({v} * 1e-12) AS BIGINT))
 WHEN {v} < 1e18 THEN format('{{:3d}}P', CAST(trunc({v} * 1e-15) AS BIGINT)) ELSE format('{{:,.2f}}{largest}', {v} * 1e-9) END"""


# every size of label, and halves of a tenth, where the binary value decides
@query("volume_label", f"""
WITH x AS (SELECT l_orderkey, l_partkey, l_extendedprice * CASE l_linenumber WHEN 1 THEN 1e2 WHEN 2 THEN 1e5 WHEN 3 THEN 1e7 WHEN 4 THEN 1e8 WHEN 5 THEN 1e10 WHEN 6 THEN 1e12 ELSE 1e15 END AS v,
 CAST(10 + l_partkey % 90 AS DOUBLE) * 1e11 + 5e10 AS half FROM lineitem)
SELECT l_orderkey, l_partkey, {label_sql('v')} AS label, {label_sql('v', 'B')} AS label_b, {label_sql('half')} AS label_half FROM x""")
def volume_label(cat):
    scale = F.array(*[F.lit(float(s)) for s in ("1e2", "1e5", "1e7", "1e8", "1e10", "1e12", "1e15")])
    v = F.col("l_extendedprice") * F.element_at(scale, F.col("l_linenumber"))
    half = (F.lit(10) + F.col("l_partkey") % 90).cast("double") * F.lit(1e11) + F.lit(5e10)
    return cat["lineitem"].select("l_orderkey", "l_partkey", C.volume_label(v).alias("label"), C.volume_label(v, "B").alias("label_b"), C.volume_label(half).alias("label_half"))


@query("volume_by_table_label", f"""
WITH {Q.FULL}, t AS (SELECT mip_table, 2 * CAST(sum(hundredths) AS DOUBLE) / 100 AS v FROM fact GROUP BY mip_table)
SELECT mip_table, {label_sql('v')} AS label FROM t""")
def volume_by_table_label(cat):
    t = per_variable(cat).groupBy("mip_table").agg((2 * F.sum("hundredths").cast("double") / 100.0).alias("v"))
    return t.select("mip_table", C.volume_label(F.col("v")).alias("label"))


@query("selection_label", """
WITH m AS (SELECT DISTINCT l.refid, x.label FROM x_request_link l JOIN x_mip x ON l.mip = x.uid)
SELECT refid, CASE WHEN count(*) = 1 THEN min(label) ELSE string_agg(lower(substr(label, 1, 2)), '.' ORDER BY lower(label)) END AS label FROM m GROUP BY refid""")
def selection_label(cat):
    names = cat["x_mip"].select(F.col("uid").alias("mip"), "label")
    per = cat["x_request_link"].select("refid", "mip").distinct().join(names, "mip").groupBy("refid").agg(F.collect_set("label").alias("names"))
    return per.select("refid", C.selection_label(F.col("names")).alias("label"))


@query("text_columns", """
SELECT uid, string_split(modeling_realm, ' ')[1] AS realm, concat(frequency, '.', string_split(modeling_realm, ' ')[1]) AS table_key,
 concat('<span title="', replace(replace(replace(CASE WHEN trim(description) <> '' THEN description ELSE title END, '"', '&quot;'), '<', '&lt;'), '>', '&gt;'),
 '"><a href="../u/', uid, '.html">', label, '</a></span>') AS link FROM x_cmorvar""")
def text_columns(cat):
    v = cat["x_cmorvar"]
    hover = C.hover_title(F.col("description"), F.col("title"), F.col("label"))
    return v.select("uid", C.first_word(F.col("modeling_realm")).alias("realm"), C.frequency_realm(F.col("frequency"), F.col("modeling_realm")).alias("table_key"),
                    C.reference_link(F.col("uid"), F.col("label"), hover, "../u/").alias("link"))


@query("record_lines", """
WITH n AS (SELECT vid AS uid, count(*) AS n FROM x_request_var GROUP BY vid), g AS (SELECT vgid AS uid, count(*) AS v FROM x_request_var GROUP BY vgid),
k AS (SELECT refid AS uid, count(*) AS l FROM x_request_link GROUP BY refid)
SELECT 'variable' AS kind, uid, concat('<li>', label, ' {', mip_table, '}: ', title, ' [', frequency, ': ', s.title2, '] (', coalesce(CAST(n.n AS VARCHAR), 'unused'), ')</li>') AS line
 FROM x_cmorvar JOIN (SELECT uid AS stid, title AS title2 FROM x_structure) s USING (stid) LEFT JOIN n USING (uid)
UNION ALL SELECT 'group', uid, concat('<li>', label, ': ', coalesce(v, 0), ' variables, ', coalesce(l, 0), ' request links</li>') FROM x_var_group LEFT JOIN g USING (uid) LEFT JOIN k USING (uid)""")
def record_lines(cat):
    count = lambda df, key, name: df.groupBy(F.col(key).alias("uid")).agg(F.count(F.lit(1)).alias(name))
    s = cat["x_structure"].select(F.col("uid").alias("stid"), F.col("title").alias("title2"))
    v = cat["x_cmorvar"].join(s, "stid").join(count(cat["x_request_var"], "vid", "n"), "uid", "left")
    line = F.format_string("<li>%s {%s}: %s [%s: %s] (%s)</li>", "label", "mip_table", "title", "frequency", "title2", F.coalesce(F.col("n").cast("string"), F.lit("unused")))
    g = cat["x_var_group"].join(count(cat["x_request_var"], "vgid", "v"), "uid", "left").join(count(cat["x_request_link"], "refid", "l"), "uid", "left")
    group = F.format_string("<li>%s: %d variables, %d request links</li>", "label", F.coalesce("v", F.lit(0)), F.coalesce("l", F.lit(0)))
    return v.select(F.lit("variable").alias("kind"), "uid", line.alias("line")).unionByName(g.select(F.lit("group").alias("kind"), "uid", group.alias("line")))


@query("section_titles", """
WITH t AS (SELECT concat(c_nationkey, '.', c_custkey % 12, ' ', c_mktsegment) AS title FROM customer UNION SELECT concat(c_nationkey, ' ', c_mktsegment) FROM customer)
SELECT title, CASE WHEN contains(string_split(title, ' ')[1], '.') THEN concat(lpad(string_split(string_split(title, ' ')[1], '.')[1], 3, '0'), '.', lpad(string_split(string_split(title, ' ')[1], '.')[2], 3, '0'))
 ELSE concat(string_split(title, ' ')[1], '.0') END AS key FROM t""")
def section_titles(cat):
    c = cat["customer"]
    two = F.concat(F.col("c_nationkey").cast("string"), F.lit("."), (F.col("c_custkey") % 12).cast("string"), F.lit(" "), "c_mktsegment")
    one = F.concat_ws(" ", F.col("c_nationkey").cast("string"), "c_mktsegment")
    titles = c.select(F.explode(F.array(two, one)).alias("title")).distinct()
    return titles.select("title", F.array_join(C.section_sort_key(F.col("title")), ".").alias("key")).orderBy("key")


@query("used_variable_rows", """
SELECT concat(label, ' ', uid) AS var, sn, title AS ln, units AS u, description AS d, uid FROM x_var WHERE uid IN (SELECT vid FROM x_cmorvar)""")
def used_variable_rows_(cat):
    return used_variable_rows(cat["x_var"], cat["x_cmorvar"])


@query("rewrite_rules", """
SELECT 'rule' AS kind, concat('RewriteRule ^', replace(c_name, '#', ''), '$ http://catalogue.example/u/', c_custkey, '.html') AS value FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT 'rejected', c_name FROM customer WHERE c_custkey % 2 <> 0""")
def rewrite_rules_(cat):
    # every second name loses the sign that makes it a complex label
    even = F.col("c_custkey") % 2 == 0
    names = cat["customer"].select(F.when(even, F.replace("c_name", F.lit("#"), F.lit(""))).otherwise(F.col("c_name")).alias("label"), F.col("c_custkey").alias("uid"))
    rules, rejected = rewrite_rules(names, "http://catalogue.example/u")
    return rules.select(F.lit("rule").alias("kind"), "value").unionByName(rejected.select(F.lit("rejected").alias("kind"), F.col("label").alias("value")))
