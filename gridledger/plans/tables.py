"""Queries on the wide variable table, priorities, revisions, updates and issues."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridledger.functions.coerce import coerce, coercion_problem, is_non_decreasing, is_strictly_increasing, to_text
from gridledger.functions.text import table_class
from gridledger.operators import expand as X
from gridledger.operators import links as L
from gridledger.operators import revise as E
from gridledger.operators import wide as T
from gridledger.plans.links import EDGES, INDEX, edges, index, sections
from gridledger.plans.paths import MEMBERS
from gridledger.plans.registry import query

STAR = """q AS (SELECT vid, concat(valid_min, ' ', substr(valid_min_status, 1, 1)) AS valid_min,
 CASE WHEN valid_max IS NULL THEN '' ELSE concat(valid_max, ' ', substr(valid_max_status, 1, 1)) END AS valid_max
 FROM (SELECT vid, CAST(valid_min AS BIGINT) AS valid_min, CAST(valid_max AS BIGINT) AS valid_max, valid_min_status, valid_max_status FROM x_qcrange)),
w AS (SELECT v.mip_table, v.default_priority AS priority, x.title AS long_name, x.units, x.description,
 CASE WHEN v.description <> x.description THEN v.description ELSE '' END AS comment, x.label AS variable_name, x.sn AS standard_name, s.cell_methods, v.positive, v.type,
 replace(concat(sp.dimensions, ' ', s.odims, ' ', tm.dimensions, ' ', s.coords), '|', ' ') AS dimensions, v.label AS cmor_name, v.modeling_realm,
 v.frequency, s.cell_measures, v.prov, v.prov_note, v.row_index, v.uid, v.vid, v.stid, s.title AS structure_title, q.valid_min, q.valid_max,
 '' AS ok_min_mean_abs, '' AS ok_max_mean_abs
 FROM x_cmorvar v JOIN x_var x ON v.vid = x.uid JOIN x_structure s ON s.uid = v.stid JOIN x_spatial_shape sp ON sp.uid = s.spid
 JOIN x_temporal_shape tm ON tm.uid = s.tmid LEFT JOIN q ON q.vid = v.uid)"""


def wide(cat, priorities=None):
    return T.wide_table(cat["x_cmorvar"], cat["x_var"], cat["x_structure"], cat["x_spatial_shape"], cat["x_temporal_shape"], cat["x_qcrange"], priorities)


@query("wide_table", f"WITH {STAR} SELECT * FROM w")
def wide_table(cat):
    return wide(cat)


@query("quantity_records", "SELECT title, units, description, label, sn FROM x_var WHERE uid IN (SELECT vid FROM x_cmorvar)")
def quantity_records(cat):
    return T.quantity_records(cat["x_cmorvar"], cat["x_var"])


@query("wide_table_mips", f"""
WITH {STAR}, rv AS (SELECT vgid, vid, max(priority) AS priority FROM x_request_var GROUP BY vgid, vid),
vm AS (SELECT DISTINCT rv.vid, l.mip FROM x_request_link l JOIN rv ON rv.vgid = l.refid WHERE l.opt <> 'priority' OR rv.priority <= l.opar),
low AS (SELECT rv.vid, min(rv.priority) AS p FROM x_request_var rv WHERE rv.vgid IN (SELECT refid FROM x_request_link WHERE mip = 'm1') GROUP BY rv.vid),
a AS (SELECT vid, string_agg(mip, ',' ORDER BY mip) AS mips FROM vm GROUP BY vid)
SELECT w.mip_table, w.cmor_name, w.uid, coalesce(low.p, w.priority) AS priority, coalesce(a.mips, '') AS mips
 FROM w LEFT JOIN a ON a.vid = w.uid LEFT JOIN low ON low.vid = w.uid""")
def wide_table_mips(cat):
    link = cat["x_request_link"]
    mine = X.select_links(link, "m1")
    low = mine.select("refid").distinct().join(cat["x_request_var"].withColumnRenamed("vgid", "refid"), "refid").groupBy("vid").agg(F.min("priority").alias("priority"))
    rows = T.with_mips(wide(cat, low), X.variable_mips_by_priority(link, cat["x_request_var"]))
    return T.in_table_order(rows).select("mip_table", "cmor_name", "uid", "priority", "mips")


@query("wide_table_broken", f"""
SELECT uid, CASE WHEN vid = 'Brand#3' THEN 'var' END AS broken FROM x_cmorvar""")
def wide_table_broken(cat):
    # one quantity is taken out of the catalogue, so its variables cannot be resolved
    var = cat["x_var"].where(F.col("uid") != "Brand#3")
    return T.star(cat["x_cmorvar"], var, cat["x_structure"], cat["x_spatial_shape"], cat["x_temporal_shape"]).select("uid", "broken")


@query("lines_star", """
SELECT p_name, s_name, n_name, r_name, count(*) AS lines, round(sum(l_quantity), 2) AS quantity FROM lineitem JOIN part ON p_partkey = l_partkey
 JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""")
def lines_star(cat):
    # lines are counted per (part, supplier) before the dimensions are looked up
    per = cat["lineitem"].groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))
    place = cat["supplier"].join(cat["nation"], F.col("n_nationkey") == F.col("s_nationkey")).join(cat["region"], F.col("r_regionkey") == F.col("n_regionkey"))
    rows = per.join(cat["part"], F.col("p_partkey") == F.col("l_partkey")).join(place, F.col("s_suppkey") == F.col("l_suppkey"))
    return rows.groupBy("p_name", "s_name", "n_name", "r_name").agg(F.sum("lines").alias("lines"), F.round(F.sum("quantity"), 2).alias("quantity"))


@query("priority_min", f"""
WITH {MEMBERS}, g AS (SELECT DISTINCT l.mip, m.expt, l.refid FROM x_request_item i JOIN x_request_link l ON i.rlid = l.uid JOIN members m ON i.esid = m.esid)
SELECT g.mip, g.expt, rv.vid, min(rv.priority) AS priority FROM g JOIN x_request_var rv ON rv.vgid = g.refid GROUP BY g.mip, g.expt, rv.vid""")
def priority_min(cat):
    return T.lowest_priorities(cat["x_request_link"], cat["x_request_item"], cat["x_experiment"], cat["x_request_var"])


@query("priority_rank", """
WITH p AS (SELECT v.vid, min(rv.priority) AS p FROM x_cmorvar v JOIN x_request_var rv ON rv.vid = v.uid GROUP BY v.vid),
w AS (SELECT DISTINCT vid, unnest(string_split(modeling_realm, ' ')) AS realm FROM x_cmorvar),
r AS (SELECT vid, string_agg(realm, ' ' ORDER BY realm) AS realms FROM w WHERE realm <> '' GROUP BY vid)
SELECT x.label, concat(p.p, CASE WHEN x.sn LIKE 'r%' THEN 'x' ELSE '' END) AS key, coalesce(r.realms, '') AS realms
 FROM x_var x JOIN p ON p.vid = x.uid LEFT JOIN r ON r.vid = x.uid""")
def priority_rank(cat):
    return T.rank_variables(cat["x_cmorvar"], cat["x_var"], cat["x_request_var"], F.col("sn").startswith("r"))


@query("priority_top2", """
SELECT vid, list_sort(list(priority))[1] AS p1, list_sort(list(priority))[2] AS p2 FROM x_request_var GROUP BY vid HAVING count(*) > 1""")
def priority_top2(cat):
    return T.two_lowest(cat["x_request_var"])


@query("priority_pairs", """
WITH p AS (SELECT vid, list_sort(list(priority))[1] AS p1, list_sort(list(priority))[2] AS p2 FROM x_request_var GROUP BY vid HAVING count(*) > 1)
SELECT v.uid, concat(v.mip_table, '.', v.label) AS variable, x.label AS var_label, concat(p1, '-', p2, CASE WHEN x.sn LIKE 'r%' THEN 'x' ELSE '' END) AS key
 FROM x_cmorvar v JOIN p ON p.vid = v.uid JOIN x_var x ON x.uid = v.vid""")
def priority_pairs(cat):
    return T.rank_table_variables(cat["x_cmorvar"], cat["x_var"], cat["x_request_var"], F.col("sn").startswith("r"))


@query("title_mismatch", """
SELECT v.uid, concat(v.mip_table, '.', v.label) AS variable, v.title, x.title AS var_title FROM x_cmorvar v JOIN x_var x ON v.vid = x.uid WHERE v.title <> x.title""")
def title_mismatch(cat):
    return T.title_mismatch(cat["x_cmorvar"], cat["x_var"])


@query("realm_counts", """
WITH w AS (SELECT uid, vid, unnest(string_split(modeling_realm, ' ')) AS realm FROM x_cmorvar)
SELECT realm, count(DISTINCT w.uid) AS variables, count(DISTINCT w.vid) AS quantities, count(DISTINCT x.sn) AS standard_names
 FROM w LEFT JOIN x_var x ON x.uid = w.vid GROUP BY realm""")
def realm_counts(cat):
    return T.realm_counts(cat["x_cmorvar"], cat["x_var"])


@query("sorted_tables", """
WITH t AS (SELECT mip_table AS name FROM x_cmorvar UNION SELECT concat('em', mip_table) FROM x_cmorvar UNION SELECT concat('CMIP5_', mip_table) FROM x_cmorvar
 UNION SELECT concat('SPECS', frequency) FROM x_cmorvar)
SELECT name, CAST(CASE WHEN substr(name, 1, 5) IN ('CMIP5', 'CORDE', 'SPECS') AND length(name) > 5 THEN 2 WHEN substr(name, 1, 2) = 'em' THEN 1 ELSE 0 END AS BIGINT) AS class FROM t""")
def sorted_tables(cat):
    v = cat["x_cmorvar"]
    names = v.select(F.explode(F.array("mip_table", F.concat(F.lit("em"), "mip_table"), F.concat(F.lit("CMIP5_"), "mip_table"),
                                       F.concat(F.lit("SPECS"), "frequency"))).alias("name")).distinct()
    return names.select("name", table_class(F.col("name")).alias("class")).orderBy("class", "name")


# --- revisions -----------------------------------------------------------------------------------------

REVISED = """rev AS (SELECT c_custkey + CASE WHEN c_custkey % 41 = 0 THEN 100000000 ELSE 0 END AS uid, c_name AS label, CAST(c_nationkey AS BIGINT) AS nation,
 CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN concat(c_mktsegment, '+') ELSE c_mktsegment END AS segment,
 c_acctbal + CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END AS balance FROM customer),
old AS (SELECT c_custkey AS uid, c_name AS label, CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment, c_acctbal AS balance FROM customer),
d AS (SELECT coalesce(o.uid, n.uid) AS uid, CASE WHEN n.uid IS NULL THEN 'only_left' WHEN o.uid IS NULL THEN 'only_right'
 WHEN o.segment IS DISTINCT FROM n.segment OR o.balance IS DISTINCT FROM n.balance THEN 'changed' END AS status,
 o.segment IS DISTINCT FROM n.segment AS cs, o.balance IS DISTINCT FROM n.balance AS cb, coalesce(o.label, n.label) AS label
 FROM old o FULL JOIN rev n ON o.uid = n.uid)"""
ATTRS = ["label", "nation", "segment", "balance"]


def revisions(cat):
    c = cat["customer"]
    key = F.col("c_custkey")
    old = c.select(key.alias("uid"), F.col("c_name").alias("label"), F.col("c_nationkey").cast("bigint").alias("nation"),
                   F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    new = c.select((key + F.when(key % 41 == 0, 100000000).otherwise(0)).alias("uid"), F.col("c_name").alias("label"),
                   F.col("c_nationkey").cast("bigint").alias("nation"),
                   F.when(key % 7 == 0, None).when(key % 5 == 0, F.concat("c_mktsegment", F.lit("+"))).otherwise(F.col("c_mktsegment")).alias("segment"),
                   (F.col("c_acctbal") + F.when(key % 11 == 0, 1).otherwise(0)).alias("balance"))
    return old, new


@query("revision_diff", f"""
WITH {REVISED} SELECT uid, status, CASE WHEN status = 'changed' THEN concat_ws(',', CASE WHEN cs THEN 'segment' END, CASE WHEN cb THEN 'balance' END) END AS changed
 FROM d WHERE status IS NOT NULL""")
def revision_diff(cat):
    return E.revision_diff(*revisions(cat), ATTRS).withColumn("changed", F.array_join("changed", ","))


@query("revision_listing", f"""
WITH {REVISED} SELECT uid, status, CASE status WHEN 'changed' THEN concat('Changed: ', uid, ' [', label, '], ',
  concat_ws(',', CASE WHEN cs THEN 'segment' END, CASE WHEN cb THEN 'balance' END))
 WHEN 'only_left' THEN concat('Only in left: ', uid, ' [', label, ']') ELSE concat('Only in right: ', uid, ' [', label, ']') END AS line FROM d WHERE status IS NOT NULL""")
def revision_listing(cat):
    old, new = revisions(cat)
    return E.diff_listing(E.revision_diff(old, new, ATTRS), old, new, "long")


@query("attribute_changes", f"""
WITH {REVISED} SELECT 'attribute' AS kind, 'segment' AS name, count(*) AS records FROM d WHERE status = 'changed' AND cs
UNION ALL SELECT 'attribute', 'balance', count(*) FROM d WHERE status = 'changed' AND cb
UNION ALL SELECT 'status', status, count(*) FROM d WHERE status IS NOT NULL GROUP BY status""")
def attribute_changes(cat):
    diff = E.revision_diff(*revisions(cat), ATTRS)
    return E.attribute_changes(diff).select(F.lit("attribute").alias("kind"), F.col("attr").alias("name"), "records").unionByName(
        E.diff_summary(diff).select(F.lit("status").alias("kind"), F.col("status").alias("name"), "records"))


UPDATES = """upd AS (SELECT concat('v', l_partkey + CASE WHEN l_linenumber = 7 THEN 100000000 ELSE 0 END) AS uid, l_orderkey, l_linenumber,
 CASE l_linenumber WHEN 1 THEN 'title' WHEN 2 THEN 'row_index' WHEN 3 THEN 'colour' WHEN 4 THEN 'label' WHEN 5 THEN 'levels' ELSE 'row_index' END AS attr,
 CASE WHEN l_linenumber = 4 OR (l_linenumber = 3 AND l_quantity < 10) THEN 'delete' ELSE 'set' END AS op,
 CASE l_linenumber WHEN 1 THEN 'text' WHEN 5 THEN CASE WHEN l_returnflag = 'A' THEN 'text' ELSE 'integer list' END ELSE CASE WHEN l_quantity < 25 THEN 'integer' ELSE 'float' END END AS given,
 CASE l_linenumber WHEN 5 THEN concat(l_linenumber, ' ', CAST(l_quantity AS BIGINT)) ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS value FROM lineitem)"""

VIOLATIONS = f"""{UPDATES}, vio AS (SELECT uid, attr, CASE WHEN NOT EXISTS (SELECT 1 FROM part WHERE concat('v', p_partkey) = upd.uid) THEN 'uid'
 WHEN op = 'delete' AND attr = 'colour' THEN 'delete unknown' WHEN op = 'delete' AND attr = 'label' THEN 'delete required' WHEN op = 'delete' THEN NULL WHEN attr = 'colour' THEN 'unknown'
 WHEN attr = 'levels' AND given <> 'integer list' THEN 'list type' WHEN attr = 'row_index' AND given <> 'integer' THEN 'type'
 WHEN attr = 'levels' AND CAST(string_split(value, ' ')[2] AS BIGINT) <= 5 THEN 'not increasing' END AS code FROM upd)"""

ATTRIBUTE_TYPES = {"label": ("xs:string", True), "title": ("xs:string", True), "row_index": ("xs:integer", False), "levels": ("aa:st__integerListMonInc", False)}


def updates(cat):
    line, qty = F.col("l_linenumber"), F.col("l_quantity")
    whole = qty.cast("bigint").cast("string")
    return cat["lineitem"].select(
        F.concat(F.lit("v"), (F.col("l_partkey") + F.when(line == 7, 100000000).otherwise(0)).cast("string")).alias("uid"),
        F.when(line == 1, "title").when(line == 3, "colour").when(line == 4, "label").when(line == 5, "levels").otherwise("row_index").alias("attr"),
        F.when((line == 4) | ((line == 3) & (qty < 10)), "delete").otherwise("set").alias("op"),
        F.when(line == 1, "text").when(line == 5, F.when(F.col("l_returnflag") == "A", "text").otherwise("integer list"))
        .when(qty < 25, "integer").otherwise("float").alias("given"),
        F.when(line == 5, F.concat(line.cast("string"), F.lit(" "), whole)).otherwise(whole).alias("value"))


def attribute_table(cat):
    return cat.spark.createDataFrame([("CMORvar", a, t, r) for a, (t, r) in ATTRIBUTE_TYPES.items()], "section string, label string, type string, required boolean")


def update_violations_of(cat):
    v = cat["x_cmorvar"].select(F.concat(F.lit("v"), F.col("uid").cast("string")).alias("uid"), F.lit("CMORvar").alias("section"))
    return E.update_violations(updates(cat), v, attribute_table(cat))


@query("update_violations", f"WITH {VIOLATIONS} SELECT uid, attr, code FROM vio WHERE code IS NOT NULL")
def update_violations(cat):
    return update_violations_of(cat)


@query("updates_applied", f"""
WITH {VIOLATIONS}, ok AS (SELECT uid, max(CASE WHEN attr = 'title' THEN value END) AS t, max(CASE WHEN attr = 'row_index' THEN value END) AS r FROM upd
 WHERE op = 'set' AND uid NOT IN (SELECT uid FROM vio WHERE code IS NOT NULL) GROUP BY uid)
SELECT concat('v', v.uid) AS uid, coalesce(ok.t, v.title) AS title, coalesce(CAST(ok.r AS BIGINT), v.row_index) AS row_index FROM x_cmorvar v LEFT JOIN ok ON ok.uid = concat('v', v.uid)""")
def updates_applied(cat):
    section = cat["x_cmorvar"].select(F.concat(F.lit("v"), F.col("uid").cast("string")).alias("uid"), "title", "row_index")
    good = E.valid_updates(updates(cat), update_violations_of(cat))
    return E.apply_updates(section, good, {a: t for a, (t, _) in ATTRIBUTE_TYPES.items()})


@query("issue_log", f"""
WITH {EDGES}, {INDEX}, {VIOLATIONS},
m AS (SELECT 'dangling link' AS code, concat(src_section, '.', attr) AS message FROM edge WHERE dst_uid NOT IN (SELECT uid FROM idx)
 UNION SELECT concat('update: ', code), attr FROM vio WHERE code IS NOT NULL
 UNION SELECT 'duplicate label', label FROM x_cmorvar GROUP BY label HAVING count(*) > 1)
SELECT code, message FROM m""")
def issue_log(cat):
    bad = L.bad_link_counts(edges(cat), index(cat)).where(F.col("bad") > 0)
    issues = L.union_all([
        bad.select(F.lit("dangling link").alias("code"), F.concat_ws(".", "src_section", "attr").alias("message")),
        update_violations_of(cat).select(F.concat(F.lit("update: "), "code").alias("code"), F.col("attr").alias("message")),
        L.duplicates(sections(cat)["CMORvar"], "label").select(F.lit("duplicate label").alias("code"), F.col("label").alias("message")),
    ])
    return E.issue_log(issues)


@query("issue_counts", f"""
WITH {VIOLATIONS} SELECT code, count(DISTINCT uid) AS messages FROM vio WHERE code IS NOT NULL GROUP BY code""")
def issue_counts(cat):
    return E.issue_counts(update_violations_of(cat).select("code", F.col("uid").alias("message")))


@query("append_except", """
SELECT 'appended' AS kind, label, uid FROM x_mip
UNION ALL SELECT 'appended', n_name, concat('n', n_nationkey) FROM nation
UNION ALL SELECT 'current', label, uid FROM x_mip WHERE label NOT IN ('PDRMIP', 'DECK', 'VIACSAB', 'SolarMIP', 'CMIP6')
UNION ALL SELECT 'nation name without nation 3', n_name, NULL FROM (SELECT n_name FROM nation EXCEPT SELECT 'NATION_3')""")
def append_except(cat):
    mips = cat["x_mip"].select("label", "uid")
    more = cat["nation"].select(F.col("n_name").alias("label"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("uid"))
    nation = cat["nation"].select(F.col("n_name").alias("label"))
    rest = nation.subtract(nation.where(F.col("label") == "NATION_3"))
    kind = lambda df, k: df.select(F.lit(k).alias("kind"), "label", "uid")
    return L.union_all([
        kind(E.append_records(mips, more), "appended"), kind(E.current_mips(mips), "current"),
        kind(rest.withColumn("uid", F.lit(None).cast("string")), "nation name without nation 3")]).orderBy("kind", "label")


@query("coercion", """
WITH t AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
 CASE WHEN l_linenumber = 1 THEN '' WHEN l_linenumber = 2 THEN ' ' WHEN l_linenumber = 3 THEN CAST(l_quantity + 0.5 AS VARCHAR) WHEN l_linenumber = 4 THEN l_returnflag
  WHEN l_linenumber = 5 THEN concat('-', l_partkey) ELSE CAST(l_partkey AS VARCHAR) END AS v,
 concat(l_linenumber, ' ', l_suppkey % 5) AS lst FROM lineitem)
SELECT v, lst, CAST(CASE WHEN trim(v) = '' THEN 0 WHEN l_linenumber = 3 THEN trunc(CAST(v AS DOUBLE)) WHEN l_linenumber = 4 THEN NULL ELSE CAST(v AS BIGINT) END AS BIGINT) AS as_integer,
 CASE WHEN v IN ('', ' ') THEN 'blank integer set to 0' WHEN l_linenumber = 3 THEN 'integer cut from number' WHEN l_linenumber = 4 THEN 'integer unreadable' END AS problem,
 CASE WHEN v NOT IN ('', ' ') AND l_linenumber <> 4 THEN CAST(v AS DOUBLE) END AS as_float,
 v IN ('1', 'true') AS as_boolean, lst AS as_list_text, l_linenumber <= l_suppkey % 5 AS not_decreasing, l_linenumber < l_suppkey % 5 AS increasing FROM t""")
def coercion(cat):
    line = F.col("l_linenumber")
    v = (F.when(line == 1, "").when(line == 2, " ").when(line == 3, (F.col("l_quantity") + 0.5).cast("string")).when(line == 4, F.col("l_returnflag"))
         .when(line == 5, F.concat(F.lit("-"), F.col("l_partkey").cast("string"))).otherwise(F.col("l_partkey").cast("string")))
    t = cat["lineitem"].select(v.alias("v"), F.concat_ws(" ", line.cast("string"), (F.col("l_suppkey") % 5).cast("string")).alias("lst"))
    xs = coerce(F.col("lst"), "aa:st__integerListMonInc")
    return t.select("v", "lst", coerce(F.col("v"), "xs:integer").alias("as_integer"), coercion_problem(F.col("v"), "xs:integer").alias("problem"),
                    coerce(F.col("v"), "xs:float").alias("as_float"), coerce(F.col("v"), "xs:boolean").alias("as_boolean"),
                    to_text(xs, "aa:st__integerList").alias("as_list_text"), is_non_decreasing(xs).alias("not_decreasing"),
                    is_strictly_increasing(xs).alias("increasing"))
