"""Queries on the link graph: edges, integrity, usage, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.functions.caps import category_passes, not_esm, preset_passes
from gridledger.lookup import PLACEHOLDER
from gridledger.operators import links as L
from gridledger.operators import search as S
from gridledger.operators.expand import allow_deny, experiment_filter
from gridledger.operators.request import requested_pairs
from gridledger.plans.registry import query
from gridledger.plans.roles import Catalogue

# uids of different sections overlap as numbers, so each section gets a letter; the same in both forms below
LETTER = {"requestLink": "l", "requestItem": "i", "requestVarGroup": "vg", "CMORvar": "v"}
LINK_ATTRS = {
    "exptgroup": {}, "mip": {}, "remarks": {}, "var": {"sn": "scalar", "related": "list"}, "spatialShape": {}, "temporalShape": {}, "requestVarGroup": {},
    "experiment": {"egid": "scalar", "mip": "scalar"},
    "requestLink": {"mip": "scalar", "refid": "scalar"},
    "requestItem": {"rlid": "scalar", "esid": "scalar"},
    "CMORvar": {"vid": "scalar", "stid": "scalar"},
    "structure": {"spid": "scalar", "tmid": "scalar"},
}

EDGES = """edge AS (
SELECT 'experiment' AS src_section, uid AS src_uid, 'egid' AS attr, egid AS dst_uid FROM x_experiment
UNION ALL SELECT 'experiment', uid, 'mip', mip FROM x_experiment
UNION ALL SELECT 'requestLink', concat('l', uid), 'mip', mip FROM x_request_link
UNION ALL SELECT 'requestLink', concat('l', uid), 'refid', concat('vg', refid) FROM x_request_link
UNION ALL SELECT 'requestItem', concat('i', uid), 'rlid', concat('l', rlid) FROM x_request_item
UNION ALL SELECT 'requestItem', concat('i', uid), 'esid', esid FROM x_request_item
UNION ALL SELECT 'CMORvar', concat('v', uid), 'vid', vid FROM x_cmorvar
UNION ALL SELECT 'CMORvar', concat('v', uid), 'stid', stid FROM x_cmorvar
UNION ALL SELECT 'structure', uid, 'spid', spid FROM x_structure
UNION ALL SELECT 'structure', uid, 'tmid', tmid FROM x_structure
UNION ALL SELECT 'var', uid, 'sn', sn FROM x_var WHERE sn <> '__unset__'
UNION ALL SELECT 'var', uid, 'related', rel1 FROM x_var
UNION ALL SELECT 'var', uid, 'related', rel2 FROM x_var WHERE rel2 <> '__unset__')"""

INDEX = """idx AS (
SELECT uid, 'mip' AS section, label FROM x_mip
UNION ALL SELECT uid, 'remarks', label FROM x_remarks
UNION ALL SELECT uid, 'exptgroup', label FROM x_exptgroup
UNION ALL SELECT uid, 'experiment', label FROM x_experiment
UNION ALL SELECT concat('l', uid), 'requestLink', CAST(NULL AS VARCHAR) FROM x_request_link
UNION ALL SELECT concat('i', uid), 'requestItem', CAST(NULL AS VARCHAR) FROM x_request_item
UNION ALL SELECT concat('vg', uid), 'requestVarGroup', label FROM x_var_group
UNION ALL SELECT concat('v', uid), 'CMORvar', label FROM x_cmorvar
UNION ALL SELECT uid, 'var', label FROM x_var
UNION ALL SELECT uid, 'structure', CAST(NULL AS VARCHAR) FROM x_structure
UNION ALL SELECT uid, 'spatialShape', label FROM x_spatial_shape
UNION ALL SELECT uid, 'temporalShape', CAST(NULL AS VARCHAR) FROM x_temporal_shape)"""


def sections(cat: Catalogue) -> dict[str, DataFrame]:
    named = lambda df, **cols: df.withColumns({c: F.concat(F.lit(LETTER[s]), F.col(c).cast("string")) for c, s in cols.items()})
    return {
        "mip": cat["x_mip"], "remarks": cat["x_remarks"], "exptgroup": cat["x_exptgroup"], "experiment": cat["x_experiment"],
        "requestLink": named(cat["x_request_link"], uid="requestLink", refid="requestVarGroup"),
        "requestItem": named(cat["x_request_item"], uid="requestItem", rlid="requestLink"),
        "requestVarGroup": named(cat["x_var_group"], uid="requestVarGroup"),
        "CMORvar": named(cat["x_cmorvar"], uid="CMORvar"),
        "var": cat["x_var"], "structure": cat["x_structure"], "spatialShape": cat["x_spatial_shape"],
        "temporalShape": cat["x_temporal_shape"],
    }


def edges(cat: Catalogue) -> DataFrame:
    return L.edges(sections(cat), {s: a for s, a in LINK_ATTRS.items() if a})


def index(cat: Catalogue) -> DataFrame:
    return L.uid_index(sections(cat))


@query("links_edges_count", f"""
WITH {EDGES} SELECT dst_uid, src_section, attr, count(*) AS refs FROM edge GROUP BY dst_uid, src_section, attr""")
def links_edges_count(cat):
    return L.edge_counts(edges(cat))


@query("links_dangling", f"""
WITH {EDGES}, {INDEX} SELECT src_section, src_uid, attr, dst_uid FROM edge WHERE dst_uid NOT IN (SELECT uid FROM idx)""")
def links_dangling(cat):
    return L.dangling(edges(cat), index(cat)).select("src_section", "src_uid", "attr", "dst_uid")


@query("links_bad_by_attr", f"""
WITH {EDGES}, {INDEX} SELECT src_section, attr, count(*) AS links,
 CAST(sum(CASE WHEN dst_uid NOT IN (SELECT uid FROM idx) THEN 1 ELSE 0 END) AS BIGINT) AS bad FROM edge GROUP BY src_section, attr""")
def links_bad_by_attr(cat):
    return L.bad_link_counts(edges(cat), index(cat))


@query("duplicate_keys", """
SELECT 'line' AS kind, concat(l_orderkey, '.', l_linenumber) AS key, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'experiment label', label, count(*) FROM x_experiment GROUP BY label HAVING count(*) > 1
UNION ALL SELECT 'objective', concat(mip, '.', label), count(*) FROM x_objective GROUP BY mip, label HAVING count(*) > 1
UNION ALL SELECT 'variable label', label, count(*) FROM x_cmorvar GROUP BY label HAVING count(*) > 1""")
def duplicate_keys(cat):
    kind = lambda df, name: df.select(F.lit(name).alias("kind"), "key", "n")
    line = F.concat(F.col("l_orderkey").cast("string"), F.lit("."), F.col("l_linenumber").cast("string")).alias("key")
    return L.union_all([
        kind(L.duplicates(cat["lineitem"], "l_orderkey", "l_linenumber").select(line, "n"), "line"),
        kind(L.duplicates(cat["x_experiment"], F.col("label").alias("key")), "experiment label"),
        kind(L.duplicates(cat["x_objective"], F.concat_ws(".", "mip", "label").alias("key")), "objective"),
        kind(L.duplicates(cat["x_cmorvar"], F.col("label").alias("key")), "variable label"),
    ])


@query("duplicate_uids", f"""
WITH {INDEX}, more AS (SELECT uid FROM idx UNION ALL SELECT concat('v', l_partkey) FROM lineitem GROUP BY l_partkey)
SELECT uid, count(*) AS n FROM more GROUP BY uid HAVING count(*) > 1""")
def duplicate_uids(cat):
    again = cat["lineitem"].select(F.concat(F.lit("v"), F.col("l_partkey").cast("string")).alias("uid")).distinct()
    return L.duplicates(index(cat).select("uid").unionByName(again), "uid")


@query("backlink_counts", """
WITH rv AS (SELECT vid AS uid, count(*) AS n FROM x_request_var GROUP BY vid),
st AS (SELECT stid, count(*) AS n1, CAST(sum(coalesce(rv.n, 0)) AS BIGINT) AS n2 FROM x_cmorvar LEFT JOIN rv USING (uid) GROUP BY stid),
g1 AS (SELECT vgid, count(*) AS n FROM x_request_var GROUP BY vgid), g2 AS (SELECT refid, count(*) AS n FROM x_request_link GROUP BY refid)
SELECT 'structure' AS kind, uid, coalesce(n1, 0) AS one_hop, coalesce(n2, 0) AS two_hops FROM x_structure LEFT JOIN st ON stid = uid
UNION ALL SELECT 'group', concat('vg', uid), coalesce(g1.n, 0), coalesce(g2.n, 0)
 FROM x_var_group LEFT JOIN g1 ON vgid = uid LEFT JOIN g2 ON refid = uid
UNION ALL SELECT 'table', mip_table, count(*), CAST(sum(coalesce(rv.n, 0)) AS BIGINT) FROM x_cmorvar LEFT JOIN rv USING (uid) GROUP BY mip_table
UNION ALL SELECT 'quantity', x.uid, count(v.uid), CAST(sum(coalesce(rv.n, 0)) AS BIGINT) FROM x_var x LEFT JOIN x_cmorvar v ON v.vid = x.uid LEFT JOIN rv ON rv.uid = v.uid GROUP BY x.uid
UNION ALL SELECT 'cell methods', s.cell_methods, count(*), CAST(sum(coalesce(n.n, 0)) AS BIGINT) FROM x_structure s LEFT JOIN (SELECT stid, count(*) AS n FROM x_cmorvar GROUP BY stid) n ON n.stid = s.uid GROUP BY s.cell_methods""")
def backlink_counts(cat):
    rv, v, link = cat["x_request_var"], cat["x_cmorvar"], cat["x_request_link"]
    requests = rv.select(F.col("vid").alias("dst"))
    st = L.backlink_counts(cat["x_structure"].select("uid"), v.select("uid", F.col("stid").alias("dst")), requests)
    tables = v.select(F.col("mip_table").alias("uid")).distinct()
    tb = L.backlink_counts(tables, v.select("uid", F.col("mip_table").alias("dst")), requests)
    vg = L.backlink_counts(cat["x_var_group"].select("uid"), rv.select(F.col("vid").alias("uid"), F.col("vgid").alias("dst")))
    vg = L.backlink_counts(vg.withColumnRenamed("one_hop", "vars"), link.select("uid", F.col("refid").alias("dst")))
    vg = vg.select(F.lit("group").alias("kind"), F.concat(F.lit("vg"), F.col("uid").cast("string")).alias("uid"),
                   F.col("vars").alias("one_hop"), F.col("one_hop").alias("two_hops"))
    kind = lambda df, k: df.select(F.lit(k).alias("kind"), "uid", "one_hop", "two_hops")
    quantity = L.backlink_counts(cat["x_var"].select("uid"), v.select("uid", F.col("vid").alias("dst")), requests)
    s = cat["x_structure"]
    methods = L.backlink_counts(s.select(F.col("cell_methods").alias("uid")).distinct(), s.select("uid", F.col("cell_methods").alias("dst")), v.select(F.col("stid").alias("dst")))
    return L.union_all([kind(st, "structure"), vg, kind(tb, "table"), kind(quantity, "quantity"), kind(methods, "cell methods")])


@query("linked", f"""
WITH {EDGES}, {INDEX} SELECT idx.section, idx.uid FROM idx WHERE uid IN (SELECT dst_uid FROM edge)""")
def linked(cat):
    return L.linked(index(cat), edges(cat)).select("section", "uid")


@query("unlinked", """
SELECT 'experiment not asked for directly' AS kind, uid FROM x_experiment WHERE uid NOT IN (SELECT esid FROM x_request_item)
UNION ALL SELECT 'variable in no request', concat('v', uid) FROM x_cmorvar WHERE uid NOT IN (SELECT vid FROM x_request_var)
UNION ALL SELECT 'group without link', concat('vg', uid) FROM x_var_group WHERE uid NOT IN (SELECT refid FROM x_request_link)""")
def unlinked(cat):
    e = edges(cat)
    s = sections(cat)
    rv = cat["x_request_var"].select(F.lit("requestVar").alias("src_section"), F.concat(F.lit("v"), F.col("vid").cast("string")).alias("dst_uid"))
    kind = lambda df, k: df.select(F.lit(k).alias("kind"), "uid")
    return L.union_all([
        kind(L.unlinked(s["experiment"], e, ["requestItem"]), "experiment not asked for directly"),
        kind(L.unlinked(s["CMORvar"], rv), "variable in no request"),
        kind(L.unlinked(s["requestVarGroup"], e, ["requestLink"]), "group without link"),
    ])


@query("section_counts", f"WITH {INDEX} SELECT section, count(*) AS records FROM idx GROUP BY section")
def section_counts(cat):
    return L.section_counts(index(cat))


@query("inverse_refs", f"""
WITH {EDGES}, {INDEX} SELECT e.dst_uid, e.src_section, e.attr, e.src_uid, i.label AS src_label
 FROM edge e LEFT JOIN idx i ON i.uid = e.src_uid AND i.section = e.src_section""")
def inverse_refs(cat):
    return L.inverse_references(edges(cat), index(cat)).select("dst_uid", "src_section", "attr", "src_uid", "src_label")


@query("record_referrers", f"""
WITH {EDGES}, {INDEX} SELECT e.dst_uid, e.src_section, e.attr, e.src_uid, i.label AS src_label
 FROM edge e LEFT JOIN idx i ON i.uid = e.src_uid AND i.section = e.src_section WHERE e.dst_uid IN (SELECT uid FROM x_mip UNION SELECT uid FROM x_structure)""")
def record_referrers(cat):
    targets = cat["x_mip"].select("uid").union(cat["x_structure"].select("uid"))
    return L.referrers(edges(cat), index(cat), targets).select("dst_uid", "src_section", "attr", "src_uid", "src_label")


@query("allow_deny", """
SELECT 'allowed' AS kind, uid FROM x_experiment WHERE label IN ('Customer#000000001', 'Customer#000000007', 'Customer#000000011')
 AND label NOT IN ('Customer#000000007')
UNION ALL SELECT 'not denied', uid FROM x_experiment WHERE label NOT IN ('Customer#000000002', 'Customer#000000003')
UNION ALL SELECT 'default deny list', uid FROM x_experiment
 WHERE label NOT IN ('esm-hist', 'esm-hist-ext', 'esm-piControl', 'piControl-spinup', 'esm-piControl-spinup')""")
def allow_deny_(cat):
    e = cat["x_experiment"]
    kind = lambda df, k: df.select(F.lit(k).alias("kind"), "uid")
    name = "Customer#00000000{}".format
    return L.union_all([
        kind(allow_deny(e, ["Customer#000000001", "Customer#000000007", "Customer#000000011"], ["Customer#000000007"]), "allowed"),
        kind(allow_deny(e, deny=[name(2), name(3)]), "not denied"),
        kind(e.where(not_esm(F.col("label"))), "default deny list"),
    ])


@query("experiment_filter", f"""
WITH {INDEX}, asked AS (SELECT c_name AS label FROM customer UNION SELECT r_name FROM region UNION SELECT n_name FROM nation
 UNION SELECT concat('group-', n_nationkey) FROM nation),
hit AS (SELECT DISTINCT a.label, i.uid AS esid FROM asked a JOIN idx i ON a.label = i.label AND i.section IN ('experiment', 'exptgroup', 'mip')),
found AS (SELECT h.label, e.uid AS expt FROM hit h JOIN x_experiment e ON h.esid = e.uid
 UNION SELECT h.label, e.uid FROM hit h JOIN x_experiment e ON h.esid = e.egid
 UNION SELECT h.label, e.uid FROM hit h JOIN x_experiment e ON h.esid = e.mip)
SELECT a.label, f.expt FROM asked a LEFT JOIN found f ON a.label = f.label""")
def experiment_filter_(cat):
    asked = (cat["customer"].select(F.col("c_name").alias("label"))
             .union(cat["region"].select("r_name")).union(cat["nation"].select("n_name"))
             .union(cat["nation"].select(F.concat(F.lit("group-"), F.col("n_nationkey").cast("string")))))
    return experiment_filter(asked, index(cat), cat["x_experiment"])


@query("effective_priority", """
WITH presets AS (SELECT DISTINCT l.refid, i.preset FROM x_request_item i JOIN x_request_link l ON i.rlid = l.uid),
rv AS (SELECT vgid, vid, min(priority) AS priority FROM x_request_var GROUP BY vgid, vid)
SELECT p.refid, p.preset, rv.vid, CASE WHEN p.preset <> -1 THEN p.preset ELSE rv.priority END AS priority
 FROM rv JOIN presets p ON rv.vgid = p.refid WHERE CASE WHEN p.preset <> -1 THEN p.preset ELSE rv.priority END <= 2""")
def effective_priority_(cat):
    return requested_pairs(cat["x_request_link"], cat["x_request_item"], cat["x_request_var"], 2)


@query("preset_filter", "SELECT uid, preset FROM x_request_item WHERE preset < 0 OR preset <= 2")
def preset_filter(cat):
    return cat["x_request_item"].where(preset_passes(F.col("preset"), 2)).select("uid", "preset")


@query("category_filter", """
SELECT uid, mcfg, mcfg IN ('AOGCM | AER CHEM BGC', 'AGCM | AER', 'LAND | ', 'RAD | ') AS loose,
 mcfg = 'AOGCM | AER CHEM BGC' AS strict FROM x_experiment""")
def category_filter(cat):
    e = cat["x_experiment"]
    wanted = ["AOGCM", "AER"]
    return e.select("uid", "mcfg", category_passes(F.col("mcfg"), wanted).alias("loose"),
                    category_passes(F.col("mcfg"), wanted, strict=True).alias("strict"))


@query("placeholder_filter", f"""
WITH {INDEX} SELECT uid, esid, rlid,
 nullif(concat_ws(',', CASE WHEN esid NOT IN (SELECT uid FROM idx WHERE section <> 'remarks') THEN 'target' END,
  CASE WHEN rlid NOT IN (SELECT uid FROM x_request_link) THEN 'link' END), '') AS broken FROM x_request_item""")
def placeholder_filter(cat):
    items = L.resolve(cat["x_request_item"].select("uid", "esid", "rlid"), "esid", index(cat))
    known = cat["x_request_link"].select(F.col("uid").alias("rlid"), F.lit(True).alias("known"))
    items = items.join(known, "rlid", "left")
    return L.broken_parts(items, {"target": F.col("esid_section") != PLACEHOLDER, "link": F.col("known")}).select("uid", "esid", "rlid", "broken")


@query("placeholders_dropped", f"WITH {INDEX} SELECT uid, esid FROM x_request_item WHERE esid IN (SELECT uid FROM idx WHERE section <> 'remarks')")
def placeholders_dropped(cat):
    return L.drop_placeholders(cat["x_request_item"].select("uid", "esid"), "esid", index(cat)).select("uid", "esid")


@query("list_by_mip", """
SELECT m.label AS mip, 'experiment' AS kind, e.label AS name FROM x_mip m JOIN x_experiment e ON e.mip = m.uid
UNION ALL SELECT m.label, 'objective', o.label FROM x_mip m JOIN x_objective o ON o.mip = m.uid""")
def list_by_mip(cat):
    m = cat["x_mip"].select(F.col("uid").alias("mip"), F.col("label").alias("name"))
    kind = lambda df, k: df.join(m, "mip").select(F.col("name").alias("mip"), F.lit(k).alias("kind"), F.col("label").alias("name"))
    return kind(cat["x_experiment"], "experiment").unionByName(kind(cat["x_objective"], "objective")).orderBy("mip", "kind", "name")


@query("lookups", f"""
WITH {INDEX}, refs AS (SELECT esid AS uid, count(*) AS n FROM x_request_item GROUP BY esid)
SELECT r.uid, r.n, i.section, i.label FROM refs r LEFT JOIN idx i ON r.uid = i.uid""")
def lookups(cat):
    refs = cat["x_request_item"].groupBy(F.col("esid").alias("uid")).agg(F.count(F.lit(1)).alias("n"))
    return L.resolve(refs, "uid", index(cat)).select("uid", "n", F.col("uid_section").alias("section"), F.col("uid_label").alias("label"))


@query("last_by_label", """
SELECT p_name AS label, max(p_partkey) AS uid, arg_max(p_brand, p_partkey) AS vid FROM part GROUP BY p_name""")
def last_by_label(cat):
    return L.last_by_label(cat["x_cmorvar"].select("label", "uid", "vid"), "uid").select("label", "uid", "vid")


@query("follow_link", """
SELECT v.uid, v.vid, q.label AS var_label, q.units AS var_units FROM x_cmorvar v LEFT JOIN x_var q ON v.vid = q.uid""")
def follow_link(cat):
    v = L.follow(cat["x_cmorvar"].select("uid", "vid"), "vid", cat["x_var"].select("uid", "label", "units"), "var_")
    return v.select("uid", "vid", "var_label", "var_units")


@query("record_unpivot", f"""
WITH {INDEX}, flat AS (SELECT uid, 'egid' AS attr, egid AS value FROM x_experiment UNION ALL SELECT uid, 'mip', mip FROM x_experiment
 UNION ALL SELECT uid, 'label', label FROM x_experiment UNION ALL SELECT uid, 'mcfg', mcfg FROM x_experiment
 UNION ALL SELECT concat('i', uid), 'esid', esid FROM x_request_item)
SELECT f.uid, f.attr, f.value, CASE WHEN f.attr IN ('egid', 'mip', 'esid')
 THEN coalesce('[' || i.section || ']' || i.label, 'key not found') END AS target
 FROM flat f LEFT JOIN idx i ON i.uid = f.value AND f.attr IN ('egid', 'mip', 'esid')""")
def record_unpivot(cat):
    s, idx = sections(cat), index(cat)
    return L.record_summary(s["experiment"], idx, ["egid", "mip"], ["label", "mcfg"]).unionByName(
        L.record_summary(s["requestItem"], idx, ["esid"], []))


@query("attribute_filters", """
SELECT 'links of m1' AS what, count(*) AS hits, count(*) > 0 AS found FROM x_request_link WHERE mip = 'm1'
UNION ALL SELECT 'links with no grid of m9', count(*), count(*) > 0 FROM x_request_link WHERE mip = 'm9'
UNION ALL SELECT 'items with a slice', count(*), count(*) > 0 FROM x_request_item WHERE ts_label IS NOT NULL""")
def attribute_filters(cat):
    link = cat["x_request_link"]
    parts = {"links of m1": link.where(F.col("mip") == "m1"), "links with no grid of m9": link.where(F.col("mip") == "m9"),
             "items with a slice": S.present(cat["x_request_item"], "ts_label")}
    return L.union_all([S.hit_count(df).select(F.lit(k).alias("what"), "hits", S.any_hit(df).scalar().alias("found")) for k, df in parts.items()])


@query("index_by_name", """
SELECT 'label' AS attr, label AS value, uid FROM x_var UNION ALL SELECT 'sn', sn, uid FROM x_var WHERE sn <> '__unset__'
UNION ALL SELECT 'label', label, concat('v', uid) FROM x_cmorvar""")
def index_by_name(cat):
    s = sections(cat)
    return L.value_index(s["var"], "label", "sn").unionByName(L.value_index(s["CMORvar"], "label"))


@query("vocabulary_columns", "SELECT label, description FROM x_var")
def vocabulary_columns(cat):
    return cat["x_var"].select("label", "description")
