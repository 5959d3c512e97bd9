"""Queries on requested years, grids, choices and time slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.functions import sizes as Z
from gridledger.operators import request as R
from gridledger.operators import slices as I
from gridledger.operators.request import Policy
from gridledger.plans import sqltext as Q
from gridledger.plans.registry import query
from gridledger.plans.roles import Catalogue

POLICY = Policy(tier_max=2, pmax=2)


def sized(cat: Catalogue) -> DataFrame:
    return cat.once("sized", lambda: Z.variable_sizes(cat["x_cmorvar"], cat["x_structure"], cat["x_spatial_shape"]))


def variable_requests(cat: Catalogue, policy: Policy = POLICY, by=(), links: DataFrame | None = None, experiments: DataFrame | None = None,
                      carry=()) -> DataFrame:
    return R.variable_requests(cat["x_request_link"] if links is None else links, cat["x_request_item"],
                               cat["x_experiment"] if experiments is None else experiments, cat["x_request_var"],
                               sized(cat).select("uid", "grid_class"), policy, by, carry)


def best_years(cat: Catalogue, links: DataFrame | None = None, experiments: DataFrame | None = None) -> DataFrame:
    """Years per variable and experiment on the best grid."""
    args = (cat["x_request_link"] if links is None else links, cat["x_request_item"], cat["x_experiment"] if experiments is None else experiments)
    wanted = R.wanted_variables(*args, cat["x_request_var"], sized(cat).select("uid", "grid_class"), POLICY)
    return R.best_years(R.group_years(*args, POLICY), wanted, cat["x_request_var"], POLICY).select("vid", "expt", "grid", "years")


def selected(cat: Catalogue, policy: Policy = POLICY, by=(), links: DataFrame | None = None) -> DataFrame:
    return R.selected_variables(cat["x_request_link"] if links is None else links, cat["x_request_item"], cat["x_experiment"],
                                cat["x_request_var"], sized(cat).select("uid", "grid_class"), policy, by)


@query("sizes", f"""
WITH {Q.SIZED} SELECT vid, latlon, size_native, size_1deg, size_2deg, npy100, CAST(npy100 AS DOUBLE) / 100 AS npy,
 {Q.CLIM} AS clim, frequency IN ('monClim', 'monC') AS clim_legacy, lower(frequency) LIKE '%clim%' AS clim_label FROM sized""")
def sizes(cat):
    f = F.col("frequency")
    return sized(cat).select(F.col("uid").alias("vid"), "latlon", "size_native", "size_1deg", "size_2deg", "npy100",
                             Z.outputs_per_year(f).alias("npy"), Z.is_climatology(f).alias("clim"),
                             Z.is_climatology_legacy(f).alias("clim_legacy"), Z.is_climatology_label(f).alias("clim_label"))


@query("sizes_by_structure_grid", f"""
WITH {Q.SIZED} SELECT stid AS uid, 'native' AS grid, CAST(k * nh AS BIGINT) AS size FROM strc
UNION ALL SELECT stid, '100km', CAST(k * n1 AS BIGINT) FROM strc UNION ALL SELECT stid, '1deg', CAST(k * n1 AS BIGINT) FROM strc
UNION ALL SELECT stid, '2deg', CAST(k * n2 AS BIGINT) FROM strc""")
def sizes_by_structure_grid(cat):
    return Z.size_by_structure_and_grid(cat["x_structure"], cat["x_spatial_shape"]).select("uid", "grid", "size")


@query("sizes_user_model", f"""
WITH {Q.SIZED.replace('259200', '1000').replace("'%olevel%' OR dimensions LIKE '%rho%' THEN 60", "'%olevel%' OR dimensions LIKE '%rho%' THEN 11").replace("'%alevel%' THEN 40", "'%alevel%' THEN 7")}
SELECT stid AS uid, CAST(k * nh AS BIGINT) AS size_native FROM strc""")
def sizes_user_model(cat):
    config = Z.model_config([1000, 11, 64800, 7, 20, 5, 100])
    return Z.structure_sizes(cat["x_structure"], cat["x_spatial_shape"], config).select("uid", "size_native")


@query("grid_policy", f"""
WITH {Q.SIZED}, g AS (SELECT uid, {Q.REQ_GRID} AS asked FROM x_request_link l)
SELECT 'link' AS kind, concat('l', uid) AS uid, asked AS value FROM g
UNION ALL SELECT 'variable', concat('v', vid), concat(cls, '/', CASE WHEN cls = 'o' THEN '1deg' ELSE 'native' END) FROM sized""")
def grid_policy(cat):
    link = cat["x_request_link"].select(F.lit("link").alias("kind"), F.concat(F.lit("l"), F.col("uid").cast("string")).alias("uid"),
                                        Z.request_grid(F.col("grid"), F.col("gridreq")).alias("value"))
    settled = Z.default_grid(F.lit("DEF"), F.col("grid_class"))
    v = sized(cat).select(F.lit("variable").alias("kind"), F.concat(F.lit("v"), F.col("uid").cast("string")).alias("uid"),
                          F.concat("grid_class", F.lit("/"), settled).alias("value"))
    return link.unionByName(v)


@query("item_expansion", f"""
WITH {Q.MEMBERS} SELECT i.uid AS item, m.expt, m.nstart, {Q.CAP} AS years, {Q.members_of(2)} AS members, i.ts_label, i.ts_start, i.ts_end
 FROM x_request_item i JOIN members m ON i.esid = m.esid WHERE m.tier1 <= 2""")
def item_expansion(cat):
    return R.item_expansion(cat["x_request_item"], cat["x_experiment"], 2).select(
        "item", "expt", "nstart", "years", "members", "ts_label", "ts_start", "ts_end")


@query("item_totals", f"""
WITH {Q.MEMBERS}, x AS (SELECT i.uid AS item, count(*) AS n, CAST(sum(m.nstart * {Q.CAP}) AS BIGINT) AS y, CAST(sum({Q.members_of(2)}) AS BIGINT) AS e
 FROM x_request_item i JOIN members m ON i.esid = m.esid WHERE m.tier1 <= 2 GROUP BY i.uid)
SELECT i.uid AS item, coalesce(x.n, 0) AS experiments, coalesce(x.y, 0) AS years, coalesce(x.e, 0) AS members
 FROM x_request_item i LEFT JOIN x ON x.item = i.uid""")
def item_totals(cat):
    return R.item_totals(cat["x_request_item"], R.item_expansion(cat["x_request_item"], cat["x_experiment"], 2))


@query("years_of_links", "SELECT rlid, CAST(sum(ny) AS BIGINT) AS years FROM x_request_item GROUP BY rlid")
def years_of_links(cat):
    return R.years_of_links(cat["x_request_item"])


@query("years_group", f"WITH {Q.requests()} SELECT refid, expt, grid, years FROM gy")
def years_group(cat):
    return R.group_years(cat["x_request_link"], cat["x_request_item"], cat["x_experiment"], POLICY).select("refid", "expt", "grid", "years")


@query("years_variable", f"WITH {Q.requests()} SELECT vid, expt, grid, max(years) AS years FROM vr GROUP BY vid, expt, grid")
def years_variable(cat):
    policy = Policy(tier_max=2, pmax=2, all_grids=True)
    return R.variable_years(variable_requests(cat, policy), policy)


@query("best_grid", f"WITH {Q.requests()}, {Q.best()} SELECT vid, expt, grid, years FROM vy")
def best_grid(cat):
    return best_years(cat)


@query("best_grid_denied_experiments", f"""
WITH {Q.requests(expt_where="AND m.label NOT LIKE '%7'")}, {Q.best()} SELECT vid, expt, grid, years FROM vy""")
def best_grid_denied_experiments(cat):
    allowed = cat["x_experiment"].where(~F.col("label").endswith("7"))
    return best_years(cat, experiments=allowed)


@query("selected_variables", f"WITH {Q.requests(by_mip=True)} SELECT DISTINCT req_mip, vid FROM vr")
def selected_variables(cat):
    return selected(cat, by=["mip"]).select("req_mip", "vid")


@query("choice_rank", f"WITH {Q.requests()}, {Q.redundant('vr')} SELECT vid FROM redundant")
def choice_rank(cat):
    return R.redundant_variables(selected(cat), cat["x_choice_rank"])


@query("choice_config", f"""
WITH {Q.requests()}, s AS (SELECT DISTINCT vid FROM vr), setting AS (SELECT cid, min(vid) % 3 = 0 AS cfg FROM x_choice_cfg GROUP BY cid)
SELECT vid FROM s WHERE vid NOT IN (SELECT c.vid FROM x_choice_cfg c LEFT JOIN setting USING (cid) WHERE c.cfg <> coalesce(setting.cfg, TRUE))""")
def choice_config(cat):
    setting = cat["x_choice_cfg"].groupBy("cid").agg((F.min("vid") % 3 == 0).alias("cfg"))
    return R.drop_by_configuration(selected(cat), cat["x_choice_cfg"], setting).select("vid")


# --- time slices ---------------------------------------------------------------------------------------

SLICES = f"""{Q.MEMBERS},
gs AS (SELECT DISTINCT l.refid, m.expt, i.ts_label, i.ts_type, i.ts_start, i.ts_end
 FROM x_request_item i JOIN x_request_link l ON i.rlid = l.uid JOIN members m ON i.esid = m.esid
 WHERE (i.treset IS NULL OR i.treset <= 2) AND m.tier1 <= 2),
pp AS (SELECT DISTINCT l.refid, i.preset FROM x_request_item i JOIN x_request_link l ON i.rlid = l.uid),
pv AS (SELECT p.refid, rv.vid, min(CASE WHEN p.preset <> -1 THEN p.preset ELSE rv.priority END) AS priority
 FROM pp p JOIN x_request_var rv ON rv.vgid = p.refid
 WHERE CASE WHEN p.preset <> -1 THEN p.preset ELSE rv.priority END <= 2 GROUP BY p.refid, rv.vid),
vs AS (SELECT pv.vid, gs.expt, ts_label, ts_type, ts_start, ts_end, min(priority) AS priority
 FROM gs JOIN pv USING (refid) GROUP BY pv.vid, gs.expt, ts_label, ts_type, ts_start, ts_end)"""

MERGED = f"""{SLICES},
n AS (SELECT *, row_number() OVER (PARTITION BY vid, expt ORDER BY ts_label) AS k, count(*) OVER (PARTITION BY vid, expt) AS c FROM vs),
f AS (SELECT vid, expt, count(*) AS slices, min(priority) AS lowest, min(CASE WHEN ts_label IS NULL THEN priority END) AS unsliced,
 count(DISTINCT ts_type) AS types, min(ts_type) AS t, string_agg(ts_label, ',' ORDER BY ts_label) AS labels, min(ts_start) AS first,
 max(CASE WHEN k = 1 THEN ts_label END) AS la, max(CASE WHEN k = 1 THEN ts_start END) AS sa, max(CASE WHEN k = 1 THEN ts_end END) AS ea, max(CASE WHEN k = 1 THEN priority END) AS pa,
 max(CASE WHEN k = c THEN ts_label END) AS lb, max(CASE WHEN k = c THEN ts_start END) AS sb, max(CASE WHEN k = c THEN ts_end END) AS eb, max(CASE WHEN k = c THEN priority END) AS pb,
 max(ROW(ts_end, ts_end - ts_start, ts_label, ts_start, priority)) FILTER (WHERE ts_end IS NOT NULL) AS z FROM n GROUP BY vid, expt),
w AS (SELECT *, CASE WHEN unsliced IS NOT NULL THEN 'none' WHEN slices = 1 THEN 'a'
 WHEN (types > 1 OR t = 'dayList') AND labels = 'RFMIP,RFMIP2' THEN 'union' WHEN (types > 1 OR t = 'dayList') AND labels IN ('RFMIP,hist55', 'RFMIP,RFMIP2,hist55') THEN 'plus'
 WHEN (types > 1 OR t = 'dayList') AND labels = 'RFMIP2,hist55' THEN 'hist' WHEN types > 1 OR t = 'dayList' THEN '-1'
 WHEN slices = 2 AND sa <= sb AND ea >= eb THEN 'a' WHEN slices = 2 AND sb <= sa AND eb >= ea THEN 'b'
 WHEN slices = 2 AND (ea < sb OR eb < sa) THEN 'two' WHEN slices = 2 THEN '-3' WHEN z[4] = first THEN 'z' ELSE '-4' END AS d FROM f),
m AS (SELECT vid, expt, slices, CAST(CASE d WHEN 'two' THEN 2 WHEN '-1' THEN -1 WHEN '-3' THEN -3 WHEN '-4' THEN -4 ELSE 1 END AS BIGINT) AS rc,
 CASE WHEN d IN ('a', 'two') THEN la WHEN d = 'b' THEN lb WHEN d = 'z' THEN z[3] WHEN d = 'union' THEN 'RFMIP-union' WHEN d = 'plus' THEN 'hist55plus' WHEN d = 'hist' THEN 'hist55' END AS ts_label,
 CASE WHEN d IN ('a', 'b', 'two', 'z') THEN t WHEN d = 'union' THEN 'dayList' WHEN d = 'plus' THEN 'rangeplus' WHEN d = 'hist' THEN 'simpleRange' END AS ts_type,
 CASE WHEN d IN ('a', 'two') THEN sa WHEN d = 'b' THEN sb WHEN d = 'z' THEN z[4] WHEN d IN ('plus', 'hist') THEN 1960 END AS ts_start,
 CASE WHEN d IN ('a', 'two') THEN ea WHEN d = 'b' THEN eb WHEN d = 'z' THEN z[1] WHEN d IN ('plus', 'hist') THEN 2014 END AS ts_end,
 CASE WHEN d = 'none' THEN unsliced WHEN d IN ('a', 'two') THEN pa WHEN d = 'b' THEN pb WHEN d = 'z' THEN z[5] ELSE lowest END AS priority,
 CASE WHEN d = 'two' THEN lb END AS other_label, CASE WHEN d = 'two' THEN sb END AS other_start, CASE WHEN d = 'two' THEN eb END AS other_end FROM w)"""


def variable_slices(cat: Catalogue) -> DataFrame:
    return I.variable_slices(cat["x_request_link"], cat["x_request_item"], cat["x_experiment"], cat["x_request_var"], POLICY, shared=True)


def merged_slices(cat: Catalogue) -> DataFrame:
    return I.merge_slices(variable_slices(cat), ["vid", "expt", "_share"]).drop("_share")


@query("slice_priorities", f"WITH {SLICES} SELECT vid, expt, ts_label, ts_start, ts_end, priority FROM vs")
def slice_priorities(cat):
    return variable_slices(cat).select("vid", "expt", "ts_label", "ts_start", "ts_end", "priority")


@query("slice_merge", f"WITH {MERGED} SELECT * FROM m")
def slice_merge(cat):
    return merged_slices(cat)


@query("slice_years", f"""
WITH {MERGED} SELECT vid, expt, rc,
 CASE WHEN rc = 2 THEN CAST(ts_end - ts_start + 1 + other_end - other_start + 1 AS VARCHAR) WHEN ts_type = 'simpleRange' THEN CAST(ts_end + 1 - ts_start AS VARCHAR)
  WHEN ts_type = 'rangeplus' THEN concat(ts_end + 1 - ts_start, '.01') WHEN rc = 1 AND ts_label IS NOT NULL THEN 'slice' ELSE 'All' END AS n_years,
 CASE WHEN ts_type = 'rangeplus' THEN concat('Partial 1850 + ', ts_start, ' to ', ts_end) WHEN ts_type = 'dayList' THEN ts_label ELSE '' END AS slice_type,
 CASE WHEN rc = 2 THEN array_to_string(list_concat(range(ts_start, ts_end + 1), range(other_start, other_end + 1)), ' ')
  WHEN ts_type = 'simpleRange' THEN array_to_string(range(ts_start, ts_end + 1), ' ')
  WHEN ts_type = 'rangeplus' THEN concat('1850 ', array_to_string(range(ts_start, ts_end + 1), ' ')) END AS years FROM m""")
def slice_years(cat):
    y = I.slice_years(merged_slices(cat))
    return y.select("vid", "expt", "rc", "n_years", "slice_type", F.array_join(F.transform("years", lambda x: x.cast("string")), " ").alias("years"))


@query("slice_compare", """
WITH s AS (SELECT l.refid, i.uid, i.ts_label AS label, i.ts_type AS type, i.ts_start AS s, i.ts_end AS e,
  row_number() OVER (PARTITION BY l.refid ORDER BY i.uid) AS k
 FROM x_request_item i JOIN x_request_link l ON i.rlid = l.uid WHERE i.ts_label IS NOT NULL),
p AS (SELECT a.refid, a.uid AS a_uid, b.uid AS b_uid, a.label AS la, b.label AS lb, a.type AS ta, b.type AS tb, a.s AS sa, a.e AS ea, b.s AS sb, b.e AS eb
 FROM s a JOIN s b ON a.refid = b.refid AND a.k = 1 AND b.k > 1),
q AS (SELECT *, concat(least(la, lb), ',', greatest(la, lb)) AS pair, ta <> tb OR ta = 'dayList' AS mixed FROM p)
SELECT refid, a_uid, b_uid, CAST(CASE WHEN la = lb THEN 0 WHEN mixed AND pair IN ('RFMIP,RFMIP2', 'RFMIP,hist55', 'RFMIP2,hist55') THEN 1 WHEN mixed THEN -1
  WHEN (sa <= sb AND ea >= eb) OR (sb <= sa AND eb >= ea) THEN 1 WHEN ea < sb OR eb < sa THEN 2 ELSE -3 END AS BIGINT) AS rc,
 CASE WHEN la = lb THEN la WHEN mixed AND pair = 'RFMIP,RFMIP2' THEN 'RFMIPunion' WHEN mixed AND pair IN ('RFMIP,hist55', 'RFMIP2,hist55') THEN 'hist55plus'
  WHEN mixed THEN NULL WHEN sa <= sb AND ea >= eb THEN la WHEN sb <= sa AND eb >= ea THEN lb END AS answer FROM q""")
def slice_compare(cat):
    items = R.link_items(cat["x_request_link"], cat["x_request_item"].where(F.col("ts_label").isNotNull()), POLICY)
    s = items.select("refid", "uid", F.col("ts_label").alias("label"), F.col("ts_type").alias("type"), F.col("ts_start").alias("start"), F.col("ts_end").alias("end"))
    fields = ["uid", "label", "type", "start", "end"]
    # every slice of a group meets the one of its first item: one row per group on that side
    first = s.groupBy("refid").agg(F.min(F.struct(*fields)).alias("a")).select("refid", *[F.col(f"a.{c}").alias(f"a_{c}") for c in fields])
    pairs = s.select("refid", *[F.col(c).alias(f"b_{c}") for c in fields]).join(first, ["refid"]).where(F.col("a_uid") != F.col("b_uid"))
    return I.compare_slices(pairs).select("refid", "a_uid", "b_uid", "rc", "answer")
