"""Pieces of SQL shared by the oracles of requests and volumes.  Each function returns common table expressions."""

from __future__ import annotations

from gridledger.plans.paths import MEMBERS

CAP = "CASE WHEN i.nymax < 0 THEN m.yps ELSE least(m.yps, i.nymax) END"

CLIM = "(lower(frequency) LIKE '%clim%' OR frequency IN ('monC', '1hrCM'))"

NPY100 = """CASE frequency WHEN 'mon' THEN 1200 WHEN 'day' THEN 36500 WHEN '6hr' THEN 146000 WHEN 'yr' THEN 100 WHEN 'monC' THEN 1200
 WHEN '3hr' THEN 292000 WHEN 'fx' THEN 1 WHEN '1hrClimMon' THEN 28800 END"""

REQ_GRID = """CASE WHEN l.grid = '100km' THEN '1deg' WHEN l.grid IN ('1deg', '2deg') THEN l.grid WHEN l.gridreq IN ('No', 'no') THEN 'native'
 WHEN l.gridreq = 'no*1' THEN 'native:01' ELSE 'DEF' END"""

RANK = "CASE grid WHEN 'native:01' THEN 1 WHEN 'native' THEN 2 WHEN '1deg' THEN 3 WHEN '100km' THEN 4 WHEN '2deg' THEN 5 WHEN 'DEF' THEN 6 ELSE 7 END"

# sizes of shapes and structures, grid class of variables
SIZED = f"""shp AS (
SELECT uid AS spid, label AS shape_label,
 contains(dimensions, 'latitude') AND contains(dimensions, 'longitude') AS plane,
 CASE WHEN NOT (contains(dimensions, 'latitude') AND contains(dimensions, 'longitude')) THEN ''
  WHEN contains(dimensions, 'olevel') THEN 'o' ELSE 'a' END AS latlon,
 CASE WHEN level_flag THEN levels WHEN dimensions LIKE '%olevel%' OR dimensions LIKE '%rho%' THEN 60 WHEN dimensions LIKE '%alevel%' THEN 40
  WHEN dimensions LIKE '%aslevel%' THEN 20 WHEN dimensions LIKE '%slevel%' THEN 5 WHEN dimensions LIKE '%sdepth%' THEN 5 END AS nz
 FROM x_spatial_shape),
strc AS (
SELECT s.uid AS stid, s.spid, s.odims, shp.shape_label, shp.latlon,
 CASE s.odims WHEN '' THEN 1 WHEN 'vegtype' THEN 8 WHEN 'tau' THEN 7 ELSE 5 END * nz AS k,
 CASE shp.latlon WHEN 'o' THEN 259200 WHEN 'a' THEN 64800 ELSE 10 END AS nh,
 CASE WHEN plane THEN 64800 ELSE 10 END AS n1, CASE WHEN plane THEN 16200 ELSE 10 END AS n2
 FROM x_structure s JOIN shp USING (spid)),
sized AS (
SELECT v.uid AS vid, v.vid AS quantity, v.label, v.mip_table, v.frequency, st.spid, st.odims, st.latlon,
 CAST(k * nh AS BIGINT) AS size_native, CAST(k * n1 AS BIGINT) AS size_1deg, CAST(k * n2 AS BIGINT) AS size_2deg,
 CAST({NPY100} AS BIGINT) AS npy100,
 CASE WHEN modeling_realm LIKE '%ocean%' THEN 'o' WHEN modeling_realm LIKE '%seaIce%' THEN 'si' WHEN modeling_realm = 'landIce' THEN 'li'
  WHEN modeling_realm <> '' THEN 'a' WHEN st.odims = 'iceband' THEN 'si' WHEN st.odims <> '' THEN 'a'
  WHEN shape_label IN ('TR-na', 'XY-O', 'YB-O', 'YB-R') THEN 'o' WHEN shape_label <> 'XY-na' THEN 'a'
  WHEN prov = 'CFMIP [cf1hrClimMon]' THEN 'a' WHEN prov = 'DAMIP [DAMIP_Omon_p2]' THEN 'o' END AS cls
 FROM x_cmorvar v JOIN strc st USING (stid))"""

SIZE_ON = """CASE WHEN latlon = '' THEN size_native WHEN grid IN ('native', 'native:01') THEN size_native WHEN grid IN ('1deg', '100km') THEN size_1deg
 WHEN grid = '2deg' THEN size_2deg END"""


def members_of(tier: int) -> str:
    size = f"CASE WHEN m.tier2 <= {tier} THEN m.ensz2 WHEN m.tier1 <= {tier} THEN m.ensz1 ELSE 0 END"
    return f"CASE WHEN i.nenmax < 0 THEN {size} ELSE least({size}, i.nenmax) END"


def requests(tier: int = 2, pmax: int = 2, mips: str | None = None, by_mip: bool = False, expt_where: str = "") -> str:
    """Expressions ``gy`` (group years), ``pre`` (presets), ``vr`` (variable requests on settled grids)."""
    where = f"l.mip IN ({mips})" if mips else "TRUE"
    rm = "l.mip AS req_mip," if by_mip else ""
    gb = ", req_mip" if by_mip else ""
    return f"""{MEMBERS}, {SIZED},
gy AS (
SELECT l.refid, {rm} m.expt, {REQ_GRID} AS grid, max(m.nstart * {CAP} * {members_of(tier)}) AS years
 FROM x_request_item i JOIN x_request_link l ON i.rlid = l.uid JOIN members m ON i.esid = m.esid
 WHERE {where} AND (i.treset IS NULL OR i.treset <= {tier}) AND m.tier1 <= {tier} {expt_where}
 GROUP BY l.refid, m.expt, {REQ_GRID}{", l.mip" if by_mip else ""}),
pre AS (
SELECT l.refid, {rm} bool_or(i.preset = -1) AS plain, bool_or(i.preset <> -1 AND i.preset <= {pmax}) AS forced
 FROM x_request_item i JOIN x_request_link l ON i.rlid = l.uid WHERE {where} GROUP BY l.refid{", l.mip" if by_mip else ""}),
rv AS (SELECT vgid AS refid, vid, min(priority) AS priority FROM x_request_var GROUP BY vgid, vid),
vr AS (
SELECT rv.vid, gy.expt, gy.refid{", gy.req_mip" if by_mip else ""},
 CASE WHEN gy.grid <> 'DEF' THEN gy.grid WHEN s.cls = 'o' THEN '1deg' ELSE 'native' END AS grid, gy.years
 FROM gy JOIN pre USING (refid{gb}) JOIN rv ON rv.refid = gy.refid JOIN sized s ON s.vid = rv.vid
 WHERE s.cls IS NOT NULL AND (pre.forced OR (pre.plain AND rv.priority <= {pmax})))"""


def best(src: str = "vr", out: str = "vy", by_mip: bool = False) -> str:
    """Largest years per variable and experiment on the best grid."""
    by = ", req_mip" if by_mip else ""
    return f"""{out}_g AS (SELECT vid, expt{by}, grid, max(years) AS years FROM {src} GROUP BY vid, expt{by}, grid),
{out} AS (SELECT vid, expt{by}, grid, years FROM {out}_g QUALIFY row_number() OVER (PARTITION BY vid, expt{by} ORDER BY {RANK}) = 1)"""


def redundant(src: str = "vy", out: str = "redundant", by_mip: bool = False) -> str:
    """Selected variables below the top rank of a choice group."""
    by = ", req_mip" if by_mip else ""
    sel = "vid, req_mip" if by_mip else "vid"
    return f"""{out} AS (SELECT DISTINCT {sel} FROM (
SELECT c.vid{by.replace("req_mip", "s.req_mip")}, c.rank, max(c.rank) OVER (PARTITION BY c.cid{by.replace("req_mip", "s.req_mip")}) AS top
 FROM x_choice_rank c JOIN (SELECT DISTINCT {sel} FROM {src}) s ON c.vid = s.vid) WHERE rank < top)"""


def fact(src: str = "vy", out: str = "fact", drop: str | None = "redundant", by_mip: bool = False) -> str:
    by = ", y.req_mip" if by_mip else ""
    same = " AND r.req_mip = y.req_mip" if by_mip else ""
    anti = f"WHERE NOT EXISTS (SELECT 1 FROM {drop} r WHERE r.vid = y.vid{same})" if drop else ""
    return f"""{out} AS (
SELECT y.vid, y.expt{by}, y.grid, y.years, s.mip_table, s.frequency, s.label,
 CAST({SIZE_ON} AS HUGEINT) * npy100 * CASE WHEN {CLIM} THEN 1 ELSE y.years END AS hundredths
 FROM {src} y JOIN sized s ON s.vid = y.vid {anti})"""


def volume(expr: str = "hundredths") -> str:
    return f"CAST(sum({expr}) AS DOUBLE) / 100.0"


FULL = f"{requests()}, {best()}, {redundant()}, {fact()}"
FULL_BY_MIP = f"{requests(by_mip=True)}, {best(by_mip=True)}, {redundant(by_mip=True)}, {fact(by_mip=True)}"
