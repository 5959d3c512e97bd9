"""Catalogue sections played by the given tables.

Each section is one SELECT over whole tables, written in SQL that Spark and DuckDB read alike, so that the same text
feeds the queries and their oracles.  All fan-outs are bounded per row of ``orders``, ``lineitem``, ``part`` and
``customer``: the sections grow in step with the tables, and so do the results of the queries.

* project (mip) = region, experiment = customer, experiment group = eight customers
* request link and request item = order, plus one link and item per region that asks for the whole project
* variable group = four neighbouring orders, request variable = line item, variable = part
* structure and spatial shape = the sizes that occur in part
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

#: Output frequencies of the variables below.
FREQUENCIES = ["mon", "day", "6hr", "yr", "monC", "3hr", "fx", "1hrClimMon"]

ROLES: dict[str, str] = {}

ROLES["x_mip"] = """
SELECT concat('m', r_regionkey) AS uid, CASE r_regionkey WHEN 4 THEN 'SolarMIP' ELSE r_name END AS label, concat('http://', lower(r_name), '.example') AS url FROM region"""

ROLES["x_exptgroup"] = """
SELECT concat('g', CAST(floor(c_custkey / 8) AS BIGINT)) AS uid,
 concat('group-', CAST(floor(c_custkey / 8) AS BIGINT)) AS label, 1 + min(c_custkey) % 3 AS tier_min
 FROM customer GROUP BY CAST(floor(c_custkey / 8) AS BIGINT)"""

ROLES["x_experiment"] = """
SELECT concat('e', c_custkey) AS uid, CASE c_custkey WHEN 11 THEN 'esm-hist' WHEN 12 THEN 'esm-piControl' WHEN 13 THEN 'piControl-spinup' ELSE c_name END AS label, concat('g', CAST(floor(c_custkey / 8) AS BIGINT)) AS egid,
 concat('m', n_regionkey) AS mip, 1 + c_custkey % 3 AS tier1, 2 + c_custkey % 3 AS tier2,
 1 + c_custkey % 5 AS ensz1, 3 + c_custkey % 7 AS ensz2, 1 + c_custkey % 2 AS nstart, 10 + c_custkey % 150 AS yps,
 CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AOGCM | AER CHEM BGC' WHEN 'BUILDING' THEN 'AGCM | AER'
  WHEN 'FURNITURE' THEN 'LAND | ' WHEN 'HOUSEHOLD' THEN 'AOGCM BGC | AER' ELSE 'RAD | ' END AS mcfg
 FROM customer JOIN nation ON c_nationkey = n_nationkey"""

ROLES["x_request_link"] = """
SELECT o_orderkey AS uid, concat('m', n_regionkey) AS mip, CAST(floor(o_orderkey / 4) AS BIGINT) AS refid,
 CASE WHEN o_orderstatus <> 'F' THEN 'any' WHEN o_orderkey % 3 = 0 THEN '1deg' WHEN o_orderkey % 3 = 1 THEN '2deg' ELSE '100km' END AS grid,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'No' WHEN '2-HIGH' THEN 'no*1' ELSE 'maybe' END AS gridreq,
 CASE WHEN o_orderpriority = '1-URGENT' THEN 'priority' ELSE '' END AS opt, 1 + o_orderkey % 3 AS opar,
 o_orderpriority AS objective
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT CAST(-1 - r_regionkey AS BIGINT) AS uid, concat('m', r_regionkey) AS mip, CAST(r_regionkey AS BIGINT) AS refid,
 'any' AS grid, 'maybe' AS gridreq, '' AS opt, CAST(1 AS BIGINT) AS opar, 'whole project' AS objective FROM region"""

ROLES["x_request_item"] = """
SELECT o_orderkey AS uid,
 CASE WHEN o_orderkey % 19 = 18 THEN -1000 - o_orderkey WHEN o_orderkey % 5 = 4 THEN o_orderkey - 1 ELSE o_orderkey END AS rlid,
 CASE o_orderkey % 4 WHEN 1 THEN concat('g', CAST(floor(o_custkey / 8) AS BIGINT)) WHEN 3 THEN concat('r', o_custkey)
  ELSE concat('e', o_custkey) END AS esid,
 1 + o_orderkey % 50 AS ny,
 CASE WHEN o_orderkey % 7 = 0 THEN -1 ELSE 1 + o_orderkey % 100 END AS nymax,
 CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 + o_orderkey % 4 END AS nenmax,
 CASE WHEN o_orderkey % 11 = 0 THEN CAST(2 AS BIGINT) WHEN o_orderkey % 11 = 1 THEN CAST(1 AS BIGINT) END AS treset,
 CASE WHEN o_orderkey % 13 = 0 THEN CAST(1 AS BIGINT) WHEN o_orderkey % 13 = 1 THEN CAST(3 AS BIGINT) ELSE CAST(-1 AS BIGINT) END AS preset,
 concat('m', o_orderkey % 5) AS own_mip,
 CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 23 = 1 THEN 'hist55' WHEN o_orderkey % 23 = 2 THEN 'RFMIP'
  WHEN o_orderkey % 23 = 3 THEN 'RFMIP2'
  ELSE concat('s', CAST(year(o_orderdate) AS BIGINT), '-', o_orderkey % 9) END AS ts_label,
 CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 23 IN (2, 3) THEN 'dayList' ELSE 'simpleRange' END AS ts_type,
 CASE WHEN o_orderkey % 6 = 0 OR o_orderkey % 23 IN (2, 3) THEN NULL WHEN o_orderkey % 23 = 1 THEN 1960
  ELSE CAST(year(o_orderdate) AS BIGINT) END AS ts_start,
 CASE WHEN o_orderkey % 6 = 0 OR o_orderkey % 23 IN (2, 3) THEN NULL WHEN o_orderkey % 23 = 1 THEN 2014
  ELSE CAST(year(o_orderdate) AS BIGINT) + o_orderkey % 9 END AS ts_end
 FROM orders
UNION ALL
SELECT CAST(-1 - r_regionkey AS BIGINT) AS uid, CAST(-1 - r_regionkey AS BIGINT) AS rlid, concat('m', r_regionkey) AS esid,
 CAST(10 AS BIGINT) AS ny, CAST(-1 AS BIGINT) AS nymax, CAST(-1 AS BIGINT) AS nenmax, CAST(NULL AS BIGINT) AS treset,
 CAST(-1 AS BIGINT) AS preset, concat('m', r_regionkey) AS own_mip, CAST(NULL AS VARCHAR(20)) AS ts_label, CAST(NULL AS VARCHAR(20)) AS ts_type,
 CAST(NULL AS BIGINT) AS ts_start, CAST(NULL AS BIGINT) AS ts_end FROM region"""

ROLES["x_remarks"] = """
SELECT concat('r', c_custkey) AS uid, concat('placeholder ', c_custkey) AS label FROM customer WHERE c_custkey % 2 = 0"""

ROLES["x_request_var"] = """
SELECT CAST(floor(l_orderkey / 4) AS BIGINT) AS vgid, l_partkey AS vid,
 CAST(1 + (l_linenumber - 1) % 3 AS BIGINT) AS priority FROM lineitem"""

ROLES["x_var_group"] = """
SELECT CAST(floor(o_orderkey / 4) AS BIGINT) AS uid, concat('pack ', CAST(floor(o_orderkey / 4) AS BIGINT)) AS label
 FROM orders GROUP BY CAST(floor(o_orderkey / 4) AS BIGINT)"""

ROLES["x_cmorvar"] = """
SELECT p_partkey AS uid, p_brand AS vid, p_name AS label, p_type AS mip_table,
 CASE p_size % 8 WHEN 0 THEN 'mon' WHEN 1 THEN 'day' WHEN 2 THEN '6hr' WHEN 3 THEN 'yr' WHEN 4 THEN 'monC' WHEN 5 THEN '3hr'
  WHEN 6 THEN 'fx' ELSE '1hrClimMon' END AS frequency,
 concat('st', p_size) AS stid,
 CASE p_size % 7 WHEN 0 THEN 'ocean' WHEN 1 THEN 'seaIce ocean' WHEN 2 THEN 'atmos land' WHEN 3 THEN 'landIce'
  WHEN 4 THEN 'seaIce' WHEN 5 THEN '' ELSE 'atmos' END AS modeling_realm,
 CASE p_size % 3 WHEN 0 THEN 'DAMIP [DAMIP_Omon_p2]' WHEN 1 THEN 'CFMIP [cf1hrClimMon]' ELSE 'table A' END AS prov,
 CASE p_size % 3 WHEN 0 THEN 'up' WHEN 1 THEN 'down' ELSE '' END AS positive, CASE p_size % 4 WHEN 0 THEN 'integer' ELSE 'real' END AS type,
 concat('note ', p_size % 6) AS prov_note, CAST(1 + p_size % 3 AS BIGINT) AS default_priority, CAST(p_size AS BIGINT) AS row_index,
 concat(p_name, ' ', lower(p_type)) AS title, concat(p_brand, ' ', p_name) AS description FROM part"""

ROLES["x_var"] = """
SELECT p_brand AS uid, lower(p_brand) AS label, concat('quantity of ', p_brand) AS title,
 CASE WHEN min(p_partkey) % 2 = 0 THEN 'K' ELSE 'm s-1' END AS units, min(concat(p_brand, ' ', p_name)) AS description,
 CASE WHEN min(p_partkey) % 5 = 4 THEN concat('r', p_brand) WHEN min(p_partkey) % 5 = 3 THEN '__unset__' ELSE concat('sn', p_brand) END AS sn,
 concat('Brand#', 1 + min(p_partkey) % 40) AS rel1, CASE WHEN min(p_partkey) % 2 = 0 THEN '__unset__' ELSE p_brand END AS rel2
 FROM part GROUP BY p_brand"""

ROLES["x_structure"] = """
SELECT concat('st', p_size) AS uid, concat('sp', p_size % 10) AS spid, concat('tm', p_size % 3) AS tmid,
 concat('structure ', p_size) AS title,
 CASE p_size % 5 WHEN 0 THEN '' WHEN 1 THEN 'vegtype' WHEN 2 THEN 'tau' WHEN 3 THEN 'iceband' ELSE 'unlisted' END AS odims,
 CASE WHEN p_size % 4 = 0 THEN 'height2m' ELSE '' END AS coords, CASE WHEN p_size % 6 = 0 THEN 'time: point' ELSE 'time: mean' END AS cell_methods,
 CASE WHEN p_size % 2 = 0 THEN 'area: areacella' ELSE '' END AS cell_measures
 FROM part GROUP BY p_size"""

ROLES["x_spatial_shape"] = """
SELECT concat('sp', p_size % 10) AS uid,
 CASE p_size % 10 WHEN 0 THEN 'XY-na' WHEN 1 THEN 'XY-O' WHEN 2 THEN 'XY-A' WHEN 3 THEN 'XY-P19' WHEN 4 THEN 'YB-O'
  WHEN 5 THEN 'XY-S' WHEN 6 THEN 'YB-R' WHEN 7 THEN 'XY-SN' WHEN 8 THEN 'S-A' ELSE 'XY-HA' END AS label,
 CASE p_size % 10 WHEN 0 THEN 'longitude|latitude' WHEN 1 THEN 'longitude|latitude|olevel' WHEN 2 THEN 'longitude|latitude|alevel'
  WHEN 3 THEN 'longitude|latitude|plev19' WHEN 4 THEN 'latitude|basin' WHEN 5 THEN 'longitude|latitude|slevel'
  WHEN 6 THEN 'latitude|rho|basin' WHEN 7 THEN 'longitude|latitude|sdepth' WHEN 8 THEN 'alevel|site'
  ELSE 'longitude|latitude|aslevel' END AS dimensions,
 CAST(CASE p_size % 10 WHEN 3 THEN 19 ELSE 1 END AS BIGINT) AS levels,
 p_size % 10 IN (0, 3, 4) AS level_flag
 FROM part GROUP BY p_size % 10"""

ROLES["x_temporal_shape"] = """
SELECT concat('tm', p_size % 3) AS uid,
 CASE p_size % 3 WHEN 0 THEN 'time' WHEN 1 THEN 'time1' ELSE 'time2' END AS dimensions FROM part GROUP BY p_size % 3"""

ROLES["x_qcrange"] = """
SELECT concat('q', p_partkey) AS uid, p_partkey AS vid, floor(p_retailprice) AS valid_min,
 CASE WHEN p_size % 4 = 0 THEN NULL ELSE floor(p_retailprice) + p_size END AS valid_max,
 CASE WHEN p_size % 2 = 0 THEN 'robust' ELSE 'tentative' END AS valid_min_status,
 CASE WHEN p_size % 3 = 0 THEN 'robust' ELSE 'suggested' END AS valid_max_status FROM part"""

ROLES["x_choice_rank"] = """
SELECT p_partkey AS vid, concat('c', CAST(floor(p_partkey / 3) AS BIGINT)) AS cid, CAST(floor(p_partkey / 7) % 4 AS BIGINT) AS rank FROM part
UNION ALL
SELECT p_partkey AS vid, concat('d', CAST(floor((p_partkey + 1) / 7) AS BIGINT)) AS cid, CAST(floor(p_partkey / 5) % 2 AS BIGINT) AS rank FROM part"""

ROLES["x_choice_cfg"] = """
SELECT p_partkey AS vid, concat('c', CAST(floor(p_partkey / 5) AS BIGINT)) AS cid, p_size % 2 = 0 AS cfg FROM part"""

ROLES["x_objective"] = """
SELECT concat(o_orderpriority, '/m', n_regionkey) AS uid, o_orderpriority AS label, concat('m', n_regionkey) AS mip
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
 GROUP BY o_orderpriority, n_regionkey"""

ROLES["x_objective_link"] = """
SELECT concat(o_orderpriority, '/m', n_regionkey) AS oid, o_orderkey AS rid
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

# columns the SQL spells as two scalars, because the engines differ in array literals
_ARRAYS = {"x_experiment": {"tier": ("tier1", "tier2"), "ensz": ("ensz1", "ensz2")}, "x_var": {"related": ("rel1", "rel2")}}


_TABLE_USE = re.compile(r"(?<=FROM |JOIN )(?:" + "|".join(TABLES) + r")\b")


class Catalogue:
    """The given tables and the sections derived from them, read lazily from one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._made: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._made[name]

    def mips(self) -> list[str]:
        """The projects, a closed vocabulary of a few names."""
        if "mips" not in self._made:
            self._made["mips"] = [r[0] for r in self["x_mip"].select("uid").orderBy("uid").collect()]
        return self._made["mips"]

    def once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A derived frame that several parts of one query name; built (not computed) once."""
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        if name not in self._made:
            used = set(_TABLE_USE.findall(ROLES[name]))
            text = _TABLE_USE.sub(lambda m: f"{{{m.group(0)}}}", ROLES[name])
            df = self.spark.sql(text, **{t: self.table(t) for t in used})
            for name_, parts in _ARRAYS.get(name, {}).items():
                df = df.withColumn(name_, F.array(*parts)).drop(*parts)
            self._made[name] = df
        return self._made[name]


def with_roles(sql: str) -> str:
    """Puts the sections a query names in front of it as common table expressions."""
    used = [r for r in ROLES if r in sql]
    if not used:
        return sql
    ctes = ",\n".join(f"{r} AS ({ROLES[r].strip()})" for r in used)
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
