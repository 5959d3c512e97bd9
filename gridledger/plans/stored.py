"""Queries on tables that are written once and read in parts: outputs by two keys, snapshots, the link index."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridledger.operators import linkindex as I
from gridledger.operators import snapshots as S
from gridledger.plans import sqltext as Q
from gridledger.plans.files import new_folder
from gridledger.plans.links import EDGES, INDEX, edges, index
from gridledger.plans.registry import query
from gridledger.plans.roles import Catalogue
from gridledger.plans.volumes import fact
from gridledger.sources import clustered as K


SNAPSHOT_RANGES, BUCKETS = 64, 16


def outputs(cat: Catalogue) -> str:
    """Volumes of every variable that a project asks of an experiment, as files clustered by project and experiment."""
    place = K.interleaved(F.col("req_mip"), F.col("expt"))
    rows = fact(cat, ["req_mip", "expt", "vid", "mip_table", "place"], by=["mip"], place=place)
    folder = new_folder(cat, "outputs")
    K.write_clustered(rows, folder, "req_mip", "expt", dealt="place")
    return folder


@query("outputs_by_request", f"""
WITH {Q.FULL_BY_MIP} SELECT req_mip, expt, count(*) AS variables, {Q.volume()} AS volume FROM fact GROUP BY req_mip, expt""")
def outputs_by_request(cat):
    folder = outputs(cat)
    rows = cat.spark.read.parquet(f"{folder}/rows").groupBy("req_mip", "expt").agg(
        (F.sum("hundredths").cast("double") / 100.0).alias("volume"))
    counts = K.pair_index(cat.spark, folder).groupBy("req_mip", "expt").agg(F.sum("rows").alias("variables"))
    return rows.join(counts, ["req_mip", "expt"]).select("req_mip", "expt", "variables", "volume")


@query("outputs_of_pair", f"""
WITH {Q.FULL_BY_MIP}, f AS MATERIALIZED (SELECT req_mip, expt, vid, mip_table, hundredths FROM fact), p AS (SELECT req_mip, expt FROM f ORDER BY req_mip, expt LIMIT 1)
SELECT req_mip, expt, vid, mip_table, CAST(hundredths AS DOUBLE) / 100.0 AS volume FROM f SEMI JOIN p USING (req_mip, expt)""")
def outputs_of_pair(cat):
    folder = outputs(cat)
    pair = K.pair_index(cat.spark, folder).orderBy("req_mip", "expt").select("req_mip", "expt").first()
    rows = K.read_pair(cat.spark, folder, "req_mip", "expt", tuple(pair) if pair else (None, None))
    return rows.select("req_mip", "expt", "vid", "mip_table", (F.col("hundredths").cast("double") / 100.0).alias("volume"))


@query("snapshot_diff", """
SELECT p_partkey AS uid, CASE WHEN p_partkey % 997 = 0 THEN 'only_left' ELSE 'changed' END AS status, CASE WHEN p_partkey % 997 = 0 THEN NULL ELSE 'size' END AS changed
 FROM part WHERE p_partkey % 997 = 0 OR p_partkey % 501 = 0 UNION ALL SELECT -1, 'only_right', NULL""")
def snapshot_diff(cat):
    old = cat["part"].select(F.col("p_partkey").cast("bigint").alias("uid"), F.col("p_name").alias("label"), F.col("p_size").cast("bigint").alias("size"))
    new = old.where("uid % 997 <> 0").withColumn("size", F.when(F.col("uid") % 501 == 0, F.col("size") + 1).otherwise(F.col("size")))
    new = new.unionByName(cat.spark.range(1).select(F.lit(-1).cast("bigint").alias("uid"), F.lit("new").alias("label"), F.lit(1).cast("bigint").alias("size")))
    folders = [new_folder(cat, "snapshot") for _ in range(2)]
    for df, folder in zip((old, new), folders):
        S.write_snapshot(df, folder, "uid", SNAPSHOT_RANGES)
    return S.snapshot_diff(cat.spark, *folders, ["label", "size"], ranges=SNAPSHOT_RANGES).withColumn("changed", F.array_join("changed", ","))


def link_index(cat: Catalogue) -> I.LinkIndex:
    return cat.once("link index", lambda: I.build(edges(cat), index(cat), new_folder(cat, "links"), BUCKETS))


@query("indexed_references", f"""
WITH {EDGES}, {INDEX} SELECT e.dst_uid, e.src_section, e.attr, e.src_uid, i.label AS src_label
 FROM edge e LEFT JOIN idx i ON i.uid = e.src_uid AND i.section = e.src_section""")
def indexed_references(cat):
    return I.references(link_index(cat))


@query("indexed_dangling", f"""
WITH {EDGES}, {INDEX} SELECT src_section, attr, count(*) AS links FROM edge WHERE dst_uid NOT IN (SELECT uid FROM idx) GROUP BY src_section, attr""")
def indexed_dangling(cat):
    return I.dangling(link_index(cat)).groupBy("src_section", "attr").agg(F.count(F.lit(1)).alias("links"))


@query("indexed_lookup", f"""
WITH {EDGES}, {INDEX}, r AS (SELECT dst_uid, count(*) AS refs FROM edge GROUP BY dst_uid)
SELECT i.uid, i.section, i.label, coalesce(r.refs, 0) AS refs FROM idx i LEFT JOIN r ON r.dst_uid = i.uid WHERE i.uid IN (SELECT uid FROM x_var) OR i.uid IN (SELECT uid FROM x_exptgroup)""")
def indexed_lookup(cat):
    wanted = cat["x_var"].select("uid").unionByName(cat["x_exptgroup"].select("uid"))
    return I.lookup(link_index(cat), wanted)
