"""Queries on a dataset catalogue: orders are datasets, line items their files, documents a faceted collection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.operators import search as S
from gridledger.plans.registry import query
from gridledger.plans.roles import Catalogue


def datasets(cat: Catalogue) -> DataFrame:
    """Orders as search records: facets are lists of values, absent for some records."""
    n = F.col("o_orderkey")
    return cat["orders"].select(
        n.alias("dataset_id"), F.array(F.concat(F.lit("model-"), (F.col("o_custkey") % 17).cast("string"))).alias("source_id"),
        F.array("o_orderpriority", "o_orderstatus").alias("experiment_id"),
        F.when(n % 9 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("r"), F.col("o_custkey").cast("string")))).alias("member_id"),
        F.concat(F.lit("v"), (n % 6).cast("string")).alias("variable_id"), (n % 4 == 0).alias("replica"), (n % 3 != 0).alias("latest"),
        F.when((n % 8 == 0) | (n % 6 == 5), None).otherwise(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).alias("creation_date"))


DATASETS = """ds AS (SELECT o_orderkey AS dataset_id, concat('model-', o_custkey % 17) AS source_id, o_orderpriority, o_orderstatus,
 CASE WHEN o_orderkey % 9 <> 0 THEN concat('r', o_custkey) END AS member, concat('v', o_orderkey % 6) AS variable_id,
 o_orderkey % 4 = 0 AS replica, o_orderkey % 3 <> 0 AS latest,
 CASE WHEN o_orderkey % 8 = 0 OR o_orderkey % 6 = 5 THEN NULL ELSE o_orderdate END AS t FROM orders)"""


@query("title_search", """SELECT uid, label, title FROM x_cmorvar WHERE contains(lower(title), 'ring')""")
def title_search(cat):
    return S.title_contains(cat["x_cmorvar"], "RING", "uid", "label", "title")


@query("facet_search", f"""
WITH {DATASETS} SELECT dataset_id, variable_id FROM ds WHERE (o_orderpriority IN ('1-URGENT', 'F') OR o_orderstatus IN ('1-URGENT', 'F'))
 AND variable_id IN ('v1', 'v2', 'v4') AND NOT replica AND latest""")
def facet_search(cat):
    found = S.facet_search(datasets(cat), experiment_id=["1-URGENT", "F"], variable_id=["v1", "v2", "v4"], replica=False, latest=True)
    return found.select("dataset_id", "variable_id")


@query("document_facets", """
SELECT lang, source, count(*) AS hits, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents WHERE lang IN ('en', 'de') AND source <> 'src3' GROUP BY lang, source""")
def document_facets(cat):
    found = S.facet_search(cat["documents"], lang=["en", "de"]).where(F.col("source") != "src3")
    return found.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("hits"), F.sum(F.length("text")).alias("chars"))


@query("hit_counts", """
SELECT variable_id, count(*) AS datasets FROM (SELECT concat('v', o_orderkey % 6) AS variable_id FROM orders) GROUP BY variable_id""")
def hit_counts(cat):
    return datasets(cat).groupBy("variable_id").agg(F.count(F.lit(1)).alias("datasets"))


@query("any_hit", "SELECT count(*) > 0 AS found FROM documents WHERE lang = 'fr' AND source = 'src7'")
def any_hit(cat):
    return S.any_hit(S.facet_search(cat["documents"], lang="fr", source="src7"))


@query("models_per_variable", """
SELECT DISTINCT concat('v', o_orderkey % 6) AS variable_id, concat('model-', o_custkey % 17) AS model FROM orders""")
def models_per_variable(cat):
    d = datasets(cat).withColumn("model", S.first_value(F.col("source_id")))
    return S.distinct_values(d, "model", "variable_id")


@query("sources_per_lang", "SELECT DISTINCT lang, source FROM documents")
def sources_per_lang(cat):
    return S.distinct_values(cat["documents"], "source", "lang")


@query("nested_sets", f"WITH {DATASETS} SELECT DISTINCT source_id AS model, o_orderpriority AS experiment, variable_id FROM ds")
def nested_sets(cat):
    d = datasets(cat).select(S.first_value(F.col("source_id")).alias("model"), S.first_value(F.col("experiment_id")).alias("experiment"), "variable_id")
    return S.distinct_values(d, "variable_id", "model", "experiment")


@query("members_per_group", f"""
WITH {DATASETS} SELECT o_orderpriority AS experiment, count(DISTINCT coalesce(member, '-')) AS members FROM ds GROUP BY o_orderpriority""")
def members_per_group(cat):
    d = datasets(cat).select(S.first_value(F.col("experiment_id"), "-").alias("experiment"), S.first_value(F.col("member_id")).alias("member"))
    return S.distinct_counts(d, "member", "experiment")


@query("latest_dataset", f"""
WITH {DATASETS} SELECT variable_id, dataset_id, strftime(t, '%Y-%m-%d') AS created, o_orderpriority AS experiment FROM ds WHERE t IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY variable_id ORDER BY t DESC, dataset_id) = 1""")
def latest_dataset(cat):
    d = datasets(cat).withColumn("created", S.iso_time(F.col("creation_date"))).withColumn("experiment", S.first_value(F.col("experiment_id"), "?"))
    best = S.newest(d, "variable_id", "created", "dataset_id", "experiment")
    return best.withColumn("created", F.date_format("created", "yyyy-MM-dd"))


@query("variables_without_date", f"WITH {DATASETS} SELECT variable_id FROM ds GROUP BY variable_id HAVING count(t) = 0")
def variables_without_date(cat):
    return S.without_time(datasets(cat), "variable_id", "creation_date")


@query("latest_per_group", """
SELECT event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) = 1""")
def latest_per_group(cat):
    best = S.newest(cat["events"], "event_type", "ts", "event_id", "value")
    return best.select("event_type", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "value")


@query("dataset_files", f"""
WITH {DATASETS} SELECT ds.variable_id, ds.dataset_id, count(*) AS files FROM ds JOIN lineitem ON l_orderkey = dataset_id WHERE latest GROUP BY ds.variable_id, ds.dataset_id""")
def dataset_files(cat):
    # files are counted per dataset before the datasets are looked up
    counts = S.file_counts(cat["lineitem"].withColumnRenamed("l_orderkey", "dataset_id"), "dataset_id")
    return S.files_of(S.facet_search(datasets(cat), latest=True).select("dataset_id", "variable_id"), counts, "dataset_id").select(
        "variable_id", "dataset_id", "files")


@query("first_files", f"""
WITH {DATASETS} SELECT concat(variable_id, '_', dataset_id, '_', l_linenumber) AS title, l_partkey, l_quantity FROM ds JOIN lineitem ON l_orderkey = dataset_id
 WHERE latest ORDER BY title, l_partkey, l_quantity LIMIT 15""")
def first_files(cat):
    files = cat["lineitem"].select(F.col("l_orderkey").alias("dataset_id"), "l_linenumber", "l_partkey", "l_quantity")
    found = S.files_of(S.facet_search(datasets(cat), latest=True).select("dataset_id", "variable_id"), files, "dataset_id")
    title = F.concat_ws("_", "variable_id", F.col("dataset_id").cast("string"), F.col("l_linenumber").cast("string"))
    return S.first_files(found.select(title.alias("title"), "l_partkey", "l_quantity"), ["title", "l_partkey", "l_quantity"])
