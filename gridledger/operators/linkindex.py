"""A link index that is built once: edges and records as tables bucketed by uid, or by uid and section.

Look-ups and references back join bucket by bucket, without moving the index. The tables lie in a shared folder and are known to the session's
catalogue under names of their own; ``drop`` forgets them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


@dataclass
class LinkIndex:
    """Names of the bucketed tables: edges by target, edges by source and section, records by uid, and by uid and section."""

    spark: SparkSession
    by_target: str
    by_source: str
    records: str
    sources: str

    def edges_to(self) -> DataFrame:
        return self.spark.table(self.by_target)

    def edges_from(self) -> DataFrame:
        return self.spark.table(self.by_source)

    def index(self) -> DataFrame:
        return self.spark.table(self.records)

    def source_index(self) -> DataFrame:
        return self.spark.table(self.sources)

    def drop(self) -> None:
        for name in (self.by_target, self.by_source, self.records, self.sources):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def build(edge: DataFrame, index: DataFrame, folder: str, buckets: int = BUCKETS) -> LinkIndex:
    """Writes the tables below ``folder``; a record whose uid several sections share has a row for each.

    The edges of a popular target are one bucket's, as several files where adaptive execution finds them too many for a task.
    """
    spark, mark = edge.sparkSession, uuid.uuid4().hex

    def table(df: DataFrame, name: str, *keys: str) -> str:
        full = f"{name}_{mark}"
        dealt = df.hint("rebalance", buckets, *keys)          # a file or so per bucket, several of one that is large
        dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{folder}/{full}").format("parquet").saveAsTable(full)
        return full

    first = index.groupBy("uid", "section").agg(F.min("label").alias("label"))                 # of a repeated uid the first label
    return LinkIndex(spark, table(edge, "edges_to", "dst_uid"), table(edge, "edges_from", "src_uid", "src_section"), table(first, "records", "uid"),
                     table(first, "sources", "uid", "section"))


def references(links: LinkIndex) -> DataFrame:
    """Every reference with the label of its source: ``(dst_uid, src_section, attr, src_uid, src_label)``; sources meet in their buckets."""
    edge, records = links.edges_from().alias("e"), links.source_index().alias("r")
    met = edge.join(records, (F.col("e.src_uid") == F.col("r.uid")) & (F.col("e.src_section") == F.col("r.section")), "left")
    return met.select("e.dst_uid", "e.src_section", "e.attr", "e.src_uid", F.col("r.label").alias("src_label"))


def dangling(links: LinkIndex) -> DataFrame:
    """Edges whose target no record has."""
    edge, records = links.edges_to().alias("e"), links.index().alias("r")
    return edge.join(records, F.col("e.dst_uid") == F.col("r.uid"), "left_anti")


def lookup(links: LinkIndex, targets: DataFrame) -> DataFrame:
    """Records and numbers of references of some uids: ``(uid, section, label, refs)``; a uid that no record has is left out."""
    wanted = targets.select(F.col("uid").cast("string").alias("uid")).distinct()
    found = links.index().join(wanted, "uid", "left_semi")
    refs = links.edges_to().groupBy(F.col("dst_uid").alias("uid")).agg(F.count(F.lit(1)).alias("refs"))
    return found.join(refs, "uid", "left").select("uid", "section", "label", F.coalesce("refs", F.lit(0)).alias("refs"))
