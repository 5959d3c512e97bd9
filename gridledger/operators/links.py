"""The link graph of a catalogue: edges, the uid index, inverse references and integrity reports.

An edge is a row ``(src_section, src_uid, attr, dst_uid)``.  References to a record stay rows as well: a popular
target can have any number of them, so they are never gathered into one array.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.lookup import PLACEHOLDER, UNSET


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def edges(sections: dict[str, DataFrame], link_attrs: dict[str, dict[str, str]]) -> DataFrame:
    """Edges of all link attributes; ``link_attrs[section][attr]`` is ``scalar`` or ``list``.  Unset links are left out."""
    parts = []
    for section, attrs in link_attrs.items():
        df = sections[section]
        one = [F.struct(F.lit(a).alias("attr"), F.array(F.col(a).cast("string")).alias("dst")) if kind == "scalar"
               else F.struct(F.lit(a).alias("attr"), F.col(a).cast("array<string>").alias("dst"))
               for a, kind in attrs.items()]
        parts.append(
            df.select(F.lit(section).alias("src_section"), F.col("uid").cast("string").alias("src_uid"),
                      F.explode(F.array(*one)).alias("l"))
            .select("src_section", "src_uid", "l.attr", F.explode("l.dst").alias("dst_uid"))
        )
    return union_all(parts).where(F.col("dst_uid") != UNSET)


def uid_index(sections: dict[str, DataFrame]) -> DataFrame:
    """``(uid, section, label)`` of every record of every section."""
    label = lambda df: F.col("label").cast("string") if "label" in df.columns else F.lit(None).cast("string")
    return union_all([
        df.select(F.col("uid").cast("string").alias("uid"), F.lit(s).alias("section"), label(df).alias("label"))
        for s, df in sections.items()
    ])


def value_index(df: DataFrame, *attrs: str) -> DataFrame:
    """``(attr, value, uid)``: every record under each value of some attributes; a value may have any number of records."""
    values = F.array(*[F.struct(F.lit(a).alias("attr"), F.col(a).cast("string").alias("value")) for a in attrs])
    return df.select(F.col("uid").cast("string").alias("uid"), F.inline(values)).where(F.col("value") != UNSET).select("attr", "value", "uid")


def section_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("section").agg(F.count(F.lit(1)).alias("records"))


def edge_counts(edge: DataFrame) -> DataFrame:
    """References per (target, source section, attribute)."""
    return edge.groupBy("dst_uid", "src_section", "attr").agg(F.count(F.lit(1)).alias("refs"))


def inverse_references(edge: DataFrame, index: DataFrame) -> DataFrame:
    """Every reference to a record with the label of its source: ``(dst_uid, src_section, attr, src_uid, src_label)``."""
    source = index.select(F.col("section").alias("src_section"), F.col("uid").alias("src_uid"), F.col("label").alias("src_label"))
    one = source.groupBy("src_section", "src_uid").agg(F.min("src_label").alias("src_label"))      # of a repeated uid the first label
    return edge.join(one, ["src_section", "src_uid"], "left")


def referrers(edge: DataFrame, index: DataFrame, targets: DataFrame) -> DataFrame:
    """The references to some records ``targets(uid)``, ordered by source section and label."""
    wanted = targets.select(F.col("uid").alias("dst_uid")).distinct()
    return inverse_references(edge.join(wanted, ["dst_uid"], "left_semi"), index).orderBy(
        "dst_uid", "src_section", "src_label", "src_uid")


def missing_targets(edge: DataFrame, index: DataFrame) -> DataFrame:
    """Distinct link targets that no record has.  Repeated targets collapse before they meet the index."""
    return edge.select("dst_uid").distinct().join(index.select(F.col("uid").alias("dst_uid")), "dst_uid", "left_anti")


def dangling(edge: DataFrame, index: DataFrame) -> DataFrame:
    """Edges whose target is not in the index."""
    return edge.join(missing_targets(edge, index), ["dst_uid"], "left_semi")


def bad_link_counts(edge: DataFrame, index: DataFrame) -> DataFrame:
    """Bad links and links in all per section and attribute, counted before the join with the index."""
    counted = edge.groupBy("src_section", "attr", "dst_uid").agg(F.count(F.lit(1)).alias("n"))
    known = index.select(F.col("uid").alias("dst_uid"), F.lit(True).alias("known")).distinct()
    return (
        counted.join(known, "dst_uid", "left").groupBy("src_section", "attr")
        .agg(F.sum("n").alias("links"), F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("bad"))
    )


def duplicates(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def last_by_label(df: DataFrame, position: str) -> DataFrame:
    """One record per label, the last one in document order."""
    rest = [c for c in df.columns if c != "label"]
    picked = df.groupBy("label").agg(F.max(F.struct(position, *[c for c in rest if c != position])).alias("r"))
    return picked.select("label", *[F.col(f"r.{c}").alias(c) for c in rest])


def backlink_counts(targets: DataFrame, first: DataFrame, second: DataFrame | None = None) -> DataFrame:
    """Number of records that link to a target and, optionally, of those that link to these in turn.

    ``targets(uid)``, ``first(uid, dst)``, ``second(dst)`` where ``second.dst`` is a ``first.uid``.  Counting comes before
    every join, so each join meets one row per key.
    """
    if second is None:
        n = first.groupBy("dst").agg(F.count(F.lit(1)).alias("one_hop"))
        return targets.join(n, targets["uid"] == n["dst"], "left").select(
            targets["*"], F.coalesce("one_hop", F.lit(0)).alias("one_hop"))
    n2 = second.groupBy(F.col("dst").alias("uid")).agg(F.count(F.lit(1)).alias("n2"))
    n1 = (first.join(n2, "uid", "left").groupBy("dst")
          .agg(F.count(F.lit(1)).alias("one_hop"), F.sum(F.coalesce("n2", F.lit(0))).alias("two_hops")))
    return targets.join(n1, targets["uid"] == n1["dst"], "left").select(
        targets["*"], F.coalesce("one_hop", F.lit(0)).alias("one_hop"), F.coalesce("two_hops", F.lit(0)).alias("two_hops"))


def linked(records: DataFrame, edge: DataFrame, by_sections: list[str] | None = None) -> DataFrame:
    """Records that something links to; with ``by_sections`` only links from those sections count."""
    return records.join(_link_targets(edge, by_sections), "uid", "left_semi")


def unlinked(records: DataFrame, edge: DataFrame, by_sections: list[str] | None = None) -> DataFrame:
    return records.join(_link_targets(edge, by_sections), "uid", "left_anti")


def _link_targets(edge: DataFrame, by_sections: list[str] | None) -> DataFrame:
    e = edge if by_sections is None else edge.where(F.col("src_section").isin(by_sections))
    return e.select(F.col("dst_uid").alias("uid")).distinct()


def follow(df: DataFrame, attr: str, target: DataFrame, prefix: str) -> DataFrame:
    """Adds the columns of the record a link attribute points to, each with a prefix."""
    named = target.select(F.col("uid").alias(attr), *[F.col(c).alias(f"{prefix}{c}") for c in target.columns if c != "uid"])
    return df.join(named, [attr], "left")


def resolve(df: DataFrame, attr: str, index: DataFrame) -> DataFrame:
    """Adds section and label of the record behind a link attribute; section is NULL for an unknown one."""
    named = index.select(F.col("uid").alias(attr), F.col("section").alias(f"{attr}_section"), F.col("label").alias(f"{attr}_label"))
    return df.join(named, [attr], "left")


def drop_placeholders(df: DataFrame, attr: str, index: DataFrame) -> DataFrame:
    """Rows whose link target exists and is not a placeholder record."""
    real = index.where(F.col("section") != PLACEHOLDER).select(F.col("uid").alias(attr)).distinct()
    return df.join(real, [attr], "left_semi")


def broken_parts(df: DataFrame, parts: dict[str, Column]) -> DataFrame:
    """Adds ``broken``: the names of the parts whose condition "resolved" fails, NULL for good rows."""
    names = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in parts.items()]))
    return df.withColumn("broken", F.when(F.size(names) > 0, F.array_join(names, ",")))


def record_summary(df: DataFrame, index: DataFrame, links: list[str], values: list[str]) -> DataFrame:
    """Records as rows (uid, attr, value, target): link attributes show their target or that it was not found."""
    cols = links + values
    flat = df.select(F.col("uid").cast("string").alias("uid"), *[F.col(c).cast("string").alias(c) for c in cols])
    flat = flat.unpivot(["uid"], cols, "attr", "value")
    named = index.select(F.col("uid").alias("value"), F.concat(F.lit("["), "section", F.lit("]"), "label").alias("found"))
    is_link = F.col("attr").isin(links) if links else F.lit(False)
    # only link values meet the index; plain values keep their rows without a join key
    keyed = flat.withColumn("key", F.when(is_link, F.col("value"))).withColumn("is_link", is_link)
    joined = keyed.join(named.withColumnRenamed("value", "key"), ["key"], "left")
    target = F.when(F.col("is_link"), F.coalesce("found", F.lit("key not found")))
    return joined.select("uid", "attr", "value", target.alias("target"))
