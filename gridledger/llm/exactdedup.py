"""Exact deduplication that splits off heavy hitters.

Misra-Gries summaries, one per partition and then merged, name the few digests that may be frequent. Their true counts
and winners are found with map-side aggregation and broadcast, so the rows of a frequent text never meet in one task.
All other digests, none of which has more than one row in ``COUNTERS``, are shuffled as usual.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridledger.llm.common import id_and_text, kept

#: Counters of a summary, and so the most digests that are broadcast.
COUNTERS = 1024


def _reduce(counts: pd.Series, counters: int) -> pd.Series:
    """A summary of at most ``counters`` digests: everything loses the count of the first that has no place."""
    if len(counts) <= counters:
        return counts
    counts = counts.sort_values(ascending=False)
    counts = counts - counts.iloc[counters]
    return counts[counts > 0]


def misra_gries(counters: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        summary = pd.Series(dtype="int64")
        for batch in batches:
            if len(batch):
                summary = _reduce(summary.add(batch["digest"].value_counts(), fill_value=0).astype("int64"), counters)
        yield pd.DataFrame({"digest": summary.index.to_numpy(dtype=object), "n": summary.to_numpy(dtype="int64")})

    return run


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, among them every one with more than one row in ``counters`` + 1."""
    parts = digests.select("digest").mapInPandas(misra_gries(counters), "digest binary, n long")
    merged = parts.groupBy("digest").agg(F.sum("n").alias("n"))
    return merged.orderBy(F.desc("n"), "digest").limit(counters).select("digest")


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per row: ``doc_id``, ``keep_id`` of the row that stays, ``group_size``, ``kept``, ``text_sha256``.

    Null counts as the empty text. Of equal texts the largest id stays; a null id is smaller than any other. Among rows
    that repeat text and id exactly one is kept. Long texts enter as digests only; other columns are not read.
    """
    rows = id_and_text(df, id_col, text_col)
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    digests = kept(rows.select("doc_id", digest.alias("digest"), F.monotonically_increasing_id().alias("row")), "digests")
    best = F.max(F.struct("doc_id", "row"))
    candidates = F.broadcast(frequent(digests, counters))
    winners = kept(digests.join(candidates, "digest").groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("n")), "winners")
    heavy = digests.join(F.broadcast(winners), "digest")
    own = Window.partitionBy("digest")
    rest = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    rest = rest.select("*", best.over(own).alias("best"), F.count(F.lit(1)).over(own).alias("n"))
    return heavy.select(rest.columns).unionByName(rest).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
