"""Joins that stay balanced when a key has many rows on both sides.

Adaptive execution splits a partition that is large on one side, whichever side that is. What it cannot see is a key whose
rows are few enough on each side but whose pairs are many. So the rows of such a key on the right are dealt into chunks, and its rows
on the left are repeated for each chunk: a row on the left then meets a chunk at most, and a key with many pairs must have many rows on
the left, which adaptive execution does see. The repeated rows are as many as the pairs divided by the size of a chunk.

The rows of a key are counted as part of the plan, in a frame that the caller names, often a column of a base table; nothing runs while
the plan is built. The list of keys is broadcast, and has at most ``MOST_KEYS`` of them whatever the data: a key that is not
among so many has less than that share of the rows on the right.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_ROWS = 512        # rows of one key on the right that a row on the left meets in one task
MOST_KEYS = 4096        # keys that are dealt into chunks
SHARES = 4              # tasks of a shuffle of lists for each partition of the session: a row stands for a list


def large_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys with more than ``CHUNK_ROWS`` rows, at most ``MOST_KEYS``, and into how many chunks to deal their rows."""
    counted = rows.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > CHUNK_ROWS)
    chosen = counted.orderBy(F.desc("_rows"), *keys).limit(MOST_KEYS)
    return chosen.select(*keys, F.ceil(F.col("_rows") / CHUNK_ROWS).cast("int").alias("_chunks"))


def skew_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", *, right_keys: DataFrame | None = None) -> DataFrame:
    """Equi-join on same-named ``keys`` that deals keys with many rows on the right into chunks.

    ``right_keys`` has the key columns, or some of them, with about as many rows of each key as the right side; an inner join that
    names it is dealt, any other is left to adaptive execution. The chunk of a row is a hash of the whole row, so a task that is
    run again puts every row where it was before; exact copies share their chunk.
    """
    keys = list(keys)
    if how != "inner" or right_keys is None:
        return left.join(right, keys, how)
    known = [k for k in keys if k in right_keys.columns]
    large = F.broadcast(large_keys(right_keys, known))
    chunks = F.coalesce("_chunks", F.lit(1))
    row = F.xxhash64(*[F.col(f"`{c}`") for c in right.columns])
    chunk = F.when(F.col("_chunks").isNotNull(), F.pmod(row, chunks)).otherwise(0).cast("int").alias("_chunk")
    dealt = right.join(large, known, "left").select(*[F.col(f"`{c}`") for c in right.columns], chunk)
    repeated = left.join(large, known, "left").select(*[F.col(f"`{c}`") for c in left.columns], F.explode(F.sequence(F.lit(0), chunks - 1)).alias("_chunk"))
    return repeated.join(dealt, [*keys, "_chunk"]).drop("_chunk")


def _large_on_walk(rows: DataFrame, key: str, name: str) -> DataFrame:
    """As ``large_keys`` of rows that another branch of the plan reads too, with the number of chunks as ``name``.

    No null is filtered and no column is left out before the count, so that both branches have one plan below, which runs once.
    """
    row = F.max(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])).alias("_row")
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), row).where(F.col("_rows") > CHUNK_ROWS)
    chosen = counted.orderBy(F.desc("_rows"), key, "_row").limit(MOST_KEYS)
    return chosen.select(key, F.ceil(F.col("_rows") / CHUNK_ROWS).cast("int").alias(name))


def list_join(left: DataFrame, right: DataFrame, keys: Sequence[str], owner: str, member: str, *, right_keys: DataFrame | None = None,
              by_range: Sequence[str] = ()) -> DataFrame:
    """Inner equi-join whose pairs come dealt by ``owner`` of the left and, as far as that has many rows, by ``member`` of the right.

    The rows of a key on the right travel as a list to each row on the left, and are unfolded only where the owner's rows have met:
    a row is shuffled, not every pair. What then groups by owner, ``_share`` and ``member`` needs no shuffle. ``_share`` follows from
    owner and member, so as one more key it changes no group; it is -1 where all rows of an owner are together. Lists are bounded as the chunks of ``skew_join``; an owner with many rows has
    its lists parted by member. Without the ``keys`` that are not asked for by ``owner`` the rows hold the columns of both sides.
    With ``by_range``, columns of the left, rows are dealt by ranges of those first, then of owner and ``_share``.
    Without ``right_keys`` the rows of the first key are counted on the walk that the lists come from.
    """
    keys = list(keys)
    known = keys[:1] if right_keys is None else [k for k in keys if k in right_keys.columns]
    # the condition that the join itself asks for, so that it is the same for all readers of the left
    have_keys = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    left, right = left.where(have_keys), right.where(have_keys)
    values = [c for c in right.columns if c not in keys]
    large = F.broadcast(_large_on_walk(right, known[0], "_chunks") if right_keys is None else large_keys(right_keys, known))
    chunks = F.coalesce("_chunks", F.lit(1))
    chunk = F.when(F.col("_chunks").isNotNull(), F.pmod(F.xxhash64(*right.columns), chunks)).otherwise(0).cast("int").alias("_chunk")
    lists = right.join(large, known, "left").select(*right.columns, chunk).groupBy(*keys, "_chunk").agg(
        F.collect_list(F.struct(*values)).alias("_list"))
    repeated = left.join(large, known, "left").select(*left.columns, F.explode(F.sequence(F.lit(0), chunks - 1)).alias("_chunk"))
    hot = F.broadcast(_large_on_walk(left, owner, "_parts"))
    met = repeated.join(lists, [*keys, "_chunk"]).join(hot, [owner], "left")
    part = lambda e: F.pmod(F.xxhash64(e[member]), F.col("_parts")).cast("int")
    shares = F.when(F.col("_parts").isNull(), F.array(F.lit(-1))).otherwise(F.array_distinct(F.transform("_list", part)))
    dealt = met.select(*left.columns, "_list", "_parts", F.explode(shares).alias("_share"))
    own = F.when(F.col("_parts").isNull(), F.col("_list")).otherwise(F.filter("_list", lambda e: part(e) == F.col("_share")))
    tasks = SHARES * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = [c for c in left.columns if c not in known]
    rows = dealt.select(*kept, "_share", own.alias("_list"))
    rows = rows.repartitionByRange(tasks, *by_range, owner, "_share") if by_range else rows.repartition(tasks, owner, "_share")
    return rows.select(*kept, "_share", F.explode("_list").alias("_e")).select(*kept, "_share", *[F.col(f"_e.{c}").alias(c) for c in values])


def string_set(col: Column | str, sep: str = ",") -> Column:
    """Sorted distinct texts of a group as one string.  Only for values out of a small closed vocabulary."""
    return F.array_join(F.sort_array(F.collect_set(col)), sep)
