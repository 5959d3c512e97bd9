"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

A hash of the whole row deals the rows into blocks. How many rows each block sends to each shard is drawn from the
multivariate hypergeometric distribution, as a uniform permutation of all rows would have it; only these counts, one
number per block and shard, exist outside the rows. Each block permutes its rows and cuts them by its counts, the rows
are exchanged by shard, and each shard permutes what it received. Row order inside blocks and shards is that of hashes
with different seeds, so a task that runs again finds the same places.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridledger.llm.common import kept

#: Rows of a block at most, on average; with fewer rows there are still so many blocks, to share the work.
BLOCK_ROWS, LEAST_BLOCKS = 1_000_000, 64


def hypergeometric(rng: np.random.Generator, good: int, bad: int, taken: int) -> int:
    """How many of ``taken`` rows, drawn without replacement from ``good`` + ``bad``, are good; for populations of any size.

    The distribution is listed from ratios of neighbouring probabilities, 14 standard deviations to either side of the
    mode, beyond which a double holds nothing, and inverted.
    """
    low, high = max(0, taken - bad), min(good, taken)
    if low == high:
        return low
    share, total = good / (good + bad), good + bad
    mode = min(max((good + 1) * (taken + 1) // (total + 2), low), high)
    reach = int(14 * np.sqrt(taken * share * (1 - share) * (total - taken) / max(1, total - 1))) + 14
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    up = np.log((good - k[:-1]) * (taken - k[:-1])) - np.log((k[:-1] + 1) * (bad - taken + k[:-1] + 1))
    logs = np.concatenate([[0.0], np.cumsum(up)])
    sums = np.cumsum(np.exp(logs - logs.max()))
    return int(k[min(np.searchsorted(sums, rng.random() * sums[-1], side="right"), len(k) - 1)])


def matrix(block_rows: list[int], shard_rows: list[int], seed: int = 0) -> np.ndarray:
    """Rows that each block sends to each shard; row sums and column sums are as given."""
    rng, left = np.random.default_rng(seed), list(shard_rows)
    out = np.zeros((len(block_rows), len(shard_rows)), dtype=np.int64)
    for i, n in enumerate(block_rows):
        rest = sum(left)
        for s, room in enumerate(left):
            rest -= room
            out[i, s] = hypergeometric(rng, room, rest, n)
            n -= out[i, s]
        left = [room - int(x) for room, x in zip(left, out[i])]
    return out


def _as_table(spark, counts: np.ndarray) -> DataFrame:
    """``block, ends``: for each block its running totals by shard, from one text value."""
    ends = np.cumsum(counts, axis=1)
    text = ";".join(f"{i}:" + ",".join(map(str, row)) for i, row in enumerate(ends.tolist()))
    line = spark.range(1).select(F.explode(F.split(F.lit(text), ";")).alias("line"))
    cell = F.split("line", ":")
    return line.select(cell[0].cast("long").alias("block"), F.split(cell[1], ",").cast("array<long>").alias("ends"))


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 0, block_rows: int = BLOCK_ROWS, least_blocks: int = LEAST_BLOCKS) -> DataFrame:
    """The rows with ``shard`` (0 to ``shards`` - 1, sizes at most one apart) and ``slot`` (gapless from 0 in each shard).

    The columns given are the rows to exchange, whatever they hold: nulls are values like others. The rows are kept with a number each
    first, which goes into every hash, so repeated rows are dealt like any others. Columns named like an added one are refused. Fewer rows
    than shards leave the last shards empty.
    """
    taken = {"shard", "slot", "s_id", "s_block", "s_key", "s_rank", "s_part"} & {c.lower() for c in df.columns}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are names that the shuffle adds")
    spark, columns = df.sparkSession, df.columns
    df = kept(df.select("*", F.monotonically_increasing_id().alias("s_id")), "to-shard")
    total = df.count()
    blocks = max(least_blocks, -(-total // block_rows))

    def key(purpose: str):
        return F.xxhash64(F.lit(f"{seed} {purpose}"), "s_id", *columns)

    rows = df.select("*", F.pmod(key("block"), F.lit(blocks)).alias("s_block"), key("place").alias("s_key"))
    sizes = dict(rows.groupBy("s_block").count().collect())                    # one number per block
    by_block = [sizes.get(b, 0) for b in range(blocks)]
    by_shard = [total // shards + (s < total % shards) for s in range(shards)]
    ends = F.broadcast(_as_table(spark, matrix(by_block, by_shard, seed)).withColumnRenamed("block", "s_block"))   # blocks x shards numbers
    rank = F.row_number().over(Window.partitionBy("s_block").orderBy("s_key"))
    placed = rows.select("*", rank.alias("s_rank")).join(ends, "s_block")
    shard = F.size(F.filter("ends", lambda e: e < F.col("s_rank")))            # shards wholly before this row's rank
    placed = kept(placed.select(*columns, shard.alias("shard"), key("slot").alias("s_key")), "sharded")
    parts = max(1, -(-total // (shards * block_rows)), least_blocks // shards + 1)
    placed = placed.select("*", F.floor((F.shiftright("s_key", 32) + F.lit(1 << 31)) * F.lit(parts) / F.lit(1 << 32)).alias("s_part"))
    before = Window.partitionBy("shard").orderBy("s_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "s_part").agg(F.count(F.lit(1)).alias("n"))
    first = counts.select("shard", "s_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("s_first"))   # shards x parts rows
    slot = F.row_number().over(Window.partitionBy("shard", "s_part").orderBy("s_key")) - 1
    ranked = placed.select("*", slot.cast("long").alias("s_rank"))
    out = ranked.join(F.broadcast(first), ["shard", "s_part"])
    return out.select(*columns, F.col("shard").cast("int").alias("shard"), (F.col("s_first") + F.col("s_rank")).alias("slot"))


def write_shards(df: DataFrame, path: str, shards: int, seed: int = 0) -> None:
    """Writes the shuffled rows, one folder per shard, each in slot order within its files."""
    placed = shuffle_into_shards(df, shards, seed)
    placed.repartition("shard", F.floor(F.col("slot") / BLOCK_ROWS)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
