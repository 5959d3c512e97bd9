"""Token ids in Parquet: one row per document with its ids as a list, in ascending document order.

Ranges of document ids are dealt to tasks and sorted there; a task tokenises its documents in order and numbers their
ids from 0, and Spark's own Parquet writer commits the files. Ids are dictionary-encoded
(or written as deltas with ``encoding="delta"``), row groups and pages have set sizes, and column and offset indexes are
written, so that a reader of a few documents or of the lengths alone skips nearly everything. A side table
with one row per range holds where each range begins among all ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridledger.llm.common import id_and_text
from gridledger.llm.words import encoder, texts_in_parts

END = 2
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 16 << 20, 256 << 10, 1000


def write_tokens(df: DataFrame, path: str, vocabulary: str, end: int = END, encoding: str = "dictionary", id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes ``path``/ids (``doc_id, part, local_start, n_tokens, ids``) and ``path``/parts (``part, first``).

    A null or empty text is the end id alone. Null ids come first; rows that repeat an id are ordered by their text's
    hash. The number of ranges is the session's number of shuffle partitions. Other columns are not written.
    """
    spark = df.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, last, so_far = encoder(vocabulary), np.asarray([end], dtype="<u4").tobytes(), 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for first, texts in texts_in_parts(batch.column(1)):
                ids = [x + last for x in tool.encode(texts)]
                sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(np.full(len(ids), part, dtype=np.int32)), pa.array(so_far + offsets[:-1]), pa.array(sizes.astype(np.int32)), lists],
                    ["doc_id", "part", "local_start", "n_tokens", "ids"])
                so_far += int(offsets[-1])

    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = id_and_text(df, id_col, text_col).repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    tokens = rows.mapInArrow(run, "doc_id long, part int, local_start long, n_tokens int, ids array<int>")
    writer = tokens.write.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES).option("parquet.page.row.count.limit", PAGE_ROWS)
    if encoding == "delta":
        writer = writer.option("parquet.writer.version", "v2").option("parquet.enable.dictionary", "false")
    writer.parquet(f"{path}/ids")
    sizes = spark.read.parquet(f"{path}/ids").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)             # one row per range
    sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")).coalesce(1).write.parquet(f"{path}/parts")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` from the files; selecting a few columns or filtering ids reads only those pages."""
    ids, parts = spark.read.parquet(f"{path}/ids"), spark.read.parquet(f"{path}/parts")
    return ids.join(F.broadcast(parts), "part").select("doc_id", (F.col("first") + F.col("local_start")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of rows of ``read_tokens``; the sum is over little-endian unsigned 32-bit ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            ends, values = lists.offsets.to_numpy(), np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<u4")
            crc = [zlib.crc32(values[a:b].data) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
