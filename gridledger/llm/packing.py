"""Packing of tokenised documents into sequences: first-fit decreasing with a tournament tree, in random groups.

Every document is cut at multiples of the capacity. A hash of the piece deals all pieces into groups of about
``GROUP_DOCUMENTS`` documents; each group is packed by itself, so groups bound the memory of a task and nothing is
ordered globally. Within a group the pieces go, longest first, into the first sequence with room for them; a
tournament tree over the room left finds it in logarithmic time.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import id_and_text
from gridledger.llm.words import encoder, texts_in_parts

CAPACITY = 4096
GROUP_DOCUMENTS = 2048
END = 2

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, twin long"


def tokenised(df: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids of each document, whose ids are those of the text and then ``end``.

    A null or empty text is the end id alone. Rows that repeat an id stay separate documents. A very long text gives
    as many pieces as it needs. Other columns are not read. ``twin`` counts rows of a task that are alike from 0, so that each
    can go its own way.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, last = encoder(vocabulary), np.asarray([end], dtype="<u4").tobytes()
        seen: Counter[tuple[int | None, int]] = Counter()
        for batch in batches:
            for first, texts in texts_in_parts(batch.column(1)):
                ids = [x + last for x in tool.encode(texts)]
                docs = batch.column(0).slice(first, len(texts)).to_pylist()
                twins = []
                for key in zip(docs, map(zlib.crc32, ids)):
                    twins.append(seen[key])
                    seen[key] += 1
                rows = [(d, i, x[4 * i:4 * (i + capacity)], len(x) // 4, t) for d, x, t in zip(docs, ids, twins) for i in range(0, len(x) // 4, capacity)]
                columns = [
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([len(r[2]) // 4 for r in rows], pa.int64()), pa.array([zlib.crc32(r[2]) for r in rows], pa.int64()),
                    pa.array([r[3] for r in rows], pa.int64()), pa.array([r[4] for r in rows], pa.int64())]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "twin"]
                if with_ids:
                    offsets = np.cumsum([0] + [len(r[2]) // 4 for r in rows]).astype(np.int32)
                    flat = np.frombuffer(b"".join(r[2] for r in rows), dtype="<i4")
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return id_and_text(df, id_col, text_col).mapInArrow(run, PIECE + (", ids array<int>" if with_ids else ""))


class Rooms:
    """Room left in each sequence, as a tournament tree in which every node holds the larger of its two children."""

    def __init__(self, most: int, capacity: int):
        self.width = 1 << max(0, (most - 1).bit_length())
        self.tree = [capacity] * (2 * self.width)

    def place(self, length: int) -> tuple[int, int]:
        """First sequence with room for the piece, and the room it had."""
        tree, node = self.tree, 1
        while node < self.width:
            node *= 2
            if tree[node] < length:
                node += 1
        found, room = node - self.width, tree[node]
        tree[node] = room - length
        while node > 1:
            node //= 2
            larger = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == larger:
                break
            tree[node] = larger
        return found, room


def first_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each piece, taken longest first and among equals in the given order."""
    rooms = Rooms(len(lengths), capacity)
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        sequence[i], room = rooms.place(lengths[i])
        offset[i] = capacity - room
    return sequence, offset


def packed(pieces: DataFrame, documents: int, capacity: int = CAPACITY, group_documents: int = GROUP_DOCUMENTS, seed: int = 0) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; offsets of a sequence are gapless from 0.

    ``documents`` sets the number of groups. The group of a piece is a hash of its document, place, ids and ``twin``, so a task
    that runs again finds the same pieces, and rows that are alike spread over the groups; an empty table gives an empty result.
    """
    groups = max(1, -(-documents // group_documents))
    schema = pieces.drop("twin").schema
    out = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in schema)}, sequence_id long, offset long"

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.drop_columns("grp").sort_by([(c, "ascending") for c in ("doc_id", "start", "ids_crc32")])
        sequence, offset = first_fit_decreasing(table["length"].to_pylist(), capacity)
        sequence_id = pa.array(np.asarray(sequence, dtype=np.int64) + (np.int64(key[0].as_py()) << 32))
        return table.append_column("sequence_id", sequence_id).append_column("offset", pa.array(offset, pa.int64()))

    group = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "twin", F.lit(seed)), F.lit(groups)).alias("grp")
    return pieces.select(*schema.names, group).groupBy("grp").applyInArrow(pack, out)


def sequences(placed: DataFrame, pad: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """One row per sequence from placed pieces that carry ``ids``: the ids in order, padded unless their number is a power of two."""
    whole = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"))
    ids = F.flatten(F.col("parts.ids"))
    filled = F.size(ids)
    even = F.bit_count(filled) == 1
    padding = F.when(even, F.array().cast("array<int>")).otherwise(F.array_repeat(F.lit(pad), F.lit(capacity) - filled))
    return whole.select("sequence_id", filled.alias("filled"), F.concat(ids, padding).alias("ids"), F.col("parts.doc_id").alias("doc_ids"))


def pack_documents(df: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = False,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents to placed pieces: nulls and empty texts are the end id alone, long texts several pieces."""
    return packed(tokenised(df, vocabulary, capacity, with_ids=with_ids, id_col=id_col, text_col=text_col), df.count(), capacity)
