"""Importance resampling towards a target: documents are drawn by how much likelier their hashed n-grams are in the target.

Newlines cut texts into lines. A line that occurs often is counted once: its features, all runs of one to three words, are
hashed to buckets when the line first appears among the distinct ones, and its counts are multiplied by its occurrences. Runs that
cross a newline belong to their document and are kept beside its list of lines. Totals, and later weights, are
sums over both.

Words are found and hashed for many lines at once with numpy. The checksum of a run follows from those of its words, because
appending a word of n bytes is a linear step on the checksum before it.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridledger.llm.common import documents, id_and_text, join_counted, kept

BUCKETS, LONGEST_RUN, LEAST_WORDS, DRAWN_PERCENT, SEED = 10_000, 3, 20, 5, 42
SLICE_BYTES = 2 << 20
_SHORT = 64

_POLYNOMIAL = np.uint32(0xEDB88320)
_SPACE = 0x20
_IS_WORD = np.isin(np.arange(256), [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])


def _steps() -> np.ndarray:
    """The checksum's table of one byte."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, c >> 1 ^ _POLYNOMIAL, c >> 1)
    return c


def _shifts(longest: int) -> np.ndarray:
    """For each length up to ``longest`` and each byte of a checksum, what that byte becomes when so many bytes follow."""
    now = (np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]).ravel()
    out = [now]
    for _ in range(longest):
        now = _STEP[now & 0xFF] ^ now >> 8
        out.append(now)
    return np.concatenate(out)


_STEP = _steps()
_SHIFT = _shifts(_SHORT)


def _appended(crc: np.ndarray, following: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums of texts, each with a following one of known checksum and of at most 64 bytes."""
    at = lengths.astype(np.int32) * 1024
    for k in range(4):
        following = following ^ _SHIFT[at + (k * 256) + (crc >> np.uint32(8 * k) & 0xFF)]
    return following


def _spaced(crc: np.ndarray) -> np.ndarray:
    """Checksums with a space appended."""
    c = ~crc
    return ~(_STEP[(c ^ _SPACE) & 0xFF] ^ c >> 8)


class Words:
    """The words of a slice of texts, in order, and checksums of runs of them."""

    def __init__(self, joined: bytes):
        self.data = np.frombuffer(joined.lower(), dtype=np.uint8)              # bytes.lower() changes A-Z only
        edges = np.diff(np.concatenate([[0], _IS_WORD[self.data].view(np.int8), [0]]))
        self.starts = np.flatnonzero(edges == 1)
        self.lengths = np.flatnonzero(edges == -1) - self.starts

    def checksums(self, chosen: np.ndarray) -> np.ndarray:
        """Of single words."""
        sizes = np.minimum(self.lengths[chosen], _SHORT + 1).astype(np.uint8)
        order = np.argsort(sizes, kind="stable")[::-1]
        starts, sizes = self.starts[chosen][order], sizes[order]
        crc = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
        more = np.searchsorted(-sizes.astype(np.int16), -np.arange(_SHORT), side="left")       # words longer than 0, 1, …
        for k, m in enumerate(more):
            if not m:
                break
            c = crc[:m]
            crc[:m] = _STEP[(c ^ self.data[starts[:m] + k]) & 0xFF] ^ c >> 8
        out = np.empty_like(crc)
        out[order] = ~crc
        for i in np.flatnonzero(self.lengths[chosen] > _SHORT):
            out[i] = zlib.crc32(self._word(chosen[i]))
        return out

    def _word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.starts[i] + self.lengths[i]].tobytes()

    def runs(self, ends: np.ndarray, crc: np.ndarray, size: int) -> np.ndarray:
        """Of the runs of ``size`` words from each word in ``ends`` back; ``crc`` has the checksum of each word."""
        out = crc[ends - (size - 1)]
        for back in range(size - 2, -1, -1):
            i = ends - back
            out = _appended(_spaced(out), crc[i], np.minimum(self.lengths[i], _SHORT))
        long = self.lengths[ends] > _SHORT
        for back in range(1, size - 1):
            long |= self.lengths[ends - back] > _SHORT
        for j in np.flatnonzero(long):
            out[j] = zlib.crc32(b" ".join(self._word(i) for i in range(ends[j] - size + 1, ends[j] + 1)))
        return out


def _slices(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts as bytes, (first row, texts), in slices of bounded size unless one text is longer."""
    part, first, size = [], 0, 0
    for i, text in enumerate(column.cast(pa.binary())):
        data = text.as_py() or b""
        if part and size + len(data) > SLICE_BYTES:
            yield first, part
            part, first, size = [], i, 0
        part.append(data)
        size += len(data)
    if part:
        yield first, part


def _planes(buckets: np.ndarray, owner: np.ndarray, owners: int) -> tuple[np.ndarray, list[pa.Array]]:
    """How many features each owner has, and its bucket numbers as two columns of bytes, low and high, which compress apart."""
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=owners)
    offsets = pa.py_buffer(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    sorted_buckets = buckets[order].astype(np.uint16)
    return counts, [pa.Array.from_buffers(pa.binary(), owners, [None, offsets, pa.py_buffer(np.ascontiguousarray(b))])
                    for b in ((sorted_buckets & 0xFF).astype(np.uint8), (sorted_buckets >> 8).astype(np.uint8))]


def _inside(buckets: int, longest: int):
    """Distinct lines: the digest of each with a word, how often it occurs, and the buckets of its features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, lines in _slices(batch.column(0)):
                words = Words(b"\n".join(lines))
                bounds = np.cumsum([len(x) + 1 for x in lines])
                line = np.searchsorted(bounds, words.starts, side="right")
                crc = words.checksums(np.arange(len(line)))
                found, owner = [crc], [line]
                for size in range(2, longest + 1):
                    ends = np.flatnonzero(line[size - 1:] == line[:len(line) - size + 1]) + size - 1
                    found.append(words.runs(ends, crc, size))
                    owner.append(line[ends])
                counts, planes = _planes(np.concatenate(found) % buckets, np.concatenate(owner), len(lines))
                some = np.flatnonzero(counts)
                digests = pa.array([xxhash.xxh3_128_digest(lines[i]) for i in some], pa.binary())
                n = batch.column(1).slice(first, len(lines)).take(pa.array(some))
                yield pa.RecordBatch.from_arrays([digests, n, *(p.take(pa.array(some)) for p in planes)], ["line", "n", "low", "high"])

    return run


def _across(buckets: int, longest: int):
    """Documents: number of words, the digests of their lines, and the buckets of features that cross a newline."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _slices(batch.column(2)):
                joined = b"\n".join(texts)
                words = Words(joined)
                doc = np.searchsorted(np.cumsum([len(x) + 1 for x in texts]), words.starts, side="right")
                breaks = np.flatnonzero(words.data == 10)
                line = np.searchsorted(breaks, words.starts)
                ends = [np.flatnonzero((line[s - 1:] != line[:len(line) - s + 1]) & (doc[s - 1:] == doc[:len(doc) - s + 1])) + s - 1 for s in range(2, longest + 1)]
                needed = np.zeros(len(line), dtype=bool)
                for size, e in enumerate(ends, 2):
                    for back in range(size):
                        needed[e - back] = True
                crc = np.zeros(len(line), dtype=np.uint32)
                chosen = np.flatnonzero(needed)
                crc[chosen] = words.checksums(chosen)
                found = [words.runs(e, crc, size) for size, e in enumerate(ends, 2)]
                owner = [doc[e] for e in ends]
                _, planes = _planes(np.concatenate([*found, crc[:0]]) % buckets, np.concatenate([*owner, doc[:0]]), len(texts))
                with_words, at = np.unique(line, return_index=True)
                starts = np.concatenate([[0], breaks + 1])[with_words]
                stops = np.concatenate([breaks, [len(joined)]])[with_words]
                digests = pa.array([xxhash.xxh3_128_digest(joined[a:b]) for a, b in zip(starts, stops)], pa.binary())
                per_doc = np.concatenate([[0], np.cumsum(np.bincount(doc[at], minlength=len(texts)))]).astype(np.int32)
                n_words = pa.array(np.bincount(doc, minlength=len(texts)).astype(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)), n_words,
                                                  pa.ListArray.from_arrays(pa.array(per_doc), digests), *planes], ["row", "doc_id", "n_words", "lines", "low", "high"])

    return run


def _features(low: pa.Array, high: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers out of two columns of bytes, and where each row's begin and end."""
    ends = np.frombuffer(low.buffers()[1], dtype=np.int32)[low.offset:low.offset + len(low) + 1].astype(np.int64)
    high_ends = np.frombuffer(high.buffers()[1], dtype=np.int32)[high.offset:high.offset + len(high) + 1]

    def part(column, a, b):
        data = column.buffers()[2]
        return np.frombuffer(data, dtype=np.uint8)[a:b] if data is not None else np.empty(0, dtype=np.uint8)

    values = part(low, ends[0], ends[-1]).astype(np.uint16) | part(high, high_ends[0], high_ends[-1]).astype(np.uint16) << 8
    return values, ends - ends[0]


def _totals(buckets: int):
    """Occurrences by bucket; a row's features count ``n`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                values, ends = _features(batch.column(1), batch.column(2))
                times = np.repeat(batch.column(0).to_numpy(), np.diff(ends))
                total += np.bincount(values, weights=times, minlength=buckets).astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "s"])

    return run


def _weights(gains: np.ndarray, carried: list[str]):
    """The sum of gains of each row's features, after the carried columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values, ends = _features(batch.column(len(carried)), batch.column(len(carried) + 1))
                sums = np.concatenate([[0], np.cumsum(gains[values])])
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(carried)], pa.array(sums[ends[1:]] - sums[ends[:-1]])], [*carried, "w"])

    return run


class Counted:
    """The distinct lines of a collection and its documents, with the buckets of their features, in kept tables."""

    def __init__(self, df: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS, longest: int = LONGEST_RUN):
        rows = id_and_text(df, id_col, text_col)
        line = F.explode(F.split("text", "\n", -1)).alias("line")
        distinct = rows.select(line).where("line <> ''").groupBy("line").agg(F.count(F.lit(1)).alias("n"))
        self.lines = kept(distinct.mapInArrow(_inside(buckets, longest), "line binary, n long, low binary, high binary"), "lines", compression="zstd")
        numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
        schema = "row long, doc_id long, n_words long, lines array<binary>, low binary, high binary"
        self.documents = kept(numbered.mapInArrow(_across(buckets, longest), schema), "documents", compression="zstd")
        self.buckets = buckets

    def totals(self) -> np.ndarray:
        """Features by bucket, every occurrence counted: one number per bucket, whatever the collection."""
        both = self.lines.select("n", "low", "high").unionByName(self.documents.select(F.lit(1).cast("long").alias("n"), "low", "high"))
        sums = both.mapInArrow(_totals(self.buckets), "bucket int, s long").groupBy("bucket").agg(F.sum("s").alias("s")).collect()
        out = np.zeros(self.buckets, dtype=np.int64)
        for r in sums:
            out[r.bucket] = r.s
        return out

    def weighed(self, gains: np.ndarray) -> DataFrame:
        """``row, doc_id, n_words, weight`` of every document."""
        lines = kept(self.lines.select("line", "n", "low", "high").mapInArrow(_weights(gains, ["line", "n"]), "line binary, n long, w long"), "line-weights")
        own = ["row", "doc_id", "n_words"]
        crossing = self.documents.select(*own, "low", "high").mapInArrow(_weights(gains, own), "row long, doc_id long, n_words long, w long")
        inside = join_counted(self.documents.select(*own, F.explode("lines").alias("line")), lines, ["line"]).select(*own, "w")
        return crossing.unionByName(inside).groupBy(*own).agg(F.sum("w").alias("weight"))


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier each bucket is in the target, rounded down; one is added to every count."""
    all_source, all_target, n = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (all_source + n) / ((float(s) + 1) * (all_target + n)))) for s, t in zip(source, target)], dtype=np.int64)


def importance(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", percent: int = DRAWN_PERCENT,
               least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_features, weight, score, rank``; the drawn ones are ranked 1, 2, 3 …

    A score is the weight plus a Gumbel number that the seed and the id decide, so the highest scores are a draw without replacement by
    weight. Drawn are ``percent`` in 100, rounded down, of the documents with at least ``least_words`` words. Equal scores go to
    the smaller id, a null id last; rows that repeat an id and a score are ranked one after the other, in any order. A null text is
    empty; a text without words has weight 0. The id of a null is empty where it is hashed. An empty table gives no rows, an empty target
    no features. Other columns are not read. ``buckets`` bounds what the driver and every task hold; at most 65,536.
    """
    found = Counted(df, id_col, text_col, buckets, longest)
    goal = Counted(target.select(F.lit(0).alias("doc_id"), target[target_text].alias("text")), "doc_id", "text", buckets, longest)
    weighed = found.weighed(bucket_gains(found.totals(), goal.totals()))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    runs = sum((F.greatest(F.col("n_words") - i, F.lit(0)) for i in range(1, longest)), F.col("n_words"))
    scored = kept(weighed.select("row", "doc_id", "n_words", runs.cast("long").alias("n_features"), "weight", (F.col("weight") + noise).alias("score")), "scores")
    able = scored.where(F.col("n_words") >= least_words)
    drawn = percent * able.count() // 100
    ranked = ranks(able.select("doc_id", "n_features", "weight", "score", "row"), [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")])
    place = F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, place).unionByName(rest.select(*columns, "rank"))


def ranks(df: DataFrame, order: list) -> DataFrame:
    """The rows with their ``rank`` by a total order, from 1: sorted in ranges, numbered within each, and moved on by the rows before it."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, so_far = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, dtype=np.int32)), pa.array(np.arange(so_far + 1, so_far + n + 1))], [*names, "part", "at"])
            so_far += n

    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    placed = kept(df.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(run, f"{kinds}, part int, at long"), "ranked")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)                  # one row per range
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    first = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return placed.join(F.broadcast(first), "part").select(*names, (F.col("at") + F.col("first")).alias("rank"))


def resampled(df: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``df`` with all their columns; of rows that repeat an id, all if one is drawn. A null id is never drawn here."""
    drawn = importance(df, target, id_col, **options).where("rank IS NOT NULL").select(F.col("doc_id").alias("_drawn")).distinct()
    return df.join(drawn, df[id_col].cast("long") == F.col("_drawn"), "left_semi")


def towards_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its weight and score towards the benchmark's texts, and the rank of the drawn ones."""
    return importance(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
