"""Language identification with bit-sliced Bloom filters over letter trigrams.

One filter holds all languages: each slot is a bit mask of languages, and the masks at the slots of a trigram, ANDed, name
every language that contains it, plus a few false ones. A document is scored by the number of its trigrams that each
language contains, corrected for that language's rate of false positives; the largest corrected share decides.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.llm.words import texts_in_parts

#: Rows that the filters are learned from, in expectation: a bound on the labelled sample, drawn by a hash of the row.
SAMPLE_ROWS = 20_000
#: A language contains a trigram that it shows at least so often and at no less than this share of the largest rate of any.
LEAST_COUNT, LEAST_SHARE = 3, 0.2
HASHES, SLOTS_PER_GRAM = 3, 16
LEAST_SLOTS_PER_GRAM, ROOMY_SLOTS = 4, 1 << 24
SLICE = 500_000
UNDETERMINED = "und"

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _pieces(text: str) -> Iterator[str]:
    """The text in slices, each with the character before and after it (a space at the ends)."""
    text = f" {text.lower()} "
    for i in range(1, len(text) - 1, SLICE):
        yield text[i - 1:min(i + SLICE, len(text) - 1) + 1]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams around every letter (other characters count as a space), as 63-bit numbers, and the text each is in."""
    parts = [(k, p) for k, t in enumerate(texts) for p in _pieces(t)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sizes = np.array([len(p) for _, p in parts])
    code = np.frombuffer("".join(p for _, p in parts).encode("utf-32-le"), dtype="<u4")
    letter = _letters()[code]
    code = np.where(letter, code, 32).astype(np.uint64)
    ends = np.cumsum(sizes)
    centre = letter
    centre[ends - 1] = False
    centre[ends - sizes] = False
    at = np.flatnonzero(centre)
    grams = code[at - 1] | code[at] << np.uint64(21) | code[at + 1] << np.uint64(42)
    return grams, np.repeat(np.array([k for k, _ in parts]), sizes)[at]


@dataclass
class Filters:
    """Bit-sliced Bloom filters: bit l of a slot's mask belongs to ``languages[l]``; 64 languages to a plane."""

    languages: list[str]
    planes: list[np.ndarray]
    false_rate: np.ndarray

    def _slots(self, grams: np.ndarray) -> list[np.ndarray]:
        size = len(self.planes[0])
        shift, mixed = np.uint64(min(40, 65 - size.bit_length())), grams ^ grams >> np.uint64(29)
        return [(mixed * m >> shift) & np.uint64(size - 1) for m in _MULTIPLIERS[:HASHES]]

    @classmethod
    def build(cls, languages: list[str], grams: np.ndarray, which: np.ndarray) -> Filters:
        n = max(1, len(np.unique(grams)))
        # many trigrams share fewer slots, down to a few each: more false hits, for which the shares are corrected
        wanted = max(min(SLOTS_PER_GRAM * n, ROOMY_SLOTS), LEAST_SLOTS_PER_GRAM * n)
        size = 1 << max(10, int(np.ceil(np.log2(wanted))))
        planes = [np.zeros(size, dtype=np.uint64) for _ in range(-(-len(languages) // 64) or 1)]
        made = cls(languages, planes, np.zeros(len(languages)))
        for slots in made._slots(grams):
            for p, plane in enumerate(planes):
                own = which // 64 == p
                np.bitwise_or.at(plane, slots[own], np.uint64(1) << (which[own] % 64).astype(np.uint64))
        fill = [np.mean(planes[i // 64] >> np.uint64(i % 64) & np.uint64(1)) for i in range(len(languages))]
        made.false_rate = np.array(fill) ** HASHES
        return made

    def shares(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each text the corrected share of its trigrams in each language, and its number of trigrams."""
        grams, owner = trigrams(texts)
        slots = self._slots(grams)
        total = np.bincount(owner, minlength=len(texts))
        hits = np.zeros((len(texts), len(self.languages)))
        for p, plane in enumerate(self.planes):
            mask = functools.reduce(np.bitwise_and, (plane[s] for s in slots))
            for i in range(64 * p, min(64 * p + 64, len(self.languages))):
                hits[:, i] = np.bincount(owner, weights=(mask >> np.uint64(i % 64) & np.uint64(1)), minlength=len(texts))
        n = np.maximum(total, 1)[:, None]
        return np.clip((hits / n - self.false_rate) / (1 - np.minimum(self.false_rate, 0.999)), 0, 1), total


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        for first, texts in texts_in_parts(batch.column(1), SLICE):
            grams, owner = trigrams(texts)
            own = langs[first:first + len(texts)]
            for lang in set(own):
                found, n = np.unique(grams[(own == lang)[owner]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])


def even_quota(have: list[int], total: int) -> float:
    """The most rows of one language, so that all of them have about ``total``; languages with fewer give all they have."""
    left = total
    for i, n in enumerate(sorted(have)):
        if n * (len(have) - i) > left:
            return left / (len(have) - i)
        left -= n
    return max(have, default=0)


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Filters:
    """Filters from a hash sample of the rows with a language and a text; about ``sample_rows`` of them, or all if fewer.

    Each language has the same number of rows in it, or all it has, so what is learned of one does not depend on the others.
    """
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id")).where("lang IS NOT NULL AND text IS NOT NULL")
    have = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = even_quota(list(have.values()), sample_rows)
    below = [(lang, (1 << 30) if n <= most else int(most / n * (1 << 30))) for lang, n in have.items()]
    drawn_below = F.broadcast(labelled.sparkSession.createDataFrame(below, "lang string, below long"))
    drawn = rows.join(drawn_below, "lang").where(F.pmod(F.xxhash64(F.lit("fit"), "id"), F.lit(1 << 30)) < F.col("below"))
    counts = drawn.select("lang", "text").mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") >= LEAST_COUNT).toPandas()                               # bounded by the sample
    languages = sorted(found["lang"].unique())
    if not languages:
        return Filters.build([], np.zeros(0, np.uint64), np.zeros(0, np.int64))
    rate = found["n"] / found.groupby("lang")["n"].transform("sum")
    chosen = found[rate >= LEAST_SHARE * rate.groupby(found["gram"]).transform("max")]
    which = chosen["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(dtype=np.int64)
    return Filters.build(languages, chosen["gram"].to_numpy(dtype=np.int64).astype(np.uint64), which)


def predicted(df: DataFrame, filters: Filters, text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score"), carry: list[str] | None = None) -> DataFrame:
    """The rows with the language and its corrected share of trigrams, 0 to 1.

    A null text, one without a letter, and every text if no language was learned, is ``und`` with score 0. Equal shares
    go to the first language by name. Long texts are read in slices. The columns to ``carry`` along are all by default.
    """
    spark, columns = df.sparkSession, list(df.columns if carry is None else carry)
    held = spark.sparkContext.broadcast(filters)                                             # its size follows the bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            langs, scores = [], []
            for _, texts in texts_in_parts(batch.column(len(columns)), SLICE):
                shares, total = model.shares(texts)
                if model.languages:
                    best = shares.argmax(axis=1)
                    langs += [model.languages[b] if n else UNDETERMINED for b, n in zip(best, total)]
                    scores += [float(s) if n else 0.0 for s, n in zip(shares.max(axis=1), total)]
                else:
                    langs += [UNDETERMINED] * len(texts)
                    scores += [0.0] * len(texts)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [f"c{i}" for i in range(len(columns) + 2)])

    plain = df.select(*columns, df[text_col].cast("string")).toDF(*[f"c{i}" for i in range(len(columns))], "text")
    schema = plain.select(*plain.columns[:-1], F.lit("").alias(f"c{len(columns)}"), F.lit(0.0).alias(f"c{len(columns) + 1}")).schema
    return plain.mapInArrow(run, schema).toDF(*columns, *names)


def held_out(id_col: str = "doc_id") -> Column:
    """True for the third of the ids that nothing is learned from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1
