"""A corpus pipeline over ``documents``: language, repeated lines, near duplicates, personal data, packed sequences.

Every stage takes the rows that its predecessor kept, and all but the last return the columns of documents. Between
stages the rows are written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.llm import langid, linededup, packing, pii, simhash
from gridledger.llm.common import by_position, documents, kept
from gridledger.llm.queries import VOCABULARY

#: Less than this share of a document's trigrams in any language learned, and it is rejected.
LEAST_LANGUAGE_SHARE = 0.5

#: Five-word shingles and a similarity of 0.8, checked on the texts. Fingerprints of 256 bits differ in 39 on average, give or
#: take 6, at that similarity; 52 lets 99 in 100 such pairs through. As many have a block with at most one bit different.
#: Texts of at most 32 distinct shingles, whose bits spread more, are found exactly.
NEAR = simhash.Scheme(shingle=5, bits=256, budget=52, blocks=16, slack=1)
LEAST_SIMILARITY = 0.8


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a stage that changes texts; of a null text as it was."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of a language that the labelled ones show; those without a letter or a text go.

    Without any labelled document there is no language to be missed, and all stay. Rows that repeat an id or a text are judged each
    for itself, a null id like any other; an empty table stays empty.
    """
    filters = langid.learn(docs)
    if not filters.languages:
        return docs
    plain, names = by_position(docs)
    found = langid.predicted(plain, filters, names["text"], ("lang_pred", "score"))
    return found.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SHARE)).select(*plain.columns).toDF(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines in later occurrences of three-line windows; a document that loses all its lines stays, empty."""
    clean = linededup.dedup_lines(docs)
    return _with_length(clean.toDF(*[f"c{i}" for i in range(len(clean.columns))]).select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near duplicates the document with the smallest id.

    Of rows with that id and one text it keeps the one whose columns have the smallest hash. Null and empty texts are one group, a
    null id comes first; an empty table stays empty.
    """
    stays = simhash.near_groups(docs, NEAR, similarity=LEAST_SIMILARITY).where("first").select("k1", "k2")
    plain, names = by_position(docs)
    key = simhash.row_key(F.col(names["doc_id"]).cast("long"), F.col(names["text"]).cast("string"))
    keyed = plain.select("*", *key, F.xxhash64(*[F.col(c) for c in plain.columns]).alias("own"))
    chosen = keyed.groupBy("k1", "k2").agg(F.min("own").alias("own")).join(stays, ["k1", "k2"], "left_semi")
    return keyed.join(chosen, ["k1", "k2", "own"], "left_semi").dropDuplicates(["k1", "k2"]).select(*plain.columns).toDF(*docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the name of its kind; null texts stay null, every row stays, whatever its id."""
    return _with_length(pii.redacted(docs, pii.learn(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents with their places in sequences; a null or empty text is the end id, equal rows are packed each."""
    return packing.pack_documents(docs, VOCABULARY)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("pii", redact), ("packing", pack)]

#: Models and tokenizers have no SQL counterpart; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
