"""Importance resampling against a plain version that reads every text on its own."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridledger.llm import resampling as R
from gridledger.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def plain(docs, targets):
    """Rows ``(doc_id, n_features, weight, score, rank)`` of ``(doc_id, text)`` pairs."""
    found = [(i, *features(t)) for i, t in docs]
    s, t = Counter(bucket(f) for _, _, fs in found for f in fs), Counter(bucket(f) for x in targets for f in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (all_s + 10_000.0) / ((s[b] + 1.0) * (all_t + 10_000.0)))) for b in range(10_000)]
    rows = []
    for i, words, fs in found:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in fs)
        rows.append((i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return sorted(([*r[:4], None] for r in rows if r[4] < 20), key=str), [[*r[:4], k if k <= 5 * len(able) // 100 else None] for k, r in enumerate(able, 1)]


def compare(df, docs, targets):
    short, able = plain(docs, targets)
    found = [list(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()]
    assert sorted(found, key=str) == sorted(short + able, key=str)


def test_the_query_agrees_with_a_plain_version(spark):
    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    targets = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    compare(QUERIES["op11_resampling"](spark, folder), docs, targets)


@pytest.mark.parametrize("seed", range(3))
def test_checksums_of_runs(seed):
    draw = random.Random(seed)
    words = ["".join(draw.choices("abz09é日😀", k=draw.choice([1, 2, 5, 12, 15, 16, 17, 30, 63, 64, 65, 200]))) for _ in range(400)]
    found = R.Words("".join(w + draw.choice([" ", "\n", "--", "@`{\x7f/:"]) for w in words).encode())
    crc = found.checksums(np.arange(len(words)))
    assert crc.tolist() == [zlib.crc32(w.encode()) for w in words]
    for size in (2, 3, 4):
        ends = np.arange(size - 1, len(words))
        assert found.runs(ends, crc, size).tolist() == [zlib.crc32(" ".join(words[e - size + 1:e + 1]).encode()) for e in ends]


HARD = [(5, None), (7, ""), (None, "no id here at all"), (None, None), (8, " \n\t "), (9, "one\ntwo\n\nthree\r\nfour five\n\n six"), (10, "one two\nthree\nfour\nfive"), (11, "A\nb\nC\nd"),
        (11, "A\nb\nC\nd"), (12, "été 日本 😀 ÉTÉ\nÉ"), (13, "word " * 30_000), (14, "y" * 50_000 + "\n" + "z" * 70 + " a b " + "q" * 65), (15, "\n" * 1000 + "end"),
        (-3, "[]^_`{|}~ @ / : 0 9"), (16, "same line here\n" * 500)] + [(100 + i, "same line here\n" * 8 + f"and number {i % 7} of them\nK" + "k " * (i % 5)) for i in range(90)]


def test_difficult_texts(spark, tmp_path):
    df = spark.createDataFrame(HARD, "doc_id long, text string").repartition(3)
    for name in ("row", "line", "n", "low", "high", "w", "score", "part", "at", "h", "n_words"):
        df = df.withColumn(name, F.lit(f"extra {name}"))
    goal = ["Same LINE\nhere", None, "", "and number 3 of", "number 3 of"]
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(t, i) for i, t in enumerate(goal)], "text string, item_id long").write.parquet(f"{tmp_path}/benchmark.parquet")
    compare(QUERIES["op11_resampling"](spark, str(tmp_path)), HARD, goal)


def test_frequent_lines_are_met_by_broadcast_or_not(spark, monkeypatch):
    from gridledger.llm import common
    df = spark.createDataFrame(HARD, "doc_id long, text string")
    for share in (1, 10 ** 9):
        monkeypatch.setattr(common, "HOT_ONE_IN", share)
        compare(R.importance(df, df), HARD, [t for _, t in HARD])


def test_lines_are_hashed_once(spark):
    found = R.Counted(spark.createDataFrame(HARD, "doc_id long, text string"), "doc_id", "text")
    lines = found.lines.collect()
    assert len({bytes(r.line) for r in lines}) == len(lines)
    assert max(r.n for r in lines) == 500 + 8 * 90
    assert found.totals().sum() == sum(len(features(t)[1]) for _, t in HARD)


def test_ranks_of_many_equal_rows(spark):
    df = spark.range(10_000).select((F.col("id") % 3).alias("score"), "id")
    found = R.ranks(df, [F.desc("score"), F.asc("id")]).orderBy("rank").collect()
    assert [r["rank"] for r in found] == list(range(1, 10_001))
    assert [(r.score, r.id) for r in found] == sorted(((i % 3, i) for i in range(10_000)), key=lambda x: (-x[0], x[1]))


def test_drawn_rows_keep_their_columns(spark):
    df = spark.createDataFrame([(i, f"alpha beta {i} " * 10, i) for i in range(60)], "doc_id long, text string, other long")
    drawn = R.resampled(df, df.limit(1), percent=50).collect()
    assert len(drawn) == 30 and all(r.other == r.doc_id for r in drawn)


@pytest.mark.parametrize("target", [[], [("alpha",)]])
def test_empty_tables(spark, tmp_path, target):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(target, "text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert QUERIES["op11_resampling"](spark, str(tmp_path)).count() == 0
    compare(R.importance(spark.createDataFrame(HARD[:3], "doc_id long, text string"), spark.createDataFrame(target, "text string")), HARD[:3], [t for t, in target])
