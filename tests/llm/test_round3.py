"""Loose personal data, filters of many trigrams, and repeated rows that spread."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridledger.llm import boosting, langid, packing, pii, sharding
from gridledger.llm.queries import VOCABULARY

LOOSE = {"write jane (at) example.org now": "jane (at) example.org", "please call 212-555-0100 today": "212-555-0100", "you may pay with 4111.1111.1111.1111 now": "4111.1111.1111.1111",
         "the server 10 . 0 . 3 . 4 is down": "10 . 0 . 3 . 4", "phone (212) 555-0100": "(212) 555-0100", "mail bob.k [at] mail.example.net please": "bob.k [at] mail.example.net"}
ALIKE = ["version 1 . 2 . 3 . 4 of it", "card 4111.1111.1111.1112", "let us meet (at) noon", "on 2021-05-06 10:30 sharp", "isbn 978-3-16-148410-0", "order 4111.1111.1111.1111 today",
         "1 . 2 . 3 . 400", "3.14159 and 2.71828", "12 345 678", "a (at) b", "from 1999-12-31 to 2000-01-01"]


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def model(spark, request):
    return pii.learn(spark.read.parquet(f"/root/testdata/{request.param}/documents.parquet"))


def test_thresholds_do_not_depend_on_the_size_of_the_table(model):
    assert max(model.thresholds) <= 1


def test_loose_forms_are_added_and_what_looks_like_them_is_not(model):
    for text, span in LOOSE.items():
        assert [text[a:b] for _, a, b in model.spans(text)[1]] == [span], text
    for text in ALIKE:
        assert model.spans(text) == ([], []), text


def plain_spans(model, text):
    """Base spans, and of the other valid candidates over their thresholds the best that meets nothing chosen, again and again."""
    chosen = pii.base_spans(text)
    offered = [(float(model.trees.probability(np.array([pii.features(text, c)]))[0]), c) for c in pii.candidates(text) if c not in chosen and pii.valid(c[0], text[c[1]:c[2]])]
    for p, c in sorted(offered, key=lambda x: (-x[0], x[1])):
        if p >= model.thresholds[c[0]] and all(c[2] <= a or b <= c[1] for _, a, b in chosen):
            chosen.append(c)
    return sorted(chosen)


def test_spans_agree_with_a_plain_version(model):
    rng = random.Random(5)
    words = ["call", "write", "the", "version", "order", "host", "a@b.org", "10.0.0.1", "+1 212 555 0100", "4111 1111 1111 1111", "12", "4111111111111111 4111111111111111"]
    for _ in range(150):
        parts = [rng.choice(words) if rng.random() < 0.6 else pii._loose(rng, rng.randrange(4)) for _ in range(rng.randint(1, 12))]
        text = rng.choice([" ", ", ", ""]).join(parts)
        assert sorted(model.spans(text)[1]) == plain_spans(model, text), text


def test_precision_and_recall_of_planted_forms(model):
    rng = random.Random(9)
    found = wrong = 0
    for i in range(400):
        kind = i % 4
        lead, form = rng.choice(pii._LEADS[kind]), pii._loose(rng, kind)
        other = rng.choice(pii._OTHER_LEADS)
        found += bool(model.spans(f"some words and {lead} {form} and more")[1])
        wrong += bool(set(model.spans(f"some words and {other} {form} and more")[1]) - set(pii.base_spans(f"some words and {other} {form} and more")))
    assert found >= 360 and wrong <= 20, (found, wrong)


def test_checks_of_candidates():
    for kind, span, right in [(0, "a (at) b.org", True), (0, "a @ b", False), (0, "@b.org", False), (1, "1 . 2 . 3 . 4", True), (1, "1.2.3.256", False), (1, "1.2.3.04", False),
                              (2, "4111.1111.1111.1111", True), (2, "0000000000000", False), (3, "(212) 555-0100", True), (3, "2125550100", False), (3, "+4930123456", False), (3, "0049 30 123456", True)]:
        assert pii.valid(kind, span) == right, span


def test_an_empty_table_and_null_texts_teach_nothing(spark):
    for rows in ([], [(1, None), (None, None)]):
        model = pii.learn(spark.createDataFrame(rows, "doc_id long, text string"))
        assert model.spans("mail a@b.org or call 212-555-0100")[1] == [(0, 5, 12)]


def test_every_text_is_an_example(spark):
    """Also of a table of more documents than were once drawn."""
    texts = [f"mail a{i}@b.org or +1 212 555 {i:04d}" for i in range(9)]
    docs = spark.range(45_000).select(F.col("id").alias("doc_id"), F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col("id") % 9 + 1).cast("int")).alias("text"))
    planted = [label for t in texts for _, _, label in pii._planted(t, f"{pii.hashlib.blake2b(t.encode(), digest_size=8).hexdigest()} 0")]
    spans = sum(len(pii.base_spans(t)) for t in texts)
    total = pii.examples(docs).agg(F.sum("n"), F.sum("right")).first()
    assert tuple(total) == (5000 * (len(planted) + spans), 5000 * (sum(planted) + spans))


def test_trees_of_a_table_are_those_of_its_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, (3000, 4))
    y = ((x[:, 0] > 5) ^ (x[:, 2] > 2) ^ (rng.random(3000) < 0.05)).astype(int)
    limits = np.arange(11) + 0.5
    rows = [(boosting.cells(a, limits).tobytes(), int(b), 1) for a, b in zip(x, y)]
    found = boosting.boost_rows(spark.createDataFrame(rows, "x binary, right long, n long").repartition(5), limits, 4, trees=8)
    plain = boosting.boost(x, y, trees=8)
    assert np.allclose(found.probability(x), plain.probability(x), atol=1e-4)


# --- other operators -----------------------------------------------------------------------------------

def test_filters_of_more_than_a_million_trigrams():
    rng = np.random.default_rng(1)
    grams = np.unique(rng.integers(0, 1 << 62, 1_300_000, dtype=np.int64)).astype(np.uint64)
    which = (np.arange(len(grams)) % 2).astype(np.uint64)
    filters = langid.Filters.build(["a", "b"], grams, which)
    assert len(filters.planes[0]) <= 1 << 24
    mask = np.bitwise_and.reduce([filters.planes[0][s] for s in filters._slots(grams[:5000])])
    assert ((mask >> which[:5000]) & np.uint64(1)).all()
    other = rng.integers(0, 1 << 62, 5000, dtype=np.int64).astype(np.uint64)
    false = np.mean(np.bitwise_and.reduce([filters.planes[0][s] for s in filters._slots(other)]) & np.uint64(1))
    assert abs(false - filters.false_rate[0]) < 0.02


def test_filters_grow_past_24_bits(monkeypatch):
    monkeypatch.setattr(langid, "ROOMY_SLOTS", 1 << 10)
    grams = np.arange(1 << 20, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    monkeypatch.setattr(langid, "LEAST_SLOTS_PER_GRAM", 32)
    filters = langid.Filters.build(["a"], grams, np.zeros(len(grams), dtype=np.uint64))
    assert len(filters.planes[0]) == 1 << 25 and max(int(s.max()) for s in filters._slots(grams)) > 1 << 24


def plain_share(texts, language, learned):
    """Share of a text's trigrams that are in a language's set, without filters."""
    grams, owner = langid.trigrams(texts)
    own = learned[language]
    return [np.mean([g in own for g in grams[owner == i]]) if (owner == i).any() else 0.0 for i in range(len(texts))]


def test_shares_agree_with_plain_sets():
    rng = random.Random(2)
    words = {lang: ["".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(400)] for lang, letters in (("x", "abcdefgh"), ("y", "efghijkl"), ("z", "éüñabç"))}
    text = lambda lang, n: " ".join(rng.choices(words[lang], k=n))
    learned = {lang: set(langid.trigrams([text(lang, 3000)])[0].tolist()) for lang in words}
    grams = np.array([g for lang in learned for g in learned[lang]], dtype=np.uint64)
    which = np.array([i for i, lang in enumerate(learned) for _ in learned[lang]], dtype=np.uint64)
    filters = langid.Filters.build(list(learned), grams, which)
    texts = [text(rng.choice(list(words)), rng.randint(3, 300)) for _ in range(60)] + ["", "12 34", text("x", 50) + " " + text("z", 50)]
    shares, _ = filters.shares(texts)
    for i, lang in enumerate(learned):
        plain = np.array(plain_share(texts, lang, learned))
        assert np.abs(shares[:, i] - plain).max() < 0.02
    best = shares.argmax(axis=1)[:60]
    assert (best == np.array([plain_share(texts[:60], lang, learned) for lang in learned]).argmax(axis=0)).all()


def test_repeated_rows_are_packed_in_many_groups(spark):
    df = spark.range(6000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("").alias("text")).repartition(3)
    pieces = packing.tokenised(df, VOCABULARY)
    placed = packing.packed(pieces, 6000, group_documents=300)
    per = placed.groupBy(F.shiftright("sequence_id", 32).alias("g")).count().collect()
    assert sum(r["count"] for r in per) == 6000 and len(per) >= 15 and max(r["count"] for r in per) < 1200
    assert sorted(placed.columns) == sorted(["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def test_repeated_rows_are_sharded_from_many_blocks(spark):
    df = spark.range(4000).select(F.lit(7).alias("a"), F.lit("same").alias("b")).repartition(4)
    placed = sharding.shuffle_into_shards(df, 5)
    got = placed.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("last"), F.count_distinct("slot").alias("slots")).collect()
    assert [(r.n, r.last, r.slots) for r in got] == [(800, 799, 800)] * 5


def test_ids_of_equal_documents_differ_only_in_their_twin(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "a b")], "doc_id long, text string").coalesce(1)
    rows = packing.tokenised(df, VOCABULARY).collect()
    assert [(r.doc_id, r.twin) for r in rows] == [(1, 0), (1, 1), (2, 0)] and len({r.ids_crc32 for r in rows}) == 1
    assert all(r.ids_crc32 == rows[0].ids_crc32 and zlib for r in rows)
