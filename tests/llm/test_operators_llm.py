"""The registered queries of the document operators: contracts, brute-force versions, and difficult tables."""

import hashlib
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

import corpus_pipeline  # noqa: E402
from gridledger.llm import exactdedup, graph, langid, linededup, minhash, packing, segment, sharding, simhash, tokenfiles  # noqa: E402
from gridledger.llm.common import new_path  # noqa: E402
from gridledger.llm.queries import PIECES, QUERIES, VOCABULARY  # noqa: E402

SMALL = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(VOCABULARY)

#: Nulls, empty and blank texts, copies, repeated rows and ids, long texts and words, odd letters.
HARD = [
    (5, None, "en", "s", 0), (7, "", None, "s", None), (None, "no id here at all", "en", None, 3), (None, None, None, None, None), (8, " \n\t ", "de", "s", 4),
    (9, "one two three four five six", "en", "s", 27), (10, "one two three four five six", "en", "t", 27), (10, "one two three four five six", "en", "t", 27),
    (11, "a\nb\nc\nd\ne", "fr", "s", 9), (12, "x\na\nb\nc\ny", "fr", "s", 9), (13, "a\na\na\na\na", "fr", "s", 9), (13, "other text with the same id", "en", "s", 9),
    (-3, "été 日本 😀 ▁ <|endoftext|>   end", "es", "s", 9), (2 ** 62, "mail me@host.org or +1 (212) 555-0100 from 10.0.0.1, card 4111 1111 1111 1111", "en", "s", 70),
    (14, "word " * 70_000, "en", "s", 350_000), (15, "y" * 50_000, "en", "s", 50_000), (16, "12 34 !!", "en", "s", 8)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def hard(spark, tmp_path_factory):
    """The difficult rows with extra columns named like those that operators use."""
    folder = tmp_path_factory.mktemp("hard")
    df = spark.createDataFrame(HARD, SCHEMA)
    for name in ("k1", "h1", "fp", "node", "part", "ids", "length", "lines", "removed", "score", "r", "c0", "row", "digest", "next"):
        df = df.withColumn(name, F.lit(f"extra {name}"))
    df.repartition(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for name, schema in (("documents", SCHEMA), ("benchmark", "item_id long, text string"), ("conversations", "conv_id long, turn long, role string, text string"),
                         ("pages", "page_id long, url string, html string")):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def texts(spark, folder):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}


def ids_of(text):
    return np.array([*LIBRARY.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_an_empty_table_gives_no_rows(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


def test_the_pipeline_of_an_empty_table_has_no_rows(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0


# op1

def plain_bins(text, bins=minhash.BINS):
    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def xx(value, seed):
        return signed(xxhash.xxh64_intdigest(value if isinstance(value, bytes) else (value & (2 ** 64 - 1)).to_bytes(8, "little"), seed & (2 ** 64 - 1)))

    def walk(i):
        return signed(xxhash.xxh64_intdigest(i.to_bytes(4, "little"), xxhash.xxh64_intdigest(b"walk", 42)))

    words = [xx(w.encode(), 42) for w in text.replace("\x0b", " ").split() if w]
    runs = [words[i:i + 5] for i in range(max(1, len(words) - 4))] if words else []
    least = {}
    for run in runs:
        h = 42
        for w in run:
            h = xx(w, h)
        b = (h >> 56) + bins // 2
        least[b] = min(h, least.get(b, h))
    if not least:
        return None
    out = []
    for i in range(bins):
        w = walk(i)
        step = (w >> 20) | 1
        t = 0
        at = i
        while at not in least:
            at = (w + t * step) % bins
            t += 1
        out.append(least[at])
    return out


def test_minhash_is_that_of_a_plain_version(spark):
    some = ["", "one two three", "a b c d e f g h", " ".join(f"w{i * i % 97}" for i in range(40)), " ".join(f"v{i}" for i in range(3000))]
    df = spark.createDataFrame([(t,) for t in some], "text string").select("text", minhash.as_text(minhash.fingerprint(F.col("text"))).alias("f"))
    got = {r.text: r.f for r in df.collect()}
    for t in some:
        bins = plain_bins(t)
        assert got[t] == ("" if bins is None else "".join(f"{b & 15:x}" for b in bins))


@pytest.mark.parametrize("where", ["small", "hard"])
def test_minhash_contract(spark, hard, where):
    folder = SMALL if where == "small" else hard
    rows = QUERIES["op1_minhash"](spark, folder).collect()
    if where == "hard":
        assert len(rows) == len(HARD)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
        return
    docs = texts(spark, folder)
    order = sorted(docs, reverse=True)
    got, errors, prints = {r.doc_id: r for r in rows}, [], {}
    for i, k in enumerate(order):
        text, following = docs[k], docs[order[(i + 1) % len(order)]]
        half = len(text) // 2
        new = text[:len(text) - half] + following[:half]
        assert got[k].n_chars == len(text) and got[k].edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        a, b = ({tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} for w in (text.split(), new.split()))
        errors.append(got[k].near_edited - len(a & b) / len(a | b))
        prints.setdefault(text, set()).add(got[k].fingerprint)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05
    assert all(len(p) == 1 for p in prints.values())


# op2

@pytest.mark.parametrize("where", ["small", "hard"])
def test_packing_contract(spark, hard, where):
    folder = SMALL if where == "small" else hard
    rows = QUERIES["op2_packing"](spark, folder).toPandas()
    for _, sequence in rows.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        assert (sequence.offset.to_numpy() == np.cumsum([0, *sequence.length])[:-1]).all() and sequence.length.sum() <= 4096
    if where == "hard":
        want = sorted(len(ids_of(t or "")) for _, t, *_ in HARD)
        assert sorted(rows[rows.start == 0].doc_tokens) == want and rows.length.sum() == sum(want)
        return
    for k, pieces in rows.groupby("doc_id"):
        ids, at = ids_of(texts(spark, folder)[k]) if k < 12 else None, 0
        for p in pieces.sort_values("start").itertuples():
            assert p.start == at and (ids is None or zlib.crc32(ids[at:at + p.length].tobytes()) == p.ids_crc32)
            at += p.length
        assert at == pieces.doc_tokens.iloc[0]
    assert rows.length.sum() / (4096 * rows.sequence_id.nunique()) > 0.95


def test_sequences_carry_their_ids(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    placed = packing.pack_documents(docs, VOCABULARY, capacity=512, with_ids=True)
    whole = packing.sequences(placed, pad=7, capacity=512).collect()
    assert all(len(s.ids) == (s.filled if s.filled & (s.filled - 1) == 0 else 512) and set(s.ids[s.filled:]) <= {7} for s in whole)
    assert sum(s.filled for s in whole) == placed.agg(F.sum("length")).first()[0]


# op3

@pytest.mark.parametrize("where", ["small", "hard"])
def test_sharding_contract(spark, hard, where):
    folder = SMALL if where == "small" else hard
    rows = QUERIES["op3_sharding"](spark, folder).toPandas()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    key = lambda d: (-1 if d[0] is None or d[0] != d[0] else int(d[0]), d[1], d[2])
    assert sorted(map(key, zip(rows.doc_id, rows["size"], rows.text_crc32))) == sorted(key((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))) for d, t in docs)
    counts = rows.groupby("shard").size().reindex(range(24), fill_value=0)
    assert counts.max() - counts.min() <= 1
    assert all(sorted(s.slot) == list(range(len(s))) for _, s in rows.groupby("shard"))


def test_places_are_uniform_and_differ_by_seed(spark):
    df = spark.range(4000)
    a = sharding.shuffle_into_shards(df, 4, seed=1).toPandas().sort_values("id")
    b = sharding.shuffle_into_shards(df, 4, seed=2).toPandas().sort_values("id")
    assert (a.shard.to_numpy() != b.shard.to_numpy()).mean() > 0.6
    for part in np.array_split(a.shard.to_numpy(), 8):                       # each run of ids is spread evenly
        assert (abs(np.bincount(part, minlength=4) - 125) < 50).all()
    assert abs(np.corrcoef(a.id, a.slot)[0, 1]) < 0.1
    with pytest.raises(ValueError):
        sharding.shuffle_into_shards(df.withColumnRenamed("id", "Slot"), 4)


# op4

def plain_line_dedup(docs):
    first, out = {}, {}
    for k in sorted(docs):
        lines, gone = docs[k].split("\n"), set()
        for i in range(len(lines) - 2):
            w = tuple(lines[i:i + 3])
            if any(x.strip(" ") for x in w) and first.setdefault(w, (k, i)) != (k, i):
                gone |= {i, i + 1, i + 2}
        out[k] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_line_dedup_on_given_texts(spark):
    docs = {1: "a\nb\nc\nd", 2: "x\nb\nc\nd\ny", 3: "a\na\na\na\na", 4: "\n\n\n\nz", 5: "\n\n\n\nz", 6: "a\nb", 7: "b\nc\nd", 8: ""}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in linededup.dedup_lines(df).collect()}
    want = plain_line_dedup(docs)
    assert {k: r.text for k, r in got.items()} == want
    assert want[2] == "x\ny" and want[3] == "a" and want[7] == "" and got[7].removed == 3


def test_line_dedup_of_hot_windows(spark, monkeypatch):
    """With any count as hot or none, by broadcast or by shuffle, the rows are the same."""
    docs = {i: f"start {i % 7}\nshared one\nshared two\nshared three\nend {i}" for i in range(60)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    for one_in in (1, 10 ** 9):
        monkeypatch.setattr(linededup, "HOT_ONE_IN", one_in)
        assert {r.doc_id: r.text for r in linededup.dedup_lines(df).collect()} == plain_line_dedup(docs)


def test_line_dedup_of_hard_rows(spark, hard):
    rows = QUERIES["op4_line_dedup"](spark, hard).collect()
    assert len(rows) == len(HARD)
    assert [r.text for r in rows if r.doc_id == 12] == ["x\ny"] and [r.text for r in rows if r.doc_id == 11] == ["a\nb\nc\nd\ne"]
    assert [(r.text, r.lines) for r in rows if r.doc_id == 5] == [(None, 0)]


# op5

@pytest.mark.parametrize("where", ["small", "hard"])
def test_segmentation_round_trip(spark, hard, where):
    folder = SMALL if where == "small" else hard
    tool = segment.Lattice(PIECES)
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op5_sentencepiece"](spark, folder).collect()
    key = lambda x: (x[0] is None, x)
    want = []
    for k, t in docs:
        ids = np.array(tool.encode(tool.normalised(t)), dtype="<u4")
        want.append((k if k is not None else -1, len(ids), zlib.crc32(ids.tobytes()), hashlib.sha256(t.replace("▁", " ").encode()).hexdigest()))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_crc32, r.decoded_sha256) for r in rows) == sorted(want)
    assert key((None,))[0]


def test_small_chunks_give_the_same_ids(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", F.substring("text", 1, 3000).alias("text"))
    one = {r.doc_id: r.ids for r in segment.encode(docs, PIECES).collect()}
    many = {r.doc_id: r.ids for r in segment.encode(docs, PIECES, chunk=100).collect()}
    assert one == many


# op6

def plain_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))], dtype=np.uint64)
    return sum(1 << j for j in range(64) if 2 * int((hashes >> np.uint64(j) & np.uint64(1)).sum()) > len(hashes))


def plain_components(prints):
    """Smallest id reachable over links of at most 4 bits."""
    order = sorted(prints)
    codes, root = np.array([prints[k] for k in order], dtype=np.uint64), list(range(len(order)))

    def up(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(order)):
        for j in np.flatnonzero(np.bitwise_count(codes[i + 1:] ^ codes[i]) <= 4) + i + 1:
            a, b = up(i), up(int(j))
            root[max(a, b)] = min(a, b)
    return {k: order[up(i)] for i, k in enumerate(order)}


def test_simhash_contract(spark):
    prints = {k: plain_fingerprint(t) for k, t in texts(spark, "/root/testdata/sf0.01").items()}
    want = plain_components(prints)
    rows = QUERIES["op6_simhash"](spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {k: (f"{p:016x}", want[k]) for k, p in prints.items()}


def test_simhash_of_hard_rows(spark, hard):
    rows = QUERIES["op6_simhash"](spark, hard).collect()
    assert len(rows) == len(HARD)
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {5}
    assert {r.component_id for r in rows if r.doc_id in (9, 10)} == {9}


def test_large_groups_are_joined_in_slices(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2 ** 63, 30, dtype=np.uint64)
    codes = np.unique(np.concatenate([base ^ np.uint64(sum(1 << int(b) for b in rng.integers(0, 20, 3))) for _ in range(20)]))
    nodes = spark.createDataFrame([(i, bytearray(int(c).to_bytes(8, "big"))) for i, c in enumerate(codes)], "node long, fp binary")
    want = plain_components(dict(enumerate(codes.tolist())))
    for slice_rows in (200_000, 40):
        monkeypatch.setattr(simhash, "SLICE_ROWS", slice_rows)
        found = {r.node: r.root for r in graph.components(simhash.linked_nodes(nodes, simhash.LINKS_OF_FOUR)).collect()}
        assert {i: found.get(i, i) for i in range(len(codes))} == want


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200)] + [(41, 40), (7, 3)]
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(42)} | {100 + i: 100 for i in range(50)}


# op7

def test_language_contract(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op7_language_id"](spark, folder).collect()}
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    assert set(rows) == set(langs) and all(r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) and 0 <= r.score <= 1 for k, r in rows.items())
    held = [k for k, r in rows.items() if r.held_out]
    assert np.mean([rows[k].lang_pred == langs[k] for k in held]) > 0.97


def test_language_of_hard_rows(spark, hard):
    rows = QUERIES["op7_language_id"](spark, hard).collect()
    assert len(rows) == len(HARD)
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {5, 7, 8, 16} <= und and all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert {r.lang_pred for r in rows if r.doc_id == 9} == {"en"}


def test_filters_of_many_languages_correct_false_positives():
    rng = np.random.default_rng(6)
    names = [f"l{i:03}" for i in range(70)]                                  # more than one plane of masks
    words = {n: ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 3)) for _ in range(40)] for n in names}
    grams, which = [], []
    for i, n in enumerate(names):
        g = np.unique(langid.trigrams([" ".join(words[n])])[0])
        grams.append(g)
        which.append(np.full(len(g), i))
    filters = langid.Filters.build(names, np.concatenate(grams), np.concatenate(which))
    shares, total = filters.shares([" ".join(words[n][:20]) for n in names] + ["123"])
    assert (shares[:-1].argmax(axis=1) == np.arange(70)).all() and total[-1] == 0 and shares[:-1].max(axis=1).min() > 0.99


def test_long_texts_are_read_in_slices(monkeypatch):
    text = "The quick brown fox, 12 times. " * 50
    whole = langid.trigrams([text, "x"])
    monkeypatch.setattr(langid, "SLICE", 37)
    parts = langid.trigrams([text, "x"])
    assert all((a == b).all() for a, b in zip(whole, parts))


# op8

def test_pii_of_hard_rows(spark, hard):
    rows = QUERIES["op8_pii"](spark, hard).collect()
    assert len(rows) == len(HARD)
    found = next(r for r in rows if r.doc_id == 2 ** 62)
    assert (found.n_email, found.n_ip, found.n_card, found.n_phone) == (1, 1, 1, 1)
    text = next(t for k, t, *_ in HARD if k == 2 ** 62)
    base = f"email:5:16,ip:{text.index('10.0')}:{text.index('10.0') + 8},card:{text.index('4111')}:{len(text)},phone:{text.index('+1')}:{text.index('+1') + 17}"
    assert found.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and set(base.split(",")) <= set(found.spans.split(","))
    assert all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows if r.doc_id in (5, 7))


def test_redaction_keeps_rows_and_columns(spark, hard):
    docs = spark.read.parquet(f"{hard}/documents.parquet")
    out = corpus_pipeline.redact(spark, docs, hard)
    assert out.columns == docs.columns and out.count() == len(HARD)
    row = out.where(F.col("doc_id") == 2 ** 62).first()
    assert row.text == "mail <EMAIL> or <PHONE> from <IP>, card <CARD>" and row.n_chars == len(row.text)


# op9

@pytest.mark.parametrize("counters", [1, 3, 1024])
def test_exact_duplicates(spark, hard, counters):
    docs = spark.read.parquet(f"{hard}/documents.parquet")
    rows = exactdedup.exact_duplicates(docs, counters=counters).collect()
    groups = {}
    for k, t, *_ in HARD:
        groups.setdefault(hashlib.sha256((t or "").encode()).hexdigest(), []).append(k)
    assert len(rows) == len(HARD)
    for digest, ids in groups.items():
        own = [r for r in rows if r.text_sha256 == digest]
        assert sum(r.kept for r in own) == 1 and {r.group_size for r in own} == {len(ids)}
        assert {r.keep_id for r in own} == {max((k for k in ids if k is not None), default=None)}


# op10

@pytest.mark.parametrize("where", ["small", "hard"])
def test_token_files_contract(spark, hard, where):
    folder = SMALL if where == "small" else hard
    rows = QUERIES["op10_token_files"](spark, folder).orderBy("start").collect()
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()), key=lambda d: (d[0] is not None, d[0] or 0))
    assert [r.doc_id for r in rows] == [k for k, _ in docs]
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    assert sorted((r.n_tokens, r.ids_crc32) for r in rows) == sorted((len(ids_of(t)), zlib.crc32(ids_of(t).tobytes())) for _, t in docs)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_files_are_encoded_and_indexed(spark, encoding):
    path = new_path(spark, "tokens-test")
    tokenfiles.write_tokens(spark.read.parquet(f"{SMALL}/documents.parquet"), path, VOCABULARY, encoding=encoding)
    files = [r.path.removeprefix("file:") for r in spark.read.format("binaryFile").load(f"{path}/ids/*.parquet").select("path").collect()]
    meta = pq.ParquetFile(files[0]).metadata.row_group(0)
    ids = next(meta.column(i) for i in range(meta.num_columns) if meta.column(i).path_in_schema.startswith("ids"))
    assert ids.has_offset_index and any(("DICTIONARY" if encoding == "dictionary" else "DELTA_BINARY_PACKED") in e for e in ids.encodings)
    plan = tokenfiles.read_tokens(spark, path).select("doc_id", "n_tokens").where("doc_id = 17")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in text.split("ReadSchema")[1].split("\n")[0] and "PushedFilters" in text and plan.count() == 1


# pipeline

def test_stages_of_hard_rows(spark, hard):
    docs = spark.read.parquet(f"{hard}/documents.parquet")
    language = corpus_pipeline.language_id(spark, docs, hard)
    gone = {5, 7, 8, 16}
    assert language.columns == docs.columns and not gone & {r.doc_id for r in language.select("doc_id").collect()}
    lines = corpus_pipeline.line_dedup(spark, docs, hard)
    assert lines.columns == docs.columns and {r.n_chars for r in lines.where("doc_id = 12").collect()} == {3} and {r.lines for r in lines.collect()} == {"extra lines"}
    near = corpus_pipeline.near_dedup(spark, docs, hard)
    kept = [r.doc_id for r in near.select("doc_id").collect()]
    assert near.columns == docs.columns and 9 in kept and 10 not in kept and kept.count(13) == 2 and sum(k in (5, 7, 8, None) for k in kept) == 2


def test_near_duplicates_of_a_text_go_and_others_stay(spark):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(4000)]
    docs, i = [], 0
    for g in range(20):
        base = list(rng.choice(words, 300))
        for c in range(5):
            copy = base.copy()
            for p in rng.choice(300, c, replace=False):                      # up to four words changed: similarity over 0.85
                copy[p] = "changed"
            docs.append((i, " ".join(copy), "en", "s", 0))
            i += 1
    docs += [(1000 + j, " ".join(rng.choice(words, 200)), "en", "s", 0) for j in range(50)]
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, spark.createDataFrame(docs, SCHEMA), "").collect()}
    assert kept == {5 * g for g in range(20)} | {1000 + j for j in range(50)}


def test_near_duplicates_are_those_of_the_similarity(spark):
    """Against all pairs of the shingle sets, on the given texts."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    own = {r.doc_id: simhash.shingle_set(r.text or "", 5) for r in docs.collect()}
    order, root = sorted(own), {k: k for k in own}

    def up(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b]):
                root[max(up(a), up(b))] = min(up(a), up(b))
    want = {k for k in order if up(k) == k}
    got = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert want <= got and len(got - want) <= 2


def test_the_pipeline_ends_in_packed_sequences(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "pii", "packing"]
    rows = corpus_pipeline.run(spark, SMALL).toPandas()
    assert (rows.groupby("sequence_id").length.sum() <= 4096).all() and rows.doc_id.nunique() > 150


def connected(own):
    """The ids that stay, by all pairs of sets of shingles with a similarity of 0.8."""
    order, root = sorted(own), {k: k for k in own}

    def up(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b]):
                root[max(up(a), up(b))] = min(up(a), up(b))
    return {k for k in order if up(k) == k}


@pytest.mark.parametrize("slice_texts", [4_000, 70])
def test_near_duplicates_in_a_family_around_the_similarity(spark, monkeypatch, slice_texts):
    """Variants of one text whose similarities are 0.7 to 0.9: every pair counts, not only the closest by fingerprint."""
    monkeypatch.setattr(simhash, "SLICE_TEXTS", slice_texts)
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(4000)]
    base = list(rng.choice(words, 200))
    docs = []
    for i in range(400):
        copy = base.copy()
        for p in rng.choice(200, 3, replace=False):
            copy[p] = f"new{i}x{p}"
        docs.append((i, " ".join(copy), "en", "s", 0))
    own = {d[0]: simhash.shingle_set(d[1], 5) for d in docs}
    got = {r.doc_id for r in corpus_pipeline.near_dedup(spark, spark.createDataFrame(docs, SCHEMA), "").collect()}
    assert got == connected(own)


def test_near_duplicates_of_texts_with_a_repeated_phrase(spark):
    """A phrase repeated often neither joins texts that share nothing else nor parts a text from its copy with the phrase."""
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(4000)]
    phrase, one, other, long = "buy the best now here " * 50, *(" ".join(rng.choice(words, n)) for n in (40, 40, 300))
    docs = [(1, phrase + one, "en", "s", 0), (2, phrase + other, "en", "s", 0), (3, long, "en", "s", 0), (4, long + " " + phrase, "en", "s", 0)]
    assert simhash.fingerprint(docs[0][1], 5, 4) == simhash.fingerprint(docs[1][1], 5, 4)
    got = {r.doc_id for r in corpus_pipeline.near_dedup(spark, spark.createDataFrame(docs, SCHEMA), "").collect()}
    assert got == connected({d[0]: simhash.shingle_set(d[1], 5) for d in docs}) == {1, 2, 3}


def test_equal_fingerprints_are_one_family(spark):
    """Sets that share a fingerprint stay nodes of their own, to be compared; one without company is in no family."""
    fps = [bytes(8), bytes(8), b"\xff" * 8, b"\xf0" * 8]
    nodes = spark.createDataFrame([(i, bytearray(fp)) for i, fp in enumerate(fps)], "node long, fp binary")
    assert sorted(tuple(r) for r in simhash.families(nodes, simhash.LINKS_OF_FOUR).select("g", "node").collect()) == [(0, 0), (0, 1)]


def test_near_duplicates_of_short_texts_are_all_found(spark):
    """Texts of 8 words and the same with a ninth: similarity 0.8, and fingerprints often too far apart."""
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(4000)]
    base = [list(rng.choice(words, 8)) for _ in range(200)]
    docs = [(2 * i + k, " ".join(b + ["more"] * k), "en", "s", 0) for i, b in enumerate(base) for k in (0, 1)]
    got = {r.doc_id for r in corpus_pipeline.near_dedup(spark, spark.createDataFrame(docs, SCHEMA), "").collect()}
    assert got == set(range(0, 400, 2))


def test_short_prefixes_meet():
    rng = np.random.default_rng(7)
    for small in range(1, 33):
        large = int(small / 0.8 + 1e-9)
        for shared in range(1, small + 1):
            h = rng.permutation(np.arange(small + large - shared, dtype=np.uint64))
            a, b = np.sort(h[:small]), np.sort(h[small - shared:])
            if shared >= 0.8 * (small + large - shared):
                assert np.intersect1d(simhash.short_prefix(a, 0.8), simhash.short_prefix(b, 0.8)).size


def test_a_rare_language_is_learned_at_every_size(spark):
    """40 documents among 20,000 of another language, and a sample of 300."""
    common, rare = "the quick brown fox jumps over lazy dogs", "zwölf boxkämpfer jagen viktor quer über"
    docs = spark.range(20_040).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 501 == 0, rare).otherwise(common).alias("text"), F.when(F.col("id") % 501 == 0, "de").otherwise("en").alias("lang"))
    filters = langid.learn(docs, sample_rows=300)
    assert filters.languages == ["de", "en"]
    found = langid.predicted(docs, filters).groupBy("lang", "lang_pred").count().collect()
    assert sorted(tuple(r) for r in found) == [("de", "de", 40), ("en", "en", 20_000)]
    assert langid.even_quota([40, 20_000], 300) == 260 and langid.even_quota([3, 4], 10) == 4 and langid.even_quota([], 10) == 0
    assert langid.even_quota([5, 100, 100], 25) == 10
