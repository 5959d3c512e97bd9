"""Highest-scoring segmentation of texts into the pieces of a vocabulary file, and back, with giant texts in chunks.

A text is cut into chunks of fixed length. A piece may reach over a chunk's end, so the state at a boundary is how many
characters of the next chunk are already taken. A chunk is a matrix: the best score from every state at its start to every
state at its end. Matrices combine by max-plus products, which are associative, so a scan in a logarithmic number of
steps gives the best score of every state at every boundary. Each chunk then traces its pieces back by itself for every
state at its end, names the state at its start, and a pass over these small tables picks the pieces of each chunk.

Scores are those of the file, added up along the text (the file's unigram reading). Among equal scores the piece that
begins first wins at each end, wherever the chunks are cut. Characters that no piece covers become byte pieces.
"""

from __future__ import annotations

import functools
import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import id_and_text, kept

#: Characters of a chunk. Texts up to this long are one chunk, with nothing to combine.
CHUNK = 16_384
#: What a worker keeps: words as written, and the units they are cut into; a full table starts anew.
WORDS_KEPT, UNITS_KEPT, LONGEST_KEPT = 150_000, 350_000, 48
#: Score of an unknown character below the least of any piece, as in the library.
UNKNOWN_PENALTY = 10.0
_SPACE = "▁"
NONE = -np.inf


class Lattice:
    """Pieces and scores of a file, and best paths over them."""

    def __init__(self, path: str):
        import sentencepiece

        self.file = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.file.vocab_size()
        special = {i for i in range(size) if self.file.is_control(i) or self.file.is_unknown(i) or self.file.is_unused(i)}
        self.byte = {i: int(self.file.id_to_piece(i)[3:5], 16) for i in range(size) if self.file.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte.items()}
        self.text = [self.file.id_to_piece(i) for i in range(size)]
        self.special = special
        self.pieces = {self.text[i]: (float(self.file.get_score(i)), i) for i in range(size) if i not in special and i not in self.byte}
        self.longest = max(map(len, self.pieces))
        self.root: dict = {}                                       # a trie: from each character to score and id (or -1), and on
        for piece in sorted(self.pieces):
            node = self.root
            for i, c in enumerate(piece):
                score, number = self.pieces[piece] if i == len(piece) - 1 else (NONE, -1)
                if c not in node or number >= 0:
                    node[c] = score, number, node[c][2] if c in node else {}
                node = node[c][2]
        self.unknown = min(s for s, _ in self.pieces.values()) - UNKNOWN_PENALTY
        self.unknown_id = self.file.unk_id()
        #: A space mark after another character begins a word that no piece reaches into.
        self.words_apart = not any(_SPACE in p.lstrip(_SPACE) for p in self.pieces)
        marks = re.escape("".join(sorted(self._marks())))
        self.units = re.compile(f"{_SPACE}+[{marks}]*[^{_SPACE}{marks}]*|[{marks}]+[^{_SPACE}{marks}]*|[^{_SPACE}{marks}]+" if marks else f"{_SPACE}+[^{_SPACE}]*|[^{_SPACE}]+", re.S)
        self.scores = np.array([self.unknown if i == self.unknown_id or (i in self.byte and not 0x80 <= self.byte[i] < 0xC0) else 0.0 if i in special or i in self.byte
                                else self.pieces[self.text[i]][0] for i in range(size)])
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _marks(self) -> set[str]:
        """Characters that begin a piece or follow a space mark or one another in it: no piece reaches over to them from a word."""
        marks = {c for piece in self.pieces for c in piece if not c.isalnum() and c != _SPACE}
        while True:
            reached = {b for piece in self.pieces for a, b in zip(piece, piece[1:]) if b in marks and a not in marks and a != _SPACE}
            if not reached:
                return marks
            marks -= reached

    def normalised(self, text: str) -> str:
        return self.file.normalize(text) if text else ""

    def best(self, text: str, starts: list[float], owned: int) -> tuple[list[float], list[tuple[int, int]]]:
        """Best score of every place and the piece (start, id) that ends there, from scores of the first places.

        Only pieces that begin in the first ``owned`` characters count; they may end after them. A character that is no
        piece by itself is also an unknown one.
        """
        n, root, pieces = len(text), self.root, self.pieces
        score = starts + [NONE] * (n + 1 - len(starts))
        back = [(-1, -1)] * (n + 1)
        for i in range(min(owned, n)):
            here = score[i]
            if here == NONE:
                continue
            node, end = root, i
            while end < n:
                found = node.get(text[end])
                if found is None:
                    break
                end += 1
                more, piece, node = found
                if piece >= 0 and here + more > score[end]:
                    score[end], back[end] = here + more, (i, piece)
            if text[i] not in pieces and here + self.unknown > score[i + 1]:
                score[i + 1], back[i + 1] = here + self.unknown, (i, self.unknown_id)
        return score, back

    def _unit(self, unit: str) -> bytes:
        """Ids (little-endian, 32 bits) of a piece of text that no piece reaches into or out of."""
        found = self.known.get(unit)
        if found is None:
            _, back = self.best(unit, [0.0], len(unit))
            ids, end = [], len(unit)
            while end:
                end, piece = back[end]
                ids.append(piece)
            ids.reverse()
            if self.unknown_id in ids:
                ids = list(self._with_bytes(unit, self._path(back, len(unit))))
            found = struct.pack(f"<{len(ids)}i", *ids)
            if len(unit) <= LONGEST_KEPT:
                if len(self.known) >= UNITS_KEPT:
                    self.known.clear()
                self.known[unit] = found
        return found

    def _score(self, ids: bytes) -> float:
        """Sum of the scores of pieces; of a character in byte pieces its first byte has the unknown score."""
        return float(self.scores[np.frombuffer(ids, dtype="<i4")].sum())

    def _path(self, back, end: int) -> list[tuple[int, int, int]]:
        out = []
        while back[end][0] >= 0:
            start, piece = back[end]
            out.append((start, end, piece))
            end = start
        return out[::-1]

    def _with_bytes(self, text: str, path: list[tuple[int, int, int]]) -> Iterator[int]:
        """Ids of a path; unknown characters as byte pieces if the file has them, else runs of them as one unknown id."""
        last = False
        for start, end, piece in path:
            if piece != self.unknown_id:
                yield piece
            elif self.byte_id:
                yield from (self.byte_id[b] for b in text[start:end].encode("utf-8"))
            elif not last:
                yield piece
            last = piece == self.unknown_id

    def split(self, text: str) -> list[str]:
        """The text cut where no piece reaches over, or whole where any may."""
        if not self.words_apart:
            return [text] if text else []
        return self.units.findall(text)

    def encoded(self, text: str) -> bytes:
        """Ids of a normalised text, little-endian, 32 bits; words after a single space mark are kept as a whole."""
        parts = text.split(_SPACE)
        words = parts[1:]
        if not self.words_apart or parts[0] or "" in words:
            return b"".join(map(self._unit, self.split(text)))
        known = self.words
        unknown = {w for w in words if w not in known}
        if len(known) + len(unknown) > WORDS_KEPT:
            known.clear()
            unknown = set(words)
        known.update((w, b"".join(map(self._unit, self.split(_SPACE + w)))) for w in unknown)
        return b"".join(map(known.__getitem__, words))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encoded(text), dtype="<i4").tolist()

    def matrix(self, text: str, owned: int) -> np.ndarray:
        """Best scores from each state at the chunk's start (rows) to each at its end; ``text`` reaches past the chunk."""
        size = self.longest
        out = np.full((size, size), NONE)
        apart = self._apart(text, owned)
        if apart is None:
            for state in range(min(size, owned + 1)):
                score, _ = self.best(text, [NONE] * state + [0.0], owned)
                ends = score[owned:owned + size]
                out[state, :len(ends)] = ends
            return out
        first, last = apart
        tail, _ = self.best(text[last:], [0.0], owned - last)
        ends = self._score(self.encoded(text[first:last])) + np.array(tail[owned - last:owned - last + size])
        for state in range(min(size, first + 1)):                   # no piece reaches over a cut between words
            head, _ = self.best(text[:first], [NONE] * state + [0.0], first)
            out[state, :len(ends)] = head[first] + ends
        return out

    def _apart(self, text: str, owned: int) -> tuple[int, int] | None:
        """The first and last place in the chunk where a word begins that no piece reaches into."""
        if not self.words_apart:
            return None
        first = text.find(_SPACE, 1)
        while 0 < first <= owned and text[first - 1] == _SPACE:
            first = text.find(_SPACE, first + 1)
        last = text.rfind(_SPACE, 1, owned + 1)
        while last > 0 and text[last - 1] == _SPACE:
            last = text.rfind(_SPACE, 1, last)
        return (first, last) if 0 < first <= last else None

    def variants(self, text: str, owned: int, starts: np.ndarray) -> tuple[bytes, list[tuple[int, int, bytes]]]:
        """The ids that all paths through the chunk share, and for every state at its end that a path reaches: that state, the
        state at the chunk's start, and the ids after the shared ones."""
        def ends(score, back, text, at, begin):
            out = []
            for state in range(min(self.longest, len(text) - at + 1)):
                if score[at + state] > NONE:
                    path = self._path(back, at + state)
                    first = begin if begin is not None else path[0][0] if path else at + state
                    ids = list(self._with_bytes(text, path))
                    out.append((state, first, struct.pack(f"<{len(ids)}i", *ids)))
            return out

        apart = self._apart(text, owned)
        if apart is None:
            return b"", ends(*self.best(text, starts.tolist()[:len(text) + 1], owned), text, owned, None)
        first, last = apart
        _, back = self.best(text[:first], starts.tolist()[:first + 1], first)
        path = self._path(back, first)
        head = list(self._with_bytes(text, path))
        shared = struct.pack(f"<{len(head)}i", *head) + self.encoded(text[first:last])
        tail = text[last:]
        return shared, ends(*self.best(tail, [0.0], owned - last), tail, owned - last, path[0][0] if path else first)

    def decode(self, ids) -> str:
        """The text of ids: bytes joined, space marks as spaces, without the mark that begins every text."""
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte:
                raw.append(self.byte[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i not in self.special:
                out.append(self.text[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        text = "".join(out).replace(_SPACE, " ")
        return text[1:] if text[:1] == " " else text


@functools.lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    """One per worker process and file."""
    return Lattice(path)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of matrices, or of stacks of them."""
    return (a[..., :, :, None] + b[..., None, :, :]).max(axis=-2)


def scan(matrices: np.ndarray) -> np.ndarray:
    """Products of the first 1, 2, … matrices, in a number of steps logarithmic in theirs."""
    out, step = matrices.copy(), 1
    while step < len(out):
        out[step:] = product(out[:-step], out[step:])
        step *= 2
    return out


def _chunks(df: DataFrame, model: str, chunk: int) -> DataFrame:
    """``row, doc_id, k, owned, text``: chunks of the normalised texts with the characters a piece may reach after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = lattice(model)
        for batch in batches:
            out: list[tuple] = []
            step = max(chunk, tool.longest)
            for row, doc_id, text in zip(*(batch.column(i) for i in range(3))):
                whole = tool.normalised(text.as_py() or "")
                n = max(1, -(-len(whole) // step))
                for k in range(n):
                    out.append((row.as_py(), doc_id.as_py(), k, len(whole[k * step:(k + 1) * step]), whole[k * step:(k + 1) * step + tool.longest]))
                if len(out) >= 500:
                    yield _batch(out, CHUNK_TYPES)
                    out = []
            yield _batch(out, CHUNK_TYPES)

    return df.mapInArrow(run, "row long, doc_id long, k long, owned long, text string")


CHUNK_TYPES = [("row", pa.int64()), ("doc_id", pa.int64()), ("k", pa.int64()), ("owned", pa.int64()), ("text", pa.string())]


def _batch(rows: list[tuple], types: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, types)], [n for n, _ in types])


def encode(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``doc_id, ids`` of every row. A null or empty text has no ids; rows that repeat an id stay separate.

    Texts of one chunk are done in one pass. Of longer ones only chunk matrices, states and ids are shuffled, and one row
    is gathered per document, as large as the ids that it returns. Other columns are not read.
    """

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = lattice(model)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                ids = [tool.encoded(tool.normalised(x.as_py() or "")) for x in part.column(1)]
                offsets = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                flat = np.frombuffer(b"".join(ids), dtype="<i4")
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["doc_id", "ids"])

    rows = id_and_text(df, id_col, text_col)
    long = F.length("text") >= chunk                               # the normalised text has a mark more
    once = rows.where(~long | F.col("text").isNull()).mapInArrow(short, "doc_id long, ids array<int>")
    giant = rows.where(long).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return once.unionByName(_encode_giant(giant, model, chunk))


def _encode_giant(giant: DataFrame, model: str, chunk: int) -> DataFrame:
    chunks = kept(_chunks(giant, model, chunk), "chunks")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = lattice(model)
        for batch in batches:
            found = [tool.matrix(t.as_py(), o.as_py()).astype("<f8").tobytes() for t, o in zip(batch.column(3), batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["row", "k", "m"])

    def boundaries(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("k")
        stack = np.frombuffer(b"".join(table["m"].to_pylist()), dtype="<f8")
        size = int(round((len(stack) / len(table)) ** 0.5))
        after = scan(stack.reshape(-1, size, size))[:, 0, :]
        first = np.full((1, size), NONE)
        first[0, 0] = 0.0
        before = np.concatenate([first, after[:-1]])
        return pa.table({"row": table["row"], "k": table["k"], "v": pa.array([x.astype("<f8").tobytes() for x in before], pa.binary())})

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = lattice(model)
        types = [("row", pa.int64()), ("doc_id", pa.int64()), ("k", pa.int64()), ("shared", pa.binary()), ("states", pa.list_(pa.int64())), ("begins", pa.list_(pa.int64())), ("tails", pa.list_(pa.binary()))]
        for batch in batches:
            for row in batch.to_pylist():
                v = np.frombuffer(row["v"], dtype="<f8")
                v = v - v[np.isfinite(v)].max()
                shared, found = tool.variants(row["text"], row["owned"], v)
                yield _batch([(row["row"], row["doc_id"], row["k"], shared, *map(list, zip(*found)))], types)

    def chosen(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """From the last chunk back, the variant whose end is the state in which the next chunk begins."""
        rows, state, parts = {r["k"]: r for r in table.to_pylist()}, 0, []
        for k in range(len(rows) - 1, -1, -1):
            i = rows[k]["states"].index(state)
            parts.append(rows[k]["shared"] + rows[k]["tails"][i])
            state = rows[k]["begins"][i]
        ids = np.frombuffer(b"".join(parts[::-1]), dtype="<i4")
        return pa.table({"doc_id": table["doc_id"].slice(0, 1), "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids))})

    m = chunks.select("row", "k", "owned", "text").mapInArrow(matrices, "row long, k long, m binary")
    states = m.groupBy("row").applyInArrow(boundaries, "row long, k long, v binary")
    both = chunks.join(states, ["row", "k"]).select("row", "doc_id", "k", "owned", "text", "v")
    variants = both.mapInArrow(traced, "row long, doc_id long, k long, shared binary, states array<long>, begins array<long>, tails array<binary>")
    return variants.groupBy("row").applyInArrow(chosen, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, text`` of rows of ``encode``; a null list is a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = lattice(model)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [tool.decode(x.as_py()) if x.is_valid else None for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def summaries(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, decoded_sha256`` of rows of ``encode``: checksums of the ids and of their decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = lattice(model)
        for batch in batches:
            lists = batch.column(1)
            ends, values = lists.offsets.to_numpy(), np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<u4")
            own = [values[a:b] for a, b in zip(ends[:-1], ends[1:])]
            texts = [hashlib.sha256(tool.decode(x.tolist()).encode()).hexdigest() for x in own]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in own], pa.int64()), pa.array([zlib.crc32(x.data) for x in own], pa.int64()), pa.array(texts, pa.string())],
                                             ["doc_id", "n_tokens", "ids_crc32", "decoded_sha256"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string")
