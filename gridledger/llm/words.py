"""Token ids of texts by a vocabulary file that lower-cases, drops white space and merges within words.

The file's normaliser and pre-tokenizer cut a text into words, runs of marks and single digits, each of which the library's
model encodes by itself. Those pieces are found with the file's own pattern, and a worker keeps the ids of pieces it has
met, up to a bound, in a table that fills itself. Words with characters outside Latin-1 go through the library's
whole pipeline, and so do texts that spell out a special token, and all texts if the file cuts them in another way.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np

#: Pieces whose ids a worker keeps; a full table starts anew.
PIECES_KEPT = 300_000
LONGEST_KEPT = 64

# The steps of the file that are followed here, and its pattern within Latin-1 after lower-casing, where
# \p{L} is _LETTER and \p{N} is _NUMBER.
_STEPS = ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTER, _NUMBER, _SPACE = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
_WORD = re.compile(r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_OTHER = re.compile(r"[^\x00-\xff]")


def _follows(conf: dict) -> bool:
    """Whether a file cuts texts as this module does."""
    try:
        first, second = conf["normalizer"]["normalizers"], conf["pre_tokenizer"]["pretokenizers"]
        return (([x["type"] for x in first], [x["type"] for x in second]) == _STEPS and first[1]["pattern"] == {"Regex": r"\s+"}
                and second[0]["pattern"] == {"Regex": _PATTERN} and second[0]["invert"] and not second[1]["add_prefix_space"])
    except (KeyError, TypeError, IndexError):
        return False


class _Pieces(dict):
    """Ids of pieces, found when they are first asked for."""

    def __init__(self, tokenizer):
        from tokenizers import pre_tokenizers

        super().__init__()
        self.tokenizer = tokenizer
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_as_text = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(256)}

    def __missing__(self, piece: str) -> bytes:
        """A piece of the pattern; with a space before it, any text as it is."""
        if piece[0] == " ":
            ids = self.tokenizer.encode(piece[1:], add_special_tokens=False).ids
        else:
            ids = [t.id for t in self.tokenizer.model.tokenize(piece.translate(self.bytes_as_text))]
        found = np.asarray(ids, dtype="<u4").tobytes()
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= PIECES_KEPT:
                self.clear()
            self[piece] = found
        return found


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, equal to the library's ids of the whole text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.follows = _follows(json.loads(self.tokenizer.to_str()))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = _Pieces(self.tokenizer)

    def _cut(self, text: str) -> list[str]:
        if not _OTHER.search(text):
            return _PIECE.findall(text.lower())
        out: list[str] = []
        for word in _WORD.findall(text):
            out += [f" {word}"] if _OTHER.search(word) else _PIECE.findall(word.lower())
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.follows:
            return [np.asarray(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        ids = self.pieces.__getitem__
        return [ids(f" {t}") if any(s in t for s in self.special) else b"".join(map(ids, self._cut(t))) for t in texts]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)


def texts_in_parts(column, most_chars: int = 2_000_000) -> Iterator[tuple[int, list[str]]]:
    """Slices of an Arrow text column, (first row, texts), of bounded size unless one text is longer; null is the empty text."""
    part, first, size = [], 0, 0
    for i in range(len(column)):
        text = column[i].as_py() or ""
        if part and size + len(text) > most_chars:
            yield first, part
            part, first, size = [], i, 0
        part.append(text)
        size += len(text)
    if part:
        yield first, part
