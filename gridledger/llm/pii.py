"""Personal data: base patterns, generous candidate generators, and boosted trees that choose among the candidates.

The base spans of a text are those of four fixed patterns. Besides, generators propose overlapping spans in looser
formats. What a candidate says in its plain form must pass the check of its kind (checksum, range of parts, number of digits, form of a
domain); whether it is meant so is for a model of boosted trees, which sees format and context and none of the checks. It is
learned from every text: its base spans, and valid loose forms that are planted in excerpts of it, after
neutral or fitting words as right ones and after words that speak of something else as wrong ones; other kinds that are seen in a planted
form are wrong, too. The examples stay in a table, equal ones counted, and trees are grown on their sums. Thresholds per kind are calibrated on held-out examples. A candidate that passes its check, lies over its
threshold and meets no base span is added, the best first.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.llm.boosting import Trees, boost_rows, cells
from gridledger.llm.common import discard, kept
from gridledger.llm.words import texts_in_parts

KINDS = ("email", "ip", "card", "phone")
#: Where the trees may cut a feature: all are whole numbers.
LIMITS = np.array([*range(24), 25, 28, 32, 40, 56, 80, 128, 192]) + 0.5
#: Scores are told apart by this part of one when a threshold is set.
SCORE_STEPS = 1 << 14
#: Planted forms in all at least, whatever the number of documents.
LEAST_PLANTED = 6000
#: Least share of right ones among the held-out candidates over a threshold, and the fewest examples of a kind to set one.
PRECISION, LEAST_EXAMPLES = 0.98, 20
CONTEXT = 40

Span = tuple[int, int, int]  # kind, start, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses; every @ is looked at once, so long runs cost no more than their length."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            free = m.end()
            yield start, free
        else:
            free = at + 1
        at = text.find("@", free)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str, runs: list[re.Match] | None = None) -> list[Span]:
    """The spans of the four patterns that pass their checks, by kind and start."""
    found = [(0, a, b) for a, b in _emails(text)]
    for run in _DOTTED.finditer(text):
        if run[0].count(".") >= 3:
            for m in _IP.finditer(run[0]):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                    found.append((1, run.start() + m.start(), run.start() + m.end()))
    for m in _CARD.finditer(text) if runs is None else runs:
        if m.end() - m.start() >= 16:
            digits = _digits(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                found.append((3, m.start(), m.end()))
    return found


_SIGN = re.compile(r"@|\(at\)|\[at\]")
_LOOSE_EMAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9.-]{2,255}")
_LOOSE_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3,5}(?![0-9])")
_LOOSE_CARD = re.compile(r"(?<![0-9])[0-9](?:[ .-]{0,2}[0-9]){11,20}(?![0-9])")
_LOOSE_PHONE = re.compile(r"(?<![0-9+])(?:\+|00)?\(?[0-9](?:[ ().-]{0,2}[0-9]){6,14}(?![0-9])")


def candidates(text: str) -> list[Span]:
    """Spans in looser formats, base spans among them; they may overlap, also between kinds."""
    out: list[Span] = []
    for sign in _SIGN.finditer(text):
        around = _LOOSE_EMAIL.finditer(text, max(0, sign.start() - 66), min(len(text), sign.end() + 258))
        out += [(0, m.start(), m.start() + len(m[0].rstrip(".-"))) for m in around if m.start() <= sign.start() < m.end()]
    for kind, pattern in ((1, _LOOSE_IP), (2, _LOOSE_CARD), (3, _LOOSE_PHONE)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    return out


_AT = re.compile(r" ?(?:\(at\)|\[at\]|@) ?")
_ADDRESS = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}")


def valid(kind: int, span: str) -> bool:
    """Whether a candidate in its plain form passes the check of its kind."""
    digits = _digits(span)
    if kind == 0:
        return bool(_ADDRESS.fullmatch(_AT.sub("@", span)))
    if kind == 1:
        parts = [p.strip() for p in span.split(".")]
        return len(parts) == 4 and all(len(p) <= 3 and p == str(int(p)) and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and len(set(digits)) > 1 and luhn(digits)
    if span.startswith(("+", "00")):
        return 8 <= len(digits.removeprefix("00")) <= 15 and len(digits) < len(span) - span.startswith("+")
    return len(digits) in (10, 11) and [len(g) for g in re.findall(r"[0-9]+", span)][-3:] == [3, 3, 4]


_HINTS = (re.compile(r"mail|write|contact|address", re.I), re.compile(r"\bip\b|host|server|addr", re.I),
          re.compile(r"card|visa|master|account|pay|credit", re.I), re.compile(r"phone|tel|call|fax|mobile|dial", re.I))
_ELSE = re.compile(r"version|release|section|chapter|isbn|order|serial|ticket|total|score|page|sum|lot|ref", re.I)


def features(text: str, span: Span) -> list[float]:
    """Format and context of a span as numbers; none of them is the check of a kind."""
    kind, a, b = span
    s, before, after = text[a:b], text[max(0, a - CONTEXT):a], text[b:b + 2]
    digits = _digits(s)
    groups = re.findall(r"[0-9]+", s)
    last, following = before[-1:] or " ", after[:1] or " "
    local, _, domain = s.partition("@")
    labels = domain.split(".") if domain else []
    return [
        *[float(kind == k) for k in range(4)], len(s), len(digits), len(s) - len(digits), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        len(set(digits)), float(digits[:1] or 0), float(s.startswith("+")), float("(" in s), s.count(" "), s.count("-"), s.count("."), float("@" in s), len(local) if domain else 0, len(labels),
        len(labels[-1]) if labels else 0, float(bool(labels) and labels[-1].isalpha()), float(last.isalpha()), float(last.isdigit()), float(last in "=:\"'/#_$"), float(last.isspace()),
        float(following.isalpha()), float(following.isspace()), float(following in "\"'/_%="), *[float(bool(h.search(before))) for h in (*_HINTS, _ELSE)]]


class Taken:
    """Places of a text that spans cover, as sorted intervals that do not overlap."""

    def __init__(self, spans: list[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, a, b in sorted(spans, key=lambda s: s[1:]):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, span: Span) -> bool:
        i = bisect.bisect_left(self.starts, span[2]) - 1
        return i >= 0 and self.ends[i] > span[1]

    def add(self, span: Span) -> None:
        """Takes a span that meets none."""
        i = bisect.bisect_left(self.starts, span[1])
        self.starts.insert(i, span[1])
        self.ends.insert(i, span[2])


@dataclass
class Model:
    trees: Trees
    thresholds: list[float]

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """The base spans, and all spans, by kind and start."""
        if not text or not _WORTH.search(text):
            return [], []
        base = base_spans(text)
        known = set(base)
        offered = [c for c in candidates(text) if c not in known]
        if not offered or min(self.thresholds) > 1:
            return base, base
        taken = Taken(base)
        free = [c for c in offered if self.thresholds[c[0]] <= 1 and not taken.meets(c) and valid(c[0], text[c[1]:c[2]])]
        if not free:
            return base, base
        score = self.trees.probability(np.array([features(text, c) for c in free]))
        for p, c in sorted(zip(score.tolist(), free), key=lambda x: (-x[0], x[1])):
            if p >= self.thresholds[c[0]] and not taken.meets(c):
                known.add(c)
                taken.add(c)
        return base, sorted(known)


_WORTH = re.compile(r"[@0-9]|[(\[]at[)\]]")


_LEADS = (("", "write to", "mail", "contact", "my address is"), ("", "host", "server", "the ip is", "from"),
          ("", "card", "pay with", "visa", "my account"), ("", "call", "phone", "tel", "reach me at"))
_OTHER_LEADS = ("version", "section", "order", "serial", "isbn", "ticket", "score", "total")


def _number(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _loose(rng: random.Random, kind: int) -> str:
    """A valid form of a kind that the base patterns do not take."""
    if kind == 0:
        name, host = ("".join(rng.choices("abcdefghijklmnoprstuvw", k=rng.randint(3, 9))) for _ in range(2))
        return f"{name}{rng.choice([' (at) ', '(at)', ' [at] ', '[at]', ' @ '])}{host}{rng.choice(['.com', '.example.org', '.net', '.de'])}"
    if kind == 1:
        return rng.choice([" . ", ". ", " ."]).join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == 2:
        digits = rng.choice("3456") + _number(rng, 14)
        digits += next(c for c in "0123456789" if luhn(digits + c))
        return rng.choice([".", " - ", "  ", " ."]).join(digits[i:i + 4] for i in range(0, 16, 4))
    a, b, c = rng.choice("23456789") + _number(rng, 2), _number(rng, 3), _number(rng, 4)
    return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{_number(rng, 2)} {a} {b} {c}", f"1-{a}-{b}-{c}"])


def _planted(text: str, seed: str) -> Iterator[tuple[str, Span, bool]]:
    """An excerpt of a text with a loose form in it, the valid candidates that meet the form, and whether each is right."""
    rng = random.Random(seed)
    kind, fits = rng.randrange(4), rng.random() < 0.6
    at = rng.randrange(len(text) + 1)
    before, after = text[max(0, at - CONTEXT):at], text[at:at + 20]
    lead = rng.choice(_LEADS[kind] if fits else _OTHER_LEADS)
    head = f"{before} {lead} ".replace("  ", " ")
    form = _loose(rng, kind)
    excerpt = f"{head}{form}{rng.choice([' ', '. ', ', '])}{after}"
    place = (kind, len(head), len(head) + len(form))
    for c in candidates(excerpt):
        if c[1] < place[2] and c[2] > place[1] and valid(c[0], excerpt[c[1]:c[2]]):
            yield excerpt, c, c == place and fits


def _shown(plants: int):
    width = len(features("0", (1, 0, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in texts_in_parts(batch.column(0)):
                rows, labels, held = [], [], []

                def add(text: str, c: Span, label: bool) -> None:
                    rows.append(features(text, c))
                    labels.append(label)
                    held.append(int.from_bytes(hashlib.blake2b(f"{c}{text[c[1]:c[2]]}".encode(), digest_size=6).digest(), "big") % 3 == 0)

                for text in texts:
                    mark = hashlib.blake2b(text.encode(), digest_size=8).hexdigest()
                    for k in range(plants):
                        for excerpt, c, label in _planted(text, f"{mark} {k}"):
                            add(excerpt, c, label)
                    if _WORTH.search(text):
                        for c in base_spans(text):
                            add(text, c, True)
                flat = cells(np.array(rows, dtype=np.float64).reshape(-1), LIMITS).tobytes()
                x = pa.array([flat[i:i + width] for i in range(0, len(flat), width)], pa.binary())
                yield pa.RecordBatch.from_arrays([x, pa.array(held, pa.bool_()), pa.array(labels, pa.bool_())], ["x", "held", "label"])

    return run


def examples(df: DataFrame, text_col: str = "text", plants: int = 1) -> DataFrame:
    """``(x, held, right, n)`` of all texts: how many examples have these features, as ``cells``, and how many of them are right.

    ``plants`` forms are planted in each text. Null texts are not read. A held-out example is one by a hash of its kind, place and text.
    """
    shown = df.where(F.col(text_col).isNotNull()).select(F.col(text_col).cast("string")).mapInArrow(_shown(plants), "x binary, held boolean, label boolean")
    return shown.groupBy("x", "held").agg(F.sum(F.col("label").cast("long")).alias("right"), F.count(F.lit(1)).alias("n"))


def _scores(trees: Trees):
    """The examples by kind and score, in steps of ``SCORE_STEPS``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                plain = np.append(LIMITS, LIMITS[-1] + 1)[x] - 0.5                                # a number in the same cell
                step = (trees.probability(plain) * SCORE_STEPS).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(x[:, :4].argmax(axis=1).astype(np.int32)), pa.array(step), batch.column(1), batch.column(2)], ["kind", "step", "right", "n"])

    return run


def learn(df: DataFrame, text_col: str = "text") -> Model:
    """Trees and thresholds from the examples of all documents.

    A form is planted in every text, in a small table so many in each that there are ``LEAST_PLANTED`` of them. Null texts are not read; an
    empty table gives a model that adds nothing.
    """
    plants = -(-LEAST_PLANTED // max(1, min(df.count(), LEAST_PLANTED)))
    found = kept(examples(df, text_col, plants), "pii-examples")
    trees = boost_rows(found.where(~F.col("held")), LIMITS, len(features("0", (1, 0, 1))))
    scored = found.where("held").select("x", "right", "n").mapInArrow(_scores(trees), "kind int, step int, right long, n long")
    rows = scored.groupBy("kind", "step").agg(F.sum("right").alias("right"), F.sum("n").alias("n")).collect()             # at most kinds x steps
    discard(found)
    own = [[r for r in rows if r.kind == k] for k in range(4)]
    return Model(trees, [_threshold(np.array([r.step / SCORE_STEPS for r in o]), np.array([r.right for r in o]), np.array([r.n for r in o])) for o in own])


def _threshold(p: np.ndarray, y: np.ndarray, times: np.ndarray | None = None) -> float:
    """The least score at and above which the held-out candidates are right with the wanted precision; 2 if none.

    ``y`` of a score's candidates are right, of one or of ``times`` many.
    """
    order = np.argsort(-p, kind="stable")
    p, y = p[order], y[order]
    right, n = np.cumsum(y), np.cumsum(np.ones(len(p)) if times is None else times[order])
    last = np.append(p[1:] != p[:-1], True) if len(p) else np.zeros(0, bool)                      # equal scores stand together
    good = np.flatnonzero(last & (right >= PRECISION * n) & (right >= LEAST_EXAMPLES))
    return float(p[good[-1]]) if len(good) else 2.0


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def found(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every row; null is the empty text.

    The counts are those of the base spans. Texts are read whole; other columns are not read.
    """
    held = df.sparkSession.sparkContext.broadcast(model)                                          # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            pairs = [own.spans(x.as_py() or "") for x in batch.column(1)]
            counts = [[sum(s[0] == k for s in base) for base, _ in pairs] for k in range(4)]
            digests = [hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in pairs]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array([_joined(s) for _, s in pairs], pa.string())],
                                             ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span, overlapping ones merged, replaced by the kind of its first."""
    out, free = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= free:
            out += [text[free:a], f"<{KINDS[kind].upper()}>"]
        free = max(free, b)
    return "".join(out) + text[free:]


def redacted(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The same rows and columns with the text redacted; null stays null."""
    held, columns = df.sparkSession.sparkContext.broadcast(model), df.columns
    place = columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            texts = [None if not x.is_valid else redact(x.as_py(), own.spans(x.as_py())[1]) for x in batch.column(place)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == place else c for i, c in enumerate(batch.columns)], [f"c{i}" for i in range(len(columns))])

    plain = df.toDF(*[f"c{i}" for i in range(len(columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*columns)
