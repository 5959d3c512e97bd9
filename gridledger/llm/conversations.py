"""Cheapest repair of the structure of conversations, on a grammar shared by all of them.

Every row of a conversation becomes one of nine symbols: its role's initial, sound or truncated, or a row that must go. What a
repair costs depends on that sequence alone, so the work is done once per distinct sequence. Re-Pair names the most frequent pairs
of neighbouring symbols, round after round, over all sequences. A symbol has one matrix of the roles expected before and after
it, with the cheapest cost of getting from one to the other; the matrix of a rule is the min-plus product of its two parts,
computed bottom-up, and its audit is a rope: the middle state at which the audits of the parts meet. A sequence is then a short
product of matrices, whatever its length.

Inserted rows belong to the row that they come before. So every audit of a block ends with the letter of its last row, none is
the beginning of another, and the least of two audits is known from the first part in which they differ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gridledger.llm.common import discard, join_counted, kept

# The white space of the faults, the marks that end a sentence, the letters of edits and what they cost.
BLANK, ENDS = " \t\n\x0b\x0c\r", ".!?"
DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 3, 2, 2, 1

#: What a conversation may expect next: anything, the first user, an assistant, another user or the end.
START, USER_FIRST, ASSISTANT, MORE = range(4)
STATES = range(4)
_INSERTED = {START: ASSISTANT, USER_FIRST: ASSISTANT, ASSISTANT: MORE, MORE: ASSISTANT}
_TAKEN = {"s": {START: USER_FIRST}, "u": {START: ASSISTANT, USER_FIRST: ASSISTANT, MORE: ASSISTANT}, "a": {ASSISTANT: MORE}, "o": {}}
_CLOSING = {START: "", MORE: "", ASSISTANT: INSERT, USER_FIRST: INSERT * 2}
_WRITTEN = {START: "user", USER_FIRST: "user", ASSISTANT: "assistant", MORE: "user"}

GONE = "x"
TERMINALS = [GONE, *"suao", *"SUAO"]
NEVER = 1 << 60

#: The largest grammar, which travels to every task. What it does not name is multiplied out symbol by symbol.
RULES = 4096
PAIRS_A_ROUND = 256
_FIRST_RULE = 0x100


class Block:
    """The matrix of a symbol: costs by state before and after, the order of the audits from a state, and their ropes."""

    __slots__ = ("cost", "order", "middle", "parts", "texts")

    def __init__(self, cost, order, middle=None, parts=None, texts=None):
        self.cost, self.order, self.middle, self.parts, self.texts = cost, order, middle, parts, texts


def _terminal(symbol: str) -> Block:
    must_go, truncated = symbol == GONE, symbol.isupper()
    extra, taken = TRUNCATED_COST * truncated, _TAKEN.get(symbol.lower(), {})
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for p in STATES:
        at, spent, said = p, 0, ""
        for _ in STATES:
            ways = [(at, DELETE_COST, DELETE)]
            if not must_go:
                ways.append((_INSERTED[at], REROLE_COST + extra, REROLE))
                ways += [(taken[at], extra, KEEP)] if at in taken else []
            for q, cost, letter in ways:
                best[p, q] = min(best.get((p, q), (NEVER, "")), (spent + cost, said + letter))
            at, spent, said = _INSERTED[at], spent + INSERT_COST, said + INSERT
    texts = [[best.get((p, q), (NEVER, ""))[1] for q in STATES] for p in STATES]
    cost = [[best.get((p, q), (NEVER, ""))[0] for q in STATES] for p in STATES]
    order = [[sorted(t).index(t[q]) for q in STATES] for t in texts]
    return Block(cost, order, texts=texts)


def _product(left: Block, right: Block) -> Block:
    cost, middle = [[NEVER] * 4 for _ in STATES], [[0] * 4 for _ in STATES]
    for p in STATES:
        for q in STATES:
            total, _, m = min((left.cost[p][m] + right.cost[m][q], left.order[p][m], m) for m in STATES)
            cost[p][q], middle[p][q] = min(total, NEVER), m
    order = []
    for p in STATES:
        place = [(left.order[p][m], right.order[m][q]) for q, m in enumerate(middle[p])]
        order.append([sorted(place).index(x) for x in place])
    return Block(cost, order, middle=middle)


class Grammar:
    """The matrices of all symbols. ``rules`` are pairs of symbols; the rule with index i has the symbol ``chr(256 + i)``."""

    def __init__(self, rules: list[tuple[str, str]], longest_text: int = 256):
        self.blocks = {symbol: _terminal(symbol) for symbol in TERMINALS}
        length = dict.fromkeys(TERMINALS, 1)
        for i, (left, right) in enumerate(rules):
            symbol, a, b = chr(_FIRST_RULE + i), self.blocks[left], self.blocks[right]
            block = self.blocks[symbol] = _product(a, b)
            block.parts, length[symbol] = (left, right), length[left] + length[right]
            if length[symbol] <= longest_text:
                block.texts = [[a.texts[p][m] + b.texts[m][q] for q, m in enumerate(block.middle[p])] for p in STATES]

    def _text(self, symbol: str, p: int, q: int, out: list[str]) -> None:
        todo = [(symbol, p, q)]
        while todo:
            symbol, p, q = todo.pop()
            block = self.blocks[symbol]
            if block.texts:
                out.append(block.texts[p][q])
            else:
                m = block.middle[p][q]
                todo += [(block.parts[1], m, q), (block.parts[0], p, m)]

    def cheapest(self, sequence: str) -> tuple[int, str]:
        """Cost and audit of a sequence of symbols."""
        cost, order, back = [0, NEVER, NEVER, NEVER], [0, 1, 2, 3], []
        for symbol in sequence:
            block, last, place = self.blocks[symbol], cost, order
            ways = [min((last[m] + block.cost[m][q], place[m], m) for m in STATES) for q in STATES]
            cost, middle = [min(w[0], NEVER) for w in ways], [w[2] for w in ways]
            said = [(place[m], block.order[m][q]) for q, m in enumerate(middle)]
            order = [sorted(said).index(x) for x in said]
            back.append(middle)
        total, _, q = min((cost[q] + INSERT_COST * len(_CLOSING[q]), order[q], q) for q in STATES)
        closing, steps = _CLOSING[q], []
        for symbol, middle in zip(reversed(sequence), reversed(back)):
            steps.append((symbol, middle[q], q))
            q = middle[q]
        out: list[str] = []
        for step in reversed(steps):
            self._text(*step, out)
        return total, "".join(out) + closing


def _pairs(new_rules: list[tuple[str, str, str]]):
    """Rewrites sequences by the new rules."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = "\n".join(batch.column(1).to_pylist())
            for left, right, symbol in new_rules:
                text = text.replace(left + right, symbol)
            short = text.split("\n") if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(short, pa.string())], ["symbols", "short"])

    return run


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbours and how often each occurs; a pair of equal symbols also counts where it overlaps itself."""
    for batch in batches:
        codes = np.frombuffer("\n".join(batch.column(0).to_pylist()).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        first, second = codes[:-1], codes[1:]
        inside = (first != 10) & (second != 10)
        pairs, n = np.unique(first[inside] << 32 | second[inside], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int64))], ["pair", "n"])


def _chosen(counts: list[tuple[int, int]], room: int) -> list[tuple[str, str]]:
    """Of the most frequent pairs those that cannot overlap one another, down to an eighth of the greatest count."""
    lefts, rights, out = set(), set(), []
    for pair, n in counts:
        left, right = pair >> 32, pair & 0xFFFFFFFF
        if n < 2 or n * 8 < counts[0][1] or len(out) == room:
            break
        if left in rights or right in lefts or (left == right and left in lefts | rights):
            continue
        lefts.add(left)
        rights.add(right)
        out.append((chr(left), chr(right)))
    return out


def compressed(sequences: DataFrame, most_rules: int = RULES) -> tuple[list[tuple[str, str]], DataFrame]:
    """The rules of a grammar of all ``symbols`` and the sequences with their rewritten form ``short``, by Re-Pair.

    A round counts all pairs of neighbours, names the most frequent ones and replaces them everywhere, from left to right; it
    ends when no pair occurs twice. At most ``most_rules`` rules are made.
    """
    rules: list[tuple[str, str]] = []
    work = kept(sequences.select("symbols", F.col("symbols").alias("short")), "sequences")
    while len(rules) < most_rules:
        counts = work.select("short").mapInArrow(_pair_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        new = _chosen([tuple(r) for r in counts.orderBy(F.desc("n"), "pair").limit(PAIRS_A_ROUND * 4).collect()], min(PAIRS_A_ROUND, most_rules - len(rules)))
        if not new:
            break
        named = [(left, right, chr(_FIRST_RULE + len(rules) + i)) for i, (left, right) in enumerate(new)]
        rules += new
        before, work = work, kept(work.mapInArrow(_pairs(named), "symbols string, short string"), "sequences")
        discard(before)
    return rules, work


def _rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, turn, role, text`` with a space for null roles and texts, and two hashes of role and text."""
    said = [F.coalesce(df[c].cast("string"), F.lit(" ")) for c in (role, text)]
    return df.select(df[conv].alias("conv_id"), df[turn].cast("long").alias("turn"), said[0].alias("role"), said[1].alias("text"),
                     F.xxhash64(*said).alias("d1"), F.xxhash64(F.lit("row"), *said).alias("d2"))


_PLACE = ["turn", "role", "d1", "d2"]
_FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long"
_LEGAL = {"su", "ua", "au"}


def _sequence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation out of its sorted rows ``conv_id, turn, initial, blank, again, truncated``."""
    conv, out = None, None
    state: dict = {}

    def fresh():
        return {"symbols": bytearray(), "last": None, "turn": None, "turns": 0, "least": None, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

    def ended():
        s = state
        gaps = s["turn"] - s["least"] + 1 - s["turns"] if s["turns"] else 0
        return (conv, s["symbols"].decode(), gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"])

    for batch in batches:
        rows = []
        for key, turn, initial, blank, again, truncated in zip(*(c.to_pylist() for c in batch.columns)):
            if not state or key != conv:
                if state:
                    rows.append(ended())
                conv, state = key, fresh()
            s = state
            if turn is not None and turn != s["turn"]:
                s["least"] = turn if s["least"] is None else s["least"]
                s["turn"], s["turns"] = turn, s["turns"] + 1
            if s["last"] is not None and s["last"] + initial not in _LEGAL:
                s["illegal"] += 1
            s["last"] = initial
            kind = initial if initial in ("s", "u", "a") else "o"
            if blank or again:
                s["blank" if blank else "duplicate"] += 1
                kind = GONE
            elif truncated:
                s["truncated"] += 1
                kind = kind.upper()
            s["symbols"] += kind.encode()
        out = batch.schema.field(0).type
        yield _sequences(rows, out)
    if state:
        yield _sequences([ended()], out)


def _sequences(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 7
    kinds = [key_type, pa.string(), *[pa.int64()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", "symbols", "gaps", "blank", "duplicate", "truncated", "illegal"])


def _ddl(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def sequences(rows: DataFrame) -> DataFrame:
    """``conv_id, symbols`` and the counts of faults of each conversation. Texts stay where they are: only their hashes move."""
    bare = F.rtrim("text", F.lit(BLANK))
    marks = rows.select("conv_id", *_PLACE, F.substring("role", 1, 1).alias("initial"), (bare == "").alias("blank"),
                        (~F.substring(bare, -1, 1).isin(*ENDS)).alias("truncated"))
    earlier = Window.partitionBy("conv_id", "d1", "d2").orderBy("turn")
    marked = marks.repartition("conv_id").withColumn("again", F.row_number().over(earlier) > 1)
    ordered = marked.sortWithinPartitions("conv_id", *_PLACE, "again").select("conv_id", "turn", "initial", "blank", "again", "truncated")
    return ordered.mapInArrow(_sequence, f"conv_id {_ddl(rows, 'conv_id')}, symbols string, {_FOUND}")


def _evaluated(grammar: Grammar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [grammar.cheapest(s) for s in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
                                             ["symbols", "cost", "audit"])

    return run


def plans(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", most_rules: int = RULES) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    Rows are taken by turn, nulls first; rows of one turn by role and then by a hash of role and text, copies next to one another. A null
    role or text is one space; an empty role, like any that does not begin with s, u or a, cannot be kept. The rows with a
    null conversation are one conversation. Equal rows are duplicates. An empty table gives no rows; other columns are not read.
    A conversation is read in order by one task, which holds a letter per row of it and no text.
    """
    found = kept(sequences(_rows(df, conv, turn, role, text)), "conversations")
    distinct = kept(found.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")), "symbols")
    rules, work = compressed(distinct, most_rules)
    audits = kept(work.mapInArrow(_evaluated(Grammar(rules)), "symbols string, cost long, audit string").join(distinct, "symbols"), "audits")
    return join_counted(found, audits, ["symbols"]).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


class _Repair:
    """Follows an audit through the rows of a conversation."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == INSERT:
            yield _WRITTEN[self.state], ""
            self.state, self.at = _INSERTED[self.state], self.at + 1

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == KEEP:
            yield role, text
            self.state = _TAKEN[role[:1]][self.state]
        elif letter == REROLE:
            yield _WRITTEN[self.state], text
            self.state = _INSERTED[self.state]

    def end(self) -> Iterator[tuple[str, str]]:
        return self._inserted()


def _in_order(df: DataFrame, found: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Every conversation's plan followed by its rows, whole in one partition: ``conv_id, audit, role, text`` and the plan."""
    rows = _rows(df, conv, turn, role, text)
    plan = F.struct(*[c for c in found.columns if c not in ("conv_id", "audit")])
    heads = found.select("conv_id", plan.alias("plan"), "audit")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("d1", "long"), ("d2", "long"))]
    both = heads.select("conv_id", *none, "audit", "plan").unionByName(
        rows.select("conv_id", "turn", "role", "text", "d1", "d2", F.lit(None).cast("string").alias("audit"), F.lit(None).cast(heads.schema["plan"].dataType).alias("plan")))
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *_PLACE)
    return ordered.select("conv_id", "audit", "role", "text", "plan")


def _walk(batch: pa.RecordBatch, most_rows: int = 500) -> Iterator[tuple]:
    for first in range(0, batch.num_rows, most_rows):
        part = batch.slice(first, most_rows)
        yield from zip(*(part.column(i).to_pylist() for i in range(4)), range(first, first + part.num_rows))


def repaired(df: DataFrame, found: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired rows ``conv_id, place, role, text`` by the plans ``found``; ``place`` counts from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, key, place, kind = None, None, 0, None

        def written(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 4, (kind, pa.int64(), pa.string(), pa.string()))],
                                              ["conv_id", "place", "role", "text"])

        for batch in batches:
            out, kind = [], batch.schema.field(0).type
            for conv_id, audit, who, said, _ in _walk(batch):
                new = list(repair.end() if repair else ()) if audit is not None else list(repair.row(who, said))
                out += [(key, place + i, *x) for i, x in enumerate(new)]
                place += len(new)
                if audit is not None:
                    repair, key, place = _Repair(audit), conv_id, 0
            yield written(out)
        if repair:
            yield written([(key, place + i, *x) for i, x in enumerate(repair.end())])

    return _in_order(df, found, conv, turn, role, text).mapInArrow(run, f"conv_id {_ddl(found, 'conv_id')}, place long, role string, text string")


def summaries(df: DataFrame, found: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The plans ``found`` with ``repaired_sha256`` of the repaired ``role:text`` joined by newlines, computed row by row."""
    fields = [c for c in found.columns if c not in ("conv_id", "audit")]
    schema = T.StructType([found.schema["conv_id"], *[found.schema[c] for c in fields], T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", *fields, "audit", "repaired_sha256"]
        head, digest, lines, repair = None, None, 0, None
        empty = None

        def add(new):
            nonlocal lines
            for who, said in new:
                digest.update(f"{chr(10) * (lines > 0)}{who}:{said}".encode())
                lines += 1

        def ended():
            add(repair.end())
            return pa.RecordBatch.from_arrays([*head, pa.array([digest.hexdigest()], pa.string())], names)

        for batch in batches:
            empty = empty or batch.slice(0, 0)
            out = []
            for conv_id, audit, who, said, i in _walk(batch):
                if audit is None:
                    add(repair.row(who, said))
                    continue
                if repair:
                    out.append(ended())
                plan = batch.column(4).slice(i, 1).flatten()
                head = [batch.column(0).slice(i, 1), *plan, batch.column(1).slice(i, 1)]
                repair, digest, lines = _Repair(audit), hashlib.sha256(), 0
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
        if repair:
            yield ended()

    return _in_order(df, found, conv, turn, role, text).mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """The given conversations with faults planted by a checksum of conversation and turn (nulls: one space)."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"),
                                (F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20).alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies).drop("copy")


def repairs_of_damaged(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation of the given table, damaged, with its faults, cheapest repair and the digest of its repaired rows."""
    given = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = damaged(given)
    done = summaries(rows, plans(rows))
    none = [F.lit(0).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    seen = rows.select("conv_id").distinct()
    lost = given.select("conv_id").distinct().exceptAll(seen)
    return done.unionByName(lost.select("conv_id", *none, F.lit("").alias("audit"), F.lit(hashlib.sha256(b"").hexdigest()).alias("repaired_sha256")))
