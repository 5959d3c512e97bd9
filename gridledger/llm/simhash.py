"""SimHash near-deduplication by self-joins of binary tries.

A fingerprint has a bit for each hash bit that most shingles of a text have set. Equal fingerprints are one node; where a
similarity is asked for, repeated shingles count once and equal sets of shingles are one node. Two fingerprints that
differ in few bits agree wholly in at least one of several blocks, so the fingerprints are dealt by the value of
each block, and each group, ordered by its other bits, is a binary trie. The trie is joined with itself:
pairs of nodes are followed together from the root, the bits in which they differ are added up, and a pair over the
budget is dropped. Small pairs of nodes are compared bit by bit. Of the links that a task finds it hands on a forest of the
closest ones, never all pairs of a set, and components are found over those links. Where a similarity is asked for, these
components are only families: the texts of each are compared by their sets of shingles, and components are found anew.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import id_and_text, join_counted, kept
from gridledger.llm.graph import components

#: Fingerprints of a group that one task joins; a larger group is cut into slices, and each pair of slices is a task.
SLICE_ROWS = 200_000
#: Pairs of trie nodes followed at once, and the most pairs of fingerprints below a pair that are compared directly.
FRONTIER, DIRECT = 1_000_000, 32
SHINGLES_AT_ONCE = 100_000
#: Texts, and distinct shingles, of a slice of a family whose texts are compared.
SLICE_TEXTS, SLICE_SHINGLES = 4_000, 2_000_000
#: Texts with at most so many distinct shingles are also found exactly: the bits of fewer shingles spread more.
SHORT = 32


@dataclass(frozen=True)
class Scheme:
    """``bits`` of a fingerprint, a multiple of 64; links differ in at most ``budget`` of them.

    The bits are cut into ``blocks``. Linked fingerprints are looked for where one block differs in at most ``slack``
    bits, so one of its slack + 1 parts is equal. With blocks * (slack + 1) > budget no link can be missed.
    """

    shingle: int
    bits: int
    budget: int
    blocks: int
    slack: int = 0

    def parts(self) -> list[tuple[int, int, int, int]]:
        """For each part: its first bit and width, and the rest of its block as the bits after the part, then those before."""
        edges = np.linspace(0, self.bits, self.blocks + 1).round().astype(int).tolist()
        out = []
        for a, b in zip(edges, edges[1:]):
            cuts = np.linspace(a, b, self.slack + 2).round().astype(int).tolist()
            out += [(x, y - x, a, b - a) for x, y in zip(cuts, cuts[1:])]
        return out

    @property
    def complete(self) -> bool:
        return self.blocks * (self.slack + 1) > self.budget


#: 4-word shingles, 64 bits, at most 4 of them different: complete.
LINKS_OF_FOUR = Scheme(shingle=4, bits=64, budget=4, blocks=5)


def _spread(hashes: np.ndarray, words: int) -> np.ndarray:
    """Each 64-bit hash and, for longer fingerprints, further words mixed from it."""
    out = np.empty((len(hashes), words), dtype=np.uint64)
    out[:, 0] = hashes
    for j in range(1, words):
        z = hashes + np.uint64((0x9E3779B97F4A7C15 * j) & (2 ** 64 - 1))
        z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        out[:, j] = z ^ z >> np.uint64(31)
    return out


def fingerprint_of_set(hashes: np.ndarray, words: int) -> bytes:
    """Fingerprint in which each of the distinct shingles counts once; zeros for none."""
    counts = np.zeros(64 * words, dtype=np.int64)
    for i in range(0, len(hashes), SHINGLES_AT_ONCE):
        some = hashes[i:i + SHINGLES_AT_ONCE]
        bits = np.unpackbits(_spread(some, words).astype(">u8").view(np.uint8).reshape(len(some), 8 * words), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(hashes)).tobytes()


def fingerprint(text: str, shingle: int, words: int) -> bytes:
    """Big-endian fingerprint of the whole text; ASCII letters in lower case, words cut at ASCII white space.

    A text with fewer words than a shingle has one shingle, and one without words a fingerprint of zeros.
    """
    parts = text.encode("utf-8").lower().split()
    if not parts:
        return bytes(8 * words)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(parts))
    n = len(parts) - width + 1
    first, last = starts[:n].tolist(), ends[width - 1:].tolist()
    counts = np.zeros(64 * words, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, SHINGLES_AT_ONCE):
        some = np.array([digest(joined[a:b], 42) for a, b in zip(first[i:i + SHINGLES_AT_ONCE], last[i:i + SHINGLES_AT_ONCE])], dtype=np.uint64)
        bits = np.unpackbits(_spread(some, words).astype(">u8").view(np.uint8).reshape(len(some), 8 * words), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > n).tobytes()


def fingerprints(df: DataFrame, scheme: Scheme, id_col: str = "doc_id", text_col: str = "text", similarity: float | None = None) -> DataFrame:
    """``doc_id, k1, k2, fp, digest, prefix`` per row; k1 and k2 are a 128-bit hash of id and text, to find the row again.

    With a ``similarity`` repeated shingles count once, ``digest`` is a 128-bit hash of their set, else empty, and ``prefix``
    has the ``short_prefix`` of the set, else none.
    """
    words = scheme.bits // 64

    def one(text: str) -> tuple[bytes, bytes, list[int]]:
        if similarity is None:
            return fingerprint(text, scheme.shingle, words), b"", []
        hashes = shingle_hashes(text, scheme.shingle)
        return fingerprint_of_set(hashes, words), xxhash.xxh3_128_digest(hashes.astype("<u8").tobytes()), short_prefix(hashes, similarity).astype(np.int64).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(x.as_py() or "") for x in batch.column(3)]
            new = [pa.array([x[k] for x in found], kind) for k, kind in enumerate((pa.binary(), pa.binary(), pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *new], ["doc_id", "k1", "k2", "fp", "digest", "prefix"])

    rows = id_and_text(df, id_col, text_col).select("doc_id", *row_key("doc_id", "text"), "text")
    return rows.mapInArrow(run, "doc_id long, k1 long, k2 long, fp binary, digest binary, prefix array<long>")


def short_prefix(hashes: np.ndarray, similarity: float) -> np.ndarray:
    """The first hashes of a short set, so many that sets of that similarity share one; none of a set too large for a short one.

    Alike sets share ceil(similarity * n) of the n hashes of either, so they cannot differ in all of the first n - that + 1.
    """
    n = len(hashes)
    if similarity * n > SHORT + 1e-9:
        return hashes[:0]
    return hashes[:n - int(np.ceil(similarity * n - 1e-9)) + 1]


def row_key(id_col: str, text_col: str):
    return F.xxhash64(id_col, text_col).alias("k1"), F.xxhash64(F.lit("row"), text_col, id_col).alias("k2")


def _codes(column, words: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u8").astype(np.uint64).reshape(-1, words)


def _bits_from(codes: np.ndarray, start: int, width: int) -> np.ndarray:
    """``width`` (at most 64) bits of each code from bit ``start``, in the low bits; bits beyond the end are the first again."""
    words = codes.shape[1]
    word, shift = start // 64 % words, start % 64
    out = codes[:, word] << np.uint64(shift)
    if shift:
        out = out | codes[:, (word + 1) % words] >> np.uint64(64 - shift)
    return out >> np.uint64(64 - width)


def _order_key(codes: np.ndarray, part: tuple[int, int, int, int]) -> np.ndarray:
    """The bits that follow the equal part, in the order in which the trie takes them: the rest of the block, then others."""
    start, width, block, block_width = part
    after, before = block + block_width - start - width, start - block
    key, have = np.zeros(len(codes), dtype=np.uint64), 0
    for first, n in ((start + width, after), (block, before), (block + block_width, 64 - after - before)):
        n = min(n, codes.shape[1] * 64 - width - have)
        if n > 0:
            key |= _bits_from(codes, first, n) << np.uint64(64 - have - n)
            have += n
    return key


class TrieJoin:
    """Links within and between sorted ranges of fingerprints, by following pairs of trie nodes."""

    def __init__(self, keys: np.ndarray, codes: np.ndarray, budget: int, slack: int, rest: int):
        self.keys, self.codes, self.budget, self.slack, self.rest = keys, codes, budget, slack, rest
        self.depth_most = min(64, codes.shape[1] * 64 - 1)
        self.ones: dict[int, np.ndarray] = {}

    def _ones(self, depth: int) -> np.ndarray:
        if depth not in self.ones:
            bit = (self.keys >> np.uint64(63 - depth) & np.uint64(1)).astype(np.int32)
            self.ones[depth] = np.concatenate([np.zeros(1, np.int32), np.cumsum(bit, dtype=np.int32)])
        return self.ones[depth]

    def _compare(self, a, ae, b, be) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Links among the fingerprints below pairs of nodes and their differing bits, in blocks of bounded size."""
        rows = np.repeat(np.arange(len(a)), ae - a)
        left = np.arange(len(rows)) - np.repeat(np.cumsum(ae - a) - (ae - a), ae - a) + a[rows]
        low = np.where(a[rows] == b[rows], left + 1, b[rows])                    # within one node each pair once
        sizes = np.maximum(be[rows] - low, 0)
        cuts = np.searchsorted(np.cumsum(sizes), np.arange(FRONTIER, int(sizes.sum()) + FRONTIER, FRONTIER), side="left") + 1
        for i, j in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
            n = sizes[i:j]
            x = np.repeat(left[i:j], n)
            y = np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[i:j], n)
            differ = np.bitwise_count(self.codes[x] ^ self.codes[y]).sum(axis=1, dtype=np.int64)
            near = differ <= self.budget
            yield x[near], y[near], differ[near]

    def links(self, a, ae, b, be) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Links between the ranges [a, ae) and [b, be); equal ranges are joined with themselves."""
        stack = [(0, a, ae, b, be, np.zeros(len(a), dtype=np.int16))]
        while stack:
            depth, a, ae, b, be, differ = stack.pop()
            if len(a) > FRONTIER:
                half = len(a) // 2
                stack += [(depth, a[:half], ae[:half], b[:half], be[:half], differ[:half]), (depth, a[half:], ae[half:], b[half:], be[half:], differ[half:])]
                continue
            end = ((ae - a) * (be - b) <= DIRECT) & (depth >= self.rest) if depth < self.depth_most else np.ones(len(a), dtype=bool)
            if end.any():
                yield from self._compare(a[end], ae[end], b[end], be[end])
                a, ae, b, be, differ = (v[~end] for v in (a, ae, b, be, differ))
            if not len(a):
                continue
            ones = self._ones(depth)
            am, bm, own = ae - (ones[ae] - ones[a]), be - (ones[be] - ones[b]), a == b
            children = [(a, am, b, bm, differ, None), (am, ae, bm, be, differ, None), (a, am, bm, be, differ + 1, None), (am, ae, b, bm, differ + 1, ~own)]
            allowed = min(self.slack, self.budget) if depth < self.rest else self.budget
            new = [[], [], [], [], []]
            for c0, c1, d0, d1, n, also in children:
                ok = (c1 > c0) & (d1 > d0) & (n <= allowed) & ((c0 != d0) | (c1 - c0 > 1))
                ok = ok if also is None else ok & also
                for k, v in enumerate((c0, c1, d0, d1, n)):
                    new[k].append(v[ok])
            stack.append((depth + 1, *(np.concatenate(v) for v in new)))


def _spanning(n: int, x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Which links form the cheapest forest over n indexes: every tree takes its cheapest link out, until none is left."""
    root, taken = np.arange(n), np.zeros(len(x), dtype=bool)
    order = np.empty(len(x), dtype=np.int64)
    order[np.argsort(cost, kind="stable")] = np.arange(len(x))                     # no two links cost the same
    link = np.empty(len(x) + 1, dtype=np.int64)
    link[order] = np.arange(len(x))
    open_ = np.arange(len(x))
    while True:
        a, b = root[x[open_]], root[y[open_]]
        out = a != b
        open_, a, b = open_[out], a[out], b[out]
        if not len(open_):
            return taken
        best = np.full(n, len(x), dtype=np.int64)
        np.minimum.at(best, a, order[open_])
        np.minimum.at(best, b, order[open_])
        tree = np.flatnonzero(best < len(x))
        chosen = link[best[tree]]
        taken[chosen] = True
        p, q = root[x[chosen]], root[y[chosen]]
        other = np.where(p == tree, q, p)
        mutual = (best[other] == best[tree]) & (tree < other)                      # of two trees that choose each other the lower stays
        root[tree] = np.where(mutual, tree, other)
        while not np.array_equal(root[root], root):
            root = root[root]


def _forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the closest links over n indexes, from links that come in blocks."""
    kept_links = [np.zeros(0, np.int64)] * 3
    waiting, size = [], 0
    for block in links:
        waiting.append(block)
        size += len(block[0])
        if size >= FRONTIER:
            x, y, d = (np.concatenate(v) for v in zip(kept_links, *waiting))
            own = _spanning(n, x, y, d)
            kept_links, waiting, size = [x[own], y[own], d[own]], [], 0
    x, y, d = (np.concatenate(v) for v in zip(kept_links, *waiting))
    own = _spanning(n, x, y, d)
    return x[own], y[own]


def _cells(nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """Every node once for each part of its fingerprint: ``part, value, node, fp``."""
    parts, words = scheme.parts(), scheme.bits // 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = _codes(batch.column(1), words)
            for k, (start, width, _, _) in enumerate(parts):
                values = _bits_from(codes, start, width).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), k, dtype=np.int32)), pa.array(values), batch.column(0), batch.column(1)], ["part", "value", "node", "fp"])

    return nodes.select("node", "fp").mapInArrow(run, "part int, value long, node long, fp binary")


def _joined(scheme: Scheme):
    """Joins groups that arrive in order; whole groups are gathered up to a slice, so small ones share the work of a pass."""
    parts, words = scheme.parts(), scheme.bits // 64

    def join(tables: list[pa.Table]) -> pa.RecordBatch:
        table = pa.concat_tables(tables)
        group = np.column_stack([table[c].to_numpy().astype(np.int64) for c in ("part", "value", "i", "j")])
        side, node = table["side"].to_numpy().astype(np.int64), table["node"].to_numpy()
        codes = _codes(table["fp"], words)
        keys = np.zeros(len(node), dtype=np.uint64)
        for k in np.unique(group[:, 0]):
            own = group[:, 0] == k
            keys[own] = _order_key(codes[own], parts[k])
        number = np.concatenate([[0], np.cumsum((group[1:] != group[:-1]).any(axis=1))])
        order = np.lexsort((keys, side, number))
        keys, codes, node, side, number, group = keys[order], codes[order], node[order], side[order], number[order], group[order]
        run = np.flatnonzero(np.concatenate([[True], (number[1:] != number[:-1]) | (side[1:] != side[:-1])]))
        ends = np.append(run[1:], len(node))
        own = group[run, 2] == group[run, 3]
        first = np.flatnonzero(~own & (side[run] == 0))
        first = first[[k + 1 < len(run) and number[run[k + 1]] == number[run[k]] for k in first]] if len(first) else first
        a, ae = np.concatenate([run[own], run[first]]), np.concatenate([ends[own], ends[first]])
        b, be = np.concatenate([run[own], run[first + 1]]), np.concatenate([ends[own], ends[first + 1]])
        rest = {w - width for _, width, _, w in parts}
        trie = TrieJoin(keys, codes, scheme.budget, scheme.slack, max(rest) if scheme.slack else 0)
        x, y = _forest(len(node), trie.links(a, ae, b, be))
        x, y = np.minimum(node[x], node[y]), np.maximum(node[x], node[y])
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if size >= SLICE_ROWS:
                key = [waiting[-1][c][-1].as_py() for c in ("part", "value", "i", "j")]
                same = np.logical_and.reduce([table[c].to_numpy() == k for c, k in zip(("part", "value", "i", "j"), key)])
                cut = int(same.sum())                                               # the rows of the last group come first
                if cut < table.num_rows:
                    yield join([*waiting, table.slice(0, cut)])
                    waiting, size, table = [], 0, table.slice(cut)
            waiting.append(table)
            size += table.num_rows
        if waiting:
            yield join(waiting)

    return run


def linked_nodes(nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """Links ``a, b`` that connect the same nodes as all pairs of fingerprints within the budget; ``nodes`` has ``node, fp``."""
    cells = _cells(nodes, scheme)
    slices = cells.groupBy("part", "value").agg(F.ceil(F.count(F.lit(1)) / F.lit(SLICE_ROWS)).cast("int").alias("slices"))
    large = F.broadcast(slices.where("slices > 1"))                                  # at most parts * 2^width rows, fixed by the scheme
    cut = cells.join(large, ["part", "value"], "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    own = F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    dealt = cut.select("part", "value", "node", "fp", own.alias("own"), other.alias("other")).select(
        "part", "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "fp")
    ordered = dealt.repartition("part", "value", "i", "j").sortWithinPartitions("part", "value", "i", "j")
    return ordered.mapInArrow(_joined(scheme), "a long, b long")


def shingle_set(text: str, shingle: int) -> frozenset:
    """The distinct shingles of a text, as for its fingerprint."""
    parts = text.encode("utf-8").lower().split()
    width = min(shingle, len(parts))
    return frozenset(b" ".join(parts[i:i + width]) for i in range(len(parts) - width + 1)) if parts else frozenset()


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingle_set(text, shingle)), dtype=np.uint64))


def alike(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same sets as all pairs of that Jaccard similarity; two empty sets are alike.

    Each set is compared with all larger ones that may be alike by their sizes and that it is not yet connected to.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    size = np.array([len(s) for s in sets], dtype=np.int64)[order]
    values, flat = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True)
    own = np.split(flat, np.cumsum(size)[:-1])
    holders = np.repeat(np.arange(len(sets)), size)[np.argsort(flat, kind="stable")]      # of each shingle in turn, in order
    ends = np.cumsum(np.bincount(flat, minlength=len(values)))
    after = np.concatenate([[0], ends[:-1]])                                              # those that come after the set in hand
    tops = np.searchsorted(similarity * size, size, side="right")
    tree, x, y = np.arange(len(sets)), [], []
    for i, top in enumerate(tops.tolist()):
        after[own[i]] += 1
        others = np.flatnonzero(tree[i + 1:top] != tree[i]) + i + 1
        if not len(others):
            continue
        met = [holders[a:b] for a, b in zip(after[own[i]].tolist(), ends[own[i]].tolist()) if a < b]
        shared = np.bincount(np.concatenate([[i], *met]), minlength=len(sets))[others]
        for k in others[shared >= similarity * (size[i] + size[others] - shared)].tolist():
            if tree[k] != tree[i]:
                tree[tree == tree[k]] = tree[i]
                x.append(i)
                y.append(k)
    return order[np.array(x, dtype=np.int64)], order[np.array(y, dtype=np.int64)]


def _alike_in_groups(similarity: float):
    """Links among the sets of each group ``g, i, j``, whose rows arrive together."""

    def links(nodes: list, sets: list) -> pa.RecordBatch:
        nodes = np.concatenate(nodes)
        x, y = alike([np.frombuffer(s, dtype="<u8") for s in sets], similarity)
        return pa.RecordBatch.from_arrays([pa.array(nodes[x]), pa.array(nodes[y])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, nodes, sets = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            group = np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in range(3)])
            starts = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]).any(axis=1)])).tolist()
            for a, b in zip(starts, [*starts[1:], len(group)]):
                if last != (key := tuple(group[a].tolist())):
                    if len(sets) > 1:
                        yield links(nodes, sets)
                    last, nodes, sets = key, [], []
                nodes.append(batch.column(3).to_numpy()[a:b])
                sets += batch.column(4).slice(a, b - a).to_pylist()
        if len(sets) > 1:
            yield links(nodes, sets)

    return run


def checked_links(groups: DataFrame, nodes: DataFrame, df: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Links ``a, b`` that connect the same nodes as all pairs of a group with that Jaccard similarity of their shingles.

    ``groups`` has ``g, node``, and ``nodes`` tells by k1 and k2 the row of ``df(doc_id, text)`` that stands for a node. A group
    with more than a task should compare is cut into slices, and each pair of slices is a task: all pairs are compared.
    """
    groups = kept(groups, "groups")
    wanted = nodes.join(groups.select("node").distinct(), "node").select("node", F.col("least.k1").alias("k1"), F.col("least.k2").alias("k2"))
    keyed = df.select(*row_key("doc_id", "text"), F.coalesce("text", F.lit("")).alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_hashes(x.as_py(), shingle).astype("<u8").tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["node", "hashes"])

    texts = keyed.join(wanted, ["k1", "k2"]).dropDuplicates(["node"]).select("node", "text")
    sets = kept(texts.mapInArrow(hashed, "node long, hashes binary"), "shingles")
    shingles = F.sum(F.length("hashes") / 8)
    cuts = F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(SLICE_TEXTS), shingles / F.lit(SLICE_SHINGLES))).cast("int")
    sizes = kept(groups.join(sets, "node").groupBy("g").agg(cuts.alias("slices"), F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    cut = join_counted(groups, sizes, ["g"])
    own = F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("slices") - 1), lambda k: (k != own) | (F.col("slices") == 1))
    pairs = cut.select("g", "node", own.alias("own"), F.explode(others).alias("other"))
    dealt = pairs.join(sets, "node").select("g", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "hashes")
    ordered = dealt.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")
    return ordered.mapInArrow(_alike_in_groups(similarity), "a long, b long")


def families(nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """``g, node`` of the sets of shingles whose fingerprints are equal or linked, as groups of texts to be compared."""
    codes = kept(nodes.groupBy("fp").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("n")), "codes")
    roots = components(linked_nodes(codes, scheme)).select("node", F.col("root").alias("g"))
    named = codes.join(roots, "node", "left").where("g IS NOT NULL OR n > 1").select("fp", "n", F.coalesce("g", "node").alias("g"))
    return join_counted(nodes.select("fp", "node"), kept(named, "families"), ["fp"]).select("g", "node")


def short_groups(nodes: DataFrame) -> DataFrame:
    """``g, node`` of the short sets that share a hash of their prefixes, as groups of texts to be compared."""
    held = kept(nodes.select(F.explode("prefix").alias("g"), "node"), "prefixes")
    shared = kept(held.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared-prefixes")
    return join_counted(held, shared, ["g"]).select("g", "node")


def near_groups(df: DataFrame, scheme: Scheme = LINKS_OF_FOUR, id_col: str = "doc_id", text_col: str = "text", similarity: float | None = None) -> DataFrame:
    """``doc_id, k1, k2, fp, component_id, first``: the smallest id that links reach, and whether the row is the one to stay.

    Null and empty texts have the zero fingerprint and link like any other. The row that stays is the first of its
    component by id (null ids last) and then by hash. Long texts are fingerprinted whole; other columns are not read.
    With a ``similarity`` a node is a set of shingles, whatever fingerprint it shares; the links only make families, and in
    each of these all texts are compared: a link is a pair with that Jaccard similarity of the shingles, at full length. No
    pair with a text of at most ``SHORT`` distinct shingles is missed; of others those with linked fingerprints are found.
    """
    rows = kept(fingerprints(df, scheme, id_col, text_col, similarity), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("k1").alias("k1"), F.col("k2").alias("k2"))
    distinct = rows.groupBy("fp", "digest").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("n"), F.min("prefix").alias("prefix"))
    nodes = kept(distinct.select("fp", "digest", "prefix", "least", "n", F.monotonically_increasing_id().alias("node")), "nodes")
    if similarity is None:
        member = components(linked_nodes(nodes, scheme))
    else:
        groups = families(nodes, scheme).unionByName(short_groups(nodes))
        member = components(checked_links(groups, nodes, id_and_text(df, id_col, text_col), scheme.shingle, similarity))
    linked = kept(nodes.join(member, "node").select("node", "root", "least"), "linked")
    roots = kept(linked.groupBy("root").agg(F.min("least").alias("reached"), F.count(F.lit(1)).alias("n")), "roots")
    moved = join_counted(linked, roots, ["root"]).select("node", "reached")
    whole = kept(nodes.join(moved, "node", "left").select("fp", "digest", "n", F.coalesce("reached", "least").alias("reached")), "reached")
    out = join_counted(rows, whole, ["fp", "digest"])
    first = (F.col("k1") == F.col("reached.k1")) & (F.col("k2") == F.col("reached.k2"))
    return out.select("doc_id", "k1", "k2", "fp", F.col("reached.d").alias("component_id"), first.alias("first"))
