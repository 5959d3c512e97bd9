"""One-permutation MinHash fingerprints in column expressions.

Each shingle is hashed once. The top bits of a hash name its bin and every bin keeps its least hash. An empty bin takes the
value of a filled one that it reaches first in a random order of its own (optimal densification), so equal bins of two
texts agree with the probability of their similarity. Only the low bits of each bin are stored, packed into words; the
chance that they agree by accident is taken out of the likeness.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridledger.llm.common import id_and_text, let

BINS, LOW_BITS, SHINGLE = 256, 4, 5
#: Bins that an empty bin tries one by one before all filled bins are ranked; the order is the same either way.
PROBES = 6
RANGES_PER_PARTITION = 4


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """A hash of every run of ``shingle`` words cut at white space; of all words if there are fewer; none without words."""
    words = F.filter(F.split(text, "[ \t\n\r\f\u000b]+"), lambda w: w != "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        last = F.greatest(F.size(h) - shingle + 1, F.lit(1))
        def run(i: Column) -> Column:
            return F.xxhash64(*[F.get(h, i + k) for k in range(shingle)])          # what is beyond the end leaves the hash as it is

        return F.when(F.size(h) > 0, F.transform(F.sequence(F.lit(0), last - 1), run))

    return F.coalesce(let(hashed, runs), F.array().cast("array<bigint>"))


def _bin(x: Column, bins: int) -> Column:
    """The bin of a hash, from its top bits; ascending with the hash."""
    width = bins.bit_length() - 1
    return (F.shiftright(x, 64 - width) + (bins // 2)).cast("int")


def _walk(bin_: Column, bins: int) -> Column:
    """Start and odd step of the affine walk through all bins that an empty bin takes."""
    walk = F.xxhash64(F.lit("walk"), bin_)
    return F.struct(F.pmod(walk, F.lit(bins)).cast("int").alias("start"), F.pmod(F.shiftright(walk, 20).bitwiseOR(F.lit(1)), F.lit(bins)).cast("int").alias("step"))


def bin_values(hashes: Column, bins: int = BINS) -> Column:
    """The value of every bin, empty ones filled; null if there is no hash at all."""

    def least(h: Column) -> Column:
        shift = 64 - (bins.bit_length() - 1)
        top = lambda x: F.shiftright(x, shift)
        return F.filter(h, lambda x, i: F.when(i == 0, F.lit(True)).otherwise(top(x) != top(F.get(h, i - 1))))

    def spread(m: Column) -> Column:
        """Filled bins at their place and nulls between them."""
        nothing = F.lit(None).cast("bigint")

        def with_gap(x: Column, i: Column) -> Column:
            before = F.when(i == 0, F.lit(-1)).otherwise(_bin(F.get(m, i - 1), bins))
            return F.concat(F.array_repeat(nothing, _bin(x, bins) - before - 1), F.array(x))

        tail = F.array_repeat(nothing, F.lit(bins - 1) - _bin(F.element_at(m, -1), bins))
        return F.concat(F.flatten(F.transform(m, with_gap)), tail)

    def filled(m: Column) -> Column:
        def first_of_all(w: Column) -> Column:
            """The filled bin that comes first on a walk: it lies (bin - start) times the inverse of the odd step along it."""
            inverse = w["step"]
            for _ in range(ceil(log2(max(3, bins.bit_length() - 1) / 3))):               # each doubles the 3 bits that are right
                inverse = F.pmod(inverse * (F.lit(2) - F.pmod(w["step"] * inverse, F.lit(bins))), F.lit(bins))
            return let(F.struct(inverse.alias("v"), w["start"].alias("s")), lambda c: F.array_min(F.transform(
                m, lambda y: F.struct(F.pmod((_bin(y, bins) - c["s"]) * c["v"], F.lit(bins)).alias("far"), y.alias("y"))))["y"])

        def taken(d: Column, w: Column) -> Column:
            tries = [F.get(d, F.pmod(w["start"] + F.lit(t) * w["step"], F.lit(bins))) for t in range(PROBES)]
            return F.coalesce(*tries, first_of_all(w))

        def value(d: Column, x: Column, i: Column) -> Column:
            return F.when(x.isNotNull(), x).otherwise(let(_walk(i, bins), lambda w: taken(d, w)))

        return let(spread(m), lambda d: F.transform(d, lambda x, i: value(d, x, i)))

    def whole(h: Column) -> Column:
        return F.when(F.size(h) > 0, let(let(F.sort_array(h), least), filled))

    return let(hashes, whole)


def packed(values: Column, bins: int = BINS, low_bits: int = LOW_BITS) -> Column:
    """The low bits of the bins, 64 to a word, first bin highest; null stays null."""
    per_word = 64 // low_bits
    mask = (1 << low_bits) - 1

    def word(v: Column, w: int) -> Column:
        return F.aggregate(F.slice(v, w * per_word + 1, per_word), F.lit(0).cast("bigint"), lambda a, x: F.shiftleft(a, low_bits).bitwiseOR(x.bitwiseAND(F.lit(mask).cast("bigint"))))

    return let(values, lambda v: F.when(v.isNotNull(), F.array(*[word(v, w) for w in range(bins // per_word)])))


def fingerprint(text: Column, shingle: int = SHINGLE, bins: int = BINS, low_bits: int = LOW_BITS) -> Column:
    """Words of the packed fingerprint; null for a text that is null or has no words."""
    return packed(bin_values(shingle_hashes(text, shingle), bins), bins, low_bits)


def as_text(words: Column) -> Column:
    """Hexadecimal fingerprint; of a text without words the empty string."""
    return F.coalesce(F.array_join(F.transform(words, lambda w: F.lower(F.lpad(F.hex(w), 16, "0"))), ""), F.lit(""))


def likeness(a: Column, b: Column, bins: int = BINS, low_bits: int = LOW_BITS) -> Column:
    """Estimated Jaccard similarity of the shingle sets, 0 to 1, less the agreement that chance gives.

    Two texts without words are alike (1), one without words is unlike any with words (0).
    """
    ones = sum(1 << (i * low_bits) for i in range(64 // low_bits))

    def differing(x: Column) -> Column:
        folded = x
        for s in range(1, low_bits):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, s))
        return F.bit_count(folded.bitwiseAND(F.lit(ones if ones < 1 << 63 else ones - (1 << 64)).cast("bigint")))

    unequal = F.aggregate(F.zip_with(a, b, lambda x, y: differing(x.bitwiseXOR(y))), F.lit(0), lambda s, n: s + n)
    chance = 2.0 ** -low_bits
    corrected = ((F.lit(bins) - unequal) / F.lit(float(bins)) - chance) / (1 - chance)
    return F.when(a.isNull() & b.isNull(), F.lit(1.0)).when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), corrected)))


def _range_of(doc_id: Column, cuts: list) -> Column:
    """How many cut points are at or below the id, by bisection."""
    size = 1 << len(cuts).bit_length()
    table = F.array(*[F.lit(c).cast("bigint") for c in cuts])

    def step(lo: Column, width: Column) -> Column:
        ahead = lo + width
        return F.when((ahead <= len(cuts)) & (F.element_at(table, F.least(ahead, F.lit(len(cuts)))) <= doc_id), ahead).otherwise(lo)

    widths = []
    while size > 1:
        size //= 2
        widths.append(F.lit(size))
    return F.aggregate(F.array(*widths), F.lit(0), step) if cuts else F.lit(0)


def with_next(df: DataFrame) -> DataFrame:
    """``doc_id, text, print`` and the following row's as ``next`` (text, print), in descending order of the id.

    After the last comes the first. Rows that repeat an id are ordered by their text's hash; null ids come last. Ids are
    dealt by range and ordered within each. The top rows of a range are also sent to the range before it, to follow its
    last row. What the driver sees is one number per range, and the session's shuffle partitions set their number.
    """
    ranges = RANGES_PER_PARTITION * max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = df.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10_000)).first()[0]
    cuts = sorted(set(cuts or []))
    own = F.coalesce(_range_of(F.col("doc_id"), cuts), F.lit(-1))
    tops = dict(df.select(own.alias("r"), "doc_id").groupBy("r").agg(F.max("doc_id")).collect())
    present = sorted(tops, reverse=True)
    before = {present[(i + 1) % len(present)]: r for i, r in enumerate(present)}
    span = range(-1, len(cuts) + 1)
    top = F.element_at(F.array(*[F.lit(tops.get(r)).cast("bigint") for r in span]), F.col("r") + 2)
    back = F.element_at(F.array(*[F.lit(before.get(r, r)) for r in span]), F.col("r") + 2)
    rows = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), own.alias("r"))
    here, there = F.struct(F.col("r").alias("at"), F.lit(0).alias("extra")), F.struct(back.alias("at"), F.lit(1).alias("extra"))
    sent = F.when(F.col("doc_id").eqNullSafe(top), F.array(here, there)).otherwise(F.array(here))
    dealt = rows.select("doc_id", "text", F.inline(sent)).repartition("at")
    printed = dealt.select("*", fingerprint(F.col("text")).alias("print"), F.xxhash64("text").alias("th"))
    order = Window.partitionBy("at").orderBy("extra", F.desc_nulls_last("doc_id"), "th")
    return printed.select("doc_id", "text", "print", "extra", F.lead(F.struct("text", "print")).over(order).alias("next")).where("extra = 0").drop("extra")


def edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half is the beginning of the next document's.

    Null is the empty text, which has the empty fingerprint. Texts of any length are used whole; other columns are not read.
    """
    rows = with_next(id_and_text(df, id_col, text_col))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    new = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next.text", F.lit(1), half))
    both = rows.select("doc_id", n.cast("long").alias("n_chars"), "print", F.col("next.print").alias("next_print"), new.alias("new"))
    both = both.select("doc_id", "n_chars", "print", "next_print", F.sha2(F.col("new"), 256).alias("edited_sha256"), fingerprint(F.col("new")).alias("new_print"))
    return both.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("print")).alias("fingerprint"), as_text(F.col("new_print")).alias("edited_fingerprint"),
                       likeness(F.col("print"), F.col("new_print")).alias("near_edited"), likeness(F.col("print"), F.col("next_print")).alias("near_next"))
