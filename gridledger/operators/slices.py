"""Time slices: collecting them per variable and experiment, merging, comparing, and the years they stand for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.functions.caps import first_tier_passes, reset_passes
from gridledger.lookup import SLICE_COMPARE_PAIRS, SLICE_PAIRS
from gridledger.operators.expand import expand_target, meet_by_experiment
from gridledger.operators.request import SLICE, Policy, link_items, requested_pairs

SPECIAL_LABELS = sorted({label for labels, *_ in SLICE_PAIRS for label in labels})


def can_compare(ts_type: Column) -> Column:
    """Slices of this type are plain year ranges."""
    return ts_type.isin("simpleRange", "relativeRange") | (ts_type.startswith("branchedYears") & (F.length(ts_type) > 13))


def group_slices(links: DataFrame, items: DataFrame, experiments: DataFrame, policy: Policy, keep_unsliced: bool = True) -> DataFrame:
    """``(refid, expt, slice)`` once each; an item without a slice gives the empty slice."""
    kept = items.where(reset_passes(F.col("treset"), policy.tier_max))
    if not keep_unsliced:
        kept = kept.where(F.col("ts_label").isNotNull())
    asks = link_items(links, kept, policy).select("refid", "esid", *SLICE).distinct()
    able = experiments.where(first_tier_passes(F.col("tier"), policy.tier_max))
    return expand_target(asks, able).select("refid", "expt", *SLICE).distinct()


def variable_slices(links: DataFrame, items: DataFrame, experiments: DataFrame, request_vars: DataFrame, policy: Policy,
                    keep_unsliced: bool = True, shared: bool = False) -> DataFrame:
    """``(vid, expt, slice, priority)``: each slice once with the lowest priority that asks for it.

    ``shared`` keeps the column ``_share``: to merge by vid, expt and it takes no further shuffle.
    """
    wanted = requested_pairs(links, items, request_vars, policy.pmax).groupBy("refid", "vid").agg(F.min("priority").alias("priority"))
    found = meet_by_experiment(group_slices(links, items, experiments, policy, keep_unsliced), wanted, request_vars)
    return found.groupBy("vid", "expt", "_share", *SLICE).agg(F.min("priority").alias("priority")).drop(*[] if shared else ["_share"])


def merge_slices(sliced: DataFrame, keys: Sequence[str] = ("vid", "expt")) -> DataFrame:
    """One slice per key out of its distinct slices, with a return code.

    1 a slice was found (an empty one if any request has no slice), 2 two disjoint ranges, -1 types that do not mix,
    -2 types that cannot be compared, -3 two overlapping ranges, -4 several ranges without a largest one.
    The rows of a key meet in fixed-size aggregates only: counts, extremes and the few specially treated slices.
    """
    whole = F.struct(*SLICE, "priority")
    has = F.col("ts_label").isNotNull()
    length = F.col("ts_end") - F.col("ts_start")
    g = sliced.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(~has, F.col("priority"))).alias("unsliced"),
        F.min("priority").alias("lowest"),
        F.min("ts_type").alias("type_a"), F.max("ts_type").alias("type_b"),
        F.min(F.when(has, whole)).alias("a"), F.max(F.when(has, whole)).alias("b"),
        F.min("ts_start").alias("first_start"),
        F.max(F.when(has, F.struct("ts_end", length.alias("len"), "ts_label", "ts_type", "ts_start", "priority"))).alias("last"),
        *[F.max(F.when(F.col("ts_label") == label, F.struct(*SLICE))).alias(f"is_{label}") for label in SPECIAL_LABELS],
    )
    answer_type = F.struct(
        F.lit(None).cast("string").alias("ts_label"), F.lit(None).cast("string").alias("ts_type"),
        F.lit(None).cast("bigint").alias("ts_start"), F.lit(None).cast("bigint").alias("ts_end"))
    agreed = F.when(F.lit(False), answer_type)
    for names, label, ts_type, start, end in SLICE_PAIRS:
        here = F.col("n") == len(names)
        for name in names:
            here = here & F.col(f"is_{name}").isNotNull()
        if ts_type is None:
            value = F.col(f"is_{label}")
        else:
            value = F.struct(F.lit(label).alias("ts_label"), F.lit(ts_type).alias("ts_type"),
                             F.lit(start).cast("bigint").alias("ts_start"), F.lit(end).cast("bigint").alias("ts_end"))
        agreed = agreed.when(here, value)
    g = g.withColumn("agreed", agreed)

    mixed = (F.col("type_a") != F.col("type_b")) | (F.col("type_a") == "dayList")
    a_in = (F.col("a.ts_start") <= F.col("b.ts_start")) & (F.col("a.ts_end") >= F.col("b.ts_end"))
    b_in = (F.col("b.ts_start") <= F.col("a.ts_start")) & (F.col("b.ts_end") >= F.col("a.ts_end"))
    apart = (F.col("a.ts_end") < F.col("b.ts_start")) | (F.col("b.ts_end") < F.col("a.ts_start"))

    def out(rc: int, label, ts_type, start, end, priority) -> Column:
        return F.struct(F.lit(rc).cast("bigint").alias("rc"), label.alias("ts_label"), ts_type.alias("ts_type"),
                        start.alias("ts_start"), end.alias("ts_end"), priority.alias("priority"))

    def from_struct(rc: int, name: str, priority: Column | None = None) -> Column:
        return out(rc, *[F.col(f"{name}.{c}") for c in SLICE], priority if priority is not None else F.col(f"{name}.priority"))

    null_s, null_i = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    failed = lambda rc: out(rc, null_s, null_s, null_i, null_i, F.col("lowest"))
    merged = (
        F.when(F.col("unsliced").isNotNull(), out(1, null_s, null_s, null_i, null_i, F.col("unsliced")))
        .when(F.col("n") == 1, from_struct(1, "a"))
        .when(mixed & F.col("agreed").isNotNull(), from_struct(1, "agreed", F.col("lowest")))
        .when(mixed, failed(-1))
        .when(~can_compare(F.col("type_a")), failed(-2))
        .when((F.col("n") == 2) & a_in, from_struct(1, "a"))
        .when((F.col("n") == 2) & b_in, from_struct(1, "b"))
        .when((F.col("n") == 2) & apart, from_struct(2, "a"))
        .when(F.col("n") == 2, failed(-3))
        .when(F.col("last.ts_start") == F.col("first_start"),
              out(1, F.col("last.ts_label"), F.col("last.ts_type"), F.col("last.ts_start"), F.col("last.ts_end"), F.col("last.priority")))
        .otherwise(failed(-4))
    )
    other = F.when(F.col("m.rc") == 2, F.col("b"))
    return g.withColumn("m", merged).select(
        *keys, F.col("n").alias("slices"), "m.*",
        *[other[c].alias(f"other_{c[3:]}") for c in SLICE if c != "ts_type"])


def compare_slices(df: DataFrame, a: str = "a_", b: str = "b_") -> DataFrame:
    """Adds ``rc`` and ``answer`` for two slices per row: 0 equal labels, 1 the larger or agreed one, 2 disjoint, negative
    without a solution (as in ``merge_slices``)."""
    x = lambda side, c: F.col(f"{side}{c}")
    low, high = F.least(x(a, "label"), x(b, "label")), F.greatest(x(a, "label"), x(b, "label"))
    agreed = F.when(F.lit(False), F.lit(None).cast("string"))
    for (p, q), answer in SLICE_COMPARE_PAIRS.items():
        agreed = agreed.when((low == p) & (high == q), F.lit(answer))
    mixed = (x(a, "type") != x(b, "type")) | (x(a, "type") == "dayList")
    a_in = (x(a, "start") <= x(b, "start")) & (x(a, "end") >= x(b, "end"))
    b_in = (x(b, "start") <= x(a, "start")) & (x(b, "end") >= x(a, "end"))
    apart = (x(a, "end") < x(b, "start")) | (x(b, "end") < x(a, "start"))
    rc = (F.when(x(a, "label") == x(b, "label"), 0).when(mixed & agreed.isNotNull(), 1).when(mixed, -1)
          .when(~can_compare(x(a, "type")), -2).when(a_in | b_in, 1).when(apart, 2).otherwise(-3))
    answer = (F.when(x(a, "label") == x(b, "label"), x(a, "label")).when(mixed, agreed)
              .when(~can_compare(x(a, "type")), F.lit(None).cast("string"))
              .when(a_in, x(a, "label")).when(b_in, x(b, "label")))
    return df.withColumn("rc", rc.cast("bigint")).withColumn("answer", answer)


def slice_years(merged: DataFrame) -> DataFrame:
    """Adds the output columns of a merged slice: ``n_years`` text, ``slice_type`` and the list ``years``."""
    start, end, t = F.col("ts_start"), F.col("ts_end"), F.col("ts_type")
    span = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))
    both = F.concat(span(start, end), span(F.col("other_start"), F.col("other_end")))
    ranged = F.substring(t, 1, 4).isin("simp", "bran")
    plus = t == "rangeplus"
    union = F.col("rc") == 2
    count = (
        F.when(union, F.size(both).cast("string"))
        .when(ranged, (end + 1 - start).cast("string"))
        .when(plus, F.concat((end + 1 - start).cast("string"), F.lit(".01")))
        .when((F.col("rc") == 1) & F.col("ts_label").isNull(), F.lit("All"))
        .when(F.col("rc") == 1, F.lit("slice"))
        .otherwise(F.lit("All"))
    )
    kind = (F.when(union | ranged, F.lit("")).when(plus, F.concat(F.lit("Partial 1850 + "), start.cast("string"), F.lit(" to "), end.cast("string")))
            .when((F.col("rc") == 1) & F.col("ts_label").isNotNull(), F.col("ts_label")).otherwise(F.lit("")))
    years = (F.when(union, both).when(ranged, span(start, end))
             .when(plus, F.concat(F.array(F.lit(1850).cast("bigint")), span(start, end))))
    return merged.withColumn("n_years", count).withColumn("slice_type", kind).withColumn("years", years)


def slice_priorities(sliced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lowest priority of each slice of a key."""
    return sliced.groupBy(*keys, *SLICE).agg(F.min("priority").alias("priority"))
