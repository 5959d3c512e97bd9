"""Years requested: item expansion, years by group and by variable, best grid, redundant choices.

All grouping keys are (group, experiment, grid) or (variable, experiment), so no task ever holds the rows of a whole
project; maxima combine on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridledger.functions.caps import cap_years, effective_priority, first_tier_passes, members_for_tier, reset_passes
from gridledger.functions.sizes import choose, default_grid, request_grid
from gridledger.operators.expand import expand_target, meet_by_experiment, meet_by_variable, meet_groups, with_link

# best first
GRID_ORDER = ["native:01", "native", "1deg", "100km", "2deg", "DEF", ""]
SLICE = ["ts_label", "ts_type", "ts_start", "ts_end"]


@dataclass(frozen=True)
class Policy:
    """Options of a request: limits, grid policy and what is kept."""

    tier_max: int = 1
    pmax: int = 1
    force_grid: str | None = None
    default_native: bool = False
    ocean_structured: bool = True
    all_grids: bool = False
    keep_redundant: bool = False
    all_ocean: bool = False


def item_expansion(items: DataFrame, experiments: DataFrame, tier_max: int) -> DataFrame:
    """Each request item once per experiment with starts, years, members and the slice."""
    found = expand_target(items, experiments, "tier", "ensz", "nstart", "yps")
    return found.where(first_tier_passes(F.col("tier"), tier_max)).select(
        F.col("uid").alias("item"), "rlid", "expt", "nstart",
        cap_years(F.col("yps"), F.col("nymax")).alias("years"),
        members_for_tier(F.col("ensz"), F.col("tier"), F.col("nenmax"), tier_max).alias("members"),
        *[c for c in SLICE if c in items.columns])


def item_totals(items: DataFrame, expansion: DataFrame) -> DataFrame:
    """Experiments, years and members in all per item; items without experiments count zero."""
    n = expansion.groupBy("item").agg(F.count(F.lit(1)).alias("experiments"), F.sum(F.col("years") * F.col("nstart")).alias("years"),
                                      F.sum("members").alias("members"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return items.select(F.col("uid").alias("item")).join(n, "item", "left").select(
        "item", zero("experiments"), zero("years"), zero("members"))


def years_of_links(items: DataFrame) -> DataFrame:
    """Sum of the years of the items of each link."""
    return items.groupBy("rlid").agg(F.sum("ny").alias("years"))


def link_items(links: DataFrame, items: DataFrame, policy: Policy, by: Sequence[str] = ()) -> DataFrame:
    """Items with group, grid and, by request, the project of their link."""
    grid = request_grid(F.col("grid"), F.col("gridreq"), policy.force_grid).alias("grid")
    return with_link(items, links, "refid", grid, *[F.col(c).alias(f"req_{c}") for c in by])


def group_years(links: DataFrame, items: DataFrame, experiments: DataFrame, policy: Policy, by: Sequence[str] = (),
                carry: Sequence[str] = ()) -> DataFrame:
    """Largest number of years per (group, experiment, grid).

    Items that ask the same of the same target collapse before they expand.  ``experiments`` may be an allowed subset; ``carry``
    names columns of it to keep, which saves looking up each experiment again.
    """
    keys = ["refid", "grid", *[f"req_{c}" for c in by]]
    asks = (link_items(links, items.where(reset_passes(F.col("treset"), policy.tier_max)), policy, by)
            .select(*keys, "esid", "nymax", "nenmax").distinct())
    able = experiments.where(first_tier_passes(F.col("tier"), policy.tier_max))
    found = expand_target(asks, able, "tier", "ensz", "nstart", "yps", *carry)
    years = (F.col("nstart") * cap_years(F.col("yps"), F.col("nymax"))
             * members_for_tier(F.col("ensz"), F.col("tier"), F.col("nenmax"), policy.tier_max))
    return found.groupBy("expt", *carry, *keys).agg(F.max(years).alias("years"))


def group_flags(links: DataFrame, items: DataFrame, experiments: DataFrame, policy: Policy, by: Sequence[str] = ()) -> DataFrame:
    """Groups that some experiment is asked for through: are their variables taken by their own priority, and does a preset
    admit all of them."""
    keys = ["refid", *[f"req_{c}" for c in by]]
    able = experiments.where(first_tier_passes(F.col("tier"), policy.tier_max))
    reachable = able.select(F.explode(F.array("uid", "egid", "mip")).alias("esid")).distinct().withColumn("reached", F.lit(True))
    asks = items.select("rlid", "esid", "preset", "treset").join(reachable, ["esid"], "left")
    p, reached = F.col("preset"), F.coalesce("reached", F.lit(False)) & reset_passes(F.col("treset"), policy.tier_max)
    flags = with_link(asks, links, "refid", *[F.col(c).alias(f"req_{c}") for c in by]).groupBy(*keys).agg(
        F.max(reached).alias("live"), F.max(p == -1).alias("by_priority"), F.max((p != -1) & (p <= policy.pmax)).alias("admit_all"))
    return flags.where("live").drop("live")


def requested_variables(links: DataFrame, request_vars: DataFrame, presets: DataFrame, pmax: int) -> DataFrame:
    """``(refid, vid)`` pairs that pass the effective priority."""
    rv = request_vars.groupBy(F.col("vgid").alias("refid"), "vid").agg(F.min("priority").alias("priority"))
    return (meet_groups(presets, rv, request_vars, few=True)
            .where(F.col("admit_all") | (F.col("by_priority") & (F.col("priority") <= pmax)))
            .drop("admit_all", "by_priority"))


def requested_pairs(links: DataFrame, items: DataFrame, request_vars: DataFrame, pmax: int) -> DataFrame:
    """``(refid, preset, vid, priority)`` with the priority that counts, for each preset of a group."""
    presets = link_items(links, items.select("rlid", "preset").distinct(), Policy(pmax=pmax)).select("refid", "preset").distinct()
    rv = request_vars.groupBy(F.col("vgid").alias("refid"), "vid").agg(F.min("priority").alias("priority"))
    return (meet_groups(presets, rv, request_vars, few=True)
            .select("refid", "preset", "vid", effective_priority(F.col("preset"), F.col("priority")).alias("priority"))
            .where(F.col("priority") <= pmax))


def wanted_variables(links: DataFrame, items: DataFrame, experiments: DataFrame, request_vars: DataFrame,
                     variables: DataFrame, policy: Policy, by: Sequence[str] = ()) -> DataFrame:
    """``(refid, vid, grid_class)`` of the groups that are asked for: the one walk from items to variables, read by the years
    and by the selection.

    ``variables`` has uid and grid_class; a variable without a class is not sized and drops out.
    """
    wanted = requested_variables(links, request_vars, group_flags(links, items, experiments, policy, by), policy.pmax)
    classed = variables.where(F.col("grid_class").isNotNull()).select(F.col("uid").alias("vid"), "grid_class")
    return wanted.join(classed, ["vid"])


def variable_requests(links: DataFrame, items: DataFrame, experiments: DataFrame, request_vars: DataFrame,
                      variables: DataFrame, policy: Policy, by: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """``(vid, expt, grid, years)`` with one row per group that asks for it; grids settled by the variable's class."""
    group_keys = ["refid", *[f"req_{c}" for c in by]]
    years = group_years(links, items, experiments, policy, by, carry)
    wanted = wanted_variables(links, items, experiments, request_vars, variables, policy, by)
    found = meet_groups(years, wanted, request_vars, group_keys)
    return found.select("vid", "expt", *carry, *group_keys,
                        default_grid(F.col("grid"), F.col("grid_class"), policy.default_native).alias("grid"), "years")


def variable_years(requests: DataFrame, policy: Policy, by: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """Largest number of years per variable and experiment, on the best grid or on every grid.

    The maxima of the few grids share one aggregation, so the best grid needs no shuffle of its own.
    """
    keys = ["vid", "expt", *carry, *[f"req_{c}" for c in by]]
    if policy.all_grids:
        return requests.groupBy(*keys, "grid").agg(F.max("years").alias("years"))
    wide = requests.groupBy(*keys).agg(*[
        F.max(F.when(F.col("grid") == g, F.col("years"))).alias(f"y{i}") for i, g in enumerate(GRID_ORDER)])
    grid = reduce(lambda acc, ig: acc.when(F.col(f"y{ig[0]}").isNotNull(), F.lit(ig[1])), enumerate(GRID_ORDER), F)
    return wide.select(*keys, grid.alias("grid"), F.coalesce(*[f"y{i}" for i in range(len(GRID_ORDER))]).alias("years"))


#: Added to years, so that a better grid outweighs any number of years, negative ones too.
YEARS_BELOW = 1 << 40


def best_years(years: DataFrame, wanted: DataFrame, request_vars: DataFrame, policy: Policy, by: Sequence[str] = (),
               carry: Sequence[str] = (), about: Sequence[str] = (), by_range: Sequence[str] = ()) -> DataFrame:
    """As ``variable_years`` of ``variable_requests``, for the best grid, with the columns ``about`` of ``wanted`` and ``_share``.

    ``years`` comes from ``group_years``, ``wanted`` from ``wanted_variables``.  Pairs meet by experiment: to group by vid, expt and ``_share``
    takes no further shuffle.  Grid and years are one number, so a pair is one maximum.  ``by_range`` names columns out of ``by`` and ``carry``
    by whose ranges the pairs are dealt.
    """
    group_keys = ["refid", *[f"req_{c}" for c in by]]
    by_class = wanted.select(*group_keys, "vid", *about, default_grid(F.lit("DEF"), F.col("grid_class"), policy.default_native).alias("_default"))
    pairs = meet_by_experiment(years, by_class, request_vars, group_keys, by_range)
    grid = F.when(F.col("grid") == "DEF", F.col("_default")).otherwise(F.coalesce("grid", "_default"))
    rank = choose(grid, {g: i for i, g in enumerate(reversed(GRID_ORDER))}).cast("bigint")
    weight = rank * (2 * YEARS_BELOW) + F.col("years").cast("bigint") + YEARS_BELOW
    keys = ["vid", "expt", *carry, *group_keys[1:], "_share", *about]
    best = pairs.groupBy(*keys).agg(F.max(weight).alias("_best"))
    grids = F.array(*[F.lit(g) for g in reversed(GRID_ORDER)])
    return best.select(*keys, F.get(grids, F.shiftright("_best", 41).cast("int")).alias("grid"),
                       (F.pmod("_best", F.lit(2 * YEARS_BELOW)) - YEARS_BELOW).cast(years.schema["years"].dataType).alias("years"))


def best_years_by_variable(years: DataFrame, wanted: DataFrame, policy: Policy, by: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """As ``best_years``, with the pairs dealt by variable: the experiments of a group travel as a list to each of its variables.

    Nothing is known of a variable but its class, and what is summed per variable has few rows in each task.  Grid and years travel
    as one number; a grid that the class settles is settled where the pairs arise.
    """
    group_keys = ["refid", *[f"req_{c}" for c in by]]
    ranks = {g: i for i, g in enumerate(reversed(GRID_ORDER))}
    default = choose(default_grid(F.lit("DEF"), F.col("grid_class"), policy.default_native), ranks).cast("bigint")
    asked = choose(F.coalesce("grid", F.lit("DEF")), ranks).cast("bigint") * (2 * YEARS_BELOW) + F.col("years").cast("bigint") + YEARS_BELOW
    pairs = meet_by_variable(wanted.select(*group_keys, "vid", default.alias("_default")),
                             years.select(*group_keys, "expt", *carry, asked.alias("_asked")), group_keys)
    settled = F.when(F.shiftright("_asked", 41) == ranks["DEF"], F.col("_asked") + (F.col("_default") - ranks["DEF"]) * (2 * YEARS_BELOW)).otherwise(F.col("_asked"))
    keys = ["vid", "expt", *carry, *group_keys[1:]]
    best = pairs.groupBy(*keys, "_share").agg(F.max(settled).alias("_best"))
    grids = F.array(*[F.lit(g) for g in reversed(GRID_ORDER)])
    return best.select(*keys, F.get(grids, F.shiftright("_best", 41).cast("int")).alias("grid"),
                       (F.pmod("_best", F.lit(2 * YEARS_BELOW)) - YEARS_BELOW).cast(years.schema["years"].dataType).alias("years"))


def _ranked(selected: DataFrame, choices: DataFrame, by: Sequence[str]) -> DataFrame:
    """Each selected variable once per choice group it is in, and whether it ranks below another selected one there.

    A variable in no choice group stands in one of its own.  Groups are few variables each.
    """
    own = F.coalesce(F.col("cid"), F.concat(F.lit("alone "), F.col("vid").cast("string")))
    chosen = selected.select("vid", *by).distinct().join(choices.select("vid", "cid", "rank"), "vid", "left").withColumn("cid", own)
    top = F.max("rank").over(Window.partitionBy("cid", *by))
    return chosen.select("vid", *by, F.coalesce(F.col("rank") < top, F.lit(False)).alias("low"))


def redundant_variables(selected: DataFrame, choices: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Selected variables that rank below another selected one in a choice group.  Equal ranks all stay."""
    return _ranked(selected, choices, by).where("low").select("vid", *by).distinct()


def kept_variables(selected: DataFrame, choices: DataFrame | None, by: Sequence[str] = ()) -> DataFrame:
    """Selected variables without the redundant ones; without ``choices`` all stay.  One row per variable and ``by``."""
    if choices is None:
        return selected.select("vid", *by).distinct()
    return _ranked(selected, choices, by).groupBy("vid", *by).agg(F.max("low").alias("low")).where(~F.col("low")).drop("low")


def drop_by_configuration(selected: DataFrame, choices: DataFrame, settings: DataFrame | None = None) -> DataFrame:
    """Selected variables without those whose flag differs from the setting of their choice group (true by default)."""
    flagged = choices.select("vid", "cid", "cfg")
    if settings is not None:
        flagged = flagged.join(settings.select("cid", F.col("cfg").alias("wanted")), ["cid"], "left")
    else:
        flagged = flagged.withColumn("wanted", F.lit(True))
    wrong = flagged.where(F.col("cfg") != F.coalesce("wanted", F.lit(True))).select("vid").distinct()
    return selected.join(wrong, "vid", "left_anti")


def selected_variables(links: DataFrame, items: DataFrame, experiments: DataFrame, request_vars: DataFrame,
                       variables: DataFrame, policy: Policy, by: Sequence[str] = ()) -> DataFrame:
    """The variables that ``variable_requests`` reaches, found from groups alone without the experiments' rows."""
    wanted = wanted_variables(links, items, experiments, request_vars, variables, policy, by)
    return wanted.select("vid", *[f"req_{c}" for c in by]).distinct()


def intersection(selected: DataFrame, mips: DataFrame) -> DataFrame:
    """Variables requested by every one of the projects; ``selected`` has one row per variable and project."""
    n_mips = mips.agg(F.count(F.lit(1))).scalar()
    return selected.groupBy("vid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == n_mips).select("vid")
