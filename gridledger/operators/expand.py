"""Expansion of requests along the links: items to experiments, links to variables, variables to projects.

A request item may point at an experiment, a group or a whole project.  Instead of testing three columns with OR, the
experiments are listed once under each of their three names and met by a single equi-join.  Repeated requests
collapse before every join, and results are distinct rows, never arrays of unbounded length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.functions.caps import first_tier_passes, preset_passes
from gridledger.scale import list_join, skew_join

KINDS = ["experiment", "exptgroup", "mip"]


def members(experiments: DataFrame, *cols: str) -> DataFrame:
    """Experiments under each name a request may use: ``(esid, kind, expt, …)``."""
    names = F.array(F.struct(F.col("uid").alias("esid"), F.lit("experiment").alias("kind")),
                    F.struct(F.col("egid").alias("esid"), F.lit("exptgroup").alias("kind")),
                    F.struct(F.col("mip").alias("esid"), F.lit("mip").alias("kind")))
    return experiments.select(F.explode(names).alias("n"), F.col("uid").alias("expt"), *cols).select(
        "n.esid", "n.kind", "expt", *cols)


def expand_target(targets: DataFrame, experiments: DataFrame, *cols: str, few: bool = False) -> DataFrame:
    """Rows with an ``esid`` to one row per experiment it stands for; placeholders and empty groups give none.

    ``few`` says that a target has a bounded number of rows; then adaptive execution is enough for large projects.
    """
    m = members(experiments, *cols)
    return skew_join(targets, m, ["esid"], right_keys=None if few else m.select("esid"))


def with_link(items: DataFrame, links: DataFrame, *cols: str | Column, how: str = "inner") -> DataFrame:
    """Item rows with columns of their link, which is met by ``rlid``."""
    l = links.select(F.col("uid").alias("rlid"), *cols)
    return items.join(l, ["rlid"], how)


def meet_groups(left: DataFrame, right: DataFrame, request_vars: DataFrame, keys: Sequence[str] = ("refid",), few: bool = False) -> DataFrame:
    """Joins rows of links (left) with rows of request variables (right) on the group; large groups are dealt into chunks.

    ``few`` says that a group has a bounded number of rows on the left, as one per project; then adaptive execution is enough.
    """
    return skew_join(left, right, keys, right_keys=None if few else request_vars.select(F.col("vgid").alias("refid")))


def meet_by_experiment(left: DataFrame, right: DataFrame, request_vars: DataFrame, keys: Sequence[str] = ("refid",),
                       by_range: Sequence[str] = ()) -> DataFrame:
    """As ``meet_groups`` without the group, dealt by experiment: to group by ``expt``, ``_share`` and ``vid`` takes no further shuffle.

    With ``by_range`` dealt by ranges of those columns of the left before the experiment; they are grouped by then, too.
    """
    return list_join(left, right, keys, "expt", "vid", right_keys=request_vars.select(F.col("vgid").alias("refid")), by_range=by_range)


def meet_by_variable(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("refid",)) -> DataFrame:
    """Rows of request variables (left) with rows of experiments (right) of their group, dealt by variable: to group by ``vid``, ``_share``
    and ``expt`` takes no further shuffle, and what is summed per variable afterwards is shuffled as sums."""
    return list_join(left, right, keys, "vid", "expt")


def copies_once(rows: DataFrame) -> DataFrame:
    """Equal rows once, with their number as ``_copies``: such rows can travel through ``meet_by_experiment`` and its grouping."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))


def copies_again(rows: DataFrame) -> DataFrame:
    """Every row as often as ``_copies`` says."""
    return rows.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))).alias("_copy")).drop("_copies", "_copy")


def target_experiments(targets: DataFrame, experiments: DataFrame, groups: DataFrame, tier_max: int | None = None,
                       full: bool = False) -> DataFrame:
    """``(esid, uid, section)`` of what a target stands for, within the tier limit.

    ``full`` adds the target itself and, for a project, the groups of its experiments; a group passes on its lowest
    tier, a project always.
    """
    t = targets.select("esid").distinct()
    found = expand_target(t, experiments, "egid", "tier", few=True)
    out = found.where(first_tier_passes(F.col("tier"), tier_max)).select(
        "esid", F.col("expt").alias("uid"), F.lit("experiment").alias("section"))
    if not full:
        return out.distinct()
    tier_ok = F.lit(True) if not tier_max or tier_max <= 0 else F.col("tier_min") <= tier_max
    ok_groups = groups.where(tier_ok).select(F.col("uid").alias("egid"))
    # every experiment of a project counts for its groups, also one above the tier limit
    of_mip = found.where(F.col("kind") == "mip").select("esid", "egid").distinct().join(ok_groups, "egid")
    own_group = t.join(ok_groups.withColumnRenamed("egid", "esid"), "esid", "left_semi").select("esid", F.col("esid").alias("egid"))
    group_rows = of_mip.select("esid", "egid").unionByName(own_group).select(
        "esid", F.col("egid").alias("uid"), F.lit("exptgroup").alias("section"))
    mip_rows = found.where(F.col("kind") == "mip").select("esid", F.col("esid").alias("uid"), F.lit("mip").alias("section"))
    return out.unionByName(group_rows).unionByName(mip_rows).distinct()


def item_experiments(items: DataFrame, experiments: DataFrame, tier_max: int | None = None) -> DataFrame:
    """``(item, expt)``: a tier reset up to ``tier_max`` admits every tier, one above it admits nothing."""
    t = items.select(F.col("uid").alias("item"), "esid", "treset")
    if tier_max is not None:
        t = t.where(F.col("treset").isNull() | (F.col("treset") <= tier_max))
    found = expand_target(t, experiments, "tier")
    if tier_max is not None:
        found = found.where(F.col("treset").isNotNull() | first_tier_passes(F.col("tier"), tier_max))
    return found.select("item", "expt").distinct()


def link_experiments(items: DataFrame, experiments: DataFrame, tier_max: int | None = None) -> DataFrame:
    """``(rlid, expt)``: targets collapse per link; one passing reset frees a target from the tier limit."""
    if tier_max is None:
        free = F.lit(0)
        kept = items
    else:
        plain = F.col("treset").isNull() | (F.col("treset") < 0)
        kept = items.where(plain | (F.col("treset") <= tier_max))
        free = F.when(plain, 0).otherwise(1)
    targets = kept.groupBy("rlid", "esid").agg(F.max(free).alias("free"))
    found = expand_target(targets, experiments, "tier")
    return found.where((F.col("free") == 1) | first_tier_passes(F.col("tier"), tier_max)).select("rlid", "expt").distinct()


def experiment_links(items: DataFrame, experiments: DataFrame) -> DataFrame:
    """``(expt, rlid)`` of all request links that serve an experiment."""
    return expand_target(items.select("esid", "rlid").distinct(), experiments).select("expt", "rlid").distinct()


def links_by_experiment(items: DataFrame, links: DataFrame, experiments: DataFrame, pmax: int) -> DataFrame:
    """Items serving an experiment with their link: ``(expt, item, rlid, known)``; ``known`` is false for a placeholder."""
    t = items.where(preset_passes(F.col("preset"), pmax)).select(F.col("uid").alias("item"), "esid", "rlid")
    t = with_link(t, links, F.lit(True).alias("known"), how="left")
    return expand_target(t, experiments).select(
        "expt", "item", "rlid", F.coalesce("known", F.lit(False)).alias("known")).distinct()


def links_with_members(links: DataFrame, expansion: DataFrame) -> DataFrame:
    """Links with an item that asks for at least one ensemble member."""
    live = expansion.where(F.col("members") > 0).select(F.col("rlid").alias("uid")).distinct()
    return links.join(live, "uid", "left_semi")


def mip_experiments(links: DataFrame, items: DataFrame, experiments: DataFrame) -> DataFrame:
    """``(mip, expt)`` through the links of a project."""
    asks = with_link(items.select("rlid", "esid").distinct(), links, F.col("mip").alias("req_mip"))
    return expand_target(asks.select("req_mip", "esid").distinct(), experiments, few=True).select(
        F.col("req_mip").alias("mip"), "expt").distinct()


def mip_items(links: DataFrame, items: DataFrame) -> DataFrame:
    """``(mip, item)`` through the links of a project."""
    return with_link(items.select(F.col("uid").alias("item"), "rlid"), links, "mip").select("mip", "item")


def items_of_mip(items: DataFrame, attr: str, *mips: str) -> DataFrame:
    """Request items by their own project attribute."""
    return items.where(F.col(attr).isin(*mips))


def mip_groups(links: DataFrame, groups: DataFrame) -> DataFrame:
    """Variable groups of a project, by label."""
    pairs = links.select("mip", F.col("refid").alias("uid")).distinct()
    return pairs.join(groups, "uid").select("mip", "uid", "label")


def mip_groups_by_preset(links: DataFrame, items: DataFrame) -> DataFrame:
    """``(mip, preset, refid, valid)``: a preset other than -1, 1, 2, 3 is reported as not valid."""
    asks = with_link(items.select("rlid", "preset").distinct(), links, "mip", "refid")
    return asks.select("mip", "preset", "refid", F.col("preset").isin(-1, 1, 2, 3).alias("valid")).distinct()


# --- variables -----------------------------------------------------------------------------------------

def group_variables(request_vars: DataFrame, pmax: int | None = None) -> DataFrame:
    """``(refid, vid)`` once, within the priority limit."""
    rv = request_vars if pmax is None else request_vars.where(F.col("priority") <= pmax)
    return rv.select(F.col("vgid").alias("refid"), "vid").distinct()


def mip_variables(links: DataFrame, request_vars: DataFrame, pmax: int | None = None) -> DataFrame:
    """``(mip, vid)`` of the variables a project requests."""
    return meet_groups(links.select("mip", "refid").distinct(), group_variables(request_vars, pmax), request_vars, few=True).select("mip", "vid").distinct()


def linkset_variables(links: DataFrame, request_vars: DataFrame, pmax: int) -> DataFrame:
    """``(vid, refid)`` for a set of links.

    A link with option ``priority`` lowers the limit of its group to its own value, unless another link asks for more.
    """
    asked = F.when(F.col("opt") == "priority", F.col("opar")).otherwise(F.lit(3))
    limit = links.groupBy("refid").agg(F.least(F.lit(pmax), F.max(asked)).alias("limit"))
    rv = request_vars.groupBy(F.col("vgid").alias("refid"), "vid").agg(F.min("priority").alias("priority"))
    return meet_groups(limit, rv, request_vars, few=True).where(F.col("priority") <= F.col("limit")).select("vid", "refid")


def experiment_variables(items: DataFrame, links: DataFrame, experiments: DataFrame, request_vars: DataFrame) -> DataFrame:
    """``(expt, vid)`` of everything requested for an experiment."""
    groups = with_link(items.select("rlid", "esid").distinct(), links, "refid")
    pairs = expand_target(groups.select("refid", "esid").distinct(), experiments).select("expt", "refid").distinct()
    return meet_by_experiment(pairs, group_variables(request_vars), request_vars).select("expt", "_share", "vid").distinct().drop("_share")


def variable_mips(links: DataFrame, request_vars: DataFrame) -> DataFrame:
    """``(vid, mip)`` of the projects that request a variable."""
    return mip_variables(links, request_vars).select("vid", "mip")


def variable_mips_by_priority(links: DataFrame, request_vars: DataFrame, serving: DataFrame | None = None) -> DataFrame:
    """As ``variable_mips``, but a link with option ``priority`` counts only if the variable's largest priority value in
    the group is within it.  ``serving(rlid)`` restricts to links that serve an experiment."""
    rv = request_vars.groupBy(F.col("vgid").alias("refid"), "vid").agg(F.max("priority").alias("priority"))
    l = links if serving is None else links.join(serving.select(F.col("rlid").alias("uid")).distinct(), "uid", "left_semi")
    # the most generous link of a project and group decides
    limit = l.groupBy("mip", "refid").agg(
        F.max(F.when(F.col("opt") == "priority", F.col("opar")).otherwise(F.lit(9))).alias("limit"))
    return meet_groups(limit, rv, request_vars, few=True).where(F.col("priority") <= F.col("limit")).select("vid", "mip").distinct()


def variable_mips_both(links: DataFrame, request_vars: DataFrame, serving: DataFrame) -> DataFrame:
    """``(vid, mip, by_experiment)``: requesting projects, flagged if they do so for the serving links."""
    all_ = variable_mips_by_priority(links, request_vars)
    some = variable_mips_by_priority(links, request_vars, serving).withColumn("by_experiment", F.lit(True))
    return all_.join(some, ["vid", "mip"], "left").withColumn("by_experiment", F.coalesce("by_experiment", F.lit(False)))


def missing_mips(variables: DataFrame, covered: DataFrame, mips: DataFrame) -> DataFrame:
    """``(vid, mip)`` of the projects that do not request a variable; the list of projects is a closed vocabulary."""
    have = covered.groupBy("vid").agg(F.collect_set("mip").alias("have"))
    every = mips.agg(F.collect_set("uid").alias("m")).scalar()
    left = variables.select(F.col("uid").alias("vid")).join(have, "vid", "left")
    lacking = F.array_except(every, F.coalesce("have", F.array().cast("array<string>")))
    return left.select("vid", F.explode(lacking).alias("mip"))


def usage_tree(var: DataFrame, variables: DataFrame, covered: DataFrame) -> DataFrame:
    """``(var, variable, mip)``: each quantity with its table variables and their projects; Empty without a project,
    Unused without a table variable."""
    v = variables.select(F.col("uid").alias("vid"), F.col("vid").alias("var_uid"), F.concat_ws(".", "mip_table", "label").alias("variable"))
    used = v.join(covered.select("vid", "mip"), "vid", "left")
    names = var.select(F.col("uid").alias("var_uid"), F.col("label").alias("var"))
    # the many variables of a quantity are the side that can be split, so the unused quantities are added on their own
    rows = used.join(names, ["var_uid"]).select(
        "var", "vid", "variable", F.coalesce("mip", F.lit("Empty")).alias("mip"))
    unused = names.join(v.select("var_uid").distinct(), "var_uid", "left_anti")
    return rows.unionByName(unused.select("var", F.lit(None).cast(rows.schema["vid"].dataType).alias("vid"),
                                          F.lit("Unused").alias("variable"), F.lit(None).cast("string").alias("mip")))


# --- selections ----------------------------------------------------------------------------------------

def selection_rows(selection: str | list[str] | set[str] | dict[str, list[str]]) -> list[tuple[str, str | None]]:
    """A selection as (mip, objective) rows; a missing objective stands for all of them."""
    if isinstance(selection, str):
        return [(selection, None)]
    if isinstance(selection, dict):
        return [(m, o) for m in sorted(selection) for o in (selection[m] or [None])]
    return [(m, None) for m in sorted(selection)]


def parse_selection(text: str, add: str | None = None) -> set[str] | dict[str, list[str]]:
    """``a,b`` is a set of projects (with ``add`` joined to it); ``a:x.y,b`` lists objectives by project."""
    if ":" not in text:
        return set(text.split(",")) | ({add} if add else set())
    out: dict[str, list[str]] = {}
    for part in text.split(","):
        bits = part.split(":")
        if len(bits) > 2:
            raise ValueError(f"cannot read the selection {part}")
        out[bits[0]] = bits[1].split(".") if len(bits) == 2 else []
    return out


def _chosen(mip: Column, names: list[str]) -> Column:
    return mip.isin(names) if names else F.lit(False)


def select_links(links: DataFrame, selection, objectives: DataFrame | None = None, objective_links: DataFrame | None = None,
                 mips: DataFrame | None = None) -> DataFrame:
    """Request links of a selection; TOTAL or None takes all.  With ``mips(uid)`` a name that is no project is an error."""
    if selection is None or selection == "TOTAL":
        return links
    rows = selection_rows(selection)
    if mips is not None:
        asked = sorted({m for m, _ in rows})
        known = {r[0] for r in mips.where(F.col("uid").isin(asked)).select("uid").distinct().collect()}      # at most the names asked for
        if set(asked) - known:
            raise ValueError(f"unknown projects in the selection: {sorted(set(asked) - known)}")
    whole = _chosen(F.col("mip"), [m for m, o in rows if o is None])
    some = [(m, o) for m, o in rows if o is not None]
    if not some:
        return links.where(whole)
    wanted = objectives.sparkSession.createDataFrame(some, "mip string, label string")
    marked = (objective_links.join(objectives.select(F.col("uid").alias("oid"), "label"), "oid")
              .select(F.col("rid").alias("uid"), "label").distinct())
    hit = links.select("uid", "mip").join(marked, "uid").join(F.broadcast(wanted), ["mip", "label"], "left_semi").select("uid").distinct()
    hit = hit.withColumn("hit", F.lit(True))
    return links.join(hit, "uid", "left").where(whole | F.col("hit")).drop("hit")


def unknown_names(spark, selection, mips: DataFrame) -> DataFrame:
    """Names of a selection that are no project."""
    asked = spark.createDataFrame(selection_rows(selection), "label string, objective string").select("label").distinct()
    return asked.join(mips.select("label"), "label", "left_anti")


def allow_deny(experiments: DataFrame, allow: list[str] | None = None, deny: list[str] | None = None) -> DataFrame:
    """Experiments whose label is allowed and not denied; an allow list that is denied as a whole is an error."""
    if allow is not None and deny is not None and not set(allow) - set(deny):
        raise ValueError("no allowed experiment is left after the deny list")
    out = experiments
    if allow is not None:
        out = out.where(F.col("label").isin(list(allow)))
    if deny is not None:
        out = out.where(~F.col("label").isin(list(deny)))
    return out


def experiment_filter(labels: DataFrame, index: DataFrame, experiments: DataFrame) -> DataFrame:
    """Labels of experiments, groups or projects to the experiments they stand for: ``(label, expt)``; ``expt`` is NULL
    for an unknown label."""
    known = index.where(F.col("section").isin(KINDS)).select("label", F.col("uid").alias("esid"))
    asked = labels.select("label").distinct().join(known, "label", "left")
    found = expand_target(asked.where(F.col("esid").isNotNull()), experiments, few=True).select("label", "expt").distinct()
    return asked.select("label").distinct().join(found, "label", "left")


def objective_targets(links: DataFrame, items: DataFrame) -> DataFrame:
    """``(refid, mip, esid, objective)``: what a variable group is requested for."""
    asks = items.select("rlid", "esid").distinct()
    return with_link(asks, links, "mip", "refid", "objective").select(
        "refid", "mip", "esid", "objective").distinct()


def experiments_per_mip(items: DataFrame, experiments: DataFrame, tier_max: int | None = None) -> DataFrame:
    """``(mip, expt)`` by designing project of the experiments some items ask for; a passing reset admits every tier."""
    free = F.lit(False) if tier_max is None else F.coalesce(F.col("treset") <= tier_max, F.lit(False))
    asks = items.groupBy("esid").agg(F.max(free).alias("free"))
    designed = experiments.withColumn("design_mip", F.col("mip"))
    found = expand_target(asks, designed, "tier", "design_mip", few=True)
    if tier_max is not None:
        found = found.where(F.col("free") | (F.element_at("tier", 1) <= tier_max))
    return found.select(F.col("design_mip").alias("mip"), "expt").distinct()
