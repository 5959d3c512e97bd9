"""Queries along the request path: projects, experiments, links, groups, variables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridledger.operators import expand as X
from gridledger.operators import request as R
from gridledger.operators.states import distinct_at_grains
from gridledger.plans.registry import query
from gridledger.scale import string_set

MEMBERS = """members AS (
SELECT uid AS esid, 'experiment' AS kind, uid AS expt, mip AS design_mip, egid, label, tier1, tier2, ensz1, ensz2, nstart, yps FROM x_experiment
UNION ALL SELECT egid, 'exptgroup', uid, mip, egid, label, tier1, tier2, ensz1, ensz2, nstart, yps FROM x_experiment
UNION ALL SELECT mip, 'mip', uid, mip, egid, label, tier1, tier2, ensz1, ensz2, nstart, yps FROM x_experiment)"""


@query("mip_variables", """
SELECT DISTINCT l.mip, rv.vid FROM x_request_link l JOIN x_request_var rv ON rv.vgid = l.refid WHERE rv.priority <= 1""")
def mip_variables(cat):
    return X.mip_variables(cat["x_request_link"], cat["x_request_var"], 1)


@query("variable_mips", """
WITH vm AS (SELECT DISTINCT rv.vid, l.mip FROM x_request_link l JOIN x_request_var rv ON rv.vgid = l.refid)
SELECT 'variable' AS grain, concat('v', vid) AS uid, string_agg(mip, ',' ORDER BY mip) AS mips FROM vm GROUP BY vid
UNION ALL SELECT 'quantity', q, string_agg(mip, ',' ORDER BY mip) FROM (SELECT DISTINCT v.vid AS q, vm.mip FROM vm JOIN x_cmorvar v ON v.uid = vm.vid) GROUP BY q
UNION ALL SELECT 'group', concat('vg', refid), string_agg(mip, ',' ORDER BY mip) FROM (SELECT DISTINCT refid, mip FROM x_request_link) GROUP BY refid""")
def variable_mips(cat):
    vm = X.variable_mips(cat["x_request_link"], cat["x_request_var"])
    v = cat["x_cmorvar"].select(F.col("uid").alias("vid"), F.col("vid").alias("q"))
    named = lambda c, letter: F.concat(F.lit(letter), F.col(c).cast("string")).alias("uid")
    grain = lambda df, key, name, letter="": df.groupBy(key).agg(string_set("mip").alias("mips")).select(
        F.lit(name).alias("grain"), named(key, letter), "mips")
    # a quantity has many variables, but its set of projects is small: distinct pairs first
    return (grain(vm, "vid", "variable", "v")
            .unionByName(grain(vm.join(v, "vid").select("q", "mip").distinct(), "q", "quantity"))
            .unionByName(grain(cat["x_request_link"].select("refid", "mip").distinct(), "refid", "group", "vg")))


@query("missing_mips", """
WITH vm AS (SELECT DISTINCT rv.vid, l.mip FROM x_request_link l JOIN x_request_var rv ON rv.vgid = l.refid WHERE rv.priority <= 1)
SELECT v.uid AS vid, m.uid AS mip FROM x_cmorvar v CROSS JOIN x_mip m
 WHERE NOT EXISTS (SELECT 1 FROM vm WHERE vm.vid = v.uid AND vm.mip = m.uid)""")
def missing_mips(cat):
    covered = X.mip_variables(cat["x_request_link"], cat["x_request_var"], 1)
    return X.missing_mips(cat["x_cmorvar"], covered, cat["x_mip"])


@query("variable_mips_priority", f"""
WITH {MEMBERS}, rv AS (SELECT vgid, vid, max(priority) AS priority FROM x_request_var GROUP BY vgid, vid),
served AS (SELECT DISTINCT i.rlid FROM x_request_item i JOIN members m ON i.esid = m.esid WHERE m.design_mip = 'm2'),
vm AS (SELECT DISTINCT rv.vid, l.mip FROM x_request_link l JOIN rv ON rv.vgid = l.refid WHERE l.opt <> 'priority' OR rv.priority <= l.opar),
vs AS (SELECT DISTINCT rv.vid, l.mip FROM x_request_link l JOIN rv ON rv.vgid = l.refid JOIN served s ON s.rlid = l.uid
 WHERE l.opt <> 'priority' OR rv.priority <= l.opar)
SELECT vm.vid, vm.mip, vs.vid IS NOT NULL AS by_experiment FROM vm LEFT JOIN vs ON vm.vid = vs.vid AND vm.mip = vs.mip""")
def variable_mips_priority(cat):
    wanted = cat["x_experiment"].where(F.col("mip") == "m2")
    serving = X.experiment_links(cat["x_request_item"], wanted)
    return X.variable_mips_both(cat["x_request_link"], cat["x_request_var"], serving)


@query("item_experiments", f"""
WITH {MEMBERS} SELECT DISTINCT i.uid AS item, m.expt FROM x_request_item i JOIN members m ON i.esid = m.esid
 WHERE CASE WHEN i.treset IS NULL THEN m.tier1 <= 1 ELSE i.treset <= 1 END""")
def item_experiments(cat):
    return X.item_experiments(cat["x_request_item"], cat["x_experiment"], 1)


@query("target_experiments", """
WITH t AS (SELECT DISTINCT esid FROM x_request_item),
e AS (SELECT t.esid, e.uid, 'experiment' AS section FROM t JOIN x_experiment e ON e.uid = t.esid WHERE tier1 <= 2
 UNION SELECT t.esid, e.uid, 'experiment' FROM t JOIN x_experiment e ON e.egid = t.esid WHERE tier1 <= 2
 UNION SELECT t.esid, e.uid, 'experiment' FROM t JOIN x_experiment e ON e.mip = t.esid WHERE tier1 <= 2)
SELECT esid, uid, section FROM e
UNION SELECT t.esid, g.uid, 'exptgroup' FROM t JOIN x_exptgroup g ON g.uid = t.esid WHERE tier_min <= 2
UNION SELECT t.esid, g.uid, 'exptgroup' FROM t JOIN x_experiment e ON e.mip = t.esid JOIN x_exptgroup g ON g.uid = e.egid WHERE tier_min <= 2
UNION SELECT t.esid, m.uid, 'mip' FROM t JOIN x_mip m ON m.uid = t.esid""")
def target_experiments(cat):
    return X.target_experiments(cat["x_request_item"], cat["x_experiment"], cat["x_exptgroup"], 2, full=True).select("esid", "uid", "section")


@query("experiment_variables", f"""
WITH {MEMBERS}, eg AS (SELECT DISTINCT m.expt, l.refid FROM x_request_item i JOIN x_request_link l ON i.rlid = l.uid JOIN members m ON i.esid = m.esid)
SELECT DISTINCT eg.expt, rv.vid FROM eg JOIN x_request_var rv ON rv.vgid = eg.refid""")
def experiment_variables(cat):
    return X.experiment_variables(cat["x_request_item"], cat["x_request_link"], cat["x_experiment"], cat["x_request_var"])


@query("link_experiments_reset", f"""
WITH {MEMBERS}, t AS (SELECT rlid, esid, max(CASE WHEN treset IS NULL OR treset < 0 THEN 0 ELSE 1 END) AS free FROM x_request_item
 WHERE treset IS NULL OR treset < 0 OR treset <= 1 GROUP BY rlid, esid)
SELECT DISTINCT t.rlid, m.expt FROM t JOIN members m ON t.esid = m.esid WHERE t.free = 1 OR m.tier1 <= 1""")
def link_experiments_reset(cat):
    return X.link_experiments(cat["x_request_item"], cat["x_experiment"], 1)


@query("objective_selection", """
SELECT uid, mip, objective FROM x_request_link WHERE (mip = 'm1' AND objective IN ('1-URGENT', '5-LOW')) OR mip = 'm3'""")
def objective_selection(cat):
    chosen = X.select_links(cat["x_request_link"], {"m1": ["1-URGENT", "5-LOW"], "m3": []}, cat["x_objective"], cat["x_objective_link"])
    return chosen.select("uid", "mip", "objective")


@query("unknown_selection_names", """
SELECT a.label FROM (SELECT 'ASIA' AS label UNION SELECT 'EUROPE' UNION SELECT 'ATLANTIS') a WHERE a.label NOT IN (SELECT r_name FROM region)""")
def unknown_selection_names(cat):
    return X.unknown_names(cat.spark, {"ASIA", "EUROPE", "ATLANTIS"}, cat["x_mip"])


@query("objective_crosstab", f"""
WITH k AS (SELECT l.objective, CASE substr(i.esid, 1, 1) WHEN 'e' THEN 'experiment' WHEN 'g' THEN 'exptgroup' WHEN 'm' THEN 'mip' ELSE 'remarks' END AS kind, l.mip
 FROM x_request_item i JOIN x_request_link l ON i.rlid = l.uid),
o AS (SELECT kind, mip, string_agg(DISTINCT objective, ',' ORDER BY objective) AS s FROM k GROUP BY kind, mip)
SELECT kind, max(CASE WHEN mip = 'm0' THEN s END) AS m0, max(CASE WHEN mip = 'm1' THEN s END) AS m1, max(CASE WHEN mip = 'm2' THEN s END) AS m2,
 max(CASE WHEN mip = 'm3' THEN s END) AS m3, max(CASE WHEN mip = 'm4' THEN s END) AS m4 FROM o GROUP BY kind""")
def objective_crosstab(cat):
    t = X.objective_targets(cat["x_request_link"], cat["x_request_item"])
    letter = F.substring("esid", 1, 1)
    kind = F.when(letter == "e", "experiment").when(letter == "g", "exptgroup").when(letter == "m", "mip").otherwise("remarks")
    pairs = t.select(kind.alias("kind"), "mip", "objective").distinct()      # the objectives of a project are a short list
    return pairs.groupBy("kind").pivot("mip", cat.mips()).agg(string_set("objective"))


@query("group_objectives", """
SELECT DISTINCT l.refid, l.mip, i.esid, l.objective FROM x_request_item i JOIN x_request_link l ON i.rlid = l.uid""")
def group_objectives(cat):
    return X.objective_targets(cat["x_request_link"], cat["x_request_item"])


@query("items_for_experiment", f"""
WITH {MEMBERS} SELECT DISTINCT m.expt, i.uid AS item, i.rlid, i.rlid IN (SELECT uid FROM x_request_link) AS known
 FROM x_request_item i JOIN members m ON i.esid = m.esid WHERE i.preset < 0 OR i.preset <= 2""")
def items_for_experiment(cat):
    return X.links_by_experiment(cat["x_request_item"], cat["x_request_link"], cat["x_experiment"], 2)


@query("links_with_members", f"""
WITH {MEMBERS} SELECT l.uid, l.mip FROM x_request_link l WHERE l.uid IN (SELECT i.rlid FROM x_request_item i JOIN members m ON i.esid = m.esid
 WHERE m.tier1 <= 2 AND CASE WHEN i.nenmax < 0 THEN 1 ELSE i.nenmax END > 0)""")
def links_with_members(cat):
    ex = R.item_expansion(cat["x_request_item"], cat["x_experiment"], 2)
    return X.links_with_members(cat["x_request_link"], ex).select("uid", "mip")


@query("mip_experiments", f"""
WITH {MEMBERS} SELECT DISTINCT l.mip, m.expt FROM x_request_item i JOIN x_request_link l ON i.rlid = l.uid JOIN members m ON i.esid = m.esid""")
def mip_experiments(cat):
    return X.mip_experiments(cat["x_request_link"], cat["x_request_item"], cat["x_experiment"])


@query("linkset_variables", """
WITH lim AS (SELECT refid, least(2, max(CASE WHEN opt = 'priority' THEN opar ELSE 3 END)) AS lim FROM x_request_link WHERE mip IN ('m1', 'm2') GROUP BY refid),
rv AS (SELECT vgid, vid, min(priority) AS priority FROM x_request_var GROUP BY vgid, vid)
SELECT rv.vid, rv.vgid AS refid FROM rv JOIN lim ON rv.vgid = lim.refid WHERE rv.priority <= lim.lim""")
def linkset_variables(cat):
    chosen = X.select_links(cat["x_request_link"], {"m1", "m2"})
    return X.linkset_variables(chosen, cat["x_request_var"], 2)


@query("mip_items", "SELECT l.mip, i.uid AS item FROM x_request_item i JOIN x_request_link l ON i.rlid = l.uid")
def mip_items(cat):
    return X.mip_items(cat["x_request_link"], cat["x_request_item"])


@query("items_by_own_project", "SELECT own_mip, uid AS item FROM x_request_item WHERE own_mip IN ('m1', 'm4')")
def items_by_own_project(cat):
    return X.items_of_mip(cat["x_request_item"], "own_mip", "m1", "m4").select("own_mip", F.col("uid").alias("item"))


@query("linkset_groups", """
SELECT DISTINCT l.mip, g.uid, g.label FROM x_request_link l JOIN x_var_group g ON g.uid = l.refid""")
def linkset_groups(cat):
    return X.mip_groups(cat["x_request_link"], cat["x_var_group"]).orderBy("mip", "label")


@query("mip_groups_by_preset", """
SELECT DISTINCT l.mip, i.preset, l.refid, i.preset IN (-1, 1, 2, 3) AS valid FROM x_request_item i JOIN x_request_link l ON i.rlid = l.uid""")
def mip_groups_by_preset(cat):
    return X.mip_groups_by_preset(cat["x_request_link"], cat["x_request_item"])


@query("usage_tree", """
WITH vm AS (SELECT DISTINCT rv.vid, l.mip FROM x_request_link l JOIN x_request_var rv ON rv.vgid = l.refid)
SELECT q.label AS var, v.uid AS vid, coalesce(concat(v.mip_table, '.', v.label), 'Unused') AS variable,
 CASE WHEN v.uid IS NOT NULL THEN coalesce(vm.mip, 'Empty') END AS mip
 FROM x_var q LEFT JOIN x_cmorvar v ON v.vid = q.uid LEFT JOIN vm ON vm.vid = v.uid""")
def usage_tree(cat):
    covered = X.variable_mips(cat["x_request_link"], cat["x_request_var"])
    return X.usage_tree(cat["x_var"], cat["x_cmorvar"], covered)


@query("experiment_links", f"""
WITH {MEMBERS} SELECT DISTINCT m.expt, i.rlid FROM x_request_item i JOIN members m ON i.esid = m.esid""")
def experiment_links(cat):
    return X.experiment_links(cat["x_request_item"], cat["x_experiment"])


@query("mip_experiment_links", f"""
WITH {MEMBERS} SELECT DISTINCT l.mip, m.label AS experiment, l.uid AS link FROM x_request_item i JOIN x_request_link l ON i.rlid = l.uid JOIN members m ON i.esid = m.esid""")
def mip_experiment_links(cat):
    pairs = X.experiment_links(cat["x_request_item"], cat["x_experiment"])
    names = cat["x_experiment"].select(F.col("uid").alias("expt"), F.col("label").alias("experiment"))
    link = cat["x_request_link"].select(F.col("uid").alias("rlid"), "mip")
    return pairs.join(link, "rlid").join(names, "expt").select("mip", "experiment", F.col("rlid").alias("link"))


@query("experiments_per_mip", f"""
WITH {MEMBERS} SELECT 'all' AS kind, m.design_mip AS mip, count(DISTINCT m.expt) AS experiments FROM x_request_item i JOIN members m ON i.esid = m.esid GROUP BY m.design_mip
UNION ALL SELECT 'tier 1 or reset', m.design_mip, count(DISTINCT m.expt) FROM x_request_item i JOIN members m ON i.esid = m.esid
 WHERE m.tier1 <= 1 OR i.treset <= 1 GROUP BY m.design_mip""")
def experiments_per_mip(cat):
    items, e = cat["x_request_item"], cat["x_experiment"]
    n = lambda df, k: df.groupBy("mip").agg(F.count(F.lit(1)).alias("experiments")).select(F.lit(k).alias("kind"), "mip", "experiments")
    return n(X.experiments_per_mip(items, e), "all").unionByName(n(X.experiments_per_mip(items, e, 1), "tier 1 or reset"))


@query("variables_at_grains", """
WITH p AS (SELECT DISTINCT l.mip, rv.vid, v.frequency FROM x_request_link l JOIN x_request_var rv ON rv.vgid = l.refid JOIN x_cmorvar v ON v.uid = rv.vid)
SELECT 'mip,frequency' AS grain, mip, frequency, count(DISTINCT vid) AS n FROM p GROUP BY mip, frequency
UNION ALL SELECT 'mip', mip, NULL, count(DISTINCT vid) FROM p GROUP BY mip UNION ALL SELECT 'frequency', NULL, frequency, count(DISTINCT vid) FROM p GROUP BY frequency
UNION ALL SELECT 'all', NULL, NULL, count(DISTINCT vid) FROM p""")
def variables_at_grains(cat):
    asked = X.mip_variables(cat["x_request_link"], cat["x_request_var"])
    rows = asked.join(cat["x_cmorvar"].select(F.col("uid").alias("vid"), "frequency"), "vid")
    return distinct_at_grains(rows, "vid", [["mip", "frequency"], ["mip"], ["frequency"], []], "mip", "frequency")
