import itertools
import random
from decimal import Decimal as D

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridledger import scale
from gridledger.operators import expand as X
from gridledger.operators import gridstats as G, links as L, request as R, revise as E, search as S, slices as I, volume as V, wide as T

# --- links ---------------------------------------------------------------------------------------------


@pytest.fixture
def graph(table):
    sections = {
        "var": table("uid string, label string, sn string", [("v1", "tas", "n1"), ("v2", "pr", "gone"), ("v3", "ps", "__unset__")]),
        "name": table("uid string, label string, members array<string>", [("n1", "air", ["v1", "v2"]), ("n2", "sea", [])]),
        "remarks": table("uid string, label string", [("r1", "note")]),
    }
    return sections, L.edges(sections, {"var": {"sn": "scalar"}, "name": {"members": "list"}}), L.uid_index(sections)


def test_edges_and_integrity(graph):
    _, edge, index = graph
    assert rows(edge) == [("name", "n1", "members", "v1"), ("name", "n1", "members", "v2"), ("var", "v1", "sn", "n1"), ("var", "v2", "sn", "gone")]
    assert rows(L.dangling(edge, index), "src_uid", "dst_uid") == [("v2", "gone")]
    assert rows(L.bad_link_counts(edge, index), "src_section", "links", "bad") == [("name", 2, 0), ("var", 2, 1)]
    assert rows(L.linked(index, edge), "uid") == [("n1",), ("v1",), ("v2",)]
    assert rows(L.unlinked(index, edge, ["name"]), "uid") == [("n1",), ("n2",), ("r1",), ("v3",)]
    assert rows(L.duplicates(index.unionByName(index.where("uid = 'v1'")), "uid")) == [("v1", 2)]
    assert rows(L.referrers(edge, index, index.where("uid = 'v1'")), "dst_uid", "src_section", "src_label") == [("v1", "name", "air")]


def test_lookup_and_summary(graph, table):
    sections, _, index = graph
    df = table("uid string, a string", [("x", "v1"), ("y", "r1"), ("z", "none")])
    assert rows(L.resolve(df, "a", index), "uid", "a_section", "a_label") == [("x", "var", "tas"), ("y", "remarks", "note"), ("z", None, None)]
    assert rows(L.drop_placeholders(df, "a", index), "uid") == [("x",)]
    assert rows(L.record_summary(sections["var"], index, ["sn"], ["label"]), "uid", "attr", "target") == [
        ("v1", "label", None), ("v1", "sn", "[name]air"), ("v2", "label", None), ("v2", "sn", "key not found"), ("v3", "label", None), ("v3", "sn", "key not found")]
    last = L.last_by_label(table("label string, uid string, pos bigint", [("a", "u1", 1), ("a", "u2", 2), ("b", "u3", 3)]), "pos")
    assert rows(last, "label", "uid") == [("a", "u2"), ("b", "u3")]


def test_backlinks(table):
    t, first = table("uid string", [("s",), ("t",)]), table("uid string, dst string", [("a", "s"), ("b", "s")])
    assert rows(L.backlink_counts(t, first, table("dst string", [("a",), ("a",), ("b",)]))) == [("s", 2, 3), ("t", 0, 0)]


# --- request path --------------------------------------------------------------------------------------


@pytest.fixture
def world(table):
    experiments = table("uid string, egid string, mip string, label string, tier array<bigint>, ensz array<bigint>, nstart bigint, yps bigint", [
        ("e1", "g1", "m1", "hist", [1], [2], 1, 100), ("e2", "g1", "m2", "future", [2, 3], [4, 8], 1, 50), ("e3", "g2", "m2", "idle", [3], [1], 2, 10)])
    links = table("uid string, mip string, refid string, grid string, gridreq string, opt string, opar bigint, objective string", [
        ("l1", "m1", "vg1", "1deg", "", "", 1, "o1"), ("l2", "m2", "vg1", "", "No", "priority", 1, "o2"), ("l3", "m2", "vg2", "", "", "", 1, "o1"), ("l4", "m3", "vg3", "", "", "", 1, "o1")])
    items = table("uid string, rlid string, esid string, ny bigint, nymax bigint, nenmax bigint, treset bigint, preset bigint, ts_label string, ts_type string, ts_start bigint, ts_end bigint", [
        ("i1", "l1", "e1", 5, -1, -1, None, -1, None, None, None, None),
        ("i2", "l1", "g1", 5, 20, 1, None, -1, "a", "simpleRange", 1, 5),
        ("i3", "l2", "m2", 5, -1, -1, 1, 1, "b", "simpleRange", 3, 9),
        ("i4", "l3", "e3", 5, -1, -1, 5, -1, None, None, None, None),
        ("i5", "gone", "e1", 5, -1, -1, None, -1, None, None, None, None),
        ("i6", "l3", "r1", 5, -1, -1, None, 2, None, None, None, None)])
    rv = table("vgid string, vid string, priority bigint", [("vg1", "v1", 1), ("vg1", "v2", 2), ("vg2", "v2", 1), ("vg2", "v3", 3)])
    variables = table("uid string, grid_class string", [("v1", "o"), ("v2", "a"), ("v3", "a")])
    return experiments, links, items, rv, variables


def test_expansion_of_targets(world):
    experiments, links, items, rv, _ = world
    assert rows(X.item_experiments(items, experiments)) == [("i1", "e1"), ("i2", "e1"), ("i2", "e2"), ("i3", "e2"), ("i3", "e3"), ("i4", "e3"), ("i5", "e1")]
    # tier 1: a reset of 1 admits all tiers, one of 5 admits nothing
    assert rows(X.item_experiments(items, experiments, 1)) == [("i1", "e1"), ("i2", "e1"), ("i3", "e2"), ("i3", "e3"), ("i5", "e1")]
    assert rows(X.link_experiments(items, experiments, 1)) == [("gone", "e1"), ("l1", "e1"), ("l2", "e2"), ("l2", "e3")]
    assert rows(X.experiment_variables(items, links, experiments, rv)) == [
        ("e1", "v1"), ("e1", "v2"), ("e2", "v1"), ("e2", "v2"), ("e3", "v1"), ("e3", "v2"), ("e3", "v3")]
    assert rows(X.mip_experiments(links, items, experiments)) == [("m1", "e1"), ("m1", "e2"), ("m2", "e2"), ("m2", "e3")]


def test_variables_of_selections(world):
    _, links, items, rv, _ = world
    assert rows(X.mip_variables(links, rv, 1)) == [("m1", "v1"), ("m2", "v1"), ("m2", "v2")]
    # vg1 is limited to priority 1 by l2 alone, but l1 asks for more
    assert rows(X.linkset_variables(links, rv, 2)) == [("v1", "vg1"), ("v2", "vg1"), ("v2", "vg2")]
    assert rows(X.linkset_variables(links.where("uid = 'l2'"), rv, 2)) == [("v1", "vg1")]
    assert rows(X.variable_mips_by_priority(links, rv)) == [("v1", "m1"), ("v1", "m2"), ("v2", "m1"), ("v2", "m2"), ("v3", "m2")]
    assert rows(X.mip_groups_by_preset(links, items)) == [("m1", -1, "vg1", True), ("m2", -1, "vg2", True), ("m2", 1, "vg1", True), ("m2", 2, "vg2", True)]


def test_selection_forms(world, table):
    _, links, *_ = world
    objectives, marks = table("uid string, label string, mip string", [("O1", "o1", "m2"), ("O2", "o2", "m2")]), table("oid string, rid string", [("O1", "l3"), ("O2", "l2")])
    pick = lambda s: [r[0] for r in rows(X.select_links(links, s, objectives, marks), "uid")]
    assert pick("TOTAL") == ["l1", "l2", "l3", "l4"] and pick("m2") == ["l2", "l3"] and pick({"m1", "m3"}) == ["l1", "l4"]
    assert pick({"m1": [], "m2": ["o1"]}) == ["l1", "l3"]
    known = table("uid string", [("m1",), ("m2",)])
    assert X.select_links(links, {"m1", "m2"}, mips=known).count() == 3
    with pytest.raises(ValueError, match="m9"):
        X.select_links(links, {"m1", "m9"}, mips=known)
    assert X.parse_selection("a,b", add="c") == {"a", "b", "c"} and X.parse_selection("a:x.y,b") == {"a": ["x", "y"], "b": []}
    with pytest.raises(ValueError):
        X.parse_selection("a:b:c")
    with pytest.raises(ValueError):
        X.allow_deny(links, ["a"], ["a"])


def test_usage_and_missing(world, table):
    _, links, _, rv, _ = world
    covered = X.variable_mips(links, rv)
    var = table("uid string, label string", [("q1", "tas"), ("q2", "old")])
    v = table("uid string, vid string, mip_table string, label string", [("v1", "q1", "Amon", "tas"), ("v9", "q1", "day", "tas")])
    assert rows(X.usage_tree(var, v, covered), "var", "variable", "mip") == [("old", "Unused", None), ("tas", "Amon.tas", "m1"), ("tas", "Amon.tas", "m2"), ("tas", "day.tas", "Empty")]
    mips = table("uid string", [("m1",), ("m2",), ("m3",)])
    assert rows(X.missing_mips(v, covered, mips)) == [("v1", "m3"), ("v9", "m1"), ("v9", "m2"), ("v9", "m3")]


def test_years(world):
    experiments, links, items, rv, variables = world
    p = R.Policy(tier_max=2, pmax=1)
    assert rows(R.group_years(links, items, experiments, p), "refid", "expt", "grid", "years") == [
        ("vg1", "e1", "1deg", 200), ("vg1", "e2", "1deg", 20), ("vg1", "e2", "native", 200)]
    # preset 1 of l2 admits all of vg1, also priority 2
    req = R.variable_requests(links, items, experiments, rv, variables, p)
    assert rows(R.variable_years(req, p)) == [("v1", "e1", "1deg", 200), ("v1", "e2", "native", 200), ("v2", "e1", "1deg", 200), ("v2", "e2", "native", 200)]
    every = R.Policy(tier_max=2, pmax=1, all_grids=True)
    assert len(rows(R.variable_years(req, every))) == 6
    assert rows(R.selected_variables(links, items, experiments, rv, variables, p)) == [("v1",), ("v2",)]
    totals = R.item_totals(items, R.item_expansion(items, experiments, 2))
    assert rows(totals) == [("i1", 1, 100, 2), ("i2", 2, 40, 2), ("i3", 1, 50, 4), ("i4", 0, 0, 0), ("i5", 1, 100, 2), ("i6", 0, 0, 0)]


def test_choices(table):
    choices = table("vid string, cid string, rank bigint", [("a", "c1", 1), ("b", "c1", 2), ("c", "c1", 2), ("d", "c2", 1), ("b", "c3", 1), ("e", "c3", 5)])
    sel = lambda *xs: table("vid string", [(x,) for x in xs])
    red = lambda *xs: [r[0] for r in rows(R.redundant_variables(sel(*xs), choices))]
    assert red("a") == [] and red("a", "b") == ["a"] and red("b", "c") == [] and red("a", "b", "e", "z") == ["a", "b"]
    flags = table("vid string, cid string, cfg boolean", [("a", "c1", True), ("b", "c1", False), ("c", "c2", False)])
    settings = table("cid string, cfg boolean", [("c2", False)])
    assert rows(R.drop_by_configuration(sel("a", "b", "c", "x"), flags, settings)) == [("a",), ("c",), ("x",)]
    assert rows(R.drop_by_configuration(sel("a", "b", "c", "x"), flags)) == [("a",), ("x",)]


# --- slices --------------------------------------------------------------------------------------------

SCHEMA = "vid string, expt string, ts_label string, ts_type string, ts_start bigint, ts_end bigint, priority bigint"
CASES = {
    "single": ([("a", "simpleRange", 1, 5, 2)], (1, "a", 1, 5, 2)),
    "unsliced wins": ([("a", "simpleRange", 1, 5, 1), (None, None, None, None, 3)], (1, None, None, None, 3)),
    "nested": ([("a", "simpleRange", 1, 9, 2), ("b", "simpleRange", 3, 5, 1)], (1, "a", 1, 9, 2)),
    "nested the other way": ([("a", "simpleRange", 3, 5, 2), ("b", "simpleRange", 1, 9, 1)], (1, "b", 1, 9, 1)),
    "equal": ([("b", "simpleRange", 1, 5, 2), ("a", "simpleRange", 1, 5, 1)], (1, "a", 1, 5, 1)),
    "disjoint": ([("a", "simpleRange", 1, 3, 2), ("b", "simpleRange", 5, 6, 1)], (2, "a", 1, 3, 2)),
    "overlap": ([("a", "simpleRange", 1, 5, 2), ("b", "simpleRange", 3, 9, 1)], (-3, None, None, None, 1)),
    "three nested": ([("a", "relativeRange", 1, 9, 2), ("b", "relativeRange", 3, 5, 1), ("c", "relativeRange", 1, 4, 1)], (1, "a", 1, 9, 2)),
    "three without order": ([("a", "simpleRange", 1, 4, 2), ("b", "simpleRange", 3, 9, 1), ("c", "simpleRange", 2, 4, 1)], (-4, None, None, None, 1)),
    "mixed known": ([("RFMIP", "dayList", None, None, 2), ("hist55", "simpleRange", 1960, 2014, 1)], (1, "hist55plus", 1960, 2014, 1)),
    "day lists": ([("RFMIP", "dayList", None, None, 2), ("RFMIP2", "dayList", None, None, 3)], (1, "RFMIP-union", None, None, 2)),
    "mixed with the larger": ([("RFMIP2", "dayList", None, None, 2), ("hist55", "simpleRange", 1960, 2014, 1)], (1, "hist55", 1960, 2014, 1)),
    "controls": ([("piControl030a", "branchedYears:x", 1, 30, 2), ("piControl200", "simpleRange", 1, 200, 3)], (1, "piControl200", 1, 200, 2)),
    "mixed unknown": ([("x", "dayList", None, None, 2), ("y", "simpleRange", 1, 2, 1)], (-1, None, None, None, 1)),
    "no range": ([("x", "startRange", 1, 2, 2), ("y", "startRange", 1, 3, 1)], (-2, None, None, None, 1)),
    "branched years": ([("x", "branchedYears:a", 1, 9, 2), ("y", "branchedYears:a", 2, 3, 1)], (1, "x", 1, 9, 2)),
}


def test_slice_merge_in_any_order(table):
    data = [(name, str(k), *s) for name, (slices, _) in CASES.items() for k, order in enumerate(itertools.permutations(slices)) for s in order]
    random.Random(3).shuffle(data)
    got = rows(I.merge_slices(table(SCHEMA, data)), "vid", "rc", "ts_label", "ts_start", "ts_end", "priority")
    for row in got:
        assert row[1:] == CASES[row[0]][1], row[0]
    assert {r[0] for r in got} == set(CASES)


def test_slice_years(table):
    data = [(n, "e", *s) for n in ("single", "disjoint", "mixed known", "day lists", "unsliced wins") for s in CASES[n][0]]
    got = {r[0]: r[1:] for r in rows(I.slice_years(I.merge_slices(table(SCHEMA, data))), "vid", "n_years", "slice_type", "years")}
    assert got["single"] == ("5", "", [1, 2, 3, 4, 5]) and got["disjoint"] == ("5", "", [1, 2, 3, 5, 6])
    assert got["mixed known"] == ("55.01", "Partial 1850 + 1960 to 2014", [1850, *range(1960, 2015)])
    assert got["day lists"] == ("slice", "RFMIP-union", None) and got["unsliced wins"] == ("All", "", None)


@pytest.mark.parametrize("a,b,expected", [
    (("x", "simpleRange", 1, 2), ("x", "simpleRange", 5, 9), (0, "x")), (("x", "simpleRange", 1, 9), ("y", "simpleRange", 2, 3), (1, "x")),
    (("x", "simpleRange", 2, 3), ("y", "simpleRange", 1, 9), (1, "y")), (("x", "simpleRange", 1, 2), ("y", "simpleRange", 4, 9), (2, None)),
    (("x", "simpleRange", 1, 5), ("y", "simpleRange", 4, 9), (-3, None)), (("hist55", "simpleRange", 1960, 2014), ("RFMIP", "dayList", None, None), (1, "hist55plus")),
    (("x", "simpleRange", 1, 5), ("y", "relativeRange", 4, 9), (-1, None)), (("x", "startRange", 1, 5), ("y", "startRange", 4, 9), (-2, None)),
])
def test_slice_compare(table, a, b, expected):
    df = table("a_label string, a_type string, a_start bigint, a_end bigint, b_label string, b_type string, b_start bigint, b_end bigint", [(*a, *b)])
    assert rows(I.compare_slices(df), "rc", "answer") == [expected]


def test_variable_slices(world):
    experiments, links, items, rv, _ = world
    got = rows(I.variable_slices(links, items, experiments, rv, R.Policy(tier_max=2, pmax=1)), "vid", "expt", "ts_label", "priority")
    assert got == [("v1", "e1", None, 1), ("v1", "e1", "a", 1), ("v1", "e2", "a", 1), ("v1", "e2", "b", 1),
                   ("v2", "e1", None, 1), ("v2", "e1", "a", 1), ("v2", "e2", "a", 1), ("v2", "e2", "b", 1)]


# --- volumes -------------------------------------------------------------------------------------------


def test_difference(table):
    first = table("k string, years bigint", [("equal", 5), ("larger", 9), ("smaller", 2)])
    second = table("k string, years bigint", [("equal", 5), ("larger", 3), ("smaller", 7), ("new", 4)])
    assert rows(V.one_sided_difference(first, second, ["k"], "years")) == [("new", 4), ("smaller", 5)]


def test_unique_years_equals_the_definition(spark, table):
    rng = random.Random(7)
    data = sorted({(f"v{rng.randrange(4)}", f"e{rng.randrange(3)}", rng.choice(["native:01", "native", "1deg", "2deg"]), rng.randrange(1, 4), f"m{rng.randrange(4)}") for _ in range(60)})

    def best(rows_):
        out = {}
        for v, e, g, y, _ in rows_:
            out.setdefault((v, e), {}).setdefault(g, []).append(y)
        return {(v, e, g): max(gs[g]) for (v, e), gs in out.items() for g in [min(gs, key=R.GRID_ORDER.index)]}

    total, expected = best(data), []
    for m in sorted({d[4] for d in data}):
        others = best([d for d in data if d[4] != m])
        expected += [(m, *k, y - others.get(k, 0)) for k, y in total.items() if y > others.get(k, 0)]
    df = table("vid string, expt string, grid string, years bigint, req_mip string", data)
    assert rows(V.unique_years(R.variable_years(df, R.Policy(), ["mip"]), R.Policy())) == sorted(expected)


def test_reconcile_top_and_matrix(table):
    parts = table("way string, hundredths decimal(38,0)", [("a", D(100)), ("a", D(50)), ("b", D(150))])
    assert rows(V.reconcile(parts)) == [(2, 1.5, 1.5, True)]
    assert rows(V.reconcile(parts.union(parts.where("way = 'a'").limit(1))), "agree") == [(False,)]
    v = table("vid string, volume double", [("a", 1.0), ("b", 3.0), ("c", 3.0)])
    assert [r["vid"] for r in V.top_variables(v, 2, "vid").collect()] == ["b", "c"] and len(V.top_variables(v, 0, "vid").collect()) == 3
    assert rows(V.not_listed(v, 2)) == [(1,)] and rows(V.not_listed(v, 0)) == [(0,)]
    sums = table("req_mip string, design_mip string, hundredths decimal(38,0)", [("m1", "m1", D(100)), ("m1", "m2", D(300)), ("m2", "m2", D(50))])
    unique = table("req_mip string, hundredths decimal(38,0)", [("m1", D(200))])
    assert rows(V.volume_matrix(sums, ["m1", "m2"], unique)) == [("m1", 1.0, 3.0, 4.0, 2.0), ("m2", 0.0, 0.5, 0.5, 0.0)]


def test_shape_pivot(table):
    s = table("spid string, odims string, out_grid string, frequency string, points bigint, variables bigint, mean_years double, experiments bigint", [
        ("a", "", "native", "mon", 1000, 2, 50.0, 3), ("a", "", "native", "day", 1000, 1, 10.0, 1), ("b", "", "1deg", "day", 10, 1, 1.0, 1)])
    wide = V.shape_frequency_pivot(s, {"mon": 12, "day": 365}, ["mon", "day"])
    got = {r["spid"]: r for r in wide.collect()}
    assert got["a"]["mon_gb"] == pytest.approx(12 * 50 * 2 * 1000 * 2e-9) and got["b"]["mon_gb"] is None and got["a"]["mon_variables"] == 2
    assert got["a"]["total_gb"] == pytest.approx((12 * 50 * 2 + 365 * 10) * 1000 * 2e-9)
    narrow = V.shape_frequency_pivot(s, {"mon": 12, "day": 365}, ["mon"])            # a frequency without columns still counts
    assert {r["spid"]: r["total_gb"] for r in narrow.collect()} == {k: r["total_gb"] for k, r in got.items()}
    tb = dict(V.pivot_totals(s, {"mon": 12, "day": 365}).collect())
    assert tb[None] == pytest.approx(tb["mon"] + tb["day"]) and tb["mon"] == pytest.approx(2.4e-6)


def test_union_is_at_most_the_sum(spark):
    import __spark_entry__ as entry
    r = entry.queries()["volume_overlap"](spark, "/root/testdata/sf0.001").first()
    assert 0 <= r["overlap_tb"] and r["combined_tb"] <= r["sum_single_tb"]


def test_request_summary_lone_row(world):
    _, links, items, rv, _ = world
    got = rows(V.request_summary(items, links, rv, 3), "vid", "ny", "nymax", "nenmax", "requests")
    assert got == [("v1", 5, 20, 1, 3), ("v2", 5, 20, 1, 5), ("v3", 5, -1, -1, 2)]


# --- wide table, revisions -----------------------------------------------------------------------------


def test_quality_dimensions_comment(spark):
    s = spark.range(1)
    null = F.lit(None).cast("double")
    assert tuple(s.select(T.quality_text(F.lit(1.5), F.lit("robust")), T.quality_text(null, F.lit("x")), T.dimension_text(F.lit("lon|lat"), F.lit(""), F.lit("time"), null.cast("string")),
                          T.other_text(F.lit("a"), F.lit("a")), T.other_text(F.lit("b"), F.lit("a"))).first()) == ("1.5 r", "", "lon lat  time", "", "b")


def test_two_lowest(table):
    rv = table("vid string, priority bigint", [("a", 1), ("a", 1), ("a", 2), ("b", 3), ("b", 2), ("c", 1)])
    assert rows(T.two_lowest(rv)) == [("a", 1, 1), ("b", 2, 3)]


def test_revision(table):
    s = "uid string, label string, x bigint"
    left, right = table(s, [("a", "A", 1), ("b", "B", None), ("c", "C", 3)]), table(s, [("b", "B", 2), ("c", "C", 3), ("d", "D", 4)])
    diff = E.revision_diff(left, right, ["label", "x"])
    assert rows(diff) == [("a", "only_left", None), ("b", "changed", ["x"]), ("d", "only_right", None)]
    assert rows(E.attribute_changes(diff)) == [("x", 1)]
    assert rows(E.diff_listing(diff, left, right), "line") == [("Only in left: a [A]",), ("Only in right: d [D]",)]


def test_updates(table):
    attributes = table("section string, label string, type string, required boolean", [
        ("s", "title", "xs:string", True), ("s", "n", "xs:integer", False), ("s", "f", "xs:float", False), ("s", "flag", "xs:boolean", False),
        ("s", "tier", "aa:st__integerListMonInc", False), ("s", "words", "aa:st__stringList", False)])
    index = table("uid string, section string", [("u", "s"), ("w", "s"), ("twice", "s"), ("twice", "s")])
    u = table("uid string, attr string, op string, given string, value string", [
        ("u", "title", "set", "text", "new"), ("u", "n", "set", "integer", "5"), ("u", "f", "set", "integer", "5"), ("u", "flag", "set", "text", "true"),
        ("u", "tier", "set", "integer list", "1 1"), ("u", "words", "set", "text", "a"), ("u", "none", "set", "text", "a"), ("u", "title", "delete", None, None),
        ("u", "nothing", "delete", None, None), ("u", "n", "delete", None, None), ("x", "title", "set", "text", "a"), ("twice", "title", "set", "text", "a"),
        ("w", "title", "set", "text", "good"), ("w", "tier", "set", "integer list", "1 2")])
    bad = E.update_violations(u, index, attributes)
    assert rows(bad) == sorted([("u", "f", "type"), ("u", "flag", "type"), ("u", "tier", "not increasing"), ("u", "words", "list type"), ("u", "none", "unknown"),
                                ("u", "title", "delete required"), ("u", "nothing", "delete unknown"), ("x", "title", "uid"), ("twice", "title", "uid")])
    section = table("uid string, title string, tier array<bigint>", [("u", "old", [1]), ("w", "old", [1])])
    done = E.apply_updates(section, E.valid_updates(u, bad), {"title": "xs:string", "tier": "aa:st__integerListMonInc"})
    assert rows(done) == [("u", "old", [1]), ("w", "good", [1, 2])]
    assert rows(E.append_records(section, table("uid string, title string", [("n", "t")])), "uid", "tier") == [("n", None), ("u", [1]), ("w", [1])]


def test_issue_log(table):
    issues = table("code string, message string", [("b", "x"), ("a", "y"), ("b", "x"), ("b", "w")])
    assert [tuple(r) for r in E.issue_log(issues).collect()] == [("a", "y"), ("b", "w"), ("b", "x")] and rows(E.issue_counts(issues)) == [("a", 1), ("b", 2)]


# --- search --------------------------------------------------------------------------------------------


def test_search(table):
    d = table("id string, title string, model array<string>, replica boolean, created string, kind string", [
        ("a", "Air Temperature", ["X", "Y"], False, "2020-01-02T00:00:00Z", "k"), ("b", "Rain", ["Y"], True, "2021-01-02T00:00:00Z", "k"),
        ("c", "temperature of sea", [], False, "2021-01-02T00:00:00Z", "k"), ("d", "Wind", None, False, None, "l")])
    assert rows(S.title_contains(d, "TEMPERATURE", "id")) == [("a",), ("c",)]
    assert rows(S.facet_search(d, model=["Y", "Z"], replica=False), "id") == [("a",)] and rows(S.facet_search(d, kind="k"), "id") == [("a",), ("b",), ("c",)]
    assert rows(S.hit_count(d)) == [(4,)] and rows(S.any_hit(d.where("id = 'z'"))) == [(False,)] and rows(S.present(d, "created"), "id") == [("a",), ("b",), ("c",)]
    assert rows(d.select("id", S.first_value(F.col("model"), "-").alias("m"))) == [("a", "X"), ("b", "Y"), ("c", "-"), ("d", "-")]
    t = d.withColumn("t", S.iso_time(F.col("created")))
    assert rows(S.newest(t, "kind", "t", "id"), "kind", "id") == [("k", "b")] and rows(S.without_time(t, "kind", "t")) == [("l",)]


# --- grids ---------------------------------------------------------------------------------------------


def box(xs):
    """Brute force of the box rule for one group."""
    xs = sorted(xs)
    def q(p):
        at = p * (len(xs) - 1)
        lo = int(at)
        hi = min(lo + 1, len(xs) - 1)
        return xs[lo] + (xs[hi] - xs[lo]) * (at - lo)
    a, b, c = q(.25), q(.5), q(.75)
    lo, hi = a - 1.5 * (c - a), c + 1.5 * (c - a)
    return (len(xs), a, b, c, min([x for x in xs if x >= lo] + [a]), max([x for x in xs if x <= hi] + [c]), sum(x < lo or x > hi for x in xs))


@pytest.mark.parametrize("range_rows", [1_000_000, 20])
def test_box(table, range_rows):
    rng = random.Random(1)
    groups = {"one": [4.0], "equal": [2.0] * 9, "outlier": [1.0, 2.0, 3.0, 4.0, 100.0], "many": [round(rng.gauss(0, 10), 1) for _ in range(3000)],
              "copies": [1.0] * 500 + [float(i) for i in range(100)], "pair": [1.0, 2.0]}
    data = [(k, x) for k, xs in groups.items() for x in xs] + [("none", None), ("many", None)]
    rng.shuffle(data)
    df = table("k string, v double", data)
    got = {r[0]: r[1:] for r in rows(G.box_stats(df, ["k"], "v", range_rows))}
    assert set(got) == set(groups)
    for k, xs in groups.items():
        assert got[k] == pytest.approx(box(xs)), k
    assert rows(G.box_outliers(df.where("k = 'outlier'"), ["k"], "v", range_rows)) == [("outlier", 100.0)]


def test_quantiles_in_ranges_equal_the_builtin(table):
    rng = random.Random(5)
    data = [(k, rng.choice([rng.random(), 0.5, rng.gauss(0, 1e6)])) for k in "abc" for _ in range(rng.randrange(1, 2500))] + [("d", -0.0), ("d", 1.0)]
    df = table("k string, v double", data)
    probs = (0.0, 0.01, 0.25, 0.5, 0.9, 1.0)
    builtin = rows(df.groupBy("k").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")).select("k", *[F.col("q")[i].alias(f"q{i}") for i in range(len(probs))]))
    for range_rows in (1_000_000, 300, 3, 1):
        for x, y in zip(rows(G.quantiles(df, ["k"], "v", probs, range_rows)), builtin, strict=True):
            assert x[0] == y[0] and x[1:] == pytest.approx(y[1:], abs=1e-9)


def test_units_and_longitude(table, spark):
    df = table("value double, units string", [(273.15, "K"), (300.0, "k"), (5.0, "m"), (None, "K")])
    assert rows(G.to_celsius(df)) == [(None, "°C"), (0.0, "°C"), (pytest.approx(26.85), "°C"), (5.0, "m")]
    attrs = F.create_map(F.lit("units"), F.lit("K"), F.lit("history"), F.lit("h"))
    assert spark.range(1).select(G.celsius_attributes(attrs)).first()[0] == {"units": "°C", "history": "h"}
    assert spark.range(1).select(G.east_longitude(F.lit(-46.6))).first()[0] == pytest.approx(313.4)


def test_point_series(table):
    grid = table("time bigint, lat double, lon double, value double", [(t, la, lo, t * 100 + la + lo) for t in (2, 1) for la in (-30.0, -20.0, 0.0) for lo in (0.0, 310.0, 320.0)])
    assert rows(G.point_series(grid, -23.5, -46.63), "time", "lat", "lon") == [(1, -20.0, 310.0), (2, -20.0, 310.0)]
    assert rows(G.point_series(grid, -25.0, 315.0), "time", "lat", "lon") == [(1, -30.0, 310.0), (2, -30.0, 310.0)]       # a tie takes the smaller


@pytest.mark.parametrize("parts", [4096, 40, 9, 2])
def test_nearest_values(table, parts):
    rng = random.Random(2)
    coords, targets = [rng.uniform(-5, 5) ** 3 for _ in range(300)] + [7.0, 9.0], [rng.uniform(-200, 200) for _ in range(500)] + [8.0, 7.0, 9.0]
    got = rows(G.nearest_values(table("t double", [(t,) for t in targets]), table("c double", [(c,) for c in coords]), "t", "c", parts))
    assert len(got) == len(set(targets))
    for t, c in got:
        assert c == min(coords, key=lambda x: (abs(x - t), x))


def test_months_and_profile(spark, table):
    df = table("t timestamp, v double", []).sparkSession.sql("SELECT timestamp'2001-03-05 00:00:00' AS t, 4.0D AS v")
    got = G.box_by_month(df, "t", "v").collect()
    assert [r["name"] for r in got][:3] == ["January", "February", "March"] and [r["n"] for r in got] == [0, 0, 1] + [0] * 9
    p = table("lat double, lon double", [(1.0, 2.0), (1.0, 3.0)])
    assert rows(G.axis_profile(p, "lat", "lon")) == [("lat", 1, "1.0", "1.0"), ("lon", 2, "2.0", "3.0")]


# --- balanced joins ------------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_gives_the_plain_join(spark, table, how, forced_split):
    rng = random.Random(4)
    left = table("k bigint, a bigint", [(rng.choice([1, 1, 1, 2, 3, 4, None]), i) for i in range(200)])
    right = table("k bigint, b bigint", [(rng.choice([1, 2, 2, 5, None]), i) for i in range(60)])
    split = scale.skew_join(left, right, ["k"], how, right_keys=right.select("k"))
    assert rows(split) == rows(left.join(right, ["k"], how))
    assert ("_chunks" in split._jdf.queryExecution().analyzed().toString()) == (how == "inner")


def test_large_keys(table, monkeypatch):
    monkeypatch.setattr(scale, "CHUNK_ROWS", 100)
    right = table("k bigint", [(1,)] * 100 + [(2,)] * 101 + [(3,)] * 950 + [(None,)] * 500)
    assert rows(scale.large_keys(right, ["k"])) == [(2, 2), (3, 10)]
    monkeypatch.setattr(scale, "MOST_KEYS", 1)
    assert rows(scale.large_keys(right, ["k"])) == [(3, 10)]


def test_a_key_of_most_rows_is_spread_over_tasks(spark, table, monkeypatch):
    """One key with nearly all rows on both sides: its pairs come from many partitions."""
    monkeypatch.setattr(scale, "CHUNK_ROWS", 10)
    left = spark.range(400).selectExpr("if(id < 380, 7, id) AS k", "id AS a")
    right = spark.range(300).selectExpr("if(id < 290, 7, id) AS k", "id AS b")
    from pyspark.sql import functions as F
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = scale.skew_join(left, right, ["k"], right_keys=right.select("k"))
        per = joined.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in per) == 380 * 290 and len(per) == 4 and max(r["count"] for r in per) < 0.5 * 380 * 290
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_last_of_several_updates_counts(table):
    section = table("uid string, label string, rank bigint", [("a", "x", 1), ("b", "y", 2)])
    updates = table("uid string, attr string, value string, position bigint", [("a", "rank", "9", 1), ("a", "rank", "10", 2), ("b", "label", "z", 1), ("b", "label", "w", 0)])
    assert rows(E.apply_updates(section, updates, {"label": "xs:string", "rank": "xs:integer"})) == [("a", "x", 10), ("b", "z", 2)]


def test_records_under_their_values(table):
    df = table("uid string, label string, sn string", [("a", "x", "n"), ("b", "x", "__unset__"), ("c", None, "n")])
    assert rows(L.value_index(df, "label", "sn")) == [("label", "x", "a"), ("label", "x", "b"), ("sn", "n", "a"), ("sn", "n", "c")]


def test_quantities_by_standard_name(table):
    var = table("uid string, title string, units string, description string, label string, sn string", [("q1", "T", "K", "d", "b", "n2"), ("q2", "U", "K", "d", "a", "n2"), ("q3", "V", "K", "d", "c", "n1"), ("q4", "W", "K", "d", "d", "n0")])
    got = T.quantity_records(table("vid string", [("q1",), ("q2",), ("q3",), ("q3",)]), var).collect()
    assert [(r["sn"], r["label"]) for r in got] == [("n1", "c"), ("n2", "a"), ("n2", "b")]


@pytest.mark.parametrize("chunk", [2, 512])
def test_list_join_gives_the_pairs_of_a_join(table, monkeypatch, chunk):
    """Large groups, an owner with many rows, repeated rows and nulls: the same pairs, each share in one task."""
    monkeypatch.setattr(scale, "CHUNK_ROWS", chunk)
    left = table("k bigint, o string, a bigint", [(i % 4, "hot" if i % 3 else f"o{i}", i) for i in range(24)] + [(None, "n", 1), (1, None, 2), (1, None, 2)])
    right = table("k bigint, v bigint, b string", [(i % 5, i % 7, f"b{i % 3}") for i in range(40)] + [(None, 3, "x"), (1, None, "y")])
    got = scale.list_join(left, right, ["k"], "o", "v", right_keys=right.select("k"))
    assert rows(got, "o", "a", "v", "b") == rows(left.join(right, "k"), "o", "a", "v", "b")
    shares = {}
    for r in got.collect():
        shares.setdefault((r["o"], r["v"]), set()).add(r["_share"])
    assert all(len(s) == 1 for s in shares.values())
    assert (len({s for (o, _), v in shares.items() if o == "hot" for s in v}) > 1) == (chunk == 2)


def test_years_of_the_best_grid_by_list(table):
    """As a maximum per grid, also with negative and missing years and grids."""
    years = table("refid bigint, expt string, grid string, years bigint", [
        (1, "e1", "2deg", 900), (1, "e1", "1deg", 5), (2, "e1", "1deg", 7), (2, "e1", None, 3), (1, "e2", "DEF", -4), (2, "e2", "", 8), (1, "e3", "native:01", None)])
    wanted = table("refid bigint, vid bigint, grid_class string", [(1, 10, "o"), (2, 10, "o"), (1, 11, "a"), (2, 12, "a")])
    met = years.join(wanted, "refid")
    plain = R.variable_years(met.withColumn("grid", R.default_grid(F.col("grid"), F.col("grid_class"))), R.Policy())
    got = R.best_years(years, wanted, wanted.withColumnRenamed("refid", "vgid"), R.Policy())
    assert rows(got, "vid", "expt", "grid", "years") == rows(plain, "vid", "expt", "grid", "years")
    assert dict(got.dtypes)["years"] == "bigint"


def test_owners_are_counted_on_the_same_walk(spark, table, tmp_path):
    """The rows whose owners are counted are those that meet the lists: they are read and grouped once."""
    from gridledger.scale import list_join

    table("g bigint, o string, y bigint", [(1, "a", 3), (1, "a", 5), (1, "b", 2), (None, "b", 1), (2, None, 7)]).write.parquet(f"{tmp_path}/walked")
    left = spark.read.parquet(f"{tmp_path}/walked").groupBy("g", "o").agg(F.max("y").alias("y"))
    right = table("g bigint, v bigint", [(1, 10), (1, 11), (2, 12), (None, 13)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = list_join(left, right, ["g"], "o", "v", right_keys=right.select("g"))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1
        assert rows(df, "o", "y", "v") == [(None, 7, 12), ("a", 5, 10), ("a", 5, 11), ("b", 2, 10), ("b", 2, 11)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("chunk", [2, 512])
def test_years_of_the_best_grid_dealt_by_variable(table, monkeypatch, chunk):
    """As a maximum per grid, with negative and missing years and grids, a large group and a variable of many groups."""
    monkeypatch.setattr(scale, "CHUNK_ROWS", chunk)
    years = table("refid bigint, expt string, grid string, years bigint", [
        (1, "e1", "2deg", 900), (1, "e1", "1deg", 5), (2, "e1", "1deg", 7), (2, "e1", None, 3), (1, "e2", "DEF", -4), (2, "e2", "", 8), (1, "e3", "native:01", None),
        (None, "e4", "1deg", 2), (3, None, "DEF", 6), (3, "e5", "DEF", 9), (4, "e5", "1deg", 9), *[(5, f"f{i}", "DEF", i) for i in range(9)]])
    wanted = table("refid bigint, vid bigint, grid_class string", [
        (1, 10, "o"), (2, 10, "o"), (1, 11, "a"), (2, 12, "a"), (3, 10, "o"), (3, 12, "a"), (3, 12, "a"), (4, 10, "o"), (5, 10, "o"), (5, 12, "a"), (4, 13, "a"), (4, 13, "o")])
    met = years.join(wanted, "refid")
    plain = R.variable_years(met.withColumn("grid", R.default_grid(F.col("grid"), F.col("grid_class"))), R.Policy())
    got = R.best_years_by_variable(years, wanted, R.Policy())
    assert rows(got, "vid", "expt", "grid", "years") == rows(plain, "vid", "expt", "grid", "years")
    assert dict(got.dtypes)["years"] == "bigint"
    by = ["mip"]
    named = R.best_years_by_variable(years.withColumn("req_mip", F.when(F.col("years") % 2 == 0, "m0").otherwise("m1")),
                                     wanted.withColumn("req_mip", F.explode(F.array(F.lit("m0"), F.lit("m1")))), R.Policy(), by)
    twice = R.variable_years(met.withColumn("grid", R.default_grid(F.col("grid"), F.col("grid_class"))).withColumn(
        "req_mip", F.when(F.col("years") % 2 == 0, "m0").otherwise("m1")), R.Policy(), by)
    assert rows(named, "req_mip", "vid", "expt", "grid", "years") == rows(twice, "req_mip", "vid", "expt", "grid", "years")


def test_labels_of_a_variable_listed_several_times(table):
    """Experiments are counted for each listing, also of one without a plane, where the grid does not show."""
    years = table("vid bigint, expt string, grid string, years bigint", [
        (1, "e1", "1deg", 5), (1, "e2", "1deg", 7), (1, "e3", "native:01", 7), (1, "e4", "native", 7), (2, "e1", None, None), (3, "e1", "1deg", 1)])
    kept = table("vid bigint, label string, spid string, odims string, frequency string, grid_class string, latlon string, size_native bigint, size_100km bigint, size_1deg bigint, size_2deg bigint", [
        (1, "a", "s", "", "mon", "o", "o", 1, 1, 1, 1), (1, "a", "s", "", "mon", "o", "o", 1, 1, 1, 1), (1, "b", "s", "", "mon", "o", "o", 1, 1, 1, 1), (2, None, "t", "x", "day", "a", "", 1, 1, 1, 1)])
    got = V.shape_labels(years, kept, R.Policy())
    assert rows(got, "out_grid", "vid", "label", "experiments") == [(None, 2, None, 1), ("1deg", 1, "a", 4), ("1deg", 1, "b", 2), ("native", 1, "a", 4), ("native", 1, "b", 2)]
