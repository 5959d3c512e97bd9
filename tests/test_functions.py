import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridledger.functions import caps, coerce, sizes, text


def one(spark, *cols):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def ints(*xs):
    return F.array(*[F.lit(x).cast("bigint") for x in xs])


@pytest.mark.parametrize("limit,expected", [(-1, 30), (10, 10), (30, 30), (99, 30)])
def test_year_cap(spark, limit, expected):
    assert one(spark, caps.cap_years(F.lit(30), F.lit(limit))) == (expected,)


@pytest.mark.parametrize("tiers,sizes_,limit,tmax,expected", [
    ((1, 2), (3, 10), -1, 1, 3), ((1, 2), (3, 10), -1, 2, 10), ((1, 2), (3, 10), -1, 3, 10), ((1, 2), (3, 10), 5, 3, 5), ((1, 2), (3, 10), 0, 3, 0),
    ((2,), (4,), -1, 1, 0), ((2,), (4,), 7, 1, 0),
    ((1, 1), (6, 9), -1, 1, 6),           # a repeated tier takes its first place
    ((1, 2), (3, 10), -1, 0, 10), ((1, 2), (3, 10), -1, -1, 10),
])
def test_members(spark, tiers, sizes_, limit, tmax, expected):
    assert one(spark, caps.members_for_tier(ints(*sizes_), ints(*tiers), F.lit(limit), tmax)) == (expected,)


def test_tier_reset_preset(spark):
    assert one(spark, caps.first_tier_passes(ints(2, 3), 1), caps.first_tier_passes(ints(2, 3), 2), caps.first_tier_passes(ints(2, 3), 0)) == (False, True, True)
    null = F.lit(None).cast("bigint")
    assert one(spark, caps.reset_passes(null, 1), caps.reset_passes(F.lit(1), 1), caps.reset_passes(F.lit(2), 1), caps.reset_passes(F.lit(2), -1)) == (True, True, False, True)
    assert one(spark, *[caps.preset_passes(F.lit(p), 1) for p in (-1, 1, 2)]) == (True, True, False)
    assert one(spark, caps.effective_priority(F.lit(-1), F.lit(3)), caps.effective_priority(F.lit(2), F.lit(3))) == (3, 2)


@pytest.mark.parametrize("mcfg,wanted,strict,expected", [
    ("AOGCM | AER", ["AOGCM"], False, True), ("AOGCM AER | CHEM", ["AOGCM"], False, False), ("LAND | ", ["AGCM"], False, True),
    ("RAD | ", ["AOGCM"], False, True), ("AOGCM | AER", ["AOGCM", "AER"], True, True), ("AOGCM | ", ["AOGCM", "AER"], True, False),
])
def test_category(spark, mcfg, wanted, strict, expected):
    assert one(spark, caps.category_passes(F.lit(mcfg), wanted, strict)) == (expected,)


@pytest.mark.parametrize("v,declared,value,problem", [
    ("12", "xs:integer", 12, None), ("-3", "xs:integer", -3, None), ("", "xs:integer", 0, "blank integer set to 0"),
    (" ", "xs:integer", 0, "blank integer set to 0"), ("[]", "xs:integer", 0, "blank integer set to 0"),
    ("12.7", "xs:integer", 12, "integer cut from number"), ("-12.7", "xs:integer", -12, "integer cut from number"), ("x", "xs:integer", None, "integer unreadable"),
    ("1", "xs:boolean", True, None), ("true", "xs:boolean", True, None), ("True", "xs:boolean", False, None), ("0", "xs:boolean", False, None),
    ("", "xs:float", None, None), ("2.5", "xs:float", 2.5, None), ("x", "xs:float", None, "float unreadable"),
    ("a b", "aa:st__stringList", ["a", "b"], None), ("a", "aa:st__stringList", ["a"], None),
    ("1 2 2", "aa:st__integerListMonInc", [1, 2, 2], None), ("2 1", "aa:st__integerListMonInc", [2, 1], "list decreases"),
    ("1.0 2", "aa:st__integerList", [1, 2], "integer list cut from numbers"), ("1 x", "aa:st__integerList", [1, None], "list unreadable"),
    ("1.5 -2", "aa:st__floatList", [1.5, -2.0], None), ("3.0 1.0", "aa:st__floatListMonInc", [3.0, 1.0], None),
    ("a:b.c+1-2_d", "aa:st__uid", "a:b.c+1-2_d", None), ("a b", "aa:st__uid", "a b", "bad uid"), ("any", "xs:string", "any", None),
])
def test_coercion(spark, v, declared, value, problem):
    assert one(spark, coerce.coerce(F.lit(v), declared), coerce.coercion_problem(F.lit(v), declared)) == (value, problem)


def test_typed_section(table):
    raw = table("uid string, label string, n string", [("u1", None, "4"), (None, "b", "x")])
    types = {"uid": "aa:st__uid", "label": "xs:string", "n": "xs:integer", "extra": "xs:float"}
    required = {"uid": None, "label": None}
    assert rows(coerce.typed(raw, types, required)) == [(None, "b", None, None), ("u1", "__unset__", 4, None)]
    found = rows(coerce.violations(raw, "s", types, required), "uid", "attr", "problem")
    assert found == [(None, "n", "integer unreadable"), (None, "uid", "missing uid"), ("u1", "label", "required attribute absent")]


def test_text_of_values(spark):
    assert one(spark, coerce.to_text(ints(1, 2), "aa:st__integerList"), coerce.to_text(F.lit(True), "xs:boolean")) == ("1 2", "true")
    assert one(spark, coerce.is_strictly_increasing(ints(1, 2)), coerce.is_strictly_increasing(ints(1, 1)), coerce.is_strictly_increasing(ints(2, 1))) == (True, False, False)
    assert one(spark, coerce.integer_problem(F.lit("7")), coerce.integer_problem(F.lit("7.1"))) == (None, "not an integer")


@pytest.mark.parametrize("grid,req,force,expected", [
    ("1deg", "No", None, "1deg"), ("2deg", "", None, "2deg"), ("100km", "", None, "1deg"), ("native", "No", None, "native"), ("", "no", None, "native"),
    ("", "no*1", None, "native:01"), ("", "", None, "DEF"), ("DEF", "yes", None, "DEF"), ("1deg", "No", "native", "native"),
])
def test_request_grid(spark, grid, req, force, expected):
    assert one(spark, sizes.request_grid(F.lit(grid), F.lit(req), force)) == (expected,)


def test_default_and_sizing_grid(spark):
    d = lambda g, c, n=False: sizes.default_grid(F.lit(g), F.lit(c), n)
    assert one(spark, d("DEF", "o"), d("DEF", "o", True), d("DEF", "a"), d("DEF", "si"), d("2deg", "o")) == ("1deg", "native", "native", "native", "2deg")
    s = lambda g, c, l, st=True: sizes.sizing_grid(F.lit(g), F.lit(c), F.lit(l), st)
    assert one(spark, s("DEF", "a", "o"), s("DEF", "o", "a"), s("native:01", "o", "o"), s("native:01", "o", "o", False), s("native:01", "a", "o", False)) == (
        "1deg", "native", "native", "1deg", "native")
    g = lambda grid, l: sizes.summary_grid(F.lit(grid), F.lit("o"), F.lit(l))
    assert one(spark, g("DEF", "o"), g("DEF", "a"), g("native:01", ""), g("1deg", "a")) == ("1deg", "native", "native", "1deg")


@pytest.mark.parametrize("realm,odims,shape,prov,expected", [
    ("ocean", "", "XY-na", "", "o"), ("atmos ocnBgchem", "", "", "", "o"), ("seaIce", "", "", "", "si"), ("landIce", "", "", "", "li"), ("atmos", "", "", "", "a"),
    ("", "iceband", "", "", "si"), ("__unset__", "tau", "", "", "a"), ("", "", "XY-O", "", "o"), ("", "?", "XY-A", "", "a"),
    ("", "", "XY-na", "CFMIP [cf1hrClimMon]", "a"), ("", "", "XY-na", "FAFMIP [fafOyr]", "o"), ("", "", "XY-na", "?", None),
])
def test_grid_class(spark, realm, odims, shape, prov, expected):
    args = [F.lit(x) for x in (realm, odims, shape, prov)]
    assert one(spark, sizes.grid_class(*args), sizes.grid_class(*args, all_ocean=True)) == (expected, "o")


def test_shape_and_structure_sizes(table):
    shapes = table("uid string, label string, dimensions string, levels bigint, level_flag boolean", [
        ("xy", "XY", "longitude|latitude", 1, True), ("xyo", "XYO", "longitude|latitude|olevel", 0, False), ("xya", "XYA", "longitude|latitude|alevhalf", 0, False),
        ("site", "S", "alevel|site", 0, False), ("rho", "R", "latitude|rho|basin", 0, False), ("soil", "D", "longitude|latitude|sdepth", 0, False), ("bad", "B", "longitude|latitude|what", 0, False)])
    got = {r[0]: r[1:] for r in rows(sizes.shape_sizes(shapes), "uid", "latlon", "surface", "size_native", "size_1deg", "size_2deg")}
    assert got == {"xy": ("a", True, 64800, 64800, 16200), "xyo": ("o", False, 259200 * 60, 64800 * 60, 16200 * 60), "xya": ("a", False, 64800 * 40, 64800 * 40, 16200 * 40),
                   "site": ("", False, 400, 400, 400), "rho": ("", False, 600, 600, 600), "soil": ("a", False, 324000, 324000, 81000), "bad": ("a", False, None, None, None)}
    st = table("uid string, spid string, odims string", [("s1", "xy", "tau"), ("s2", "xy", "landUse"), ("s3", "xy", "new"), ("s4", "none", ""), ("s5", "xy", None), ("s6", "xy", "effectRadLi|tau")])
    got = rows(sizes.structure_sizes(st, shapes), "uid", "size_native", "known")
    assert got == [("s1", 453600, True), ("s2", 324000, True), ("s3", 324000, True), ("s4", 0, False), ("s5", 64800, True), ("s6", 64800 * 28, True)]


def test_model_configuration():
    assert sizes.model_config()["nho"] == 259200 and sizes.model_config([1, 2, 3, 4, 5, 6, 7])["nh1"] == 7
    with pytest.raises(ValueError):
        sizes.model_config([1, 2])
    with pytest.raises(TypeError):
        sizes.model_config([1, 2, 3, 4, 5, 6, "7"])


def test_outputs_per_year(spark):
    f = lambda x: (sizes.outputs_per_year(F.lit(x)), sizes.hundredths_per_year(F.lit(x)))
    assert one(spark, *f("fx"), *f("dec"), *f("mon"), *f("1hrClimMon"), *f("nothing")) == (0.01, 1, 0.1, 10, 12.0, 1200, 288.0, 28800, None, None)
    c = lambda x: (sizes.is_climatology(F.lit(x)), sizes.is_climatology_legacy(F.lit(x)), sizes.is_climatology_label(F.lit(x)))
    assert one(spark, *c("monC"), *c("1hrCM"), *c("monClim"), *c("mon")) == (True, True, False, True, False, False, True, True, True, False, False, False)


@pytest.mark.parametrize("x,expected", [(1.5e8, "150M"), (9.99e8, "999M"), (1e9, "1G"), (2.5e11, "250G"), (1.25e12, "1.2T"), (1e13, " 10T"), (9.5e14, "950T"), (3e15, "  3P"), (2e18, "2,000,000,000.00")])
def test_volume_label(spark, x, expected):
    assert one(spark, text.volume_label(F.lit(x))) == (expected,)


def test_volume_label_rounds_the_binary_value(spark):
    xs = [float(v) for k in range(10, 100) for v in ((2 * k + 1) * 5e10, (2 * k + 1) * 5e10 * (1 + 2e-16), (2 * k + 1) * 5e10 * (1 - 2e-16))]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", text.volume_label(F.col("x")), text.volume_label(F.col("x"), "B")).collect()
    assert all(a == b == f"{x * 1e-12:3.1f}T" for x, a, b in got)
    assert one(spark, text.volume_label(F.lit(1.5e18), "B")) == ("1,500,000,000.00B",)


def test_labels_and_clean_up(spark):
    names = lambda *xs: F.array(*[F.lit(x) for x in xs])
    assert one(spark, text.selection_label(names("CMIP")), text.selection_label(names("LUMIP", "C4MIP"))) == ("CMIP", "c4.lu")
    assert one(spark, text.plain_text(F.lit("a–b “c” d’s … 5m²")), text.plain_text(F.lit('say "x"\ny'), True)) == ('a-b "c" d\'s ... 5m2', "say 'x';;y")
    assert one(spark, text.markup_links(F.lit("see {var} and [http://a.b c d]"), "u/")) == ("see <a href=u/var.html>var</a> and <a href=http://a.b>c d</a>",)
    assert one(spark, text.first_word(F.lit("ocean seaIce")), text.first_word(F.lit("")), text.frequency_realm(F.lit("mon"), F.lit("atmos land"))) == ("ocean", "", "mon.atmos")
    null = F.lit(None).cast("string")
    h = lambda d, t: text.hover_title(d, t, F.lit("lab"))
    assert one(spark, h(F.lit('a "b" <c>'), F.lit("t")), h(F.lit("  "), F.lit("t")), h(null, F.lit("__unset__"))) == ("a &quot;b&quot; &lt;c&gt;", "t", "lab")


def test_sort_keys(spark):
    k = lambda x: text.section_sort_key(F.lit(x))
    assert one(spark, k("3.10 Request"), k("X.1 Core"), k("Plain title"), k("1.2.3 deep")) == (["003", "010"], ["X", "001"], ["Plain", "0"], ["1", "2", "3"])
    c = lambda x: text.table_class(F.lit(x))
    assert one(spark, c("Amon"), c("emDay"), c("em"), c("CMIP5_x"), c("CORDEX"), c("SPECS")) == (0, 1, 0, 2, 2, 0)
