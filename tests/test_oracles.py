"""Every registered query against its SQL on the smallest tables, and the heavy ones again with split joins."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import compare  # noqa: E402
from gridledger.plans.roles import TABLES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
SPLIT = ["years_group", "best_grid", "choice_rank", "mip_variables", "experiment_variables", "links_dangling", "record_unpivot",
         "item_experiments", "box_by_day", "box_outliers", "linkset_variables", "dataset_files", "slice_compare", "variables_per_experiment",
         "placeholders_dropped", "usage_tree", "updates_applied", "experiment_summary"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), ORACLES[name], con) == ""


@pytest.mark.parametrize("name", SPLIT)
def test_agrees_with_sql_when_joins_are_split(spark, con, name, forced_split):
    assert compare(QUERIES[name](spark, FOLDER), ORACLES[name], con) == ""


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert sorted(df.columns) == ["frequency", "volume"] and df.count() > 0


@pytest.mark.parametrize("name", ["experiment_variables", "priority_min", "slice_merge", "slice_years", "experiment_requests", "request_unique", "best_grid"])
def test_pairs_of_variable_and_experiment_are_not_shuffled(spark, name):
    """Above the place where lists of variables are unfolded into pairs there is no exchange."""
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode(_list" in plan and "Exchange" not in plan.split("Generate explode(_list")[0]


def test_matrix_and_unique_column_walk_to_the_years_once(spark):
    """The years of both parts come from one plan: the columns that the walk carries are the same."""
    from gridledger.plans import volumes
    from gridledger.plans.roles import Catalogue

    asked = []
    years = volumes.R.group_years
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(volumes.R, "group_years", lambda *a: asked.append(years(*a)) or asked[-1])
        volumes.volume_matrix(Catalogue(spark, FOLDER))
    assert len(asked) == 2 and asked[0].sameSemantics(asked[1])


@pytest.mark.parametrize("name", ["shape_frequency_summary", "shape_frequency_pivot"])
def test_shapes_travel_as_one_number(spark, con, name, forced_split):
    """Lists and pairs hold no names of a shape, and experiments in several shares count once."""
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    lists = [line for line in plan.splitlines() if "Generate explode(_list" in line]
    assert lists and "_e#" in lists[0]
    assert not [line for line in plan.splitlines() if "_e#" in line and "_e#" in line.split("Project")[-1] and ("label" in line or "odims" in line)]
    assert compare(df, ORACLES[name], con) == ""


def test_tables_and_frequencies_travel_as_one_number(spark):
    """The lists that become pairs of the roll-ups hold no names."""
    plan = QUERIES["rollups_by_mip"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    unfolded = [line for line in plan.splitlines() if "_e#" in line and ".vid AS" in line]
    assert unfolded and not [line for line in unfolded if "mip_table" in line or "frequency" in line]


def _dealt_by_variable(spark, name):
    """Only sums per variable and grid leave the place where lists of experiments are unfolded, and lists hold nothing but experiment and request."""
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode(_list" in plan
    above = plan.split("Generate explode(_list")[0]
    first = [line for line in above.splitlines() if "Exchange" in line][-1]
    assert "hashpartitioning(vid" in first and "grid" in first and "expt" not in first
    unfolded = [line for line in plan.splitlines() if "_e#" in line and ".expt AS" in line]
    assert unfolded and all(line.count("_e#") == 2 for line in unfolded)
    return df


def test_table_labels_sum_where_lists_are_unfolded(spark, con, forced_split):
    assert compare(_dealt_by_variable(spark, "volume_by_table_label"), ORACLES["volume_by_table_label"], con) == ""


def test_volumes_of_variables_sum_where_lists_are_unfolded(spark, con, forced_split):
    assert compare(_dealt_by_variable(spark, "volume_by_variable"), ORACLES["volume_by_variable"], con) == ""


def test_largest_volumes_sum_where_lists_are_unfolded(spark, con, forced_split):
    assert compare(_dealt_by_variable(spark, "volume_by_variable_top20"), ORACLES["volume_by_variable_top20"], con) == ""


def test_variables_not_listed_are_counted_where_lists_are_unfolded(spark, con, forced_split):
    assert compare(_dealt_by_variable(spark, "volume_not_listed"), ORACLES["volume_not_listed"], con) == ""


def test_shape_labels_are_looked_up_after_experiments_are_counted(spark, con, forced_split):
    assert compare(_dealt_by_variable(spark, "shape_labels"), ORACLES["shape_labels"], con) == ""
