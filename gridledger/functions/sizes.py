"""Grid policy, points per output time, outputs per year, and the points of one variable-year."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.lookup import (
    ATMOS_PROVENANCE, EXTRA_DIM_DEFAULT, EXTRA_DIM_SIZE, MODEL_CONFIG, OCEAN_PROVENANCE, OCEAN_SHAPES,
    OFF_GRID_POINTS, OUTPUTS_PER_YEAR, REGULAR_POINTS, SOIL_LEVELS, UNDECIDED_SHAPE, UNSET,
)

REGULAR_GRIDS = sorted(REGULAR_POINTS)


def choose(key: Column, table: dict, default=None) -> Column:
    """The value of a key in a small fixed table, written as a literal map."""
    text = lambda v: f"'{v}'" if isinstance(v, str) else f"{v}D" if isinstance(v, float) else str(v)
    found = F.try_element_at(F.expr("map(" + ", ".join(f"{text(k)}, {text(v)}" for k, v in table.items()) + ")"), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def model_config(values: list[int] | None = None) -> dict[str, int]:
    """The seven sizes of the nominal model, or the user's; wrong length or type is an error."""
    if values is None:
        return dict(MODEL_CONFIG)
    if len(values) != len(MODEL_CONFIG):
        raise ValueError(f"a model configuration has {len(MODEL_CONFIG)} values: {values}")
    if not all(type(v) is int for v in values):
        raise TypeError(f"a model configuration has integer values only: {values}")
    return dict(zip(MODEL_CONFIG, values))


def outputs_per_year(frequency: Column) -> Column:
    return choose(frequency, {k: float(v) for k, v in OUTPUTS_PER_YEAR.items()})


def hundredths_per_year(frequency: Column) -> Column:
    """Outputs per year times 100: a whole number for every frequency, so that sums are exact."""
    return choose(frequency, {k: round(v * 100) for k, v in OUTPUTS_PER_YEAR.items()}).cast("bigint")


def is_climatology(frequency: Column) -> Column:
    """For volumes of the fact table."""
    return F.lower(frequency).contains("clim") | frequency.isin("monC", "1hrCM")


def is_climatology_legacy(frequency: Column) -> Column:
    """For the volumes by experiment of the older method."""
    return frequency.isin("monClim", "monC")


def is_climatology_label(frequency: Column) -> Column:
    """For the shape and frequency summary."""
    return F.lower(frequency).contains("clim")


# --- grid policy ---------------------------------------------------------------------------------------

def request_grid(grid: Column, gridreq: Column, force: str | None = None) -> Column:
    """Grid asked for by a request link."""
    if force is not None:
        return F.lit(force)
    return (
        F.when(grid == "100km", F.lit("1deg"))
        .when(grid.isin("1deg", "2deg"), grid)
        .when(gridreq.isin("No", "no"), F.lit("native"))
        .when(gridreq == "no*1", F.lit("native:01"))
        .otherwise(F.lit("DEF"))
    )


def default_grid(grid: Column, grid_class: Column, default_native: bool = False) -> Column:
    """Settles DEF: one degree for the ocean unless the policy is native, else native."""
    ocean = F.lit(False) if default_native else F.coalesce(grid_class == "o", F.lit(False))
    return F.when(grid != "DEF", grid).when(ocean, F.lit("1deg")).otherwise(F.lit("native"))


def sizing_grid(grid: Column, grid_class: Column, latlon: Column, ocean_structured: bool = True) -> Column:
    """The grid whose size counts: DEF by the shape, native:01 by the variable's class and the mesh."""
    first = F.lit("native") if ocean_structured else F.when(grid_class == "o", F.lit("1deg")).otherwise(F.lit("native"))
    return (
        F.when(grid == "DEF", F.when(latlon == "o", F.lit("1deg")).otherwise(F.lit("native")))
        .when(grid == "native:01", first)
        .otherwise(grid)
    )


def summary_grid(
    grid: Column, grid_class: Column, latlon: Column, default_native: bool = False, ocean_structured: bool = True
) -> Column:
    """Grid label used in the shape summary; only shapes on a latitude-longitude plane distinguish grids."""
    ocean_default = F.lit("native") if default_native else F.lit("1deg")
    first = F.lit("native") if ocean_structured else F.when(grid_class == "o", F.lit("1deg")).otherwise(F.lit("native"))
    on_plane = (
        F.when((grid == "DEF") & (latlon == "o"), ocean_default)
        .when(grid == "native:01", first)
        .when(grid.isin("1deg", "2deg", "native"), grid)
        .otherwise(F.lit("native"))
    )
    off_plane = F.when(grid == "native:01", F.lit("native")).otherwise(grid)
    return F.when(latlon != "", on_plane).otherwise(off_plane)


def grid_class(realm: Column, odims: Column, shape_label: Column, prov: Column, all_ocean: bool = False) -> Column:
    """Class of a variable: o ocean, si sea ice, li land ice, a atmosphere; NULL when nothing settles it.

    ``all_ocean`` gives every variable the ocean class, as the published volume figures do.
    """
    if all_ocean:
        return F.lit("o")
    return (
        F.when(realm.contains("ocean") | realm.contains("ocnBgchem"), "o")
        .when(realm.contains("seaIce"), "si")
        .when(realm == "landIce", "li")
        .when(~realm.isin("", UNSET), "a")
        .when(odims == "iceband", "si")
        .when(~odims.isin("", "?"), "a")
        .when(shape_label.isin(OCEAN_SHAPES), "o")
        .when(shape_label != UNDECIDED_SHAPE, "a")
        .when(prov.isin(ATMOS_PROVENANCE), "a")
        .when(prov.isin(OCEAN_PROVENANCE), "o")
    )


# --- sizes ---------------------------------------------------------------------------------------------

def shape_sizes(shapes: DataFrame, config: dict[str, int] | None = None) -> DataFrame:
    """Points per output time of each spatial shape, native and on each regular grid.

    ``latlon`` is 'o' or 'a' for shapes on a latitude-longitude plane and '' for the others; ``surface`` tells the
    two-dimensional ones.  A vertical dimension without a rule gives NULL sizes.
    """
    c = config or MODEL_CONFIG
    dims = F.split("dimensions", r"\|")
    last = F.element_at(dims, -1)
    vertical = F.when(last.isin("site", "basin"), F.try_element_at(dims, F.lit(-2))).otherwise(last)
    ocean_levels = vertical.startswith("olev") | (vertical == "rho")
    free = (
        F.when(ocean_levels, c["nlo"])
        .when(vertical.startswith("alev"), c["nla"])
        .when(vertical == "slevel", c["nls"])
        .when(vertical.isin("snowdepth", "sdepth"), SOIL_LEVELS)
        .when(vertical == "aslevel", c["nlas"])
    )
    nz = F.when(F.col("level_flag"), F.col("levels")).otherwise(free.cast("bigint"))
    plane = F.array_contains(dims, "latitude") & F.array_contains(dims, "longitude")
    side = F.when(~F.col("level_flag") & ocean_levels, "o").otherwise("a")
    latlon = F.when(plane, side).otherwise("")
    per_level = F.when(latlon == "o", c["nho"]).when(latlon == "a", c["nha"]).otherwise(OFF_GRID_POINTS).cast("bigint")
    regular = [
        (F.when(F.col("plane"), REGULAR_POINTS[g]).otherwise(OFF_GRID_POINTS).cast("bigint") * F.col("nz")).alias(f"size_{g}")
        for g in REGULAR_GRIDS
    ]
    return (
        shapes.select("uid", "label", nz.alias("nz"), plane.alias("plane"), latlon.alias("latlon"),
                      per_level.alias("nh"), (plane & (F.size(dims) == 2)).alias("surface"))
        .select("uid", "label", "latlon", "surface", "nz", (F.col("nh") * F.col("nz")).alias("size_native"), *regular)
    )


def extra_size(odims: Column) -> Column:
    """Length of the further dimension of a structure; 1 without one, the default for an unlisted one."""
    known = choose(odims, EXTRA_DIM_SIZE, EXTRA_DIM_DEFAULT)
    return F.when(F.coalesce(odims, F.lit("")) == "", 1).otherwise(known).cast("bigint")


def structure_sizes(structures: DataFrame, shapes: DataFrame, config: dict[str, int] | None = None) -> DataFrame:
    """Points per output time of each structure; zero, flagged, when its shape is not known."""
    sized = shape_sizes(shapes, config).withColumnsRenamed({"uid": "spid", "label": "shape_label"})
    cols = ["size_native"] + [f"size_{g}" for g in REGULAR_GRIDS]
    times = extra_size(F.col("odims"))
    scaled = [F.coalesce(F.col(c) * times, F.lit(0)).cast("bigint").alias(c) for c in cols]
    return (
        structures.select("uid", "spid", F.coalesce("odims", F.lit("")).alias("odims"))
        .join(sized, "spid", "left")
        .select("uid", "spid", "odims", "shape_label", F.coalesce("latlon", F.lit("")).alias("latlon"),
                F.col("size_native").isNotNull().alias("known"), *scaled)
    )


def size_on(grid: Column, latlon: Column) -> Column:
    """Picks the size of a row of ``structure_sizes`` for a settled grid."""
    by_grid = reduce(lambda acc, g: acc.when(grid == g, F.col(f"size_{g}")), REGULAR_GRIDS, F)
    return F.when((latlon == "") | (grid == "native"), F.col("size_native")).otherwise(by_grid)


def size_by_structure_and_grid(structures: DataFrame, shapes: DataFrame, config: dict[str, int] | None = None) -> DataFrame:
    """One row per (structure, grid): the sizes looked up again and again by the volume sums."""
    cols = {"native": "size_native", **{g: f"size_{g}" for g in REGULAR_GRIDS}}
    return structure_sizes(structures, shapes, config).unpivot(
        ["uid", "spid", "odims", "latlon"], list(cols.values()), "grid", "size"
    ).withColumn("grid", F.regexp_replace("grid", "^size_", ""))


def variable_sizes(variables: DataFrame, structures: DataFrame, shapes: DataFrame,
                   config: dict[str, int] | None = None, all_ocean: bool = False) -> DataFrame:
    """Variables with their sizes, outputs per year (in hundredths) and grid class."""
    sizes = structure_sizes(structures, shapes, config).withColumnRenamed("uid", "stid")
    return (
        variables.join(sizes, ["stid"], "left")
        .withColumn("grid_class", grid_class(F.col("modeling_realm"), F.coalesce("odims", F.lit("")),
                                             F.col("shape_label"), F.col("prov"), all_ocean))
        .withColumn("npy100", hundredths_per_year(F.col("frequency")))
    )
