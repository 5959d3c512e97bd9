"""Statistics of gridded values in long form ``(…, time, lat, lon, value)``.

Quantiles are exact.  The values of a group are counted and ordered as they are; of a group that is too large for one task, a
sketch with a known error bound gives a range around each wanted rank, only the values in those ranges are ordered, and
what lies between them is counted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridledger.lookup import KELVIN_OFFSET

QUARTILES = (0.25, 0.5, 0.75)
RANGE_ROWS = 1_000_000   # values that one task orders
MOST_GROUPS = 65_536     # groups whose ranges are broadcast, the largest ones; any other has less than one in so many of all values
SKETCH_ACCURACY = 100_000
AXIS_PARTS = 1024        # parts of an axis, of about equally many values


def to_celsius(df: DataFrame, value: str = "value", units: str = "units") -> DataFrame:
    """Kelvin values in degrees Celsius with the unit changed; values of other units stay as they are."""
    kelvin = F.lower(F.col(units)) == "k"
    return (df.withColumn(value, F.when(kelvin, F.col(value) - F.lit(KELVIN_OFFSET)).otherwise(F.col(value)))
            .withColumn(units, F.when(kelvin, F.lit("°C")).otherwise(F.col(units))))


def celsius_attributes(attrs: Column) -> Column:
    """The attribute map after conversion: all attributes kept, the unit replaced if it was Kelvin."""
    kelvin = F.coalesce(F.lower(F.try_element_at(attrs, F.lit("units"))) == "k", F.lit(False))
    rest = F.map_filter(attrs, lambda k, v: k != "units")
    return F.when(kelvin, F.map_concat(rest, F.create_map(F.lit("units"), F.lit("°C")))).otherwise(attrs)


def east_longitude(lon: Column) -> Column:
    """Longitude in 0 to 360."""
    return F.pmod(lon, F.lit(360.0))


def month_name(time: Column) -> Column:
    return F.date_format(time, "MMMM")


def long_from_chunks(df: DataFrame, values: str, *keys: str, index: str = "cell", value: str = "value") -> DataFrame:
    """One row per cell of chunked grid values."""
    return df.select(*keys, F.posexplode(values).alias(index, value))


def long_from_grid(chunks: DataFrame, lats: DataFrame, lons: DataFrame, n_lon: int) -> DataFrame:
    """Cells of ``chunks(time, values)`` with their coordinates; ``lats(i, lat)`` and ``lons(j, lon)`` are the axes."""
    cells = chunks.select("time", F.posexplode("values").alias("cell", "value"))
    cells = cells.withColumn("i", (F.col("cell") / n_lon).cast("int")).withColumn("j", F.col("cell") % n_lon)
    return cells.join(lats, "i").join(lons, "j").select("time", "lat", "lon", "value")


def global_stats(df: DataFrame, value: str = "value", *keys: str) -> DataFrame:
    """Smallest, largest and mean value without nulls, and the number of nulls."""
    v = F.col(value)
    return df.groupBy(*keys).agg(F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean"),
                                 F.count_if(v.isNull()).alias("nulls"))


def axis_profile(df: DataFrame, *axes: str) -> DataFrame:
    """Size and range of each coordinate; every coordinate is a scan of its own column."""
    def one(a: str) -> DataFrame:
        return df.select(a).distinct().agg(F.count(a).alias("size"), F.min(a).cast("string").alias("low"), F.max(a).cast("string").alias("high")).select(
            F.lit(a).alias("axis"), "size", "low", "high")

    return reduce(DataFrame.unionByName, [one(a) for a in axes])


# --- quantiles -----------------------------------------------------------------------------------------

def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float] = QUARTILES, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Exact quantiles with linear interpolation: the keys and one column ``q0``, ``q1``, … per probability.

    Groups without values are left out; a null key is a group.  The rows are read twice, once for the sketches.  A rank outside
    its range, which the error bound of the sketch rules out, is an error.
    """
    probs, given = list(probs), list(keys)
    keys = given or ["_all"]
    have = df.where(F.col(value).isNotNull()).select(*given, *([] if given else [F.lit(0).alias("_all")]), F.col(value).cast("double").alias("_v"))
    # three times the error of the sketch, and at least three ranks of the smallest group that is cut
    width = 3.0 / min(range_rows, SKETCH_ACCURACY)
    marks = sorted({min(1.0, max(0.0, p + side * width)) for p in probs for side in (-1, 1)})
    sketched = have.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", marks, SKETCH_ACCURACY).alias("_cuts"))
    cuts = sketched.where(F.col("_n") > range_rows).orderBy(F.desc("_n"), *keys).limit(MOST_GROUPS).select(*keys, "_cuts")

    v = F.col("_v")
    low, high = ([F.get("_cuts", F.lit(marks.index(min(1.0, max(0.0, p + side * width))))) for p in probs] for side in (-1, 1))
    inside = reduce(lambda a, b: a | b, [(v >= lo) & (v <= hi) for lo, hi in zip(low, high)], F.col("_cuts").isNull())
    below = reduce(F.greatest, [F.when(hi < v, hi) for hi in high], F.lit(None).cast("double"))
    placed = have.join(F.broadcast(cuts), keys, "left").select(
        *keys, F.when(inside, v).otherwise(below).alias("_v"), (~inside).alias("_between"))
    rows = placed.groupBy(*keys, "_v", "_between").agg(F.count(F.lit(1)).alias("_n"))

    group = Window.partitionBy(*keys)
    upto = F.sum("_n").over(group.orderBy("_v", "_between").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ordered = rows.select("*", upto.alias("_upto"), F.sum("_n").over(group).alias("_total"))
    last = F.col("_total") - 1
    found, out = [], []
    for i, p in enumerate(probs):
        for name, rank in ((f"_a{i}", F.floor(F.lit(p) * last)), (f"_b{i}", F.ceil(F.lit(p) * last))):
            here = (rank < F.col("_upto")) & (rank >= F.col("_upto") - F.col("_n"))
            outside = F.raise_error(F.lit("a rank lies outside of the range of values that a sketch gave for it")).cast("double")
            found.append(F.max(F.when(here, F.when(F.col("_between"), outside).otherwise(v))).alias(name))
        pos = F.lit(p) * last
        out.append((F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * (pos - F.floor(pos))).alias(f"q{i}"))
    return ordered.groupBy(*keys).agg(F.max("_total").alias("_total"), *found).select(*given, *out)


def quantile_rows(q: DataFrame, keys: Sequence[str], labels: Sequence[str] = ("Q1", "Q2", "Q3")) -> DataFrame:
    """Quantiles laid out as rows ``(keys, quantile, value)`` under labels."""
    named = q.select(*keys, *[F.col(f"q{i}").alias(l) for i, l in enumerate(labels)])
    return named.unpivot(list(keys), list(labels), "quantile", "value")


def box_fences(df: DataFrame, keys: Sequence[str], value: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Quartiles and the fences one and a half interquartile ranges beyond them."""
    q = quantiles(df, keys, value, QUARTILES, range_rows).select(
        *keys, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return q.withColumn("low_fence", F.col("q1") - 1.5 * iqr).withColumn("high_fence", F.col("q3") + 1.5 * iqr)


def box_stats(df: DataFrame, keys: Sequence[str], value: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Quartiles, whiskers (the most extreme values inside the fences, never inside the box) and number of outliers."""
    keys = list(keys)
    fences = box_fences(df, keys, value, range_rows)
    v = F.col("_v")
    have = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    rows = have.join(fences, keys)
    inside = (v >= F.col("low_fence")) & (v <= F.col("high_fence"))
    return rows.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(v >= F.col("low_fence"), v)).alias("_low"), F.max(F.when(v <= F.col("high_fence"), v)).alias("_high"),
        F.count(F.lit(1)).alias("n"), F.count_if(~inside).alias("outliers"),
    ).select(*keys, "n", "q1", "median", "q3", F.least("_low", "q1").alias("low_whisker"),
             F.greatest("_high", "q3").alias("high_whisker"), "outliers")


def box_outliers(df: DataFrame, keys: Sequence[str], value: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The rows beyond the fences."""
    fences = box_fences(df, keys, value, range_rows).select(*keys, "low_fence", "high_fence")
    return df.join(fences, list(keys)).where(
        (F.col(value) < F.col("low_fence")) | (F.col(value) > F.col("high_fence"))).drop("low_fence", "high_fence")


def box_by_month(df: DataFrame, time: str, value: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Box statistics of the twelve calendar months in order; a month without values has empty statistics."""
    spark = df.sparkSession
    months = spark.range(1, 13).select(F.col("id").alias("month"), month_name(F.make_date(F.lit(2000), F.col("id").cast("int"), F.lit(1))).alias("name"))
    stats = box_stats(df.select(F.month(time).cast("bigint").alias("month"), value), ["month"], value, range_rows)
    return months.join(stats, "month", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn(
        "outliers", F.coalesce("outliers", F.lit(0))).orderBy("month")


# --- nearest -------------------------------------------------------------------------------------------

def point_series(df: DataFrame, lat: float, lon: float, time: str = "time") -> DataFrame:
    """The ordered time series of the grid point nearest to a place; western longitudes count as 0 to 360.

    Both coordinates are found in one pass.
    """
    def nearest(axis: str, x: float) -> Column:
        return F.min(F.struct(F.abs(F.col(axis) - F.lit(float(x))).alias("d"), F.col(axis)))[axis].alias(axis)

    place = df.agg(F.struct(nearest("lat", lat), nearest("lon", lon % 360.0)).alias("place")).scalar()
    return df.where(F.struct("lat", "lon") == place).orderBy(time)


def nearest_values(targets: DataFrame, coords: DataFrame, target: str, coord: str, parts: int = AXIS_PARTS) -> DataFrame:
    """For many targets at once: each distinct target with the closest coordinate, the smaller of two equally close.

    Targets and coordinates are ordered within parts of the axis that hold about equally many of them; what lies beyond a part
    comes from a table with one row per part.  Where the cuts fall does not matter.
    """
    c = coords.select(F.col(coord).cast("double").alias("x")).distinct()
    t = targets.select(F.col(target).cast("double").alias("x")).distinct()
    marked = c.withColumn("coord", F.col("x")).unionByName(t.withColumn("coord", F.lit(None).cast("double")))
    step = max(2, int(parts ** 0.5))
    shares = ", ".join(f"{i / parts!r}D" for i in range(1, parts))
    cuts = marked.agg(F.expr(f"array_distinct(percentile_approx(x, array({shares}), {10 * parts}))").alias("fine"))
    cuts = cuts.select("fine", F.filter("fine", lambda v, i: i % step == step - 1).alias("coarse"))
    marked = marked.withColumns({"fine": cuts.select("fine").scalar(), "coarse": cuts.select("coarse").scalar()})
    # the number of cuts below a value, found in two short steps
    marked = marked.withColumn("step", F.size(F.filter("coarse", lambda v: v < F.col("x"))))
    block = F.slice("fine", F.col("step") * step + 1, F.lit(step - 1))
    part = F.col("step") * step + F.size(F.filter(block, lambda v: v < F.col("x")))
    marked = marked.select("x", "coord", part.alias("part"))
    by_part = marked.groupBy("part").agg(F.min("coord").alias("first"), F.max("coord").alias("last"))   # at most one row per cut
    back = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(F.lit(0)).orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    beyond = by_part.select("part", F.last("last", ignorenulls=True).over(back).alias("before"),
                            F.last("first", ignorenulls=True).over(ahead).alias("after"))
    # at equal places the coordinate comes before the target, in both directions
    upwards = Window.partitionBy("part").orderBy("x", F.asc_nulls_last("coord")).rowsBetween(Window.unboundedPreceding, 0)
    downwards = Window.partitionBy("part").orderBy(F.desc("x"), F.asc_nulls_last("coord")).rowsBetween(Window.unboundedPreceding, 0)
    found = marked.select("part", "x", "coord", F.last("coord", ignorenulls=True).over(upwards).alias("below"),
                          F.last("coord", ignorenulls=True).over(downwards).alias("above"))
    found = found.where(F.col("coord").isNull()).join(F.broadcast(beyond), "part", "left")
    below, above = F.coalesce("below", "before"), F.coalesce("above", "after")
    pick = F.when(above.isNull(), below).when(below.isNull(), above).when(F.col("x") - below <= above - F.col("x"), below).otherwise(above)
    return found.select(F.col("x").alias(target), pick.alias(coord))
