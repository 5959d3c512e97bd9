"""The nearest of many points for many places, in two dimensions.

The globe is cut into cells, each of which is cut into sixteen smaller ones, level by level. A cell with points knows one of them, which bounds how
far the nearest point of a place can be; a cell that lies wholly farther away than the best such bound is dropped with all that it holds.
The search goes down the levels for all places at once and compares points only in the few smallest cells that are left, so no place
meets all points. Longitudes wrap at 0 and 360. All joins are on cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP = 22.5          # degrees of a cell of the first level: 8 x 16 cells, whatever the points
FAN = 4             # cells along a side of one cell of the level before
LEVELS = 5
_SLACK = 1 + 1e-9   # rounding must not drop a cell that holds a point exactly at the bound


def squared_distance(lat: Column, lon: Column, other_lat: Column, other_lon: Column) -> Column:
    """In degrees, the shorter way around; longitudes from 0 to 360."""
    across = F.abs(lon - other_lon)
    across = F.least(across, F.lit(360.0) - across)
    along = lat - other_lat
    return along * along + across * across


def _cell(lat: Column, lon: Column, level: int) -> tuple[Column, Column]:
    side = TOP / FAN ** level
    rows = round(180 / side)
    return F.least(F.floor((lat + 90.0) / side), F.lit(rows - 1)), F.floor(lon / side)


def _squared_gap(i: Column, j: Column, level: int) -> Column:
    """From a place to the nearest edge of a cell, 0 within it."""
    side = TOP / FAN ** level
    south, west = i * side - 90.0, j * side
    lat, lon = F.col("lat"), F.col("lon")
    along = F.greatest(south - lat, lat - (south + side), F.lit(0.0))
    inside = (lon >= west) & (lon <= west + side)
    across = F.when(inside, 0.0).otherwise(F.least(F.pmod(west - lon, F.lit(360.0)), F.pmod(lon - (west + side), F.lit(360.0))))
    return along * along + across * across


def _on_globe(df: DataFrame, lat: str, lon: str, *cols: Column) -> DataFrame:
    rows = df.select(F.col(lat).cast("double").alias("lat"), F.pmod(F.col(lon).cast("double"), F.lit(360.0)).alias("lon"), *cols)
    return rows.where(F.col("lat").between(-90, 90) & F.col("lon").isNotNull())


def nearest_points(places: DataFrame, points: DataFrame, place_id: str, point_id: str, lat: str = "lat", lon: str = "lon", levels: int = LEVELS) -> DataFrame:
    """``(place_id, point_id, distance)``: the nearest point of each place in degrees, of equally near ones the smallest id.

    Places and points at the same spot are searched for once. A place or point without a latitude from -90 to 90 or without a longitude is left out; without points
    there are no rows. ``levels`` sets the size of the smallest cells: 5 is 0.09 degrees, each more is a quarter of it; points that lie much closer
    together than that are compared one by one.
    """
    spots = _on_globe(points, lat, lon, F.col(point_id).alias("id")).groupBy("lat", "lon").agg(F.min("id").alias("id"))
    last = levels - 1
    i, j = _cell(F.col("lat"), F.col("lon"), last)
    spots = spots.select("lat", "lon", "id", i.alias("i"), j.alias("j"))
    cells = {last: spots.groupBy("i", "j").agg(F.min(F.struct("lat", "lon")).alias("some"))}
    for level in range(last, 0, -1):
        up = [F.floor(F.col(c) / FAN).alias(c) for c in ("i", "j")]
        cells[level - 1] = cells[level].select(*up, "some").groupBy("i", "j").agg(F.min("some").alias("some"))

    wanted = _on_globe(places, lat, lon).distinct()
    far = lambda some: squared_distance(F.col("lat"), F.col("lon"), some["lat"], some["lon"])
    first = cells[0].agg(F.collect_list(F.struct("i", "j", "some")).alias("first")).select("first").scalar()       # at most 128 cells
    known = wanted.withColumn("first", first).withColumn("bound", F.array_min(F.transform("first", lambda c: far(c["some"]))))
    near = F.filter("first", lambda c: _squared_gap(c["i"], c["j"], 0) <= F.col("bound") * _SLACK)
    left = known.select("lat", "lon", "bound", F.inline(F.transform(near, lambda c: F.struct(c["i"].alias("i"), c["j"].alias("j")))))
    of_place = Window.partitionBy("lat", "lon")
    for level in range(1, levels):
        inner = cells[level].select("i", "j", "some", F.floor(F.col("i") / FAN).alias("pi"), F.floor(F.col("j") / FAN).alias("pj"))
        met = left.withColumnsRenamed({"i": "pi", "j": "pj"}).join(inner, ["pi", "pj"]).withColumn("far", far(F.col("some")))
        met = met.withColumn("bound", F.least("bound", F.min("far").over(of_place)))
        left = met.where(_squared_gap(F.col("i"), F.col("j"), level) <= F.col("bound") * _SLACK).select("lat", "lon", "bound", "i", "j")

    end = spots.select("i", "j", "id", F.struct("lat", "lon").alias("some"))
    met = left.join(end, ["i", "j"])
    best = met.groupBy("lat", "lon").agg(F.min(F.struct(far(F.col("some")).alias("d"), "id")).alias("best"))
    asked = _on_globe(places, lat, lon, F.col(place_id).alias("place"))
    return asked.join(best, ["lat", "lon"]).select(F.col("place").alias(place_id), F.col("best.id").alias(point_id), F.sqrt("best.d").alias("distance"))
