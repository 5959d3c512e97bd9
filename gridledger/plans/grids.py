"""Queries on values over time and space: events are a time-stamped series, embeddings are chunked grid rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.operators import chunks as H
from gridledger.operators import gridstats as G
from gridledger.operators import states as T
from gridledger.operators.nearest import nearest_points
from gridledger.operators.search import iso_time
from gridledger.plans.registry import query
from gridledger.plans.roles import Catalogue

DAY = "strftime(ts, '%Y-%m-%d')"


def series(cat: Catalogue) -> DataFrame:
    """Events as values, in Kelvin for even users."""
    return cat["events"].select("event_id", "ts", "event_type", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"),
                                F.col("value"), F.when(F.col("user_id") % 2 == 0, "K").otherwise("m").alias("units"))


@query("unit_conversion", """
SELECT event_id, CASE WHEN user_id % 2 = 0 THEN value - 273.15 ELSE value END AS value, CASE WHEN user_id % 2 = 0 THEN '°C' ELSE 'm' END AS units FROM events""")
def unit_conversion(cat):
    return G.to_celsius(series(cat)).select("event_id", "value", "units")


@query("grid_stats", """
SELECT event_type, round(min(v), 3) AS low, round(max(v), 3) AS high, round(avg(v), 3) AS mean, count(*) - count(v) AS nulls
 FROM (SELECT event_type, CASE WHEN user_id % 2 = 0 THEN value - 273.15 WHEN user_id % 7 = 1 THEN NULL ELSE value END AS v FROM events) GROUP BY event_type""")
def grid_stats(cat):
    gaps = series(cat).withColumn("value", F.when((F.col("user_id") % 7 != 1) | (F.col("units") == "K"), F.col("value")))
    s = G.global_stats(G.to_celsius(gaps), "value", "event_type")
    return s.select("event_type", *[F.round(c, 3).alias(c) for c in ("low", "high", "mean")], "nulls")


@query("quantiles_by_day", f"""
WITH q AS (SELECT {DAY} AS day, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.5) AS b, quantile_cont(value, 0.75) AS c FROM events GROUP BY 1)
SELECT day, 'Q1' AS quantile, round(a, 4) AS value FROM q UNION ALL SELECT day, 'Q2', round(b, 4) FROM q UNION ALL SELECT day, 'Q3', round(c, 4) FROM q""")
def quantiles_by_day(cat):
    rows = G.quantile_rows(G.quantiles(series(cat), ["day"], "value"), ["day"])
    return rows.withColumn("value", F.round("value", 4))


@query("median_by_type", "SELECT event_type, round(quantile_cont(value, 0.5), 4) AS value FROM events GROUP BY event_type")
def median_by_type(cat):
    rows = G.quantile_rows(G.quantiles(series(cat), ["event_type"], "value"), ["event_type"])
    return rows.where(F.col("quantile") == "Q2").select("event_type", F.round("value", 4).alias("value"))


@query("quantiles_in_ranges", f"""
SELECT event_type, round(quantile_cont(value, 0.1), 4) AS q0, round(quantile_cont(value, 0.5), 4) AS q1, round(quantile_cont(value, 0.99), 4) AS q2 FROM events GROUP BY event_type""")
def quantiles_in_ranges(cat):
    # with so few values to a task every group is cut into ranges
    q = G.quantiles(series(cat), ["event_type"], "value", (0.1, 0.5, 0.99), range_rows=50)
    return q.select("event_type", *[F.round(f"q{i}", 4).alias(f"q{i}") for i in range(3)])


@query("quantile_states", """
SELECT grain, event_type, p.prob, n, TRUE AS within FROM (SELECT 'type' AS grain, event_type, count(value) AS n FROM events GROUP BY event_type UNION ALL SELECT 'all', NULL, count(value) FROM events),
 (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) p(prob)""")
def quantile_states(cat):
    # sketches of every type and day, merged to types and to everything, against the exact quantiles
    daily = T.quantile_states(series(cat), ["event_type", "day"], "value")
    out = []
    for grain, keys in (("type", ["event_type"]), ("all", [])):
        bounds = T.quantile_bounds(T.merged_states(daily, keys), keys, G.QUARTILES)
        exact = G.quantiles(series(cat), keys, "value").unpivot(keys, ["q0", "q1", "q2"], "q", "value")
        exact = exact.withColumn("prob", F.when(F.col("q") == "q0", 0.25).when(F.col("q") == "q1", 0.5).otherwise(0.75))
        met = bounds.join(exact, [*keys, "prob"])
        kind = F.col("event_type") if keys else F.lit(None).cast("string").alias("event_type")
        out.append(met.select(F.lit(grain).alias("grain"), kind, "prob", "n", F.col("value").between(F.col("at_least"), F.col("at_most")).alias("within")))
    return out[0].unionByName(out[1])


def box_sql(rows: str, key: str) -> str:
    return f"""v AS ({rows}),
f AS (SELECT {key}, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
 SELECT {key}, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM v GROUP BY {key})),
b AS (SELECT v.{key}, count(*) AS n, q1, median, q3, least(q1, min(CASE WHEN x >= lo THEN x END)) AS low_whisker,
 greatest(q3, max(CASE WHEN x <= hi THEN x END)) AS high_whisker, CAST(sum(CASE WHEN x < lo OR x > hi THEN 1 ELSE 0 END) AS BIGINT) AS outliers
 FROM v JOIN f ON v.{key} = f.{key} GROUP BY v.{key}, q1, median, q3)"""


_BOX = ["q1", "median", "q3", "low_whisker", "high_whisker"]
_BOX_SQL = ", ".join(f"round({c}, 4) AS {c}" for c in _BOX)


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in _BOX})


@query("box_by_day", f"WITH {box_sql(f'SELECT {DAY} AS day, value AS x FROM events', 'day')} SELECT day, n, {_BOX_SQL}, outliers FROM b")
def box_by_day(cat):
    return rounded(G.box_stats(series(cat), ["day"], "value"))


@query("box_in_ranges", f"WITH {box_sql('SELECT event_type, value AS x FROM events', 'event_type')} SELECT event_type, n, {_BOX_SQL}, outliers FROM b")
def box_in_ranges(cat):
    return rounded(G.box_stats(series(cat), ["event_type"], "value", range_rows=50))


@query("box_outliers", f"""
WITH {box_sql(f'SELECT event_id, {DAY} AS day, value AS x FROM events', 'day')}
SELECT v.day, v.event_id, v.x AS value FROM v JOIN f ON v.day = f.day WHERE x < lo OR x > hi""")
def box_outliers(cat):
    return G.box_outliers(series(cat), ["day"], "value").select("day", "event_id", "value")


_MONTHS = ", ".join(f"({i + 1}, '{m}')" for i, m in enumerate(
    ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]))


@query("box_by_month", f"""
WITH {box_sql("SELECT CAST(month(o_orderdate) AS BIGINT) AS month, o_totalprice AS x FROM orders", 'month')}
SELECT CAST(m.month AS BIGINT) AS month, m.name, coalesce(n, 0) AS n, {_BOX_SQL}, coalesce(outliers, 0) AS outliers FROM (VALUES {_MONTHS}) m(month, name) LEFT JOIN b ON b.month = m.month""")
def box_by_month(cat):
    return rounded(G.box_by_month(cat["orders"], "o_orderdate", "o_totalprice"))


@query("box_by_month_events", f"""
WITH {box_sql("SELECT CAST(month(ts) AS BIGINT) AS month, value AS x FROM events", 'month')}
SELECT CAST(m.month AS BIGINT) AS month, m.name, coalesce(n, 0) AS n, {_BOX_SQL}, coalesce(outliers, 0) AS outliers FROM (VALUES {_MONTHS}) m(month, name) LEFT JOIN b ON b.month = m.month""")
def box_by_month_events(cat):
    return rounded(G.box_by_month(cat["events"], "ts", "value"))


@query("grid_long", """
SELECT vec_id, CAST(i - 1 AS INTEGER) AS cell, CAST(embedding[i] AS DOUBLE) AS value FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""")
def grid_long(cat):
    return G.long_from_chunks(cat["embeddings"], "embedding", "vec_id").withColumn("value", F.col("value").cast("double"))


def grid(cat: Catalogue) -> DataFrame:
    """Embeddings as levels of an 8 x 8 grid: time from the row, latitude and longitude from the place in the chunk."""
    chunks = cat["embeddings"].select(F.col("vec_id").alias("time"), F.col("embedding").alias("values"))
    spark = cat.spark
    lats = spark.range(8).select(F.col("id").cast("int").alias("i"), (F.lit(-70.0) + F.col("id") * 20).alias("lat"))
    lons = spark.range(8).select(F.col("id").cast("int").alias("j"), (F.col("id") * 45.0).alias("lon"))
    return G.long_from_grid(chunks, lats, lons, 8)


GRID = """g AS (SELECT vec_id AS time, -70.0 + 20 * floor((i - 1) / 8) AS lat, 45.0 * ((i - 1) % 8) AS lon, CAST(embedding[i] AS DOUBLE) AS value
 FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))"""


@query("grid_cells", f"WITH {GRID} SELECT time, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, value FROM g")
def grid_cells(cat):
    return grid(cat).withColumn("value", F.col("value").cast("double"))


@query("point_series", f"""
WITH {GRID} SELECT time, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, value FROM g WHERE lat = -30 AND lon = 315""")
def point_series(cat):
    return G.point_series(grid(cat), -23.5, -46.63).withColumn("value", F.col("value").cast("double"))


@query("dimension_profile", f"""
WITH {GRID} SELECT 'lat' AS axis, count(DISTINCT lat) AS size, CAST(min(lat) AS DOUBLE) AS low, CAST(max(lat) AS DOUBLE) AS high FROM g
UNION ALL SELECT 'lon', count(DISTINCT lon), CAST(min(lon) AS DOUBLE), CAST(max(lon) AS DOUBLE) FROM g UNION ALL SELECT 'time', count(DISTINCT time), min(time), max(time) FROM g""")
def dimension_profile(cat):
    p = G.axis_profile(grid(cat), "lat", "lon", "time")
    return p.select("axis", "size", F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"))


@query("nearest_point", """
WITH c AS (SELECT DISTINCT p_retailprice AS coord FROM part), t AS (SELECT DISTINCT round(900 + value * 3, 3) AS target FROM events),
lo AS (SELECT t.target, c.coord FROM t ASOF LEFT JOIN c ON t.target >= c.coord), hi AS (SELECT t.target, c.coord FROM t ASOF LEFT JOIN c ON t.target <= c.coord)
SELECT lo.target, CASE WHEN hi.coord IS NULL THEN lo.coord WHEN lo.coord IS NULL THEN hi.coord WHEN lo.target - lo.coord <= hi.coord - lo.target THEN lo.coord ELSE hi.coord END AS coord
 FROM lo JOIN hi ON lo.target = hi.target""")
def nearest_point(cat):
    targets = cat["events"].select(F.round(F.lit(900) + F.col("value") * 3, 3).alias("target"))
    return G.nearest_values(targets, cat["part"].select(F.col("p_retailprice").alias("coord")), "target", "coord")


PLACES = """t AS (SELECT c_custkey AS place, CAST(c_custkey * 7919 % 18001 AS DOUBLE) / 100.0 - 90.0 AS lat, CAST(c_custkey * 104729 % 36000 AS DOUBLE) / 100.0 AS lon FROM customer),
p AS (SELECT p_partkey AS point, CAST(p_partkey * 3571 % 17001 AS DOUBLE) / 100.0 - 85.0 AS lat, CAST(p_partkey * 15485863 % 30000 AS DOUBLE) / 100.0 AS lon FROM part)"""


def made_up(df: DataFrame, key: str, name: str, lat: tuple[int, int, float], lon: tuple[int, int]) -> DataFrame:
    """Rows at places that follow from their keys."""
    k = F.col(key).cast("bigint")
    return df.select(k.alias(name), ((k * lat[0] % lat[1]).cast("double") / 100.0 - lat[2]).alias("lat"), ((k * lon[0] % lon[1]).cast("double") / 100.0).alias("lon"))


@query("nearest_places", f"""
WITH {PLACES}, m AS (SELECT place, point, (t.lat - p.lat) * (t.lat - p.lat) + least(abs(t.lon - p.lon), 360.0::DOUBLE - abs(t.lon - p.lon)) * least(abs(t.lon - p.lon), 360.0::DOUBLE - abs(t.lon - p.lon)) AS d FROM t, p)
SELECT place, point, round(sqrt(d), 9) AS distance FROM m QUALIFY row_number() OVER (PARTITION BY place ORDER BY d, point) = 1""")
def nearest_places(cat):
    places = made_up(cat["customer"], "c_custkey", "place", (7919, 18001, 90.0), (104729, 36000))
    points = made_up(cat["part"], "p_partkey", "point", (3571, 17001, 85.0), (15485863, 30000))
    return nearest_points(places, points, "place", "point").withColumn("distance", F.round("distance", 9))


def levels(cat: Catalogue) -> DataFrame:
    """Embeddings as chunks of grid values, in ten groups, with a few values missing."""
    missing = lambda v, i: F.when((F.col("vec_id") + i) % 17 != 0, v.cast("double"))
    return cat["embeddings"].select("vec_id", (F.col("vec_id") % 10).alias("level"), F.transform("embedding", missing).alias("values"))


LEVELS = """e AS (SELECT vec_id, vec_id % 10 AS level, CASE WHEN (vec_id + i - 1) % 17 <> 0 THEN CAST(embedding[i] AS DOUBLE) END AS v
 FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))"""


@query("chunk_stats", f"WITH {LEVELS} SELECT level, min(v) AS low, max(v) AS high, round(avg(v), 6) AS mean, count(*) - count(v) AS nulls FROM e GROUP BY level")
def chunk_stats(cat):
    s = H.merged_stats(H.chunk_index(levels(cat), "values", "vec_id", "level"), "level")
    return s.withColumn("mean", F.round("mean", 6))


@query("chunk_extremes", f"WITH {LEVELS} SELECT vec_id, count(*) AS n FROM e WHERE v >= 0.3 GROUP BY vec_id")
def chunk_extremes(cat):
    chunks = levels(cat)
    return H.count_within(chunks, H.chunk_index(chunks, "values", "vec_id"), "values", ["vec_id"], low=0.3)


@query("chunk_series", f"WITH {LEVELS} SELECT vec_id, level, embedding[12]::DOUBLE AS value FROM (SELECT vec_id, vec_id % 10 AS level, embedding FROM embeddings WHERE (vec_id + 11) % 17 <> 0) UNION ALL SELECT vec_id, vec_id % 10, NULL FROM embeddings WHERE (vec_id + 11) % 17 = 0")
def chunk_series(cat):
    return H.cell_series(levels(cat), "values", 11, "vec_id", "level")


@query("longitude", "SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 360.0 - value % 360 ELSE value % 360 END % 360 AS lon FROM events")
def longitude(cat):
    lon = F.when(F.col("user_id") % 2 == 0, -F.col("value")).otherwise(F.col("value"))
    return cat["events"].select("event_id", G.east_longitude(lon).alias("lon"))


@query("time_parts", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, strftime(ts, '%B') AS month FROM events""")
def time_parts(cat):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    t = cat["events"].select("event_id", iso_time(text).alias("t"))
    return t.select("event_id", F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("at"), G.month_name(F.col("t")).alias("month"))


@query("unit_attributes", """
SELECT event_type, CASE WHEN user_id % 2 = 0 THEN '°C' ELSE 'm' END AS units, event_type AS standard_name, count(*) AS n FROM events GROUP BY ALL""")
def unit_attributes(cat):
    attrs = F.create_map(F.lit("units"), "units", F.lit("standard_name"), "event_type")
    new = G.celsius_attributes(F.col("attrs"))
    rows = series(cat).groupBy("event_type", "units").agg(F.count(F.lit(1)).alias("n")).withColumn("attrs", attrs)
    return rows.select("event_type", new["units"].alias("units"), new["standard_name"].alias("standard_name"), "n")
