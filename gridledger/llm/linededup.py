"""Line deduplication over overlapping windows of three lines.

Every window of consecutive lines is hashed (128 bits) and its occurrences are counted over all documents; the first one,
by document id and position, stays. The lines that later occurrences cover, merged per document, are removed. The first
place of a line is never covered by a later occurrence, so no line vanishes from the whole collection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import by_position, join_counted, kept

WINDOW = 3
#: A window with more than one in so many occurrences of repeated ones is met by broadcast; there are fewer than this many.
HOT_ONE_IN = 1000


def _lines(text):
    return F.split(text, "\n", -1)


def windows(df: DataFrame, width: int = WINDOW) -> DataFrame:
    """``doc_id, th, pos, h1, h2`` of every window with a line that is not blank; ``df`` has ``doc_id`` and ``text``."""
    rows = df.select("doc_id", F.xxhash64("text").alias("th"), _lines(F.col("text")).alias("lines")).where(F.size("lines") >= width)

    def window(i):
        part = F.slice(F.col("lines"), i + 1, width)
        return F.struct(i.alias("pos"), F.xxhash64(part).alias("h1"), F.xxhash64(F.lit("window"), part).alias("h2"),
                        F.exists(part, lambda x: F.trim(x) != "").alias("said"))

    found = F.transform(F.sequence(F.lit(0), F.size("lines") - width), window)
    return rows.select("doc_id", "th", F.inline(found)).where("said").drop("said")


def later_windows(found: DataFrame) -> DataFrame:
    """The occurrences of repeated windows that are not the first of their window."""
    place = F.struct("doc_id", "th", "pos")
    counts = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = join_counted(found, kept(counts, "repeated-windows"), ["h1", "h2"], HOT_ONE_IN)
    return met.where(~place.eqNullSafe(F.col("first"))).select("doc_id", "th", "pos")


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """The rows with their text less the lines of repeated windows, and ``lines`` and ``removed`` as last columns.

    A null text stays null with 0 lines; a text of fewer lines than a window keeps them all; windows of blank lines
    are not compared. Rows with equal id and text count as one document. A null id comes before all others. Columns of
    any names are carried along; the two new ones come last, by position.
    """
    plain, names = by_position(df)
    doc_id, text = F.col(names[id_col]), F.col(names[text_col])
    found = kept(windows(plain.select(doc_id.cast("long").alias("doc_id"), text.alias("text")), width), "windows")
    covered = later_windows(found).groupBy("doc_id", "th").agg(F.collect_set("pos").alias("places"))
    right = covered.select(F.col("doc_id").alias("w_doc"), F.col("th").alias("w_th"), "places")
    joined = plain.join(right, doc_id.cast("long").eqNullSafe(F.col("w_doc")) & (F.xxhash64(text) == F.col("w_th")), "left")
    gone = F.flatten(F.transform("places", lambda p: F.sequence(p, p + (width - 1))))
    lines = _lines(text)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    with_left = joined.select(*plain.columns, lines.alias("w_lines"), F.when(F.col("places").isNotNull(), left).alias("w_left"))
    rest = F.transform("w_left", lambda i: F.element_at(F.col("w_lines"), i + 1))
    new_text = F.when(F.col("w_left").isNull(), text).otherwise(F.array_join(rest, "\n"))
    count = F.coalesce(F.when(text.isNotNull(), F.size("w_lines")), F.lit(0))
    removed = F.coalesce(count - F.size("w_left"), F.lit(0))
    removed = F.when(F.col("w_left").isNull(), F.lit(0)).otherwise(removed)
    out = with_left.select(*[new_text.alias(c) if c == names[text_col] else F.col(c) for c in plain.columns], count, removed)
    return out.toDF(*df.columns, "lines", "removed")


SQL = """
WITH doc AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
 place AS (SELECT doc_id, unnest(range(0, len(lines) - 2)) AS pos FROM doc WHERE len(lines) >= 3),
 win AS (SELECT place.doc_id, pos, lines[pos + 1:pos + 3] AS w FROM place JOIN doc USING (doc_id)),
 ranked AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS k FROM win
  WHERE list_bool_or([trim(w[1], ' ') <> '', trim(w[2], ' ') <> '', trim(w[3], ' ') <> ''])),
 gone AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS line FROM ranked WHERE k > 1),
 line AS (SELECT doc_id, unnest(range(0, len(lines))) AS line FROM doc),
 stay AS (SELECT l.doc_id, string_agg(d.lines[l.line + 1], chr(10) ORDER BY l.line) AS text, count(*) AS n
  FROM line l JOIN doc d USING (doc_id) LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.line = l.line WHERE g.line IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(stay.text, '') END AS text, CAST(coalesce(len(d.lines), 0) AS INTEGER) AS lines,
 CAST(coalesce(len(d.lines) - coalesce(stay.n, 0), 0) AS INTEGER) AS removed
FROM doc d LEFT JOIN stay ON stay.doc_id = d.doc_id
"""
