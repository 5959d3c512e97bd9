"""Searching a dataset catalogue: facets, counts, newest dataset, files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def title_contains(df: DataFrame, text: str, *cols: str) -> DataFrame:
    """Records whose title contains a text, in any case."""
    found = df.where(F.lower("title").contains(text.lower()))
    return found.select(*cols) if cols else found


def facet_search(df: DataFrame, **facets) -> DataFrame:
    """All facets must match: a list is any of its values, and a facet with several values matches by any of them."""
    types = dict(df.dtypes)

    def matches(name: str, wanted) -> Column:
        values = list(wanted) if isinstance(wanted, (list, tuple, set)) else [wanted]
        if types[name].startswith("array"):
            return F.arrays_overlap(F.col(name), F.array(*[F.lit(v) for v in values]))
        return F.col(name).isin(values)

    return df.where(reduce(lambda a, b: a & b, [matches(k, v) for k, v in facets.items()], F.lit(True)))


def hit_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("hits"))


def any_hit(df: DataFrame) -> DataFrame:
    """One row telling whether there is a hit; stops at the first one found."""
    return df.select(F.lit(1).alias("one")).limit(1).agg((F.count(F.lit(1)) > 0).alias("found"))


def present(df: DataFrame, field: str) -> DataFrame:
    return df.where(F.col(field).isNotNull())


def first_value(facet: Column, default: str | None = None) -> Column:
    """First value of a facet; ``default`` if it is absent."""
    value = F.get(facet, F.lit(0))
    return value if default is None else F.coalesce(value, F.lit(default))


def iso_time(text: Column) -> Column:
    """ISO time text with its Z dropped."""
    return F.to_timestamp(F.replace(text, F.lit("Z"), F.lit("")))


def distinct_values(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Sorted distinct values of each key, one per row; absent and empty values do not count."""
    return df.where(F.col(value).isNotNull() & (F.col(value) != "")).select(*keys, value).distinct().orderBy(*keys, value)


def distinct_counts(df: DataFrame, value: str, *keys: str, default: str | None = "-") -> DataFrame:
    v = F.col(value) if default is None else F.coalesce(F.col(value).cast("string"), F.lit(default))
    return df.groupBy(*keys).agg(F.count_distinct(v).alias("members"))


def newest(df: DataFrame, key: str, time: str, ident: str, *cols: str) -> DataFrame:
    """The newest record per key; of equal times the one with the lowest id.  Combines on the map side, without a sort."""
    # the least (negative time, id) is the newest record with the lowest id
    order = F.struct((-F.unix_micros(F.col(time).cast("timestamp"))).alias("_order"), F.col(ident), F.col(time), *[F.col(c) for c in cols])
    return df.where(F.col(time).isNotNull()).groupBy(key).agg(F.min(order).alias("r")).select(
        key, F.col(f"r.{ident}"), F.col(f"r.{time}"), *[F.col(f"r.{c}") for c in cols])


def without_time(df: DataFrame, key: str, time: str) -> DataFrame:
    """Keys none of whose records has a time."""
    return df.groupBy(key).agg(F.count(time).alias("n")).where(F.col("n") == 0).select(key)


def files_of(datasets: DataFrame, files: DataFrame, key: str) -> DataFrame:
    return files.join(datasets, [key])


def file_counts(files: DataFrame, key: str) -> DataFrame:
    return files.groupBy(key).agg(F.count(F.lit(1)).alias("files"))


def first_files(files: DataFrame, order: Sequence[str], n: int = 15) -> DataFrame:
    """The first files in order, for a short listing."""
    return files.orderBy(*order).limit(n)
