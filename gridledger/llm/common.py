"""What the document operators share: the given tables, tables kept in the shared folder, and row identities."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors reach: ``spark.checkpoint.dir``; where that is unset, below the warehouse of a local session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The frame written to the shared folder and read again: later stages and lost executors start from those files."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Removes the files of a kept frame that nothing reads any more."""
    spark, folders = df.sparkSession, {f.rpartition("/")[0] for f in df.inputFiles()}
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: A key with more than one in so many of all rows is met by broadcast; there are fewer than this many such keys.
HOT_ONE_IN = 1000


def join_counted(rows: DataFrame, one: DataFrame, keys: list[str], one_in: int | None = None) -> DataFrame:
    """``rows`` with the columns of ``one``, which has a row for each of their keys and in ``n`` how many rows it has.

    The few keys with more than one in ``one_in`` of all rows are broadcast, so that their rows stay where they are; no task
    of the shuffled rest gets more than that share of one key. ``one`` is read several times and should be a kept table.
    """
    share = one_in or HOT_ONE_IN
    total = one.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * share > total
    hot = F.broadcast(one.where(is_hot).drop("n"))
    cold = one.where(~is_hot).drop("n")
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where the body names it inside other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def by_position(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame with columns c0, c1, … and the new name of each old one, so that no name of an operator can clash."""
    names = {name: f"c{i}" for i, name in enumerate(df.columns)}
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), names


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, as ``doc_id`` and ``text``."""
    return df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))
