"""Session and shared-folder helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "gridledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; everything else stays as the cluster configured it."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or one in the warehouse where that is unset."""
    return spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several results read, with files in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
