"""Session settings shared by queries, tests and the bench."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, partitions: int = 8, app: str = "siftspark") -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table by name; any path that Spark itself can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_place(spark: SparkSession) -> str:
    """The folder that driver and executors share; one is named only where the session names none."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (place or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints").rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows with their lineage cut, in the shared folder of the session."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_place(df.sparkSession))
    return df.checkpoint(eager=True)
