"""Pieces shared by the training-data operators: columns, bounded samples, written tables."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def crc_mod(column: str, mod: int):
    """crc32 of a column's text, modulo."""
    return F.crc32(F.col(column).cast("string")) % F.lit(mod)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a folder of its own is set only where none is configured."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not place:
        place = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(place)
    return place.rstrip("/")


#: Bytes of an Arrow batch, about, where the session sets no bound of its own; a longer row is a batch.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes from now on, unless the session does so: rows hold whole texts, and both the executor and
    its Python worker hold a batch, so that 10,000 rows have no bound."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, group_rows: int | None = None) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts the lineage and survives lost executors.

    ``group_rows`` is for rows of megabytes: Spark's reader decodes thousands of rows at once, but none beyond a row group."""
    bound_batches(df.sparkSession)
    path = f"{shared_dir(df.sparkSession)}/siftspark-{uuid.uuid4().hex}"
    out = df.write if group_rows is None else df.write.option("parquet.block.row.count.limit", group_rows)
    out.parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._written_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes the files of tables that ``written`` made and that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_written_at", None)
        if path:
            place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def keyed(docs: DataFrame, key: str, name: str) -> DataFrame:
    """The rows with a column ``name`` that tells them apart: the key, or for rows whose key is null or repeated a number
    beyond all keys.  Without such rows nothing is copied; with them the rows are written once, so that numbers stay."""
    keys = docs.groupBy(F.col(key).cast("long").alias("_k")).agg(F.count("*").alias("_n"))
    odd = written(keys.where("_k is null or _n > 1").select("_k"))
    if not odd.take(1):
        forget(odd)
        return docs.withColumn(name, F.col(key).cast("long"))
    top = docs.agg(F.max(F.col(key).cast("long"))).first()[0] or 0
    numbered = written(docs.withColumn(name, F.monotonically_increasing_id() + F.lit(top + 1)))
    of = odd.select(F.col("_k").alias("_odd_key"))
    found = numbered.join(of, F.col(key).cast("long").eqNullSafe(F.col("_odd_key")), "left")
    own = F.when(F.col(key).isNull() | F.col("_odd_key").isNotNull(), F.col(name)).otherwise(F.col(key).cast("long"))
    return found.withColumn(name, own).drop("_odd_key")


def sampled_labels(labels: DataFrame, key: str, label: str, limit: int, where=None) -> tuple[DataFrame, dict]:
    """(sample, rows of each value before it).  About ``limit`` labelled rows of each value of ``label`` at most, chosen by a hash of the key.

    Rows with a null key or label are left out; of a key with several labels the smallest counts.  The share that is
    kept follows from the count of each value, so the result stays near the bound at every input size.
    """
    rows = labels.select(F.col(key).alias("_k"), F.col(label).alias("_y")).where("_k is not null and _y is not null")
    rows = rows.where(where("_k")) if where else rows
    rows = rows.groupBy("_k").agg(F.min("_y").alias("_y"))
    counts = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    unit = F.pmod(F.xxhash64("_k", F.lit(7)), F.lit(1 << 30))
    share = F.lit(0)
    for value, n in counts.items():
        share = F.when(F.col("_y") == F.lit(value), F.lit(int((1 << 30) * min(1.0, limit / n)))).otherwise(share)
    return rows.where(unit < share), counts


def prior_shift(counts: dict, positives: float) -> float:
    """What a log-odds learned on a sample with this share of positives lacks to hold for all counted rows."""
    yes = sum(n for value, n in counts.items() if value > 0)
    no = sum(counts.values()) - yes
    if not (yes and no and 0 < positives < 1):
        return 0.0
    return math.log(yes / no) - math.log(positives / (1 - positives))
