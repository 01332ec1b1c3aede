"""Intermediate tables in the shared folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


BATCH_ROWS = 1000


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local folder is set only where none is named and Spark runs in this process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    folder = tempfile.mkdtemp(prefix="shelfspark-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: its lineage ends there.

    Shuffle files of what led to it are released once the driver's JVM collects their handles.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, of which texts will go to Python: batches get at most BATCH_ROWS rows, so that long texts fit in a worker."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def dropped(*tables: DataFrame) -> None:
    """Deletes tables of ``stored`` that no later step reads."""
    for table in tables:
        jvm = table.sparkSession._jvm
        for file in table.inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)
