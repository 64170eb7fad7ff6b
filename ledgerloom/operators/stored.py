"""Write an intermediate result once, read it back as a plain column-pruned scan.

This is what cuts lineage here: a lost executor costs a re-read of files, never a
recomputation that could sample or sum in a different order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import PARQUET, shared_folder, shuffles_removed


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/ledgerloom/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def drop_stored(spark: SparkSession) -> None:
    """Remove what this application has stored, when no result that reads it is needed any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet under the shared folder and return a scan of it."""
    path = new_folder(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.options(**PARQUET).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
