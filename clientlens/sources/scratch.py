"""Intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate results: the one named by ``spark.checkpoint.dir``, or a
    folder below the warehouse, which all executors reach too."""
    root = spark.conf.get(_SETTING, None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return root.rstrip("/")


def _folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/clientlens-{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write the frame to the shared folder once and return a frame that reads it; by partitions of
    a column if one is named.

    Cuts the lineage without depending on executor storage: a lost executor only means
    reading the files again. Readers prune columns, unlike with a checkpoint.
    """
    spark = df.sparkSession
    path = f"{_folder(spark)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete everything this application wrote with :func:`materialise`."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
