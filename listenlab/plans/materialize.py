"""Cut lineage by writing a DataFrame as Parquet to the shared checkpoint
folder named by the session (``spark.checkpoint.dir``) and reading it back.

Used where several jobs consume one expensive intermediate (the stage, the
user-day base): they then scan files instead of re-running the session
window, and a lost executor costs a re-read, not a recomputation from the
source. The tables of an application lie in one folder of it; ``clear``
deletes them once the results that read them have been consumed."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from listenlab.session import checkpoint_dir


def _root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}-listenlab"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Delete everything that this application has materialized."""
    drop_folder(spark, _root(spark))


def materialize(df: DataFrame, name: str) -> DataFrame:
    path = new_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_observed(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``materialize`` and the measures that the write observed."""
    obs = Observation()
    return materialize(df.observe(obs, *[m.alias(k) for k, m in measures.items()]), name), dict(obs.get)
