"""Tables kept in the shared folder that the session names in
``spark.checkpoint.dir``: they cut lineage, and a lost executor costs a read."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import listenlab
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlab.session import checkpoint_dir


def _root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}-llm"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return it read back."""
    spark = df.sparkSession
    path = f"{_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete every table that ``keep`` wrote in this application. Results
    that still read them must have been consumed before."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def packed(docs: DataFrame, body: str, **needed: Column) -> DataFrame:
    """``row``, a struct of the columns of ``docs``, the needed ones, and the
    column ``body`` by itself, as ``body``: the names of the columns then meet
    no name that an operator uses, and a text is carried once."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != body] or [F.lit(True).alias("_")]
    return docs.select(F.struct(*others).alias("row"), F.col(f"`{body}`").alias("body"), *[c.alias(n) for n, c in needed.items()])


def unpacked(frame: DataFrame, columns: list[str], body: str, **results: Column) -> DataFrame:
    """The columns as they were, and the results; a result replaces a column of its name."""
    own = [(F.col("body") if c == body else F.col("row")[c]).alias(c) for c in columns if c not in results]
    return frame.select(*own, *[c.alias(n) for n, c in results.items()])


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library to the executors, once per application, so that
    their Python workers can import the functions they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(listenlab.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="listenlab-"), "listenlab.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("listenlab", os.path.relpath(full, top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


#: Bytes of an Arrow batch. Spark's default of 64 MB is held several times
#: over outside the heap, for each task, when the rows hold texts.
BATCH_BYTES = str(8 << 20)
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_arrow(df: DataFrame, function, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` whose function lives in this library. The session's
    batch size is lowered if it still has Spark's default."""
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(_BATCH_SETTING) == "67108864b":
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)
    return df.mapInArrow(function, schema)
