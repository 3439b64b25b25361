"""Intermediate tables that cut lineage and survive lost executors."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tillroll.session import ensure_checkpoint_dir

# One list of folders per `scratch` that is open, the innermost last.
_open: list[list[str]] = []


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet under the session's checkpoint folder and read it back.

    Used where a frame feeds several later steps: they then read only the columns they need, and the
    planner knows the size. Within `scratch` the folder lasts as long as that; else it belongs to the
    session, and the cluster's clean-up removes it.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid4().hex}"
    if _open:
        _open[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the intermediate tables written inside when it ends, also after a failure."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
