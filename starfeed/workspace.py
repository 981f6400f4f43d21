"""Where intermediate tables go."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder the session names in
    ``spark.checkpoint.dir``. A machine-local folder stands in only in the local modes, where
    all executors are on the driver's machine and see it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="starfeed-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back: computed one time, safe
    against lost executors, and of a size Spark knows when it plans the next join."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_if_there(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """The Parquet table at ``path``, or None if nothing was written there yet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def removed(spark: SparkSession, folders: Iterable[str]) -> None:
    """Deletes folders that nothing refers to any more; those that are not there are passed over."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
