"""Session settings and the shared work folder.

Intermediate tables live under the folder the cluster names in
``spark.checkpoint.dir``. A folder of our own is made only on a local master
that names none.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_WORK_DIRS: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables, on shared storage."""
    app = spark.sparkContext.applicationId
    if app not in _WORK_DIRS:
        root = spark.conf.get("spark.checkpoint.dir", None)
        root = root or spark.sparkContext.getCheckpointDir()
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            root = tempfile.mkdtemp(prefix="starloom-")
        _WORK_DIRS[app] = f"{root.rstrip('/')}/{app}"
    return _WORK_DIRS[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path nothing has been written to yet."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and continue from the files.

    Cuts the lineage on shared storage, so a lost executor costs one re-read
    and nothing upstream is computed a second time by several consumers.
    """
    path = new_path(df.sparkSession, name)
    df.write.partitionBy(*([partition_by] if partition_by else [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def setting[N: (int, float)](spark: SparkSession, name: str, default: N) -> N:
    """A number of ours, overridable as ``spark.starloom.<name>``."""
    return type(default)(spark.conf.get(f"spark.starloom.{name}", str(default)))
