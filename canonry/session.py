"""Session helpers shared by every operator: table access and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; one of our own only where the session names none.

    A cluster names its folder in ``spark.checkpoint.dir``, which every executor can
    reach. Only a session without it (tests, a laptop) gets a local folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not sc._jsc.sc().getCheckpointDir().isDefined() and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), f"canonry-{os.getuid()}"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` as a table into the shared folder and read it again.

    The table outlives any executor. Unlike ``checkpoint()``, which hands on estimated
    sizes that multiply over the joins of an iteration, it has sizes as they are, so the
    joins behind it are planned by true sizes.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_path = path  # for release()
    return out


def release(*frames: DataFrame) -> None:
    """Delete the tables behind results of ``cut`` that are no longer read."""
    for df in frames:
        if path := getattr(df, "_cut_path", None):
            sc = df.sparkSession.sparkContext
            where = sc._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
