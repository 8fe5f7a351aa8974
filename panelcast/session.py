"""Session defaults shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app: str = "panelcast", **conf: str) -> SparkSession:
    """Session with the library defaults; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if it names one."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: the cluster's folder, or on one machine a temporary one.

    On a cluster without ``spark.checkpoint.dir`` this raises, as executors would write to disks of their own.
    """
    named = checkpoint_dir(spark)
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="panelcast-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


_owned: list[list[str]] = []


@contextmanager
def settled_within(spark: SparkSession) -> Iterator[None]:
    """Own the tables that ``settle`` writes in this block, and remove them at its end.

    For jobs whose result is written inside the block; frames that read the tables are of no use afterwards.
    """
    _owned.append([])
    try:
        yield
    finally:
        for path in _owned.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def settle(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Operators that pass over the same rows more than once settle them first. Every pass then sees
    the same values (a sum of doubles may differ in its last bits when it is computed again), the
    upstream plan runs once, and a lost executor costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    if _owned:
        _owned[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
