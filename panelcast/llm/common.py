"""What the training-data operators share."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import shared_folder

#: Bytes of rows in one Arrow batch. Texts run to megabytes, so rows alone bound nothing.
BATCH_BYTES = "4m"
#: Session setting that overrides the bytes of a batch.
BATCH_SETTING = "panelcast.text.batchBytes"
#: The six characters that separate words: \x20 and \x09 to \x0D.
SPACES = b" \t\n\v\f\r"


def bounded_batches(spark: SparkSession, size: str = BATCH_BYTES) -> None:
    """Let the bytes, not the rows, bound what a Python worker receives at once.

    A session may set another size (``BATCH_SETTING``), as where the workers of several stages live side by side.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", spark.conf.get(BATCH_SETTING, size))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and read them back."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table, through the file system that holds it."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def strings(values: pa.Array) -> list[str]:
    """Texts of an Arrow column, null as the empty text."""
    return [v or "" for v in values.to_pylist()]


def raw(values: pa.Array) -> list[bytes]:
    """UTF-8 bytes of an Arrow column, null as no bytes."""
    return [v or b"" for v in values.cast(pa.binary()).to_pylist()]


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of the frame is called so, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_facts(rows: DataFrame, facts: DataFrame, keys: list[str], times: str, most: int) -> DataFrame:
    """Inner join of rows with what is known of their keys, however often one key occurs.

    ``facts`` has one row per key, and in ``times`` how many rows have it. Keys of at least one in ``most`` of all
    rows are ``most`` at the utmost: those are broadcast. No other key can make a task of a shuffled join large.
    Null keys meet null keys. ``facts`` is read three times.
    """
    total = facts.agg(F.coalesce(F.sum(times), F.lit(0))).first()[0]
    frequent = F.col(times) * F.lit(most) >= F.lit(total)
    often, seldom = facts.where(frequent).drop(times), facts.where(~frequent).drop(times)

    def met(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        named = right.select(*[F.col(k).alias(f"{k}!") if k in keys else F.col(k) for k in right.columns])
        same = [F.col(k).eqNullSafe(F.col(f"`{k}!`")) for k in keys]
        return left.join(F.broadcast(named) if right is often else named, same, how).drop(*[f"{k}!" for k in keys])

    rest = met(rows, often, "left_anti")
    return met(rows, often, "inner").unionByName(met(rest, seldom, "inner"))
