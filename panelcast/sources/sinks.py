"""Writers: partitioned overwrite, evolving append, keyed upsert, catalog tables, exports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.operators.blocks import as_keys
from panelcast.operators.quality import dedup_any, dedup_ordered
from panelcast.session import settle, settled_within
from panelcast.sources.readers import _exists


def _spread_files(df: DataFrame, by: list[str], files: int) -> DataFrame:
    """Shuffle rows to their partition directory, each directory over up to ``files`` tasks."""
    if not by:
        return df
    rest = [c for c in df.columns if c not in by]
    slot = F.pmod(F.xxhash64(*rest), F.lit(files)) if rest else F.lit(0)
    return df.repartition(*by, slot)


def write_partitioned(
    df: DataFrame, path: str, by: Iterable[str] = (), files: int = 4, replace: bool = True
) -> None:
    """Overwrite a table, schema included; ``replace=False`` only replaces the partitions present.

    A hot partition is written by several tasks, so one large zone is not one file.
    """
    by = list(by)
    mode = "static" if replace else "dynamic"
    writer = _spread_files(df, by, files).write.mode("overwrite").option("partitionOverwriteMode", mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def append_evolving(df: DataFrame, path: str, by: Iterable[str] = ()) -> None:
    """Append; new columns are allowed and read back as null in older rows."""
    by = list(by)
    writer = df.write.mode("append")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def merge_rows(target: DataFrame, source: DataFrame, keys, update: Iterable[str]) -> DataFrame:
    """Result of a keyed upsert: matched rows take ``update`` columns from the source, the rest
    of the source is inserted, everything else stays.

    The source must hold each key once.
    """
    keys, update = as_keys(keys), list(update)
    left = target.withColumn("_in_target", F.lit(True)).alias("t")
    right = source.withColumn("_in_source", F.lit(True)).alias("s")
    same = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = left.join(right, same, "full")
    matched = F.col("t._in_target") & F.col("s._in_source")
    out = []
    for c in target.columns:
        old = F.col(f"t.{c}")
        new = F.col(f"s.{c}") if c in source.columns else F.lit(None)
        if c in update:
            value = F.when(F.col("s._in_source"), new).otherwise(old)
        else:
            value = F.when(matched | F.col("s._in_source").isNull(), old).otherwise(new)
        out.append(value.alias(c))
    return joined.select(*out)


def _refuse_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """A null key matches nothing and would be inserted again by every load."""
    refused = {k: F.when(F.col(k).isNull(), F.raise_error(F.lit(f"null in the key {k}"))).otherwise(F.col(k)) for k in keys}
    return df.withColumns(refused)


def touched_files(spark: SparkSession, path: str, fresh: DataFrame, keys: list[str], pruned_by: Iterable[str] = ()) -> list[str]:
    """The files of a table that hold a key of ``fresh``, by full name.

    Only the key columns are read, and of those only row groups whose smallest and largest values, which every file
    keeps in its footer, reach into the range of the keys that come; ``pruned_by`` are directory columns that follow
    from the key, so other directories are not read at all. What reaches the driver is names of files.
    """
    pruned = list(pruned_by)
    table = spark.read.parquet(path).select(*keys, *pruned, F.col("_metadata.file_path").alias("_file"))
    # numbers, texts and days come back from the driver exactly as they were
    exact = [k for k, kind in fresh.select(*keys).dtypes if kind in ("int", "bigint", "smallint", "string", "date")]
    if exact:
        ends = fresh.agg(*[F.min(k) for k in exact], *[F.max(k) for k in exact]).first()
        for i, k in enumerate(exact):
            table = table.where(F.col(k).between(F.lit(ends[i]), F.lit(ends[i + len(exact)])))
    if pruned:
        table = table.join(fresh.select(*pruned).distinct(), pruned, "left_semi")
    held = table.join(fresh.select(*keys), keys, "left_semi")
    return sorted(r[0] for r in held.select("_file").distinct().collect())


def _remove(spark: SparkSession, files: Iterable[str]) -> None:
    for name in files:
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, False)


def upsert(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys,
    update: Iterable[str],
    partitions: dict[str, Column] | None = None,
    order: str | None = None,
    by_key: bool = False,
) -> None:
    """Upsert into a parquet table, rewriting only the files that hold a key of the source.

    ``partitions`` names directory columns and their values for a row. Where they follow from the key alone
    (``by_key``), a key never changes its directory and only directories of the source are searched. The merged rows
    are settled, then written as new files beside the others, then the files they replace are removed. A load that was
    lost between these steps leaves old and new rows of a key; loading the same source again finds both and leaves one.
    """
    keys, partitions = as_keys(keys), partitions or {}
    fresh = dedup_ordered(source, keys, [order], keep="last") if order else dedup_any(source, keys)
    fresh = _refuse_null_keys(fresh, keys).withColumns(partitions) if partitions else _refuse_null_keys(fresh, keys)
    if not _exists(spark, path):
        write_partitioned(fresh, path, partitions)
        return
    names = list(partitions)
    whole = spark.read.parquet(path)
    kinds = {f.name: f.dataType for f in whole.schema.fields}
    with settled_within(spark):
        fresh = settle(fresh.withColumns({n: F.col(n).cast(kinds[n]) for n in names if n in kinds}))
        if fresh.isEmpty():
            return
        replaced = touched_files(spark, path, fresh, keys, names if by_key else ())
        target = whole.where(F.col("_metadata.file_path").isin(replaced)) if replaced else whole.limit(0)
        merged = merge_rows(target, fresh, keys, update).withColumns(partitions)
        typed = merged.select(*[F.col(c).cast(kinds[c]).alias(c) for c in whole.columns])
        merged = settle(dedup_any(typed, keys))
        spread = _spread_files(merged, names, 4).write.mode("append")
        (spread.partitionBy(*names) if names else spread).parquet(path)
        _remove(spark, replaced)


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, by: Iterable[str] = (), comment: str | None = None
) -> None:
    """Create the database and the parquet table if they are absent."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = list(by)
    layout = f" PARTITIONED BY ({', '.join(by)})" if by else ""
    note = " COMMENT '" + comment.replace("'", "\\'") + "'" if comment else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{layout}{note}")


def register_training_view(df: DataFrame, name: str, flag: str = "is_training_row") -> None:
    df.filter(F.col(flag) == 1).createOrReplaceTempView(name)


def export_metrics(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Metric tables as CSV with a header or as JSON lines."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        raise ValueError("fmt must be csv or json")
