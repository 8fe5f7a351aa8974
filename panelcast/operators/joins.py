"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.timecols import add_hours
from panelcast.operators.blocks import as_keys
from panelcast.schemas import require_columns


#: A key of at least one in so many rows is spread over tasks. At most as many keys are.
HEAVY_KEYS = 256
#: Keys that the sketch of frequent keys follows at once: it is wrong by a few in ten thousand rows at most.
TRACKED = 10_000


def default_salts(df: DataFrame) -> int:
    """Tasks over which a heavy key is spread: as many as a shuffle has, two at least."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def heavy_keys(df: DataFrame, keys: list[str], most: int = HEAVY_KEYS) -> Column:
    """Hashes of the keys that hold at least one in ``most`` rows, as a scalar of at most ``most`` entries.

    They come from a mergeable sketch of frequent items. It may count a key a little too often, never too rarely,
    so none is missed; one too many costs copies of a single row.
    """
    hashed = df.select(key_hash(keys).alias("_h"))
    found = hashed.agg(F.expr(f"approx_top_k(_h, {2 * most}, {TRACKED})").alias("_top"), F.count(F.lit(1)).alias("_n"))
    often = F.filter("_top", lambda x: x["count"] * most >= F.col("_n"))
    return found.select(F.transform(often, lambda x: x["item"]).alias("_heavy")).scalar()


def attach(df: DataFrame, stats: DataFrame, key, salts: int | None = None) -> DataFrame:
    """Left join of per-key values onto many rows, in which no heavy key makes a large task.

    ``stats`` holds one row per key. Heavy keys are measured (``heavy_keys``, one more pass over ``df``), their rows
    spread over ``salts`` tasks and their one row of ``stats`` repeated for each; all other keys are joined as they are,
    without copies. The salt comes from the row and its input partition, not from a random number: equal rows of
    different tasks spread, and a retried task sends its rows to the same place.
    """
    keys, salts = as_keys(key), salts or default_salts(df)
    heavy = F.array_contains(heavy_keys(df, keys), key_hash(keys))
    spread = [c for c in df.columns if c not in keys]
    seed = F.xxhash64(*spread) if spread else F.lit(0)
    salt = F.pmod(seed + F.spark_partition_id(), F.lit(salts)).cast("int")
    left = df.withColumn("_salt", F.when(heavy, salt).otherwise(0))
    copies = F.when(heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = stats.withColumn("_salt", F.explode(copies))
    return left.join(right, [*keys, "_salt"], "left").drop("_salt")


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the columns of a global aggregate on every row as a scalar subquery, without a join."""
    packed = one_row.select(F.struct(*one_row.columns)).scalar()
    added = [F.col("_one").getField(c).alias(c) for c in one_row.columns]
    return df.withColumn("_one", packed).select(*df.columns, *added)


def lookup(df: DataFrame, dimension: DataFrame, on) -> DataFrame:
    """Left join of a dimension. Spark broadcasts it if its measured or estimated size allows that."""
    return df.join(dimension, as_keys(on), "left")


def join_panel(left: DataFrame, right: DataFrame, keys=("zone", "datetime")) -> DataFrame:
    """Left equi-join of two panels; the right keys are not repeated."""
    keys = list(keys)
    require_columns(left, keys)
    require_columns(right, keys)
    return left.join(right, keys, "left")


def unmatched_count(joined: DataFrame, column: str) -> DataFrame:
    """How many joined rows found no partner, judged by a column of the right side."""
    return joined.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(column).isNull()).alias("unmatched")
    )


def expand_horizons(
    df: DataFrame, issue: str, lo: int = 1, hi: int = 168, horizon: str = "forecast_horizon_hours"
) -> DataFrame:
    """One row per issue and horizon. A generator, so there is no join and no shuffle."""
    steps = F.explode(F.sequence(F.lit(lo), F.lit(hi)))
    expanded = df.withColumn(horizon, steps)
    return expanded.withColumn("target_datetime", add_hours(issue, horizon))


def join_target(
    expanded: DataFrame, panel: DataFrame, columns: dict[str, str], key="zone", ts: str = "datetime"
) -> DataFrame:
    """Values of the panel at the target time of each row."""
    keys = as_keys(key)
    targets = panel.select(
        *keys,
        F.col(ts).alias("target_datetime"),
        *[F.col(c).alias(name) for c, name in columns.items()],
    )
    return expanded.join(targets, [*keys, "target_datetime"], "left")


def keep_matching(df: DataFrame, keys_frame: DataFrame, on) -> DataFrame:
    """Rows whose key occurs in another frame."""
    return df.join(keys_frame.select(*as_keys(on)), as_keys(on), "left_semi")


def join_aggregates(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """Inner join of two aggregates on their shared grouping columns."""
    return a.join(b, as_keys(on), "inner")


def forecast_with_contributions(
    forecast: DataFrame, contributions: DataFrame, on=("zone", "target_datetime")
) -> DataFrame:
    """Each prediction with its feature contributions, one row per contribution."""
    extra = [c for c in contributions.columns if c in on or c not in forecast.columns]
    return forecast.join(contributions.select(*extra), list(on), "left")


def union_padded(a: DataFrame, b: DataFrame) -> DataFrame:
    """UNION ALL by name; a column one side lacks becomes a typed null."""
    return a.unionByName(b, allowMissingColumns=True)


def shared_keys(a: DataFrame, b: DataFrame, key) -> DataFrame:
    keys = as_keys(key)
    # distinct first: a hot key then reaches the comparison once per task, not once per row
    return a.select(*keys).distinct().intersect(b.select(*keys).distinct())


def missing_keys(a: DataFrame, b: DataFrame, key) -> DataFrame:
    """Distinct keys of ``a`` that ``b`` lacks."""
    keys = as_keys(key)
    return a.select(*keys).distinct().subtract(b.select(*keys).distinct())
