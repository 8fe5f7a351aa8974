"""Landed files to DataFrames: report CSVs, interval feeds, GeoJSON pages, parallel-array JSON."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.schemas import MissingColumns


#: Files of up to so many bytes are read as one row each, so that a line meets its header without a join.
WHOLE_FILE = 16 << 20


def _fields(line: str = "value") -> Column:
    return F.transform(F.split(line, ","), lambda f: F.trim(f))


def _named(line: Column, required: list[str]) -> Column:
    """Whether a line holds every required name: a header."""
    fields = F.transform(F.split(line, ","), lambda f: F.trim(f))
    return F.forall(F.array(*[F.lit(c) for c in required]), lambda c: F.array_contains(fields, c))


def _files(spark: SparkSession, paths: str | list[str], whole: int) -> tuple[DataFrame, DataFrame]:
    """Files of up to ``whole`` bytes as (lines, file), larger ones as (value, file). Spark lists each file once."""
    size, file = F.col("_metadata.file_size"), F.col("_metadata.file_path").alias("file")
    small = spark.read.text(paths, wholetext=True).where(size <= whole)
    large = spark.read.text(paths).where(size > whole)
    return small.select(F.split("value", "\r\n|\n|\r").alias("lines"), file), large.select("value", file)


def _with_header(
    spark: SparkSession, paths: str | list[str], required: list[str], columns: list[str] | None, whole: int = WHOLE_FILE
) -> tuple[DataFrame, list[str], int]:
    """Lines with the ``header`` of their own file, the names of all files in order of appearance, and the most fields.

    A header is the line that holds every required name. A file without one has the layout ``columns``, or is refused
    when that is not given. A file of ordinary size is one row until its header is known, so its lines are neither
    shuffled nor read again; only files of more than ``whole`` bytes are joined with their headers, which are one row a
    file. Only distinct layouts reach the driver.
    """
    small, large = _files(spark, paths, whole)
    own = small.select("file", "lines", F.array_min(F.filter("lines", lambda x: _named(x, required))).alias("header"))
    heads = large.where(_named(F.col("value"), required)).groupBy("file").agg(F.min("value").alias("header"))
    known = own.select("header", "file").where("header IS NOT NULL").union(heads.select("header", "file"))
    layouts = known.groupBy("header").agg(F.min("file").alias("file")).orderBy("file").collect()
    found = [name.strip() for row in layouts for name in row.header.split(",")]
    if columns is None and not layouts:
        raise MissingColumns("no header line holds " + ", ".join(required))
    names = columns or list(dict.fromkeys(found))
    if columns is None:
        refused = F.raise_error(F.concat(F.lit("no header line in "), F.col("file"))).cast("array<string>")
    else:
        refused = F.array(*[F.lit(c) for c in columns])
    lines = own.select(F.explode("lines").alias("value"), "file", "header").unionByName(large.join(heads, "file", "left"))
    placed = lines.withColumn("header", F.when(F.col("header").isNotNull(), _fields("header")).otherwise(refused))
    return placed, names, max(len(columns or []), *[row.header.count(",") + 1 for row in layouts], 1)


def _parse(spark: SparkSession, paths: str | list[str], required: list[str], columns: list[str] | None, date_col: str) -> DataFrame:
    """Lines whose date field holds a date, as columns by the header of their file; other lines fall away.

    A column that a file lacks is null in its rows. Every field is read as text first, as one malformed number must
    not cost the row.
    """
    placed, names, width = _with_header(spark, paths, required, columns)
    ddl = ", ".join(f"_{i} STRING" for i in range(width))
    trimmed = {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    split = F.from_csv("value", ddl, trimmed)
    rows = placed.withColumn("_r", split).withColumn("_f", F.array(*[F.col(f"_r._{i}") for i in range(width)]))

    def field(name: str) -> Column:
        place = F.array_position("header", F.lit(name))
        return F.when(place > 0, F.get("_f", place.cast("int") - 1))

    dated = rows.withColumn("_date", field(date_col).try_cast("date")).where("_date IS NOT NULL")
    return dated.select(*[F.col("_date").alias(c) if c == date_col else field(c).try_cast("double").alias(c) for c in names])


def read_report_csv(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str] | None = None,
    start: date | None = None,
    end: date | None = None,
    date_col: str = "Date",
    hour_col: str = "Hour",
) -> DataFrame:
    """Yearly report files: metadata lines before the header, then one row per date and hour.

    Each file is read by its own header, so columns may stand in any order or be missing in some files; ``columns``
    picks some, and is the layout of files without a header. Lines are told apart by their fields, not by position,
    so files may be split anywhere. Rows with a bad date or hour are dropped; every other column becomes a number or
    null.
    """
    rows = _parse(spark, paths, [date_col, hour_col], columns, date_col)
    rows = rows.dropna(subset=[date_col, hour_col]).withColumn(hour_col, F.col(hour_col).cast("int"))
    if start is not None:
        rows = rows.filter(F.col(date_col) >= F.lit(start))
    if end is not None:
        rows = rows.filter(F.col(date_col) <= F.lit(end))
    return rows


def read_interval_feed(
    spark: SparkSession,
    paths: str | list[str],
    required: Iterable[str] = ("Date", "Hour", "Interval"),
    columns: list[str] | None = None,
) -> DataFrame:
    """Five-minute feed: trimmed column names, required columns checked in every file, all measures numeric."""
    required = list(required)
    if columns is not None and (missing := [c for c in required if c not in columns]):
        raise MissingColumns("missing feed columns: " + ", ".join(missing))
    rows = _parse(spark, paths, required, columns, "Date")
    whole = {c: F.col(c).cast("int") for c in ("Hour", "Interval")}
    return rows.dropna(subset=["Date", "Hour", "Interval"]).withColumns(whole)


def feed_metadata(spark: SparkSession, paths: str | list[str], first: str = "Date") -> DataFrame:
    """The lines of each file that are neither data nor header."""
    lines = spark.read.text(paths).withColumn("file", F.input_file_name())
    head = F.trim(F.split("value", ",")[0])
    other = head.try_cast("date").isNull() & (F.lower(head) != first.lower())
    return lines.filter(other & (F.trim("value") != "")).select("file", F.trim("value").alias("line"))


CLIMATE_FIELDS = ["UTC_DATE", "TEMP", "DEW_POINT_TEMP", "RELATIVE_HUMIDITY", "WIND_SPEED", "PRECIP_AMOUNT"]


def read_geojson_features(
    spark: SparkSession, paths: str | list[str], fields: Iterable[str] = CLIMATE_FIELDS, zone: str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Rows of ``features[].properties`` of all pages, numbers coerced, zone added when given.

    ``multiline=False`` reads one page per line, so large files are split between tasks.
    """
    fields = list(fields)
    properties = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    feature = T.StructType([T.StructField("properties", properties)])
    schema = T.StructType([T.StructField("features", T.ArrayType(feature))])
    pages = spark.read.schema(schema).json(paths, multiLine=multiline)
    rows = pages.select(F.explode("features").alias("f")).select("f.properties.*")
    typed = {f: F.col(f).try_cast("double") for f in fields if not f.endswith("DATE")}
    typed |= {f: F.col(f).try_cast("timestamp") for f in fields if f.endswith("DATE")}
    rows = rows.withColumns(typed)
    return rows.withColumn("ZONE", F.lit(zone)) if zone else rows


HOURLY_VARIABLES = [
    "temperature_2m", "relative_humidity_2m", "dew_point_2m", "precipitation",
    "wind_speed_10m", "wind_gusts_10m", "cloud_cover", "surface_pressure",
]


def read_columnar_json(
    spark: SparkSession,
    paths: str | list[str],
    variables: Iterable[str] = HOURLY_VARIABLES,
    parent: str = "hourly",
    time: str = "time",
    extra: str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Parallel arrays to rows; a variable the payload lacks is null in every row.

    ``extra`` is DDL of scalar fields beside the arrays to carry along, for example ``zone string``.
    """
    variables = list(variables)
    arrays = ", ".join(f"`{v}`: array<string>" for v in [time, *variables])
    ddl = f"`{parent}` struct<{arrays}>" + (f", {extra}" if extra else "")
    pages = spark.read.schema(ddl).json(paths, multiLine=multiline)
    carried = [c for c in pages.columns if c != parent]
    present = F.transform(
        F.sequence(F.lit(0), F.size(F.col(f"{parent}.{time}")) - 1),
        lambda i: F.struct(
            *[F.get(F.col(f"{parent}.{v}"), i).alias(v) for v in [time, *variables]]
        ),
    )
    some = pages.filter(F.size(F.col(f"{parent}.{time}")) > 0)
    rows = some.select(*carried, F.inline(present))
    typed = {v: F.col(v).try_cast("double") for v in variables}
    return rows.withColumns({time: F.col(time).try_cast("timestamp"), **typed}).dropna(subset=[time])


def _exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def read_first_available(
    spark: SparkSession, candidates: Iterable[str], ts: str | None = None, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """The first archive that exists, parquet or CSV by its suffix, clipped to a period."""
    for path in candidates:
        if not _exists(spark, path):
            continue
        if path.rstrip("/").endswith(".csv"):
            found = spark.read.csv(path, header=True)
        else:
            found = spark.read.parquet(path)
        if ts:
            found = found.withColumn(ts, F.col(ts).try_cast("timestamp")).dropna(subset=[ts])
            if start is not None:
                found = found.filter(F.col(ts) >= F.lit(start))
            if end is not None:
                found = found.filter(F.col(ts) <= F.lit(end))
        return found
    raise FileNotFoundError("none of the archives exists")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a parquet path when the name holds a slash."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)
