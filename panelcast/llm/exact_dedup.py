"""Exact deduplication as a stream with state on disk.

Documents stream in file by file. The state has an entry per distinct text and never expires: the SHA-256 of
the text, the smallest document id, the file and row at which that document lies, and the number of copies. It
lives in RocksDB on the executors' disks and is committed to the shared folder with every batch, so a lost
executor, or a stopped stream that starts again over the same folder, goes on where it was. Batches only report
entries that changed.

Equal digests are hits, not yet copies: the full bytes of every hit are compared with those of the document
that the entry points to. Rows that differ are grouped anew by their whole text.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import bloom
from panelcast.llm.common import scratch, text_or_empty, written

#: Share of false hits whose text is shuffled for nothing.
FALSE_HITS = 0.01
ARRIVED = "id long, file string, row long, digest string"
ENTRIES = "digest string, owner bigint, locator struct<file: string, row: bigint>, held bigint"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    # a store takes some megabytes of disk however little it holds: close each after its commit
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normal(text: Column) -> Column:
    """Each run of the six white-space characters as one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@contextmanager
def disk_state(spark: SparkSession):
    """Keep state in RocksDB while a stream starts; the session's own setting returns afterwards."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def entries(rows: DataFrame) -> DataFrame:
    """The state: per digest the owner (least id, with its locator) and the number of rows so far."""
    return rows.groupBy("digest").agg(
        F.min("id").alias("owner"),
        F.min_by(F.struct("file", "row"), "id").alias("locator"),
        F.count("*").alias("held"),
    )


def stream_entries(stream: DataFrame, state: str, out: str, available_now: bool = True):
    """Run the stream over what has arrived; changed entries of batch n go to ``out/batch=n``.

    ``stream`` has id, digest, file and row. ``state`` keeps offsets and state between runs.
    """

    def report(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    with disk_state(stream.sparkSession):
        writer = entries(stream).writeStream.outputMode("update").option("checkpointLocation", state).foreachBatch(report)
        query = (writer.trigger(availableNow=True) if available_now else writer).start()
        if available_now:
            query.awaitTermination()
    return query


def current(spark: SparkSession, out: str) -> DataFrame:
    """Entries as of the last batch: owners only fall and counts only grow."""
    try:
        changed = spark.read.schema(ENTRIES).parquet(f"{out}/batch=*")
    except AnalysisException as missing:  # no row ever arrived
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ENTRIES)
    return changed.groupBy("digest").agg(
        F.min("owner").alias("owner"), F.min_by("locator", "owner").alias("locator"), F.max("held").alias("held")
    )


class ExactDedup:
    """One run over a Parquet table or a frame; ``digest`` may be another function of the text, as in tests."""

    def __init__(self, source: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text", digest=digest):
        self.spark, self.source, self.path = source.sparkSession, source, path
        self.id_col, self.text, self.digest = id_col, text, digest

    def rows(self, source: DataFrame) -> DataFrame:
        """id, text, file, row and digest; rows without an id are left out."""
        try:
            place = source.select("_metadata.file_path", "_metadata.row_index").schema and (F.col("_metadata.file_path"), F.col("_metadata.row_index"))
        except AnalysisException:  # a frame that was not read from files
            place = (F.lit(None).cast("string"), F.lit(None).cast("long"))
        texts = source.where(F.col(self.id_col).isNotNull()).select(
            F.col(self.id_col).cast("long").alias("id"),
            normal(text_or_empty(self.text)).alias("text"),
            place[0].alias("file"),
            place[1].alias("row"),
        )
        return texts.withColumn("digest", self.digest(F.col("text")))

    def state(self) -> DataFrame:
        found = scratch(self.spark, "dedup")
        if self.path is None:
            # a frame arrives as one batch of digests
            self.rows(self.source).drop("text").write.parquet(f"{found}/arrived")
            stream = self.spark.readStream.schema(ARRIVED).parquet(f"{found}/arrived")
        else:
            place = self.path.rstrip("/")
            # as a pattern, as a table may be one file, and a stream takes only folders or patterns
            files = self.spark.readStream.schema(self.source.select(self.id_col, self.text).schema)
            stream = self.rows(files.parquet(f"{place[:-1]}[{place[-1]}]")).drop("text")
        stream_entries(stream, f"{found}/state", f"{found}/entries")
        return current(self.spark, f"{found}/entries")

    def groups(self) -> DataFrame:
        """(id, keep, digest) of every row."""
        owners = written(self.state().where("held > 1"), "owners")
        bits, hashes = bloom.shape(owners.count(), FALSE_HITS)
        words = written(bloom.build(owners, "digest", 0, bits, hashes), "filter").scalar()
        all_rows = self.rows(self.source)
        # texts travel only where the digest may be a hit; owners are picked by id before anything is computed
        rows = all_rows.select("id", "digest", F.when(bloom.holds(words, F.col("digest"), 0, bits, hashes), F.col("text")).alias("text"))
        ids = owners.select("digest", F.col("owner").alias("id"))
        located = bloom.only(all_rows.select("id", F.col("text").alias("owned")), ids, "id").join(ids, "id")
        located = located.select("digest", F.col("id").alias("owner"), "owned").dropDuplicates(["digest"])
        met = rows.join(located, "digest", "left").select(
            "id", "digest", F.coalesce("owner", "id").alias("owner"), F.when(~F.coalesce(F.col("text") == F.col("owned"), F.lit(True)), F.col("text")).alias("differs")
        )
        met = written(met, "met")
        same = met.where("differs IS NULL").select("id", F.col("owner").alias("keep"), "digest")
        other = met.where("differs IS NOT NULL")
        regrouped = other.groupBy("digest", "differs").agg(F.min("id").alias("keep"))
        return same.union(other.join(regrouped, ["digest", "differs"]).select("id", "keep", "digest"))

    def result(self) -> DataFrame:
        groups = self.groups()
        sizes = groups.groupBy("keep").agg(F.count("*").alias("size")).where("size > 1")
        return groups.join(sizes, "keep", "left").select("id", "keep", F.coalesce("size", F.lit(1).cast("long")).alias("size"), "digest")


def exact_duplicates(source: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``source``: id, keep_id, group_size, kept and text_sha256.

    ``path`` is the Parquet table that ``source`` is, if it is one: it is then streamed as it lies, else its digests
    are written first and streamed. Texts are equal when identical after each run of white space becomes one space;
    null counts as empty. The row with the smallest id of equal texts stays. ``id_col`` holds distinct whole numbers;
    rows without an id are left out. Other columns are ignored; an empty table gives an empty result.
    """
    found = ExactDedup(source, path, id_col, text).result()
    return found.select(
        F.col("id").alias(id_col),
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("id") == F.col("keep")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
