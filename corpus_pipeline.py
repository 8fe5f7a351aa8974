"""Documents to packed training sequences.

Each stage takes all that the one before kept. Stages one to four return the columns of documents: the first three
drop rows, the fourth masks secrets in the texts and keeps every row. The last returns the pieces of sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import bloom, cost_packing, exact_dedup, hyperminhash, quality_model, secrets
from panelcast.llm.common import BATCH_SETTING, table, written
from panelcast.llm.queries import WORD_TOKENIZER

#: Id that ends a document.
END_ID = 2
#: Runs of five words; four fifths of them in common make two documents near copies.
NEAR = hyperminhash.Rule(width=5, least=80, of=100)
#: Bytes of a batch: executors keep what the stages before them have touched, so each stage takes little.
BATCH_BYTES = "1m"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and that the classifier finds likely to be of quality."""
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return quality_model.keep_good(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents of equal text, the one with the smallest id."""
    found = exact_dedup.exact_duplicates(docs)
    return bloom.without(docs, found.where("NOT kept").select("doc_id"), "doc_id")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near copies, the one with the smallest id."""
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    found = hyperminhash.near_duplicates(docs, NEAR)
    return bloom.without(docs, found.where("NOT kept").select("doc_id"), "doc_id")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with a mark in place of each secret, and the length that it then has."""
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    clean = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens, with their ids."""
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    return cost_packing.pack(docs, WORD_TOKENIZER, END_ID)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("secret scans", mask_secrets),
    ("packing", pack_sequences),
]
#: SQL can express neither the classifier nor the tokenizer; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return docs
