import pytest

LONG = "wordy " * 30_000
ODD_TEXTS = {
    0: None,
    1: "",
    2: " \t\n ",
    3: "one",
    4: "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf",
    5: "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf",
    6: "the quick  brown\tfox jumps over the lazy dog and runs away from the big bad wolf",
    7: LONG,
    8: "x" * 50_000,
    9: "naïve İstanbul 世界 🙂 ﷺ é  \u0085 tail",
    10: "<|endoftext|> stays 'll <|startoftext|>",
    11: "a\nb\na\n\nb  c   d\n \n",
}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, long and repeated texts, with columns whose names clash with results."""
    rows = [(i, t, "en", None, -1, "x", None) for i, t in ODD_TEXTS.items()]
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, kept boolean"
    return spark.createDataFrame(rows, columns)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("doc_id < 0")


@pytest.fixture(scope="session")
def small_docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="session")
def small_texts(small_docs):
    return {r["doc_id"]: r["text"] for r in small_docs.select("doc_id", "text").collect()}
