"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import alignment, binary_output, bpe, cost_packing, exact_dedup, html_text, hyperminhash, license_scan, mixing, periodic_runs, quality_model, secrets, url_filter
from panelcast.llm.common import scratch, table

BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), BYTE_TOKENIZER)
    return bpe.decode(coded, BYTE_TOKENIZER).select(
        "doc_id",
        bpe.token_count().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("secret_spans")

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        *[count(k) for k in secrets.KINDS],
        F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(spans).alias("spans"),
    )


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, folder, "documents"), hyperminhash.Rule(width=4, least=80, of=100))


def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = html_text.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge(table(spark, folder, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"), f"{folder}/documents.parquet")


def op7_packed_matrices(spark: SparkSession, folder: str) -> DataFrame:
    packed = binary_output.matrices(table(spark, folder, "documents"), WORD_TOKENIZER, end_id=2)
    rows = binary_output.write_matrices(packed, scratch(spark, "matrices"))
    return rows.select(
        "sequence_id",
        "tokens",
        "doc_ids",
        "starts",
        "cu_seqlens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("positions", 256).alias("positions_sha256"),
    )


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality_model.train(docs, table(spark, folder, "labels"))
    return quality_model.judge(docs, model).select("doc_id", *[n for n, _ in quality_model.FIELDS])


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = license_scan.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op10_cost_packing(spark: SparkSession, folder: str) -> DataFrame:
    return cost_packing.pack(table(spark, folder, "documents"), WORD_TOKENIZER, end_id=2).drop("ids")


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    coded = alignment.align(table(spark, folder, "documents").select("doc_id", "text"), BYTE_TOKENIZER, PIECE_TOKENIZER)
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    rows = coded.select("doc_id", "n_a", "n_b", "n_groups", F.size("links").cast("long").alias("n_links"), digest.alias("groups_sha256"), "links")
    return alignment.with_link_counts(rows)


def op12_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_documents(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(table(spark, folder, "documents").select("doc_id", "text"))
    found = periodic_runs.find_runs(docs).withColumn("longest", periodic_runs.longest())
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(periodic_runs.listed().cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


OP6_SQL = r"""
    WITH rows AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM rows WINDOW w AS (PARTITION BY t)"""

#: Grams of five words find every run: the shortest overlap is that of period one, five of six words.
OP13_SQL = r"""
    WITH ids AS (
        SELECT doc_id, coalesce(text, '') AS text,
               xor(list_reduce(
                   [4294967295] || list_transform(range(length(doc_id::VARCHAR)), lambda k: ascii(substr(doc_id::VARCHAR, k + 1, 1))::BIGINT),
                   lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) AS h
        FROM documents),
    split AS (SELECT doc_id, h, h // 10 AS g, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM ids),
    places AS (SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN g % len(w) END AS a FROM split),
    texts AS (
        SELECT doc_id, n,
               CASE WHEN h % 10 = 0 AND n > 0
                    THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END)
                    ELSE w END AS w
        FROM places),
    grams AS (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + 5], ' ') AS gram FROM (SELECT doc_id, n, w, unnest(range(n - 4)) AS i FROM texts WHERE n >= 6)),
    again AS (SELECT doc_id, n, list(i) AS spots FROM grams GROUP BY doc_id, n, gram HAVING count(*) > 1),
    equal AS (
        SELECT doc_id, i, unnest(list_filter(spots, lambda j: j > i AND 4 * (j - i) <= n)) - i AS q
        FROM (SELECT doc_id, n, spots, unnest(spots) AS i FROM again)),
    rows AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal),
    stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length FROM rows GROUP BY doc_id, q, island),
    runs AS (
        SELECT * FROM stretches s
        WHERE length >= greatest(6, 4 * q) AND NOT EXISTS (
            SELECT 1 FROM stretches t
            WHERE t.doc_id = s.doc_id AND t.q < s.q AND t.start <= s.start AND t.start + t.length >= s.start + s.length)),
    found AS (
        SELECT doc_id, count(*) AS n_runs,
               list({'start': start, 'length': length, 'period': q} ORDER BY start, q) AS runs,
               list({'start': start, 'length': length, 'period': q} ORDER BY length DESC, start, q)[1] AS longest
        FROM runs GROUP BY doc_id),
    kept AS (
        SELECT t.doc_id, f.n_runs, f.runs, f.longest,
               CASE WHEN f.runs IS NULL THEN w
                    ELSE list_transform(list_filter(range(n), lambda i: NOT list_bool_or(list_transform(f.runs, lambda r: i >= r.start + r.period AND i < r.start + r.length))), lambda i: w[i + 1])
               END AS w
        FROM texts t LEFT JOIN found f USING (doc_id))
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, longest.start AS start, longest.length AS length, longest.period AS period,
           1000 * longest.length // longest.period AS exponent_milli,
           sha256(coalesce(array_to_string(list_transform(runs, lambda r: r.start || ',' || r.length || ',' || r.period || chr(10)), ''), '')) AS runs_sha256,
           sha256(array_to_string(w, ' ')) AS collapsed_sha256
    FROM kept"""

QUERIES = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op2_secret_scan": op2_secret_scan,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_html_text": op4_html_text,
    "op5_url_filter": op5_url_filter,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_packed_matrices": op7_packed_matrices,
    "op8_quality_rules": op8_quality_rules,
    "op9_license_scan": op9_license_scan,
    "op10_cost_packing": op10_cost_packing,
    "op11_token_alignment": op11_token_alignment,
    "op12_source_mix": op12_source_mix,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES: dict[str, str] = {
    "op5_url_filter": url_filter.judge_sql(),
    "op6_exact_dedup": OP6_SQL,
    "op13_periodic_runs": OP13_SQL,
}
