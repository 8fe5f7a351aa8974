"""Near and exact duplicates, components, URL rules and the pipeline, against all-pairs versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelcast.llm import bloom, components, exact_dedup, hyperminhash, quality_model, secrets, url_filter
from panelcast.llm.queries import ORACLES, QUERIES, WORD_TOKENIZER
from tests.llm import plain
from tests.llm.conftest import ODD_TEXTS


def as_dict(rows):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


def test_near_query(spark, small, small_texts):
    rows = QUERIES["op3_near_duplicates"](spark, small).collect()
    assert len(rows) == len(small_texts)
    assert as_dict(rows) == plain.near(small_texts, 4)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def chain_texts():
    """Copies with more and more changes: neighbours are near, ends are not; and a large group of equal texts."""
    draw = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    texts, now = {}, words[:]
    order = list(range(60))
    draw.shuffle(order)
    for i in order:
        now = now[:]
        now[3 * i] = f"c{i}"
        texts[i] = " ".join(now)
    for i in range(60, 140):
        texts[i] = "same words in every one of these rows of text"
    # each differs from the common one in its own place
    for i in range(140, 200):
        own = [f"h{k}" for k in range(150)]
        own[2 * (i - 140)] = f"x{i}"
        texts[i] = " ".join(own)
    for i in range(200, 230):
        texts[i] = " ".join(draw.choices(["a", "b", "c"], k=draw.randint(0, 9)))
    return texts


@pytest.mark.parametrize("width", [4, 5])
def test_chains_stars_and_short_texts(spark, width):
    texts = chain_texts()
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    found = hyperminhash.near_duplicates(docs, hyperminhash.Rule(width))
    assert as_dict(found.collect()) == plain.near(texts, width)


def test_near_of_odd_texts(odd, nothing):
    assert as_dict(hyperminhash.near_duplicates(odd, hyperminhash.Rule(4)).collect()) == plain.near(ODD_TEXTS, 4)
    assert hyperminhash.near_duplicates(nothing).count() == 0


def test_short_texts_whose_registers_differ_by_bad_luck(spark):
    """Four of five shingles in common, but registers that agree in half of the buckets only."""
    words = {i: [f"word{i}{c}" for c in "abcdefgh"] for i in (3141, 4406, 9686, 11461)}
    texts = {2 * i + k: " ".join(w[: 7 + k]) for i, w in words.items() for k in (0, 1)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = as_dict(hyperminhash.near_duplicates(docs, hyperminhash.Rule(4)).collect())
    assert found == plain.near(texts, 4)
    assert all(found[2 * i + 1][1] == 2 * i for i in words)


def test_registers_estimate_similarity():
    draw = np.random.default_rng(5)
    for size in (6, 40, 400, 20_000):
        for share in (0.3, 0.8, 0.95):
            guesses = []
            for _ in range(12):
                pool = np.unique(draw.integers(0, 2**64, 2 * size, dtype=np.uint64))
                common = round(2 * size * share / (1 + share) / 2 * 1.0) or 1
                own = size - common
                a = np.sort(pool[draw.permutation(len(pool))])
                mixed = draw.permutation(a)
                x, y = mixed[: common + own // 2], np.concatenate([mixed[:common], mixed[common + own // 2 : common + 2 * (own // 2)]])
                x, y = np.unique(x), np.unique(y)
                real = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
                rx, ry = hyperminhash.registers(x), hyperminhash.registers(y)
                assert (rx > 0).all() and (ry > 0).all()
                guesses.append(hyperminhash.estimated(rx[None], ry[None], np.array([len(x)]), np.array([len(y)]))[0] - real)
            assert abs(np.mean(guesses)) < 0.08


def test_components_of_chains_and_stars(spark):
    draw = random.Random(8)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(7, 7), (3, 9), (9, 3), (9, 12)]
    draw.shuffle(links)
    union = plain.Union({n for link in links for n in link})
    for a, b in links:
        union.join(a, b)
    frame = spark.createDataFrame(links, "u bigint, v bigint").repartition(4)
    got = {r["node"]: r["component"] for r in components.components(frame).collect()}
    assert got == {n: union.root(n) for n in union.up if n != 7}
    assert components.components(frame.where("u < 0")).count() == 0


def test_exact_query(spark, small, small_texts):
    rows = QUERIES["op6_exact_dedup"](spark, small).collect()
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows} == plain.exact(small_texts)


def test_exact_of_odd_texts(odd, nothing):
    rows = exact_dedup.exact_duplicates(odd).collect()
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows} == plain.exact(ODD_TEXTS)
    assert exact_dedup.exact_duplicates(nothing).count() == 0


def test_equal_digests_of_different_texts(spark):
    texts = {i: f"text {i % 7}" for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    weak = exact_dedup.ExactDedup(docs, digest=lambda t: F.length(t).cast("string"))
    got = {r["id"]: (r["keep"], r["size"]) for r in weak.result().collect()}
    assert got == {i: v[:2] for i, v in plain.exact(texts).items()}


def test_stream_goes_on_over_its_state(spark, tmp_path):
    place = str(tmp_path / "arrived")

    def arrive(rows, mode="append"):
        spark.createDataFrame(rows, "id long, file string, row long, digest string").coalesce(1).write.mode(mode).parquet(place)

    def run():
        stream = spark.readStream.schema("id long, file string, row long, digest string").parquet(place)
        exact_dedup.stream_entries(stream, str(tmp_path / "state"), str(tmp_path / "out"))
        return {r["digest"]: (r["owner"], r["held"], r["locator"]["file"]) for r in exact_dedup.current(spark, str(tmp_path / "out")).collect()}

    arrive([(5, "f1", 0, "a"), (6, "f1", 1, "b"), (7, "f1", 2, "a")])
    assert run() == {"a": (5, 2, "f1"), "b": (6, 1, "f1")}
    arrive([(2, "f2", 0, "a"), (9, "f2", 1, "c")])
    assert run() == {"a": (2, 3, "f2"), "b": (6, 1, "f1"), "c": (9, 1, "f2")}
    assert run() == {"a": (2, 3, "f2"), "b": (6, 1, "f1"), "c": (9, 1, "f2")}


def test_cascade_is_exact(spark):
    listed = [f"key{i}" for i in range(0, 3000, 50)]
    universe = [f"key{i}" for i in range(3000)] + ["key1", None]
    frame = spark.createDataFrame([(k,) for k in universe], "key string")
    cascade = url_filter.Cascade.build(url_filter.key_table(spark, [*listed, "absent"]), frame)
    assert len(cascade.levels) > 1
    got = {r["key"] for r in frame.where("key IS NOT NULL").where(cascade.member(F.col("key"))).collect()}
    assert got == set(listed)
    none = url_filter.Cascade.build(url_filter.key_table(spark, []), frame)
    assert not none.levels


def test_filter_drops_exactly_the_keys(spark):
    rows = spark.range(1000).select(F.col("id"), F.lit("x").alias("v")).union(spark.createDataFrame([(None, "n")], "id bigint, v string"))
    left = bloom.without(rows, spark.range(0, 1000, 3), "id")
    assert sorted(r["id"] for r in left.where("id IS NOT NULL").collect()) == [i for i in range(1000) if i % 3]
    assert left.where("id IS NULL").count() == 1
    assert bloom.without(rows, spark.range(0), "id").count() == 1001


URLS = {
    "http://Example.ORG/en/1?x": ("example.org", "/en/1", "example.org/en/1", "block"),
    "http://a.example.org/en/2": ("a.example.org", "/en/2", "org/", "allow"),
    "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
    "https://example.org": ("example.org", "", None, "allow"),
    "https://x.com/fr/1#y": ("x.com", "/fr/1", "com/fr/", "allow"),
    "https://x.com/de/": ("x.com", "/de/", "com/de/", "block"),
    "https://www.spam-farm.example.net/a": ("www.spam-farm.example.net", "/a", None, "block"),
    "https://nospam-farm.example.net/a": ("nospam-farm.example.net", "/a", None, "allow"),
    "https://spam-farm.example.org/a": ("spam-farm.example.org", "/a", "org/", "allow"),
    "no scheme": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    "x://y://z/É": ("y:", "//z/É", None, "allow"),
    "http://İX.net\n/p": ("İx.net\n", "/p", None, "allow"),
    None: ("", "", None, "allow"),
}


def test_urls(spark):
    rows = list(enumerate(URLS))
    frame = spark.createDataFrame([(i, u, "r") for i, u in [*rows, *rows]], "page_id int, url string, rule string")
    found = url_filter.judge(frame).collect()
    assert len(found) == 2 * len(URLS)
    for r in found:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == URLS[r["url"]]
    assert url_filter.judge(frame.where("page_id < 0")).count() == 0


def test_sql_belongs_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def plain_pipeline(spark, folder):
    """Documents that are left, with their texts, by plain means; the classifier's verdict is taken as given."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality_model.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        fields = quality_model.measured((r["text"] or "").encode(), model)
        if not plain.quality_counts(r["text"] or "")[5] and fields[-1]:
            texts[r["doc_id"]] = r["text"]
    texts = {i: t for i, t in texts.items() if plain.exact(texts)[i][0] == i}
    groups = plain.near(texts, 5)
    return {i: secrets.masked(t, "[SECRET]") for i, t in texts.items() if groups[i][1] == i}


def test_pipeline(spark, small):
    from tokenizers import Tokenizer

    from tests.llm.test_bpe_and_packing import check_pieces

    wanted = plain_pipeline(spark, small)
    library = Tokenizer.from_file(WORD_TOKENIZER)
    check_pieces(corpus_pipeline.run(spark, small).collect(), {i: [*library.encode(t, add_special_tokens=False).ids, 2] for i, t in wanted.items()})
    assert not any(plain.base_secrets(t) for t in wanted.values())


def test_stages_keep_columns_and_take_odd_rows(spark, small, odd, nothing):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, small).columns == odd.columns, name
        assert stage(spark, nothing, small).count() == 0, name
    docs = corpus_pipeline.exact_copies(spark, odd, small)
    assert docs.count() == len({v[0] for v in plain.exact(ODD_TEXTS).values()})
    # white space counts for exact copies, case does not for near ones
    assert {r["doc_id"] for r in corpus_pipeline.near_copies(spark, odd, small).collect()} == {i for i, v in plain.near(ODD_TEXTS, 5).items() if v[1] == i}
    masked = corpus_pipeline.mask_secrets(spark, odd, small)
    assert {r["doc_id"]: r["n_chars"] for r in masked.collect()} == {i: None if t is None else len(t) for i, t in ODD_TEXTS.items()}
