"""Token alignment, mixes of sources and periodic runs against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelcast.llm import alignment, mixing, periodic_runs, queries
from panelcast.llm.bpe import byte_alphabet
from panelcast.llm.common import with_facts
from tests.llm.conftest import ODD_TEXTS
from tests.llm.plain import WORD

# --- alignment -------------------------------------------------------------------------------


def plain_tokens(texts: dict) -> dict:
    """id -> (A ids, A bytes, B ids, B bytes), by the libraries themselves."""
    left = Tokenizer.from_file(queries.BYTE_TOKENIZER)
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_TOKENIZER)
    letters = byte_alphabet()
    out = {}
    for i, t in texts.items():
        if not t:
            out[i] = ([], [], [], [])
            continue
        a, b = left.encode(" " + t, add_special_tokens=False).ids, right.encode(t)
        raw_a = [bytes(letters[c] for c in left.id_to_token(k)) for k in a]
        raw_b = [
            bytes([int(p[3:-1], 16)]) if right.is_byte(k) else p.replace("▁", " ").encode()
            for k, p in ((k, right.id_to_piece(k)) for k in b)
        ]
        same = b"".join(raw_a) == b"".join(raw_b) == (" " + t).encode()
        out[i] = (a, raw_a, b, raw_b) if same else ([], [], [], [])
    return out


def plain_alignment(texts: dict) -> dict:
    """id -> the columns of the query, group by group."""
    made, links = {}, {}
    for i, (a, raw_a, b, raw_b) in plain_tokens(texts).items():
        groups, x, y, at_a, at_b = [], [], [], 0, 0
        rest = list(zip(b, raw_b))
        for k, r in zip(a, raw_a):
            x.append(k)
            at_a += len(r)
            while rest and at_b + len(rest[0][1]) <= at_a:
                y.append(rest[0][0])
                at_b += len(rest.pop(0)[1])
            if at_b == at_a:
                groups.append((x, y))
                x, y = [], []
        links[i] = [(x[-1], y[-1]) for x, y in groups]
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        made[i] = (len(a), len(b), len(groups), len(groups), hashlib.sha256(shown.encode()).hexdigest() if groups else "")
    counts = Counter(p for ps in links.values() for p in ps)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return {i: (*made[i], sum(counts[p] == best[p[1]] for p in links[i]), sum(counts[p] for p in links[i])) for i in made}


ALIGNED = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")


def test_alignment_matches_plain(spark, small, small_texts):
    found = {r["doc_id"]: tuple(r[c] for c in ALIGNED) for r in queries.op11_token_alignment(spark, small).collect()}
    assert found == plain_alignment(small_texts)


def aligned_rows(df, heavy=alignment.HEAVY):
    coded = alignment.align(df, queries.BYTE_TOKENIZER, queries.PIECE_TOKENIZER)
    rows = coded.withColumns(
        {"n_links": F.size("links").cast("long"), "groups_sha256": F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")}
    )
    return alignment.with_link_counts(rows, heavy)


def test_alignment_of_odd_texts(spark, odd):
    texts = {**ODD_TEXTS, 20: "▁ is a piece's space", 21: "<unk> <s> </s> <0x41>", 22: "a\x00b\x01", 23: " lead", 24: "͸ unassigned \U0001fae8"}
    more = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id bigint, text string")
    found = {r["doc_id"]: tuple(r[c] for c in ALIGNED) for r in aligned_rows(more).collect()}
    want = plain_alignment(texts)
    assert found == want
    assert want[20][0] == 0 and want[21][0] > 0
    # clashing columns stay or are replaced; the answer is the same
    assert {r["doc_id"]: r["count_sum"] for r in alignment.with_link_counts(
        alignment.align(odd.withColumn("row", F.lit(1)).withColumn("aligned", F.lit(2)).withColumn("n_a", F.lit(-1)), queries.BYTE_TOKENIZER, queries.PIECE_TOKENIZER)
    ).collect()} == {i: x[-1] for i, x in plain_alignment(ODD_TEXTS).items()}


def test_alignment_counts_hot_and_rare_pairs_alike(spark):
    texts = {i: "the same words again and again" for i in range(40)} | {100 + i: f"rare {i} words zq{i}x" for i in range(30)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    want = plain_alignment(texts)
    for heavy in (1, 10, 1 << 16):
        assert {r["doc_id"]: tuple(r[c] for c in ALIGNED) for r in aligned_rows(df, heavy).collect()} == want


def test_alignment_of_nothing_and_repeats(spark, nothing):
    assert aligned_rows(nothing).count() == 0
    rows = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "one two"), (2, None)], "doc_id bigint, text string")
    out = aligned_rows(rows).collect()
    assert sorted(r["count_sum"] for r in out) == [0, 6, 6, 6]


def test_pointer_jumping_labels_components():
    random.seed(3)
    for _ in range(200):
        n = random.randint(1, 60)
        a, b = (np.array(sorted({*random.sample(range(1, n + 1), random.randint(1, n)), n})) for _ in range(2))
        last = alignment.last_tokens(a, b)
        shared = sorted(set(a.tolist()) & set(b.tolist()))
        ends = [next(s for s in shared if s >= e) for e in [*a.tolist(), *b.tolist()]]
        assert [int(b[x - len(a)]) for x in last] == ends


def test_alignment_is_linear_in_one_text():
    both = alignment.sides(queries.BYTE_TOKENIZER, queries.PIECE_TOKENIZER)
    start = time.perf_counter()
    alignment.aligned_rows(both, ["x" * 200_000 + " " * 100_000 + "word " * 50_000])
    assert time.perf_counter() - start < 10


# --- mixing ----------------------------------------------------------------------------------


def plain_mix(docs: list, weights=(5, 2, 1), cap=3) -> dict:
    """source -> (size, target), by sharing out again and again."""
    sizes = defaultdict(int)
    for _, source, text in docs:
        sizes[source] += len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, full = {}, set()
    while True:
        rest = sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        free = sum(weight[s] for s in sizes if s not in full)
        target = {s: cap * sizes[s] if s in full else rest * weight[s] / free for s in sizes}
        above = {s for s in sizes if target[s] > cap * sizes[s]}
        if not above:
            return {s: (sizes[s], target[s]) for s in sizes}
        full |= above


def check_mix(docs: list, rows: list, near: float):
    want = plain_mix(docs)
    by_source, source_of = defaultdict(float), {i: s for i, s, _ in docs}
    assert len(rows) == len(docs)
    for r in rows:
        source = source_of[r["doc_id"]]
        size, target = want[source]
        assert r["source_size"] == size and math.isclose(r["target"], target, rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        by_source[source] += r["taken"]
    for s, (_, target) in want.items():
        assert abs(by_source[s] - target) <= near * target + 1e-9, (s, by_source[s], target)
    assert math.isclose(sum(t for _, t in want.values()), sum(n for n, _ in want.values()))


def test_mix_meets_targets(spark):
    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "text").collect()]
    rows = queries.op12_source_mix(spark, folder).collect()
    check_mix(docs, rows, 0.005)
    again = queries.op12_source_mix(spark, folder).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_shares_out_what_lies_above_the_cap(spark):
    docs = [(i, "hot", "w " * (1 + i % 50)) for i in range(900)] + [(1000 + i, f"s{i % 7}", "w " * (3 + i)) for i in range(70)]
    docs += [(2000, None, "w w"), (2001, None, None), (2002, "", " "), (2003, "Z", "w"), (2004, "é", "w " * 9)]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, text string").repartition(7)
    rows = mixing.mix_documents(df).collect()
    check_mix(docs, rows, 0.05)
    rates = {r["doc_id"]: r["rate"] for r in rows}
    # the tilt is exponential in the size: one number per source explains every rate below the cap
    tilts = {round(math.log(rates[i]) / len(WORD.findall(t)), 9) for i, s, t in docs if s == "hot"}
    assert len(tilts) == 1
    # small blocks settle on their own; the sum of a source stays near its target
    check_mix(docs, mixing.mix_documents(df, block=64).collect(), 0.05)


def test_mix_of_odd_tables(spark, odd, nothing):
    assert mixing.mix_documents(nothing).count() == 0
    out = {r["doc_id"]: r for r in mixing.mix_documents(odd).collect()}
    assert set(out) == set(ODD_TEXTS) and out[0]["taken"] == 0 and out[7]["size"] == 30_000
    assert all(r["target"] == out[7]["source_size"] == r["source_size"] for r in out.values())
    twice = mixing.mix_documents(odd.union(odd)).collect()
    assert len(twice) == 2 * len(ODD_TEXTS)
    empty = odd.where("doc_id < 3")
    assert [r["taken"] for r in mixing.mix_documents(empty).collect()] == [0, 0, 0]


def test_mix_gives_documents_as_often_as_taken(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2], "w " * (i + 1)) for i in range(60)], "doc_id bigint, source string, text string")
    mixed = mixing.mix_documents(docs)
    taken = {r["doc_id"]: r["copies"] for r in mixed.collect() if r["copies"]}
    out = mixing.copied(docs.withColumn("copies", F.lit("x")), mixed)
    assert out.columns == ["doc_id", "source", "text", "copies"]
    assert Counter(r["doc_id"] for r in out.collect()) == taken


def test_rows_repeat_in_steps(spark):
    rows = spark.createDataFrame([(1, 10_000), (2, 0), (3, 4096), (4, 1)], "a int, times long")
    assert {r["a"]: r["count"] for r in mixing.repeated(rows, "times").groupBy("a").count().collect()} == {1: 10_000, 3: 4096, 4: 1}


def test_facts_meet_frequent_rare_and_null_keys(spark):
    rows = spark.createDataFrame([("a",)] * 50 + [(None,)] * 20 + [(f"k{i}",) for i in range(30)], "k string")
    facts = rows.groupBy("k").count().withColumn("word", F.concat(F.lit("f"), F.coalesce("k", F.lit("-"))))
    for most in (1, 4, 1000):
        out = with_facts(rows, facts, ["k"], "count", most)
        assert out.columns == ["k", "word"] and out.count() == 100
        assert out.where("word <> concat('f', coalesce(k, '-'))").count() == 0


# --- runs ------------------------------------------------------------------------------------


def plain_runs(words: list, least=6, repeats=4) -> list:
    found = []
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i < len(words) - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            part = words[i : j + q]
            smaller = any(part[: len(part) - p] == part[p:] for p in range(1, q))
            if len(part) >= max(least, repeats * q) and not smaller:
                found.append((i, len(part), q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_planted(i: int, words: list) -> list:
    h = zlib.crc32(str(i).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]


def plain_row(i, text) -> tuple:
    words = plain_planted(i, WORD.findall(text or ""))
    runs = plain_runs(words)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    shown = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha(shown), sha(kept)


def test_runs_match_plain(spark, small, small_texts):
    columns = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    found = {r["doc_id"]: tuple(r[c] for c in columns) for r in queries.op13_periodic_runs(spark, small).collect()}
    want = {i: plain_row(i, t) for i, t in small_texts.items()}
    assert found == want
    assert sum(x[0] for x in want.values()) > 5


@pytest.mark.parametrize("rule", [(6, 4), (2, 3), (9, 3), (6, 5), (20, 4)])
def test_runs_of_small_alphabets(rule):
    random.seed(rule[0])
    for _ in range(400):
        n = random.randint(0, 120)
        words = [random.randrange(random.choice([1, 2, 3])) for _ in range(n)]
        if n > 5 and random.random() < 0.7:
            a = random.randrange(n)
            p = random.randint(1, max(1, (n - a) // 3))
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        found = periodic_runs.runs_of(np.array(words, dtype=np.int64), periodic_runs.Rule(*rule))
        assert [tuple(r) for r in found.tolist()] == plain_runs(words, *rule)


def test_runs_need_three_periods():
    with pytest.raises(ValueError):
        periodic_runs.Rule(6, 2)


def test_runs_of_odd_texts(spark, odd, nothing):
    assert periodic_runs.find_runs(nothing).count() == 0
    clash = odd.withColumn("found", F.lit(1)).withColumn("runs", F.lit("x")).withColumn("words", F.lit(2))
    out = {r["doc_id"]: r for r in periodic_runs.find_runs(clash).collect()}
    for i, t in ODD_TEXTS.items():
        words = WORD.findall(t or "")
        assert out[i]["n_words"] == len(words) and out[i]["found"] == 1
        want = [(0, 30_000, 1)] if i == 7 else plain_runs(words)
        assert [tuple(r) for r in out[i]["runs"]] == want
    assert out[7]["collapsed"] == "wordy" and out[2]["collapsed"] == "" and out[0]["collapsed"] == ""
    planted = {r["doc_id"]: r["text"] for r in periodic_runs.with_planted_runs(odd.withColumn("words", F.lit(1))).collect()}
    for i, t in ODD_TEXTS.items():
        assert WORD.findall(planted[i] or "") == plain_planted(i, WORD.findall(t or ""))
    same = periodic_runs.with_planted_runs(spark.createDataFrame([(None, "a b")], "doc_id bigint, text string"))
    assert [r["text"] for r in same.collect()] == ["a b"]


def test_runs_stay_fast_where_grams_recur():
    random.seed(1)
    long = [b"w " * 300_000, b" ".join(b"%d" % random.randrange(2) for _ in range(200_000)), b" ".join(b"%d" % (i % 50_001) for i in range(250_000))]
    for text in long:
        start = time.perf_counter()
        periodic_runs.found_in([text], periodic_runs.Rule())
        assert time.perf_counter() - start < 10
