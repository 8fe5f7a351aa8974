"""Text judgements against plain versions, and what the methods add to the fixed rules."""

import hashlib
import random
import string

import numpy as np
import pytest

from panelcast.llm import html_text, license_scan, quality_model, secrets
from panelcast.llm.queries import QUERIES
from tests.llm import plain
from tests.llm.conftest import ODD_TEXTS


def test_secret_query(spark, small, small_texts):
    rows = QUERIES["op2_secret_scan"](spark, small).collect()
    assert len(rows) == len(small_texts)
    for r in rows:
        base = plain.base_secrets(small_texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s.startswith(k) for s in base) for k in ("assign:", "access:", "hex:")]
        assert set(base) <= set(r["spans"].split(",")) or not base


@pytest.mark.parametrize(
    "text",
    [
        "api_key: abcdef token=short Token = 'abc123==' PASSWORD=abcdef",
        "paſſword=abcdefgh toKen=abcdefgh 🙂secret=abcdefgh",
        "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + "AKIAAKIA",
        "deadbeef" * 3 + " " + "deadbeef" * 2 + " é" + "0" * 24,
        "secret==abc secret=  abcdef.ghi=/+-",
    ],
)
def test_known_forms(text):
    names = {0: "assign", 1: "access", 2: "hex"}
    assert [f"{names[k]}:{a}:{b}" for a, k, b in secrets.base_spans(text)] == plain.base_secrets(text)


def test_random_strings_are_reported_and_words_are_not():
    draw = random.Random(9)
    letters = string.ascii_letters + string.digits + "+/"
    found = sum(any(k == 3 for _, k, _ in secrets.spans_of("a " + "".join(draw.choices(letters, k=40)) + " b")) for _ in range(200))
    assert found >= 190
    words = ["internationalization2of3things", "https/example/com/path/to/file2", "a1" * 20, "version_2_of_this_module_name_long", "4111111111111111111111"]
    for w in words:
        assert not [s for s in secrets.spans_of(f"see {w} there") if s[1] == 3]


def test_longer_strings_are_surer():
    draw, last = random.Random(4), 1.0
    letters = string.ascii_letters + string.digits
    for n in (20, 40, 80, 160):
        p = float(np.median([secrets.battery("".join(draw.choices(letters, k=n))).text_p for _ in range(60)]))
        assert p < last
        last = p


def test_step_up_rejects_a_prefix_of_sorted_values():
    assert secrets.discoveries([]) == []
    assert secrets.discoveries([(0.0001, 30), (0.5, 30), (0.009, 30)], 0.05) == [True, False, True]
    assert secrets.discoveries([(0.02, 20), (0.02, 60)], 0.01) == [False, False]


@pytest.mark.parametrize("neighbours", [0, 100, 1000])
@pytest.mark.parametrize(
    ("letters", "length"),
    [
        (string.ascii_letters + string.digits, 24),
        (string.ascii_letters + string.digits, 32),
        ("0123456789ABCDEF", 32),
        (string.ascii_uppercase + "234567", 32),
        (string.ascii_lowercase + string.digits, 32),
    ],
)
def test_secrets_are_found_among_many_neighbours(letters, length, neighbours):
    draw, words = random.Random(length), "report image upload user profile summer sale review guide travel music release notes budget".split()
    tries, found, false = 40 if neighbours < 1000 else 8, 0, 0
    for _ in range(tries):
        others = ["-".join(draw.choices(words, k=5)) + f"-{draw.randint(1, 2030)}" for _ in range(neighbours)]
        key, before = "".join(draw.choices(letters, k=length)), " ".join(others[: neighbours // 2])
        spans = [(a, b) for a, k, b in secrets.spans_of(f"{before} {key} {' '.join(others[neighbours // 2 :])}") if k == 3]
        hit = (len(before) + 1, len(before) + 1 + length)
        found, false = found + (hit in spans), false + len(set(spans) - {hit})
    assert found >= 0.8 * tries and false == 0


@pytest.mark.parametrize("path", ["host/my-app/{}", "path/user_name/{}", "{}/my-app/x_y", "repo/{}-backup/file", "a+b-c/{}?x=1", "deadbeefdeadbeefdeadbeef01/{}"])
def test_keys_in_paths_are_covered(path):
    draw, signs = random.Random(5), string.ascii_letters + string.digits + "+/"
    for letters, least in ((signs[:62], 38), (signs, 36), ("0123456789ABCDEF", 39)):
        keys = ["".join(draw.choices(letters, k=40)) for _ in range(40)]
        texts = [f"see {path.format(k)} there" for k in keys]
        found = [[(a, b) for a, kind, b in secrets.spans_of(t) if kind == 3] for t in texts]
        assert sum(any(a <= t.index(k) and t.index(k) + 40 <= b for a, b in f) for k, t, f in zip(keys, texts, found)) >= least
        assert all(x[1] <= y[0] for f in found for x, y in zip(f, f[1:]))
    assert secrets.spans_of(f"see {path.format('user-guide_of/the+summer')} there") == [s for s in secrets.base_spans("see " + path) if s]


def test_redaction(odd, spark, nothing):
    assert {r["doc_id"]: r["text"] for r in secrets.redact(odd).collect()} == ODD_TEXTS
    one = spark.createDataFrame([(1, "x token=abcdef12 y AKIA" + "Q" * 16 + "!"), (2, "password=" + "a1" * 15)], "doc_id int, text string")
    assert [r["text"] for r in secrets.redact(one).orderBy("doc_id").collect()] == ["x [SECRET] y [SECRET]!", "[SECRET]"]
    assert secrets.redact(nothing).count() == 0 and secrets.scan(nothing).count() == 0
    assert secrets.scan(odd).count() == len(ODD_TEXTS)


def test_quality_query(spark, small, small_texts):
    rows = QUERIES["op8_quality_rules"](spark, small).collect()
    assert len(rows) == len(small_texts)
    for r in rows:
        wanted = plain.quality_counts(small_texts[r["doc_id"]] or "")
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == wanted
        assert not (r["kept"] and r["base_failed"])


def test_counts_of_odd_texts(odd, nothing):
    model = quality_model.fit([], np.array([]))
    for r in quality_model.judge(odd, model).collect():
        wanted = plain.quality_counts(ODD_TEXTS[r["doc_id"]] or "")
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == wanted
        assert r["kept"] == (not r["base_failed"])
    kept = quality_model.keep_good(odd, model)
    assert kept.columns == odd.columns
    assert quality_model.judge(nothing, model).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    learnt = labels.where("doc_id % 3 <> 0")
    model = quality_model.train(docs, learnt)
    seen = quality_model.judge(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").where("NOT base_failed").collect()
    right = [r["kept"] == (r["quality"] == 1) for r in seen]
    assert len(right) > 80 and np.mean(right) >= 0.95
    # probabilities mean what they say: the mean is near the share of good texts
    assert abs(np.mean([r["probability"] for r in seen]) - np.mean([r["quality"] for r in seen])) < 0.1


def test_sample_is_bounded_and_ordered(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "labels"))
    texts, quality = quality_model.labelled_sample(docs, labels, "doc_id", "text", rows=20)
    again, _ = quality_model.labelled_sample(docs.repartition(5), labels.repartition(3), "doc_id", "text", rows=20)
    assert len(texts) == len(quality) == 20 and texts == again


def test_licence_query(spark, small, small_texts):
    rows = QUERIES["op9_license_scan"](spark, small).collect()
    assert len(rows) == len(small_texts)
    for r in rows:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain.licence_names(small_texts[r["doc_id"]] or "")
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1


@pytest.mark.parametrize("text", ["MIT license MIT-License mit, LICENSE", "general public license license", "", "é mit license世", "the apache license mit license"])
def test_licence_names(text):
    words = license_scan.words_of(text.encode())
    found = license_scan.named(words)
    got = (len(words), len(found), found[0][0] if found else None, found[-1][0] if found else None, ",".join(sorted({x for _, x in found})))
    assert got == plain.licence_names(text)


def test_templates_are_found_whole_and_edited_but_not_by_scattered_words(spark):
    mit = dict((t[0], t[1]) for t in reversed(license_scan.TEMPLATES))["mit"]
    notice = license_scan.TEMPLATES[1][1]
    edited = notice.replace("associated documentation", "accompanying").replace("sublicense", "license on")
    keyless = notice.replace("free of charge", "gratis")
    shuffled = " ".join(sorted(notice.split()))
    rows = [(1, f"before {notice} after"), (2, f"x y {edited}"), (3, keyless), (4, shuffled), (5, "Licensed under CC BY-NC 4.0."), (6, None), (7, mit)]
    found = {r["i"]: r["labels"] for r in license_scan.scan(spark.createDataFrame(rows, "i int, text string")).collect()}
    assert found == {1: "mit", 2: "mit", 3: "", 4: "", 5: "cc-by-nc", 6: "", 7: "mit"}


def test_licences_of_odd_texts(odd, nothing):
    assert license_scan.scan(odd).where("n_base = 0").count() == len(ODD_TEXTS)
    assert license_scan.scan(nothing).count() == 0


PAGES = {
    "": "",
    "<p>hi": "hi",
    "plain": "plain",
    "a < b and c": "a < b and c",
    "<article><p>One &amp; two<b>bold</b></p><div class='ad'>buy</div><p>Sit.</p><aside>x</aside><p>End&nbsp;here</p></article>": "One & twobold Sit. End here",
    "<nav>menu<article><h1>T</h1><p>Text</p><section id=comments><p>nice</p></section></article><footer>f": "T Text",
    "<script>var a='<p>x</p>'": "",
    "<form>name<input></form><div class='cookie-notice'>We use</div><main><p>Body</p></main><!-- open": "Body",
    "<article><header><h1>T</h1></header>x &lt;b&gt;</article>": "T x <b>",
    "<div class='menu'><a href=x>Home</a></div><div>" + "<p>long words here</p>" * 20 + "<p>Hm.</p></div><div class='site-footer'>(c) 2020</div>": "long words here " * 20 + "Hm.",
    "<div>" * 5000 + "deep" + "</div>" * 5000: "deep",
    "<a href=\"never closed><p>x</p>": "<a href=\"never closed> x",
}


@pytest.mark.parametrize("html", PAGES)
def test_main_text(html):
    assert html_text.main_text(html).strip() == PAGES[html].strip()


def test_surge_and_dive():
    assert html_text.runs(np.array([0, 0, 0, 5, 0, 9, 0, 0, 0, 4])) == [(1, 6, 14), (7, 10, 4)]
    assert html_text.runs(np.array([], dtype=int)) == []


def test_pages_query(spark, small):
    rows = QUERIES["op4_html_text"](spark, small).collect()
    assert rows and all(r["n_chars"] == len(r["text"]) and "  " not in r["text"] for r in rows)


def test_pages_with_odd_rows(spark):
    odd = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (2, "", "b"), (3, "<p>" + "w " * 100_000, "c")], "page_id int, html string, text string")
    found = html_text.extract(odd)
    assert found.columns == odd.columns
    assert sorted(len(r["text"]) for r in found.collect()) == [0, 0, 0, 199_999]
    assert html_text.extract(odd.where("page_id > 9")).count() == 0
