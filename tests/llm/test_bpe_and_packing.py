"""Encoding against the tokenizers library; packing against its own rules and plain best fit."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from panelcast.llm import binary_output, bpe, cost_packing
from panelcast.llm.queries import BYTE_TOKENIZER, QUERIES, WORD_TOKENIZER
from tests.llm.conftest import ODD_TEXTS

PARTS = list("ab 's'll  \n\n\t1२½ⅷéÉ世界🙂　\x85\x1c\x0b<|!?.,_-ΣσÁ̸") + ["<|endoftext|>", "don't", "  ", " \n", "İ", "́", "ΑΣ "]


def library_ids(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE_TOKENIZER, WORD_TOKENIZER])
def test_ids_of_random_texts(path):
    library, own, draw = Tokenizer.from_file(path), bpe.vocabulary(path), random.Random(5)
    for _ in range(3000):
        text = "".join(draw.choices(PARTS, k=draw.randint(0, 14)))
        wanted = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == wanted, text


def test_plain_merges_agree_with_compiled_ones():
    for path in (BYTE_TOKENIZER, WORD_TOKENIZER):
        own = bpe.vocabulary(path)
        for token in list(own.id_of)[::97]:
            if len(token) > len(own.end):
                ranks = own.core.encode_single_piece(token)
                assert own.merged(token) == np.frombuffer(b"".join(own.place[r] for r in ranks), "<u4").tolist()


def test_cuts_are_certain():
    own = bpe.vocabulary(BYTE_TOKENIZER)
    for token in own.id_of:
        assert own.fragments(token) == [token]
    pieces = own.fragments("世界é".encode())
    assert b"".join(pieces) == "世界é".encode()


def test_forgetting_changes_nothing():
    own = bpe.vocabulary(BYTE_TOKENIZER)
    kept = own.words
    own.words = bpe.Memory(own.byte_word, size=3)
    try:
        text = "one two three, four. one two five six seven one"
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library_ids(BYTE_TOKENIZER, text)
    finally:
        own.words = kept


@pytest.mark.parametrize("path", [BYTE_TOKENIZER, WORD_TOKENIZER])
def test_ids_of_texts_together(path, monkeypatch):
    """Also with runs that end inside of texts, a memory that forgets, and words that are met again."""
    library, own, draw = Tokenizer.from_file(path), bpe.vocabulary(path), random.Random(6)
    monkeypatch.setattr(bpe, "RUN", 20)
    monkeypatch.setattr(own, "words", bpe.Memory(own.words.make, size=50))
    texts = ["".join(draw.choices(PARTS, k=draw.randint(0, 14))) for _ in range(3000)]
    texts += [f"{chr(c)} a{chr(c)}b {chr(c)}, x{chr(c)}{chr(c)}." for c in range(0x260)]
    texts += [t or "" for t in ODD_TEXTS.values()] + ["w" * n + " é" * n for n in range(45, 52)]
    for text, ids in zip([*texts, *texts], own.encode_all([*texts, *texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert own.encode_all([]) == []


def test_lines_are_split_like_words():
    plain = [chr(c) for c in range(0x180) if c != 0x130]
    assert not any(bpe.BEYOND_LINES.search(c.encode()) for c in plain)
    for a in plain:
        for b in plain:
            text = (a + b).lower()
            assert [p for p in bpe.LINES_SPLIT.findall(text) if p != "\n"] == bpe.WORD_SPLIT.findall(text)


def test_new_words_are_merged_in_one_call(monkeypatch):
    own, alone = bpe.vocabulary(WORD_TOKENIZER), []
    monkeypatch.setattr(own, "words", bpe.Memory(own.lower_word))
    monkeypatch.setattr(own, "lower_word", lambda word: alone.append(word) or own.plain(word.decode()))
    texts = [f"Unmet{n}, überall{n}. naïve### x{n}y" for n in range(500)]
    own.encode_all([*texts, "世界"])
    assert alone == ["世界".encode()]


def test_round_trip_of_odd_texts(odd, nothing):
    coded = bpe.decode(bpe.encode(odd, BYTE_TOKENIZER), BYTE_TOKENIZER)
    assert set(coded.columns) == {*odd.columns, "decoded"}
    for row in coded.collect():
        text = ODD_TEXTS[row["doc_id"]] or ""
        assert row["decoded"] == text
        assert np.frombuffer(row["ids"], "<u4").tolist() == library_ids(BYTE_TOKENIZER, text)
    assert bpe.encode(nothing, BYTE_TOKENIZER).count() == 0


def test_bpe_query(spark, small, small_texts):
    library = Tokenizer.from_file(BYTE_TOKENIZER)
    rows = QUERIES["op1_bpe_round_trip"](spark, small).collect()
    assert len(rows) == len(small_texts)
    for r in rows:
        ids = library.encode(small_texts[r["doc_id"]] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def check_pieces(rows, ids):
    sequences, docs = {}, {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        docs.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(docs) == set(ids)
    for spans, whole in ((docs, {d: len(x) for d, x in ids.items()}), (sequences, {})):
        for name, got in spans.items():
            at = 0
            for start, n in sorted(got):
                assert start == at and n > 0
                at += n
            assert at == whole.get(name, at)
    lengths = [sum(n for _, n in s) for s in sequences.values()]
    assert all(n == 4096 or (n < 4096 and n & (n - 1) == 0) for n in lengths)


def test_packing_query(spark, small, small_texts):
    library = Tokenizer.from_file(WORD_TOKENIZER)
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, 2] for d, t in small_texts.items()}
    check_pieces(QUERIES["op10_cost_packing"](spark, small).collect(), ids)


def test_packing_of_odd_texts(odd, nothing):
    ids = {d: [*library_ids(WORD_TOKENIZER, t or ""), 2] for d, t in ODD_TEXTS.items()}
    check_pieces(cost_packing.pack(odd, WORD_TOKENIZER, 2, block_tokens=5000).collect(), ids)
    assert cost_packing.pack(nothing, WORD_TOKENIZER, 2).count() == 0


def spread_of_costs(rows):
    costs = [sum(map(cost_packing.cost, row)) for row in rows if sum(row) == 4096 and len(row) > 1]
    return np.std(costs) / np.mean(costs)


def test_costs_are_closer_than_by_best_fit():
    draw = random.Random(3)
    sizes = [min(3000, int(draw.lognormvariate(6, 1)) + 1) for _ in range(1500)]
    spent = {}
    for _, _, n, into, _ in cost_packing.balanced(sizes):
        spent.setdefault(into, []).append(n)
    by_room = [[n for _, _, n in row] for row in binary_output.best_fit(sizes, 4096)]
    assert spread_of_costs(spent.values()) < 0.8 * spread_of_costs(by_room)


def test_capacities_need_no_padding():
    for total in (0, 1, 4095, 4096, 4097, 123_457):
        rooms = cost_packing.capacities(total).tolist()
        assert sum(rooms) == total and all(r & (r - 1) == 0 for r in rooms)


def plain_best_fit(sizes, length):
    rooms = []
    for n in sorted(sizes, reverse=True):
        fitting = [r for r in rooms if r >= n]
        if fitting:
            rooms[rooms.index(min(fitting))] -= n
        else:
            rooms.append(length - n)
    return sorted(rooms)


def test_segment_tree_finds_the_best_fit():
    draw = random.Random(2)
    for _ in range(200):
        sizes = [draw.randint(1, 63) for _ in range(draw.randint(0, 60))]
        rows = binary_output.best_fit(sizes, 64)
        assert sorted(64 - sum(n for _, _, n in row) for row in rows) == plain_best_fit(sizes, 64)


def test_matrices_hold_every_token_once(odd, nothing):
    length = 256
    found = binary_output.matrices(odd, WORD_TOKENIZER, end_id=2, length=length, block_tokens=4000).collect()
    back = {}
    for r in found:
        ids, places = np.frombuffer(r["ids"], "<u2"), np.frombuffer(r["positions"], "<i4")
        bounds = r["cu_seqlens"]
        assert len(ids) == len(places) == length and bounds[0] == 0 and bounds[-1] == r["tokens"]
        for doc, start, a, b in zip(r["doc_ids"], r["starts"], bounds, bounds[1:]):
            assert places[a:b].tolist() == list(range(b - a))
            back.setdefault(doc, []).append((start, ids[a:b].tolist()))
        assert not ids[bounds[-1] :].any() and not places[bounds[-1] :].any()
    for doc, text in ODD_TEXTS.items():
        whole = [i for _, part in sorted(back[doc]) for i in part]
        assert whole == [*library_ids(WORD_TOKENIZER, text or ""), 2]
    assert len({r["sequence_id"] for r in found}) == len(found)
    assert binary_output.matrices(nothing, WORD_TOKENIZER, end_id=2).count() == 0


def test_matrices_query(spark, small, small_texts):
    rows = QUERIES["op7_packed_matrices"](spark, small).collect()
    own = bpe.vocabulary(WORD_TOKENIZER)
    assert sum(r["tokens"] for r in rows) == sum(len(own.encode(t or "")) // 4 + 1 for t in small_texts.values())
