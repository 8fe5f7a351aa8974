"""Byte-pair encoding by forced boundaries, and decoding.

A pair of adjacent bytes that occurs inside no token of the vocabulary can never be merged over: it
marks a certain cut. Each pre-token is cut at all such pairs, the fragments are encoded on their own
and their ids are concatenated, which gives the ids of the whole. Words recur, so most are looked up
in a bounded memory; only new ones are cut and merged. Where words have ends, the new words of a run of
texts go to the compiled merges in one call; as they are short, those need no cuts.

Ids are bytes, little-endian unsigned 32-bit: they cross from Python to the JVM without boxing.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import compress, repeat
from operator import is_

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelcast.llm.common import bounded_batches, strings, text_or_empty

#: The public split patterns of byte-level and of lower-case word vocabularies.
BYTE_SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
WORD_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
#: Stands for the end of a word. UTF-8 never holds this byte.
WORD_END = b"\xff"
#: A run of white space that a cut before its space would break up.
MIXED_SPACE = re.compile(r"\s \s|  |\s \Z")
#: Below this code point every Unicode version agrees on letters and numbers; above, the library splits.
SETTLED = "ɐ"
#: ``WORD_SPLIT`` for lower-case words below U+0180 that stand in lines; the ends of lines are kept.
LINES_SPLIT = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ſ]+|[0-9²³¹¼½¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ſ0-9²³¹¼½¾]+|\n"
)
#: In UTF-8: a code point from U+0180 on, or the one below whose lower case is beyond.
BEYOND_LINES = re.compile(rb"[\xc6-\xff]|\xc4\xb0")
#: Words that a worker remembers in each of two generations, and the longest of them.
REMEMBERED, LONGEST = 150_000, 48
#: Words that are looked up at once.
RUN = 1 << 14


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: bytes that print stand for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Memory(dict):
    """Ids of the words seen last. What a generation did not use again is forgotten with it."""

    def __init__(self, make, size: int = REMEMBERED):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, word):
        ids = self.older.get(word)
        if ids is None:
            ids = self.make(word)
            if len(word) > LONGEST:
                return ids
        self.keep({word: ids})
        return ids

    def keep(self, made: dict) -> None:
        if len(self) + len(made) > self.size:
            self.older = dict(self)
            self.clear()
        self.update(made)

    def each(self, words: list, make_all) -> list[bytes]:
        """Ids of every word; those of new words are made all at once."""
        ids = list(map(self.get, words))
        if None in ids:
            unmet = dict.fromkeys(compress(words, map(is_, ids, repeat(None))))
            met = {w: self.older[w] for w in unmet if w in self.older}
            new = [w for w in unmet if w not in met]
            met.update(zip(new, make_all(new)))
            ids = [met[w] if i is None else i for w, i in zip(words, ids)]
            self.keep({w: i for w, i in met.items() if len(w) <= LONGEST})
        return ids


class Vocabulary:
    """Tokens, merge ranks and forced cuts of a byte-pair vocabulary, byte-level or with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.alphabet = byte_alphabet()
        model, suffix = spec["model"], spec["model"].get("end_of_word_suffix")
        self.end = WORD_END if suffix else b""
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}

        def raw(token: str) -> bytes:
            ended = bool(suffix) and token.endswith(suffix)
            plain = token[: -len(suffix)] if ended else token
            return bytes(self.alphabet[c] for c in plain) + (WORD_END if ended else b"")

        self.id_of = {raw(t): i for t, i in model["vocab"].items() if t not in self.special}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(raw(a), raw(b)): r for r, (a, b) in enumerate(merges)}
        size = max([*self.id_of.values(), *self.special.values()]) + 1
        self.token = [b""] * size
        for token, i in self.id_of.items():
            self.token[i] = token.replace(WORD_END, b" ") if suffix else token
        for token, i in self.special.items():
            self.token[i] = token.encode()
        self.inside = frozenset(pair for t in self.id_of for pair in zip(t, t[1:]))
        self.close = self._close()
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.core, self.lines_core, self.place = self._core(raw, merges)
        if self.lines_core is not None:
            self.places = np.frombuffer(b"".join(self.place), dtype="<u4")
            (self.line_end,) = self.lines_core.encode_ordinary("\n ")
        self.words = Memory(self.lower_word if suffix else self.byte_word)

    def _core(self, raw, merges):
        """Merges in compiled form, ranked as the vocabulary ranks them, and the id of each rank.

        A last byte first joins the mark of the word's end, before any merge of the vocabulary. The second form is
        for texts of pre-tokens, with a space for that mark: it cuts behind spaces.
        None where two merges make one token, as a rank of its own is then not known: see ``merged``.
        """
        first = [bytes([b]) for b in range(256)]
        if self.end:
            first += [b + WORD_END for b in first]
        made = [raw(a) + raw(b) for a, b in merges]
        if len({*first, *made}) < len(first) + len(made):
            return None, None, None
        order = {t: r for r, t in enumerate([*first, *made])}
        core = tiktoken.Encoding("vocabulary", pat_str=r"\S+", mergeable_ranks=order, special_tokens={})._core_bpe
        lines_core = None
        if self.end:
            swap = bytes.maketrans(WORD_END + b" ", b" " + WORD_END)
            spaced = {t.translate(swap): r for t, r in order.items()}
            lines_core = tiktoken.Encoding("lines", pat_str=r"[^ ]+ ", mergeable_ranks=spaced, special_tokens={})._core_bpe
        return core, lines_core, [np.uint32(self.id_of.get(t, 0)).tobytes() for t in order]

    def _close(self) -> bytes:
        """Bytes of which any two may stand together in a token: words of these alone have no cut."""
        close: list[int] = [*self.end]
        for b in b"etaoinshrdlucmfwypvbgk ":
            if all((b, c) in self.inside for c in close if c != 32) and all((c, b) in self.inside for c in close if b != 32 and c != 255) and (b == 32 or (b, b) in self.inside):
                close.append(b)
        return bytes(close)

    def fragments(self, piece: bytes) -> list[bytes]:
        """The piece, cut wherever its neighbouring bytes share no token."""
        if not piece.translate(None, self.close):
            return [piece]
        inside = self.inside
        cuts = [i + 1 for i, pair in enumerate(zip(piece, piece[1:])) if pair not in inside]
        return [piece[a:b] for a, b in zip([0, *cuts], [*cuts, len(piece)])]

    def merged(self, fragment: bytes) -> list[int]:
        """Ids of a fragment, plainly: the merge of lowest rank first, leftmost among equals.

        A heap holds the possible merges, so a fragment of n bytes takes O(n log n).
        """
        parts: list[bytes | None] = [fragment[i : i + 1] for i in range(len(fragment))]
        if self.end and parts[-1] == WORD_END:
            parts[-2:] = [parts[-2] + WORD_END]
        left, right = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
        pairs = zip(range(len(parts)), parts, parts[1:])
        waiting = [(self.rank[a, b], i, a, b) for i, a, b in pairs if (a, b) in self.rank]
        heapq.heapify(waiting)
        while waiting:
            _, i, a, b = heapq.heappop(waiting)
            j = right[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue  # one of both has been merged since
            parts[i], parts[j], right[i] = a + b, None, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for x in (left[i], i):
                y = right[x] if x >= 0 else -1
                if y >= 0 and (r := self.rank.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(waiting, (r, x, parts[x], parts[y]))
        return [self.id_of[p] for p in parts if p is not None]

    def pieces(self, pieces: list[bytes]) -> bytes:
        """Ids of pre-tokens: the ids of their fragments, one after the other."""
        if self.core is None:
            return np.array([i for p in pieces for f in self.fragments(p) for i in self.merged(f)], dtype="<u4").tobytes()
        one = self.core.encode_single_piece
        place = self.place
        return b"".join([place[r] for p in pieces for f in self.fragments(p) for r in one(f)])

    def split(self, text: str) -> list[bytes]:
        """Pre-tokens of a text that is normalised already."""
        if text.isascii() or max(text) < SETTLED:
            found = (WORD_SPLIT if self.end else BYTE_SPLIT).findall(text)
            return [p.encode() + self.end for p in found]
        found = self.library.pre_tokenizer.pre_tokenize_str(text)
        return [bytes(self.alphabet[c] for c in p) + self.end for p, _ in found]

    def plain(self, text: str) -> bytes:
        return self.pieces(self.split(text))

    def byte_word(self, word: str) -> bytes:
        """Ids of a word with its leading space. A final mark is looked up apart, as a pre-token of its own."""
        if word.isascii() and (bare := word[:-1]).strip(" ").isalpha() and bare[:2] != "  ":
            last = word[-1]
            if last in ",.":
                return self.words[bare] + self.words[last]
            if last.isalpha():
                return self.pieces([word.encode()])
        return self.plain(word)

    def lower_word(self, word: bytes) -> bytes:
        """Ids of a word under a vocabulary that normalises.

        Below ``SETTLED`` texts are composed already and lower-case letter by letter; else the library normalises.
        """
        bare = word[:-1]
        if bare.isalpha():  # bytes: ASCII letters only
            last = word[-1:]
            if last in b",.":
                return self.words[bare] + self.words[last]
            if last.isalpha():
                whole = word.lower() + WORD_END
                if self.core is not None and not whole.translate(None, self.close):
                    return b"".join([self.place[r] for r in self.core.encode_single_piece(whole)])
                return self.pieces([whole])
        text = word.decode()
        return self.plain(text.lower() if max(text) < SETTLED else self.library.normalizer.normalize_str(text))

    def lower_words(self, words: list[bytes]) -> list[bytes]:
        """``lower_word`` of many: the short ones below U+0180 are encoded in one call, as lines of a text."""
        if self.lines_core is None:
            return [self.lower_word(w) for w in words]
        apart = {w: self.lower_word(w) for w in words if len(w) > LONGEST or not w.isascii() and BEYOND_LINES.search(w)}
        lines = b"\n".join([*([w for w in words if w not in apart] if apart else words), b""]).decode().lower()
        pieces = " ".join([*LINES_SPLIT.findall(lines), ""])
        ranks = np.array(self.lines_core.encode_ordinary(pieces), dtype=np.int64)
        ends = 4 * np.flatnonzero(ranks == self.line_end)
        ids = self.places[ranks].tobytes()
        made = [ids[a:b] for a, b in zip([0, *(ends + 4).tolist()], ends.tolist())]
        following = iter(made)
        return [apart[w] if w in apart else next(following) for w in words] if apart else made

    def spaced(self, text: str) -> bytes:
        """Ids of a text without special tokens, by words.

        With word ends, white space only separates. In a byte-level vocabulary one space always begins
        a pre-token, so the text may be cut there unless it is part of a longer run of white space.
        """
        words = self.words
        if self.end:
            return b"".join([words[w] for w in text.encode().split()])
        if MIXED_SPACE.search(text):
            return self.plain(text)
        first, *rest = text.split(" ")
        return words[first] + b"".join([words[w] for w in [" " + w for w in rest]])

    def encode(self, text: str) -> bytes:
        if not self.specials.search(text):
            return self.spaced(text)
        out, at = [], 0
        for found in self.specials.finditer(text):
            out += [self.spaced(text[at : found.start()]), np.uint32(self.special[found[0]]).tobytes()]
            at = found.end()
        return b"".join([*out, self.spaced(text[at:])])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """``encode`` of many texts; where words have ends, runs of texts look up their words together."""
        if not self.end:
            return [self.encode(t) for t in texts]
        marked = [bool(self.specials.search(t)) for t in texts]
        plain = self._all_spaced(t for t, m in zip(texts, marked) if not m)
        return [self.encode(t) if m else next(plain) for t, m in zip(texts, marked)]

    def _all_spaced(self, texts: Iterable[str]) -> Iterator[bytes]:
        found: list[bytes] = []
        ends = [0]

        def run() -> Iterator[bytes]:
            ids: list[bytes] = []
            for at in range(0, len(found), RUN):
                ids += self.words.each(found[at : at + RUN], self.lower_words)
            return (b"".join(ids[a:b]) for a, b in zip(ends, ends[1:]))

        for text in texts:
            found += text.encode().split()
            ends.append(len(found))
            if len(found) >= RUN:
                yield from run()
                found, ends = [], [0]
        yield from run()

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Read once in each worker, from the place where the tokenizer is installed on every machine."""
    return Vocabulary(path)


def encode_column(text: Column, path: str) -> Column:
    """Binary column of ids; a null text is encoded as the empty text."""

    @F.arrow_udf("binary")
    def encoded(texts: pa.Array) -> pa.Array:
        encode = vocabulary(path).encode
        return pa.array([encode(t) for t in strings(texts)], type=pa.binary())

    return encoded(text)


def decode_column(ids: Column, path: str) -> Column:
    """Text column of ids; null gives the empty text."""

    @F.arrow_udf("string")
    def decoded(values: pa.Array) -> pa.Array:
        decode = vocabulary(path).decode
        return pa.array([decode(v or b"") for v in values.to_pylist()], type=pa.string())

    return decoded(ids)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of every text as a binary column.

    ``path`` is a tokenizer file that every machine has. Null and empty texts get no ids (an empty value).
    A column already called like ``ids`` is replaced; other columns, repeated rows and an empty table
    pass through as they are.
    """
    bounded_batches(df.sparkSession)
    return df.withColumn(ids, encode_column(text_or_empty(text), path))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of every row's ids; null ids give the empty text, ids beyond the vocabulary an error."""
    bounded_batches(df.sparkSession)
    return df.withColumn(text, decode_column(F.col(ids), path))


def token_count(ids: str = "ids") -> Column:
    return (F.length(F.col(ids)) / 4).cast("long")
