"""Secrets in texts: known forms, and strings that pass for random under a battery of tests.

Known forms are found by pattern. For everything else a candidate is a run of encoding characters, and
its encoding (hexadecimal, base32, base64 or letters and digits) is inferred from the characters used.
A run can be a path that holds a key, so its parts between the signs ``+ / - _`` are candidates as well.
Three tests then ask whether the symbols look drawn evenly and independently from that alphabet:

* chi-squared: how even are the counts of symbols;
* runs: how often do the symbols cross the middle of the alphabet;
* serial correlation: does a symbol depend on the one before.

Each test gives a p-value that randomness is right; a candidate whose smallest value, corrected for three
tests, is below ``RANDOM`` is not random and is left. For the rest the question is turned round: how likely
does ordinary text hold such a string? Text is a chain of letter pairs that seldom changes between small and
capital letters, digits and signs; the chance that it seems at least as random as the candidate is at most the
ratio of both likelihoods (Markov's inequality), whatever the alphabet, and falls with the length: a short run
proves little, a long one much. These p-values go through the step-up procedure of Benjamini and Hochberg,
weighted by length. A family is ``FAMILY`` candidates in a row, of those that may be random, so that a secret
counts as much in a long text as in a short one. What is rejected is reported as ``random``; of overlapping
candidates that with the strongest evidence, with the parts beside it that read like more of it.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import bounded_batches, strings, text_or_empty

#: The known forms, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX_LONG = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

#: Runs of encoding characters; shorter ones can't be told from words.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Where runs are cut: signs of one alphabet only, the slash, all signs.
CUTS = tuple(map(re.compile, (r"[-_]+", r"[+/]+", r"/+", r"[-+/_]+")))
LEAST_CANDIDATE = 20
#: Parts beside a secret: up to the next sign, forward and backward.
PART, BACK = re.compile(r"[-+/_]+[A-Za-z0-9]*|[A-Za-z0-9]+"), re.compile(r"[A-Za-z0-9]+[-+/_]*|[-+/_]+")
#: Evidence that they may lack, that ends the search, and the size of the widest alphabet.
NEARLY, HOPELESS, WIDEST = 3.0, 20.0, 64
#: Alphabets from narrow to wide: the first that holds all symbols is the encoding.
ALPHABETS = (
    ("hexadecimal", "0123456789abcdef"),
    ("hexadecimal", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
    ("lower", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
#: Below this p-value a candidate is not random.
RANDOM = 0.001
#: Share of false reports allowed among the reports.
FALSE_SHARE = 0.01
#: Candidates tested together.
FAMILY = 64
#: Ordinary text: how often a letter follows another, in five languages of Europe (from message catalogues and
#: source code). The first row starts a word, the others follow a to z; columns are a to z; a letter of the
#: table stands for half bits, "a" for a chance of 1 and "c" for one half.
PAIRS = """
hjiiikkljokjijkipjhillmpoo mkjjnokmjolhifnkqgihkmnpmn fnmofqoogmqhonhotikmhrpsmr gqlohqqfhsjkoofpsjmikrstqt
gooleoonfoqmnngotkknjpproq knijkllokqnijfnlpfgimmoloo hqnnghnqerrjongnsikkisqror gmoneqkkhsokniintijlhqospr
eqpoeqqogtpjmlgptjmjirouos ilijilkqnqnijfhlpjhholqopm enonfsqogqnppngmunlogqpupt eoonfpnjhtolomgmtkjjhqltnq
fonlfnnqfrphnnhntokjjorslq eioofppqgtqnknhhtnlmjqqsps gojhhmgphpmnoliosoigknqsnn lljjmmlolqmiieljrfijjlmqpp
fqmnfooliupipngjrgljirqsns irppmrprktsnpnmpomnmbsnurt fnlkeolpgrnmkkhnskjijoosnp hpiofonjgtlmnnijqnifiposmq
fqmoeoqjfsplonhnuhjjjqpsmo ikklhllojpmiigmjsghhooppoo epopdqpqftroomhoulmompqrqs dpomfppkgsqmpjhoujknkropos
imhmhlongtpllokgtmlemqokmo enmmhonpiroljjhhtliiiporop eonperomfrqnnniprnnlhrmtoj
""".split()
#: Ordinary text: chances of the next kind of character (small, capital, digit, sign), in words and in codes.
KINDS_OF = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/-_")
CHANGES = (
    ((0.86, 0.04, 0.03, 0.07), (0.37, 0.50, 0.05, 0.08), (0.07, 0.05, 0.74, 0.14), (0.60, 0.17, 0.20, 0.03)),
    ((0.60, 0.15, 0.15, 0.10), (0.25, 0.50, 0.15, 0.10), (0.15, 0.15, 0.55, 0.15), (0.40, 0.25, 0.30, 0.05)),
)
#: A random string of letters and digits nearly always holds both; words and numbers hold one.
DIGIT, LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")


def normal_tail(z: float) -> float:
    """Chance of a normal value above z."""
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def chi_squared_tail(x: float, freedom: int) -> float:
    """Chance of a chi-squared value above x (the cube-root approximation of Wilson and Hilferty)."""
    if x <= 0:
        return 1.0
    scale = 2.0 / (9.0 * freedom)
    return normal_tail(((x / freedom) ** (1.0 / 3.0) - (1.0 - scale)) / math.sqrt(scale))


def text_steps(changes: tuple[tuple[float, ...], ...]) -> dict[str, float]:
    """Natural logarithm of the chance of every character after every other in ordinary text."""
    kind = {c: i for i, letters in enumerate(KINDS_OF) for c in letters}
    rows = [[2.0 ** (-(ord(x) - 97) / 2.0) for x in row] for row in PAIRS]
    rows = [[x / sum(row) for x in row] for row in rows]
    steps = {}
    for a, i in kind.items():
        for b, j in kind.items():
            if j < 2:  # a capital after a small letter starts a word
                chance = rows[0 if i > 1 or (i, j) == (0, 1) else 1 + ord(a.lower()) - 97][ord(b.lower()) - 97]
            else:
                chance = 1.0 / len(KINDS_OF[j])
            steps[a + b] = math.log(changes[i][j] * chance)
    return steps


STEPS = tuple(text_steps(changes) for changes in CHANGES)


def inferred(symbols: str) -> tuple[str, str] | None:
    held = set(symbols)
    return next(((name, letters) for name, letters in ALPHABETS if held <= set(letters)), None)


def evenness(symbols: str, k: int) -> float:
    """Chi-squared of the symbol counts against an even share of k symbols."""
    n = len(symbols)
    return k / n * sum(c * c for c in Counter(symbols).values()) - n


def runs_p(places: list[int], k: int) -> float:
    """Two-sided p-value of the number of runs below and above the middle of the alphabet."""
    high = [2 * x >= k for x in places]
    up, down = sum(high), len(high) - sum(high)
    n = up + down
    if up == 0 or down == 0:
        return 2.0 ** (1 - n)
    expected = 2.0 * up * down / n + 1.0
    variance = (expected - 1.0) * (expected - 2.0) / (n - 1.0)
    if variance <= 0:
        return 1.0
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    return 2.0 * normal_tail(max(0.0, abs(runs - expected) - 0.5) / math.sqrt(variance))


def serial_p(places: list[int]) -> float:
    """Two-sided p-value of the correlation of each symbol with the next."""
    n = len(places)
    mean = sum(places) / n
    spread = sum((x - mean) ** 2 for x in places)
    if spread == 0:
        return 0.0
    r = sum((a - mean) * (b - mean) for a, b in zip(places, places[1:])) / spread
    return 2.0 * normal_tail(abs(r + 1.0 / n) * math.sqrt(n))


@dataclass(frozen=True)
class Tested:
    encoding: str
    random_p: float
    evidence: float

    @property
    def text_p(self) -> float:
        """Bound on the chance that ordinary text seems as random."""
        return min(1.0, math.exp(-max(0.0, self.evidence)))


def text_evidence(symbols: str, k: int) -> float:
    """Logarithm of the likelihood under k even symbols over that under text, both less the first symbol.

    Text is taken as the likelier of its two ways, random strings as any of the alphabets with one chance.
    """
    pairs = [a + b for a, b in zip(symbols, symbols[1:])]
    text = max(sum(map(steps.__getitem__, pairs)) for steps in STEPS)
    return -len(pairs) * math.log(k) - text - math.log(len(STEPS) * len(ALPHABETS))


def battery(candidate: str) -> Tested | None:
    """The tests of one candidate; None where the characters fit no encoding."""
    symbols = candidate.rstrip("=")
    found = inferred(symbols)
    if found is None or not DIGIT.search(symbols) or not LETTER.search(symbols):
        return None
    name, letters = found
    k = len(letters)
    place = {c: i for i, c in enumerate(letters)}
    places = [place[c] for c in symbols]
    x = evenness(symbols, k)
    # also suspicious: more even than chance, as in an alphabet written out
    even = 2.0 * min(chi_squared_tail(x, k - 1), max(1e-12, 1.0 - chi_squared_tail(x, k - 1)))
    random_p = min(1.0, 3.0 * min(even, runs_p(places, k), serial_p(places)))
    return Tested(name, random_p, text_evidence(symbols, k))


def discoveries(tested: list[tuple[float, int]], share: float = FALSE_SHARE) -> list[bool]:
    """Benjamini-Hochberg over (p-value, length), each p-value divided by its length's weight of mean one."""
    if not tested:
        return []
    mean = sum(n for _, n in tested) / len(tested)
    weighted = [p * mean / n for p, n in tested]
    bound, m = 0.0, len(weighted)
    for i, p in enumerate(sorted(weighted), 1):
        if p <= share * i / m:
            bound = p
    return [p <= bound for p in weighted]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the known forms, leftmost and non-overlapping within each kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    # a run of 24 is maximal from its first character on, so the short runs need not be visited
    found += [(m.start(), 2, m.end()) for m in HEX_LONG.finditer(text)]
    return sorted(found)


def free_runs(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs of encoding characters, less what the known forms cover."""
    covered: list[list[int]] = []
    for a, _, b in known:
        if covered and a <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], b)
        else:
            covered.append([a, b])
    out, i = [], 0
    for m in CANDIDATE.finditer(text):
        at = m.start()
        while i < len(covered) and covered[i][1] <= at:
            i += 1
        j = i
        while j < len(covered) and covered[j][0] < m.end():
            out.append((at, covered[j][0]))
            at, j = covered[j][1], j + 1
        out.append((at, m.end()))
    return [(a, b) for a, b in out if b - a >= LEAST_CANDIDATE]


def candidates(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs and their parts of 20 characters or more, by start and then end."""
    found = set()
    for a, b in runs:
        found.add((a, b))
        for cut in CUTS:
            at = a
            for c in cut.finditer(text, a, b):
                found.add((at, c.start()))
                at = c.end()
            found.add((at, b))
    return sorted((a, b) for a, b in found if len(text[a:b].rstrip("=")) >= LEAST_CANDIDATE)


def strongest(found: list[tuple[int, int, float]]) -> list[tuple[int, int]]:
    """Spans of the (start, end, evidence) that overlap nothing of more evidence, by start."""
    out: list[tuple[int, int]] = []
    for a, b, _ in sorted(found, key=lambda f: (-f[2], f[0], -f[1])):
        i = bisect_right(out, a, key=lambda f: f[1])
        if i >= bisect_left(out, b, key=lambda f: f[0]):
            out.insert(i, (a, b))
    return out


def beyond(parts: list[str]) -> int:
    """How many characters of what follows a secret belong to it: as far as the sum of evidence hardly falls."""
    total = best = 0.0
    at = reach = 0
    for part in parts:
        pairs = [a + b for a, b in zip(part, part[1:])]
        total += -len(pairs) * math.log(WIDEST) - max(sum(map(steps.__getitem__, pairs)) for steps in STEPS)
        at += len(part) - 1
        if total >= best - NEARLY:
            reach = at
        best = max(best, total)
        if total < best - HOPELESS:
            break
    return reach


def grown(text: str, a: int, b: int, left: int, right: int) -> tuple[int, int]:
    """A secret and the parts beside it, between signs, that read like more of it, within a run."""
    if not inferred(text[a:b].rstrip("="))[0].startswith("base6"):
        return a, b  # signs belong to no narrower encoding
    if b < right and text[b] != "=":
        # each part with the character before it
        ends = [m.end() for m in PART.finditer(text, b, right)]
        b += beyond([text[x - 1 : y] for x, y in zip([b, *ends], ends)])
    if a > left:
        starts = [m.start() for m in BACK.finditer(text, left, a)][::-1]
        a -= beyond([text[x : y + 1] for x, y in zip(starts, [a, *starts])])
    while b < right and text[b] == "=":
        b += 1
    return a, b


def random_spans(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that the battery reports, away from the known ones and from each other."""
    runs, tested = free_runs(text, known), []
    for a, b in candidates(text, runs):
        result = battery(text[a:b])
        if result is not None and result.random_p >= RANDOM:
            tested.append((a, b, result))
    kept = []
    for i in range(0, len(tested), FAMILY):
        family = tested[i : i + FAMILY]
        kept += [f for f, ok in zip(family, discoveries([(t.text_p, b - a) for a, b, t in family])) if ok]
    out: list[tuple[int, int, int]] = []
    for a, b in strongest([(a, b, t.evidence) for a, b, t in kept]):
        a, b = grown(text, a, b, *runs[bisect_right(runs, a, key=lambda r: r[0]) - 1])
        if out and a < out[-1][2]:
            a, b = out[-1][0], max(b, out.pop()[2])
        out.append((a, 3, b))
    return out


def spans_of(text: str) -> list[tuple[int, int, int]]:
    known = base_spans(text)
    return sorted(known + random_spans(text, known))


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def spans_column(text: Column) -> Column:
    """Array of (kind, start, end) in code points, by start and then kind."""

    @F.arrow_udf("array<struct<kind: string, start: bigint, end: bigint>>")
    def found(texts: pa.Array) -> pa.Array:
        rows = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans_of(t)] for t in strings(texts)]
        return pa.array(rows, type=pa.list_(SPAN))

    return found(text)


def scan(df: DataFrame, text: str = "text", spans: str = "secret_spans") -> DataFrame:
    """Add the spans of every text: the known forms and what the randomness battery reports.

    Null and empty texts have none. A column already called like ``spans`` is replaced; other columns and
    repeated rows stay. Each text is judged on its own, so the result does not depend on the other rows.
    """
    bounded_batches(df.sparkSession)
    return df.withColumn(spans, spans_column(text_or_empty(text)))


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Replace every span by ``mark``; overlapping spans become one. Null texts stay null."""
    bounded_batches(df.sparkSession)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else masked(t, mark) for t in texts.to_pylist()], type=pa.string())

    return df.withColumn(text, clean(F.col(text).cast("string")))


def masked(text: str, mark: str) -> str:
    out, at = [], 0
    for a, _, b in spans_of(text):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
