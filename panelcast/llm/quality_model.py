"""Quality rules and a classifier of hashed n-grams.

Counts per text feed two fixed rules. What passes them is judged by a logistic regression over hashed words,
word pairs, and runs of three and four characters. Within each of the four kinds a text is the average of its
n-grams, so its length does not matter and a score is an average of looked-up weights.

The model is fitted on at most ``SAMPLE_ROWS`` labelled rows, those with the smallest hash of their id, which
bounds what reaches the driver. Four fifths train it; the rest calibrate it: a logistic curve through the
held-out scores turns a score into the probability of quality. Texts below a fixed probability are rejected.
Scoring runs in Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import bounded_batches, raw, text_or_empty

#: Weights of each kind of n-gram; the kinds are words, word pairs, three and four characters.
SLOTS_BITS, KINDS = 16, 4
SLOTS = 1 << SLOTS_BITS
#: Labelled rows that reach the driver, at most.
SAMPLE_ROWS = 2000
HELD_OUT = 5
#: Passes over the sample, rows of a step, step size, and the weight of the penalty on large weights.
PASSES, STEP_ROWS, RATE, PENALTY = 8, 64, 0.5, 1e-6
#: Texts less likely to be of quality than this are rejected.
LEAST_PROBABILITY = 0.25
#: Fixed rules: least words, and the largest share of repeated words in percent.
LEAST_WORDS, MOST_REPEATED = 10, 20
WINDOW = 5
SPACE_BYTES = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
SYMBOL_BYTES = np.isin(np.arange(256), list(b"#*$%&|<>"))
INNER_BYTES = (np.arange(256) & 0xC0) == 0x80
ODD = np.uint64(0x9E3779B97F4A7C15)


def spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros(max(0, len(hashes) - width + 1), dtype=np.uint64)
    for i in range(width):
        out = spread(out * ODD + hashes[i : i + len(out)])
    return out


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside five-word windows that the text holds twice or more."""
    runs = windows(hashes, WINDOW)
    if len(runs) < 2:
        return 0
    order = np.argsort(runs, kind="stable")
    same = runs[order][1:] == runs[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(runs), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    begins = np.flatnonzero(twice)
    edges = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(edges, begins, 1)
    np.add.at(edges, begins + WINDOW, -1)
    return int((np.cumsum(edges) > 0).sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def grams(text: bytes, hashes: np.ndarray) -> list[np.ndarray]:
    """Slots of a text's n-grams, a list for each kind."""
    letters = np.frombuffer(text.decode("utf-8").encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    out = []
    for values, width in ((hashes, 1), (hashes, 2), (letters, 3), (letters, 4)):
        if width == 1:
            runs = spread(values * ODD)
        elif values is hashes:
            runs = windows(values, width)
        else:
            n = max(0, len(values) - width + 1)
            runs = np.zeros(n, dtype=np.uint64)
            for i in range(width):
                runs = (runs << np.uint64(21)) ^ (runs >> np.uint64(43)) ^ values[i : i + n]
            runs = spread(runs * ODD)
        out.append((runs >> np.uint64(64 - SLOTS_BITS)).astype(np.int32))
    return out


@dataclass(frozen=True)
class Model:
    """Weights per kind and slot, and the calibration of the score."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, text: bytes, hashes: np.ndarray) -> float:
        total = self.bias
        for kind, slots in enumerate(grams(text, hashes)):
            if len(slots):
                total += float(self.weights[kind][slots].mean())
        return total

    def probability(self, score: float) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * score + self.shift, -40, 40))))


@dataclass(frozen=True)
class Averages:
    """Averaged n-grams of texts: columns and values, text after text, and where each text begins."""

    columns: np.ndarray
    values: np.ndarray
    begins: np.ndarray

    @staticmethod
    def of(texts: list[bytes]) -> Averages:
        columns, values, begins = [np.empty(0, np.int32)], [np.empty(0, np.float32)], [0]
        for text in texts:
            n = 0
            for kind, slots in enumerate(grams(text, word_hashes(text.split()))):
                there, count = np.unique(slots, return_counts=True)
                columns.append(there + np.int32(kind * SLOTS))
                values.append((count / max(1, len(slots))).astype(np.float32))
                n += len(there)
            begins.append(begins[-1] + n)
        return Averages(np.concatenate(columns), np.concatenate(values), np.array(begins))

    def rows(self, first: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row (from 0), column and value of the texts from ``first`` to before ``end``."""
        a, b = self.begins[first], self.begins[end]
        row = np.repeat(np.arange(end - first), np.diff(self.begins[first : end + 1]))
        return row, self.columns[a:b], self.values[a:b]

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        out = np.empty(len(self.begins) - 1)
        for first in range(0, len(out), STEP_ROWS):
            end = min(first + STEP_ROWS, len(out))
            row, column, value = self.rows(first, end)
            out[first:end] = np.bincount(row, value * weights[column], minlength=end - first) + bias
        return out


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit(texts: list[bytes], labels: np.ndarray) -> Model:
    """Fit on four fifths of the rows and calibrate on the rest. Without both labels everything scores alike."""
    n, size = len(texts), KINDS * SLOTS
    if n < 2 * HELD_OUT or labels.min() == labels.max():
        return Model(np.zeros((KINDS, SLOTS), dtype=np.float32), 0.0, 0.0, 40.0)
    held = np.arange(n) % HELD_OUT == 0
    learnt, known = Averages.of([t for t, h in zip(texts, held) if not h]), labels[~held]
    # both labels weigh the same, however rare one is
    share = np.where(known > 0, 0.5 / max(1, (known > 0).sum()), 0.5 / max(1, (known == 0).sum())) * len(known) / STEP_ROWS
    weights, bias = np.zeros(size), 0.0
    seen, seen_bias = np.full(size, 1e-8), 1e-8
    for _ in range(PASSES):
        for first in range(0, len(known), STEP_ROWS):
            end = min(first + STEP_ROWS, len(known))
            row, column, value = learnt.rows(first, end)
            z = np.bincount(row, value * weights[column], minlength=end - first) + bias
            gap = (_logistic(z) - known[first:end]) * share[first:end]
            slope = np.bincount(column, value * gap[row], minlength=size) + PENALTY * weights
            seen += slope * slope
            seen_bias += gap.sum() ** 2
            weights -= RATE * slope / np.sqrt(seen)
            bias -= RATE * gap.sum() / np.sqrt(seen_bias)
    z = Averages.of([t for t, h in zip(texts, held) if h]).scores(weights, bias)
    slope, shift = _calibrated(z, labels[held])
    return Model(weights.reshape(KINDS, SLOTS).astype(np.float32), float(bias), slope, shift)


def _calibrated(z: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through held-out scores, by Newton steps on smoothed labels."""
    good, bad = (labels > 0).sum(), (labels == 0).sum()
    target = np.where(labels > 0, (good + 1.0) / (good + 2.0), 1.0 / (bad + 2.0))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _logistic(a * z + b)
        d = p - target
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([(d * z).sum() + 1e-3 * (a - 1.0), d.sum()])
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text: str, rows: int = SAMPLE_ROWS) -> tuple[list[bytes], np.ndarray]:
    """At most ``rows`` labelled texts, chosen by a hash of the id, in the order of that hash."""
    wanted = labels.where("quality IS NOT NULL").select(F.col("doc_id").alias("_id"), "quality").dropDuplicates(["_id"])
    wanted = wanted.withColumn("_order", F.xxhash64("_id")).orderBy("_order", "_id").limit(rows)
    # the sample is bounded, so it may be broadcast
    found = docs.select(F.col(id_col).alias("_id"), text_or_empty(text).alias("text")).join(F.broadcast(wanted), "_id")
    got = sorted(found.select("_order", "_id", "text", "quality").collect(), key=lambda r: (r["_order"], r["_id"]))
    return [r["text"].encode() for r in got], np.array([float(r["quality"]) for r in got])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> Model:
    """The model of the labelled rows among ``docs``."""
    return fit(*labelled_sample(docs, labels, id_col, text))


FIELDS = (
    ("n_words", "bigint"),
    ("word_chars", "bigint"),
    ("n_symbols", "bigint"),
    ("n_dup_lines", "bigint"),
    ("n_repeat_words", "bigint"),
    ("base_failed", "boolean"),
    ("probability", "double"),
    ("kept", "boolean"),
)


def measured(text: bytes, model: Model) -> tuple:
    words = text.split()
    hashes = word_hashes(words)
    codes = np.frombuffer(text, dtype=np.uint8)
    letters = len(codes) - int(INNER_BYTES[codes].sum()) - int(SPACE_BYTES[codes].sum())
    repeat = repeated_words(hashes)
    failed = len(words) < LEAST_WORDS or 100 * repeat > MOST_REPEATED * len(words)
    probability = model.probability(model.score(text, hashes))
    return (
        len(words),
        letters,
        int(SYMBOL_BYTES[codes].sum()),
        repeated_lines(text),
        repeat,
        failed,
        probability,
        not failed and probability >= LEAST_PROBABILITY,
    )


def verdict_column(spark: SparkSession, model: Model, text: str) -> Column:
    """All fields of a text as a struct."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # a megabyte, fixed by SLOTS

    @F.arrow_udf("struct<" + ", ".join(f"{n}: {k}" for n, k in FIELDS) + ">")
    def judged(texts: pa.Array) -> pa.Array:
        own = shared.value
        columns = list(zip(*[measured(t, own) for t in raw(texts)])) or [()] * len(FIELDS)
        types = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
        arrays = [pa.array(c, type=types[k]) for c, (_, k) in zip(columns, FIELDS)]
        return pa.StructArray.from_arrays(arrays, [n for n, _ in FIELDS])

    return judged(text_or_empty(text))


def judge(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add the counts, base_failed, the probability of quality, and kept.

    Null and empty texts have no words and fail. Columns of these names are replaced, others and repeated rows
    stay; each text is judged alone, so ties and order do not matter; an empty table gives an empty result.
    """
    found = df.withColumn("_quality", verdict_column(df.sparkSession, model, text))
    return found.withColumns({n: F.col(f"_quality.{n}") for n, _ in FIELDS}).drop("_quality")


def keep_good(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows that are kept, with the columns they had."""
    found = df.withColumn("_quality", verdict_column(df.sparkSession, model, text))
    return found.where("_quality.kept").drop("_quality")
