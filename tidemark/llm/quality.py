"""Text quality by a generalised additive model with pairwise interactions.

Each text becomes a few numbers, each number a bin. Boosting goes round the features,
one shallow tree on one feature at a time, and adds each tree to that feature's lookup
table; then the pairs with the strongest interaction get tables of their own the same
way. A text's score is the sum of the table entries of its bins.

The model is fitted on the driver, on at most ``sample`` labelled rows (chosen by the
hash of their ids, alike at every size); texts are scored where they are.

Defined results: NULL text is the empty text, whose numbers are zero, and has a score
like any other. Labels that are NULL, without an id, or contradict each other for an id
are not learned from; a repeated label counts once. Of an id with several texts the one
with the smallest hash is learned from, whatever the order of the rows. Without labels of both kinds every
score is the share of label 1 (0.5 without any). An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, text_column, unused

SAMPLE = 40_000
BINS = 32
PAIR_BINS = 12
PAIRS = 8
ROUNDS = 150
PAIR_ROUNDS = 60
RATE = 0.15
# Weight that pulls leaves with few rows to zero.
PULL = 2.0
THRESHOLD = 0.3

FEATURES = (
    "log_chars", "log_words", "word_length", "words_a_line", "words_a_sentence", "upper", "digits", "spaces",
    "stops", "exclaimed", "marks", "bars", "other_ascii", "not_ascii", "distinct_words", "repeated_words",
    "common_word", "short_words", "distinct_lines", "common_line", "title_words",
)
_UPPER, _DIGITS, _STOPS = bytes(range(65, 91)), b"0123456789", b".,;:?'\"()-"
_SPACES, _MARKS = b" \t\n\r\x0b\x0c", b"#$%&*@^~=+<>{}[]\\/_`"
_LETTERS = bytes(range(97, 123)) + _UPPER
_OTHER = bytes(set(range(128)) - set(_LETTERS + _DIGITS + _STOPS + _SPACES + _MARKS + b"!|"))


def features(text: str) -> list[float]:
    """The numbers of one text, in the order of FEATURES."""
    data = text.encode("utf-8", "surrogatepass")
    size = len(data) or 1
    share = lambda characters: (len(data) - len(data.translate(None, characters))) / size
    words = text.split()
    count = len(words) or 1
    counted = Counter(words)
    lines = [line for line in text.split("\n") if line]
    line_counts = Counter(lines)
    per_line = len(lines) or 1
    return [
        float(np.log1p(len(text))),
        float(np.log1p(len(words))),
        sum(map(len, words)) / count,
        len(words) / per_line,
        len(words) / (1 + text.count(". ") + text.count(".\n")),
        share(_UPPER),
        share(_DIGITS),
        share(_SPACES),
        share(_STOPS),
        data.count(b"!") / size,
        share(_MARKS),
        data.count(b"|") / size,
        share(_OTHER),
        1 - len(data.translate(None, bytes(range(128, 256)))) / size if data else 0.0,
        len(counted) / count if words else 0.0,
        sum(map(eq, words, words[1:])) / count,
        max(counted.values(), default=0) / count,
        sum(n for word, n in counted.items() if len(word) <= 3) / count,
        len(line_counts) / per_line if lines else 0.0,
        max(line_counts.values(), default=0) / per_line,
        sum(n for word, n in counted.items() if word[:1].isupper()) / count,
    ]


@dataclass(frozen=True)
class QualityModel:
    """Cuts of each feature into bins, a table for each feature, and tables of pairs."""

    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def scores(self, numbers: np.ndarray) -> np.ndarray:
        """Scores between 0 and 1 of rows of features."""
        total = np.full(len(numbers), self.base)
        bins = [np.searchsorted(c, numbers[:, i], side="right") for i, c in enumerate(self.cuts)]
        for own, table in zip(bins, self.tables):
            total += table[own]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[self.coarse[a][bins[a]], self.coarse[b][bins[b]]]
        return 1 / (1 + np.exp(-total))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    marks = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))
    # Between neighbouring values, so that a value and its bin do not hang on rounding.
    known = np.unique(values)
    above = known[np.minimum(np.searchsorted(known, marks, side="right"), len(known) - 1)]
    return np.unique((marks + above) / 2)


def _gain(residual: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return residual**2 / (weight + PULL)


def _shallow_tree(residual: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Values of the bins by a tree of three leaves over bins in order."""

    def best_cut(low: int, high: int) -> tuple[float, int]:
        r, w = np.cumsum(residual[low:high]), np.cumsum(weight[low:high])
        gains = _gain(r[:-1], w[:-1]) + _gain(r[-1] - r[:-1], w[-1] - w[:-1]) - _gain(r[-1], w[-1])
        at = int(np.argmax(gains)) if len(gains) else 0
        return (float(gains[at]), low + at + 1) if len(gains) else (-1.0, low)

    edges = [0, len(residual)]
    for _ in range(2):
        found = [best_cut(low, high) for low, high in zip(edges, edges[1:])]
        gain, cut = max(found)
        if gain <= 0:
            break
        edges = sorted({*edges, cut})
    values = np.zeros(len(residual))
    for low, high in zip(edges, edges[1:]):
        values[low:high] = residual[low:high].sum() / (weight[low:high].sum() + PULL)
    return values


def _quadrants(residual: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The cross cut of a table of bins with the highest gain, and the values of its four leaves."""
    r, w = residual.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    parts = []
    for table in (r, w):
        corner = table[:-1, :-1]
        right, below, whole = table[:-1, -1:] - corner, table[-1:, :-1] - corner, table[-1, -1]
        parts.append((corner, right, below, whole - corner - right - below))
    gains = sum(_gain(a, b) for a, b in zip(*parts))
    if not gains.size:
        return 0.0, np.zeros_like(residual)
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    values = np.zeros_like(residual)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for columns in (slice(0, j + 1), slice(j + 1, None)):
            values[rows, columns] = residual[rows, columns].sum() / (weight[rows, columns].sum() + PULL)
    return float(gains[i, j] - _gain(residual.sum(), weight.sum())), values


def fit_tables(numbers: np.ndarray, labels: np.ndarray) -> QualityModel:
    """Boosts the tables on rows of features and their labels (0 or 1)."""
    count = numbers.shape[1] if numbers.ndim == 2 else len(FEATURES)
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        share = min(1 - 1e-6, max(1e-6, share))
        empty = [np.zeros(1)] * count
        return QualityModel(float(np.log(share / (1 - share))), [np.zeros(0)] * count, empty, [np.zeros(1, int)] * count, [], [])
    cuts = [_cuts(numbers[:, i], BINS) for i in range(count)]
    bins = [np.searchsorted(c, numbers[:, i], side="right") for i, c in enumerate(cuts)]
    sizes = [len(c) + 1 for c in cuts]
    tables = [np.zeros(n) for n in sizes]
    base = float(np.log(share / (1 - share)))
    total = np.full(len(labels), base)
    for _ in range(ROUNDS):
        for i, own in enumerate(bins):
            p = 1 / (1 + np.exp(-total))
            residual = np.bincount(own, labels - p, sizes[i])
            weight = np.bincount(own, p * (1 - p), sizes[i])
            step = RATE * _shallow_tree(residual, weight)
            tables[i] += step
            total += step[own]
    coarse = [(np.arange(n) * min(n, PAIR_BINS)) // n for n in sizes]
    wide = [c[b] for c, b in zip(coarse, bins)]
    shapes = [int(c[-1]) + 1 for c in coarse]

    def sums(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        cell, size = wide[a] * shapes[b] + wide[b], shapes[a] * shapes[b]
        shape = (shapes[a], shapes[b])
        return (
            np.bincount(cell, labels - p, size).reshape(shape),
            np.bincount(cell, p * (1 - p), size).reshape(shape),
        )

    ranked = sorted(combinations(range(count), 2), key=lambda ab: -_quadrants(*sums(*ab))[0])
    pairs = ranked[:PAIRS]
    pair_tables = [np.zeros((shapes[a], shapes[b])) for a, b in pairs]
    for _ in range(PAIR_ROUNDS):
        for table, (a, b) in zip(pair_tables, pairs):
            step = RATE * _quadrants(*sums(a, b))[1]
            table += step
            total += step[wide[a], wide[b]]
    return QualityModel(base, cuts, tables, coarse, pairs, pair_tables)


def held_out(id_column: str | Column, folds: int = 5) -> Column:
    """Whether an id's checksum puts it in the part that is never learned from."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> QualityModel:
    """Learns ``label`` (0 or 1, by doc_id) from documents that are not held out."""
    known = (
        labels.select("doc_id", F.col(label).alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("highest"))
        .where("label = highest")
        .select("doc_id", "label")
    )
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    rows = known.count()
    if rows > sample:
        # A little more than asked for, then exactly as many.
        known = known.where(place < int(1.1 * sample / rows * (1 << 20)) + 16)
    known = known.orderBy(place, "doc_id").limit(sample)
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("hash")).join(F.broadcast(known), "doc_id")
    numbers = texts.mapInArrow(_numbers, "doc_id bigint, label int, hash bigint, numbers array<double>")
    # Of an id with several texts the one with the smallest hash is learned from, so that
    # the model does not depend on the order of the rows.
    smallest = F.min(F.struct("hash", "numbers", "label")).alias("one")
    # At most ``sample`` rows of a few numbers.
    found = numbers.groupBy("doc_id").agg(smallest).select("doc_id", "one.*").orderBy("doc_id").toPandas()
    if found.empty:
        return fit_tables(np.zeros((0, len(FEATURES))), np.zeros(0))
    return fit_tables(np.stack(found["numbers"].to_numpy()), found["label"].to_numpy(dtype=np.float64))


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in (p for batch in batches for p in slices(batch, "text")):
        numbers = pa.array([features(t) for t in text_column(part, "text").to_pylist()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id").cast(pa.int64()), part.column("label").cast(pa.int32()), part.column("hash"), numbers],
            names=["doc_id", "label", "hash", "numbers"],
        )


def score(documents: DataFrame, model: QualityModel, columns: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """These columns of the documents, and the score of each text."""
    kept = [c for c in columns if c != name]
    own = unused(kept, "_text")
    rows = documents.select(*kept, F.col(text).alias(own))
    schema = rows.select(*kept).schema.add(name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, own)):
            numbers = [features(t) for t in text_column(part, own).to_pylist()]
            found = model.scores(np.array(numbers).reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(found, pa.float64())], names=[*kept, name]
            )

    return rows.mapInArrow(run, schema)
