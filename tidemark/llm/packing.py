"""Documents packed into token sequences of one size by fitted length patterns.

The histogram of lengths decides everything: it has at most ``capacity`` bins, however
many documents there are. Patterns of a few length classes that fill a sequence are
fitted to it by non-negative least squares; the rounded repeat counts become sequences,
and what is left is packed by best fit, largest first, into the gaps and new sequences.
The driver holds the histogram and the plan of (length, how many) groups only; tasks
then look up the place of each piece by its rank among the pieces of its length.

Defined results: NULL text is the empty text, so a document of the end id alone. Rows
are independent: equal or NULL ids, equal texts and other columns change nothing. Texts
of any length are cut into pieces of ``capacity`` ids, the last one shorter. An empty
table gives no pieces and no sequences.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import crc32, id_kind, slices, stored, text_column
from tidemark.llm.tokens import default_vocabulary, encoder

# Length classes the patterns are made of, and the most documents of a pattern.
CLASSES = 64
PATTERN_DOCUMENTS = 4

_PIECES = (
    "doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint, "
    "task int, place bigint, ids binary"
)


def non_negative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |a x - b|, by an active set of columns."""
    columns = a.shape[1]
    x, free = np.zeros(columns), np.zeros(columns, dtype=bool)
    slope = a.T @ b
    tolerance = 1e-9 * max(1.0, float(np.abs(slope).max(initial=0)))
    for _ in range(3 * columns):
        if free.all() or slope[~free].max() <= tolerance:
            break
        free[np.argmax(np.where(free, -np.inf, slope))] = True
        while True:
            step = np.zeros(columns)
            step[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if step[free].min() > 0:
                break
            bad = free & (step <= 0)
            part = np.min(x[bad] / np.maximum(x[bad] - step[bad], 1e-300))
            x += part * (step - x)
            free &= x > 1e-12
            x[~free] = 0
            if not free.any():
                return x
        x = step
        slope = a.T @ (b - a @ x)
    return x


def class_patterns(classes: int = CLASSES, most: int = PATTERN_DOCUMENTS) -> list[tuple[int, ...]]:
    """All ways to fill ``classes`` with up to ``most`` length classes, largest first."""
    found = [(classes,)]
    for n in range(1, most):
        for rest in combinations_with_replacement(range(1, classes), n):
            last = classes - sum(rest)
            if last >= rest[-1]:
                found.append((last, *rest[::-1]))
    return found


@dataclass(frozen=True)
class Plan:
    """Where the pieces of each length go: sorted by length, then rank.

    The piece of rank r (from ``rank``) is number (r - rank) of its segment: sequence
    ``sequence + number // times``, offset ``offset + number % times * length``.
    """

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    times: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = (self.length << 40) + self.rank
        at = np.searchsorted(keys, (length.astype(np.int64) << 40) + rank, side="right") - 1
        number = rank - self.rank[at]
        sequence = self.sequence[at] + number // self.times[at]
        return sequence, self.offset[at] + number % self.times[at] * length


def _from_patterns(left: np.ndarray, capacity: int) -> list[tuple[Counter, int]]:
    """Sequences after the fitted patterns; their pieces are taken out of ``left``."""
    width = -(-capacity // CLASSES)
    classes = -(-capacity // width)
    of_class = -(-np.arange(capacity) // width)
    histogram = np.bincount(of_class[1:], weights=left[1:], minlength=classes + 1)[1:]
    patterns = class_patterns(classes)
    a = np.zeros((classes, len(patterns)))
    for column, pattern in enumerate(patterns):
        for k in pattern:
            a[k - 1, column] += 1
    repeats = np.floor(non_negative_least_squares(a, histogram) + 1e-6).astype(np.int64)
    made = []
    for column in np.flatnonzero(repeats):
        *most, last = patterns[column]
        wanted = repeats[column]
        while wanted > 0:
            taken: Counter = Counter()
            for k in most:
                low, high = (k - 1) * width + 1, min(k * width, capacity - 1)
                there = [n for n in range(high, low - 1, -1) if left[n] > taken[n]]
                if there:
                    taken[there[0]] += 1
            room = capacity - sum(n * t for n, t in taken.items())
            # The last one is the longest that fits, which closes the gap of the classes.
            fits = np.flatnonzero(left[: min(room, capacity - 1) + 1])
            fits = [n for n in fits[::-1][:PATTERN_DOCUMENTS] if left[n] > taken[n]]
            if sum(taken.values()) < len(most) or not fits or fits[0] <= (last - 1) * width:
                break
            taken[int(fits[0])] += 1
            times = min(wanted, *(left[n] // t for n, t in taken.items()))
            for n, t in taken.items():
                left[n] -= t * times
            made.append((taken, int(times)))
            wanted -= times
    return made


def _best_fit(left: np.ndarray, capacity: int, made: list[tuple[Counter, int]]) -> list[tuple[Counter, int]]:
    """The rest into the gaps of ``made`` and new sequences, largest first, many at a time."""
    gaps: dict[int, list[list]] = defaultdict(list)
    open_gaps = np.zeros(capacity + 1, dtype=np.int64)

    def put(content: Counter, times: int) -> None:
        gap = capacity - sum(n * t for n, t in content.items())
        gaps[gap].append([content, times])
        open_gaps[gap] += times

    for content, times in made:
        put(content, times)
    for length in np.flatnonzero(left)[::-1].tolist():
        count = int(left[length])
        while count:
            fitting = np.flatnonzero(open_gaps[length:])
            gap = length + int(fitting[0]) if len(fitting) else capacity
            each = gap // length
            if len(fitting):
                content, times = gaps[gap].pop()
                open_gaps[gap] -= times
            else:
                content, times = Counter(), -(-count // each)
            used = min(times, count // each) if count >= each else 1
            inside = each if count >= each else count
            if times > used and len(fitting):
                put(content, times - used)
            put(content + Counter({length: inside}), used)
            count -= used * inside
    return [(content, times) for groups in gaps.values() for content, times in groups]


def plan(lengths: dict[int, int], capacity: int) -> Plan:
    """Sequences for so many pieces of each length from 1 to ``capacity``."""
    left = np.zeros(capacity, dtype=np.int64)
    for length, count in lengths.items():
        if length < capacity:
            left[length] = count
    made = _from_patterns(left, capacity) if left.any() else []
    made = _best_fit(left, capacity, made)
    if lengths.get(capacity):
        made.append((Counter({capacity: 1}), lengths[capacity]))
    segments, ranks, sequence = [], Counter(), 0
    for content, times in made:
        offset = 0
        for length, inside in sorted(content.items(), reverse=True):
            segments.append((length, ranks[length], sequence, offset, inside))
            ranks[length] += inside * times
            offset += length * inside
        sequence += times
    columns = np.array(sorted(segments), dtype=np.int64).reshape(-1, 5).T
    return Plan(*columns, sequences=sequence)


def _pieces_of(vocabulary: str, end_id: int, capacity: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(vocabulary), np.zeros(capacity + 1, dtype=np.int64)
        kind, task = id_kind(max(encode.size, end_id + 1)), TaskContext.get().partitionId()
        for batch in batches:
            for part in slices(batch, names[1]):
                flat, ends = encode.encode(text_column(part, names[1]))
                rows: list[tuple] = []
                keys = part.column(names[0]).to_pylist()
                for key, start, end in zip(keys, ends.tolist(), ends[1:].tolist()):
                    ids = np.append(flat[start:end], np.uint32(end_id))
                    for number, at in enumerate(range(0, len(ids), capacity)):
                        piece = ids[at : at + capacity]
                        place = int(seen[len(piece)])
                        seen[len(piece)] += 1
                        rows.append(
                            (key, number, at, len(piece), crc32(piece), task, place, piece.astype(kind).tobytes())
                        )
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)]
                yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

    return run


_NAMES = [part.split()[0] for part in _PIECES.split(", ")]
_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]


@dataclass(frozen=True)
class Packing:
    """The pieces with their ids, the place of each piece, and the number of sequences."""

    pieces: DataFrame
    placements: DataFrame
    sequences: int
    kind: str

    def tokens(self) -> DataFrame:
        """One row a sequence: its ids, and the documents with their offsets."""
        kind = self.kind

        def ids(packed):
            return packed.map(lambda p: np.frombuffer(p, kind).astype(np.int64).tolist())

        key = ["task", "length", "place"]
        ids_of = F.pandas_udf(ids, "array<bigint>")
        placed = self.placements.join(self.pieces.select(*key, ids_of("ids").alias("ids")), key)
        parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
        return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
            "sequence_id",
            F.flatten("parts.ids").alias("ids"),
            F.transform("parts", lambda p: p.dropFields("ids")).alias("documents"),
        )


def pack(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column_name: str = "text",
    vocabulary: str | None = None,
    end_id: int = 1,
    capacity: int = 4096,
) -> Packing:
    """Cuts, encodes and packs all documents; see the module for the defined cases."""
    vocabulary = vocabulary or default_vocabulary()
    names = ["doc_id", "text"]
    texts = documents.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column_name).alias("text")
    )
    cut = texts.mapInArrow(_pieces_of(vocabulary, end_id, capacity, names), _PIECES)
    pieces = stored(cut, "pieces", codec="zstd")
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("count"))
    # At most ``capacity`` rows.
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    fitted = plan(histogram, capacity)
    before = F.sum("count").over(Window.partitionBy("length").orderBy("task")) - F.col("count")
    ranks = per_task.select("length", "task", before.alias("before"))
    columns = [n for n in _NAMES if n != "ids"]
    ranked = pieces.select(*columns).join(ranks, ["length", "task"])

    def placed(batches):
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            rank = batch.column("place").to_numpy() + batch.column("before").to_numpy()
            sequence, offset = fitted.place(length, rank)
            kept = [batch.column(n) for n in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*columns, "sequence_id", "offset"],
            )

    schema = _PIECES.removesuffix(", ids binary") + ", sequence_id bigint, offset bigint"
    placements = ranked.mapInArrow(placed, schema)
    return Packing(pieces, placements, fitted.sequences, id_kind(max(encoder(vocabulary).size, end_id + 1)))
