"""Shards of nearly equal bytes by a histogram sort.

Rows are ordered by a key, by their id and by their number in the stored table, and the
shards are stretches of that order. Where they end is found by counting: every round
counts the exact bytes and rows below candidate boundaries, a row of counts per bin and
task, and then lays finer boundaries inside those bins only in which a splitter still
lies. A splitter is done when a boundary is within the tolerance of its share of the
bytes, or when its bin is a single row and the nearer side is taken. With the splitters
known to the row, every row is exchanged once, and its slot follows from the counts.

The key is a hash of the text, so copies stand together and a boundary cuts a group of
copies only where no edge of the group is near enough. Such a group, however large, is
cut by ids, and rows with one id by their number: no bin is left whole because its rows
are alike. Shards are dealt in parts of bounded rows and bytes, as splitters of the same
search, so that a task holds a part and not a shard; the driver holds the splitters, one
per part, and the counts of one round, PROBES or a few per splitter.

All of it is column expressions, aggregations and one window.

Defined results: NULL text has no bytes, NULL ids come first. Ties go by the stored
number, repeated rows are rows of their own. With fewer rows than shards some shards are
empty; an empty table gives no rows. Any size of 0 or more will do, also 0 throughout:
then all rows may share a shard.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass, replace
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

# Candidate boundaries of a round, for all splitters together; two per splitter at least.
PROBES = 65_536
# How far a shard's end may be from its place, as a share of a shard's bytes.
TOLERANCE = 0.001
# The same for ends of parts inside a shard, as a share of a part's bytes.
PART_TOLERANCE = 0.25
# What one task exchanges at most, about.
PART_ROWS = 1_000_000
PART_BYTES = 512 << 20

_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1
_WORDS = ("word_0", "word_1", "word_2")


@dataclass(frozen=True)
class Splitter:
    """A boundary looked for: ``target`` bytes are to lie below it, give or take ``within``.

    Until ``boundary`` is found, it lies in ``bin`` of the word after ``prefix``, with
    ``bytes`` and ``rows`` below that bin; then these are what lies below the boundary.
    """

    target: float
    within: float
    prefix: tuple[int, ...] = ()
    bin: int | None = None
    bytes: int = 0
    rows: int = 0
    boundary: tuple[int, ...] | None = None


def _edge(prefix: tuple[int, ...], value: int) -> tuple[int, ...]:
    """The least key of all that begin with the prefix and go on with at least ``value``."""
    if value > _HIGHEST:
        return (*prefix, *[_HIGHEST] * (len(_WORDS) - len(prefix)))
    return (*prefix, value, *[_LOWEST] * (len(_WORDS) - len(prefix) - 1))


@dataclass(frozen=True)
class Bins:
    """Counted bins in order: their numbers, and the bytes and rows below each and below the end."""

    numbers: list[int]
    bytes: list[int]
    rows: list[int]

    @classmethod
    def of(cls, counted: list[tuple[int, int, int]]) -> Bins:
        numbers, sizes, rows = zip(*sorted(counted))
        return cls(list(numbers), [0, *accumulate(sizes)], [0, *accumulate(rows)])


def _refined(splitter: Splitter, bins: Bins, shift: int) -> Splitter:
    """The splitter after its bin was counted in finer ones."""
    sought = splitter.target - splitter.bytes
    # The first bin that ends at the target or beyond it.
    at = min(bisect_left(bins.bytes, sought, 1) - 1, len(bins.numbers) - 1)
    low, high = sought - bins.bytes[at], bins.bytes[at + 1] - sought
    number = bins.numbers[at]
    if min(low, high) <= splitter.within or bins.rows[at + 1] - bins.rows[at] == 1:
        upper = high < low
        return replace(
            splitter,
            boundary=_edge(splitter.prefix, (number + upper) << shift),
            bytes=splitter.bytes + bins.bytes[at + upper],
            rows=splitter.rows + bins.rows[at + upper],
        )
    found = replace(
        splitter, bin=number, bytes=splitter.bytes + bins.bytes[at], rows=splitter.rows + bins.rows[at]
    )
    return found if shift else replace(found, prefix=(*splitter.prefix, number), bin=None)


def _among(rows: DataFrame, depth: int, opened: list[Splitter], shift: int | None) -> DataFrame:
    """The rows of the bins in which open splitters lie; ``shift`` is that of their bins."""
    if depth == 0 and shift is None:
        return rows
    names = [*_WORDS[:depth], *(["bin"] if shift is not None else [])]
    keys = {(*s.prefix, *([s.bin] if shift is not None else [])) for s in opened}
    some = rows.sparkSession.createDataFrame(sorted(keys), ", ".join(f"{n} bigint" for n in names))
    if shift is not None:
        rows = rows.withColumn("bin", F.shiftright(_WORDS[depth], shift))
    # At most one row per splitter.
    return rows.join(F.broadcast(some), names, "left_semi")


def _counted(rows: DataFrame, depth: int, shift: int, parent: int | None) -> dict[tuple, Bins]:
    """The bins by the words before and, from the second round on, the bin they are part of."""
    prefix = _WORDS[:depth]
    counts = rows.groupBy(*prefix, F.shiftright(_WORDS[depth], shift).alias("bin")).agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows")
    )
    found = defaultdict(list)
    # At most PROBES rows, or two per splitter.
    for row in counts.collect():
        whole = None if parent is None else row["bin"] >> (parent - shift)
        found[tuple(row[n] for n in prefix), whole].append((row["bin"], row["bytes"], row["rows"]))
    return {place: Bins.of(counted) for place, counted in found.items()}


def splitters(rows: DataFrame, wanted: list[Splitter]) -> list[Splitter]:
    """Finds the boundaries. ``rows`` has ``size`` and the three words, no two rows alike in these."""
    done, opened = [], list(wanted)
    for depth, word in enumerate(_WORDS):
        if not opened:
            break
        inside = _among(rows, depth, opened, None)
        low, high = inside.agg(F.min(word), F.max(word)).first()
        if low is None:
            break
        parent = None
        while opened and (parent is None or parent > 0):
            places = len({(s.prefix, s.bin) for s in opened})
            bits = max(1, (PROBES // places).bit_length() - 1)
            if parent is None:
                # The widest bins that still tell PROBES values in this range apart.
                shift = 0
                while (high >> shift) - (low >> shift) >= 1 << bits:
                    shift += 1
            else:
                shift = max(0, parent - bits)
            bins = _counted(_among(rows, depth, opened, parent), depth, shift, parent)
            found = [_refined(s, bins[s.prefix, s.bin], shift) for s in opened]
            done += [s for s in found if s.boundary is not None]
            opened = [s for s in found if s.boundary is None]
            parent = shift
    return sorted(done, key=lambda s: s.target)


def _place(boundaries: list[tuple[int, ...]]) -> Column:
    """How many boundaries a row's words have reached, by halving steps."""
    fields = ", ".join(f"{n}: bigint" for n in _WORDS)
    text = json.dumps([dict(zip(_WORDS, b)) for b in boundaries])
    sorted_ones = F.from_json(F.lit(text), f"array<struct<{fields}>>")
    key = F.struct(*_WORDS)
    steps = [1 << k for k in reversed(range(len(boundaries).bit_length()))]

    def further(at: Column, step: Column) -> Column:
        reached = F.get(sorted_ones, at + step - 1) <= key
        return F.when(reached, at + step).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further) if boundaries else F.lit(0)


def sharded(
    documents: DataFrame,
    shards: int,
    size: Column,
    key: Column,
    id_column: str,
    keep: Mapping[str, Column] | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """What is kept of every row (the row as ``document`` if nothing is named), with size, shard and slot.

    ``key`` is a bigint, equal for rows that should stay together; ``size`` an integer.
    Slots are the places in a shard, gapless from 0, in order of key and id.
    """
    keep = dict(keep or {"document": F.struct(*documents.columns)})
    kind = dict(documents.dtypes)[id_column]
    number = F.col(id_column).cast("bigint") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(id_column)
    # Written first: texts are read once, and a row keeps its number.
    rows = stored(
        documents.select(
            size.cast("bigint").alias("size"),
            key.alias(_WORDS[0]),
            F.coalesce(number, F.lit(_LOWEST)).alias(_WORDS[1]),
            F.monotonically_increasing_id().alias(_WORDS[2]),
            *[value.alias(f"kept_{name}") for name, value in keep.items()],
        ),
        "rows",
    )
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = max(1, -(-count // (shards * PART_ROWS)), -(-total // (shards * PART_BYTES)))
    wanted = []
    for i in range(1, shards * parts):
        share = tolerance * total / shards if i % parts == 0 else PART_TOLERANCE * total / (shards * parts)
        wanted.append(Splitter(total * i / (shards * parts), share))
    found = splitters(rows, wanted)
    placed = rows.withColumn("part", _place([s.boundary for s in found]))
    # Rows below each part within its shard.
    below = [0, *(s.rows for s in found)]
    before = F.from_json(
        F.lit(json.dumps([n - below[i - i % parts] for i, n in enumerate(below)])), "array<bigint>"
    )
    within = F.row_number().over(Window.partitionBy("part").orderBy(*_WORDS)) - 1
    return placed.select(
        *[F.col(f"kept_{name}").alias(name) for name in keep],
        "size",
        F.floor(F.col("part") / parts).cast("int").alias("shard"),
        (F.get(before, F.col("part")) + within).alias("slot"),
    )


def write(placed: DataFrame, path: str) -> None:
    """A folder per shard; a part is written by one task, in order of its slots."""
    placed.write.partitionBy("shard").parquet(path)
