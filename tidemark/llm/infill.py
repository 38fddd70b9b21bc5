"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as independent zstandard frames of FRAME_UNITS code points, with the
cumulative number of units before each. A stretch of it is found by bisection in these
counts: frames that lie wholly inside pass on as they are, and only the frames in which
a cut falls are decompressed and cut. So a text is rearranged by moving compressed
frames. Digests stream the frames in order; nothing holds a whole text but the cell it
arrives in.

A text becomes prefix, middle and suffix between two cuts, in one of two orders with a
mark before each part, or stays plain. Both cuts and the order come from a hash of the
row's id, so that a repeated task, or another cluster, makes the same choice.

Defined results: NULL text is the empty text, which stays plain, like any text with one
of the marks in it. Rows without an id hash as the empty id. Rows of one id are cut alike
if their texts are equally long; repeated rows are rows of their own. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, stored

FRAME_UNITS = 4096
LEVEL = 3
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
# The marks of a form in their order.
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PLAIN = "plain"
# Of a hundred texts so many are transformed, and so many of these put the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20


@dataclass(frozen=True)
class Frames:
    """A text: ``ends`` are the units up to the end of each frame."""

    ends: list[int]
    data: list[bytes]

    @property
    def units(self) -> int:
        return self.ends[-1] if self.ends else 0

    @classmethod
    def of(cls, text: str) -> Frames:
        starts = range(0, len(text), FRAME_UNITS)
        data = [_packed(text[i : i + FRAME_UNITS]) for i in starts]
        return cls([min(i + FRAME_UNITS, len(text)) for i in starts], data)

    def begin(self, frame: int) -> int:
        return self.ends[frame - 1] if frame else 0

    def within(self, start: int, end: int) -> Iterator[tuple[int, int, int]]:
        """The frames that units start to end lie in, and from where to where in each."""
        frame = bisect_right(self.ends, start)
        while start < end:
            first, last = self.begin(frame), min(self.ends[frame], end)
            yield frame, start - first, last - first
            start, frame = last, frame + 1

    def whole(self, frame: int, start: int, end: int) -> bool:
        return start == 0 and end == self.ends[frame] - self.begin(frame)

    def part(self, start: int, end: int) -> Frames:
        """Frames of units start to end; only those with a cut in them are packed anew."""
        ends, data, units = [], [], 0
        for frame, a, b in self.within(start, end):
            units += b - a
            ends.append(units)
            data.append(self.data[frame] if self.whole(frame, a, b) else _packed(_text(self.data[frame])[a:b]))
        return Frames(ends, data)

    def stream(self, start: int = 0, end: int | None = None) -> Iterator[bytes]:
        """The bytes of units start to end, a frame at a time."""
        for frame, a, b in self.within(start, self.units if end is None else end):
            content = _unpacked(self.data[frame])
            yield content if self.whole(frame, a, b) else content.decode()[a:b].encode()

    def find(self, mark: str, start: int) -> int:
        """The unit at which the mark next begins, also where it lies across frames."""
        carried, done = "", start
        for piece in self.stream(start):
            text = carried + piece.decode()
            at = text.find(mark)
            if at >= 0:
                return done + at
            carried = text[1 - len(mark) :]
            done += len(text) - len(carried)
        raise ValueError(f"no {mark} from unit {start} on")


_PACKER = zstandard.ZstdCompressor(level=LEVEL)
_UNPACKER = zstandard.ZstdDecompressor()


def _packed(text: str) -> bytes:
    return _PACKER.compress(text.encode())


def _unpacked(frame: bytes) -> bytes:
    return _UNPACKER.decompress(frame)


def _text(frame: bytes) -> str:
    return _unpacked(frame).decode()


def joined(parts: list[Frames]) -> Frames:
    """Texts one after the other."""
    ends, data, before = [], [], 0
    for part in parts:
        ends += [before + end for end in part.ends]
        data += part.data
        before += part.units
    return Frames(ends, data)


def arranged(text: Frames, form: str, first: int | None, second: int | None) -> Frames:
    """The text with its parts in the order of the form, each behind its mark."""
    if form == PLAIN:
        return text
    parts = {PREFIX: (0, first), MIDDLE: (first, second), SUFFIX: (second, text.units)}
    return joined([f for mark in ORDER[form] for f in (Frames.of(mark), text.part(*parts[mark]))])


def restored(output: Frames, form: str) -> Iterator[bytes]:
    """The bytes of the text that was arranged, from nothing but the output and its form."""
    if form == PLAIN:
        yield from output.stream()
        return
    at, starts, places = 0, [], []
    for mark in ORDER[form]:
        at = output.find(mark, at)
        places.append(at)
        at += len(mark)
        starts.append(at)
    parts = dict(zip(ORDER[form], zip(starts, [*places[1:], output.units])))
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from output.stream(*parts[mark])


def sha256(pieces: Iterator[bytes]) -> str:
    state = hashlib.sha256()
    for piece in pieces:
        state.update(piece)
    return state.hexdigest()


_FRAMES = {"ends": pa.list_(pa.int64()), "frames": pa.list_(pa.binary())}


def _framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            texts = part.column("text").fill_null("")
            marked = pc.match_substring_regex(texts, "|".join(MARKS))
            found = [Frames.of(text.as_py()) for text in texts]
            columns = [
                part.column("doc_id"),
                pa.array([f.units for f in found], pa.int64()),
                marked,
                pa.array([f.ends for f in found], _FRAMES["ends"]),
                pa.array([f.data for f in found], _FRAMES["frames"]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "marked", *_FRAMES])


def store(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The texts as frames, in the shared folder: doc_id, n, marked, ends, frames."""
    texts = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = dict(texts.dtypes)["doc_id"]
    framed = texts.mapInArrow(
        _framed, f"doc_id {kind}, n bigint, marked boolean, ends array<bigint>, frames array<binary>"
    )
    # The frames are compressed as they are.
    return stored(framed, "frames", "uncompressed")


def chosen(frames: DataFrame, seed: int = 1) -> DataFrame:
    """Adds form, prefix_chars and middle_chars, the latter NULL for plain texts."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    first, second, plain, order = (
        F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)
    )
    form = (
        F.when((F.col("n") == 0) | F.col("marked") | (plain % 100 >= TRANSFORMED), PLAIN)
        .when(order % 100 < SUFFIX_FIRST, "spm")
        .otherwise("psm")
    )
    a, b = first % (F.col("n") + 1), second % (F.col("n") + 1)
    cut = F.col("form") != PLAIN
    return (
        frames.withColumn("form", form)
        .withColumn("prefix_chars", F.when(cut, F.least(a, b)))
        .withColumn("middle_chars", F.when(cut, F.abs(a - b)))
    )


_COLUMNS = ("doc_id", "n", "form", "prefix_chars", "middle_chars")


def _outputs(batch: pa.RecordBatch) -> Iterator[tuple[Frames, str]]:
    for row in zip(*(batch.column(c) for c in ("ends", "frames", "form", "prefix_chars", "middle_chars"))):
        ends, frames, form, prefix, middle = (value.as_py() for value in row)
        second = None if prefix is None else prefix + middle
        yield arranged(Frames(ends, frames), form, prefix, second), form


def _arranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [output for output, _ in _outputs(batch)]
        columns = [batch.column(name) for name in _COLUMNS]
        columns.append(pa.array([f.ends for f in found], _FRAMES["ends"]))
        columns.append(pa.array([f.data for f in found], _FRAMES["frames"]))
        yield pa.RecordBatch.from_arrays(columns, names=[*_COLUMNS, *_FRAMES])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(sha256(o.stream()), sha256(restored(o, form))) for o, form in _outputs(batch)]
        columns = [batch.column(name) for name in _COLUMNS]
        columns += [pa.array([pair[i] for pair in found], pa.string()) for i in range(2)]
        yield pa.RecordBatch.from_arrays(columns, names=[*_COLUMNS, "output_sha256", "restored_sha256"])


def _schema(frames: DataFrame, added: str) -> str:
    kind = dict(frames.dtypes)["doc_id"]
    return f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, {added}"


def transform(frames: DataFrame, seed: int = 1) -> DataFrame:
    """Stored texts in their form, as frames again: doc_id, n, form, prefix_chars,
    middle_chars, ends, frames."""
    made = _schema(frames, "ends array<bigint>, frames array<binary>")
    return chosen(frames, seed).mapInArrow(_arranged, made)


def digests(frames: DataFrame, seed: int = 1) -> DataFrame:
    """Of stored texts in their form: doc_id, n, form, prefix_chars, middle_chars,
    output_sha256, and restored_sha256 of the text rebuilt from that output."""
    made = _schema(frames, "output_sha256 string, restored_sha256 string")
    return chosen(frames, seed).mapInArrow(_digested, made)


def texts(frames: DataFrame, name: str = "text") -> DataFrame:
    """Frames decompressed into one column, for readers that take whole texts."""
    others = [c for c in frames.columns if c not in _FRAMES]

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = ["".join(_text(f) for f in row.as_py()) for row in batch.column("frames")]
            columns = [batch.column(c) for c in others]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(whole, pa.string())], names=[*others, name])

    schema = ", ".join(f"{c} {kind}" for c, kind in frames.dtypes if c in others)
    return frames.mapInArrow(unpacked, f"{schema}, {name} string")
