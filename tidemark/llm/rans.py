"""Token ids as a compressed table, by a static range asymmetric numeral system.

One frequency table, counted over all documents, serves every block. A block holds up
to BLOCK consecutive ids and stands alone: LANES interleaved states, the words they gave
off, a checksum, and checkpoints (all states and the place in the words, every
CHECKPOINT steps), so that blocks, and parts of a block, are decoded independently of
each other.

The file format is a folder with two Parquet tables, so it lies on any store Spark can
reach: ``model`` (token, freq; the frequencies add up to 2**SCALE_BITS) and ``blocks``
(part, block, n, states, checkpoints, words, crc32, and the documents in it: doc_ids,
first, lengths, offset). Parts follow each other in ascending order of document ids, and
blocks within a part; ``first`` numbers the documents of a part, ``offset`` is how many
ids of the first document are in earlier blocks.

Defined results: NULL text is the empty text, of the end id alone. NULL document ids
come first. Equal ids are ordered by a hash of their ids, then the ids. Documents of any
length run on over several blocks. An empty table gives empty tables.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import crc32, id_kind, slices, stored, sums_before, text_column
from tidemark.llm.tokens import default_vocabulary, encoder
from tidemark.session import working_folder

BLOCK = 1 << 16
LANES = 256
CHECKPOINT = 64
SCALE_BITS = 18
# Ids of a part: what one task puts in order and encodes.
PART = 4_000_000
# Blocks that are encoded or decoded side by side.
SIDE_BY_SIDE = 16

_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_SCALE = np.uint64(SCALE_BITS)
_SLOTS = np.uint64((1 << SCALE_BITS) - 1)


class Model:
    """Frequencies of tokens, their running sums, and the token of each slot."""

    def __init__(self, tokens: np.ndarray, freq: np.ndarray):
        size = int(tokens.max()) + 1 if len(tokens) else 1
        self.freq = np.zeros(size, np.uint64)
        self.freq[tokens] = freq
        self.start = np.cumsum(self.freq) - self.freq
        self.token_of = np.repeat(np.arange(size, dtype=np.uint32), self.freq.astype(np.int64))

    @staticmethod
    def frequencies(counts: np.ndarray) -> np.ndarray:
        """Positive frequencies in proportion to positive counts that add up to the scale."""
        total = 1 << SCALE_BITS
        if len(counts) > total // 2:
            raise ValueError(f"{len(counts)} different tokens do not fit {SCALE_BITS} bits")
        # One slot for every token, the others in proportion.
        freq = 1 + np.floor(counts * ((total - len(counts)) / counts.sum())).astype(np.int64)
        freq[np.argmax(freq)] += total - int(freq.sum())
        return freq


def encode(ids: np.ndarray, model: Model) -> list[tuple[bytes, bytes, bytes]]:
    """States, checkpoints and words of blocks of the same size, one a row of ``ids``."""
    blocks, n = ids.shape
    steps = -(-n // LANES)
    padded = np.zeros((blocks, steps * LANES), np.int64)
    padded[:, :n] = ids
    grid = padded.reshape(blocks, steps, LANES)
    state = np.full((blocks, LANES), _LOW, np.uint64)
    given: list[tuple[np.ndarray, np.ndarray]] = []
    marks = []
    for step in range(steps - 1, -1, -1):
        lanes = min(LANES, n - step * LANES)
        token = grid[:, step, :lanes]
        freq, own = model.freq[token], state[:, :lanes]
        over = own >= (freq << np.uint64(31 - SCALE_BITS + 32))
        given.append((over.sum(axis=1), own[over].astype(np.uint32)))
        own = np.where(over, own >> _WORD, own)
        whole = own // freq
        state[:, :lanes] = (whole << _SCALE) + (own - whole * freq) + model.start[token]
        if step and step % CHECKPOINT == 0:
            marks.append((step, state.copy()))
    given.reverse()
    counts = np.array([c for c, _ in given]).reshape(steps, blocks)
    # The words of a step lie block by block; those of a block are put together, in order of steps.
    owner = np.repeat(np.tile(np.arange(blocks, dtype=np.uint16), steps), counts.ravel())
    sorted_words = np.concatenate([w for _, w in given])[np.argsort(owner, kind="stable")]
    words = np.split(sorted_words, np.cumsum(counts.sum(axis=0))[:-1])
    used = np.concatenate((np.zeros((1, blocks), np.int64), np.cumsum(counts, axis=0)))
    found = []
    for block in range(blocks):
        # Fixed-size entries: the place in the words, then the states.
        saved = b"".join(
            np.uint64(used[step, block]).tobytes() + states[block].tobytes()
            for step, states in reversed(marks)
        )
        found.append((state[block].tobytes(), saved, words[block].tobytes()))
    return found


def decode(
    model: Model, n: int, states: list[bytes], words: list[bytes], first_step: int = 0, steps: int | None = None
) -> np.ndarray:
    """Ids of blocks of the same size; ``states`` and ``words`` are those at ``first_step``."""
    blocks = len(states)
    last = -(-n // LANES)
    end = last if steps is None else min(last, first_step + steps)
    state = np.frombuffer(b"".join(states), np.uint64).reshape(blocks, LANES).copy()
    stream = np.frombuffer(b"".join(words), np.uint32)
    place = np.cumsum([0, *(len(w) // 4 for w in words)])[:-1].astype(np.int64)
    out = np.zeros((blocks, max(0, end - first_step) * LANES), np.uint32)
    for step in range(first_step, end):
        lanes = min(LANES, n - step * LANES)
        own = state[:, :lanes]
        slot = own & _SLOTS
        token = model.token_of[slot]
        own = model.freq[token] * (own >> _SCALE) + slot - model.start[token]
        under = own < _LOW
        number = np.cumsum(under, axis=1)
        at = (place[:, None] + number - 1)[under]
        own[under] = (own[under] << _WORD) | stream[at]
        place += number[:, -1]
        state[:, :lanes] = own
        out[:, (step - first_step) * LANES : (step - first_step) * LANES + lanes] = token
    return out[:, : min(n, end * LANES) - first_step * LANES]


def decode_range(model: Model, n: int, states: bytes, checkpoints: bytes, words: bytes, start: int, end: int) -> np.ndarray:
    """The ids from ``start`` to ``end`` of one block, from the checkpoint before them."""
    step = start // LANES
    number = min(step // CHECKPOINT, len(checkpoints) // (8 + 8 * LANES))
    if number:
        entry = checkpoints[(number - 1) * (8 + 8 * LANES) : number * (8 + 8 * LANES)]
        words = words[4 * int(np.frombuffer(entry[:8], np.uint64)[0]) :]
        states = entry[8:]
    from_step = number * CHECKPOINT
    ids = decode(model, n, [states], [words], from_step, -(-end // LANES) - from_step)[0]
    return ids[start - from_step * LANES : end - from_step * LANES]


def sections(states: bytes, checkpoints: bytes, words: bytes) -> list[tuple[bytes, bytes]]:
    """States and words of the parts of a block between its checkpoints, in order."""
    size = 8 + 8 * LANES
    entries = [checkpoints[at : at + size] for at in range(0, len(checkpoints), size)]
    places = [0, *(4 * int(np.frombuffer(e[:8], np.uint64)[0]) for e in entries), len(words)]
    starts = [states, *(e[8:] for e in entries)]
    return [(own, words[a:b]) for own, a, b in zip(starts, places, places[1:])]


def decode_sections(model: Model, n: int, blocks: list[list[tuple[bytes, bytes]]]) -> np.ndarray:
    """Ids of blocks of the same size, all sections of all blocks at once, each from its checkpoint."""
    whole, size = len(blocks[0]) - 1, CHECKPOINT * LANES
    found = []
    if whole:
        parts = [part for own in blocks for part in own[:-1]]
        found.append(decode(model, size, [s for s, _ in parts], [w for _, w in parts]).reshape(len(blocks), -1))
    found.append(decode(model, n - whole * size, [own[-1][0] for own in blocks], [own[-1][1] for own in blocks]))
    return np.concatenate(found, axis=1)


# Documents with their ids, and behind those of a task how often each token is in them.
_IDS = "doc_id bigint, ids binary, token bigint, n bigint"


def _encoded(vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(vocabulary)
        kind = id_kind(max(encode_texts.size, end_id + 1))
        counts = np.zeros(max(encode_texts.size, end_id + 1), np.int64)
        names = [p.split()[0] for p in _IDS.split(", ")]
        for batch in batches:
            for part in slices(batch, "text"):
                flat, ends = encode_texts.encode(text_column(part, "text"))
                ids = np.insert(flat, ends[1:], end_id).astype(kind)
                counts += np.bincount(ids, minlength=len(counts))
                size = np.dtype(kind).itemsize
                offsets = (ends + np.arange(len(ends))) * size
                if offsets[-1] >= 1 << 31:
                    raise ValueError("one document has more than a billion ids")
                binary = pa.Array.from_buffers(
                    pa.binary(),
                    part.num_rows,
                    [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids)],
                )
                none = pa.nulls(part.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), binary, none, none], names=names)
        tokens = np.flatnonzero(counts)
        none = pa.nulls(len(tokens), pa.int64()), pa.nulls(len(tokens), pa.binary())
        yield pa.RecordBatch.from_arrays([*none, pa.array(tokens, pa.int64()), pa.array(counts[tokens])], names=names)

    return run


_BLOCKS = (
    "part int, block int, n int, states binary, checkpoints binary, words binary, crc32 bigint, "
    "doc_ids array<bigint>, first bigint, lengths array<int>, offset bigint"
)
_BLOCK_KINDS = [
    pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(),
    pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int32()), pa.int64(),
]


class _Part:
    """Cuts the documents of a part, in order, into blocks."""

    def __init__(self, part: int, model: Model):
        self.part, self.model = part, model
        self.block, self.documents, self.offset = 0, 0, 0
        self.ids: list[np.ndarray] = []
        self.waiting: list[tuple[int | None, int]] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.waiting.append((doc_id, len(ids)))
        self.size += len(ids)

    def rows(self, all_of_it: bool) -> Iterator[tuple]:
        full = self.size // BLOCK
        if not full and not (all_of_it and self.size):
            return
        ids = np.concatenate(self.ids)
        done = 0
        while full - done:
            side = min(SIDE_BY_SIDE, full - done)
            yield from self._blocks(ids[done * BLOCK : (done + side) * BLOCK].reshape(side, BLOCK))
            done += side
        rest = ids[full * BLOCK :]
        if all_of_it and len(rest):
            yield from self._blocks(rest.reshape(1, -1))
            rest = rest[:0]
        self.ids, self.size = [rest], len(rest)

    def _blocks(self, grid: np.ndarray) -> Iterator[tuple]:
        n = grid.shape[1]
        for ids, coded in zip(grid, encode(grid, self.model)):
            doc_ids, lengths, first, offset, room = [], [], self.documents, self.offset, n
            while room:
                doc_id, length = self.waiting[0]
                taken = min(room, length - self.offset)
                doc_ids.append(doc_id)
                lengths.append(taken)
                room -= taken
                self.offset += taken
                if self.offset == length:
                    self.waiting.pop(0)
                    self.documents, self.offset = self.documents + 1, 0
            yield (self.part, self.block, n, *coded, crc32(ids), doc_ids, first, lengths, offset)
            self.block += 1


def _blocks_of(kind: str, tokens: np.ndarray, freq: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for batch in batches:
            if part is None and batch.num_rows:
                part = _Part(batch.column("part")[0].as_py(), Model(tokens, freq))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                part.add(doc_id, np.frombuffer(ids.as_buffer(), kind))
                if part.size >= SIDE_BY_SIDE * BLOCK:
                    yield from _batches(part.rows(False))
        if part is not None:
            yield from _batches(part.rows(True))

    return run


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    names = [p.split()[0] for p in _BLOCKS.split(", ")]
    if found := list(rows):
        columns = [pa.array(c, k) for c, k in zip(zip(*found), _BLOCK_KINDS)]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def write(
    documents: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column_name: str = "text",
    vocabulary: str | None = None,
    end_id: int = 2,
) -> None:
    """Encodes all texts and writes them, in ascending order of their ids, to ``path``."""
    vocabulary = vocabulary or default_vocabulary()
    kind = id_kind(max(encoder(vocabulary).size, end_id + 1))
    texts = documents.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column_name).alias("text")
    )
    coded = stored(texts.mapInArrow(_encoded(vocabulary, end_id), _IDS), "ids", "zstd")
    ids = coded.where("token IS NULL").select("doc_id", "ids")
    counts = coded.where("token IS NOT NULL").select("token", "n")
    # One row a token of the vocabulary at most.
    counted = counts.groupBy("token").agg(F.sum("n").alias("n")).orderBy("token").collect()
    tokens = np.array([r["token"] for r in counted], dtype=np.int64)
    total = sum(r["n"] for r in counted)
    freq = Model.frequencies(np.array([r["n"] for r in counted], dtype=np.float64)) if counted else tokens
    spark = documents.sparkSession
    model = spark.createDataFrame(
        [(int(t), int(f)) for t, f in zip(tokens, freq)], "token bigint, freq bigint"
    )
    model.coalesce(1).write.parquet(f"{path}/model")
    parts = max(1, math.ceil(total / PART))
    # Equal ids are told apart by their content, so that they need not meet in one part.
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("ids"), F.col("ids")]
    ordered = ids.repartitionByRange(parts, *order[:2]).sortWithinPartitions(*order)
    marked = ordered.withColumn("part", F.spark_partition_id())
    blocks = marked.mapInArrow(_blocks_of(kind, tokens, freq), _BLOCKS)
    blocks.write.parquet(f"{path}/blocks")


_PIECE = (
    "part int, number bigint, doc_id bigint, block int, offset bigint, n int, crc32 bigint, ids binary"
)


def _pieces_of(tokens: np.ndarray, freq: np.ndarray, keep_ids: bool):
    names = [p.split()[0] for p in _PIECE.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(tokens, freq)
        for batch in batches:
            sizes = batch.column("n").to_numpy()
            # Blocks of one size side by side.
            for n in np.unique(sizes).tolist():
                same = np.flatnonzero(sizes == n)
                for at in range(0, len(same), SIDE_BY_SIDE):
                    rows = batch.take(pa.array(same[at : at + SIDE_BY_SIDE])).to_pylist()
                    try:
                        parts = [sections(r["states"], r["checkpoints"], r["words"]) for r in rows]
                        found = decode_sections(model, n, parts)
                    except IndexError as error:
                        raise ValueError(f"a block of part {rows[0]['part']} is damaged") from error
                    pieces: list[tuple] = []
                    for row, ids in zip(rows, found):
                        if crc32(ids) != row["crc32"]:
                            raise ValueError(f"block {row['block']} of part {row['part']} is damaged")
                        ends = np.cumsum(row["lengths"]).tolist()
                        for i, (doc_id, length, end) in enumerate(zip(row["doc_ids"], row["lengths"], ends)):
                            own = ids[end - length : end]
                            start = row["block"] * BLOCK + end - length
                            kept = own.astype("<u4").tobytes() if keep_ids else None
                            pieces.append(
                                (row["part"], row["first"] + i, doc_id, row["block"], start, length, crc32(own), kept)
                            )
                    columns = [pa.array(c, k) for c, k in zip(zip(*pieces), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def read_pieces(spark: SparkSession, path: str, keep_ids: bool = True) -> DataFrame:
    """What each block holds of each document, with its place ``offset`` in the part.

    ``ids`` are little-endian 32-bit integers, NULL unless asked for.
    """
    rows = spark.read.parquet(f"{path}/model").orderBy("token").collect()
    tokens = np.array([r["token"] for r in rows], dtype=np.int64)
    freq = np.array([r["freq"] for r in rows], dtype=np.int64)
    blocks = spark.read.parquet(f"{path}/blocks").select(
        "part", "block", "n", "states", "checkpoints", "words", "crc32", "doc_ids", "first", "lengths"
    )
    return blocks.mapInArrow(_pieces_of(tokens, freq, keep_ids), _PIECE)


def checksum_of_parts(checksums: list[int], sizes: list[int]) -> int:
    """The crc32 of byte strings one after the other, from the crc32 and size of each."""
    whole = checksums[0]
    for checksum, size in zip(checksums[1:], sizes[1:]):
        nothing = bytes(size)
        whole = zlib.crc32(nothing, whole) ^ zlib.crc32(nothing) ^ checksum
    return whole


def read_documents(spark: SparkSession, path: str, keep_ids: bool = True) -> DataFrame:
    """One row a document: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids."""
    parts = (
        spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n").cast("bigint").alias("size"))
    )
    before = sums_before(parts, "part", "size", "before").select("part", "before")
    pieces = read_pieces(spark, path, keep_ids)
    in_order = F.sort_array(F.collect_list(F.struct("block", "n", "crc32", "ids")))
    documents = pieces.groupBy("part", "number").agg(
        F.min("doc_id").alias("doc_id"),
        F.min("offset").alias("offset"),
        F.sum("n").cast("bigint").alias("n_tokens"),
        in_order.alias("pieces"),
    )

    @F.pandas_udf("bigint")
    def joined(checksums, sizes):
        return checksums.combine(sizes, lambda c, n: checksum_of_parts(list(c), [4 * int(x) for x in n]))

    many = F.size("pieces") > 1
    checksum = F.when(many, joined("pieces.crc32", "pieces.n")).otherwise(F.col("pieces")[0]["crc32"])
    ids = F.aggregate("pieces", F.lit(b""), lambda whole, p: F.concat(whole, p["ids"]))
    return documents.join(before, "part").select(
        "doc_id",
        (F.col("before") + F.col("offset")).alias("start"),
        "n_tokens",
        checksum.alias("ids_crc32"),
        *([ids.alias("ids")] if keep_ids else []),
    )


def write_and_read(documents: DataFrame, keep_ids: bool = False, **options) -> DataFrame:
    """Writes to a new folder under the shared one and reads that back."""
    spark = documents.sparkSession
    path = f"{working_folder(spark)}/tokens"
    write(documents, path, **options)
    return read_documents(spark, path, keep_ids)
