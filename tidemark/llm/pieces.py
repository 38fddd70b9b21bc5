"""SentencePiece encoding and decoding over a relational lattice.

The words of a batch of texts are reduced to distinct ones. All their substrings up to
the longest piece are listed, joined to the piece table by value, and the matches, the
edges of the lattice, are folded word by word into one path. The fold depends on the
model: for a unigram model it is the Viterbi algorithm (the path with the highest sum
of scores), for a BPE model the merges in order of rank, leftmost first, which is what
that kind of model means; the scores of its pieces are ranks, and their best sum is
another path. List, join and folds are array operations over all words at once.

``lattice_paths`` is the same lattice as DataFrame operations, for tables of words:
explode, equi-join, group by word, fold by a higher-order aggregate.

Characters without a piece become their bytes, where the model has pieces for bytes,
else the unknown id. Defined results: NULL text is the empty text, which has no ids.
Repeated rows are rows of their own. An empty table gives no rows. Very long words are
merged with a heap. A lower one eighth block (U+2581) in a text is the model's mark of a
space, so it is decoded as one.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc32, slices, text_column

SPACE = "\u2581"
KNOWN_WORDS = 300_000
# Characters of words whose lattice is made at once; longer single words use a heap.
AT_ONCE = 1 << 20
LONG_WORD = 256
# Fixed value: what a run of spaces with the word after it, a line break, or spaces are.
_UNIT = r"( *[^ \n]+|\n| +)"
_WORD_AND_MARK = r"^ *\pL+[.,]$"
_NONE = np.iinfo(np.int64).max
_NO_RANK = np.int64(1 << 30)
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class PieceModel:
    """Pieces with ids and scores, ids of bytes, and what kind of model it is."""

    pieces: tuple[str, ...]
    ids: tuple[int, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]  # empty without pieces for bytes
    unknown: int
    kind: str = "bpe"


def load(path: str, kind: str = "bpe") -> PieceModel:
    """Reads a model file with the sentencepiece library."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.vocab_size())
    plain = [
        i
        for i in every
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    in_bytes = {model.id_to_piece(i): i for i in every if model.is_byte(i)}
    byte_ids = tuple(in_bytes[f"<0x{b:02X}>"] for b in range(256)) if len(in_bytes) == 256 else ()
    return PieceModel(
        tuple(model.id_to_piece(i) for i in plain),
        tuple(plain),
        tuple(model.get_score(i) for i in plain),
        byte_ids,
        model.unk_id(),
        kind,
    )


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceEncoder:
    """Encodes and decodes many texts at once."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.longest = max(map(len, model.pieces), default=1)
        self._key_tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self._ids = np.array(model.ids, np.uint32)
        scores = np.array(model.scores)
        # Ranks from the best score down; equal scores share one.
        self._ranks = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self._scores = scores
        self._by_piece = {p: i for i, p in enumerate(model.pieces)}
        # Full stop and comma are words of their own if no piece joins them to a letter.
        joined = any(p[i] in ".," and p[i - 1].isalpha() for p in model.pieces for i in range(1, len(p)))
        self._marks_apart = not joined
        self._breaks_apart = not any("\n" in p for p in model.pieces if len(p) > 1)
        self._known = pa.array([], pa.large_string())
        self._known_table = (np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64))
        every = max([0, model.unknown, *model.ids, *model.byte_ids]) + 1
        self._bytes = [b""] * every
        for piece, number in zip(model.pieces, model.ids):
            self._bytes[number] = piece.encode("utf-8")
        for byte, number in enumerate(model.byte_ids):
            self._bytes[number] = bytes([byte])
        self._bytes[model.unknown] = " \u2047 ".encode()

    # --- the lattice of distinct words ---------------------------------------

    def _lattice(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """By start and length, the piece of each substring (-1: none), and the words' sizes.

        Substrings and pieces are joined by a hash of their characters, and what meets is
        compared in full.
        """
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        room = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))
        edges = np.full((len(codes), self.longest), -1, np.int32)
        starts, hashes = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        for length in range(1, self.longest + 1):
            inside = room[starts] >= length
            starts, hashes = starts[inside], hashes[inside]
            hashes = hashes * _BASE + codes[starts + length - 1]
            keys, found, characters = self._keys(length)
            if not len(keys) or not len(starts):
                continue
            at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            same = np.flatnonzero(keys[at] == hashes)
            windows = starts[same][:, None] + np.arange(length)
            equal = (codes[windows] == characters[at[same]]).all(axis=1)
            edges[starts[same[equal]], length - 1] = found[at[same[equal]]]
        return edges, sizes

    def _keys(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pieces of a length by their sorted hashes: hash, number and characters."""
        if length not in self._key_tables:
            own = [i for i, p in enumerate(self.model.pieces) if len(p) == length]
            text = "".join(self.model.pieces[i] for i in own)
            characters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, length)
            keys = np.zeros(len(own), np.uint64)
            for column in characters.T:
                keys = keys * _BASE + column
            if len(np.unique(keys)) != len(keys):
                raise ValueError("two pieces have one hash")
            order = np.argsort(keys)
            self._key_tables[length] = keys[order], np.array(own, np.int32)[order], characters[order]
        return self._key_tables[length]

    def _merged(self, edges: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Length of the symbol that starts at each character (0: none), after all merges.

        In each round every word merges its pair of the best rank, the leftmost of equals.
        """
        ranks = np.where(edges >= 0, self._ranks[edges], _NO_RANK)
        start, length = np.arange(len(edges)), np.ones(len(edges), np.int64)
        word = np.repeat(np.arange(len(sizes)), sizes)
        final = np.zeros(len(edges), np.int64)
        while len(start):
            size = length.copy()
            size[:-1] += np.where(word[1:] == word[:-1], length[1:], self.longest)
            size[-1] += self.longest
            can = np.flatnonzero(size <= self.longest)
            key = np.full(len(start), _NONE)
            key[can] = (ranks[start[can], size[can] - 1] << 32) + can
            firsts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(key, firsts)
            merging = best < _NO_RANK << 32
            # Words without a merge are done.
            keep = np.repeat(merging, np.diff(np.r_[firsts, len(start)]))
            final[start[~keep]] = length[~keep]
            at = best[merging] & ((1 << 32) - 1)
            length[at] = size[at]
            keep[at + 1] = False
            start, length, word = start[keep], length[keep], word[keep]
        return final

    def _best_path(self, edges: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Length of the symbol that starts at each character (0: none) on the path with the
        highest sum of scores; ties to the longer last symbol."""
        lowest = float(self._scores.min(initial=0.0)) - 10.0
        place = np.arange(len(edges)) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # in its word
        by_place = np.argsort(place, kind="stable")
        cuts = np.searchsorted(place[by_place], np.arange(int(place.max(initial=-1)) + 2))
        value = np.full(len(edges), -np.inf)  # of the path that ends after a character
        last = np.ones(len(edges), np.int64)
        for low, high in zip(cuts, cuts[1:]):
            own = by_place[low:high]
            for size in range(min(self.longest, place[own[0]] + 1), 0, -1):
                start = own - size + 1
                piece = edges[start, size - 1]
                score = np.where(piece >= 0, self._scores[piece], lowest if size == 1 else -np.inf)
                total = score + np.where(place[start] > 0, value[start - 1], 0.0)
                better = total > value[own]
                value[own[better]] = total[better]
                last[own[better]] = size
        final = np.zeros(len(edges), np.int64)
        first = (np.cumsum(sizes) - sizes)[sizes > 0]
        at = np.cumsum(sizes)[sizes > 0] - 1
        while len(at):
            size = last[at]
            final[at - size + 1] = size
            at = at - size
            at, first = at[at >= first], first[at >= first]
        return final

    def _long_word(self, word: str) -> list[str]:
        """Symbols of one word after all merges, by a heap of pairs."""
        symbols: list[str | None] = list(word)
        after = [*range(1, len(word)), -1]
        before = list(range(-1, len(word) - 1))
        heap: list[tuple[int, int, str]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right >= 0:
                joint = symbols[left] + symbols[right]
                if len(joint) <= self.longest and (piece := self._by_piece.get(joint)) is not None:
                    heapq.heappush(heap, (int(self._ranks[piece]), left, joint))

        for left in range(len(word)):
            offer(left)
        while heap:
            _, left, joint = heapq.heappop(heap)
            right = after[left]
            if symbols[left] is None or right < 0 or symbols[left] + symbols[right] != joint:
                continue
            symbols[left], symbols[right] = joint, None
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [s for s in symbols if s is not None]

    def _ids_of(self, symbol: str) -> list[int]:
        piece = self._by_piece.get(symbol)
        if piece is not None:
            return [int(self._ids[piece])]
        if not self.model.byte_ids:
            return [self.model.unknown]
        return [self.model.byte_ids[b] for b in symbol.encode("utf-8", "surrogatepass")]

    def _new_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and the number of each."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        apart = (sizes > LONG_WORD) if self.model.kind == "bpe" else np.zeros(len(words), bool)
        # Groups of words in order; a very long one is alone.
        group = np.cumsum(sizes) // AT_ONCE + 2 * np.cumsum(apart) - apart
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(words)] if words else [0]
        parts, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for low, high in zip(cuts, cuts[1:]):
            if apart[low]:
                ids = [n for symbol in self._long_word(words[low]) for n in self._ids_of(symbol)]
                parts.append(np.array(ids, np.uint32))
                counts.append(np.array([len(ids)]))
                continue
            own = words[low:high]
            edges, own_sizes = self._lattice(own)
            length = (self._merged if self.model.kind == "bpe" else self._best_path)(edges, own_sizes)
            start = np.flatnonzero(length)
            piece = edges[start, length[start] - 1]
            ids = self._ids[piece]
            ends = np.cumsum(own_sizes)
            if (piece < 0).any():
                text = "".join(own)
                repeats = np.ones(len(start), np.int64)
                others = {i: self._ids_of(text[start[i]]) for i in np.flatnonzero(piece < 0).tolist()}
                repeats[list(others)] = [len(o) for o in others.values()]
                ids, start = np.repeat(ids, repeats), np.repeat(start, repeats)
                places = np.cumsum(repeats) - repeats
                for i, own_ids in others.items():
                    ids[places[i] : places[i] + len(own_ids)] = own_ids
            parts.append(ids)
            counts.append(np.diff(np.searchsorted(start, ends), prepend=0))
        return np.concatenate(parts).astype(np.uint32), np.concatenate(counts)

    # --- texts ----------------------------------------------------------------

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids that hold those of distinct words, where each starts, and how many they are."""
        at = pc.index_in(words, value_set=self._known)
        new = at.is_null().to_numpy(zero_copy_only=False)
        fresh = words.filter(at.is_null())
        ids, counts = self._new_words([w.replace(" ", SPACE) for w in fresh.to_pylist()])
        known_ids, known_starts, known_counts = self._known_table
        new_starts = len(known_ids) + np.cumsum(counts) - counts
        where = at.fill_null(0).to_numpy()[~new]
        starts, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        starts[new], sizes[new] = new_starts, counts
        starts[~new], sizes[~new] = known_starts[where], known_counts[where]
        flat = np.concatenate((known_ids, ids))
        room = KNOWN_WORDS - len(self._known)
        if room > 0 and len(fresh):
            self._known = pa.concat_arrays([self._known, fresh.slice(0, room)])
            self._known_table = (
                flat[: len(known_ids) + int(counts[:room].sum())],
                np.concatenate((known_starts, new_starts[:room])),
                np.concatenate((known_counts, counts[:room])),
            )
        return flat, starts, sizes

    def _units(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts, spaces in front, and how many each text has."""
        texts = pc.replace_substring(texts, SPACE, " ")
        filled = pc.greater(pc.binary_length(texts), 0)
        nothing, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        spaced = pc.if_else(filled, pc.binary_join_element_wise(nothing, texts, space), texts)
        if not self._breaks_apart or pc.any(pc.match_substring(texts, "\0")).as_py():
            # A separator cannot be put in: cut row by row.
            cut = re.compile(r" *[^ ]+| +" if not self._breaks_apart else r" *[^ \n]+|\n| +")
            lists = [cut.findall(t) for t in spaced.to_pylist()]
            counts = np.fromiter(map(len, lists), np.int64, len(lists))
            return pa.array([u for units in lists for u in units], pa.large_string()), counts
        marked = pc.replace_substring_regex(spaced, _UNIT, "\\1\0")
        lists = pc.split_pattern(pc.utf8_rtrim(marked, "\0"), "\0")
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        counts[~filled.to_numpy(zero_copy_only=False)] = 0
        return lists.filter(filled).flatten(), counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and where each text starts and ends."""
        units, counts = self._units(texts)
        coded = units.dictionary_encode()
        words, which = coded.dictionary, coded.indices.to_numpy()
        marked = pc.match_substring_regex(words, _WORD_AND_MARK) if self._marks_apart else pa.array([False] * len(words), pa.bool_())
        stems = pc.if_else(marked, pc.utf8_rtrim(words, ".,"), words)
        stem_coded = stems.dictionary_encode()
        of_stem = stem_coded.indices.to_numpy()
        stem_ids, stem_starts, stem_counts = self._words(stem_coded.dictionary)
        has_mark = marked.to_numpy(zero_copy_only=False).astype(bool)
        size = stem_counts[of_stem]
        every = size + has_mark
        starts = np.cumsum(every) - every
        flat = np.zeros(int(every.sum()), np.uint32)
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        flat[np.repeat(starts, size) + within] = stem_ids[np.repeat(stem_starts[of_stem], size) + within]
        if has_mark.any():
            marks = pc.utf8_slice_codeunits(words.filter(marked), -1).to_numpy(zero_copy_only=False)
            stop, comma = self._ids_of(".")[0], self._ids_of(",")[0]
            flat[(starts + size)[has_mark]] = np.where(marks == ".", stop, comma)
        per_unit = every[which]
        before = np.concatenate(([0], np.cumsum(per_unit)))
        place = np.arange(before[-1], dtype=np.int64)
        place += np.repeat(starts[which] - before[:-1], per_unit)
        return flat[place], before[np.concatenate(([0], np.cumsum(counts)))]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; broken bytes become replacement characters."""
        table = self._bytes
        text = b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text[:1] == " " else text


_ENCODERS: dict[tuple[str, int], PieceEncoder] = {}


def encoder(model: PieceModel) -> PieceEncoder:
    """The encoder of this process for a model."""
    key = (model.kind, hash((model.pieces, model.ids, model.scores)))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = PieceEncoder(model)
    return _ENCODERS[key]


def encode(
    documents: DataFrame,
    model: PieceModel,
    id_column: str = "doc_id",
    text_column_name: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """One row a document: doc_id, n_tokens, ids_crc32, restored (decoded, it is the text), ids."""
    rows = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column_name).alias("text"))
    schema = rows.select("doc_id").schema.add("n_tokens", "long").add("ids_crc32", "long").add("restored", "boolean")
    names = ["doc_id", "n_tokens", "ids_crc32", "restored", *(["ids"] if keep_ids else [])]
    if keep_ids:
        schema = schema.add("ids", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = text_column(part, "text")
                flat, ends = own.encode(texts)
                ids = [flat[s:e] for s, e in zip(ends.tolist(), ends[1:].tolist())]
                restored = [own.decode(i) == t for i, t in zip(ids, texts.to_pylist())]
                columns = [
                    part.column("doc_id"),
                    pa.array(np.diff(ends), pa.int64()),
                    pa.array([crc32(i) for i in ids], pa.int64()),
                    pa.array(restored, pa.bool_()),
                ]
                if keep_ids:
                    columns.append(pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: PieceModel, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """The texts (doc_id, text) of ids as little-endian 32-bit integers; NULL ids give NULL."""
    rows = encoded.select(F.col(id_column).alias("doc_id"), F.col(ids_column).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            texts = [None if i is None else own.decode(np.frombuffer(i, "<u4")) for i in ids]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.mapInArrow(run, rows.select("doc_id").schema.add("text", "string"))


def lattice_paths(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """For each distinct ``word`` the path of pieces with the highest sum of scores: (word, ids, score).

    ``pieces`` has piece, id and score, as many rows as a vocabulary, and is sent to
    every task. The substrings of at most ``longest`` characters are joined to it; the
    matches are grouped by word and folded from the first character on. Words that no
    row of pieces covers have NULL ids.
    """
    starts = F.sequence(F.lit(1), F.char_length("word"))
    distinct = words.select("word").where("word <> ''").distinct()
    cut = distinct.select("word", F.explode(starts).alias("start"))
    room = F.least(F.lit(longest), F.char_length("word") - F.col("start") + 1)
    cut = cut.select("word", "start", F.explode(F.sequence(F.lit(1), room)).alias("size"))
    cut = cut.withColumn("piece", F.substring("word", F.col("start"), F.col("size")))
    edges = cut.join(F.broadcast(pieces.select("piece", "id", "score")), "piece")
    after = (F.col("start") + F.col("size") - 1).alias("after")
    score = F.col("score").cast("double").alias("score")
    lattice = edges.groupBy("word").agg(F.sort_array(F.collect_list(F.struct(after, "start", "id", score))).alias("edges"))
    path = "struct<score:double,ids:array<bigint>>"
    # Paths by the character they end after, from none on; NULL where none ends, which an
    # array of the first path alone would not allow.
    first = F.struct(F.lit(0.0).alias("score"), F.array().cast("array<bigint>").alias("ids")).cast(path)
    first = F.slice(F.array(first, F.lit(None).cast(path)), 1, 1)

    def step(paths, after):
        candidates = F.transform(
            F.filter("edges", lambda e: (e["after"] == after) & paths[e["start"] - 1].isNotNull()),
            lambda e: F.struct(
                (paths[e["start"] - 1]["score"] + e["score"]).alias("score"),
                F.concat(paths[e["start"] - 1]["ids"], F.array(e["id"].cast("bigint"))).alias("ids"),
            ),
        )
        return F.concat(paths, F.array(F.array_max(candidates).cast(path)))

    paths = F.aggregate(F.sequence(F.lit(1), F.char_length("word")), first, step)
    found = lattice.select("word", F.element_at(paths, -1).alias("path"))
    return distinct.join(found, "word", "left").select("word", F.col("path.ids").alias("ids"), F.col("path.score").alias("score"))
