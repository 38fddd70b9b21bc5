"""Token ids of many texts at once, by the tokenizers library.

The vocabularies handled here drop white space and never join over it, so a text's
ids are those of its space-separated words in order. The library therefore encodes
every distinct word of a batch once, and the ids are laid out with numpy. Words of
Latin letters, digits and signs fall into the pieces that the file's own rules cut them
into: runs of letters, single digits, runs of signs. Every distinct piece goes to the
library once, many to a call; the ids that end a word tell them apart again. Every other
word is a call's text of its own, as it stands, and so is every word if a file cuts or
lower-cases in another way.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Pieces that are sent to the library as one text, and texts of a call.
PIECES_PER_CALL = 64
TEXTS_PER_CALL = 256
# Pieces whose ids a process keeps, some tens of MB.
KNOWN_PIECES = 300_000
# Letters that lower case or composition turns into a letter and a mark are not among
# these: a mark would go together with what follows.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
# Without the apostrophe, which may go together with letters, and the sign that special tokens begin with.
_SIGNS = "!-&(-/:;=-@\\[-`{-~"
_PLAIN = f"^[{_LETTERS}0-9{_SIGNS}]+$"
_APART = f"([{_SIGNS}]+|[0-9])"
# What a file says of itself if its pieces are those above.
_NORMALIZER = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_PRE_TOKENIZER = [
    {
        "type": "Split",
        "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


class TextEncoder:
    """Encodes texts with a word-end vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self._tokenizer = Tokenizer.from_file(path)
        suffix = self._tokenizer.model.end_of_word_suffix
        if not suffix:
            raise ValueError(f"{path} is not a vocabulary with word ends")
        self.size = self._tokenizer.get_vocab_size()
        words = self._tokenizer.get_vocab(with_added_tokens=False)
        self._ends_word = np.zeros(self.size, dtype=bool)
        self._ends_word[[i for word, i in words.items() if word.endswith(suffix)]] = True
        with open(path, encoding="utf-8") as file:
            own = json.load(file)
        self._cuts = (
            (own["normalizer"] or {}).get("normalizers") == _NORMALIZER
            and (own["pre_tokenizer"] or {}).get("pretokenizers") == _PRE_TOKENIZER
            and all(token["content"].startswith("<") for token in own["added_tokens"])
        )
        # The same model for pieces, which are in lower case and cut already.
        self._model = Tokenizer(self._tokenizer.model)
        self._model.pre_tokenizer = Sequence(
            [WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        # Pieces that stay known from one call to the next.
        self._known = pa.array([], pa.large_string())
        self._known_table = _joined([]), _joined([], np.int64), _joined([], np.int64)

    @staticmethod
    def _encoded(tokenizer, texts: list[str]) -> list[np.ndarray]:
        ids: list[np.ndarray] = []
        # The library's results hold much more than ids; few of them are kept at a time.
        for at in range(0, len(texts), TEXTS_PER_CALL):
            some = texts[at : at + TEXTS_PER_CALL]
            found = tokenizer.encode_batch_fast(some, add_special_tokens=False)
            ids.extend(np.array(e.ids, dtype=np.uint32) for e in found)
        return ids

    def _apart(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, one after the other, and the number of each."""
        groups = [pieces[i : i + PIECES_PER_CALL] for i in range(0, len(pieces), PIECES_PER_CALL)]
        ids, counts = [], []
        for group, found in zip(groups, self._encoded(self._model, [" ".join(g) for g in groups])):
            ends = np.flatnonzero(self._ends_word[found])
            if len(ends) == len(group) and ends[-1] == len(found) - 1:
                ids.append(found)
                counts.append(np.diff(ends, prepend=-1))
            else:
                alone = self._encoded(self._model, group)
                ids.extend(alone)
                counts.append(np.array([len(a) for a in alone]))
        return _joined(ids), _joined(counts, np.int64)

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids that hold those of distinct pieces, where each starts, and their numbers."""
        at = pc.index_in(pieces, value_set=self._known)
        new = at.is_null().to_numpy(zero_copy_only=False)
        ids, counts = self._apart(pieces.filter(at.is_null()).to_pylist())
        known_ids, known_starts, known_counts = self._known_table
        new_starts = len(known_ids) + np.cumsum(counts) - counts
        where = at.fill_null(0).to_numpy()
        starts, sizes = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        starts[new], sizes[new] = new_starts, counts
        starts[~new], sizes[~new] = known_starts[where[~new]], known_counts[where[~new]]
        flat = np.concatenate((known_ids, ids))
        room = KNOWN_PIECES - len(self._known)
        if room > 0 and new.any():
            some = pieces.filter(at.is_null()).slice(0, room)
            self._known = pa.concat_arrays([self._known, some])
            self._known_table = (
                flat[: len(known_ids) + int(counts[:room].sum())],
                np.concatenate((known_starts, new_starts[:room])),
                np.concatenate((known_counts, counts[:room])),
            )
        return flat, starts, sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and where each text starts and ends."""
        lists = pc.ascii_split_whitespace(texts)
        word_ends = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        ids, before = _laid_out(*self._table(coded.dictionary), coded.indices.to_numpy())
        return ids, before[word_ends - word_ends[0]]

    def _table(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words, and where those of each word start and how many they are."""
        plain = pc.match_substring_regex(words, _PLAIN) if self._cuts else pc.is_null(words)
        others = self._encoded(self._tokenizer, words.filter(pc.invert(plain)).to_pylist())
        spaced = pc.replace_substring_regex(pc.utf8_lower(words.filter(plain)), _APART, r" \1 ")
        lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(spaced))
        coded = lists.flatten().dictionary_encode()
        ids, before = _laid_out(*self._pieces(coded.dictionary), coded.indices.to_numpy())
        bounds = before[lists.offsets.to_numpy()]
        other_counts = np.array([len(o) for o in others], dtype=np.int64)
        plain = plain.to_numpy(zero_copy_only=False).astype(bool)
        starts, counts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        starts[plain], counts[plain] = bounds[:-1], np.diff(bounds)
        starts[~plain] = len(ids) + np.cumsum(other_counts) - other_counts
        counts[~plain] = other_counts
        return _joined([ids, *others]), starts, counts


def _laid_out(
    flat: np.ndarray, starts: np.ndarray, counts: np.ndarray, which: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of ``flat`` one after the other, and where each begins there and the last ends."""
    sizes = counts[which]
    before = np.concatenate(([0], np.cumsum(sizes)))
    place = np.arange(before[-1], dtype=np.int64)
    place += np.repeat(starts[which] - before[:-1], sizes)
    return flat[place], before


def _joined(arrays: list[np.ndarray], kind=np.uint32) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *arrays]).astype(kind, copy=False)


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """The encoder of this process for a vocabulary file."""
    return TextEncoder(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
