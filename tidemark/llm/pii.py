"""Personal data in texts: patterns, and a linear-chain conditional random field.

Four kinds (email, ip, card, phone) are found by their form. What has no fixed form
(names, phone numbers without a country code, identity numbers) is found by a random
field over the shapes of words, their neighbours, word lists and cue words. It is trained
on the labelled table of ``sentences`` and decoded with the Viterbi algorithm, all
stretches of a batch at a time. Its spans are added where no span by form is.

A word without a digit or a capital in front can only be outside; the chain falls apart
there, so that decoding the stretches between such words gives the same labels as decoding
whole texts. All else is learned: shapes, neighbours, and for numbers the cues among the
WINDOW words before, of the 32 * WINDOW characters before them; a word after is looked for
in 64 characters. Marks and brackets around a word are not part of its shape.

Defined results: NULL text is the empty text and has no spans. Repeated rows are rows of
their own. An empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from dataclasses import field as dataclass_field
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import sentences
from tidemark.llm.common import slices, text_column
from tidemark.llm.sentences import GIVEN, THING

KINDS = ("email", "ip", "card", "phone", "crf_name", "crf_phone", "crf_id")
# The forms.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

OUTSIDE, NAME, PHONE, ID = range(4)
LABELS = 4
_SPAN_KIND = {NAME: KINDS.index("crf_name"), PHONE: KINDS.index("crf_phone"), ID: KINDS.index("crf_id")}

_CUES = {
    **dict.fromkeys("mr mrs ms dr prof".split(), "title"),
    **dict.fromkeys("call phone telephone tel mobile fax cell dial ring reach text".split(), "phone"),
    **dict.fromkeys("ssn passport".split(), "id"),
    **dict.fromkeys("number no security".split(), "number"),
}
_WORD = re.compile(r"\S+")
_CANDIDATE = re.compile(r"(?<!\S)(?:[^\s\w]*[A-Z]\S*|[^\s0-9]*[0-9]\S*)")
_ENDS = re.compile(r"[.!?][^\w\s]*$")
_MARKS_AROUND = ".,;:!?#\"'()[]{}<>\u201c\u201d\u2018\u2019"
# Words before a word in which cues are looked for, up to the sentence's beginning.
WINDOW = 8
# Scores of words in their surroundings that a task keeps.
REMEMBERED = 200_000


def shape(word: str) -> str:
    """Letters and digits by class, in runs of four at most, of the first characters."""
    classes = ["X" if c.isupper() else "x" if c.isalpha() else "d" if c.isdigit() else c for c in word[:24]]
    kept = [c for i, c in enumerate(classes) if not (i >= 4 and classes[i - 4 : i] == [c] * 4)]
    return "".join(kept[:12])


@lru_cache(maxsize=1)
def _vocabulary() -> frozenset[str]:
    """Words of the labelled table that neighbours are known by."""
    table = sentences.labelled()
    return frozenset(w.strip(_MARKS_AROUND) for words, _ in table for w in words if w == w.lower())


@dataclass(frozen=True, slots=True)
class Kind:
    """What the field sees of a word."""

    kind: str  # number, name (a capital in front) or word
    shape: str
    digits: int
    cue: str
    known: str  # the word itself, if the labelled table has it
    listed: str  # given name, a word of things, or neither
    ends: bool  # whether a sentence ends with it
    stops: bool  # whether a mark that divides comes after it


@lru_cache(maxsize=200_000)
def kind_of(word: str) -> Kind:
    core = word.strip(_MARKS_AROUND)
    low = core.lower()
    cue = _CUES.get(low, "-")
    digits = min(sum(c.isdigit() for c in core), 12)
    kind = "number" if digits else "name" if core[:1].isupper() else "word"
    listed = "given" if low in GIVEN else "thing" if low in THING else "-"
    # How long a word is says nothing of names, but for initials and capitals only.
    own = shape(core) if digits else shape(core[:2]) if len(core) > 1 else "X" if core.isupper() else "x"
    known = low if low in _vocabulary() else "-" if core else "mark"
    ends = _ENDS.search(word) is not None and cue != "title" and not (own == "X" and word.endswith("."))
    return Kind(kind, own, digits, cue, known, listed, ends, word.endswith((",", ":", ";")) or ends)


NOTHING = kind_of("")


def near(words: list[str], at: int) -> frozenset[str]:
    """Cues among the WINDOW words before a word, up to its sentence's beginning."""
    found = set()
    for word in reversed(words[max(0, at - WINDOW) : at]):
        kind = kind_of(word)
        if kind.ends and kind.cue == "-":
            break
        found.add(kind.cue)
    return frozenset(found - {"-", "title"})


def features(before: Kind, own: Kind, after: Kind, cues: frozenset[str]) -> list[str]:
    """Features of one word, by its neighbours and the cues before it."""
    kind = own.kind
    first = before is NOTHING or before.ends
    follows = before.kind == "name" and not before.stops
    goes_on = after.kind == "name" and not own.stops
    found = [
        f"bias {kind}",
        f"shape {own.shape}",
        f"cue {own.cue}",
        f"before {before.known} {kind}",
        f"before {before.cue} {kind}",
        f"after {after.known} {kind}",
        f"first {first} {kind}",
    ]
    if kind == "name":
        return [
            *found,
            f"is {own.listed}",
            f"is {own.known}",
            f"run {follows} {goes_on}",
            f"run {follows} {goes_on} {own.listed}",
            f"run {follows} {goes_on} {first}",
            f"lists {before.listed if follows else ''} {own.listed} {after.listed if goes_on else ''}",
            f"follows {before.kind} {first}",
            f"in run {before.known if not follows else '='} {goes_on}",
            f"beside {before.listed if follows else ''}",
            f"beside after {after.listed if goes_on else ''}",
        ]
    if kind == "number":
        found += [
            f"digits {own.digits}",
            f"numbers {before.kind == 'number'} {after.kind == 'number'}",
            f"shapes {before.shape if before.kind == 'number' else ''} {own.shape}",
            *(f"near {cue}" for cue in cues),
            *(f"near {cue} digits {own.digits}" for cue in cues),
            *(f"near {cue} shape {own.shape}" for cue in cues),
            *(f"near {cue} after {after.known}" for cue in cues),
            *([] if cues else ["no cue"]),
        ]
    return found


def allowed(word: str) -> list[bool]:
    """Which labels a word can have at all."""
    digit = _DIGIT.search(word) is not None
    return [True, "A" <= word.lstrip(_MARKS_AROUND)[:1] <= "Z", digit, digit]


@dataclass(frozen=True)
class Field:
    """Weights of features by label, and of label after label."""

    features: dict[str, int]
    weights: np.ndarray
    transitions: np.ndarray

    known: dict = dataclass_field(default_factory=dict, compare=False, repr=False)

    def emission(self, words: list[str], at: int) -> np.ndarray:
        """Scores of the labels of a word, remembered by what they depend on."""
        own = kind_of(words[at])
        before = kind_of(words[at - 1]) if at else NOTHING
        after = kind_of(words[at + 1]) if at + 1 < len(words) else NOTHING
        cues = near(words, at) if own.kind == "number" else frozenset()
        key = before, own, after, cues, *(mask := allowed(words[at]))
        score = self.known.get(key)
        if score is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            named = [self.features[f] for f in features(before, own, after, cues) if f in self.features]
            score = self.known[key] = np.where(mask, self.weights[named].sum(axis=0), -1e6)
        return score


def viterbi(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Best labels of many padded stretches (stretches x words x labels) at once."""
    count, longest, labels = emissions.shape
    best = emissions[:, 0].copy()
    back = np.zeros((count, longest, labels), np.int8)
    for step in range(1, longest):
        paths = best[:, :, None] + transitions[None]
        back[:, step] = paths.argmax(axis=1)
        goes_on = (step < lengths)[:, None]
        best = np.where(goes_on, paths.max(axis=1) + emissions[:, step], best)
    found = np.zeros((count, longest), np.int8)
    label = best.argmax(axis=1)
    rows = np.arange(count)
    for step in range(longest - 1, -1, -1):
        inside = step < lengths
        found[:, step] = np.where(inside, label, OUTSIDE)
        label = np.where(inside, back[rows, step, label] if step else label, label)
    return found


@lru_cache(maxsize=1)
def train(rounds: int = 150, pull: float = 0.05) -> Field:
    """Weights with the highest penalised likelihood of the labelled table, by gradient ascent.

    All sentences are summed over at once, padded to the longest.
    """
    table = sentences.labelled()
    count, longest = len(table), max(len(words) for words, _ in table)
    names: dict[str, int] = {}
    coded, kinds, masks = {}, {}, np.zeros((count, longest, LABELS), bool)
    gold, lengths = np.zeros((count, longest), int), np.array([len(words) for words, _ in table])
    for row, (words, labels) in enumerate(table):
        gold[row, : len(words)] = labels
        kinds = [NOTHING, *map(kind_of, words), NOTHING]
        for i, word in enumerate(words):
            cues = near(words, i) if kinds[i + 1].kind == "number" else frozenset()
            own = features(kinds[i], kinds[i + 1], kinds[i + 2], cues)
            coded[row, i] = [names.setdefault(f, len(names)) for f in own]
            masks[row, i] = allowed(word)
    # As many features for each word; what is missing is a feature of no weight.
    found = np.full((count, longest, max(map(len, coded.values()))), len(names))
    for (row, i), own in coded.items():
        found[row, i, : len(own)] = own
    inside = np.arange(longest) < lengths[:, None]
    rows = np.arange(count)
    weights, transitions = np.zeros((len(names) + 1, LABELS)), np.zeros((LABELS, LABELS))
    moments = [np.zeros_like(weights), np.zeros_like(transitions)]
    squares = [np.zeros_like(weights), np.zeros_like(transitions)]
    for step in range(1, rounds + 1):
        emission = np.where(masks, weights[found].sum(axis=2), -1e6)
        ahead, behind = emission.copy(), np.zeros_like(emission)
        for i in range(1, longest):
            ahead[:, i] += np.logaddexp.reduce(ahead[:, i - 1, :, None] + transitions, axis=1)
        for i in range(longest - 2, -1, -1):
            later = np.logaddexp.reduce(transitions + (emission[:, i + 1] + behind[:, i + 1])[:, None], axis=2)
            behind[:, i] = np.where(inside[:, i + 1, None], later, 0)
        whole = np.logaddexp.reduce(ahead[rows, lengths - 1], axis=1)
        share = np.where(inside[..., None], np.exp(np.minimum(ahead + behind - whole[:, None, None], 0)), 0)
        share[rows[:, None], np.arange(longest), gold] -= inside
        slopes = [-pull * weights, -pull * transitions]
        for label in range(LABELS):
            each = np.repeat(share[..., label].ravel(), found.shape[2])
            slopes[0][:, label] -= np.bincount(found.ravel(), each, len(names) + 1)
        for i in range(1, longest):
            pair = ahead[:, i - 1, :, None] + transitions + (emission[:, i] + behind[:, i])[:, None]
            pair = np.exp(np.minimum(pair - whole[:, None, None], 0))
            slopes[1] -= pair[inside[:, i]].sum(axis=0)
            np.add.at(slopes[1], (gold[inside[:, i], i - 1], gold[inside[:, i], i]), 1)
        for value, slope, moment, square in zip((weights, transitions), slopes, moments, squares):
            moment += 0.1 * (slope - moment)
            square += 0.01 * (slope**2 - square)
            value += 0.1 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        weights[-1] = 0
    return Field(names, weights, transitions)


def luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(doubled) + sum(map(int, digits[::-2]))) % 10 == 0


def by_form(text: str) -> list[tuple[int, int, int]]:
    """Spans (start, kind, end) of the four kinds with a fixed form, in order."""
    spans = []
    at, last, before = text.find("@"), 0, -1
    while at >= 0:
        # The run of characters before the sign cannot reach over an earlier sign.
        own = text[max(last, before + 1) : at]
        local = len(own) - len(own.rstrip(LOCAL))
        domain = _DOMAIN.match(text, at + 1) if local else None
        if domain:
            spans.append((at - local, 0, domain.end()))
            last = domain.end()
        before, at = at, text.find("@", max(at + 1, last))
    if _DIGIT.search(text):
        for match in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match[0].split(".")):
                spans.append((match.start(), 1, match.end()))
        for match in _CARD.finditer(text):
            digits = match[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((match.start(), 2, match.end()))
        for match in _PHONE.finditer(text) if "+" in text else ():
            if 10 <= sum(c in "0123456789" for c in match[0]) <= 15:
                spans.append((match.start(), 3, match.end()))
    return sorted(spans)


def _stretches(text: str) -> list[list[tuple[int, int]]]:
    """Rows of words (start, end) that may have a label other than outside."""
    rows: list[list[tuple[int, int]]] = []
    for word in _CANDIDATE.finditer(text):
        gap = text[rows[-1][-1][1] : word.start()] if rows else ""
        # A capital at the beginning of a line may be there for that.
        if rows and not gap.strip() and ("\n" not in gap or _DIGIT.search(word[0])):
            rows[-1].append(word.span())
        else:
            rows.append([word.span()])
    return rows


def _context(text: str, row: list[tuple[int, int]]) -> tuple[list[str], int]:
    """The words of a row with up to WINDOW before and one after, and how many are before."""
    start, end = row[0][0], row[-1][1]
    reach = text[max(0, start - 32 * WINDOW) : start]
    before = reach.split()[-WINDOW:]
    if "\n" in reach[len(reach.rstrip()) :]:
        before.append("\n")
    after = _WORD.search(text[end : end + 64])
    return [*before, *(text[s:e] for s, e in row), *([after[0]] if after else [])], len(before)


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A span without the marks around it; brackets that close within it stay."""
    while start < end:
        inner = text[start:end]
        if inner[-1] in ".,;:!?\"'\u201d\u2019]}>" or (inner[-1] == ")" and ("(" not in inner or inner[0] == "(" and inner.count("(") == 1)):
            end -= 1
        elif inner[0] in "\"'\u201c\u2018[{<" or (inner[0] == "(" and ")" not in inner):
            start += 1
        else:
            break
    return start, end


def by_field(texts: list[str], field: Field) -> list[list[tuple[int, int, int]]]:
    """Spans (start, kind, end) of the field's labels in each text."""
    rows = [(i, row) for i, text in enumerate(texts) for row in _stretches(text)]
    spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    rows.sort(key=lambda r: len(r[1]))
    at = 0
    while at < len(rows):
        # Stretches of like length side by side, so that padding at most doubles them.
        longest = 2 * len(rows[at][1])
        group = rows[at : at + max(1, 200_000 // longest)]
        group = [r for r in group if len(r[1]) <= longest]
        at += len(group)
        emissions = np.zeros((len(group), max(len(row) for _, row in group), LABELS))
        for number, (i, row) in enumerate(group):
            words, before = _context(texts[i], row)
            for place in range(len(row)):
                emissions[number, place] = field.emission(words, before + place)
        lengths = np.array([len(row) for _, row in group])
        labels = viterbi(emissions, lengths, field.transitions)
        for number in np.flatnonzero(labels.any(axis=1)):
            i, row = group[number]
            own = labels[number, : len(row)]
            cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(row)]
            for first, stop in zip(cuts, cuts[1:]):
                if own[first] != OUTSIDE:
                    start, end = _trimmed(texts[i], row[first][0], row[stop - 1][1])
                    spans[i].append((start, _SPAN_KIND[int(own[first])], end))
    return spans


def find(texts: list[str], field: Field) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """For each text the spans by form, and all spans, in order of start and kind."""
    found = []
    for base, more in zip([by_form(t) for t in texts], by_field(texts, field)):
        starts, ends = [b[0] for b in base], [0, *accumulate((b[2] for b in base), max)]
        # Of the spans that start before its end, none ends after its start.
        apart = [s for s in more if s[0] < s[2] and ends[bisect_left(starts, s[2])] <= s[0]]
        found.append((base, sorted(base + apart)))
    return found


_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("end", T.IntegerType())])


def detect(documents: DataFrame, id_column: str = "doc_id", text_column_name: str = "text") -> DataFrame:
    """One row a document: doc_id, base (spans by form) and spans (all)."""
    field = train()
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
    rows = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column_name).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans(found):
            return pa.array([[{"start": s, "kind": KINDS[k], "end": e} for s, k, e in own] for own in found], kind)

        for part in (p for batch in batches for p in slices(batch, "text")):
            found = find(text_column(part, "text").to_pylist(), field)
            columns = [part.column("doc_id"), spans([b for b, _ in found]), spans([a for _, a in found])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "base", "spans"])

    schema = rows.select("doc_id").schema.add("base", T.ArrayType(_SPAN)).add("spans", T.ArrayType(_SPAN))
    return rows.mapInArrow(run, schema)


def as_text(spans: str):
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
