"""Near-duplicate groups by SimHash fingerprints and multi-index hashing.

A fingerprint is cut into segments. Two fingerprints that differ in few bits differ in
very few bits of some segment, so each is entered in one table per segment under its own
value, and asks for all values in a small Hamming ball around it. What meets under one
value is verified by the complete distance. Texts with one fingerprint are one entry, and
a value's entries are not paired with each other: they are linked as a spanning star per
connected group, which loses no connection and has no more links than entries. Values
that very many fingerprints share are looked into once more by the rest of the bits.

Defined results: NULL text is the empty text. Words are what white space (space, tab to
carriage return) separates; with fewer words than a shingle has, the whole sequence is
the one shingle; without words the fingerprint is zero, which links like any other. Rows
are independent: a repeated row is a copy of itself; rows without an id belong to groups
but do not name them (component NULL if all are such). An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, stored, text_column, unused
from tidemark.llm.graph import components

SEED = 42
BITS = 64
SEGMENTS = 2
# Shingles whose bits are counted at once, and entries that are compared at once.
SHINGLES = 1 << 16
COMPARED = 1 << 22
# Fingerprints that share one half before they are told apart by more of their bits.
CROWD = 200_000
# Up to this many keys (9 bytes each) are sent to every task.
BROADCAST_KEYS = 2_000_000

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_POWERS = np.uint64(1) << np.arange(BITS, dtype=np.uint64)


def text_fingerprint(text: str, words: int = 3) -> int:
    """Fingerprint of one text: a bit is set if it is in over half the shingle hashes."""
    found = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    width = min(words, len(found))
    count = len(found) - width + 1
    set_bits = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, SHINGLES):
        here = slice(at, min(at + SHINGLES, count))
        spans = zip(starts[here].tolist(), ends[width - 1 :][here].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(_POWERS[2 * set_bits > count].sum(dtype=np.uint64))


def fingerprints(
    documents: DataFrame, id_column: str, text_column_name: str, words: int, hash_column: str | None = None
) -> DataFrame:
    """(doc_id, fp): the fingerprint's 64 bits as a signed number; and text_hash, where it is asked for."""
    more = [] if hash_column is None else ["text_hash"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, "text")):
            texts = text_column(part, "text").to_pylist()
            found = np.array([text_fingerprint(t, words) for t in texts], dtype=np.uint64)
            columns = [part.column("doc_id"), pa.array(found.view(np.int64)), *[part.column(n) for n in more]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", *more])

    texts = documents.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.col(text_column_name).alias("text"),
        *[F.col(hash_column).alias(n) for n in more],
    )
    return texts.mapInArrow(run, "doc_id bigint, fp bigint" + "".join(f", {n} bigint" for n in more))


def _balls(distance: int, bits: int = BITS) -> list[tuple[int, int, int]]:
    """(lowest bit, bits, radius) of each segment of that many bits.

    Values within ``distance`` agree in some segment up to its radius: with
    distance = SEGMENTS * a + b, up to a in one of the first b + 1 or a - 1 in another.
    """
    a, b = divmod(distance, SEGMENTS)
    width = bits // SEGMENTS
    radii = [a if i <= b else a - 1 for i in range(SEGMENTS)]
    return [(i * width, width, radius) for i, radius in enumerate(radii) if radius >= 0]


def _around(own: Column, width: int, radius: int, upwards: Column) -> Column:
    """The values within ``radius`` bits of ``own``, itself left out.

    Of two values that differ, ``upwards`` keeps only those the one with the lowest
    differing bit unset reaches: if all do that, each meeting happens once.
    """
    masks = [sum(1 << b for b in bits) for n in range(1, radius + 1) for bits in combinations(range(width), n)]
    every = F.array(*[F.lit(m).cast("bigint") for m in masks]) if masks else F.array().cast("array<bigint>")
    kept = F.filter(every, lambda m: ~upwards | (own.bitwiseAND(m.bitwiseAND(-m)) == 0))
    return F.transform(kept, lambda m: own.bitwiseXOR(m))


def _entries(value: Column, distance: int, bits: int, asks: Column) -> Column:
    """Array of (segment, value, asks): the own value of each segment, and those around it.

    Values that are stored enter their own one without asking and ask upwards; values
    that only ask (``asks``) ask for their own one and for all around.
    """
    every = []
    for number, (low, width, radius) in enumerate(_balls(distance, bits)):
        own = F.shiftrightunsigned(value, low).bitwiseAND((1 << width) - 1)

        def entry(v: Column, a: Column, number: int = number) -> Column:
            return F.struct(F.lit(number).alias("segment"), v.alias("value"), a.alias("asks"))

        every.append(F.array(entry(own, asks)))
        around = _around(own, width, radius, ~asks)
        every.append(F.transform(around, lambda v: entry(v, F.lit(True))))
    return F.concat(*every)


def _linked(stored_fp: np.ndarray, asking: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (larger, smallest of its group) among ``stored_fp`` and from ``asking`` to it.

    Grows each group from one entry; what was reached is not compared again, so a dense
    group costs about its size and not its square.
    """
    links: list[tuple[np.ndarray, np.ndarray]] = []
    rest, others = stored_fp.copy(), asking.copy()
    while len(rest):
        group, rest = [rest[:1]], rest[1:]
        front = [(rest[:0], False), (group[0], True)]
        while front:
            nodes, is_stored = front.pop()
            step = max(1, COMPARED // max(1, len(rest) + len(others)))
            for at in range(0, len(nodes), step):
                some = nodes[at : at + step, None]
                near = (np.bitwise_count(some ^ rest[None, :]) <= distance).any(axis=0)
                if near.any():
                    group.append(rest[near])
                    front.append((rest[near], True))
                    rest = rest[~near]
                if is_stored and len(others):
                    near = (np.bitwise_count(some ^ others[None, :]) <= distance).any(axis=0)
                    if near.any():
                        group.append(others[near])
                        front.append((others[near], False))
                        others = others[~near]
        members = np.unique(np.concatenate(group))
        if len(members) > 1:
            links.append((members[1:], np.full(len(members) - 1, members[0])))
    if not links:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(side) for side in zip(*links))


def _links_of(distance: int):
    """Links of the entries that meet under one value; these come one after the other."""
    names = ["place", "value", "asks", "fp"]

    def links(runs: list[list[np.ndarray]]) -> pa.RecordBatch:
        larger, smaller = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for _, _, asks, fp in runs:
            # A value that is only asked for is nobody's.
            if len(fp) > 1 and not asks[0]:
                a, b = _linked(fp[~asks].view(np.uint64), fp[asks].view(np.uint64), distance)
                larger.append(a)
                smaller.append(b)
        sides = [pa.array(np.concatenate(side).view(np.int64)) for side in (larger, smaller)]
        return pa.RecordBatch.from_arrays(sides, names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # parts of the value that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
            place, value = columns[:2]
            new = (place[1:] != place[:-1]) | (value[1:] != value[:-1])
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
            # Most values have one entry: only those with several are cut out.
            several = [(s, e) for s, e in zip(cuts[:-2], cuts[1:-1]) if e - s > 1]
            last = [c[cuts[-2] :] for c in columns]
            if held and (held[0][0][0], held[0][1][0]) == (place[0], value[0]):
                held.append([c[: cuts[1]] for c in columns])
                if len(cuts) == 2:
                    continue
                several = [(s, e) for s, e in several if s]
            runs = [[np.concatenate(c) for c in zip(*held)]] if held else []
            yield links(runs + [[c[s:e] for c in columns] for s, e in several])
            held = [last]
        if held:
            yield links([[np.concatenate(c) for c in zip(*held)]])

    return run


def near_links(fps: DataFrame, distance: int = 3, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints ``fp`` just as all links within ``distance`` do.

    ``place`` and ``value`` name where entries meet. A value with more than ``crowd``
    fingerprints is looked into once more: what is left of them is cut into segments
    the same way, so that a meeting place is known by three quarters of the bits and has
    room for as many fingerprints as the last quarter has values.
    """
    stored_only = F.lit(False)
    entries = fps.select("fp", F.explode(_entries(F.col("fp"), distance, BITS, stored_only)).alias("entry"))
    entries = entries.select("fp", "entry.*")
    own = [
        F.struct(F.lit(i).alias("segment"), F.shiftrightunsigned("fp", low).bitwiseAND((1 << width) - 1).alias("value"))
        for i, (low, width, _) in enumerate(_balls(distance))
    ]
    crowded = fps.select(F.explode(F.array(*own)).alias("e")).groupBy("e.segment", "e.value").agg(F.count("*").alias("n"))
    crowded = stored(crowded.where(F.col("n") > crowd).select("segment", "value", F.lit(True).alias("crowded")), "crowded")
    found = crowded.count()
    met = entries.select(F.col("segment").cast("bigint").alias("place"), "value", "asks", "fp")
    if found:
        few = F.broadcast(crowded) if found <= BROADCAST_KEYS else crowded
        marked = entries.join(few, ["segment", "value"], "left")
        met = marked.where("crowded is null").select(
            F.col("segment").cast("bigint").alias("place"), "value", "asks", "fp"
        )
        width = BITS // SEGMENTS
        # The other half of the fingerprint, and the half that is known as the place.
        rest = F.when(F.col("segment") == 0, F.shiftrightunsigned("fp", width)).otherwise(
            F.col("fp").bitwiseAND((1 << width) - 1)
        )
        inner = F.explode(_entries(rest, distance, width, F.col("asks"))).alias("entry")
        place = F.shiftleft(F.col("value"), 2) + 2 * F.col("segment") + F.col("entry.segment") + 16
        again = marked.where("crowded").select("fp", "segment", "value", inner)
        met = met.unionByName(
            again.select(place.cast("bigint").alias("place"), F.col("entry.value").alias("value"), "entry.asks", "fp")
        )
    dealt = met.repartition(F.col("place"), F.col("value")).sortWithinPartitions("place", "value", "asks")
    return dealt.mapInArrow(_links_of(distance), "a bigint, b bigint")


def near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column_name: str = "text",
    words: int = 3,
    distance: int = 3,
) -> DataFrame:
    """One row a document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = stored(fingerprints(documents, id_column, text_column_name, words), "fingerprints")
    return _with_group(prints, F.col("doc_id"), distance).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _with_group(prints: DataFrame, name: Column, distance: int) -> DataFrame:
    """Adds ``component_id``, the smallest ``name`` among the rows of a row's group."""
    distinct = stored(prints.groupBy("fp").agg(F.min(name).alias("first_id")), "distinct")
    roots = components(near_links(distinct.select("fp"), distance))
    labelled = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    names = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = labelled.join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp")


def without_near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column_name: str = "text",
    words: int = 3,
    distance: int = 3,
) -> DataFrame:
    """One document of each group: that with the smallest id, and of these the smallest hash of its text.

    A document is known by its id and its text: an id that comes with several texts names
    a document for each of them, and of rows with the same id and the same text one
    stays. A row without an id is known by its text, and comes after all others.
    """
    text = F.coalesce(F.col(text_column_name), F.lit(""))
    text_hash = F.xxhash64(text)
    unnamed = text_hash.bitwiseAND((1 << 62) - 1).bitwiseOR(1 << 62)
    key = F.coalesce(F.col(id_column).cast("bigint"), unnamed)
    own, gone_name, again_name, hash_name = (
        unused(documents.columns, name) for name in ("_key", "_gone", "_again", "_hash")
    )
    keyed = documents.select(key.alias("key"), text.alias("text"), text_hash.alias("hash"))
    prints = stored(fingerprints(keyed, "key", "text", words, "hash"), "fingerprints")
    named = _with_group(prints, F.struct("doc_id", "text_hash"), distance)
    groups = stored(named.select("doc_id", "text_hash", "component_id"), "groups")
    document = [F.col("doc_id").alias(own), F.col("text_hash").alias(hash_name)]
    gone = groups.where(F.struct("doc_id", "text_hash") != F.col("component_id")).select(*document).distinct()
    gone = stored(gone.withColumn(gone_name, F.lit(True)), "gone")
    repeated = groups.groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows")).where("rows > 1")
    repeated = stored(repeated.select(*document, F.lit(True).alias(again_name)), "repeated")

    def marked(rows: DataFrame, keys: DataFrame) -> DataFrame:
        few = keys.count() <= BROADCAST_KEYS
        return rows.join(F.broadcast(keys) if few else keys, [own, hash_name], "left")

    rows = documents.withColumns({own: key, hash_name: text_hash})
    left = marked(rows, gone).where(F.col(gone_name).isNull())
    if repeated.isEmpty():
        return left.select(*documents.columns)
    left = marked(left, repeated)
    again = left.where(F.col(again_name)).dropDuplicates([own, hash_name])
    once = left.where(F.col(again_name).isNull()).select(*documents.columns)
    return once.unionByName(again.select(*documents.columns))
