"""Document fingerprints that add up: a multiset hash of paragraphs.

A paragraph is a line or a part of one: lines are cut between two words wherever a hash
of these two says so, after eight words on average, so that texts without line breaks
have paragraphs too and an edit changes none but the paragraphs next to it. The white
space around and within paragraphs is not part of them. Each is hashed to a wide vector,
and a document's fingerprint is the sum of its paragraphs' vectors, lane by lane, modulo
powers of two. Order does not matter, paragraphs are added and taken away by adding and
subtracting vectors, and equal multisets have equal vectors. The vector
has a count (modulo 2**32), WIDE lanes modulo 2**40 that tell multisets apart, and LANES
one-bit lanes, counted modulo 2**32, two to a number. A one-bit lane's signed sum,
2 * lane - count, is a random projection of the multiset, so that products of lanes
estimate what two documents share.

All of it is column expressions; a vector is computed where its row is.

Defined results: NULL text is the empty text; its vector is zero, and two empty texts
are alike (1.0). A text of nothing but white space is one paragraph. Repeated rows are documents of their own. Equal ids are ordered by a
hash of the text, then the text; rows without an id come last in descending order. An
empty table gives no rows, a single document is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A word, or a line break with the white space after it.
TOKEN = r"\S++|[\r\n]\s*+"
# One in so many places between two words of a line is a cut; a power of two.
CUT = 8
WIDE = 3
WIDE_BITS = 40
SIGN_HASHES = 2
LANES = 64 * SIGN_HASHES
# Rows that are put in order together; ids are cut into this many ranges of like size.
ROWS_PER_RANGE = 1024
CELLS = 64
# Rows that the bounds of the ranges are taken from.
SAMPLED = 200_000
# Up to this many range heads (two numbers each) are sent to every task.
BROADCAST_HEADS = 1_000_000

_TWO = (1 << 32) + 1


def _words(text: Column) -> Column:
    """Hashes of the words; NULL where a line ends."""
    breaks = lambda t: t.startswith("\n") | t.startswith("\r")
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    words = F.transform(tokens, lambda t: F.when(~breaks(t), F.xxhash64(t)))
    return F.when((text != "") & ~text.rlike(r"\S"), F.array(F.xxhash64(text))).otherwise(words)


def _starts(words: Column) -> Column:
    """Places (from 1) of the words that paragraphs begin with."""

    def place(word: Column, i: Column) -> Column:
        # NULL at the beginning of a line.
        both = F.get(words, i - 1).bitwiseXOR(F.shiftright(word, 8)).bitwiseAND(CUT - 1)
        return F.when(word.isNotNull() & (F.coalesce(both, F.lit(0)) == 0), i + 1)

    return F.filter(F.transform(words, place), lambda start: start.isNotNull())


def _paragraphs(words: Column, starts: Column) -> Column:
    """The hashes of each paragraph's words; NULLs at its end count for nothing when hashed."""
    end = lambda i: F.coalesce(F.get(starts, i + 1), F.size(words) + 1)
    return F.transform(starts, lambda start, i: F.slice(words, start, end(i) - start))


def _hashes(parts: str, seed: int) -> Column:
    return F.transform(parts, lambda p: F.xxhash64(F.lit(seed), p))


def _one_bit_lanes(hashes: Column, bit: int) -> Column:
    """How many hashes have this bit set, and, 32 bits higher, the bit 32 above."""
    step = lambda s, h: s + F.shiftrightunsigned(h, bit).bitwiseAND(_TWO)
    return F.aggregate(hashes, F.lit(0).cast("bigint"), step)


def _wide_lane(hashes: Column) -> Column:
    mask = (1 << WIDE_BITS) - 1
    step = lambda s, h: (s + h.bitwiseAND(mask)).bitwiseAND(mask)
    return F.aggregate(hashes, F.lit(0).cast("bigint"), step)


def with_vector(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the vector of a text column as an array of numbers."""
    own = df.columns
    # One step after the other, so that nothing is computed once per lane.
    cut = df.withColumn("_words", _words(F.coalesce(F.col(text), F.lit(""))))
    cut = cut.withColumn("_starts", _starts(F.col("_words")))
    hashed = cut.withColumn("_parts", _paragraphs(F.col("_words"), F.col("_starts"))).select(
        *own,
        F.size("_parts").cast("bigint").alias("_n"),
        *[_hashes("_parts", i).alias(f"_h{i}") for i in range(SIGN_HASHES + WIDE)],
    )
    signs = [_one_bit_lanes(F.col(f"_h{i}"), bit) for i in range(SIGN_HASHES) for bit in range(32)]
    wide = [_wide_lane(F.col(f"_h{i}")) for i in range(SIGN_HASHES, SIGN_HASHES + WIDE)]
    return hashed.select(*own, F.array(F.col("_n"), *wide, *signs).alias(name))


def _lanes(vector: Column) -> Column:
    """The signed sums of the one-bit lanes."""
    packed = F.slice(vector, 2 + WIDE, 32 * SIGN_HASHES)
    both = F.flatten(
        F.transform(packed, lambda x: F.array(x.bitwiseAND((1 << 32) - 1), F.shiftrightunsigned(x, 32)))
    )
    return F.transform(both, lambda lane: 2 * lane - vector[0])


def added(one: Column, other: Column) -> Column:
    """Vector of the paragraphs of both."""
    return _combined(one, other, lambda a, b: a + b)


def removed(one: Column, other: Column) -> Column:
    """Vector of the paragraphs of ``one`` without those of ``other``, which it must hold."""
    return _combined(one, other, lambda a, b: a - b)


def _combined(one: Column, other: Column, how) -> Column:
    mask = (1 << WIDE_BITS) - 1
    lanes = F.zip_with(one, other, how)
    return F.transform(lanes, lambda x, i: F.when((i >= 1) & (i <= WIDE), x.bitwiseAND(mask)).otherwise(x))


def likeness(one: Column, other: Column) -> Column:
    """About twice the shared paragraphs over all paragraphs; 1 for equal vectors."""

    def product(a: Column, b: Column) -> Column:
        pairs = F.zip_with(_lanes(a), _lanes(b), lambda x, y: x.cast("double") * y)
        return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)

    size = product(one, one) + product(other, other)
    share = F.when(size == 0, 0.0).otherwise(2 * product(one, other) / size)
    return F.when(one == other, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), share)))


def as_text(vector: Column) -> Column:
    """The vector in hex; one-bit lanes modulo 2**16."""

    def digits(x: Column, n: int) -> Column:
        return F.lower(F.right(F.lpad(F.hex(x), 16, "0"), F.lit(n)))

    def pair(x: Column) -> Column:
        low = x.bitwiseAND((1 << 16) - 1)
        return low.bitwiseOR(F.shiftrightunsigned(x, 16).bitwiseAND(((1 << 16) - 1) << 16))

    head = [digits(vector[0], 8), *[digits(vector[i], WIDE_BITS // 4) for i in range(1, WIDE + 1)]]
    lanes = F.transform(F.slice(vector, 2 + WIDE, 32 * SIGN_HASHES), lambda x: digits(pair(x), 8))
    return F.concat(*head, F.array_join(lanes, ""))


def _range(documents: DataFrame) -> Column:
    """Number of the range of ids a row is in, growing with the id.

    Cells between quantiles, each cut into ranges of equal width; rows without an id are
    below all others, dealt by the hash that orders them.
    """
    rows, lowest, highest = documents.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    spread = F.shiftright(F.col("_hash"), 58) + 32  # 0 to 63
    without = -1 - spread
    if lowest is None:
        return without
    # The sample decides how even the ranges are, and nothing else.
    some = documents.sample(min(1.0, SAMPLED / rows), seed=1)
    shares = [i / CELLS for i in range(1, CELLS)]
    bounds = some.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] or []
    per_cell = max(1, -(-rows // (CELLS * ROWS_PER_RANGE)))
    lows = sorted({lowest, *bounds})
    highs = [*lows[1:], highest]
    cells = F.array(
        *[
            F.struct(F.lit(low).cast("bigint").alias("low"), F.lit(float(max(1, high - low))).alias("width"))
            for low, high in zip(lows, highs)
        ]
    )
    number = F.greatest(F.lit(1), F.size(F.filter(cells, lambda c: c["low"] <= F.col("doc_id"))))
    cell = F.element_at(cells, number)
    share = (F.col("doc_id").cast("double") - cell["low"].cast("double")) / cell["width"]
    within = F.least(F.lit(per_cell - 1), F.greatest(F.lit(0), F.floor(share * per_cell)))
    return F.when(F.col("doc_id").isNull(), without).otherwise((number - 1) * per_cell + within).cast("bigint")


def _heads(ranged: DataFrame) -> DataFrame:
    """The first row of each range in descending order, and the range before it, whose last row it follows.

    The first of all follows the last of all.
    """
    first = F.min(F.struct(F.bitwise_not("doc_id").alias("down"), "_hash"))
    without = F.min("_hash")
    ranges = ranged.groupBy("_range").agg(
        F.when(F.col("_range") >= 0, first["down"]).alias("_down"),
        F.when(F.col("_range") >= 0, first["_hash"]).otherwise(without).alias("_first"),
    )
    # In two levels, so that no window holds all ranges.
    level = F.floor(F.col("_range") / 4096)
    ranges = ranges.withColumn("_level", level)
    here = F.lead("_range").over(Window.partitionBy("_level").orderBy("_range"))
    levels = ranges.groupBy("_level").agg(F.min("_range").alias("_low"))
    above = F.lead("_low").over(Window.orderBy("_level"))
    lowest = F.min("_low").over(Window.partitionBy())
    levels = levels.select("_level", F.coalesce(above, lowest).alias("_above"))
    return (
        ranges.withColumn("_here", here)
        .join(levels, "_level")
        .select("_range", "_down", "_first", F.coalesce("_here", "_above").alias("_after"))
    )


def with_next(documents: DataFrame) -> DataFrame:
    """Adds the vector of each text, and ``next`` and ``next_vector``, the text and vector
    of the next document in descending order of doc_id.

    Expects doc_id and text. One shuffle of the texts: ranges of ids are ordered each in
    one task, and each gets a copy of the row that comes after its last one. Vectors are
    computed before it, once a text, and go with the texts.
    """
    hashed = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "_hash", F.xxhash64("text")
    )
    ranged = hashed.withColumn("_range", _range(documents))
    heads = _heads(ranged.select("doc_id", "_hash", "_range"))
    few = heads.select("_range").limit(BROADCAST_HEADS + 1).count() <= BROADCAST_HEADS
    heads = F.broadcast(heads) if few else heads
    is_head = (F.bitwise_not("doc_id").eqNullSafe(F.col("_down"))) & (F.col("_hash") == F.col("_first"))
    copies = ranged.join(heads, "_range").where(is_head)
    copies = copies.select("doc_id", "text", "_hash", F.col("_after").alias("_range"), F.lit(1).alias("_copy"))
    rows = ranged.withColumn("_copy", F.lit(0)).unionByName(copies)
    order = [F.col("_copy"), F.col("doc_id").desc_nulls_last(), F.col("_hash"), F.col("text")]
    rows = with_vector(rows, "text", "text_vector")
    following = F.lead(F.struct("text", "text_vector")).over(Window.partitionBy("_range").orderBy(*order))
    return rows.withColumn("_next", following).where("_copy = 0").select(
        "doc_id",
        "text",
        "text_vector",
        F.col("_next.text").alias("next"),
        F.col("_next.text_vector").alias("next_vector"),
    )


def edited(text: Column, other: Column) -> Column:
    """The last half of the characters replaced by as many first ones of ``other``, or all."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(
        F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(other, F.lit(1), half)
    )


def compared(documents: DataFrame, id_column: str = "doc_id", text_column_name: str = "text") -> DataFrame:
    """Vectors of each text, of its edited text and of the next document's."""
    texts = documents.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column_name).alias("text")
    )
    found = with_next(texts).withColumn("edited", edited(F.col("text"), F.col("next")))
    return with_vector(found, "edited", "edited_vector")


def fingerprints(documents: DataFrame, **columns) -> DataFrame:
    """One row a document: its fingerprint, that of its edited text, and how alike they are."""
    found = compared(documents, **columns)
    return found.select(
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("text_vector")).alias("fingerprint"),
        as_text(F.col("edited_vector")).alias("edited_fingerprint"),
        likeness(F.col("text_vector"), F.col("edited_vector")).alias("near_edited"),
        likeness(F.col("text_vector"), F.col("next_vector")).alias("near_next"),
    )
