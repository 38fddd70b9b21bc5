"""Credentials in texts, told from copied examples by who owns them corpus-wide.

Three kinds of spans are found by their form alone (assigned values, access keys, long
hex strings), and a fourth, mixed letters and digits of key length, is only a candidate.
The values of all of them are hashed and counted over the whole corpus, by distinct
repositories and distinct owners: a value that several owners have is an example that
was copied around, one that a single owner has looks live. Spans found by form stay in
either case and carry the verdict; candidates become spans if they look live.

All of it is column expressions and joins. Positions are code points, ends exclusive:
the pieces between the matches, from ``split``, give the matches their places.

Defined results: NULL text is the empty text. A row without a repository is its own, a
row without an owner belongs to one unnamed owner. Repeated rows are rows of their own,
but repositories with the same name count once. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, unused

# The forms, and the least number of characters.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
ASSIGNED_CHARACTERS = 8
KINDS = ("assign", "access", "hex", "key")
# A candidate: a whole run of such characters with a letter and a digit in it.
CANDIDATE = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+"
_MENTION = r"(?i:password|passwd|secret|token|api_?key)"
# A value that this many owners have is an example.
EXAMPLE_OWNERS = 3

# Up to this many spans to redact are sent to every task, about 100 bytes each.
BROADCAST_SPANS = 500_000

_SPAN = "struct<start:int,kind:int,end:int,value:string>"


def _spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """The matches of a pattern as (start, kind, end, value), those with a short value dropped."""
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    number = F.lit(KINDS.index(kind))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.char_length(x["between"])
        end = start + F.char_length(x["match"])
        span = F.struct(start.alias("start"), number.alias("kind"), end.alias("end"), x["value"].alias("value"))
        kept = F.when(F.char_length(x["value"]) >= least, F.concat(state["spans"], F.array(span)))
        return F.struct(end.alias("at"), kept.otherwise(state["spans"]).alias("spans"))

    rows = F.arrays_zip(
        F.slice(between, 1, F.size(matches)).alias("between"), matches.alias("match"), values.alias("value")
    )
    nothing = F.from_json(F.lit("[]"), f"array<{_SPAN}>")
    start = F.struct(F.lit(0).alias("at"), nothing.alias("spans"))
    return F.aggregate(rows, start, step, lambda state: state["spans"])


def _found(text: Column, mention: str, spans: Column) -> Column:
    """``spans`` where the text has what they need; most texts do not."""
    return F.when(text.rlike(mention), spans).otherwise(F.from_json(F.lit("[]"), f"array<{_SPAN}>"))


def found_by_form(documents: DataFrame, text: str) -> DataFrame:
    """Adds ``base``, the spans by form in order of start and kind, and ``candidates``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(
        _found(whole, _MENTION, _spans(whole, ASSIGN, "assign", 1, ASSIGNED_CHARACTERS)),
        _found(whole, "AKIA", _spans(whole, ACCESS, "access")),
        _found(whole, HEX, _spans(whole, HEX, "hex")),
    )
    candidates = F.filter(
        _found(whole, CANDIDATE, _spans(whole, CANDIDATE, "key")),
        lambda c: c["value"].rlike("[0-9]") & c["value"].rlike("[A-Za-z]"),
    )
    spans = documents.withColumn("base", F.array_sort(base)).withColumn("candidates", candidates)
    apart = F.filter(
        "candidates",
        lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )
    return spans.withColumn("candidates", apart)


def ownership(values: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """(hash, repositories, owners, live) of (hash, repository, owner).

    Combined in three steps, each map side first, so that a value copied a million times
    is spread by repository and owner before it is one row.
    """
    distinct = values.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    per_owner = distinct.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    counted = per_owner.groupBy("hash").agg(
        F.sum("repositories").alias("repositories"), F.count("*").alias("owners")
    )
    return counted.withColumn("live", F.col("owners") < example_owners)


def scan(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column_name: str = "text",
    owner_column: str = "source",
    repository_column: str | None = None,
    example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """One row a document: doc_id, text_hash, base and spans.

    ``base`` are the spans by form (start, kind, end, hash). ``spans`` are all of them
    (start, kind, end, hash, repositories, owners, live), candidates that look live
    included.
    """
    texts = documents.select(
        F.col(id_column).alias("doc_id"),
        F.col(text_column_name).alias("text"),
        F.col(owner_column).cast("string").alias("owner"),
        F.col(repository_column or id_column).cast("string").alias("repository"),
    )
    found = found_by_form(texts, "text")

    def hashed(spans: str) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("hash")
            ),
        )

    # Without the texts from here on. The number of a row is fixed once it is written.
    found = stored(
        found.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.xxhash64("text").alias("text_hash"),
            "owner",
            "repository",
            hashed("base").alias("base"),
            hashed("candidates").alias("candidates"),
        ),
        "found",
    )
    anything = (F.size("base") > 0) | (F.size("candidates") > 0)
    spans = found.where(anything).select(
        "row",
        F.coalesce("repository", F.concat(F.lit("row "), F.col("row"))).alias("repository"),
        "owner",
        F.explode(F.concat("base", "candidates")).alias("span"),
    )
    owned = ownership(spans.select(F.col("span.hash").alias("hash"), "owner", "repository"), example_owners)
    judged = (
        spans.select("row", "span.start", "span.kind", "span.end", "span.hash")
        .join(owned, "hash")
        .where((F.col("kind") < KINDS.index("key")) | F.col("live"))
        .groupBy("row")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("start", "kind", "end", "hash", "repositories", "owners", "live"))
            ).alias("spans")
        )
    )
    none = F.from_json(
        F.lit("[]"),
        "array<struct<start:int,kind:int,end:int,hash:string,repositories:bigint,owners:bigint,live:boolean>>",
    )
    with_any = found.where(anything).select("row", "doc_id", "text_hash", "base").join(judged, "row", "left")
    without = found.where(~anything).select("row", "doc_id", "text_hash", "base", none.alias("spans"))
    every = with_any.withColumn("spans", F.coalesce("spans", none)).unionByName(without)
    return every.drop("row")


def as_text(spans: str) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def count_of(spans: str, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("bigint")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with ``mark`` in place of spans (start, end; in order of start, may overlap)."""

    def step(state: Column, s: Column) -> Column:
        start, end = F.greatest(state["at"], s["start"]), F.greatest(state["at"], s["end"])
        before = F.substring(text, state["at"] + 1, start - state["at"])
        put = F.when(s["start"] >= state["at"], F.concat(state["done"], before, F.lit(mark)))
        return F.struct(end.alias("at"), put.otherwise(state["done"]).alias("done"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))
    rest = lambda state: F.concat(
        state["done"], F.substring(text, state["at"] + 1, F.char_length(text) - state["at"])
    )
    return F.aggregate(spans, start, step, rest)


def redact(documents: DataFrame, id_column: str = "doc_id", text_column_name: str = "text", **options) -> DataFrame:
    """The documents with a mark in place of every span that looks live; examples stay.

    A row is known by its id and its text, so rows without an id and repeated rows are
    redacted alike.
    """
    found = scan(documents, id_column, text_column_name, **options)
    live = F.filter("spans", lambda s: s["live"])
    own_id, own_hash, own_spans = (unused(documents.columns, name) for name in ("_id", "_hash", "_live"))
    marked = found.select(
        F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash), live.alias(own_spans)
    )
    marked = stored(marked.where(F.size(own_spans) > 0).dropDuplicates([own_id, own_hash]), "live")
    # One row: what would be sent to every task.
    spans = marked.agg(F.sum(F.size(own_spans))).first()[0] or 0
    marked = F.broadcast(marked) if spans <= BROADCAST_SPANS else marked
    same = F.col(id_column).eqNullSafe(F.col(own_id)) & (F.xxhash64(text_column_name) == F.col(own_hash))
    text = F.col(text_column_name)
    put = F.when(F.col(own_spans).isNotNull(), redacted(text, F.col(own_spans))).otherwise(text)
    whole = documents.join(marked, same, "left")
    return whole.withColumn(text_column_name, put).select(*documents.columns)
