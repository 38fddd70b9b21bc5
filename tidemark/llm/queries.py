"""The operators of this package as queries over the given tables, with the SQL of those that have one."""

from __future__ import annotations

import functools
import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    html,
    infill,
    merkle,
    multiset,
    packing,
    pieces,
    pii,
    quality,
    rans,
    secrets,
    sharding,
    simhash,
    topk,
)
from tidemark.llm.common import ship, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def sql() -> dict[str, str]:
    return dict(_SQL)


def _query(function: Query) -> Query:
    @functools.wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return function(spark, folder)

    _QUERIES[function.__name__] = run
    return run


@_query
def op1_ball_tree_top_k(spark, folder):
    """The five best inner products of every fiftieth vector with all others."""
    vectors = table(spark, folder, "embeddings").select(
        "vec_id", topk.scaled(F.col("embedding")).alias("vector")
    )
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


@_query
def op2_rans_tokens(spark, folder):
    """Ids written in compressed blocks in order of the documents and read back from them."""
    return rans.write_and_read(table(spark, folder, "documents"), end_id=2)


@_query
def op3_html_text(spark, folder):
    """The visible text of every page."""
    pages = html.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", F.char_length("text").cast("bigint").alias("n_chars"), "text")


@_query
def op4_best_fit_packing(spark, folder):
    """Documents in sequences of at most 4096 ids."""
    return packing.pack(table(spark, folder, "documents"), end_id=1, capacity=4096).placements.select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("bigint").alias("length"),
        "ids_crc32",
        "sequence_id",
        "offset",
    )


@_query
def op5_simhash_groups(spark, folder):
    """Groups of documents whose fingerprints are linked at three or fewer bits."""
    return simhash.near_duplicates(table(spark, folder, "documents"), words=3, distance=3)


@_query
def op6_quality_scores(spark, folder):
    """Quality of each text, learned from the labels of those not held out."""
    documents = table(spark, folder, "documents")
    model = quality.fit(documents, table(spark, folder, "labels"))
    scored = quality.score(documents, model, ["doc_id"])
    return scored.select(
        "doc_id",
        quality.held_out("doc_id").alias("held_out"),
        "score",
        F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


@_query
def op7_secret_spans(spark, folder):
    """Credentials by form, and candidates that a single owner has."""
    found = secrets.scan(table(spark, folder, "documents"), owner_column="source")
    return found.select(
        "doc_id",
        *[secrets.count_of("base", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.as_text("base"), 256).alias("base_sha256"),
        secrets.as_text("spans").alias("spans"),
    )


@_query
def op8_personal_data(spark, folder):
    """Personal data by form, and by the random field."""
    found = pii.detect(table(spark, folder, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in ("email", "ip", "card", "phone")],
        F.sha2(pii.as_text("base"), 256).alias("base_sha256"),
        pii.as_text("spans").alias("spans"),
    )


@_query
def op9_multiset_fingerprints(spark, folder):
    """Fingerprints of documents and edited documents, and how alike they are."""
    return multiset.fingerprints(table(spark, folder, "documents"))


@_query
def op10_sentencepiece(spark, folder):
    """Ids of every text by the given model, and whether they decode to the text."""
    model = pieces.load(pieces.default_model())
    return pieces.encode(table(spark, folder, "documents"), model, keep_ids=False)


@_query
def op11_merkle_manifest(spark, folder):
    """Proofs of all documents from the log of their manifest, some of them tampered with."""
    documents = table(spark, folder, "documents")
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = merkle.leaf([*fields[:-1], lowered])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    made = merkle.manifest(
        documents,
        fields,
        tree_column="lang",
        id_column="doc_id",
        keep={"doc_id": F.col("doc_id"), "claimed": F.when(chosen, tampered)},
    )
    return merkle.proofs(made, claim="claimed").select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@_query
def op12_histogram_shards(spark, folder):
    """All documents in 24 shards of nearly equal bytes."""
    whole = F.coalesce("text", F.lit(""))
    placed = sharding.sharded(
        table(spark, folder, "documents"),
        shards=24,
        size=F.octet_length(whole) + 8,
        key=F.xxhash64("text"),
        id_column="doc_id",
        keep={"doc_id": F.col("doc_id"), "text_crc32": F.crc32(whole.cast("binary"))},
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op13_fill_in_middle(spark, folder):
    """Every text cut and rearranged from compressed frames, and rebuilt from the outcome."""
    return infill.digests(infill.store(table(spark, folder, "documents")))


_SQL["op1_ball_tree_top_k"] = """
    WITH usable AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_dot_product(q.vector, c.vector) AS BIGINT) AS score
        FROM usable q JOIN usable c ON q.vec_id <> c.vec_id
        WHERE q.vec_id % 50 = 0)
    SELECT query_id, CAST(row_number() OVER (
               PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored QUALIFY rank <= 5"""


def _op7_sql() -> str:
    """Base and candidate spans of every text by splitting it at the matches."""

    def places(kind: int, pattern: str) -> str:
        # What is before a match: the pieces up to it and the matches before.
        escaped = pattern.replace("'", "''")
        return f"""
            SELECT doc_id, source, {kind} AS kind, i, matches[i] AS match,
                   list_sum(list_transform(pieces[1:i], lambda p: length(p)))
                   + coalesce(list_sum(list_transform(matches[1:i - 1], lambda m: length(m))), 0) AS start
            FROM (SELECT doc_id, source, matches, pieces, unnest(range(1, len(matches) + 1)) AS i
                  FROM (SELECT doc_id, source, regexp_extract_all(body, '{escaped}') AS matches,
                               regexp_split_to_array(body, '{escaped}') AS pieces FROM doc))"""

    # The same forms in the dialect of this engine.
    assign = secrets.ASSIGN.replace("\\x20", " ")
    found = " UNION ALL ".join(
        places(kind, pattern)
        for kind, pattern in enumerate(
            (assign, "AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}", "[A-Za-z0-9_-]{20,}")
        )
    )
    value = f"CASE kind WHEN 0 THEN regexp_extract(match, '{assign.replace(chr(39), chr(39) * 2)}', 1) ELSE match END"

    def joined(where: str) -> str:
        names = "['assign', 'access', 'hex', 'key'][kind + 1]"
        span = f"{names} || ':' || start || ':' || stop"
        return f"coalesce(string_agg({span}, ',' ORDER BY start, kind) FILTER ({where}), '')"

    counts = ", ".join(
        f"count(*) FILTER (kind = {kind}) AS n_{name}" for kind, name in enumerate(("assign", "access", "hex"))
    )
    return f"""
        WITH doc AS (SELECT doc_id, source, coalesce(text, '') AS body FROM documents),
        every AS (SELECT *, CAST(start + length(match) AS BIGINT) AS stop, {value} AS value
                  FROM ({found})),
        base AS (SELECT * FROM every WHERE kind IN (1, 2) OR (kind = 0 AND length(value) >= 8)),
        candidate AS (
            SELECT * FROM every c WHERE kind = 3 AND regexp_matches(value, '[0-9]')
              AND regexp_matches(value, '[A-Za-z]')
              AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = c.doc_id
                              AND b.start < c.stop AND c.start < b.stop)),
        spans AS (SELECT * FROM base UNION ALL SELECT * FROM candidate),
        owned AS (SELECT value, count(DISTINCT coalesce(source, '?')) AS owners FROM spans GROUP BY 1),
        kept AS (SELECT s.* FROM spans s JOIN owned USING (value)
                 WHERE kind < 3 OR owners < {secrets.EXAMPLE_OWNERS})
        SELECT doc.doc_id, {counts}, sha256({joined("kind < 3")}) AS base_sha256,
               {joined("kind IS NOT NULL")} AS spans
        FROM doc LEFT JOIN kept USING (doc_id) GROUP BY doc.doc_id"""


_SQL["op7_secret_spans"] = _op7_sql()


def _op11_sql() -> str:
    """Nodes level by level, the siblings of every leaf, and the roots these lead to."""

    def part(value: str) -> str:
        text = f"CAST({value} AS VARCHAR)"
        return f"coalesce(strlen({text}) || ':' || {text}, '-')"

    fields = [part(name) for name in ("doc_id", "source", "lang", "n_chars")]
    leaf = f"sha256({' || '.join([*fields, part('text')])})"
    lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    claimed = f"sha256({' || '.join([*fields, part(lowered)])})"
    # The checksum bit by bit: 3988292384 is its polynomial.
    byte = "list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]), " \
        "lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    crc = f"xor(list_reduce(list_concat([4294967295], {codes}), lambda crc, byte: {byte}), 4294967295)"

    def tree(name: str, of: str, key: str) -> str:
        return f"""{name}({key}, level, n, i, digest) AS (
            SELECT {key}, 0, n, i, digest FROM {of}
            UNION ALL
            SELECT {key}, level + 1, (n + 7) // 8, i // 8, sha256(string_agg(digest, '' ORDER BY i))
            FROM {name} WHERE n > 1 GROUP BY {key}, level, n, i // 8)"""

    def steps(name: str, of: str, key: str, leaves: str, offset: int) -> str:
        own = "(leaf.i >> (3 * node.level))"
        return f"""{name} AS (
            SELECT leaf.row, node.level + {offset} AS step,
                   coalesce(string_agg(node.digest, '' ORDER BY node.i) FILTER (node.i < {own}), '') AS before,
                   coalesce(string_agg(node.digest, '' ORDER BY node.i) FILTER (node.i > {own}), '') AS after
            FROM {leaves} leaf JOIN {of} node ON node.{key} IS NOT DISTINCT FROM leaf.{key}
                AND node.n > 1 AND node.i // 8 = {own} // 8
            GROUP BY leaf.row, node.level, {own})"""

    return f"""
        WITH RECURSIVE hashed AS (
            SELECT doc_id, lang, {leaf} AS digest,
                   CASE WHEN {crc} % 3 = 0 THEN {claimed} ELSE {leaf} END AS claimed
            FROM documents),
        leaf AS (
            SELECT *, row_number() OVER () AS row, count(*) OVER (PARTITION BY lang) AS n,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, digest) - 1 AS i
            FROM hashed),
        {tree("node", "leaf", "lang")},
        subroot AS (
            SELECT 0 AS one, lang, digest, count(*) OVER () AS n,
                   row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i
            FROM node WHERE n = 1),
        {tree("upper", "subroot", "one")},
        above AS (SELECT leaf.row, subroot.one, subroot.i FROM leaf JOIN subroot
                  ON leaf.lang IS NOT DISTINCT FROM subroot.lang),
        {steps("low", "node", "lang", "leaf", 0)},
        {steps("high", "upper", "one", "above", 1000)},
        step AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY step) AS k
                 FROM (SELECT * FROM low UNION ALL SELECT * FROM high)),
        fold(row, k, digest) AS (
            SELECT row, 0, claimed FROM leaf
            UNION ALL
            SELECT row, fold.k + 1, sha256(before || fold.digest || after)
            FROM fold JOIN step USING (row) WHERE step.k = fold.k + 1),
        proof AS (SELECT row, string_agg(before || after, '' ORDER BY k) AS siblings FROM step GROUP BY row),
        top AS (SELECT digest AS root FROM upper WHERE n = 1)
        SELECT leaf.doc_id, leaf.digest AS leaf, subroot.digest AS subroot, root,
               sha256(coalesce(siblings, '')) AS proof_sha256, folded.digest AS folded_root,
               folded.digest = root AS verified
        FROM leaf JOIN subroot ON leaf.lang IS NOT DISTINCT FROM subroot.lang CROSS JOIN top
        LEFT JOIN proof ON proof.row = leaf.row
        JOIN (SELECT row, arg_max(digest, k) AS digest FROM fold GROUP BY row) folded ON folded.row = leaf.row"""


_SQL["op11_merkle_manifest"] = _op11_sql()


_SQL["op13_fill_in_middle"] = """
    WITH hashed AS (
        SELECT doc_id, coalesce(text, '') AS body, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
        FROM documents),
    number AS (
        SELECT doc_id, body, length(body) AS n,
               list_transform([1, 9, 17, 25], lambda i: CAST('0x' || digest[i:i + 7] AS BIGINT)) AS h
        FROM hashed),
    chosen AS (
        SELECT *, CASE WHEN n = 0 OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>')
                            OR h[3] % 100 >= 90 THEN 'plain'
                       WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
               least(h[1] % (n + 1), h[2] % (n + 1)) AS first,
               greatest(h[1] % (n + 1), h[2] % (n + 1)) AS second
        FROM number),
    parts AS (
        SELECT *, substring(body, 1, first) AS prefix, substring(body, first + 1, second - first) AS middle,
               substring(body, second + 1) AS suffix
        FROM chosen)
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN first END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN second - first END AS middle_chars,
           sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                            WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                            ELSE body END) AS output_sha256,
           sha256(body) AS restored_sha256
    FROM parts"""
