"""The manifest against a tree built node by node in lists."""

import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text):
    return sha256(text.encode()).hexdigest()


def levels(nodes):
    """All levels of a tree, by the rule as it is worded."""
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([h("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return found


def proof(tree, index):
    steps = []
    for nodes in tree[:-1]:
        run = index // 8 * 8
        steps.append((nodes[run:index], nodes[index + 1 : run + 8]))
        index //= 8
    return steps


def fold(digest, steps):
    for before, after in steps:
        digest = h("".join([*before, digest, *after]))
    return digest


def leaf_of(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def expected(rows):
    trees = defaultdict(list)
    for row in rows:
        text = row["text"]
        low = text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        chosen = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0
        leaf = leaf_of(row, text)
        trees[row["lang"]].append((row["doc_id"], leaf, leaf_of(row, low) if chosen else leaf))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    built = {name: levels([leaf for _, leaf, _ in trees[name]]) for name in names}
    top = levels([built[name][-1][0] for name in names])
    found = []
    for number, name in enumerate(names):
        for index, (doc_id, leaf, claimed) in enumerate(trees[name]):
            steps = proof(built[name], index) + proof(top, number)
            folded = fold(claimed, steps)
            siblings = "".join("".join([*before, *after]) for before, after in steps)
            found.append(
                (doc_id, leaf, built[name][-1][0], top[-1][0], h(siblings), folded, folded == top[-1][0])
            )
    return found


def ours(documents):
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    keep = {"doc_id": F.col("doc_id"), "claimed": F.when(chosen, merkle.leaf([*FIELDS[:-1], low]))}
    made = merkle.manifest(documents, FIELDS, "lang", "doc_id", keep)
    return made, merkle.proofs(made, "claimed", whole=True)


def as_rows(found):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")
    return [(*(r[n] for n in names), r["folded_root"] == r["root"]) for r in found]


def test_odd_documents(documents):
    _, found = ours(documents)
    assert Counter(as_rows(found.collect())) == Counter(expected(documents.collect()))


@pytest.mark.parametrize("sizes", [(1,), (1, 1, 8, 9), (512, 513, 64), (4700, 3)])
def test_trees_of_several_layers(spark, sizes):
    names = [None, "", "é", "z", "Z"]
    rows = [(i * 7 + k, f"Text {i}", names[k], "s", i) for k, n in enumerate(sizes) for i in range(n)]
    random.Random(1).shuffle(rows)
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    made, found = ours(documents.repartition(5))
    assert len(made.layers) == (3 if max(sizes) > 512 * 512 else 2 if max(sizes) > 512 else 1)
    collected = found.collect()
    assert Counter(as_rows(collected)) == Counter(expected(documents.collect()))
    for r in random.Random(2).sample(collected, min(50, len(collected))):
        assert merkle.folded(r["leaf"], [(p["place"], p["siblings"]) for p in r["path"]]) == r["root"]


def test_many_trees(spark):
    rows = [(i, "t", f"lang{i:04}", None, None) for i in range(700)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    made, found = ours(documents)
    assert len(made.top) == 2
    assert Counter(as_rows(found.collect())) == Counter(expected(documents.collect()))


def test_no_rows(nothing):
    made, found = ours(nothing)
    assert made.root is None and found.count() == 0


def test_a_repeated_id_and_equal_rows(spark):
    rows = [(5, "same", "en", "s", 1)] * 900 + [(5, f"T{i}", "en", "s", 1) for i in range(600)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    _, found = ours(documents.repartition(4))
    assert Counter(as_rows(found.collect())) == Counter(expected(documents.collect()))


@settings(max_examples=80, deadline=None)
@drawn(st.integers(1, 512))
def test_positions_have_a_closed_form(n):
    leaves = [h(str(i)) for i in range(n)]
    log, tree = merkle.postorder(leaves, merkle.height_of(n)), levels(leaves)
    assert len(log) == sum(map(len, tree))
    for level, nodes in enumerate(tree):
        assert [log[merkle.position(level, i, n)] for i in range(len(nodes))] == nodes


def test_blocks_have_a_bounded_size(spark):
    rows = [(i, "t", "en", None, None) for i in range(3000)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    made, _ = ours(documents)
    sizes = [r[0] for r in made.layers[0].select(F.size("rows")).collect()]
    assert max(sizes) == merkle.BLOCK and sum(sizes) == 3000
