"""Merkle manifest of a dataset, kept as a postorder append log, and proofs from it.

Every row is a leaf; the leaves of a tree (one tree a language, say) stand in order of
their ids. Runs of FANOUT nodes have one parent, the last run may be shorter; the trees'
roots are in turn the leaves of one tree above them, whose root stands for the dataset.

Aligned builders write the log: each takes BLOCK neighbouring leaves, a whole subtree of
HEIGHT levels, and appends a node as soon as its last child is there. Full subtrees have
a known size, so the place of a node in that order has a closed form (``position``), and
nothing but the log is kept: no parent or child pointers. The roots of the blocks are
the leaves of the next layer, built alike, until a tree has a single block. Proofs go
the other way, from the uppermost layer down: a block's own proof is what all its leaves
share, and the siblings within the block are read from its log at their positions.

No task holds more than BLOCK leaves at once, whatever the size of a tree, and a layer is
a 512th of the one below. Trees are told apart by value, so one of them may hold nearly all rows: the
leaves are dealt by ranges of (tree, id, leaf, row), and blocks are groups of their own.

Defined results: NULL in any column is a value of its own. Rows without an id come
first, rows of one id are in order of their leaf; repeated rows are leaves of their own.
Texts are hashed whole. An empty table has no trees, no root and no proofs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import stored

FANOUT = 8
# Levels and leaves of a builder's subtree.
HEIGHT = 3
BLOCK = FANOUT**HEIGHT

_STEP = T.StructType().add("place", T.IntegerType()).add("siblings", T.ArrayType(T.StringType()))
_PATH = T.StructField("path", T.ArrayType(_STEP))
# The tree above the trees.
_TOP = ""


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields: Sequence[str | Column]) -> Column:
    """Hash of a row: each value as its size in bytes, a colon and itself, NULL as ``-``."""

    def part(value: str | Column) -> Column:
        text = (F.col(value) if isinstance(value, str) else value).cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        return F.coalesce(sized, F.lit("-"))

    return F.sha2(F.concat(*[part(value) for value in fields]), 256)


def height_of(leaves: int) -> int:
    """Levels a builder completes over a tree's leaves: to the root, or to those of a block."""
    height = 0
    while FANOUT**height < min(leaves, BLOCK):
        height += 1
    return height


def position(level: int, index: int, leaves: int) -> int:
    """Place in the postorder log of the ``index``-th node of a level.

    A node is written after its last leaf and the nodes below that end there. Before
    that leaf are all earlier leaves and every full subtree that ended with them.
    """
    last = min((index + 1) * FANOUT**level, leaves) - 1
    place, rest = level, last
    while rest:
        place += rest
        rest //= FANOUT
    return place


def postorder(leaves: Sequence[str], height: int) -> list[str]:
    """The nodes of a subtree in the order of their completion, its root last."""
    log: list[str] = []
    pending: list[list[str]] = [[] for _ in range(height + 1)]

    def complete(level: int) -> None:
        pending[level + 1].append(digest(*pending[level]))
        pending[level].clear()
        log.append(pending[level + 1][-1])

    for one in leaves:
        log.append(one)
        pending[0].append(one)
        level = 0
        while level < height and len(pending[level]) == FANOUT:
            complete(level)
            level += 1
    for level in range(height):
        if pending[level]:
            complete(level)
    return log


def siblings(log: Sequence[str], leaves: int, height: int) -> Iterator[list[tuple[int, list[str]]]]:
    """For every leaf of a subtree, the other nodes of its run and its place there, level by level."""
    runs: list[list[list[str]]] = []
    for level in range(height):
        count = -(-leaves // FANOUT**level)
        nodes = [log[position(level, i, leaves)] for i in range(count)]
        runs.append([nodes[i : i + FANOUT] for i in range(0, count, FANOUT)])
    for index in range(leaves):
        found, at = [], index
        for level_runs in runs:
            at, place = divmod(at, FANOUT)
            run = level_runs[at]
            found.append((place, run[:place] + run[place + 1 :]))
        yield found


def folded(claim: str, path: Sequence[tuple[int, Sequence[str]]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for place, others in path:
        claim = digest(*others[:place], claim, *others[place:])
    return claim


@dataclass(frozen=True)
class Manifest:
    """``layers[i]`` has a row a block: tree, block, n (nodes of the tree in this layer),
    log (digests in postorder) and, in the first, rows (what was kept of the leaves, in
    order). ``trees`` has tree, number, leaves, subroot; ``top`` are the layers above."""

    layers: list[DataFrame]
    trees: DataFrame
    top: list[DataFrame]
    root: str | None


def ranked(df: DataFrame, group: str, order: Sequence[str], name: str, size: str) -> DataFrame:
    """Adds each row's number from 0 within its group, and the group's rows.

    Dealt by ranges and sorted once; what is then counted is a row per group and range.
    ``order`` has to tell all rows apart, so that no group is bound to one task.
    """
    placed = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = stored(placed.withColumn("_place", F.monotonically_increasing_id()), "ranked")
    # The upper bits of that number are the range, the lower ones count its rows.
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    runs = placed.groupBy(group, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(
        runs.select(
            group,
            "_part",
            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_n").over(whole).alias(size),
        ),
        "starts",
    )
    numbered = placed.join(starts, [group, "_part"])
    return numbered.withColumn(name, F.col("_place") + F.col("_shift")).drop("_place", "_part", "_shift")


def _logs(schema: T.StructType):
    arrow_log = pa.list_(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heights = [height_of(n) for n in batch.column("n").to_pylist()]
            logs = [postorder(d, h) for d, h in zip(batch.column("digests").to_pylist(), heights)]
            columns = [pa.array(logs, arrow_log) if n == "log" else batch.column(n) for n in schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return run


def _layer(nodes: DataFrame, kept: Sequence[str], number: int) -> DataFrame:
    """Blocks of (tree, index, n, digest) and what is kept, each with its log."""
    block = F.shiftright("index", HEIGHT * 3).alias("block")
    row = F.struct("index", "digest", *kept)
    blocks = nodes.groupBy("tree", block, "n").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    given = blocks.select(
        "tree",
        "block",
        "n",
        F.col("rows.digest").alias("digests"),
        F.transform("rows", lambda r: F.struct(*[r[k].alias(k) for k in ["index", *kept]])).alias("rows"),
    )
    schema = T.StructType([given.schema[n] for n in ("tree", "block", "n", "rows")])
    schema = schema.add("log", T.ArrayType(T.StringType()))
    return stored(given.mapInArrow(_logs(schema), schema), f"layer_{number}")


def _layers(nodes: DataFrame, kept: Sequence[str]) -> list[DataFrame]:
    """All layers over these leaves, up to the one in which every tree has one block."""
    layers = [_layer(nodes, kept, 0)]
    while True:
        above = layers[-1].where(F.col("n") > BLOCK).select(
            "tree",
            F.col("block").alias("index"),
            F.ceil(F.col("n") / BLOCK).cast("bigint").alias("n"),
            F.element_at("log", -1).alias("digest"),
        )
        if above.isEmpty():
            return layers
        layers.append(_layer(above, [], len(layers)))


def _roots(layers: list[DataFrame]) -> DataFrame:
    """(tree, subroot): the last node of each tree's last block."""
    found = [
        layer.where(F.col("n") <= BLOCK).select("tree", F.element_at("log", -1).alias("subroot"))
        for layer in layers
    ]
    return reduce(DataFrame.unionByName, found)


def manifest(
    documents: DataFrame,
    fields: Sequence[str],
    tree_column: str,
    id_column: str,
    keep: Mapping[str, Column] | None = None,
) -> Manifest:
    """The log of every tree and of the one above; ``keep`` names what stays with a leaf."""
    keep = dict(keep or {})
    rows = documents.select(
        # In order of the bytes, NULL first; a name of its own for NULL.
        F.coalesce(F.concat(F.lit("="), F.col(tree_column).cast("string")), F.lit("")).alias("tree"),
        F.col(id_column).alias("id"),
        leaf(fields).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
        *[value.alias(f"kept_{name}") for name, value in keep.items()],
    )
    # Written first: texts are read once, and a row keeps its number.
    rows = stored(rows, "leaves")
    leaves = ranked(rows, "tree", ["id", "digest", "row"], "index", "n").drop("id", "row")
    layers = _layers(leaves, [f"kept_{name}" for name in keep])
    sizes = layers[0].where(F.col("block") == 0).select("tree", F.col("n").alias("leaves"))
    roots = _roots(layers).withColumn("above", F.lit(_TOP))
    numbered = ranked(roots, "above", ["tree"], "number", "n")
    trees = stored(numbered.join(sizes, "tree"), "trees")
    top = _layers(
        trees.select(
            F.col("above").alias("tree"), F.col("number").alias("index"), "n", F.col("subroot").alias("digest")
        ),
        [],
    )
    # One row at most.
    root = _roots(top).first()
    return Manifest(layers, trees.select("tree", "number", "leaves", "subroot"), top, root and root["subroot"])


def _paths(schema: T.StructType, claim: str | None, whole: bool):
    """Rows of blocks with the path of the block: one row a leaf, with the leaf's proof."""
    types = {
        "index": pa.int64(),
        "path": pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.list_(pa.string()))])),
        "leaf": pa.string(),
        "proof_sha256": pa.string(),
        "folded_root": pa.string(),
    }

    def proofs_of(log: list[str], count: int, height: int, shared: list, claims: list | None):
        out: dict[str, list] = {name: [] for name in types}
        for index, own in enumerate(siblings(log, count, height)):
            path, one = own + shared, log[position(0, index, count)]
            claimed = claims[index] if claims else None
            out["path"].append([{"place": p, "siblings": s} for p, s in path] if whole else None)
            out["leaf"].append(one)
            out["proof_sha256"].append(digest(*[node for _, nodes in path for node in nodes]))
            out["folded_root"].append(folded(one if claimed is None else claimed, path))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, block in enumerate(batch.column("block").to_pylist()):
                n = batch.column("n")[i].as_py()
                count = min(n - block * BLOCK, BLOCK)
                shared = [(p["place"], p["siblings"]) for p in batch.column("path")[i].as_py()]
                kept = batch.column("rows")[i].values
                claims = kept.field(claim).to_pylist() if claim else None
                log = batch.column("log")[i].as_py()
                found = proofs_of(log, count, height_of(n), shared, claims)
                found["index"] = range(block * BLOCK, block * BLOCK + count)
                tree = [batch.column("tree")[i].as_py()] * count
                columns = [
                    pa.array(tree, pa.string())
                    if name == "tree"
                    else pa.array(found[name], types[name])
                    if name in types
                    else kept.field(name)
                    for name in schema.names
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return run


def _descended(layers: list[DataFrame], start: DataFrame) -> DataFrame:
    """The blocks of the first layer, each with its path to the root above all layers.

    ``start`` has (tree, path) of every tree's own root.
    """
    schema = T.StructType().add("tree", T.StringType()).add("index", T.LongType()).add(_PATH)
    below = None
    for number in reversed(range(len(layers))):
        layer = layers[number]
        single = layer.where(F.col("n") <= BLOCK).select("tree", "block")
        paths = single.join(start, "tree")
        if below is not None:
            paths = paths.unionByName(below)
        blocks = layer.join(paths, ["tree", "block"])
        if number == 0:
            return blocks
        found = blocks.mapInArrow(_paths(schema, None, True), schema)
        below = stored(found.withColumnRenamed("index", "block"), f"paths_{number}")


def proofs(made: Manifest, claim: str | None = None, whole: bool = False) -> DataFrame:
    """One row a leaf: what was kept of it, tree, index, leaf, proof_sha256, folded_root.

    The proof is all siblings on the way to the root, level by level and from left to
    right; with ``whole`` they come as ``path`` (place among them, siblings). The folded
    root is computed from them and the kept column ``claim``, or the leaf where that is
    NULL.
    """
    spark = made.trees.sparkSession
    above = spark.createDataFrame([(_TOP, [])], T.StructType().add("tree", T.StringType()).add(_PATH))
    tops = _descended(made.top, above)
    schema = T.StructType().add("index", T.LongType()).add(_PATH)
    start = (
        tops.mapInArrow(_paths(schema, None, True), schema)
        .withColumnRenamed("index", "number")
        .join(made.trees, "number")
        .select("tree", "path")
    )
    blocks = _descended(made.layers, stored(start, "tree_paths"))
    kept = [f for f in made.layers[0].schema["rows"].dataType.elementType if f.name != "index"]
    schema = T.StructType([*kept]).add("tree", T.StringType()).add("index", T.LongType())
    for name in ("leaf", "proof_sha256", "folded_root"):
        schema = schema.add(name, T.StringType())
    if whole:
        schema = schema.add(_PATH)
    found = blocks.mapInArrow(_paths(schema, claim and f"kept_{claim}", whole), schema)
    found = found.join(made.trees.select("tree", "subroot"), "tree").withColumn("root", F.lit(made.root))
    names = {f.name: f.name.removeprefix("kept_") for f in kept}
    return found.withColumnsRenamed(names)
