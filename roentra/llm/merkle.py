"""Merkle manifest of a table: a tree of SHA-256 digests, with proofs checked by midstates.

Every row is a leaf. The leaves of a group, in order, form a tree in which each run
of ``FAN`` consecutive nodes has one parent, and the groups' subroots, in order of
the group, form one more tree above them. A parent is the hash of its children's
digests, one after the other. While it is built, it keeps a copy of the hash state
before each child slot; to fold a replaced child, the state of its slot is resumed
with the replacement and the siblings to its right, so nothing on its left is hashed again.

Work is cut into chunks of ``CHUNK`` consecutive nodes, the subtrees of three levels.
Upwards, each round hashes the chunks of a table of nodes to a table a few thousand
times smaller, until each group has one node. Downwards, each chunk gets the siblings
on its way to the root (its path) and hands them to its nodes; the leaves' chunks fold
their replaced leaves. A state cannot travel, so a chunk keeps its own states
in its task, and prepares one state for each step of its path. The largest group is
spread over all its chunks, and no task holds more than one chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from roentra.operators.durable import materialize

FAN, LEVELS = 16, 3
CHUNK = FAN**LEVELS
# Rows of a batch that leaves a task.
BATCH = 4096

NODES = "tree string, rank long, n long, digest binary"
STEP = "array<struct<left: binary, right: binary>>"
PATHS = f"tree string, rank long, n long, path {STEP}"
ARROW_STEP = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))
FOLDED = (
    "doc_id long, leaf binary, subroot binary, root binary, proof binary, folded binary"
)


class Parent:
    """The hash of a run of children, with the state before each slot."""

    def __init__(self, children: list[str]):
        self.children = children
        state = hashlib.sha256()
        self.states = []
        for child in children:
            self.states.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()

    def fold(self, slot: int, replaced: str) -> str:
        """The digest with another child in the slot."""
        state = self.states[slot].copy()
        state.update((replaced + "".join(self.children[slot + 1 :])).encode())
        return state.hexdigest()


class Subtree:
    """The parents over at most ``CHUNK`` consecutive nodes of a tree of ``n`` nodes."""

    def __init__(self, digests: list[str], n: int):
        self.levels: list[list[Parent]] = []
        level = digests
        for _ in range(LEVELS):
            if n == 1:
                break
            parents = [Parent(level[i : i + FAN]) for i in range(0, len(level), FAN)]
            self.levels.append(parents)
            level = [p.digest for p in parents]
            n = -(-n // FAN)
        (self.top,) = level

    def steps(self, at: int) -> Iterator[tuple[Parent, int]]:
        """The parents on the way from node ``at`` to the top, with the slot in each."""
        for parents in self.levels:
            yield parents[at // FAN], at % FAN
            at //= FAN

    def siblings(self, at: int) -> list[tuple[str, str]]:
        """(left, right) siblings of each step, joined."""
        return [
            ("".join(p.children[:slot]), "".join(p.children[slot + 1 :]))
            for p, slot in self.steps(at)
        ]

    def fold(self, at: int, replaced: str) -> str:
        for parent, slot in self.steps(at):
            replaced = parent.fold(slot, replaced)
        return replaced


class Path:
    """The steps from the top of a chunk to the root, each with its state before the slot."""

    def __init__(self, steps: list[tuple[str, str]]):
        self.steps = [(hashlib.sha256(left.encode()), right) for left, right in steps]
        self.siblings = "".join(left + right for left, right in steps)

    def fold(self, replaced: str) -> str:
        for before, right in self.steps:
            state = before.copy()
            state.update((replaced + right).encode())
            replaced = state.hexdigest()
        return replaced


@dataclass
class Chunk:
    """Consecutive nodes of one tree, as they come out of a sorted partition."""

    tree: str
    first: int
    n: int
    rows: list[tuple]
    path: list[tuple[str, str]]
    tops: tuple

    def subtree(self, digest: int) -> Subtree:
        return Subtree([row[digest].hex() for row in self.rows], self.n)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """Chunks of rows (tree, rank, n, path, ...) sorted by tree, chunk and then path before nodes;
    a row with a path has no rank of its own but its chunk's first."""
    open_: Chunk | None = None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for tree, rank, n, path, *rest in zip(*columns):
            first = rank - rank % CHUNK
            if open_ is None or (open_.tree, open_.first) != (tree, first):
                if open_ is not None:
                    yield open_
                open_ = Chunk(tree, first, 0, [], [], ())
            if path is None:
                open_.n = n
                open_.rows.append((rank, *rest))
            else:
                open_.path = [(s["left"].hex(), s["right"].hex()) for s in path]
                open_.tops = tuple(rest)
    if open_ is not None:
        yield open_


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows (tree, rank, n, path, ...) with each chunk whole, in order, in one partition."""
    chunk = F.floor(F.col("rank") / CHUNK)
    return (
        rows.withColumn("chunk", chunk)
        .repartition("tree", "chunk")
        .sortWithinPartitions("tree", "chunk", F.col("path").isNull(), "rank")
        .drop("chunk")
    )


def _batched(
    work: Callable[[Chunk], Iterator[tuple]], schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(v, f.type) for v, f in zip(zip(*rows), schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for chunk in _chunks(batches):
            rows += work(chunk)
            if len(rows) >= BATCH:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)

    return task


def _hashed(chunk: Chunk) -> Iterator[tuple]:
    """The node that a chunk is in the next round."""
    top = bytes.fromhex(chunk.subtree(1).top)
    yield chunk.tree, chunk.first // CHUNK, -(-chunk.n // CHUNK), top


def _handed_down(chunk: Chunk) -> Iterator[tuple]:
    """The path of each node of a chunk, as the path of the chunk that it was a round before."""
    subtree = chunk.subtree(1)
    for row in chunk.rows:
        steps = [*subtree.siblings(row[0] - chunk.first), *chunk.path]
        path = [{"left": bytes.fromhex(a), "right": bytes.fromhex(b)} for a, b in steps]
        yield chunk.tree, row[0] * CHUNK, None, path


def _folded(chunk: Chunk) -> Iterator[tuple]:
    """Each leaf with its proof, and the root that its replacement gives."""
    subtree, path = chunk.subtree(1), Path(chunk.path)
    subroot, root, _ = chunk.tops
    for rank, leaf, replaced, doc_id in chunk.rows:
        at = rank - chunk.first
        own = "".join(left + right for left, right in subtree.siblings(at))
        proof = hashlib.sha256((own + path.siblings).encode()).digest()
        folded = path.fold(subtree.fold(at, (leaf if replaced is None else replaced).hex()))
        yield doc_id, leaf, subroot, root, proof, bytes.fromhex(folded)


NODE_SCHEMA = pa.schema(
    [("tree", pa.string()), ("rank", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())]
)
PATH_SCHEMA = pa.schema(
    [("tree", pa.string()), ("rank", pa.int64()), ("n", pa.int64()), ("path", ARROW_STEP)]
)
FOLDED_SCHEMA = pa.schema(
    [("doc_id", pa.int64())]
    + [(c, pa.binary()) for c in ("leaf", "subroot", "root", "proof", "folded")]
)


def _ranked(df: DataFrame, tree: Column, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``tree``, ``rank`` (from 0 in the order of its tree) and ``n`` (rows of the tree).

    One sort by range over all rows, so that a tree with a third of them is in many
    partitions; rows are numbered where they lie, and only the counts of a tree in each
    partition pass through a window.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for value in batch.column(0).to_pylist():
                at = at + 1 if value == last else 0
                last = value
                places.append(at)
            parts = pa.array([part] * len(places), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, parts, pa.array(places, pa.int64())],
                names=[*batch.schema.names, "part", "place"],
            )

    keyed = df.select(tree.alias("tree"), *[F.col(c) for c in df.columns if c != "tree"])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema)
    placed = materialize(
        keyed.sort("tree", *order).mapInArrow(number, f"{kinds}, part int, place long"), name
    )
    counts = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("here"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "tree",
        "part",
        F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"),
        F.sum("here").over(whole).alias("n"),
    )
    ranked = placed.join(counts, ["tree", "part"])
    return ranked.withColumn("rank", F.col("before") + F.col("place")).drop("part", "place", "before")


def _rounds(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Tables of nodes (tree, rank, n, digest), each with the chunks of the one before hashed;
    every tree has one node in the last."""
    most = nodes.agg(F.max("n")).first()[0] or 1
    rounds = [nodes.select("tree", "rank", "n", "digest")]
    while most > 1:
        rows = rounds[-1].select("tree", "rank", "n", F.lit(None).cast(STEP).alias("path"), "digest")
        hashed = _dealt(rows).mapInArrow(_batched(_hashed, NODE_SCHEMA), NODES)
        rounds.append(materialize(hashed, name))
        most = -(-most // CHUNK)
    return rounds


def _paths(rounds: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """The path of each chunk of the first round, from the path of each tree's last node, which is
    the only chunk of the round before."""
    paths = tops
    for nodes in reversed(rounds[1:-1]):
        rows = nodes.select("tree", "rank", "n", F.lit(None).cast(STEP).alias("path"), "digest")
        known = paths.withColumn("digest", F.lit(None).cast("binary"))
        both = _dealt(rows.unionByName(known))
        paths = materialize(both.mapInArrow(_batched(_handed_down, PATH_SCHEMA), PATHS), name)
    return paths


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    size = F.octet_length(text).cast("string")
    return F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 of the fields, as binary."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256))


def manifest(
    docs: DataFrame,
    replaced: Column,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """(id, leaf, subroot, root, proof, folded), digests as binary: one row for each row of ``docs``.

    A leaf hashes ``fields``, groups are the values of ``group_col`` (null is one, and the
    first), leaves ascend by id. ``proof`` hashes the siblings from the leaf to the root,
    ``folded`` is the root that follows from ``replaced``, the text in place of
    ``text_col`` where it is not null, and from the untouched siblings. Null ids come before
    all others and rows of one id follow each other by leaf digest, so repeated rows
    are leaves side by side. Null and empty texts have leaves of their own; an empty table
    gives no rows. A text is hashed where it is read, at any length; other columns than
    ``fields`` are not read.
    """
    swapped = [replaced if c == text_col else F.col(c) for c in fields]
    # Null first, then the groups in the order of their bytes.
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-"))
    leaves = materialize(
        docs.select(
            group.alias("tree"),
            F.col(id_col).cast("long").alias("doc_id"),
            leaf_digest([F.col(c) for c in fields]).alias("digest"),
            F.when(replaced.isNotNull(), leaf_digest(swapped)).alias("replaced"),
        ),
        "merkle-leaves",
    )
    order = [F.asc_nulls_first("doc_id"), F.asc("digest")]
    ranked = materialize(_ranked(leaves, F.col("tree"), order, "merkle-placed"), "merkle-ranked")
    rounds = _rounds(ranked, "merkle-nodes")

    # One tree over the subroots.
    subroots = rounds[-1].select(F.col("tree").alias("group"), "digest")
    above = materialize(
        _ranked(subroots, F.lit("top"), [F.asc("group")], "merkle-groups"), "merkle-tops"
    )
    upper = _rounds(above, "merkle-upper")
    last = upper[-1].first()
    root = F.lit(bytes(last["digest"]) if last else None).cast("binary")
    empty = F.array().cast(STEP)
    start = upper[-1].select("tree", F.lit(0).cast("long").alias("rank"), "n", empty.alias("path"))
    chunks = _paths(upper, start, "merkle-upper-paths")
    # A chunk of the top tree hands its path to the groups in it.
    rows = above.select("tree", "rank", "n", F.lit(None).cast(STEP).alias("path"), "digest", "group")
    known = chunks.select(
        "*", F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("group")
    )

    def to_groups(chunk: Chunk) -> Iterator[tuple]:
        subtree = chunk.subtree(1)
        for rank, digest, group in chunk.rows:
            steps = [*subtree.siblings(rank - chunk.first), *chunk.path]
            path = [{"left": bytes.fromhex(a), "right": bytes.fromhex(b)} for a, b in steps]
            yield group, 0, None, path, digest

    schema = PATH_SCHEMA.append(pa.field("subroot", pa.binary()))
    groups = materialize(
        _dealt(rows.unionByName(known)).mapInArrow(
            _batched(to_groups, schema), f"{PATHS}, subroot binary"
        ),
        "merkle-group-paths",
    )
    paths = _paths(rounds, groups.select("tree", "rank", "n", "path"), "merkle-paths")

    # The leaves meet the paths of their chunks; subroot and root come with the path.
    known = paths.join(groups.select("tree", "subroot"), "tree").select(
        "tree",
        "rank",
        "n",
        "path",
        F.col("subroot").alias("digest"),
        root.alias("replaced"),
        F.lit(None).cast("long").alias("doc_id"),
    )
    rows = ranked.select(
        "tree", "rank", "n", F.lit(None).cast(STEP).alias("path"), "digest", "replaced", "doc_id"
    )
    found = _dealt(rows.unionByName(known)).mapInArrow(_batched(_folded, FOLDED_SCHEMA), FOLDED)
    return found.withColumnRenamed("doc_id", id_col)


def tampered(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text with A-Z lower-cased where 5 divides the CRC-32 of the id as text; else null."""
    upper = "".join(map(chr, range(65, 91)))
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0
    return F.when(hit, F.translate(F.col(text_col), upper, upper.lower()))
