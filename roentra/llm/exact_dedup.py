"""Exact duplicates by Patricia tries that own every distinct text.

Texts are dealt to tasks by length and content hash, and each task inserts the
full byte strings into a compressed radix trie whose terminal nodes store the
smallest identifier seen. Equality is decided by the bytes alone.

Three things keep this bounded. Every map task first combines its own copies in a
small trie, so a text that fills a third of the table leaves each task once. Where
these still are far more than a share, they are dealt by a salt and combined once
more before they meet. And a trie that outgrows its budget spills: its largest
subtree is cut off, its strings go back to Spark and meet again in a further round,
dealt to more tasks. Nothing lists the members of a group: each learns the label it
goes under, and labels are joined to owners.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from roentra.operators.durable import materialize

# Bytes of text in one trie before it spills; a combiner is emptied at the second figure.
TRIE_BYTES = 64_000_000
COMBINER_BYTES = 8_000_000
COMBINER_ROWS = 100_000
# Bytes of text dealt to one task in the first round.
TASK_BYTES = 16_000_000
# Slots of content, one of which is hot at so many times a mean slot's bytes, and what a row
# weighs beside its text.
SLOTS, HOT, ROW_BYTES = 1 << 16, 4, 64
OPEN = ["gid", "keep_gid", "keep_id", "group_size", "n_bytes", "text"]


class Node:
    """The bytes on the way in, children by their first byte, and at a terminal its owner."""

    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner = label, {}, None


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving: comparing slices is what bytes do fastest."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class Patricia:
    """Compressed radix trie from byte strings to owners.

    ``size`` counts the label bytes, ``held`` the owners (set by the caller).
    """

    def __init__(self):
        self.root, self.size, self.held, self.cut = Node(b""), 0, 0, set()

    def find(self, text: bytes) -> Node | None:
        """The terminal node of ``text``, made where missing; None if its subtree was cut off."""
        if text[:1] in self.cut:
            return None
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.size += len(child.label)
                return child
            end = at + len(child.label)
            if text[at:end] != child.label:
                same = _shared(child.label, text[at:end])
                fork = Node(child.label[:same])
                child.label = child.label[same:]
                fork.children[child.label[0]] = child
                node.children[text[at]] = child = fork
                end = at + same
            node, at = child, end
        return node

    @staticmethod
    def strings(top: Node, before: bytes = b"") -> Iterator[tuple[bytes, object]]:
        """(text, owner) of every terminal below ``top``; a stack, as depth has no bound."""
        stack = [(top, before + top.label)]
        while stack:
            node, text = stack.pop()
            if node.owner is not None:
                yield text, node.owner
            stack += [(c, text + c.label) for c in node.children.values()]

    @staticmethod
    def weight(top: Node) -> int:
        stack, total = [top], 0
        while stack:
            node = stack.pop()
            total += len(node.label)
            stack += node.children.values()
        return total

    def spill(self) -> list[tuple[bytes, object]]:
        """Cuts off the largest subtree of the root and returns its strings and owners."""
        weights = {k: self.weight(c) for k, c in self.root.children.items()}
        largest = max(weights, key=weights.get)
        top = self.root.children.pop(largest)
        self.cut.add(bytes([largest]))
        self.size -= weights[largest]
        strings = list(self.strings(top))
        self.held -= len(strings)
        return strings


def _smaller(a, b) -> bool:
    """Is identifier a before b? Null comes last."""
    return a is not None and (b is None or a < b)


def _local_groups(columns: DataFrame) -> DataFrame:
    """(id, gid, text_sha256, n_bytes, text, copies): every row with its group in its task.

    ``text`` and ``copies`` are set on one row of each group, the first with the
    smallest id; that row stands for the group from here on.
    """
    names = ["id", "gid", "text_sha256", "n_bytes", "text", "copies"]
    kind = T.StructType(
        [
            columns.schema["id"],
            T.StructField("gid", T.LongType()),
            T.StructField("text_sha256", T.StringType()),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("text", T.BinaryType()),
            T.StructField("copies", T.LongType()),
        ]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_gid = TaskContext.get().partitionId() << 36
        groups, trie, rows = 0, Patricia(), []

        def flush(id_type: pa.DataType) -> pa.RecordBatch:
            texts, copies = [None] * len(rows), [None] * len(rows)
            for text, (_, row, _, seen) in trie.strings(trie.root):
                texts[row], copies[row] = text, seen
            ids, gids, shas, sizes = zip(*rows)
            arrays = [
                pa.array(ids, id_type),
                pa.array(gids, pa.int64()),
                pa.array(shas, pa.string()),
                pa.array(sizes, pa.int64()),
                pa.array(texts, pa.binary()),
                pa.array(copies, pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = text.as_py()
                node = trie.find(raw)
                if node.owner is None:  # smallest id, its row, group, copies
                    node.owner = [doc, len(rows), first_gid + groups, 0]
                    groups += 1
                elif _smaller(doc, node.owner[0]):
                    node.owner[:2] = doc, len(rows)
                node.owner[3] += 1
                sha = hashlib.sha256(raw).hexdigest()
                rows.append((doc, node.owner[2], sha, len(raw)))
                if trie.size > COMBINER_BYTES or len(rows) >= COMBINER_ROWS:
                    yield flush(id_type)
                    trie, rows = Patricia(), []
        if rows:
            yield flush(id_type)

    return columns.mapInArrow(task, kind)


def _owned(groups: DataFrame, id_type: T.DataType, settle: bool = True) -> DataFrame:
    """(gid, label, keep_gid, keep_id, group_size, n_bytes, text): rows of three kinds.

    A group that met equal ones has only its gid and the ``label`` they share, which is the gid
    of one of them; such rows leave at once, so that no list of members is held. A settled text
    has a label (and no gid) and its owner. A text that was spilled, or every text unless
    ``settle``, has its label as gid, the owner so far, and the text: it goes on to a further
    round. Reads the columns gid, keep_gid, keep_id, group_size, n_bytes, text; if settled, equal
    texts must be in one partition.
    """
    kind = T.StructType(
        [
            T.StructField("gid", T.LongType()),
            T.StructField("label", T.LongType()),
            T.StructField("keep_gid", T.LongType()),
            T.StructField("keep_id", id_type),
            T.StructField("group_size", T.LongType()),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("text", T.BinaryType()),
        ]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_arrow, trie = pa.int64(), Patricia()

        def out(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.int64(), id_arrow, pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=kind.fieldNames()
            )

        def going_on(text: bytes, owner: list) -> tuple:
            keep, keep_gid, copies, label = owner
            return label, None, keep_gid, keep, copies, len(text), text

        for batch in batches:
            id_arrow = batch.schema.field(2).type
            plain = [batch.column(i).to_pylist() for i in range(4)]
            rows = []
            for gid, keep_gid, doc, copies, text in zip(*plain, batch.column(4)):
                raw = text.as_py()
                node = trie.find(raw)
                if node is None:
                    rows.append((gid, None, keep_gid, doc, copies, len(raw), raw))
                    continue
                if node.owner is None:  # smallest id, its group, copies, label
                    node.owner = [doc, keep_gid, copies, gid]
                    trie.held += 1
                else:
                    if _smaller(doc, node.owner[0]):
                        node.owner[:2] = doc, keep_gid
                    node.owner[2] += copies
                    rows.append((gid, node.owner[3], *(None,) * 5))
                # A single string always stays, however long, so every round settles some.
                while trie.size > TRIE_BYTES and trie.held > 1:
                    rows += [going_on(*x) for x in trie.spill()]
            if rows:
                yield out(rows)
        rows, size = [], 0
        for text, owner in trie.strings(trie.root):
            if settle:
                keep, keep_gid, copies, label = owner
                rows.append((None, label, keep_gid, keep, copies, None, None))
            else:
                rows.append(going_on(text, owner))
                size += len(text)
            if len(rows) >= COMBINER_ROWS or size > COMBINER_BYTES:
                yield out(rows)
                rows, size = [], 0
        if rows:
            yield out(rows)

    return groups.select("gid", "keep_gid", "keep_id", "group_size", "text").mapInArrow(task, kind)


def _dealt(groups: DataFrame, tasks: int, turn: int) -> DataFrame:
    """Rows with equal texts in one partition: by length and content hash, anew each round."""
    content = F.xxhash64(F.lit(turn), "text")
    return groups.repartition(tasks, "n_bytes", content)


def _hot_slots(groups: DataFrame) -> tuple[DataFrame, list[int], int]:
    """``groups`` with the slot of their text by content, the slots that hold ``HOT`` times a mean
    slot's bytes, and the bytes of one slot that are not hot.

    Each row weighs ``ROW_BYTES`` more than its text. At most ``SLOTS / HOT`` slots are hot, so
    they are bounded whatever the table holds.
    """
    slotted = groups.withColumn("slot", F.pmod(F.xxhash64(F.lit(-1), "text"), F.lit(SLOTS)))
    sizes = slotted.groupBy("slot").agg(F.sum(F.col("n_bytes") + ROW_BYTES).alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    bound = max(TASK_BYTES, HOT * total // SLOTS)
    return slotted, [r["slot"] for r in sizes.where(F.col("size") > bound).collect()], bound


def _merged(groups: DataFrame, tasks: int) -> tuple[DataFrame, DataFrame | None]:
    """(groups, links): texts that hold far more than their share become one group for each salted
    task, so that no task gets all groups of a hot text; (gid, label) of those merged.

    A slot in which many texts meet by chance passes through as well, to no harm.
    """
    slotted, hot, bound = _hot_slots(groups)
    if not hot:
        return groups, None
    id_type = groups.schema["keep_id"].dataType
    own = slotted.where(F.col("slot").isin(hot))
    # A task of this round gets groups of one slot up to the bound, about.
    size = own.agg(F.sum(F.col("n_bytes") + ROW_BYTES)).first()[0]
    salted = own.repartition(max(tasks, size // bound + 1), F.xxhash64("gid"))
    part = materialize(_owned(salted, id_type, settle=False), "dedup-hot")
    rest = slotted.where(~F.col("slot").isin(hot)).select(*OPEN)
    return rest.unionByName(part.where("text IS NOT NULL").select(*OPEN)), _links(part)


def _links(part: DataFrame) -> DataFrame:
    return part.where("gid IS NOT NULL AND label IS NOT NULL").select("gid", "label")


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256): one row per row of ``df``.

    Texts are equal when identical after each run of ASCII white space becomes
    one space; null counts as empty. Of equal texts one row is kept, one with the
    smallest id (of repeated rows any one; rows with a null id only if the group
    has no other, then keep_id is null). Texts of any length are compared whole; a task holds a
    few of the longest at once. An empty table gives no rows. Other columns are not read.
    """
    plain = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    columns = df.select(F.col(id_col).alias("id"), plain.cast("binary").alias("text"))
    id_type = columns.schema["id"].dataType
    rows = materialize(_local_groups(columns), "dedup-rows")
    open_ = rows.where("text IS NOT NULL").select(
        "gid",
        F.col("gid").alias("keep_gid"),
        F.col("id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        "n_bytes",
        "text",
    )
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    open_, merged = _merged(open_, least)
    size, count = open_.agg(F.sum("n_bytes"), F.count(F.lit(1))).first()
    parts = []
    # The first round also runs on an empty table, whose owners are none.
    while count or not parts:
        turn = len(parts)
        tasks = max(least, (size or 0) // TASK_BYTES + 1) * 2**turn
        part = materialize(_owned(_dealt(open_, tasks, turn), id_type), "dedup-owners")
        parts.append(part)
        open_ = part.where("text IS NOT NULL").select(*OPEN)
        size, count = open_.agg(F.sum("n_bytes"), F.count(F.lit(1))).first()
    links = [_links(part) for part in parts]
    if merged is not None:
        links.insert(0, merged)
        parts.insert(0, None)
    # From the last round to the first: a group is owned as the label it goes under, whose owner
    # is of the same round or, where its text went on, of a later one.
    owners = None
    for at in range(len(parts) - 1, -1, -1):
        if parts[at] is not None:
            settled = parts[at].where("gid IS NULL").select(
                F.col("label").alias("gid"), "keep_gid", "keep_id", "group_size"
            )
            owners = settled if owners is None else settled.unionByName(owners)
        under = links[at].join(owners.withColumnRenamed("gid", "label"), "label").drop("label")
        owners = owners.unionByName(under.select(*owners.columns))
        if at:
            owners = materialize(owners, "dedup-links")
    members = rows.select("id", "gid", "text_sha256", (F.col("copies").isNotNull()).alias("stands"))
    joined = members.join(owners, "gid")
    return joined.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("stands") & (F.col("gid") == F.col("keep_gid"))).alias("kept"),
        "text_sha256",
    )
