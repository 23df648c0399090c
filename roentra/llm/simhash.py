"""SimHash near-duplicates: 64-bit fingerprints, all pairs within a Hamming radius, components.

The comparison is exact and tiled. A tile holds distinct fingerprints with equal
population counts in each of four 16-bit parts. Two fingerprints that differ in
r bits have part counts that differ by r in total at most, so tile pairs beyond
that are skipped and only neighbouring tiles meet, by an equality join on the
tile's key. Inside a pair of tiles numpy takes the exclusive-or of all members
and counts bits. Tiles are cut to a bounded size, and each pair of tiles reports
a spanning forest of its links, never all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from roentra.llm.components import components
from roentra.operators.durable import materialize

SEED = 42
PARTS, PART_BITS = 4, 16
# About so many fingerprints meet as many others in one comparison.
TILE_ROWS = 2048
# Shingles whose bits are counted at a time.
CHUNK = 32_768


def fingerprint(raw: bytes, shingle: int) -> int:
    """Bit i is set when it is set in more than half of the shingle hashes; no words: zero."""
    words = raw.lower().split()  # on bytes both touch ASCII only
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(text, SEED)]
    else:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        begins = (ends - lengths)[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(text[a:b], SEED) for a, b in zip(begins, ends[shingle - 1 :].tolist())]
    values = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), CHUNK):
        bits = np.unpackbits(values[at : at + CHUNK], axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    kept = np.packbits(counts * 2 > len(values), bitorder="little")
    return int(kept.view("<u8")[0])


def fingerprints(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3
) -> DataFrame:
    """(id, fp long): the SimHash of each whole text over word shingles, as a signed 64-bit number."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in batch.column(1)),
                dtype=np.uint64,
                count=batch.num_rows,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"]
            )

    columns = df.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    )
    kind = T.StructType([columns.schema["id"], T.StructField("fp", T.LongType())])
    return columns.mapInArrow(task, kind)


def _part_counts(fp: Column) -> list[Column]:
    mask = (1 << PART_BITS) - 1
    return [
        F.bit_count(F.shiftrightunsigned(fp, PART_BITS * i).bitwiseAND(F.lit(mask).cast("long")))
        for i in range(PARTS)
    ]


def _tiles(fps: DataFrame) -> DataFrame:
    """(p0..p3, sub, members): distinct fingerprints by part counts, large cells cut by hash."""
    parts = [f"p{i}" for i in range(PARTS)]
    placed = fps.select("fp", *[c.alias(p) for c, p in zip(_part_counts(F.col("fp")), parts)])
    # At most 17^4 rows whatever the input, so broadcasting them is safe.
    cells = placed.groupBy(*parts).agg(F.ceil(F.count(F.lit(1)) / TILE_ROWS).alias("subs"))
    return (
        placed.join(F.broadcast(cells), parts)
        .withColumn("sub", F.pmod(F.xxhash64("fp"), F.col("subs")))
        .groupBy(*parts, "sub")
        .agg(F.collect_list("fp").alias("members"))
    )


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Differences of part counts that a pair within the radius can have, one of each opposite two."""
    span = range(-radius, radius + 1)
    near = (d for d in product(span, repeat=PARTS) if sum(map(abs, d)) <= radius)
    return [d for d in near if d >= (0,) * PARTS]


def _forest(a: np.ndarray, b: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph whose edges are the near pairs of a x b."""
    names = np.concatenate([a, b])
    group = np.arange(len(names))
    links: list[tuple[int, int]] = []
    step = max(1, 1_000_000 // max(1, len(b)))
    for at in range(0, len(a), step):
        near = np.bitwise_count(a[at : at + step, None] ^ b[None, :]) <= radius
        near &= a[at : at + step, None] != b[None, :]
        for i in np.flatnonzero(near.any(axis=1)).tolist():
            own = group[at + i]
            for j in (np.flatnonzero(near[i]) + len(a)).tolist():
                if group[j] != group[at + i]:
                    links.append((int(names[at + i]), int(names[j])))
                    group[group == group[j]] = own
    return links


def near_links(fps: DataFrame, radius: int) -> DataFrame:
    """(u, v): links between distinct fingerprints within the radius, enough to connect them all.

    ``fps`` has one row per distinct fingerprint in the column ``fp``.
    """
    parts = [f"p{i}" for i in range(PARTS)]
    tiles = materialize(_tiles(fps), "simhash-tiles")
    step = T.StructType([T.StructField(f"d{i}", T.IntegerType()) for i in range(PARTS)])
    steps = F.array(*[F.struct(*map(F.lit, d)).cast(step) for d in _steps(radius)])
    reach = (
        tiles.withColumn("step", F.explode(steps))
        .select(
            *[(F.col(p) + F.col(f"step.d{i}")).alias(p) for i, p in enumerate(parts)],
            F.expr(" AND ".join(f"step.d{i} = 0" for i in range(PARTS))).alias("same"),
            F.col("sub").alias("other_sub"),
            F.col("members").alias("others"),
        )
        .where(" AND ".join(f"{p} BETWEEN 0 AND {PART_BITS}" for p in parts))
    )
    met = reach.join(tiles, parts).where("NOT same OR other_sub <= sub").select("others", "members")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def side(column: pa.ListArray, i: int) -> np.ndarray:
            return column[i].values.to_numpy().view(np.uint64)

        for batch in batches:
            links = []
            for i in range(batch.num_rows):
                links += _forest(side(batch.column(0), i), side(batch.column(1), i), radius)
            ends = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["u", "v"]
            )

    return met.mapInArrow(task, "u long, v long")


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 2,
) -> DataFrame:
    """(id, fp, component_id): each row with the smallest id reachable over links of at most
    ``radius`` differing bits, itself included.

    Null texts count as empty; texts without words have fingerprint zero and link
    like any other. Equal fingerprints are one node, so copies are never paired.
    Rows with a null id are fingerprinted and connect others, but no component is
    named after them (null if there is no other id). Repeated rows are each
    returned. Other columns are not read.
    """
    table = materialize(fingerprints(df, id_col, text_col, shingle), "simhash-fingerprints")
    nodes = table.groupBy("fp").agg(F.min("id").alias("smallest"))
    roots = components(near_links(nodes.select("fp"), radius))
    labelled = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "smallest", F.coalesce("root", "fp").alias("root")
    )
    named = labelled.groupBy("root").agg(F.min("smallest").alias("component_id"))
    classes = materialize(
        labelled.join(named, "root").select(F.col("fp").alias("own"), "component_id"),
        "simhash-classes",
    )
    joined = table.join(classes, table["fp"] == classes["own"])
    return joined.select(F.col("id").alias(id_col), "fp", "component_id")
