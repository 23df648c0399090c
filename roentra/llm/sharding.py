"""Sharding by a hierarchical weighted hash tree.

A tree of regions, racks and shards with weights places each key by descending
it: at every level each child draws an exponential with its weight as rate from
a hash of the key, and the smallest draw wins, so children win in proportion to
their weights. Draws of a child depend on nothing but the key and the child.

A shard that is added later is a *graft* on a rack. It draws beside the regions with
its own weight and, where it wins, takes the key straight down its path; all other
keys descend as before. As the smallest of several exponentials is an exponential
with the sum of their rates, this equals weights that grew along that path, and keys
move only into the new shard.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from roentra.llm.ordering import running

SEED = 8
BUCKET_ROWS = 20_000


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    number: int
    weight: float = 1.0


@dataclass(frozen=True)
class Tree:
    """``shards`` were placed together; ``grafts`` came later, in this order."""

    shards: tuple[Shard, ...]
    grafts: tuple[Shard, ...] = field(default=())

    def __post_init__(self):
        numbers = [s.number for s in (*self.shards, *self.grafts)]
        if not self.shards or len(set(numbers)) < len(numbers):
            raise ValueError("a tree needs shards with numbers of their own")
        if any(s.weight <= 0 for s in (*self.shards, *self.grafts)):
            raise ValueError("weights must be positive")

    def grown(self, shard: Shard) -> Tree:
        return Tree(self.shards, (*self.grafts, shard))


def even_tree(regions: int, racks: int, shards: int) -> Tree:
    """Shards 0, 1, ... of weight one, ``shards`` in each of ``racks`` of each region."""
    numbers = iter(range(regions * racks * shards))
    return Tree(
        tuple(
            Shard(region, rack, next(numbers))
            for region in range(regions)
            for rack in range(racks)
            for _ in range(shards)
        )
    )


def _draw(key: Column, name: str, weight: float) -> Column:
    """Exponential with rate ``weight``, fixed by the key and the name."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.lit(name), key), 11)
    uniform = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(uniform) / F.lit(weight)


def _choose(options: list[tuple[Column, Column]]) -> Column:
    """The outcome of the smallest draw; the first of equal ones."""
    if len(options) == 1:
        return options[0][1]
    least = F.least(*[draw for draw, _ in options])
    return reduce(
        lambda rest, option: F.when(option[0] == least, option[1]).otherwise(rest),
        reversed(options[:-1]),
        options[-1][1],
    )


def place(tree: Tree, key: Column) -> Column:
    """The shard number of a key; a null key is placed like the word null."""
    name = F.coalesce(key.cast("string"), F.lit("null"))

    def weight(shards: list[Shard]) -> float:
        return sum(s.weight for s in shards)

    def part(shards, level: str) -> dict[int, list[Shard]]:
        found: dict[int, list[Shard]] = {}
        for s in shards:
            found.setdefault(getattr(s, level), []).append(s)
        return found

    def in_rack(shards: list[Shard]) -> Column:
        return _choose(
            [(_draw(name, f"shard {s.number}", s.weight), F.lit(s.number)) for s in shards]
        )

    def in_region(region: int, shards: list[Shard]) -> Column:
        racks = part(shards, "rack")
        return _choose(
            [
                (_draw(name, f"rack {region} {rack}", weight(own)), in_rack(own))
                for rack, own in racks.items()
            ]
        )

    options = [
        (_draw(name, f"region {region}", weight(own)), in_region(region, own))
        for region, own in part(tree.shards, "region").items()
    ]
    options += [(_draw(name, f"shard {s.number}", s.weight), F.lit(s.number)) for s in tree.grafts]
    return _choose(options).cast("int")


def assign(
    df: DataFrame, tree: Tree, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, size, text_crc32, shard, slot): one row per row of ``df``.

    ``size`` is the bytes of the text (null: none) plus 16. ``slot`` counts the rows
    of a shard from 0 without gaps, by hash bucket of the id, then id and content.
    Rows with the same id, null included, share a shard. Other columns are not read.
    """
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = df.select(
        F.col(id_col).alias("id"),
        (F.octet_length(raw) + 16).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        place(tree, F.col(id_col)).alias("shard"),
    )
    buckets = max(64, df.select(id_col).count() // BUCKET_ROWS)
    spread = F.pmod(F.xxhash64(F.lit(SEED + 1), "id"), F.lit(buckets)).alias("bucket")
    counted = running(
        rows.select("*", spread), ["shard"], "bucket", ["id", "text_crc32", "size"], F.lit(1)
    )
    return counted.select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", F.col("before").alias("slot")
    )
