"""Substring dedup: every window of words that also starts elsewhere is removed.

Each document's words are hashed, and Rabin-Karp prefix sums give the hash of
every window of consecutive words. Spark counts the hashes: tasks pack those of a
block of documents by bucket of hash, buckets are shuffled, and a bucket answers
each block with the windows whose hash it saw more than once. Answers return to
their block, where overlapping windows merge into maximal spans of words.

Sizes: a window costs about nine bytes of shuffle (a 64-bit hash, and its place
as a small difference). Equal windows of a block are sent once, so a passage in a
third of all documents reaches its bucket once a block. The number of buckets
follows the input. The bucket comes from a second hash that is independent of the
first, so that two windows are taken for one only if 64 bits and the bucket agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from roentra.operators.durable import materialize

# Odd multipliers of the two polynomials modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
# Words of a block of documents (a longer document is a block of its own), bytes of text a bucket.
BLOCK_WORDS = 1_000_000
BUCKET_BYTES = 4_000_000
LEAST_BUCKETS = 512
# Hash slots by which most texts that lose nothing are kept out of the last shuffle.
SLOTS = 1 << 20

MESSAGE = (
    "bucket int, block long, hashes binary, places binary, many binary, "
    "doc_ids binary, doc_texts binary, doc_words binary, doc_shas binary, known binary"
)
COLUMNS = [c.split()[0] for c in MESSAGE.split(", ")]


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, dtype=np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, dtype=np.uint64)


class Rolling:
    """Rabin-Karp hashes of all windows of a given number of words, modulo 2^64."""

    def __init__(self, window: int):
        self.window, self.powers = window, [(np.ones(0, np.uint64),) * 2] * 2

    def _power(self, which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.powers[which][0]) < n:
            base = BASES[which]
            self.powers[which] = (_powers(base, n), _powers(pow(base, -1, 1 << 64), n))
        up, down = self.powers[which]
        return up[:n], down[:n]

    def hashes(self, words: np.ndarray, which: int) -> np.ndarray:
        """Hash of the window that starts at each word, for one document's word hashes."""
        n = len(words) - self.window + 1
        up, down = self._power(which, len(words))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up, dtype=np.uint64)])
        found = (sums[self.window :] - sums[:n]) * down[:n]
        found ^= found >> np.uint64(31)
        found *= np.uint64(0xBF58476D1CE4E5B9)
        return found ^ (found >> np.uint64(29))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def _pack_places(places: np.ndarray) -> bytes:
    """Increasing places as differences, two bytes each where they fit, else four."""
    steps = np.diff(places, prepend=0)
    small = not len(steps) or steps.max() < 1 << 16
    return (b"2" if small else b"4") + steps.astype("<u2" if small else "<u4").tobytes()


def _unpack_places(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed, "<u2" if packed[:1] == b"2" else "<u4", offset=1))


class Block:
    """Window hashes of consecutive documents, packed into one message for each bucket."""

    def __init__(self, number: int, rolling: Rolling, buckets: int):
        self.number, self.rolling, self.buckets = number, rolling, buckets
        self.docs, self.first, self.second, self.words = [], [], [], 0

    def add(self, doc_id: int | None, text_hash: int, raw: bytes) -> None:
        words = raw.split()  # on bytes: at ASCII white space
        sha = hashlib.sha256(b" ".join(words)).digest()
        self.docs.append((doc_id, text_hash, len(words), sha))
        self.words += max(1, len(words))
        if len(words) >= self.rolling.window:
            hashes = _word_hashes(words)
            self.first.append(self.rolling.hashes(hashes, 0))
            self.second.append(self.rolling.hashes(hashes, 1))

    def messages(self) -> pa.RecordBatch:
        empty = np.zeros(0, np.uint64)
        hashes = np.concatenate([empty, *self.first])
        bucket = (np.concatenate([empty, *self.second]) % np.uint64(self.buckets)).astype(np.int32)
        order = np.lexsort((hashes, bucket))
        h, b = hashes[order], bucket[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (b[1:] != b[:-1])
        begins = np.flatnonzero(new)
        sizes = np.diff(np.append(begins, len(order)))
        many = sizes > 1
        known = np.sort(order[np.repeat(many, sizes)])
        # One window stands for its equals in this block; by bucket, in text order.
        stands = order[begins]
        by_place = np.lexsort((stands, b[begins]))
        stands, many = stands[by_place], many[by_place]
        cuts = np.searchsorted(bucket[stands], np.arange(self.buckets + 1))
        rows = [
            (
                i,
                self.number,
                hashes[stands[x:y]].tobytes(),
                _pack_places(stands[x:y]),
                np.packbits(many[x:y]).tobytes(),
                *(None,) * 5,
            )
            for i, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
            if y > x
        ]
        ids, texts, counts, shas = zip(*self.docs)
        listed = [
            np.array([i if i is not None else 0 for i in ids], np.int64).tobytes()
            + np.packbits([i is not None for i in ids]).tobytes(),
            np.array(texts, np.int64).tobytes(),
            np.array(counts, np.int32).tobytes(),
            b"".join(shas),
            known.astype(np.int32).tobytes(),
        ]
        # The number's halves are the task and the block's place in it: spread the lists by both.
        at = ((self.number >> 32) * 31 + (self.number & 0xFFFFFFFF)) % self.buckets
        rows.append((at, self.number, *(None,) * 3, *listed))
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32(), pa.int64()])]
        columns += [pa.array(c, pa.binary()) for c in list(zip(*rows))[2:]]
        return pa.RecordBatch.from_arrays(columns, names=COLUMNS)


def _hash_windows(texts: DataFrame, window: int, buckets: int) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rolling = TaskContext.get().partitionId() << 32, Rolling(window)
        block = Block(number, rolling, buckets)
        for batch in batches:
            for doc, text, raw in zip(*map(batch.column, range(3))):
                block.add(doc.as_py(), text.as_py(), raw.as_py())
                if block.words >= BLOCK_WORDS:
                    yield block.messages()
                    number += 1
                    block = Block(number, rolling, buckets)
        if block.docs:
            yield block.messages()

    return texts.mapInArrow(task, MESSAGE)


def _count_bucket(messages: pa.Table) -> pa.Table:
    """For each block the places of its windows that other blocks have too; lists of documents
    pass through."""
    listed = messages.filter(pa.compute.is_valid(messages["doc_ids"]))
    sent = messages.filter(pa.compute.is_valid(messages["hashes"]))
    answers = []
    if sent.num_rows:
        parts = [np.frombuffer(x, np.uint64) for x in sent["hashes"].to_pylist()]
        many = [
            np.unpackbits(np.frombuffer(x, np.uint8), count=len(p)).astype(bool)
            for x, p in zip(sent["many"].to_pylist(), parts)
        ]
        _, which, seen = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        # Windows known to repeat in a block need no answer, but count for the others.
        asked = (seen[which] > 1) & ~np.concatenate(many)
        ends = np.cumsum([0, *map(len, parts)])
        blocks = sent["block"].to_pylist()
        for block, packed, a, b in zip(blocks, sent["places"].to_pylist(), ends, ends[1:]):
            hit = np.flatnonzero(asked[a:b])
            if len(hit):
                answers.append((block, _unpack_places(packed)[hit].astype(np.int32).tobytes()))
    replies = pa.table(
        {
            "block": pa.array([a[0] for a in answers], pa.int64()),
            "known": pa.array([a[1] for a in answers], pa.binary()),
        }
    )
    names = ["block", "known", *COLUMNS[5:9]]
    blank = pa.nulls(replies.num_rows, pa.binary())
    for name in names[2:]:
        replies = replies.append_column(name, blank)
    return pa.concat_tables([replies, listed.select(names)])


def _merge_block(rows: pa.Table, window: int) -> pa.Table:
    """One row for each document of a block: its words, the hash of them all, and the spans of
    words to remove (null: none)."""
    head = rows.filter(pa.compute.is_valid(rows["doc_ids"])).to_pylist()[0]
    n = len(head["doc_shas"]) // 32
    ids = np.frombuffer(head["doc_ids"], np.int64, count=n).tolist()
    has_id = np.unpackbits(np.frombuffer(head["doc_ids"], np.uint8, offset=8 * n), count=n)
    words = np.frombuffer(head["doc_words"], np.int32).astype(np.int64)
    windows = np.maximum(0, words - window + 1)
    ends = np.cumsum(windows)
    starts = np.unique(np.concatenate([np.frombuffer(x, np.int32) for x in rows["known"].to_pylist()]))
    owner = np.searchsorted(ends, starts, side="right")
    word = starts - (ends - windows)[owner]
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (word[1:] > word[:-1] + window)
    begins = np.flatnonzero(fresh)
    last = np.append(begins[1:], len(starts))[: len(begins)] - 1
    spans = np.stack([word[begins], word[last] + window], axis=1).astype(np.int32)
    cuts = np.searchsorted(owner[begins], np.arange(n + 1)).tolist()
    removed = np.zeros(n, np.int64)
    np.add.at(removed, owner[begins], spans[:, 1] - spans[:, 0])
    shas = [head["doc_shas"][32 * i : 32 * i + 32].hex() for i in range(n)]
    return pa.table(
        {
            "id": pa.array([i if ok else None for i, ok in zip(ids, has_id)], pa.int64()),
            "text_hash": pa.array(np.frombuffer(head["doc_texts"], np.int64)),
            "n_words": pa.array(words),
            "n_removed": pa.array(removed),
            "sha": pa.array(shas, pa.string()),
            "spans": pa.array(
                [spans[a:b].tobytes() if b > a else None for a, b in zip(cuts, cuts[1:])], pa.binary()
            ),
        }
    )


def repeated_spans(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35
) -> DataFrame:
    """(id, text_hash, n_words, n_removed, sha, spans): one row per row of ``df``.

    ``spans`` holds the word ranges [begin, end) covered by windows whose words also
    start anywhere else, as packed 32-bit pairs, null where there are none; ``sha`` is
    the SHA-256 of all words joined by a space. Written to the shared folder.
    Integer ids; null ids, repeated rows and null texts (no words) are kept; a copy
    of a whole text repeats all its windows. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(text).alias("text_hash"),
        text.cast("binary").alias("raw"),
    )
    size = df.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, size // BUCKET_BYTES)
    answers = (
        _hash_windows(texts, window, buckets)
        .groupBy("bucket")
        .applyInArrow(
            lambda table: _count_bucket(table),
            "block long, known binary, doc_ids binary, doc_texts binary, doc_words binary, "
            "doc_shas binary",
        )
    )
    return materialize(
        answers.groupBy("block").applyInArrow(
            lambda table: _merge_block(table, window),
            "id long, text_hash long, n_words long, n_removed long, sha string, spans binary",
        ),
        "substring-spans",
    )


def _slot(doc_id: str, text_hash: str) -> Column:
    return F.pmod(F.xxhash64(doc_id, text_hash), F.lit(SLOTS)).alias("slot")


def remove_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35
) -> DataFrame:
    """(id, n_words, n_removed, kept, kept_sha256): ``kept`` is the words that stay, joined by a
    space, and null where nothing is removed (the text stays as it is).

    Only documents that lose words meet their text again, by id and content, so
    repeated ids cannot mix.
    """
    found = repeated_spans(df, id_col, text_col, window)
    whole = found.where("spans IS NULL").select(
        F.col("id").alias(id_col),
        "n_words",
        "n_removed",
        F.lit(None).cast("string").alias("kept"),
        F.col("sha").alias("kept_sha256"),
    )
    cut = found.where("spans IS NOT NULL").dropDuplicates(["id", "text_hash"])
    cut = cut.select(F.col("id").alias("own_id"), "text_hash", "n_words", "n_removed", "spans")
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(text).alias("own_hash"),
        text.cast("binary").alias("raw"),
    )
    # At most SLOTS rows, so they may be broadcast; with more documents to cut they fill up, and
    # more texts are shuffled for nothing, but none is missed.
    slots = cut.select(_slot("own_id", "text_hash")).distinct()
    texts = texts.withColumn("slot", _slot("id", "own_hash")).join(
        F.broadcast(slots), "slot", "left_semi"
    )
    same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("own_hash") == F.col("text_hash"))
    met = texts.join(cut, same).select("id", "n_words", "n_removed", "raw", "spans")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, shas = [], []
            for raw, spans in zip(batch.column(3), batch.column(4)):
                words, at, left = raw.as_py().split(), 0, []
                for begin, end in np.frombuffer(spans.as_py(), np.int32).reshape(-1, 2).tolist():
                    left += words[at:begin]
                    at = end
                text = b" ".join([*left, *words[at:]])
                kept.append(text.decode())
                shas.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(kept, pa.string()), pa.array(shas, pa.string())],
                names=["id", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    kind = "id long, n_words long, n_removed long, kept string, kept_sha256 string"
    return whole.unionByName(met.mapInArrow(task, kind).withColumnRenamed("id", id_col))
