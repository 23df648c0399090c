"""Byte-level BPE encoding and decoding by speculation and verification.

A text is cut into special tokens and words. For every word not seen before,
greedy longest match *proposes* tokens. A proposal is right exactly when every
token is what BPE makes of its own bytes and no merge crosses a seam between
neighbours before both sides are complete; the first is a property of the
vocabulary (other tokens are never proposed), the second is *verified* for all
distinct neighbour pairs of a batch at once in numpy. Only words with a failing
pair are merged step by step.

The vocabulary (a few MB whatever the corpus) is read in the driver and shipped
as a broadcast variable, so executors need no file.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

# Fixed value: the words of byte-level BPE vocabularies, white space as Unicode defines it.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
NEVER = np.iinfo(np.int64).max
# Texts are encoded in blocks of about so many bytes; the memory holds about so many chunks.
BLOCK_CHARS = 500_000
MEMORY_CHUNKS = 150_000
# Longer words are merged one at a time, by a queue instead of in step.
LONG_WORD = 200


def _byte_alphabet() -> dict[str, int]:
    """Character -> byte of the printable byte alphabet: printable Latin-1 stands for itself, the
    other bytes follow from code point 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Lookup:
    """Whole numbers from 0 to whole numbers from 0, by open addressing; finds many keys at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = 64 - max(4, int(4 * len(keys)).bit_length())
        size = 1 << (64 - self.shift)
        self.keys, self.values = np.full(size, -1, dtype=np.int64), np.full(size, -1, dtype=np.int64)
        slot, rest = self._slot(np.asarray(keys, dtype=np.int64)), np.arange(len(keys))
        while rest.size:
            free = self.keys[slot[rest]] < 0
            placed = rest[free][np.unique(slot[rest[free]], return_index=True)[1]]
            self.keys[slot[placed]], self.values[slot[placed]] = keys[placed], values[placed]
            rest = np.setdiff1d(rest, placed)
            slot[rest] = (slot[rest] + (self.keys[slot[rest]] != keys[rest])) % size

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(self.shift)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        slot = self._slot(keys)
        seen, found = self.keys[slot], self.values[slot]
        rest = np.flatnonzero((seen != keys) & (seen >= 0))
        found[seen != keys] = -1
        while rest.size:
            slot[rest] = (slot[rest] + 1) % len(self.keys)
            seen = self.keys[slot[rest]]
            hit = seen == keys[rest]
            found[rest[hit]] = self.values[slot[rest[hit]]]
            rest = rest[~hit & (seen >= 0)]
        return found


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE file, in arrays.

    ``rank[t]`` is the order of the merge that makes token t (0: a single byte),
    ``first[t]`` and ``second[t]`` what it merges.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, words = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or words.get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        if words.get("add_prefix_space") or not words.get("use_regex", True):
            raise ValueError(f"{path}: unsupported way to cut words")
        letters = _byte_alphabet()
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*model["vocab"].values(), *special.values()]) + 1
        self.size, self.special = size, special
        self.token: list[bytes] = [b""] * size
        for text, i in model["vocab"].items():
            if text not in special:
                self.token[i] = bytes(letters[c] for c in text)
        for text, i in special.items():
            self.token[i] = text.encode()

        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([model["vocab"][a] for a, _ in pairs], dtype=np.int64)
        right = np.array([model["vocab"][b] for _, b in pairs], dtype=np.int64)
        made = np.array([model["vocab"][a + b] for a, b in pairs], dtype=np.int64)
        order = np.arange(1, len(pairs) + 1)
        self.rank = np.zeros(size, dtype=np.int64)
        self.rank[made] = order
        if len(set(made.tolist())) < len(made) or (
            len(made) and (np.maximum(self.rank[left], self.rank[right]) >= order).any()
        ):
            raise ValueError(f"{path}: a token has two merges, or one that precedes its parts")
        self.first, self.second = np.full(size, -1), np.full(size, -1)
        self.first[made], self.second[made] = left, right
        self.pairs = Lookup(left * size + right, order)
        self.made = np.concatenate([[-1], made])

        # A token is usable when its last merge is the first one to cross its seam.
        usable = np.ones(size, dtype=bool)
        usable[made] = self.compatible(left, right, order)
        for t in made:  # in merge order: parts are decided before what they make
            usable[t] &= usable[self.first[t]] and usable[self.second[t]]
        usable[list(special.values())] = False
        self.single = np.array([self.token.index(bytes([b])) for b in range(256)])
        self._grow_tree({self.token[t]: t for t in np.flatnonzero(usable).tolist()})

    def _grow_tree(self, usable: dict[bytes, int]) -> None:
        """Prefix tree of the usable tokens: ``children`` by (node, byte), ``token_at`` a node."""
        nodes, keys, token_at = {b"": 0}, [], [-1]
        for token in sorted(filter(None, usable)):
            for end in range(1, len(token) + 1):
                if token[:end] not in nodes:
                    nodes[token[:end]] = len(nodes)
                    keys.append(nodes[token[: end - 1]] << 8 | token[end - 1])
                    token_at.append(usable.get(token[:end], -1))
        self.children = Lookup(np.array(keys), np.arange(1, len(nodes)))
        self.token_at = np.array(token_at)

    def compatible(self, left, right, until=NEVER) -> np.ndarray:
        """For each pair of tokens: does no merge before ``until`` cross the seam between them?

        Walks back from the finished tokens: the part that was formed last is
        undone first, so that ``a`` and ``b`` are always the two pieces that met
        at the seam at one time. They merge if their own merge comes before the
        merge that used up ``a``, and not after the one that used up ``b`` (of
        equal merges the leftmost is done first).
        """
        a, b = np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)
        a_gone = np.broadcast_to(np.asarray(until), a.shape).astype(np.int64)
        b_gone = a_gone.copy()
        good = np.ones(len(a), dtype=bool)
        open_ = np.arange(len(a))
        while open_.size:
            found = self.pairs.find(a * self.size + b)
            merge = np.where(found >= 0, found, NEVER)
            clash = (merge < a_gone) & (merge <= b_gone)
            good[open_[clash]] = False
            a_rank, b_rank = self.rank[a], self.rank[b]
            go_on = ~clash & ((a_rank > 0) | (b_rank > 0))
            undo_b = b_rank >= a_rank
            a_gone, b_gone = np.where(undo_b, a_gone, a_rank), np.where(undo_b, b_rank, b_gone)
            a, b = np.where(undo_b, a, self.second[a]), np.where(undo_b, self.first[b], b)
            open_, a, b = open_[go_on], a[go_on], b[go_on]
            a_gone, b_gone = a_gone[go_on], b_gone[go_on]
        return good

    def propose(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match over the usable tokens, for all words in step: (word, token) rows
        in text order."""
        ends = np.cumsum(np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)))
        text = np.frombuffer(b"".join(raw) + b"\0", dtype=np.uint8).astype(np.int64)
        word = np.flatnonzero(np.diff(ends, prepend=0))
        at = np.concatenate([[0], ends[:-1]])[word]
        end, node = ends[word], np.zeros(len(word), dtype=np.int64)
        token, stop = np.full(len(word), -1), at.copy()
        owners, tokens = [], []
        while word.size:
            child = np.where(at < end, self.children.find(node << 8 | text[at]), -1)
            on = child >= 0
            node, at = np.where(on, child, 0), at + on
            ends_here = np.where(on, self.token_at[child], -1)
            token = np.where(ends_here >= 0, ends_here, token)
            stop = np.where(ends_here >= 0, at, stop)
            stuck = ~on
            owners.append(word[stuck])
            tokens.append(token[stuck])
            at = np.where(stuck, stop, at)
            left = on | (at < end)
            word, at, end, node = word[left], at[left], end[left], node[left]
            token, stop = token[left], stop[left]
        owner = np.concatenate([np.zeros(0, dtype=np.int64), *owners])
        order = np.argsort(owner, kind="stable")
        return owner[order], np.concatenate([np.zeros(0, dtype=np.int64), *tokens])[order]

    def merge_all(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact BPE of all words in step, as (word, token) rows: each round does the first merge in
        rank order, the leftmost of equals, in every word that has one left."""
        counts = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        ids = self.single[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        word = np.repeat(np.arange(len(raw)), counts)
        done_words, done_ids = [], []
        rank = self._ranks(ids, word, np.arange(len(ids)))
        while ids.size:
            begins = np.flatnonzero(np.diff(word, prepend=-1))
            sizes = np.diff(np.append(begins, len(word)))
            least = np.repeat(np.minimum.reduceat(rank, begins), sizes)
            open_ = least < NEVER
            done_words.append(word[~open_])
            done_ids.append(ids[~open_])
            ids, word, rank, least = ids[open_], word[open_], rank[open_], least[open_]
            if not ids.size:
                break
            hits = np.flatnonzero(rank == least)
            hits = hits[np.diff(word[hits], prepend=-1) > 0]
            ids[hits] = self.made[rank[hits]]
            kept = np.ones(len(ids), dtype=bool)
            kept[hits + 1] = False
            moved = hits - np.arange(len(hits))  # their places once the right halves are gone
            ids, word, rank = ids[kept], word[kept], rank[kept]
            rank[moved] = self._ranks(ids, word, moved)
            inner = moved[moved > 0] - 1
            rank[inner] = self._ranks(ids, word, inner)
        words = np.concatenate([np.zeros(0, dtype=np.int64), *done_words])
        order = np.argsort(words, kind="stable")
        return words[order], np.concatenate([np.zeros(0, dtype=np.int64), *done_ids])[order]

    def _ranks(self, ids: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the merge of each given place with the next one of its word, if any."""
        after = np.minimum(at + 1, len(ids) - 1)
        found = self.pairs.find(ids[at] * self.size + ids[after])
        inside = (after > at) & (word[after] == word[at]) & (found >= 0)
        return np.where(inside, found, NEVER)

    def merge_long(self, raw: bytes) -> list[int]:
        """Exact BPE of one long word, by a queue of its merges."""
        ids = self.single[np.frombuffer(raw, dtype=np.uint8)].tolist()
        before, after = list(range(-1, len(ids) - 1)), [*range(1, len(ids)), -1]
        ranks = self.pairs.find(np.array(ids[:-1]) * self.size + np.array(ids[1:])).tolist()
        queue = [(r, i, i + 1, ids[i], ids[i + 1]) for i, r in enumerate(ranks) if r >= 0]
        heapq.heapify(queue)

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0:
                rank = int(self.pairs.find(np.array([ids[i] * self.size + ids[j]]))[0])
                if rank >= 0:
                    heapq.heappush(queue, (rank, i, j, ids[i], ids[j]))

        while queue:
            rank, i, j, x, y = heapq.heappop(queue)
            if ids[i] != x or after[i] != j or ids[j] != y:
                continue  # one of the two has merged meanwhile
            ids[i], ids[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [t for t in ids if t >= 0]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Packed token ids of each word: proposed, verified together, merged exactly where that
        fails."""
        raw = [w.encode() for w in words]
        owner, flat = self.propose(raw)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, which = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)
        wrong = np.zeros(len(raw), dtype=bool)
        wrong[owner[inner[~good[which]]]] = True
        ids = _packed(owner, flat, len(raw))
        failed = np.flatnonzero(wrong).tolist()
        short = [w for w in failed if len(raw[w]) <= LONG_WORD]
        merged = _packed(*self.merge_all([raw[w] for w in short]), len(short))
        for w, found in zip(short, merged):
            ids[w] = found
        for w in failed:
            if len(raw[w]) > LONG_WORD:
                ids[w] = np.array(self.merge_long(raw[w]), dtype=np.int32).tobytes()
        return ids


def _packed(owner: np.ndarray, ids: np.ndarray, n: int) -> list[bytes]:
    """The ids of each owner 0..n-1, as bytes of 32-bit numbers; rows are in owner order."""
    cuts = (4 * np.searchsorted(owner, np.arange(n + 1))).tolist()
    data = ids.astype(np.int32).tobytes()
    return [data[a:b] for a, b in zip(cuts, cuts[1:])]


class Encoder:
    """Encodes texts with a vocabulary and remembers a bounded number of chunks.

    Words never span a single space between two visible characters, so a text
    is first cut there, and only chunks that are new are cut into words. Ids are
    kept packed in bytes, which join fast.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.words = regex.compile(WORDS).findall
        self.chunks = re.compile(r"(?<=\S)(?= \S)").split
        marks = sorted(vocabulary.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.mark_ids = {m: np.int32(i).tobytes() for m, i in vocabulary.special.items()}
        self.after_space: dict[str, bytes | None] = {}
        self.as_is: dict[str, bytes] = {}

    def _learn(self, spaced: set[str], plain: set[str]) -> None:
        """Ids of all chunks: ``spaced`` follow a space, ``plain`` are whole. Of the former, those
        that white space begins or ends get None: there a cut at the space may be wrong."""
        for memory in (self.after_space, self.as_is):
            if len(memory) > MEMORY_CHUNKS:
                memory.clear()
        spaced, plain = spaced - self.after_space.keys(), plain - self.as_is.keys()
        safe = [c for c in spaced if c and not c[0].isspace() and not c[-1].isspace()]
        self.after_space.update(dict.fromkeys(spaced))
        # One pass over all of them: of the words found, those with a space begin a chunk.
        found = self.words(" " + " ".join(safe)) if safe else []
        begins = [i for i, w in enumerate(found) if w[0] == " "]
        cut = [*(found[a:b] for a, b in zip(begins, [*begins[1:], len(found)]))]
        cut += map(self.words, plain)
        distinct = list(set().union(found, *cut[len(safe) :]))
        ids = dict(zip(distinct, self.vocabulary.encode_words(distinct)))
        joined = [b"".join(map(ids.__getitem__, words)) for words in cut]
        self.after_space.update(zip(safe, joined))
        self.as_is.update(zip(plain, joined[len(safe) :]))

    def _whole(self, texts: list[str]) -> list[bytes]:
        """Ids of texts with special tokens or unusual white space."""
        parts = [self.marks.split(t) if self.marks else [t] for t in texts]
        cut = [[self.chunks(p) for p in one[::2]] for one in parts]
        self._learn(set(), set().union(*chain.from_iterable(cut)))
        rows = []
        for one, between in zip(parts, cut):
            ids = []
            for chunks, mark in zip(between, [*one[1::2], None]):
                ids += map(self.as_is.__getitem__, chunks)
                if mark is not None:
                    ids.append(self.mark_ids[mark])
            rows.append(b"".join(ids))
        return rows

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text, as bytes of 32-bit numbers."""
        marked = [self.marks is not None and bool(self.marks.search(t)) for t in texts]
        cut = [[] if m else t.split(" ") for t, m in zip(texts, marked)]
        self._learn(set().union(*(c[1:] for c in cut)), {c[0] for c in cut if c})
        after, rows = self.after_space.__getitem__, []
        for chunks in cut:
            first = chunks[0] if chunks else ""
            if not chunks or (len(chunks) > 1 and (not first or first[-1].isspace())):
                rows.append(None)
                continue
            try:
                rows.append(b"".join([self.as_is[first], *map(after, chunks[1:])]))
            except TypeError:  # a chunk has None
                rows.append(None)
        others = [i for i, r in enumerate(rows) if r is None]
        for i, ids in zip(others, self._whole([texts[i] for i in others])):
            rows[i] = ids
        return rows


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
    """(keys, texts) of a batch, about ``BLOCK_CHARS`` bytes of text at a time."""
    sizes = pa.compute.binary_length(batch.column(1)).to_numpy()
    which = np.cumsum(sizes) // BLOCK_CHARS
    cuts = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a).to_pylist()


def _as_lists(rows: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(r) // 4 for r in rows)], dtype=np.int32)
    flat = np.frombuffer(b"".join(rows), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def decode_ids(token: list[bytes], ids: np.ndarray) -> str:
    """Text of one array of token ids; bytes that are not UTF-8 become the replacement character."""
    if len(ids) and (ids.min() < 0 or ids.max() >= len(token)):
        raise ValueError("a token id is outside the vocabulary")
    return b"".join([token[i] for i in ids.tolist()]).decode("utf-8", "replace")


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).alias("id"), text.alias("text"))


def encode(
    df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids array<int>): the token ids of each whole text, one row per row of ``df``.

    A null text counts as empty and has no ids; rows that repeat are encoded each;
    null ids are kept. Other columns are not read, so their names cannot clash.
    """
    return encode_and_decode(df, vocabulary, id_col, text_col).select(id_col, "ids")


def encode_and_decode(
    df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids, decoded): as ``encode``, with the text that the ids stand for, in one pass over
    the texts."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        token = encoder.vocabulary.token
        for batch in batches:
            for keys, texts in _blocks(batch):
                rows = encoder.encode(texts)
                decoded = [decode_ids(token, np.frombuffer(r, dtype=np.int32)) for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [keys, _as_lists(rows), pa.array(decoded, pa.string())],
                    names=["id", "ids", "decoded"],
                )

    columns = _texts(df, id_col, text_col)
    kind = T.StructType(
        [
            columns.schema["id"],
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.StringType()),
        ]
    )
    return columns.mapInArrow(task, kind).withColumnRenamed("id", id_col)


def decode(
    df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """(id, text): the text of each array of token ids, special tokens included.

    Null and empty arrays give the empty text; an id outside the vocabulary ends the job.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary.token)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value
        for batch in batches:
            texts = [
                decode_ids(token, np.array(ids.as_py() or [], dtype=np.int64))
                for ids in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["id", "text"]
            )

    columns = df.select(F.col(id_col).alias("id"), ids_col)
    kind = T.StructType([columns.schema["id"], T.StructField("text", T.StringType())])
    return columns.mapInArrow(task, kind).withColumnRenamed("id", id_col)
