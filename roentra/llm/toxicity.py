"""Toxicity by a factorization machine over hashed terms.

Terms are the beginnings of words, three to nine bytes of a lower-cased word and the space
after it, so that short words are whole and long ones share the terms of their stems. A
document is the logarithms of its term counts, each weighted by how much the term tells the
labels apart in the sample (a floor is left for all, as a term may tell only
together with another), scaled to one length. The machine adds to a linear
model the products of all pairs of terms, through a short vector for each term: what an
insult weighs beside the mention of a group is learnt, though each alone weighs nothing.

Training is by adaptive gradient steps in numpy, in one task, on a bounded sample
(``max_train_docs``, half for each label) of term counts made where the texts are read. The
intercept is moved from the sample's share of toxic rows to the share among all labels.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from roentra.operators.durable import materialize

BITS = 18
BUCKETS = 1 << BITS
SHORTEST, LONGEST = 3, 9
FACTORS, EPOCHS, BATCH, RATE, DECAY = 4, 5, 32, 0.1, 1e-3
# A document's length; the weight of terms that tell nothing; deviations of chance alone.
LENGTH, FLOOR, CHANCE = 3.0, 0.01, 3.0
MAX_TRAIN_DOCS = 4000
# Rows of a label beyond the expected number that make up for its spread.
SPARE = 64
BLOCK_BYTES, PIECE_BYTES = 500_000, 4_000_000
MOST_LOGIT = 30.0

# ASCII letters, lower-cased before, and bytes of longer characters; all others part words.
SPACE = 32
LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else SPACE for b in range(256))

Counts = tuple[np.ndarray, np.ndarray, np.ndarray]


def _terms(data: bytes, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, buckets) of the terms of the words that begin in ``data[first:last]``, which a
    space ends and ``LONGEST`` spaces or more bytes follow."""
    letters = np.frombuffer(data, dtype=np.uint8)
    # One byte before, to see where words begin.
    low = max(0, first - 1)
    gap = np.concatenate([[True] if first == 0 else [], letters[low:last] == SPACE]).astype(bool)
    begin = first + np.flatnonzero(gap[:-1] & ~gap[1:])
    places, buckets = [], []
    run = np.zeros(len(begin), dtype=np.uint32)
    for k in range(LONGEST):
        run = (run ^ letters[begin + k]) * np.uint32(0x9E3779B1)
        run ^= run >> np.uint32(15)
        if k + 1 >= SHORTEST:
            places.append(begin)
            buckets.append((run * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS))
        ended = letters[begin + k] == SPACE
        if ended.any():
            begin, run = begin[~ended], run[~ended]
    return np.concatenate(places), np.concatenate(buckets).astype(np.int64)


def term_counts(texts: list[bytes]) -> Counts:
    """(text, bucket, count) of all terms, by text and bucket.

    A text beyond ``PIECE_BYTES`` is counted in pieces by where its words begin, which
    gives the same counts.
    """
    pad = b" " * (LONGEST + 1)
    parts: list[Counts] = []
    block: list[bytes] = []
    start = 0

    def close(end: int) -> None:
        if block:
            sizes = [len(t) + len(pad) for t in block]
            data = b"".join(t.translate(LETTERS) + pad for t in block)
            place, bucket = _terms(data, 0, len(data) - len(pad))
            owner = start + np.searchsorted(np.cumsum(sizes), place, side="right")
            key, count = np.unique(owner * BUCKETS + bucket, return_counts=True)
            parts.append((key // BUCKETS, key % BUCKETS, count))
            block.clear()

    for i, text in enumerate(texts):
        if len(text) <= PIECE_BYTES:
            block.append(text)
            continue
        close(i)
        data, total = text.translate(LETTERS) + pad, np.zeros(BUCKETS, dtype=np.int64)
        for at in range(0, len(text), PIECE_BYTES):
            _, bucket = _terms(data, at, min(at + PIECE_BYTES, len(text)))
            total += np.bincount(bucket, minlength=BUCKETS)
        used = np.flatnonzero(total)
        parts.append((np.full(len(used), i), used, total[used]))
        start = i + 1
    close(len(texts))
    if not parts:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    return tuple(np.concatenate(column) for column in zip(*parts))


@dataclass
class Machine:
    """A factorization machine over the terms that two sampled documents or more have.

    ``weight`` is what a term counts in a document, ``linear`` and ``factors`` (a row for
    each term) what it adds to the logit alone and with others; ``index`` gives the row
    of a bucket or -1.
    """

    index: np.ndarray
    weight: np.ndarray
    linear: np.ndarray
    factors: np.ndarray
    bias: float

    def entries(self, counts: Counts, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, term, value) of the known terms; the values of a document have one length."""
        owner, bucket, count = counts
        term = self.index[bucket]
        known = term >= 0
        owner, term = owner[known], term[known]
        value = self.weight[term] * np.log1p(count[known])
        size = np.sqrt(np.bincount(owner, value * value, n))
        return owner, term, value * LENGTH / size[owner]

    def logits(self, owner: np.ndarray, term: np.ndarray, value: np.ndarray, n: int):
        """(logits, sums, parts): w0 + sum w x + sum over pairs <v, v'> x x'. The pairs are half the
        square of the summed vectors less the squares of each."""
        parts = self.factors[term] * value[:, None]
        sums = np.stack([np.bincount(owner, p, n) for p in parts.T], axis=1)
        own = np.bincount(owner, (parts * parts).sum(axis=1), n)
        alone = np.bincount(owner, self.linear[term] * value, n)
        return self.bias + alone + ((sums * sums).sum(axis=1) - own) / 2, sums, parts

    def scores(self, counts: Counts, n: int) -> np.ndarray:
        logits, *_ = self.logits(*self.entries(counts, n), n)
        return 1 / (1 + np.exp(-np.clip(logits, -MOST_LOGIT, MOST_LOGIT)))


def gradients(
    machine: Machine, owner: np.ndarray, term: np.ndarray, value: np.ndarray, label: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Slopes of the mean log loss: (of the bias, terms touched, of their weights, of their vectors)."""
    n = len(label)
    logits, sums, parts = machine.logits(owner, term, value, n)
    error = (1 / (1 + np.exp(-np.clip(logits, -MOST_LOGIT, MOST_LOGIT))) - label) / n
    touched, at = np.unique(term, return_inverse=True)
    pull = error[owner] * value
    linear = np.bincount(at, pull, len(touched))
    others = (sums[owner] - parts) * pull[:, None]
    factors = np.stack([np.bincount(at, o, len(touched)) for o in others.T], axis=1)
    return float(error.sum()), touched, linear, factors


def _informed(label: np.ndarray, documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(index, weight): the terms that two documents have, and how many deviations beyond chance
    their shares of the two labels lie apart."""
    with_term = [
        np.bincount(np.concatenate([d for d, y in zip(documents, label) if y == k]), minlength=BUCKETS)
        for k in (0, 1)
    ]
    both, sizes = with_term[0] + with_term[1], [int((label == k).sum()) for k in (0, 1)]
    known = np.flatnonzero(both >= 2)
    share = both[known] / len(label)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / sizes[0] + 1 / sizes[1]))
    apart = np.abs(with_term[1][known] / sizes[1] - with_term[0][known] / sizes[0]) / spread
    beyond = np.maximum(apart - CHANCE, 0)
    index = np.full(BUCKETS, -1, dtype=np.int32)
    index[known] = np.arange(len(known))
    return index, beyond / max(1.0, beyond.max(initial=0.0)) + FLOOR


def train(
    documents: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, prior: float, seed: int = 11
) -> Machine:
    """Fits to (buckets, counts) of each document and its label 0 or 1; both labels occur.

    ``prior`` is the share of label 1 that the scores are for.
    """
    rng = np.random.default_rng(seed)
    index, weight = _informed(label, [bucket for bucket, _ in documents])
    share = label.mean()
    bias = float(np.log(share) - np.log1p(-share))
    factors = rng.normal(0, 0.05, (len(weight), FACTORS))
    machine = Machine(index, weight, np.zeros(len(weight)), factors, bias)
    seen_bias = 1e-4
    seen_linear, seen_factors = np.full(len(weight), 1e-4), np.full(factors.shape, 1e-4)
    decay = DECAY * BATCH / len(documents)
    for _ in range(EPOCHS):
        order = rng.permutation(len(documents))
        for chosen in np.array_split(order, max(1, len(order) // BATCH)):
            sizes = [len(documents[i][0]) for i in chosen]
            counts = (
                np.repeat(np.arange(len(chosen)), sizes),
                np.concatenate([documents[i][0] for i in chosen]),
                np.concatenate([documents[i][1] for i in chosen]),
            )
            entries = machine.entries(counts, len(chosen))
            slope, touched, linear, vectors = gradients(machine, *entries, label[chosen])
            linear += decay * machine.linear[touched]
            vectors += decay * machine.factors[touched]
            seen_bias += slope * slope
            seen_linear[touched] += linear * linear
            seen_factors[touched] += vectors * vectors
            machine.bias -= RATE * slope / np.sqrt(seen_bias)
            machine.linear[touched] -= RATE * linear / np.sqrt(seen_linear[touched])
            machine.factors[touched] -= RATE / 2 * vectors / np.sqrt(seen_factors[touched])
    machine.bias += float(np.log(prior) - np.log1p(-prior)) - bias
    return machine


def _examples(
    docs: DataFrame, labels: DataFrame, max_train_docs: int, id_col: str, text_col: str, label_col: str
) -> tuple[DataFrame, int, int]:
    """(label, bucket, count) of the sampled documents; how many labels are 0 and 1 in all.

    Of each label the ids with the smallest hashes are taken, half of ``max_train_docs``
    at most; of rows with one id, the one whose text has the smallest hash.
    """
    y = F.col(label_col)
    known = labels.where(F.col(id_col).isNotNull() & y.isin(0, 1)).select(
        F.col(id_col).alias("id"), y.cast("int").alias("label")
    )
    zero, one = known.agg(*[F.count_if(F.col("label") == k) for k in (0, 1)]).first()
    half = max_train_docs // 2
    place = F.shiftrightunsigned(F.xxhash64("id"), 1)
    # Only about as many rows as are needed leave their tasks.
    shares = [min(1.0, (1.5 * half + SPARE) / max(1, n)) for n in (zero, one)]
    cut = F.when(F.col("label") == 0, shares[0]).otherwise(shares[1]) * float(1 << 63)
    few = known.withColumn("place", place).where(F.col("place") <= cut).distinct()
    ranked = few.withColumn(
        "rank", F.row_number().over(Window.partitionBy("label").orderBy("place", "id"))
    )
    # At most ``max_train_docs`` rows.
    chosen = F.broadcast(materialize(ranked.where(F.col("rank") <= half).select("id", "label"), "toxic-ids"))
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    once = text.join(chosen, "id").groupBy("id", "label").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")
    )
    ready = once.select("label", F.lower("text").cast("binary").alias("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                _, bucket, count = term_counts([value.as_py()])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([label], pa.int32()),
                        pa.array([bucket.astype(np.int32)], pa.list_(pa.int32())),
                        pa.array([count], pa.list_(pa.int64())),
                    ],
                    names=["label", "bucket", "count"],
                )

    kind = "label int, bucket array<int>, count array<long>"
    return ready.mapInArrow(task, kind), zero, one


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_train_docs: int = MAX_TRAIN_DOCS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Machine | float:
    """The machine learnt from all rows of ``labels``, up to the bound; where no sampled document
    has label 0 or none has label 1, the share of label 1 among the labels (0 if there are none)."""
    rows, zero, one = _examples(docs, labels, max_train_docs, id_col, text_col, label_col)
    prior = one / max(1, zero + one)
    stored = materialize(rows, "toxic-terms")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for label, bucket, count in zip(*batch.columns):
                values = (x.values.to_numpy().astype(np.int64) for x in (bucket, count))
                found.append((label.as_py(), *values))
        # In an order that does not depend on partitions.
        found.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))
        label = np.array([r[0] for r in found])
        if len(set(label.tolist())) == 2:
            machine = pickle.dumps(train([(b, c) for _, b, c in found], label, prior).__dict__)
            yield pa.RecordBatch.from_arrays([pa.array([machine], pa.binary())], names=["machine"])

    found = stored.coalesce(1).mapInArrow(task, "machine binary").collect()
    return Machine(**pickle.loads(found[0]["machine"])) if found else prior


def held_out(id_col: str = "doc_id") -> Column:
    """Ids whose CRC-32 as text is a multiple of 5: their labels are never learnt from."""
    rest = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5
    return F.coalesce(rest == 0, F.lit(False))


def score(
    docs: DataFrame, machine: Machine | float, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score): the chance that label 1 holds, for each row and its whole text.

    Null and empty texts, and texts without a known term, get the score of a document
    without terms. Null ids and repeated rows are scored each; other columns are not read.
    """
    columns = docs.select(
        F.col(id_col).alias("id"),
        F.lower(F.coalesce(text_col, F.lit(""))).cast("binary").alias("text"),
    )
    kind = T.StructType([columns.schema["id"], T.StructField("score", T.DoubleType())])

    def scores(texts: list[bytes]) -> np.ndarray:
        if isinstance(machine, float):
            return np.full(len(texts), machine)
        return machine.scores(term_counts(texts), len(texts))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, texts, size = [np.zeros(0)], [], 0
            for value in batch.column(1):
                texts.append(value.as_py())
                size += len(texts[-1])
                if size >= BLOCK_BYTES:
                    found.append(scores(texts))
                    texts, size = [], 0
            found.append(scores(texts))
            values = pa.array(np.concatenate(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["id", "score"])

    return columns.mapInArrow(task, kind).withColumnRenamed("id", id_col)


def judge(
    docs: DataFrame,
    labels: DataFrame,
    max_train_docs: int = MAX_TRAIN_DOCS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """(id, held_out, score, predicted): learns from the labels that are not held out and scores all
    rows of ``docs``. Labels other than 0 and 1, and of ids without a document, are not learnt
    from; several labels of one id count each. An empty table gives no rows."""
    learn = labels.where(~held_out(id_col))
    machine = fit(docs, learn, max_train_docs, id_col, text_col, label_col)
    found = score(docs, machine, id_col, text_col)
    return found.select(
        id_col,
        held_out(id_col).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
