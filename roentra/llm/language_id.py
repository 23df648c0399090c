"""Language identification by averaged hashed subword embeddings with a linear softmax.

Subwords are all runs of one to three bytes of the lower-cased letters, hashed
into a fixed number of buckets; bytes that cannot be part of a letter count as
spaces, so runs with a space mark the ends of words. A text is the mean of its
subwords' embeddings, and a linear softmax over that mean gives the languages.

Training is stochastic gradient descent in numpy, in one task, on the subword counts of a
bounded sample of labelled documents (``max_train_docs`` dealt evenly to the labels, some
tens each at least; the counts of a document are bounded by the number of buckets, and
are made where its text is). A part of the sample is set aside to
calibrate: a temperature that makes the scores probabilities, and the score below
which a text is rejected. The model has a fixed size and travels with the job.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from roentra.operators.durable import materialize

BUCKETS = 1 << 13
WIDTH = 16
LONGEST = 3
MAX_TRAIN_DOCS = 2000
# Texts of each label at least; texts beyond the expected number that make up for an estimate.
LEAST_TRAIN_DOCS, SPARE = 32, 64
SNIPPETS, SNIPPET_BYTES = 3, 60
EPOCHS, RATE = 4, 0.5
# Share of the calibration texts that a rejection threshold may lose at most.
LOST = 0.001
BLOCK_BYTES, PIECE_BYTES = 500_000, 4_000_000
UNKNOWN = "und"

# Letters in lower case, all other ASCII as a space; bytes of longer characters stay.
LETTERS = bytes(
    b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)
MULTIPLIERS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


def _buckets(data: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The buckets of the runs of each length that begin in the first ``n`` bytes of ``data``, which
    has ``LONGEST - 1`` bytes more."""
    run = np.zeros(n, dtype=np.uint32)
    for i in range(LONGEST):
        run = (run ^ data[i : i + n].astype(np.uint32)) * np.uint32(MULTIPLIERS[i])
        run ^= run >> np.uint32(15)
        yield (run * np.uint32(MULTIPLIERS[0])) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def subword_counts(texts: list[bytes]) -> np.ndarray:
    """Row per text, column per bucket: how often its subwords fall there.

    Texts stand apart by enough spaces that no run spans two of them. A text beyond
    ``PIECE_BYTES`` is counted in pieces, each run in the piece where it begins, which gives
    the same counts.
    """
    pad = b" " * (LONGEST - 1)
    if any(len(t) > PIECE_BYTES for t in texts):
        rows = []
        for text in texts:
            data = np.frombuffer(pad + text.translate(LETTERS) + pad + pad, dtype=np.uint8)
            size, row = len(data) - len(pad), np.zeros(BUCKETS, dtype=np.int64)
            for at in range(0, size, PIECE_BYTES):
                n = min(PIECE_BYTES, size - at)
                for bucket in _buckets(data[at : at + n + len(pad)], n):
                    row += np.bincount(bucket, minlength=BUCKETS)
            rows.append(row)
        return np.stack(rows)
    padded = [pad + t.translate(LETTERS) + pad for t in texts]
    data = np.frombuffer(b"".join(padded) + pad, dtype=np.uint8)
    owner = np.repeat(np.arange(len(texts)) * BUCKETS, list(map(len, padded)))
    total = np.zeros(len(texts) * BUCKETS, dtype=np.int64)
    for bucket in _buckets(data, len(owner)):
        total += np.bincount(owner + bucket, minlength=len(total))
    return total.reshape(len(texts), BUCKETS)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    """``weights`` is embeddings times softmax matrix: the mean of embeddings is linear, too."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        counts = subword_counts(texts)
        means = (counts @ self.weights) / counts.sum(axis=1, keepdims=True)
        return _softmax((means + self.bias) / self.temperature)


Vector = tuple[np.ndarray, np.ndarray]


def vectors(text: bytes) -> list[Vector]:
    """(buckets, shares) of a whole text and of some short pieces of it, as short texts differ. Where
    the pieces begin follows from the text."""
    rng = np.random.default_rng(zlib.crc32(text))
    pieces = [text]
    for _ in range(SNIPPETS):
        at = int(rng.integers(0, max(1, len(text) - SNIPPET_BYTES)))
        pieces.append(text[at : at + SNIPPET_BYTES])
    found = []
    for row in (subword_counts([p])[0] for p in pieces):
        used = np.flatnonzero(row)
        found.append((used.astype(np.int32), (row[used] / row.sum()).astype(np.float32)))
    return found


def spared(target: np.ndarray) -> np.ndarray:
    """Which texts calibrate: of each label the fifth, tenth, ... text, or its last of two to four."""
    aside = np.zeros(len(target), dtype=bool)
    for label in np.unique(target):
        own = np.flatnonzero(target == label)
        aside[own[4::5] if len(own) > 4 else own[1:][-1:]] = True
    return aside


def fit(examples: list[list[Vector]], labels: list[str], seed: int = 7) -> Model:
    """Trains and calibrates on the vectors of each text, in the given order.

    A fifth of each label's texts calibrates (of two to four, one), and none of a label
    with a single text, which is needed to learn it. Only if no label has two texts is there
    nothing to calibrate on: the temperature stays 1 and the threshold is a guess between all
    languages.
    """
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    target = np.array([languages.index(x) for x in labels])
    aside = spared(target)

    def flat(chosen: np.ndarray) -> tuple[list[Vector], np.ndarray]:
        rows = [(v, t) for e, t, c in zip(examples, target, chosen) if c for v in e]
        return [v for v, _ in rows], np.array([t for _, t in rows])

    rows, goal = flat(~aside)
    embed = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    matrix = np.zeros((WIDTH, len(languages)), dtype=np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)
    steps, step = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)).tolist():
            used, share = rows[i]
            rate = np.float32(RATE * (1 - step / steps))
            mean = share @ embed[used]
            error = _softmax(mean @ matrix + bias)
            error[goal[i]] -= 1
            back = matrix @ error
            matrix -= rate * np.outer(mean, error)
            bias -= rate * error
            embed[used] -= np.outer(rate * len(used) ** 0.5 * share, back)
            step += 1
    model = Model(languages, (embed @ matrix).astype(np.float64), bias.astype(np.float64), 1.0, 0.0)
    # A text no more certain than a guess between all languages goes in any case.
    model.threshold = 1 / len(languages)

    checks, truth = flat(aside)
    if checks:
        logits = np.array([share @ model.weights[used] + bias for used, share in checks])
        scales = np.geomspace(0.05, 10, 60)
        own = np.arange(len(truth))
        loss = [-np.log(_softmax(logits / s)[own, truth] + 1e-12).mean() for s in scales]
        model.temperature = float(scales[int(np.argmin(loss))])
        best = _softmax(logits / model.temperature).max(axis=1)
        model.threshold = float(max(model.threshold, np.quantile(best, LOST)))
    return model


def train(
    labelled: DataFrame, text_col: str, label_col: str, max_train_docs: int = MAX_TRAIN_DOCS
) -> Model | None:
    """Fits on a bounded number of distinct texts; None if there are none with a text and a label.

    Of each label the texts with the smallest content hashes: ``max_train_docs``
    divided by the number of labels, but ``LEAST_TRAIN_DOCS`` at least, or all that
    the label has. A label so has its examples however small its share of the table is.
    """
    rows = labelled.select(
        F.col(text_col).cast("binary").alias("text"), F.col(label_col).alias("label")
    ).where("text IS NOT NULL AND label IS NOT NULL")
    place = F.shiftrightunsigned(F.xxhash64("text", "label"), 1)
    # Only about so many texts as are needed leave their tasks: those below a hash that follows
    # from the label's number of distinct texts, as copies of one may be a third of all rows.
    # The labels fit in a broadcast, as the model has a vector for each bucket and label.
    sizes = materialize(
        rows.groupBy("label").agg(F.approx_count_distinct(place).alias("distinct")), "lang-labels"
    )
    bound = max(LEAST_TRAIN_DOCS, max_train_docs // max(1, sizes.count()))
    share = F.least(F.lit(1.0), (1.5 * bound + SPARE) / F.greatest("distinct", F.lit(1)))
    cuts = sizes.select(F.col("label").alias("own"), share.alias("share"))
    few = rows.withColumn("place", place).join(F.broadcast(cuts), F.col("label") == F.col("own"))
    few = few.where(F.col("place") <= F.col("share") * float(1 << 63))
    once = few.groupBy("label", "place").agg(F.first("text").alias("text"))
    ranked = once.withColumn(
        "rank", F.row_number().over(Window.partitionBy("label").orderBy("place"))
    )
    chosen = ranked.where(F.col("rank") <= bound).select("label", "place", "text")

    # Texts of any length become a few vectors in the tasks that hold them.
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, place, text in zip(*batch.columns):
                packed = pickle.dumps(vectors(text.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label.as_py()]), pa.array([place.as_py()]), pa.array([packed])],
                    names=["label", "place", "vectors"],
                )

    counted = materialize(
        chosen.mapInArrow(count, "label string, place long, vectors binary"), "lang-vectors"
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        if rows:
            examples = [pickle.loads(packed) for *_, packed in rows]
            model = pickle.dumps(fit(examples, [label for label, *_ in rows]).__dict__)
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    found = counted.coalesce(1).mapInArrow(task, "model binary").collect()
    return Model(**pickle.loads(found[0]["model"])) if found else None


def held_out(id_col: str = "doc_id") -> Column:
    """Ids whose CRC-32 as text leaves 1 modulo 3: never learnt from."""
    rest = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3
    return F.coalesce(rest == 1, F.lit(False))


def predict(
    df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, lang_pred, score, accepted): the language of each whole text.

    A text that is null or has no letter is ``und`` with score 0 and not accepted,
    as is every text when there is no model. Otherwise the most probable language
    (the first in order of name if several tie), its calibrated probability, and
    whether that reaches the model's threshold. Null ids and repeated rows are kept,
    other columns are not read.
    """
    has_letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    columns = df.select(
        F.col(id_col).alias("id"), F.when(has_letter, F.col(text_col)).cast("binary").alias("text")
    )
    kind = T.StructType(
        [
            columns.schema["id"],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("accepted", T.BooleanType()),
        ]
    )

    def guess(texts: list[bytes]) -> list[tuple[str, float, bool]]:
        if not texts:
            return []
        chances = model.probabilities(texts)
        best = chances.argmax(axis=1)
        scores = np.clip(chances[np.arange(len(texts)), best], 0.0, 1.0).tolist()
        return [
            (model.languages[b], s, s >= model.threshold) for b, s in zip(best.tolist(), scores)
        ]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list = [(UNKNOWN, 0.0, False)] * batch.num_rows
            open_, texts, size = [], [], 0
            for i, value in enumerate(batch.column(1)):
                if model is None or not value.is_valid:
                    continue
                open_.append(i)
                texts.append(value.as_py())
                size += len(texts[-1]) + 4096
                if size >= BLOCK_BYTES:
                    for j, row in zip(open_, guess(texts)):
                        rows[j] = row
                    open_, texts, size = [], [], 0
            for j, row in zip(open_, guess(texts)):
                rows[j] = row
            langs, scores, accepted = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(accepted, pa.bool_()),
                ],
                names=["id", "lang_pred", "score", "accepted"],
            )

    return columns.mapInArrow(task, kind).withColumnRenamed("id", id_col)


def identify(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    max_train_docs: int = MAX_TRAIN_DOCS,
) -> DataFrame:
    """(id, held_out, lang_pred, score, accepted): trains on the rows that are not held out and
    predicts all."""
    learn = df.where(~held_out(id_col) & F.col(text_col).rlike(r"\p{L}"))
    model = train(learn, text_col, label_col, max_train_docs)
    found = predict(df, model, id_col, text_col)
    return found.select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score", "accepted")
