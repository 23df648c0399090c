"""Training in epochs of mini-batches: a layer of features under a head, in two phases.

The first phase trains the head on a fixed layer, the second both, at a rate that falls
along a cosine. Each step is one Spark job: every task sums the gradient of its Arrow batches
of one mini-batch, the sums are merged in a tree, and the driver, which holds only the weights,
takes an Adam step; the next job carries the new weights. Features are written once, dealt to
the mini-batches by a hash of the row, so that a step reads its own files only and an epoch
reads the table once. After every epoch the whole state is written; a run that stops goes on
from its last whole epoch and ends with the same weights.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roentra import schemas
from roentra.functions import scores
from roentra.operators import metrics
from roentra.operators.classifier import image_features
from roentra.operators.combine import combine, count_tasks
from roentra.operators.durable import materialize
from roentra.operators.labels import class_weight

# Decay of the running means of gradients and of their squares, and the least divisor.
MEAN_DECAY, SQUARE_DECAY, LEAST = 0.9, 0.999, 1e-8

STATE = """run_name string, epoch long, position long, weights array<double>, means array<double>,
    squares array<double>, steps long, best double, best_epoch long, best_weights array<double>,
    log array<struct<run_name: string, step: long, metric: string, value: double>>"""


@dataclass(frozen=True)
class Phase:
    """Some epochs at a rate, with the layer under the head fixed or not."""

    run_name: str
    epochs: int
    rate: float
    frozen: bool = False
    cosine: bool = False

    def rate_at(self, epoch: int) -> float:
        share = (1 + math.cos(math.pi * epoch / self.epochs)) / 2 if self.cosine else 1.0
        return self.rate * share


# Names, lengths and rates of the two phases.
PHASES = (
    Phase("phase1_frozen_backbone", 3, 1e-3, frozen=True),
    Phase("phase2_fine_tune", 8, 1e-4, cosine=True),
)


@dataclass(frozen=True)
class Network:
    """logit = tanh(x W + b) u + c; ``weights`` holds W row by row, then b, u and c."""

    inputs: int
    units: int
    weights: np.ndarray

    @staticmethod
    def start(inputs: int, units: int, seed: int = 42) -> Network:
        rng = np.random.default_rng(seed)
        layer = rng.normal(0, 1 / math.sqrt(inputs), inputs * units)
        head = rng.normal(0, 1 / math.sqrt(units), units)
        return Network(inputs, units, np.concatenate([layer, np.zeros(units), head, [0.0]]))

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        n = self.inputs * self.units
        w, b, u, c = np.split(self.weights, [n, n + self.units, n + 2 * self.units])
        return w.reshape(self.inputs, self.units), b, u, float(c[0])

    @property
    def head(self) -> slice:
        """Where the head's weights are."""
        return slice((self.inputs + 1) * self.units, None)

    def logits(self, x: np.ndarray) -> np.ndarray:
        w, b, u, c = self.parts()
        return np.tanh(x @ w + b) @ u + c

    def gradient(
        self, x: np.ndarray, y: np.ndarray, pos_weight: float, frozen: bool
    ) -> tuple[float, np.ndarray]:
        """(loss, gradient) summed over rows; zero for a fixed layer."""
        w, b, u, c = self.parts()
        hidden = np.tanh(x @ w + b)
        logit = hidden @ u + c
        weight = np.where(y == 1, pos_weight, 1.0)
        margin = np.where(y == 1, logit, -logit)
        loss = float((weight * np.logaddexp(0, -margin)).sum())
        error = np.where(y == 1, -weight, weight) / (1 + np.exp(np.clip(margin, -700, 700)))
        head = [error @ hidden, [error.sum()]]
        if frozen:
            layer = [np.zeros(self.inputs * self.units), np.zeros(self.units)]
        else:
            back = np.outer(error, u) * (1 - hidden * hidden)
            layer = [(x.T @ back).ravel(), back.sum(axis=0)]
        return loss, np.concatenate([*layer, *head])


def _rows(batch: pa.RecordBatch, inputs: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of a batch (label, features)."""
    flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, inputs), batch.column(0).to_numpy(zero_copy_only=False)


def batch_gradient(
    rows: DataFrame, network: Network, pos_weight: float, tasks: int, frozen: bool = False
) -> tuple[int, float, np.ndarray] | None:
    """(rows, summed loss, summed gradient) of rows (label, features); None without rows."""

    def make(batch: pa.RecordBatch) -> tuple[int, float, np.ndarray]:
        x, y = _rows(batch, network.inputs)
        return (len(y), *network.gradient(x, y, pos_weight, frozen))

    def merge(a: tuple, b: tuple) -> tuple:
        return a[0] + b[0], a[1] + b[1], a[2] + b[2]

    return combine(rows.select("label", "features"), tasks, make, merge)


def dealt_rows(
    examples: DataFrame, key: Column, batches: int, features: Column | None = None
) -> DataFrame:
    """(label, features, batch): usable examples, dealt to mini-batches by a hash of ``key``.

    Rows without a label 0 or 1 or without features are left out.
    """
    made = image_features(F.col("pixels")) if features is None else features
    rows = examples.where(F.col("label").isin(0, 1)).select(
        F.col("label").cast("int").alias("label"),
        made.alias("features"),
        F.pmod(F.xxhash64(key), F.lit(batches)).cast("int").alias("batch"),
    )
    return rows.where(F.col("features").isNotNull())


def deal(
    examples: DataFrame, key: Column, batches: int, features: Column | None = None
) -> DataFrame:
    """``dealt_rows``, written once to the shared folder, a directory for each mini-batch."""
    return materialize(dealt_rows(examples, key, batches, features), "batches", ["batch"])


def as_table(spark: SparkSession, network: Network) -> DataFrame:
    """One row: inputs, units, weights."""
    row = (network.inputs, network.units, network.weights.tolist())
    return spark.createDataFrame([row], "inputs int, units int, weights array<double>")


def from_table(table: DataFrame) -> Network:
    row = table.first()
    return Network(row["inputs"], row["units"], np.array(row["weights"]))


@dataclass(frozen=True)
class State:
    """Where a run is after some whole epochs: what a checkpoint holds."""

    network: Network
    means: np.ndarray
    squares: np.ndarray
    steps: int
    best: float
    best_epoch: int
    best_weights: np.ndarray
    log: tuple = ()

    @staticmethod
    def start(network: Network) -> State:
        none = np.zeros_like(network.weights)
        return State(network, none, none, 0, 0.0, -1, network.weights)

    def restarted(self) -> State:
        """With the running means of a new optimizer."""
        none = np.zeros_like(self.means)
        return replace(self, means=none, squares=none, steps=0)

    def step(self, gradient: np.ndarray, rate: float, only: slice) -> State:
        """One Adam step of the weights in ``only``."""
        means, squares = self.means.copy(), self.squares.copy()
        weights, g = self.network.weights.copy(), gradient[only]
        means[only] = MEAN_DECAY * means[only] + (1 - MEAN_DECAY) * g
        squares[only] = SQUARE_DECAY * squares[only] + (1 - SQUARE_DECAY) * g * g
        steps = self.steps + 1
        mean = means[only] / (1 - MEAN_DECAY**steps)
        square = squares[only] / (1 - SQUARE_DECAY**steps)
        weights[only] -= rate * mean / (np.sqrt(square) + LEAST)
        network = replace(self.network, weights=weights)
        return replace(self, network=network, means=means, squares=squares, steps=steps)


class Checkpoints:
    """One table row for every whole epoch, in a folder that all executors reach.

    A row is a file of its own that is committed whole, so a run that stops while writing
    has no row for that epoch. Without a folder nothing is kept.
    """

    def __init__(self, spark: SparkSession, path: str | None):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(STATE).parquet(f"{self.path}/*")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], STATE)

    def write(self, position: int, phase: Phase, epoch: int, state: State) -> None:
        if self.path is None:
            return
        values = asdict(state) | {"run_name": phase.run_name, "epoch": epoch, "position": position}
        values["weights"] = values.pop("network")["weights"]
        row = {k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in values.items()}
        names = self.spark.createDataFrame([], STATE).columns
        table = self.spark.createDataFrame([tuple(row[c] for c in names)], STATE)
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/position={position:05d}")

    def last(self, network: Network) -> tuple[int, State] | None:
        """The newest (position, state)."""
        row = None if self.path is None else self.rows().orderBy(F.desc("position")).first()
        if row is None:
            return None
        if len(row["weights"]) != len(network.weights):
            raise ValueError("the checkpoints are of another network")
        arrays = {c: np.array(row[c]) for c in ("means", "squares", "best_weights")}
        others = {c: row[c] for c in ("steps", "best", "best_epoch")}
        return row["position"], State(
            replace(network, weights=np.array(row["weights"])),
            log=tuple(tuple(r) for r in row["log"]),
            **arrays,
            **others,
        )


@dataclass
class Trained:
    """The best network, the last one, and (run_name, step, metric, value) of every epoch."""

    best: Network
    last: Network
    pos_weight: float
    run_metrics: DataFrame


def score(network: Network, rows: DataFrame) -> DataFrame:
    """Add ``logit`` and ``probability`` to rows with ``features``; NULL features give NULL."""

    @F.pandas_udf("double")
    def logit(batch: pd.Series) -> pd.Series:
        known = batch.notna().to_numpy()
        out = np.full(len(batch), np.nan)
        if known.any():
            out[known] = network.logits(np.stack(batch[known].to_numpy()).astype(np.float64))
        return pd.Series(out).astype("Float64").where(known, None)

    scored = rows.withColumn("logit", logit("features"))
    return scored.withColumn("probability", scores.sigmoid(F.col("logit")))


def evaluate(network: Network, rows: DataFrame, pos_weight: float) -> tuple[float, float | None]:
    """(mean weighted loss, AUROC) of rows (label, features), which are scored once.

    The loss is a sum of decimals, the same to the last bit in whatever order the rows meet.
    """
    scored = materialize(score(network, rows).drop("features"), "scored")
    loss = metrics.weighted_log_loss(scored, pos_weight, exact=True).first()["loss"]
    return loss, metrics.auroc(scored).first()["auroc"]


def order_of_batches(batches: int, position: int, seed: int) -> list[int]:
    """In which order an epoch reads the mini-batches."""
    return np.random.default_rng([seed, position]).permutation(batches).tolist()


def train(
    rows: DataFrame,
    val: DataFrame,
    network: Network,
    phases: Sequence[Phase] = PHASES,
    checkpoints: str | None = None,
    stop_after: int | None = None,
    seed: int = 42,
) -> Trained:
    """Trains on ``rows`` (from ``deal``) and keeps the epoch that is strictly best on ``val``
    (label, features), as to the AUROC, among the epochs of the last phase.

    Each phase starts a new optimizer. ``checkpoints`` is a folder of this run alone: whole
    epochs found there are not trained again. ``stop_after`` ends the run after so many epochs
    in all.
    """
    spark = rows.sparkSession
    balance = class_weight(rows).first()
    pos_weight = balance["pos_weight"]
    if not pos_weight:
        raise ValueError("training rows must hold both classes")
    batches = [r["batch"] for r in rows.select("batch").distinct().orderBy("batch").collect()]
    tasks = count_tasks(rows)
    kept = Checkpoints(spark, checkpoints)
    done, state = kept.last(network) or (-1, State.start(network))

    plan = [(phase, epoch) for phase in phases for epoch in range(phase.epochs)]
    for position, (phase, epoch) in enumerate(plan[:stop_after]):
        if position <= done:
            continue
        if epoch == 0:
            state = state.restarted()
        rate, seen, total = phase.rate_at(epoch), 0, 0.0
        only = state.network.head if phase.frozen else slice(None)
        for at in order_of_batches(len(batches), position, seed):
            part = rows.where(F.col("batch") == batches[at])
            found = batch_gradient(part, state.network, pos_weight, tasks, phase.frozen)
            n, loss, gradient = found
            seen, total = seen + n, total + loss
            state = state.step(gradient / n, rate, only)
        val_loss, val_auroc = evaluate(state.network, val, pos_weight)
        if val_auroc is None:
            raise ValueError("validation rows must hold both classes")
        found = {
            "learning_rate": rate,
            "train_rows": float(seen),
            "train_loss": total / seen,
            "val_loss": val_loss,
            "val_auroc": val_auroc,
        }
        if phase is phases[-1] and val_auroc > state.best:
            found["best_val_auroc"] = val_auroc
            state = replace(
                state, best=val_auroc, best_epoch=epoch, best_weights=state.network.weights
            )
        if epoch == 0:
            found["pos_weight"] = pos_weight
        log = [(phase.run_name, epoch, metric, value) for metric, value in found.items()]
        state = replace(state, log=(*state.log, *log))
        kept.write(position, phase, epoch, state)

    best = state.best_weights if state.best_epoch >= 0 else state.network.weights
    return Trained(
        replace(state.network, weights=best),
        state.network,
        pos_weight,
        spark.createDataFrame(list(state.log), schemas.RUN_METRICS),
    )
