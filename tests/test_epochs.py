import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roentra.operators import epochs, metrics
from roentra.operators.combine import combine, count_tasks

ROWS = "id long, label int, features array<double>"


def examples(n, seed=0):
    """Positive where two entries have one sign: no linear model tells."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    return [(i, int(b), a.tolist()) for i, (a, b) in enumerate(zip(x, y))]


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, ROWS).repartition(parts, "id")


@pytest.fixture(scope="module")
def dealt(spark):
    make = lambda rows, n: epochs.deal(frame(spark, rows), F.col("id"), n, F.col("features"))
    return make(examples(300), 3), make(examples(100, 1), 1)


def loss_of(network, x, y, pos_weight):
    z = network.logits(x)
    return float(np.where(y == 1, pos_weight * np.log1p(np.exp(-z)), np.log1p(np.exp(z))).sum())


@pytest.mark.parametrize("frozen", [False, True])
def test_gradient_equals_differences(frozen):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(9, 4)), rng.integers(0, 2, 9)
    network = epochs.Network.start(4, 3)
    loss, gradient = network.gradient(x, y, 2.5, frozen)
    assert loss == pytest.approx(loss_of(network, x, y, 2.5))
    for i in range(len(gradient)):
        if frozen and i < network.head.start:
            assert gradient[i] == 0
            continue
        ends = []
        for step in (1e-6, -1e-6):
            weights = network.weights.copy()
            weights[i] += step
            ends.append(loss_of(epochs.Network(4, 3, weights), x, y, 2.5))
        assert gradient[i] == pytest.approx((ends[0] - ends[1]) / 2e-6, abs=1e-6)


def test_gradient_of_tasks_equals_one_sum(spark, dealt):
    rows, _ = dealt
    network = epochs.Network.start(4, 3)
    n, loss, gradient = epochs.batch_gradient(rows, network, 2.0, count_tasks(rows))
    local = rows.select("label", "features").collect()
    x, y = np.array([r["features"] for r in local]), np.array([r["label"] for r in local])
    expected = network.gradient(x, y, 2.0, False)
    assert n == 300 and loss == pytest.approx(expected[0])
    assert gradient == pytest.approx(expected[1])
    assert epochs.batch_gradient(rows.where("batch = 99"), network, 2.0, 3) is None


def test_a_step_is_adam():
    state = epochs.State.start(epochs.Network(1, 1, np.array([1.0, 2.0, 3.0, 4.0])))
    mean = square = 0.0
    weight = 3.0
    for t, slope in enumerate([0.5, -2.0, 0.25], 1):
        state = state.step(np.array([9.0, 9.0, slope, 0.0]), 0.1, state.network.head)
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        weight -= 0.1 * (mean / (1 - 0.9**t)) / (math.sqrt(square / (1 - 0.999**t)) + 1e-8)
        # The fixed layer stays.
        assert state.network.weights == pytest.approx([1.0, 2.0, weight, 4.0])


def test_rates():
    first, second = epochs.PHASES
    assert [first.rate_at(e) for e in range(3)] == [1e-3] * 3
    assert second.rate_at(0) == 1e-4 and second.rate_at(4) == pytest.approx(5e-5)


PHASES = (epochs.Phase("one", 2, 1e-2, frozen=True), epochs.Phase("two", 4, 3e-2, cosine=True))


def test_a_stopped_run_goes_on_to_the_same_end(spark, dealt, tmp_path):
    network = epochs.Network.start(4, 6)
    whole = epochs.train(*dealt, network, PHASES)
    path = str(tmp_path / "checkpoints")
    for stop in (1, 4):
        epochs.train(*dealt, network, PHASES, checkpoints=path, stop_after=stop)
        assert epochs.Checkpoints(spark, path).rows().count() == stop
    # An epoch whose checkpoint was not committed is trained again.
    (tmp_path / "checkpoints" / "position=00004" / "_temporary").mkdir(parents=True)
    resumed = epochs.train(*dealt, network, PHASES, checkpoints=path)
    assert (resumed.last.weights == whole.last.weights).all()
    assert (resumed.best.weights == whole.best.weights).all()
    a, b = (sorted(map(tuple, t.run_metrics.collect())) for t in (whole, resumed))
    assert a == b
    # Nothing is left to do, and the same comes back.
    again = epochs.train(*dealt, network, PHASES, checkpoints=path)
    assert (again.best.weights == whole.best.weights).all()
    with pytest.raises(ValueError, match="another network"):
        epochs.train(*dealt, epochs.Network.start(4, 5), PHASES, checkpoints=path)


def test_both_phases_learn_and_the_best_epoch_is_kept(dealt):
    rows, val = dealt
    phases = (epochs.Phase("one", 1, 1e-2, frozen=True), epochs.Phase("two", 14, 0.1, cosine=True))
    network = epochs.Network.start(4, 12)
    trained = epochs.train(rows, val, network, phases)
    log = trained.run_metrics
    values = {(r["run_name"], r["metric"], r["step"]): r["value"] for r in log.collect()}
    assert {k[2] for k in values if k[:2] == ("two", "val_auroc")} == set(range(14))
    best = {r["run_name"]: r for r in metrics.best_epoch(metrics.metric_values(log, "val_auroc")).collect()}
    kept = max(k[2] for k in values if k[1] == "best_val_auroc")
    assert best["two"]["best_step"] == kept
    assert best["two"]["best"] == values["two", "best_val_auroc", kept]
    assert epochs.evaluate(trained.best, val, trained.pos_weight)[1] == best["two"]["best"] > 0.9
    assert values["two", "train_loss", 13] < values["one", "train_loss", 0]
    assert values["one", "train_rows", 0] == 300
    # The first phase left the layer as it was.
    first = epochs.train(rows, val, network, phases[:1]).last.weights
    assert (first[: network.head.start] == network.weights[: network.head.start]).all()
    assert (first[network.head] != network.weights[network.head]).any()


def test_unusable_rows_are_left_out(spark):
    rows = [(1, 1, [1.0]), (2, None, [1.0]), (3, 7, [1.0]), (4, 0, None), (5, 0, [2.0])]
    dealt = epochs.deal(frame(spark, rows), F.col("id"), 2, F.col("features"))
    assert sorted(r["features"][0] for r in dealt.collect()) == [1.0, 2.0]
    with pytest.raises(ValueError, match="both classes"):
        epochs.train(dealt.where("label = 1"), dealt, epochs.Network.start(1, 1))
    scored = epochs.score(epochs.Network.start(1, 2), frame(spark, rows)).collect()
    assert [r["id"] for r in scored if r["probability"] is None] == [4]


def test_networks_are_kept_as_tables(spark):
    network = epochs.Network.start(3, 2)
    back = epochs.from_table(epochs.as_table(spark, network))
    assert (back.inputs, back.units) == (3, 2) and (back.weights == network.weights).all()


@pytest.mark.parametrize("tasks", [1, 7, 100])
def test_payloads_are_merged_in_order(spark, tasks):
    """Also where fewer tasks were counted than there are."""
    df = spark.range(0, 200, 1, 7)
    found = combine(df, tasks, lambda b: b.column(0).to_pylist(), lambda a, b: a + b)
    assert found == list(range(200))
    assert combine(df.where("id < 0"), tasks, len, max) is None
