import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.catalog.queries import _vectors
from corpusloom.functions.head import Features, with_scores
from corpusloom.operators import evaluate
from corpusloom.operators.gradient import evaluate_pass, gradient
from corpusloom.operators.optimizer import HeadState, adamw, initial_weights
from corpusloom.plans import report, state as saved
from corpusloom.plans.train import fit, history_frame, write_steps
from corpusloom.session import scratch_path

DENSE = Features("embedding", 64)


@pytest.fixture(scope="module")
def vectors(spark):
    return _vectors(spark, "/root/testdata/sf0.001").cache()


def dense_reference(rows, weights):
    """Loss and gradient of the training rows in plain numpy."""
    train = [r for r in rows if r.split == "train"]
    x = np.array([list(r.embedding) + [1.0] for r in train])
    y = np.array([r.label for r in train])
    z = x @ weights.T
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    loss = -np.log(p[np.arange(len(y)), y]).mean()
    p[np.arange(len(y)), y] -= 1
    return loss, p.T @ x / len(y), (z.argmax(1) == y).mean()


def test_gradient_matches_numpy(vectors):
    weights = initial_weights(2, 64)
    loss, grad, acc = dense_reference(vectors.collect(), weights)
    got, metrics = evaluate_pass(vectors, DENSE, weights)
    assert np.allclose(got, grad, atol=1e-12)
    assert metrics["train"][1:] == pytest.approx((loss, acc))
    frame = np.zeros_like(weights)
    for r in gradient(vectors, DENSE, weights).collect():
        frame[r.k, r.j] = r.gradient
    assert np.allclose(frame, grad, atol=1e-12)


def test_hashed_features_match_dense_counts(spark):
    rng = np.random.default_rng(0)
    dim, data = 7, []
    for i in range(60):
        ids = [int(v) for v in rng.integers(100, 130, rng.integers(1, 9))] + [0, 0]
        counts = np.bincount([v % dim for v in ids if v], minlength=dim).astype(float).tolist()
        data.append(("train" if i % 3 else "test", int(rng.integers(0, 2)), ids, counts))
    frame = spark.createDataFrame(data, "split string, label int, ids array<int>, counts array<double>")
    weights = initial_weights(2, dim)
    a = evaluate_pass(frame, Features("ids", dim, hashed=True), weights)
    b = evaluate_pass(frame, Features("counts", dim), weights)
    assert np.allclose(a[0], b[0]) and a[1].keys() == b[1].keys()
    scored = [with_scores(frame, f, weights).agg(F.sum("loss"), F.sum("pred")).first()
              for f in (Features("ids", dim, hashed=True), Features("counts", dim))]
    assert scored[0][0] == pytest.approx(scored[1][0]) and scored[0][1] == scored[1][1]


def test_zero_weights_lose_ln_two(vectors):
    loss = with_scores(vectors, DENSE, np.zeros((2, 65))).select("loss", "pred")
    assert all(r.loss == pytest.approx(math.log(2)) and r.pred == 0 for r in loss.collect())


def test_column_scores_match_the_pass(vectors):
    weights = initial_weights(2, 64)
    _, metrics = evaluate_pass(vectors, DENSE, weights)
    for r in evaluate.by_dataset(with_scores(vectors, DENSE, weights)).collect():
        assert (r["rows"], r.loss, r.accuracy) == pytest.approx(metrics[r.split])


def test_damaged_features_are_an_error(spark):
    from pyspark.errors import PythonException

    rows = [("train", 0, [1.0, 2.0]), ("train", 1, [1.0]), ("train", 1, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame(rows, "split string, label int, x array<double>")
    with pytest.raises(PythonException, match="must have 2 numbers"):
        evaluate_pass(frame, Features("x", 2), initial_weights(2, 2))
    null = spark.createDataFrame([("train", 0, None)], "split string, label int, x array<double>")
    with pytest.raises(PythonException, match="null x"):
        with_scores(null, Features("x", 2), initial_weights(2, 2)).collect()


def test_adamw_against_a_scalar_loop():
    state, w, m, v = HeadState.fresh(np.array([[0.3]])), 0.3, 0.0, 0.0
    for t, g in enumerate([0.5, -0.2, 0.1], 1):
        state = adamw(state, np.array([[g]]), lr=0.01)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.01 * 0.01 * w - 0.01 * (m / (1 - 0.9**t)) / (math.sqrt(v / (1 - 0.999**t)) + 1e-8)
        assert state.weights[0, 0] == pytest.approx(w, abs=1e-15)


def test_frozen_weights_stay(vectors):
    mask = np.zeros((2, 65), dtype=bool)
    mask[:, -1] = True
    start = initial_weights(2, 64)
    state, _ = fit(vectors, DENSE, epochs=2, lr=0.1, trainable=mask, weights=start)
    assert np.array_equal(state.weights[:, :-1], start[:, :-1])
    assert not np.array_equal(state.weights[:, -1], start[:, -1])


def test_history_has_every_series_once_per_epoch(vectors):
    _, series = fit(vectors, DENSE, epochs=3, lr=0.05)
    names = ["imdb_eval_acc", "imdb_eval_losses", "sst2_eval_acc", "sst2_eval_losses", "train_losses"]
    assert [(e, s) for e, s, _ in series] == [(e, s) for e in (1, 2, 3) for s in names]
    losses = [v for _, s, v in series if s == "train_losses"]
    assert losses[0] > losses[1] > losses[2]


def test_epoch_scores_are_those_of_its_final_weights(vectors):
    state, series = fit(vectors, DENSE, epochs=2, lr=0.05)
    _, metrics = evaluate_pass(vectors, DENSE, state.weights)
    assert dict(((e, s), v) for e, s, v in series)[(2, "imdb_eval_losses")] == pytest.approx(metrics["test"][1])


@pytest.mark.parametrize("steps", [1, 2])
def test_resume_equals_straight(spark, vectors, steps):
    data = vectors.withColumn("batch_id", F.col("doc_id"))
    data = write_steps(data, scratch_path(spark, "steps"), steps) if steps > 1 else data
    path = scratch_path(spark, "resume")
    straight, all_series = fit(data, DENSE, epochs=4, lr=0.05, steps_per_epoch=steps)
    fit(data, DENSE, epochs=2, lr=0.05, steps_per_epoch=steps, run_id="r", folder=path)
    resumed, series = fit(data, DENSE, epochs=4, lr=0.05, steps_per_epoch=steps, run_id="r", folder=path)
    assert np.allclose(straight.weights, resumed.weights, atol=1e-9) and resumed.step == 4 * steps
    assert [r[:2] for r in series] == [r[:2] for r in all_series]
    assert np.allclose([r[2] for r in series], [r[2] for r in all_series], atol=1e-9)
    assert saved.latest_epoch(spark, path, "r") == 4
    stored = saved.history(spark, path, "r")
    assert sorted((r.epoch, r.series) for r in stored.collect()) == [r[:2] for r in all_series]


def test_resume_from_the_middle_scores_the_open_epoch(spark, vectors):
    """A driver lost after epoch 1 of 3 leaves that epoch's test scores to the next pass."""
    path = scratch_path(spark, "lost")
    _, straight = fit(vectors, DENSE, epochs=3, lr=0.05)
    calls = []

    class Lost(Exception):
        pass

    def dying_save(*args, **kwargs):
        original(*args, **kwargs)
        calls.append(1)
        raise Lost

    original, saved.save = saved.save, dying_save
    try:
        with pytest.raises(Lost):
            fit(vectors, DENSE, epochs=3, lr=0.05, run_id="r", folder=path)
    finally:
        saved.save = original
    _, series = fit(vectors, DENSE, epochs=3, lr=0.05, run_id="r", folder=path)
    assert [r[:2] for r in series] == [r[:2] for r in straight]
    assert np.allclose([r[2] for r in series], [r[2] for r in straight], atol=1e-9)


def test_saving_an_epoch_again_replaces_it(spark):
    path = scratch_path(spark, "again")
    for value in (1.0, 2.0):
        saved.save(spark, path, "r", 1, HeadState.fresh(np.full((2, 3), value)), [(1, "train_losses", value)])
    state, series = saved.load(spark, path, "r", 1)
    assert np.all(state.weights == 2.0) and series == [(1, "train_losses", 2.0)]
    assert saved.read(spark, path, "weights").count() == 6


def test_trained_head_reaches_logistic_regression(spark, vectors):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    train = vectors.filter("split = 'train'").select(
        F.col("label").cast("double").alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    model = LogisticRegression(regParam=0.0, maxIter=200, standardization=False).fit(train)
    best = model.evaluate(train)
    weights = np.zeros((2, 65))
    weights[1, :-1], weights[1, -1] = model.coefficients.toArray(), model.intercept
    _, metrics = evaluate_pass(vectors, DENSE, weights)
    # The optimum of the same loss: its gradient is flat and no trained head beats it.
    grad, _ = evaluate_pass(vectors, DENSE, weights)
    assert np.abs(grad).max() < 1e-3 and best.accuracy == pytest.approx(metrics["train"][2])
    _, series = fit(vectors, DENSE, epochs=30, lr=0.1)
    last = [v for _, s, v in series if s == "train_losses"][-1]
    assert metrics["train"][1] - 1e-9 <= last < metrics["train"][1] + 0.1


def test_nan_reaches_the_history(spark, vectors):
    weights = initial_weights(2, 64)
    weights[0, 3] = float("nan")
    _, series = fit(vectors, DENSE, epochs=1, weights=weights)
    losses = {s: v for _, s, v in series}
    assert math.isnan(losses["train_losses"]) and math.isnan(losses["imdb_eval_losses"])
    path = scratch_path(spark, "nan")
    saved.save(spark, path, "r", 1, HeadState.fresh(weights), series)
    assert math.isnan(saved.history(spark, path, "r").filter("series = 'train_losses'").first().value)


def test_missing_test_split_has_no_scores(vectors):
    _, series = fit(vectors.filter("split = 'train'"), DENSE, epochs=2, lr=0.05)
    assert {s for _, s, _ in series} == {"train_losses"}


PREDICTIONS = "doc_id long, split string, shard int, batch_id long, label int, pred int, loss double"


def test_accuracy_cases(spark):
    five = spark.createDataFrame([(i, "test", 0, 0, 1, int(i > 0), 0.5) for i in range(5)], PREDICTIONS)
    assert evaluate.accuracy(five).first().accuracy == pytest.approx(0.8)
    assert evaluate.accuracy(five.filter("false")).first().accuracy is None
    rows = [(s * 4 + i, "test", s, 0, 1, int(i < right), 0.5) for s, right in ((0, 3), (1, 1)) for i in range(4)]
    two = spark.createDataFrame(rows, PREDICTIONS)
    assert evaluate.accuracy(two).first().accuracy == 0.5
    assert sorted(r.accuracy for r in evaluate.accuracy(two, "shard").collect()) == [0.25, 0.75]


def test_batch_loss_is_a_mean_of_means(spark):
    rows = [(0, "test", 0, 0, 1, 1, 1.0), (1, "test", 0, 0, 1, 1, 3.0), (2, "test", 1, 0, 1, 1, 5.0), (3, "test", 0, 1, 1, 1, 7.0)]
    frame = spark.createDataFrame(rows, PREDICTIONS)
    assert evaluate.batch_loss(frame, "split").first().loss == ((2 + 5) / 2 + 7) / 2
    broken = frame.withColumn("loss", F.when(F.col("doc_id") == 3, float("nan")).otherwise(F.col("loss")))
    assert math.isnan(evaluate.batch_loss(broken, "split").first().loss)


def test_curves(spark):
    series = [(1, "train_losses", 0.5), (1, "imdb_eval_losses", 0.4), (1, "sst2_eval_losses", 0.6), (1, "imdb_eval_acc", 0.9)]
    wide = report.wide_history(history_frame(spark, "a", series))
    got = {(r.epoch, r.series): r.value for r in report.loss_curves(wide, "run_id").collect()}
    assert got == {(1, s): v for _, s, v in series[:3]}
    assert report.loss_curves(report.wide_history(history_frame(spark, "a", []))).count() == 0
    # Test losses alone are no curves.
    assert report.loss_curves(report.wide_history(history_frame(spark, "a", series[1:])), "run_id").count() == 0


def test_latest_path_breaks_ties(spark):
    frame = spark.createDataFrame([("a", "x1", 5), ("a", "x2", 5), ("a", "x9", 1)], "run_id string, path string, t long")
    got = saved.latest_path(frame.withColumn("created_at", F.timestamp_seconds("t"))).first()
    assert got.path == "x2"
