"""Mini-batch training in a barrier stage."""

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.functions.head import Features
from corpusloom.operators.gradient import batch_gradient
from corpusloom.operators.optimizer import HeadState, adamw, initial_weights
from corpusloom.plans.minibatch import fit_minibatches, pack, run_epoch, unpack
from corpusloom.plans.train import fit
from corpusloom.schemas import TRAIN_LOSS
from corpusloom.session import materialise, scratch_path

DENSE, HASHED = Features("x", 6), Features("ids", 32, hashed=True)
SCHEMA = "doc_id long, split string, shard int, row_in_shard long, batch_id long, label int, x array<float>, ids array<int>"


def rows(seed=0, shards=(11, 9, 4), size=4):
    rng = np.random.default_rng(seed)
    out = []
    for split, counts in (("train", shards), ("test", (11,)), ("sst2", (7,))):
        for shard, count in enumerate(counts):
            for at in range(count):
                ids = rng.integers(1, 500, rng.integers(1, 9)).tolist()
                x = rng.normal(size=6).astype(np.float32).tolist()
                out.append((len(out), split, shard, at, at // size, int(rng.integers(0, 2)), x, ids))
    return out


def table(spark, data=None):
    return materialise(spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(5), "rows")


def plain(data, features, epochs, lr):
    """The same updates on the driver, a global batch after the other."""
    state, losses = HeadState.fresh(initial_weights(2, features.dim)), []
    train = [r for r in data if r[1] == "train"]
    for _ in range(epochs):
        each = []
        for step in range(max(r[4] for r in train) + 1):
            found = []
            for shard in sorted({r[2] for r in train}):
                own = sorted((r for r in train if r[2] == shard and r[4] == step), key=lambda r: r[3])
                if own:
                    column = pa.array([r[7 if features.hashed else 6] for r in own], pa.list_(pa.int32() if features.hashed else pa.float32()))
                    found.append(batch_gradient(features, column, np.array([r[5] for r in own]), state.weights))
            count = sum(f[0] for f in found)
            each.append(sum(f[1] for f in found) / count)
            state = adamw(state, sum(f[2] for f in found) / count, lr)
        losses.append(float(np.mean(each)))
    return state, losses


@pytest.mark.parametrize("features", [DENSE, HASHED])
def test_any_number_of_tasks_gives_the_plain_updates(spark, features):
    data, wanted = rows(), None
    state, losses = plain(data, features, 2, 0.05)
    frame = table(spark, data)
    for tasks in (1, 4):  # 4 tasks: more than shards, so one has no rows
        found, series = fit_minibatches(frame, features, epochs=2, lr=0.05, tasks=tasks)
        assert (found.weights == state.weights).all() and (found.m == state.m).all() and (found.v == state.v).all()
        assert found.step == state.step == 6
        assert [v for _, name, v in series if name == TRAIN_LOSS] == pytest.approx(losses, rel=1e-12)
        wanted = wanted or series
        assert [r[:2] for r in series] == [r[:2] for r in wanted]
        assert [r[2] for r in series] == pytest.approx([r[2] for r in wanted], rel=1e-12)


def test_one_batch_an_epoch_is_the_full_gradient(spark):
    data = [(*r[:4], 0, *r[5:]) for r in rows()]
    frame = table(spark, data)
    state, series = fit_minibatches(frame, DENSE, epochs=3, lr=0.05)
    whole, other = fit(frame, DENSE, epochs=3, lr=0.05)
    assert np.allclose(state.weights, whole.weights, rtol=1e-12)
    assert [(e, n) for e, n, _ in series] == [(e, n) for e, n, _ in other]
    assert np.allclose([v for *_, v in series], [v for *_, v in other], rtol=1e-12)


def test_resumed_run_equals_a_straight_one(spark):
    frame, folder = table(spark), scratch_path(spark, "mini")
    fit_minibatches(frame, DENSE, epochs=1, lr=0.05, run_id="a", folder=folder)
    state, series = fit_minibatches(frame, DENSE, epochs=2, lr=0.05, run_id="a", folder=folder)
    straight, other = fit_minibatches(frame, DENSE, epochs=2, lr=0.05)
    assert (state.weights == straight.weights).all() and state.step == straight.step
    assert [r[2] for r in series] == pytest.approx([r[2] for r in other], rel=1e-12)


def test_frozen_weights_and_gaps_between_batches(spark):
    data = [r for r in rows() if not (r[1] == "train" and r[4] == 1)]  # no rank has batch 1
    mask = np.zeros((2, 7), dtype=bool)
    mask[:, 3:] = True
    state, _ = fit_minibatches(table(spark, data), DENSE, epochs=1, lr=0.05, trainable=mask)
    first = initial_weights(2, 6)
    assert (state.weights[:, :3] == first[:, :3]).all() and (state.weights[:, 3:] != first[:, 3:]).all()
    assert state.step == 2


def test_without_training_rows(spark):
    data = [r for r in rows() if r[1] != "train"]
    state, series = fit_minibatches(table(spark, data), DENSE, epochs=2)
    assert state.step == 0 and {n for _, n, _ in series} == {"imdb_eval_losses", "imdb_eval_acc", "sst2_eval_losses", "sst2_eval_acc"}
    assert fit_minibatches(table(spark, []), DENSE, epochs=2)[1] == []


def test_a_repeated_epoch_is_the_same(spark):
    frame = table(spark).filter("split = 'train'")
    state = HeadState.fresh(initial_weights(2, 6))
    wanted, loss = run_epoch(frame, DENSE, state, 3, 3, 0.05)
    again, same = run_epoch(frame, DENSE, state, 3, 3, 0.05)
    assert (wanted.weights == again.weights).all() and loss == pytest.approx(same, rel=1e-12)


def test_sums_survive_packing():
    gradient = np.zeros((2, 7))
    gradient[1, 3], gradient[0, 6] = 1.5, np.nan
    data = pack(4, (3.0, 2.5, gradient)) + pack(9, (1.0, 0.5, np.zeros((2, 7))))
    (a, (rows_a, loss_a, g)), (b, (rows_b, _, h)) = unpack(data, (2, 7))
    assert (a, rows_a, loss_a, b, rows_b) == (4, 3.0, 2.5, 9, 1.0)
    assert g[1, 3] == 1.5 and np.isnan(g[0, 6]) and not h.any() and list(unpack(b"", (2, 7))) == []
