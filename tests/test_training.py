"""Back-propagation: gradients by finite differences, held-out accuracy, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skysift.operators import training
from skysift.queries import QUERIES


@pytest.mark.parametrize("network", [training.Network((1, 8, 8), ((6, 3, 3),), 3), training.Network((2, 6, 5), ((3, 2, 2), (4, 3, 2)), 2), training.Network((1, 4, 4, 4), ((3, 2, 2, 2), (2, 2, 1, 1)), 1)])
def test_gradients(network):
    r = np.random.default_rng(1)
    cubes, labels = r.normal(size=(7, *network.shape)), r.integers(0, 2, 7).astype(float)
    weights = network.start(3) + r.normal(0, 0.05, len(network.start(3)))
    loss, slope = network.gradient(weights, cubes, labels)
    p = network.probabilities(weights, cubes)
    assert loss == pytest.approx(-(labels * np.log(p) + (1 - labels) * np.log(1 - p)).sum())
    for k in range(len(weights)):
        step = np.zeros(len(weights))
        step[k] = 1e-6
        up, down = (network.gradient(weights + s, cubes, labels)[0] for s in (step, -step))
        assert slope[k] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-6)


def test_training_beats_chance_by_far_and_loss_falls(spark):
    """Blobs in one of two halves, among noise; rows without pixels, label or with null pixels."""
    r = np.random.default_rng(2)
    rows = []
    for n in range(400):
        x = r.normal(0, 1, (8, 8))
        half = int(r.integers(0, 2))
        y = int(r.integers(0, 3)) + 4 * half
        x[y : y + 2, (c := int(r.integers(0, 6))) : c + 2] += 2.5
        rows.append((n, [float(v) for v in x.ravel()], half))
    rows += [(1000, None, 1), (1001, [None] * 64, None), (1002, [None if k % 9 == 0 else float(k < 32) for k in range(64)], None)]
    df = spark.createDataFrame(rows, "cand_id bigint, pixels array<double>, label int").repartition(3)
    network = training.Network((1, 8, 8), ((6, 3, 3),), 3)
    weights, losses = training.train(df.where("cand_id < 300 or cand_id >= 1000"), network, 40)
    assert len(losses) == 40 and losses[-1] < 0.6 * losses[0]
    got = {x.cand_id: x for x in training.classify(df, network, weights).collect()}
    assert len(got) == 403 and got[1000].prob is None and got[1000].predict is None and got[1001].prob is not None
    right = [got[n].predict == label for n, _, label in rows if 300 <= n < 400]
    assert sum(right) >= 88
    again, _ = training.train(df.where("label is null"), network, 3)
    assert (again == network.start(0)).all()


@pytest.mark.parametrize("name", ["cnn_learned", "cnn_learned_3d"])
def test_held_out_accuracy(spark, name):
    import os

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    out = QUERIES[name](spark, "/root/testdata/sf0.001").where("held_out").agg(F.count("*").alias("n"), F.sum((F.col("predict") == F.col("label")).cast("int")).alias("right")).first()
    assert out.n > 50 and out.right / out.n > 0.8
