import numpy as np
from pyspark.sql import functions as F

from rowsentry.operators import softmax

DDL = "fold INT, split STRING, label INT, features ARRAY<DOUBLE>"


def _rows():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    y = (x[:, 0] + 0.3 * rng.normal(size=300) > 0).astype(int) + (x[:, 1] > 0.8)
    side = ["train" if k % 5 else "validation" for k in range(300)]
    return [(f, side[(k + f) % 300], int(y[k]), [float(v) for v in x[k]]) for f in (1, 2) for k in range(300)]


def _plain(rows, fold, epochs, step):
    """Weights, and loss and accuracy of both sides after each epoch."""
    def part(side):
        some = [r for r in rows if r[0] == fold and r[1] == side]
        return np.array([r[3] + [1.0] for r in some]), np.array([r[2] for r in some])

    def chances(x, w):
        s = x @ w.T
        e = np.exp(s - s.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    w, out = np.zeros((3, 5)), []
    x, y = part("train")
    for _ in range(epochs):
        w = w - step * (chances(x, w) - np.eye(3)[y]).T @ x / len(x)
        for name, (a, b) in (("", (x, y)), ("val_", part("validation"))):
            p = chances(a, w)
            out += [(f"{name}loss", -np.log(p[np.arange(len(b)), b]).mean()), (f"{name}accuracy", (p.argmax(axis=1) == b).mean())]
    return w, out


def test_agrees_with_plain_descent(spark):
    rows = _rows()
    fits = softmax.train_softmax(spark.createDataFrame(rows, DDL), [1, 2], 4, 3, epochs=6, steps=(0.3, 1.0))
    for t, step in enumerate((0.3, 1.0)):
        for fold in (1, 2):
            w, metrics = _plain(rows, fold, 6, step)
            model = fits.models[fold, t]
            assert np.allclose(np.column_stack([model.coefficients, model.intercepts]), w, atol=1e-8)
            found = [(m, v) for f, at, _, m, v in fits.history if (f, at) == (fold, t)]
            assert [m for m, _ in found] == [m for m, _ in metrics]
            assert np.allclose([v for _, v in found], [v for _, v in metrics], atol=1e-8)


def test_order_and_partitions_do_not_change_a_bit(spark):
    df = spark.createDataFrame(_rows(), DDL)
    a = softmax.train_softmax(df.coalesce(1), [1, 2], 4, 3, epochs=4)
    b = softmax.train_softmax(df.repartition(7).orderBy(F.desc("label"), F.col("features")[2]), [1, 2], 4, 3, epochs=4)
    assert a.models == b.models and a.history == b.history


def test_rows_that_do_not_fit_take_no_part(spark):
    rows = _rows()
    odd = [(1, "train", None, [1.0] * 4), (1, "train", 3, [1.0] * 4), (1, "train", -1, [1.0] * 4), (1, "train", 0, None), (1, "train", 0, [1.0]),
           (1, "train", 0, [1.0, None, 1.0, 1.0]), (1, "train", 0, [float("nan")] * 4), (1, "train", 0, [float("inf")] * 4),
           (None, "train", 0, [1.0] * 4), (1, None, 0, [1.0] * 4), (1, "test", 0, [1.0] * 4), (9, "train", 0, [1.0] * 4)]
    a = softmax.train_softmax(spark.createDataFrame(rows, DDL), [1], 4, 3, epochs=2)
    b = softmax.train_softmax(spark.createDataFrame(rows + odd, DDL), [1], 4, 3, epochs=2)
    assert a.models == b.models and a.history == b.history


def test_empty_table_and_trials(spark):
    none = softmax.train_softmax(spark.createDataFrame([], DDL), [1], 4, 3, epochs=2)
    assert none.models[1, 0].intercepts == [0.0] * 3 and none.history == []
    fits = softmax.train_softmax(spark.createDataFrame(_rows(), DDL), [1, 2], 4, 3, epochs=4, steps=(0.1, 1.0))
    short = softmax.train_softmax(spark.createDataFrame(_rows(), DDL), [1, 2], 4, 3, epochs=2, steps=(0.1, 1.0))
    trials = {(r["step"], r["epochs"]): r["val_accuracy"] for r in softmax.softmax_trials(fits, spark, [2, 4]).collect()}
    ends = {t: v for f, t, e, m, v in short.history if (f, e, m) == (2, 2, "val_accuracy")}
    assert len(trials) == 4 and {t: trials[t, 2] for t in ends} == ends
