"""The kernel map beside the kernel itself, and the kernel machine beside a plain dual solver."""

import numpy as np
import pytest

from docsignal.operators import kernels, models
from docsignal.operators.kernels import KernelMap, gaussian
from docsignal.operators.matrix import Scaler


def frame(spark, x, y):
    rows = [(i, int(b), [float(v) for v in a]) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "doc_id long, label int, features array<double>").repartition(5)


def rings(n, seed=1):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.5).astype(int)
    angle, radius = rng.uniform(0, 2 * np.pi, n), 1 + y + rng.normal(scale=0.35, size=n)
    return np.column_stack([radius * np.cos(angle), radius * np.sin(angle), rng.normal(size=n)]), y


def plain_dual(z, y, gamma, c):
    """Decision values of the squared-hinge machine with a penalised intercept, by its dual.

    Rows with a positive multiplier solve a linear system; rows are exchanged until none is wrong.
    """
    sign = np.where(y == 1, 1.0, -1.0)
    kernel = gaussian(z, z, gamma) + 1.0
    system = kernel * np.outer(sign, sign) + np.eye(len(y)) * 0.5 / c
    support = np.ones(len(y), bool)
    for _ in range(100):
        alpha = np.zeros(len(y))
        alpha[support] = np.linalg.solve(system[np.ix_(support, support)], np.ones(support.sum()))
        said = kernel @ (alpha * sign)
        before, support = support, sign * said < 1
        if (before == support).all():
            break
    slope = system @ alpha - 1  # 0 at positive multipliers, not negative elsewhere, none negative
    assert alpha.min() >= 0 and np.abs(slope[alpha > 0]).max() < 1e-9 and slope.min() > -1e-9
    return said


def standardised(x):
    return Scaler(x.mean(0), x.std(0), len(x))


@pytest.mark.parametrize("c", [0.5, 4.0])
def test_decision_values_equal_a_plain_dual_solver(spark, c):
    x, y = rings(1000)
    model = models.fit_final(frame(spark, x, y), "svc_rbf", {"C": c, "gamma": 0.5, "rank": 1000, "tolerance": 1e-9})
    want = plain_dual(standardised(x).apply(x), y, 0.5, c)
    assert model.inner.task.lift.residual < 1e-8
    assert np.abs(model.inner.margins(x) - want).max() < 1e-3
    assert ((want > 0) == (y == 1)).mean() > 0.85


def test_the_bound_holds_and_falls_with_the_rank(spark, monkeypatch):
    monkeypatch.setattr(kernels, "BLOCK", 20)
    x, y = rings(400, 2)
    scaler, df = standardised(x), frame(spark, x, y)
    z = scaler.apply(x)
    exact, last = gaussian(z, z, 0.3), 1.1
    for rank in (20, 60, 120):
        basis = kernels.choose_basis(df, scaler, 0.3, rank, 1e-9)
        kernel_map = basis.map(scaler, 0.3)
        mapped = kernel_map.apply(z)
        loss = kernel_map.losses(z)
        off = np.abs(exact - mapped @ mapped.T)
        assert (off <= np.sqrt(np.outer(loss, loss)) + 1e-6).all()
        assert len(basis.rows) <= rank and loss.max() == pytest.approx(basis.residual, abs=1e-6)
        assert basis.residual < last
        last = basis.residual
    assert len(np.unique(basis.rows, axis=0)) == len(basis.rows)
    wide = kernels.choose_basis(df, scaler, 0.3, 400, 0.05)
    assert wide.residual <= 0.05 and len(wide.rows) < 120


def test_copies_empty_frames_and_one_row(spark):
    x, y = np.repeat(rings(5)[0], 30, axis=0), np.arange(150) % 2
    basis = kernels.choose_basis(frame(spark, x, y), standardised(x), 1.0, 100)
    assert len(basis.rows) == 5 and basis.residual <= 1e-4
    none = kernels.choose_basis(frame(spark, x, y).where("false"), standardised(x), 1.0, 10)
    assert none.rows.shape == (0, 3) and none.residual == 0
    one = KernelMap.on(np.zeros((1, 2)), 1.0)
    assert one.apply(np.zeros((3, 2))).round(6).tolist() == [[1.0]] * 3


def test_search_and_reload(spark, tmp_path):
    x, y = rings(300, 3)
    df = frame(spark, x, y)
    found = models.cv_search(df, "svc_rbf", {"C": [0.5, 2.0], "gamma": [0.001, 0.5]}, n_splits=3)
    assert found.best_params["gamma"] == 0.5 and found.cv_acc > 0.8
    model = models.fit_final(df, "svc_rbf", found.best_params)
    model.save(spark, str(tmp_path / "kernel"))
    again = models.load_model(spark, str(tmp_path / "kernel"))
    assert again.inner.margins(x) == pytest.approx(model.inner.margins(x), abs=1e-9)
    assert again.inner.task.lift.residual == model.inner.task.lift.residual
