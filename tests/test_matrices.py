"""Newton's method and correlations against numpy over all rows."""

import random

import numpy as np
import pytest

from creditflow import config
from creditflow.operators import matrices, prepare, woe
from creditflow.plans import queries
from creditflow.session import stage


def frame(spark, rows, names):
    return spark.createDataFrame(rows, ", ".join(["BAD_FLAG int", *[f"`{n}` double" for n in names]]))


def some_rows(n=600, seed=3):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = pick.choice([-1.0, 0.25, 0.75, 2.0]), pick.choice([-0.5, 0.5])
        rows.append((None if i % 40 == 3 else int(pick.random() < 1 / (1 + np.exp(0.4 - 0.8 * a + 0.6 * b))), a, b, a))
    return rows


def newton(rows, k):
    known = [r for r in rows if r[0] is not None]
    x, y = np.array([[1.0, *r[1 : k + 1]] for r in known]), np.array([r[0] for r in known])
    beta = np.zeros(k + 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ beta))
        beta = beta + np.linalg.pinv((x * (p * (1 - p))[:, None]).T @ x) @ (x.T @ (y - p))
    return beta


def test_same_as_over_single_rows(spark):
    rows = some_rows()
    fitted = matrices.logistic(frame(spark, rows, ["a", "b b", "c"]).repartition(4), ["a", "b b"])
    assert fitted.coefficients == pytest.approx(newton(rows, 2), abs=1e-9)
    assert fitted.gradient < 1e-8 and fitted.steps < 10


def test_equal_columns_share_a_coefficient(spark):
    rows = some_rows()
    twice = matrices.logistic(frame(spark, rows, ["a", "b", "c"]), ["a", "b", "c"]).coefficients
    once = newton(rows, 2)
    assert twice[1] == pytest.approx(twice[3], abs=1e-9) == pytest.approx(once[1] / 2, abs=1e-7)
    assert twice[[0, 2]] == pytest.approx(once[[0, 2]], abs=1e-7)


def test_separated_classes_end(spark):
    fitted = matrices.logistic(frame(spark, [(int(i > 5), float(i > 5)) for i in range(12)], ["a"]), ["a"])
    assert np.isfinite(fitted.coefficients).all() and fitted.coefficients[1] > 5


@pytest.mark.parametrize("rows", [[], [(1, 2.0)], [(0, 1.0), (0, 2.0)], [(None, 1.0)]])
def test_without_both_classes(spark, rows):
    assert matrices.logistic(frame(spark, rows, ["a"]), ["a"]).coefficients.tolist() == [0, 0]


def test_gradient_of_all_accepted_variables(spark):
    scored, found, _ = queries._job_fit(spark, "/root/testdata/sf0.01")
    table = woe.woe_table(found.where("status = 'accepted'"))
    train, _ = prepare.train_and_oot(scored, config.TRANSACTIONS.split)
    fitted = matrices.logistic(stage(woe.woe_wide(train, table), "woe"), [f"{v}_woe" for v in table])
    assert len(table) > 50 and fitted.gradient < 1e-8


def test_correlations(spark):
    pick = np.random.default_rng(1)
    a = pick.normal(1e6, 3, 500)
    b, c = pick.normal(0, 1, 500), np.full(500, 7.25)
    names = ["a", "b", "c", "d d"]
    rows = [(1, *r) for r in np.column_stack([a, b, c, 0.1 * a - b]).tolist()]
    found = matrices.correlations(frame(spark, rows, names).repartition(3), names)
    assert found.names == ["a", "b", "d d"]
    assert found.matrix == pytest.approx(np.corrcoef(np.array(rows)[:, [1, 2, 4]].T), abs=1e-9)
    values = matrices.eigenvalues(found.matrix)
    assert values.sum() == pytest.approx(3) and (values**2).sum() == pytest.approx((found.matrix**2).sum())
    assert list(values) == sorted(values, reverse=True)


def test_correlations_of_nothing(spark):
    found = matrices.correlations(frame(spark, [], ["a"]), ["a"])
    assert found.names == [] and len(matrices.eigenvalues(found.matrix)) == 0
    rows = [(1, 1.0, None), (1, 2.0, 3.0), (0, 4.0, 5.0)]
    assert matrices.correlations(frame(spark, rows, ["a", "b"]), ["a", "b"]).matrix == pytest.approx(np.ones((2, 2)))


def test_residual_is_checked():
    with pytest.raises(ArithmeticError, match="residual"):
        matrices.eigenvalues(np.array([[1.0, 5.0], [0.0, 1.0]]))


def test_correlations_read_their_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    rows = [(1, float(i), float(i * i)) for i in range(50)]
    data = frame(spark, rows, ["a", "b"]).repartition(3).mapInPandas(counted, "BAD_FLAG int, a double, b double")
    found = matrices.correlations(data, ["a", "b"])
    assert read.value == len(rows)
    assert found.matrix == pytest.approx(np.corrcoef(np.array(rows)[:, 1:].T))


def test_moments_of_unlike_parts_are_put_together(spark):
    """More parts than mergers, each around a mean of its own, one with missing values only."""
    pick = np.random.default_rng(4)
    x = np.concatenate([pick.normal(1e7 * part, 1, (7, 2)) for part in range(20)])
    rows = [(1, *r) for r in x.tolist()] + [(1, None, 3.0), (1, float("nan"), 4.0)]
    data = frame(spark, rows, ["a", "b"]).repartition(20)
    found = matrices.moments(data, ["a", "b"])
    assert found.n == len(x)
    assert found.means == pytest.approx(x.mean(axis=0), rel=1e-12)
    assert found.products == pytest.approx((x - x.mean(axis=0)).T @ (x - x.mean(axis=0)), rel=1e-10)
