"""Batched linear learners against plain Newton steps on whole matrices."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tessella import operators as op
from tessella.operators import linear
from tessella.operators.learners import Candidate, fit_linear_svm_folds, fit_logreg_folds


def plain_newton(x, y, weight, c, kind, bias_penalty):
    """The optimum of one binary fit by exact Newton steps with halving."""
    x = np.c_[x, np.ones(len(x))]
    penalty = np.r_[np.ones(x.shape[1] - 1), bias_penalty]
    w = np.zeros(x.shape[1])

    def total(w):
        m = y * (x @ w)
        each = np.logaddexp(0, -m) if kind == linear.LOGISTIC else np.maximum(0, 1 - m) ** 2
        return 0.5 * (penalty * w * w).sum() + c * (weight * each).sum()

    for _ in range(200):
        m = y * (x @ w)
        if kind == linear.LOGISTIC:
            p = 1 / (1 + np.exp(m))
            first, second = -weight * y * p, weight * p * (1 - p)
        else:
            short = np.maximum(0, 1 - m)
            first, second = -2 * weight * y * short, 2 * weight * (short > 0)
        g = penalty * w + c * x.T @ first
        step = np.linalg.solve(np.diag(penalty + 1e-12) + c * x.T @ (second[:, None] * x), -g)
        a = 1.0
        while total(w + a * step) > total(w) + 1e-4 * a * g @ step and a > 1e-8:
            a /= 2
        w = w + a * step
        if np.abs(g).max() < 1e-11:
            break
    return w[:-1], w[-1]


@pytest.fixture(scope="module")
def sample(spark):
    """600 rows of sparse and full columns, three classes, folds 0 to 2; every tenth vector is dense."""
    rng = np.random.default_rng(4)
    x = np.where(rng.random((600, 40)) < 0.1, rng.random((600, 40)), 0)
    x[:, 35:] = 3 * rng.normal(size=(600, 5))
    y = (x @ rng.normal(size=(40, 3)) + rng.normal(size=(600, 3))).argmax(1)
    rows = [
        (Vectors.dense(v) if i % 10 == 0 else Vectors.sparse(40, np.flatnonzero(v).tolist(), v[v != 0].tolist()), float(k), i % 3)
        for i, (v, k) in enumerate(zip(x, y, strict=True))
    ]
    schema = StructType([StructField("features", VectorUDT()), StructField("label", DoubleType()), StructField("fold", IntegerType())])
    return op.durable(spark.createDataFrame(rows, schema).repartition(5)), x, y


def margins_of(model, df, x):
    """Margins by the model in the order of the rows of ``x``."""
    got = {tuple(np.round(r.features.toArray(), 9)): r.rawPrediction.toArray() for r in model.transform(df).collect()}
    return np.stack([got[tuple(np.round(v, 9))] for v in x])


def test_svm_of_all_folds_and_classes(sample):
    df, x, y = sample
    models = fit_linear_svm_folds(df, [0, 1, 2, None], tol=1e-10)
    for fold, model in zip([0, 1, 2, None], models, strict=True):
        own = np.ones(600, bool) if fold is None else np.arange(600) % 3 != fold
        want = []
        for code in range(3):
            is_class = y[own] == code
            weight = np.where(is_class, own.sum() / (3 * is_class.sum()), 1.0)
            w, b = plain_newton(x[own], np.where(is_class, 1, -1), weight, 0.5, linear.SQUARED_HINGE, 1.0)
            want.append(x @ w + b)
        assert np.abs(margins_of(model, df, x) - np.stack(want, 1)).max() < 1e-6


def test_binary_logistic_of_all_folds(sample):
    df, x, y = sample
    two = df.withColumn("label", (df.label > 0).cast("double"))
    for fold, model in zip([0, 1, 2], fit_logreg_folds(two, [0, 1, 2], family="binomial", tol=1e-10), strict=True):
        own = np.arange(600) % 3 != fold
        is_class = y[own] > 0
        weight = np.where(is_class, own.sum() / (2 * is_class.sum()), own.sum() / (2 * (~is_class).sum()))
        w, b = plain_newton(x[own], np.where(is_class, 1, -1), weight, 1.0, linear.LOGISTIC, 0.0)
        assert np.abs(margins_of(model, two, x)[:, 1] - (x @ w + b)).max() < 1e-6


def test_softmax_gradient_is_zero(sample):
    df, x, y = sample
    model = op.fit_logreg(df)
    s = x @ model.weights.T + model.intercepts
    p = np.exp(s - s.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    weight = 600 / (3 * np.bincount(y)[y])
    pull = weight[:, None] * (p - np.eye(3)[y])
    start = np.abs(x.T @ (weight[:, None] * (1 / 3 - np.eye(3)[y]))).max()
    assert np.abs(model.weights.T + x.T @ pull).max() < 1e-5 * start
    assert np.abs(pull.sum(0)).max() < 1e-5 * start
    got = {tuple(np.round(r.features.toArray(), 9)): (r.probability.toArray(), r.prediction) for r in model.transform(df).collect()}
    for v, row in zip(x, p, strict=True):
        assert got[tuple(np.round(v, 9))][0] == pytest.approx(row, abs=1e-9)
        assert got[tuple(np.round(v, 9))][1] == row.argmax()


def test_batches_give_the_same(sample, monkeypatch):
    df, _, _ = sample
    whole = fit_linear_svm_folds(df, [0, 1])
    monkeypatch.setattr(linear, "CELLS", 200)
    for a, b in zip(whole, fit_linear_svm_folds(df, [0, 1]), strict=True):
        assert np.abs(a.weights - b.weights).max() < 1e-6


def test_cross_validation_shares_the_fits(sample):
    """The batched folds score as fits fold by fold do."""
    df, _, _ = sample
    runs = [Candidate("batched", op.fit_linear_svm, fit_linear_svm_folds), Candidate("single", op.fit_linear_svm)]
    cv = {(r.candidate, r.fold): r.macro_f1 for r in op.cross_validate(df, runs, 3).collect()}
    assert all(cv["batched", f] == pytest.approx(cv["single", f]) for f in range(3))


def test_odd_tables(spark, sample):
    df, _, _ = sample
    with pytest.raises(ValueError):
        linear.store_rows(df.limit(0), "features", ["label"])
    zero = spark.createDataFrame([(0.0, 0), (1.0, 0), (1.0, 1)], "label double, fold int").selectExpr("*", "array(0D, 0D) AS a")
    model = op.fit_linear_svm(zero.withColumn("features", array_to_vector("a")))
    assert np.abs(model.weights).max() == 0


def test_what_meets_on_the_driver_is_bounded(spark):
    """Counts of rare columns and the weights of many wide fits stay off the driver; each block holds a value once."""
    n = 3000
    found = []

    def collect(df):
        found.append(kept(df))
        return found[-1]

    schema = StructType([StructField("features", VectorUDT()), StructField("y", IntegerType())])
    wide = spark.createDataFrame(
        [(Vectors.sparse(n + 1, [0, i + 1], [1.0, 2.0]), i % 2) for i in range(n)], schema
    )
    stored = op.durable(wide)
    kept = type(stored).collect
    type(stored).collect = collect
    try:
        table = linear.store_rows(stored, "features", ["y"])
    finally:
        type(stored).collect = kept
    assert table.dense.tolist() == [0]
    assert max(map(len, found)) <= linear.DENSE
    assert linear.CELLS * 8 * 16 <= 1 << 28
    blocks = list(linear._opened((tuple(r) for r in table.table.collect()), 1))
    assert sum(len(b.values) for b in blocks) == n
    assert all(len(b.at) == len(b.values) for b in blocks)
    total = np.zeros((table.width + 2, 1))
    for b in blocks:
        b.pull(total, np.ones((len(b.folds), 1)), table.width)
    assert total[:, 0].tolist() == [0.0] + [2.0] * n + [n, n]


def test_a_wide_vector_has_no_attributes_on_the_driver(spark):
    """Appended columns equal those of the assembler, without a description of each place; the vocabulary is joined by shuffle."""
    from tessella.operators.vectorise import append_values, as_vectors, assemble, fit_tfidf, ngrams_1_2, tokenize

    rows = spark.createDataFrame([(1, "red ring bolt", 1, 0), (2, "blue gear", 0, 1), (3, "", 0, 0)], "id int, text string, a int, b int")
    terms = ngrams_1_2(tokenize(rows, "text", []))
    model = fit_tfidf(terms, min_df=1, max_df=1.0, size=None, sublinear=False)
    weighted = model.transform(terms)
    table = as_vectors(append_values(weighted, ["a", "b"]), ["tfidf", "features"])
    assert table.schema["features"].metadata == {}
    both = assemble(table, ["tfidf", "a", "b"], "wanted").select("features", "wanted").collect()
    assert all(r.features.toArray().tolist() == r.wanted.toArray().tolist() for r in both)
    plan = weighted._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan
    twice = model.transform(terms.unionByName(terms))
    with pytest.raises(Exception, match="not unique"):
        append_values(twice, ["a", "b"]).collect()


def test_folds_start_from_a_fit_on_all_of_them(sample, monkeypatch):
    """Fewer passes have the outputs of all folds, and the fits end at the same weights."""
    df, _, _ = sample
    stored = linear.store_rows(df, "features", ["label"], "fold")
    fits = [linear.Fit(0, fold, dict.fromkeys(range(3), 1.0), (code,)) for fold in range(3) for code in range(3)]
    sizes, whole = [], linear._total

    def counted(blocks, task, size):
        sizes.append(size)
        return whole(blocks, task, size)

    monkeypatch.setattr(linear, "_total", counted)
    warm = linear.solve(stored, linear.SQUARED_HINGE, fits, 0.5, 1.0, 1e-7)
    full = 9 * (stored.width + len(stored.dense) + 1)
    n_warm = sum(n >= full for n in sizes)
    sizes.clear()
    monkeypatch.setattr(linear, "_start", lambda *_: None)
    cold = linear.solve(stored, linear.SQUARED_HINGE, fits, 0.5, 1.0, 1e-7)
    assert n_warm < sum(n >= full for n in sizes)
    for a, b in zip(warm, cold, strict=True):
        assert max(a.gradient, b.gradient) <= 1e-7
        assert np.abs(a.weights - b.weights).max() < 1e-4


@pytest.mark.parametrize("joined", [True, False])
def test_outputs_preconditioned_together(sample, monkeypatch, joined):
    """Taken as one, the classes of a softmax need few passes also where the loss is large against the penalty; the optimum is the same."""
    df, x, y = sample
    passes, total = [], linear._total
    monkeypatch.setattr(linear, "_total", lambda *given: passes.append(1) or total(*given))
    if not joined:
        monkeypatch.setattr(linear, "COUPLED", 0)
    model = op.fit_logreg(df, c=10.0, tol=1e-6)
    s = x @ model.weights.T + model.intercepts
    p = np.exp(s - s.max(1, keepdims=True))
    pull = (600 / (3 * np.bincount(y)[y]))[:, None] * (p / p.sum(1, keepdims=True) - np.eye(3)[y])
    start = np.abs(x.T @ ((600 / (3 * np.bincount(y)[y]))[:, None] * (1 / 3 - np.eye(3)[y]))).sum()
    assert np.abs(model.weights.T / 10 + x.T @ pull).max() < 1e-6 * start
    assert not joined or len(passes) < 80


def test_columns_of_single_rows_kept_apart(spark):
    """Logistic fits with and without a fold: the same weights whether columns that one row fills are searched for or follow from the rest."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(120):
        words = sorted({int(j) for j in rng.integers(0, 12, 3)} | {12})
        cols = words + [13 + 2 * i, 14 + 2 * i] if i % 3 else words
        rows.append((Vectors.sparse(260, cols, (0.2 + rng.random(len(cols))).tolist()), int(sum(words) > 30), int(rng.random() < 0.3), i % 4))
    schema = StructType([StructField("features", VectorUDT()), *[StructField(n, IntegerType()) for n in ("a", "b", "fold")]])
    df = op.durable(spark.createDataFrame(rows, schema).repartition(3))
    fits = [linear.Fit(0, None, {0: 1.0, 1: 2.0}, (1,)), linear.Fit(1, 2, {0: 0.7, 1: 3.0}, (1,))]
    found = {}
    for apart in (False, True):
        stored = linear.store_rows(df, "features", ["a", "b"], "fold", apart=apart)
        found[apart] = linear.solve(stored, linear.LOGISTIC, fits, 30.0, 0.0, tol=1e-9)
    assert len(stored.kept) == 13
    for whole, rest in zip(found[False], found[True], strict=True):
        assert np.abs(whole.weights[13:]).max() > 0.1
        assert np.abs(whole.weights - rest.weights).max() < 1e-6
        assert np.abs(whole.intercepts - rest.intercepts).max() < 1e-6
    with pytest.raises(ValueError, match="logistic fits only"):
        linear.solve(stored, linear.SOFTMAX, [linear.Fit(0, None, {0: 1.0, 1: 1.0}, (0, 1))], 1.0, 0.0)
