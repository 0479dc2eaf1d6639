"""Linear models, trees, ensembles and forecasts against plain numpy."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from faultline.operators import binned_trees, ensemble, forecast, linear, tree
from faultline.operators.profile import fill_numeric

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(11)
    n = 500
    x = rng.normal(size=(n, 3)).round(3)
    y = 1.5 + 2 * x[:, 0] - x[:, 1] + 0.3 * rng.normal(size=n) + (x[:, 2] > 0.3)
    return pd.DataFrame(x, columns=FEATURES).assign(y=y, idx=np.arange(n), label=np.where(x[:, 0] + x[:, 2] > 0, "u", "v"))


@pytest.fixture(scope="module")
def df(spark, pdf):
    return spark.createDataFrame(pdf).repartition(6)


def test_ridge_closed_form(df, pdf):
    m = linear.fit_ridge(df, FEATURES, "y", alpha=2.0)
    x, y = pdf[FEATURES].to_numpy(), pdf.y.to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + 2 * np.eye(3), xc.T @ yc)
    assert m.weights == pytest.approx(w.tolist()) and m.intercept == pytest.approx(y.mean() - x.mean(0) @ w)


@pytest.mark.parametrize("intercept", [True, False])
def test_least_squares(df, pdf, intercept):
    m = linear.fit_ols(df, FEATURES, "y", intercept)
    x = pdf[FEATURES].to_numpy()
    if intercept:
        x = np.column_stack([x, np.ones(len(x))])
    want = np.linalg.lstsq(x, pdf.y.to_numpy(), rcond=None)[0]
    assert [*m.weights, *([m.intercept] if intercept else [])] == pytest.approx(want.tolist())


def test_gradient_descent_has_the_row_forms_iterates(df, pdf):
    start = [0.1, -0.2, 0.3, 0.4]
    m = linear.fit_gradient_descent(df, FEATURES, "y", rate=0.01, iterations=300, theta0=start)
    x, y, theta = np.column_stack([np.ones(len(pdf)), pdf[FEATURES]]), pdf.y.to_numpy(), np.array(start)
    costs = []
    for _ in range(300):
        theta = theta - 0.01 * x.T @ (x @ theta - y) / len(y)
        cost = ((x @ theta - y) ** 2).sum() / (2 * len(y))
        if costs and abs(costs[-1] - cost) < 1e-6:
            break
        costs.append(cost)
    assert [m.intercept, *m.weights] == pytest.approx(theta.tolist())
    assert list(m.history) == pytest.approx(costs)


def test_sgd_comes_close_to_least_squares(df):
    a, b = linear.fit_sgd(df, FEATURES, "y"), linear.fit_ols(df, FEATURES, "y")
    assert a.weights == pytest.approx(b.weights, abs=0.05)
    assert linear.fit_sgd(df.repartition(2), FEATURES, "y").weights == pytest.approx(a.weights)


def test_compare_scores_all_models(df):
    models = {"ols": linear.fit_ols(df, FEATURES, "y"), "ridge": linear.fit_ridge(df, FEATURES, "y")}
    assert linear.compare_models(df, models, "y").groupBy("model").count().collect()[0]["count"] == 500
    with_history = {"gd": linear.fit_gradient_descent(df, FEATURES, "y", iterations=10)}
    assert linear.cost_history(df.sparkSession, with_history).count() == 10


def _grow(x, y, max_depth, min_sample, depth=0):
    """Plain recursive tree on the 19 midpoints of 20 percentiles."""
    node = {"value": y.mean(), "n": len(y)}
    if len(y) < min_sample or depth > max_depth:
        return node
    best, chosen = 0.0, None
    for f in range(x.shape[1]):
        q = np.percentile(x[:, f], np.linspace(10, 90, 20))
        for t in (q[:-1] + q[1:]) / 2:
            left = x[:, f] <= t
            if left.all() or not left.any():
                continue
            gain = y.var() - (left.sum() * y[left].var() + (~left).sum() * y[~left].var()) / len(y)
            if gain > best + 1e-12 * y.var():
                best, chosen = gain, (f, t)
    if chosen:
        left = x[:, chosen[0]] <= chosen[1]
        node |= {"split": chosen, "left": _grow(x[left], y[left], max_depth, min_sample, depth + 1),
                 "right": _grow(x[~left], y[~left], max_depth, min_sample, depth + 1)}
    return node


def _walk(node, row):
    while "split" in node:
        f, t = node["split"]
        node = node["left"] if row[f] <= t else node["right"]
    return node["value"]


def test_regression_tree_equals_the_recursive_one(df, pdf):
    grown = tree.fit_regression_tree(df, FEATURES, "y", max_depth=3, min_sample=30)
    got = tree.predict(df, grown, FEATURES, ["idx"]).toPandas().set_index("idx").predicted
    x, y = pdf[FEATURES].to_numpy(), pdf.y.to_numpy()
    root = _grow(x, y, 3, 30)
    assert got.sort_index().tolist() == pytest.approx([_walk(root, r) for r in x])


def test_grid_scores_equal_separate_trees(df, pdf, many_partitions):
    train, valid = df.filter("idx < 350"), df.filter("idx >= 350")
    got = {(r["depth"], r["min_sample"]): r["r2"] for r in tree.grid_scores(train, valid, FEATURES, "y", range(1, 3), range(20, 150, 60)).collect()}
    a, b = pdf[pdf.idx < 350], pdf[pdf.idx >= 350]
    for (depth, minimum), r2 in got.items():
        root = _grow(a[FEATURES].to_numpy(), a.y.to_numpy(), depth, minimum)
        p = np.array([_walk(root, r) for r in b[FEATURES].to_numpy()])
        assert r2 == pytest.approx(1 - ((b.y - p) ** 2).sum() / ((b.y - b.y.mean()) ** 2).sum())
    assert len(got) == 6


def _entropy(y):
    p = np.unique(y, return_counts=True)[1] / len(y)
    return -(p * np.log(p)).sum()


def test_classification_root_split(df, pdf, many_partitions):
    root = tree.fit_classification_tree(df, FEATURES, "label", max_depth=0).filter("node = 0").first()
    best = (0.0, None)
    for f, c in enumerate(FEATURES):
        for t in np.unique(pdf[c])[:-1]:
            left = pdf[c] <= t
            gain = _entropy(pdf.label) - (left.mean() * _entropy(pdf.label[left]) + (~left).mean() * _entropy(pdf.label[~left]))
            if gain > best[0] + 1e-12:
                best = (gain, (f, t))
    assert (root["feature"], root["threshold"]) == best[1] and root["gain"] == pytest.approx(best[0])


def test_classification_tree_predicts(df):
    grown = tree.fit_classification_tree(df, FEATURES, "label", max_depth=4, min_sample=5)
    out = tree.predict(df, grown, FEATURES, ["label"])
    assert out.filter("label = predicted").count() > 450


def test_first_of_equal_scores_wins(spark):
    scores = spark.createDataFrame([(2, 5, 0.5), (3, 4, 0.9), (3, 5, 0.9)], "depth int, min_sample int, r2 double")
    assert tuple(tree.best_parameters(scores, ["depth", "min_sample"], "r2", ["depth", "min_sample"]).first()) == (3, 4, 0.9)


def plain_cuts(v):
    """Values at which the share of rows up to them passes a multiple of 1 / 256."""
    v, n = np.sort(v), len(v)
    return [x for x in np.unique(v)[:-1] if int((v <= x).sum()) * 256 // n > int((v < x).sum()) * 256 // n]


def plain_tree(x, rest, bag, depth, penalty, columns):
    """Nested splits over exact integers: (feature, cut, left, right) or (sum, weight)."""
    w, s = sum(bag), sum(b * t for b, t in zip(bag, rest))
    best = None
    if depth and w:
        inside = [i for i in range(len(x)) if bag[i]]
        for f in columns:
            for cut in sorted({x[i][f] for i in inside}):
                left = [i for i in inside if x[i][f] <= cut]
                wl, sl = sum(bag[i] for i in left), sum(bag[i] * rest[i] for i in left)
                if wl < w:
                    gain = float(sl) * sl / (wl + penalty) + float(s - sl) * (s - sl) / (w - wl + penalty) - float(s) * s / (w + penalty)
                    if gain > 0 and (best is None or gain > best[0]):
                        best = (gain, f, cut)
    if best is None:
        return s, w
    _, f, cut = best
    sides = [[b if (r[f] <= cut) == here else 0 for b, r in zip(bag, x)] for here in (True, False)]
    return (f, cut, *[plain_tree(x, rest, side, depth - 1, penalty, columns) for side in sides])


def plain_value(node, row, rate, penalty):
    while len(node) == 4:
        node = node[2] if row[node[0]] <= node[1] else node[3]
    return int(np.floor(rate * node[0] / (node[1] + penalty) + 0.5)) if node[1] else 0


def plain_boosting(x, y, keys, train, rounds, depth, rate, rows, columns, seed=42):
    base = int(np.floor(sum(y[i] for i in train) / len(train) + 0.5))
    p = [base] * len(y)
    for turn in range(rounds):
        bag = [0] * len(y)
        for i in train:
            bag[i] = int(binned_trees.uniform(keys[i], seed + turn) < rows)
        order = sorted(range(len(x[0])), key=lambda f: (binned_trees.uniform(f + 1_000_003, seed + turn), f))
        grown = plain_tree(x, [a - b for a, b in zip(y, p)], bag, depth, 1.0, sorted(order[:max(1, int(columns * len(order)))]))
        p = [v + plain_value(grown, row, rate, 1.0) for v, row in zip(p, x)]
    return p


@pytest.fixture(scope="module")
def coded(df):
    """Codes, fixed-point targets and keys of the complete rows, in plain Python."""
    pdf = df.select("idx", *FEATURES, "y").na.drop("any").orderBy("idx").toPandas()
    cuts = [plain_cuts(pdf[c].to_numpy()) for c in FEATURES]
    x = [[sum(c < v for c in cut) for cut, v in zip(cuts, row)] for row in pdf[FEATURES].to_numpy()]
    unit = 2.0 ** (30 - math.frexp(pdf.y.abs().max())[1])
    return x, [int(np.floor(v * unit + 0.5)) for v in pdf.y], [int(k) for k in pdf.idx], unit


@pytest.mark.parametrize("limit", [None, 0])
def test_boosting_equals_plain_trees(df, coded, limit):
    """Where the binned rows are held by tasks, and by shared passes."""
    x, y, keys, unit = coded
    params = {"rounds": 3, "depth": 3, "rate": 0.3, "rows": 0.7, "columns": 0.7}
    got = {r["idx"]: r["predicted"] for r in ensemble.fit_boosted(df, FEATURES, "y", limit=limit, **params).predict(df, "y").collect()}
    want = plain_boosting(x, y, keys, range(len(y)), **params)
    assert got == {k: p / unit for k, p in zip(keys, want)}


@pytest.mark.parametrize("limit", [None, 0])
def test_forest_equals_plain_trees(df, coded, limit, monkeypatch):
    x, y, keys, unit = coded
    monkeypatch.setattr(binned_trees, "PASS_NODES", 40)  # several groups of passes, several parts of the model
    got = {r["idx"]: r["predicted"] for r in ensemble.fit_forest(df, FEATURES, "y", trees=4, depth=4, limit=limit).predict(df, "y").collect()}
    total = [0] * len(y)
    for t in range(4):
        bag = [sum(binned_trees.uniform(k, 42 + t) >= p for p in binned_trees.BOOTSTRAP) for k in keys]
        grown = plain_tree(x, y, bag, 4, 0.0, range(len(x[0])))
        total = [v + plain_value(grown, row, 1.0, 0.0) for v, row in zip(total, x)]
    assert got == {k: v / 4 / unit for k, v in zip(keys, total)}


@pytest.mark.parametrize("limit", [None, 0])
def test_search_equals_plain_trees(df, coded, limit):
    x, y, keys, unit = coded
    grid = {"rounds": [1, 2], "depth": [2, 3], "rate": [0.5], "rows": [0.8], "columns": [1.0]}
    got = [tuple(r) for r in ensemble.grid_search(df, FEATURES, "y", grid, folds=2, limit=limit).orderBy("run").collect()]
    half = (len(y) + 1) // 2
    folds = [range(half), range(half, len(y))]
    want = []
    for rounds in grid["rounds"]:
        for depth in grid["depth"]:
            parts = []
            for out, train in (folds, folds[::-1]):
                p = plain_boosting(x, y, keys, train, rounds, depth, 0.5, 0.8, 1.0)
                parts.append(np.mean([((y[i] - p[i]) / unit) ** 2 for i in out]))
            want.append((len(want), rounds, depth, 0.5, 0.8, 1.0, pytest.approx(np.mean(parts), rel=1e-12)))
    assert [r[:-1] for r in got] == want and [r[-1] for r in got] == [m == min(w[6].expected for w in want) for m in (w[6].expected for w in want)]
    assert ensemble.grid_size() == 243


def test_only_the_lighter_child_of_a_split_is_added_up(monkeypatch):
    rng = np.random.default_rng(4)
    n = 6000
    codes, y = rng.integers(0, 256, (n, 3)).astype(np.uint8), rng.integers(-(1 << 30), 1 << 30, n)
    specs = [binned_trees.Spec(depth=3, seed=7), binned_trees.Spec(depth=3, rows=None, columns=0.7)]
    added = []
    plain = np.bincount
    monkeypatch.setattr(binned_trees.np, "bincount", lambda key, *a: added.append(len(key)) or plain(key, *a))

    def grown(known):
        monkeypatch.setattr(binned_trees, "KNOWN", known)
        added.clear()
        trees, values = binned_trees.boost(binned_trees.HeldRows(specs, codes, y, np.arange(n), np.zeros(n, int), np.zeros(2, np.int64)), specs, 1)[0][0]
        return sum(added), [x.tolist() for x in (trees.feature, trees.cut, trees.left, trees.weight, trees.total, values)]

    (whole, expected), (half, got) = grown(0), grown(1 << 18)
    assert got == expected and half < 0.8 * whole


@pytest.mark.parametrize("rows, spread", [(6000, 1 << 30), (6000, 3), (40, 1 << 30), (1, 1), (0, 1)])
def test_forests_only_carry_drawn_rows(rows, spread):
    """The same trees as with all rows held, also where bins are mostly empty and where sums are added up in two parts."""
    rng = np.random.default_rng(4)
    codes, y = rng.integers(0, 256, (rows, 3)).astype(np.uint8), rng.integers(-spread, spread, rows) * (1 if spread < 5 else 1 << 12)
    specs = [binned_trees.Spec(depth=9, rows=None, seed=s, columns=c) for s, c in ((7, 1.0), (8, 0.7))]

    def grown(holder):
        held = holder(specs, codes, y, np.arange(rows), np.zeros(rows, int), np.zeros(2, np.int64))
        trees, values = binned_trees.boost(held, specs, 1)[0][0]
        return held, [x.tolist() for x in (trees.feature, trees.cut, trees.left, trees.weight, trees.total, values)]

    (_, expected), (bagged, got) = grown(binned_trees.HeldRows), grown(binned_trees.BaggedRows)
    drawn = binned_trees.weights(specs, 0, np.arange(rows), np.zeros(rows, int)) > 0
    assert got == expected and all(len(bag.at) <= n for bag, n in zip(bagged.bags, drawn.sum(1)))


def test_rows_in_few_files_meet_a_model_in_many_tasks(df):
    model = ensemble.fit_forest(df, FEATURES, "y", trees=2, depth=2)
    few = model.predict(df.coalesce(1), "y")
    assert few.rdd.getNumPartitions() >= 8 and sorted(few.collect()) == sorted(model.predict(df, "y").collect())


def test_rounds_of_shared_rows_are_written_together(df, monkeypatch):
    labels, plain = [], binned_trees.written
    monkeypatch.setattr(binned_trees, "written", lambda rows, label="table": labels.append(label) or plain(rows, label))
    params = {"rounds": 10, "depth": 2, "rate": 0.3, "rows": 0.8, "columns": 1.0}
    shared, held = (ensemble.fit_boosted(df, FEATURES, "y", limit=limit, **params) for limit in (0, None))
    assert all(np.array_equal(a, b) for x, y in zip(shared.trees, held.trees) for a, b in zip(x, y)) and len(shared.trees) == len(held.trees) == 10
    assert labels.count("round") == 1  # nine rounds are followed by another


def test_drawn_rows_are_even_and_apart():
    keys = np.arange(200_000)
    a, b = binned_trees.uniform(keys, 42), binned_trees.uniform(keys, 43)
    assert abs(a.mean() - 0.5) < 0.005 and abs(np.corrcoef(a, b)[0, 1]) < 0.01 and abs(np.corrcoef(a[1:], a[:-1])[0, 1]) < 0.01
    counts = np.bincount(np.searchsorted(binned_trees.BOOTSTRAP, a, "right"))
    assert abs((np.arange(len(counts)) * counts).sum() / len(keys) - 1) < 0.01


def test_trees_of_odd_tables(spark, tmp_path):
    schema = "idx long, a double, b double, y double"
    empty = spark.createDataFrame([], schema)
    one = spark.createDataFrame([(1, 0.5, None, 2.0), (2, 0.5, 1.0, 3.0), (2, 0.5, 1.0, 3.0), (None, 0.5, 1.0, 9.0)], schema)
    for limit in (None, 0):
        assert ensemble.fit_forest(empty, ["a", "b"], "y", trees=2, depth=3, limit=limit).predict(empty, "y").count() == 0
        model = ensemble.fit_boosted(one, ["a", "b"], "y", rounds=2, rate=1.0, rows=1.0, limit=limit)  # equal rows: leaves only
        assert {(r["idx"], round(r["predicted"], 6)) for r in model.predict(one, "y").collect()} == {(2, 3.0)}
        assert ensemble.grid_search(one, ["a", "b"], "y", {"rounds": [1], "depth": [2], "rate": [0.5], "rows": [1.0], "columns": [1.0]}, folds=2, limit=limit).count() == 1


def test_saved_models(df, tmp_path):
    forest = ensemble.fit_forest(df, FEATURES, "y", trees=5, depth=4)
    boosted = ensemble.fit_boosted(df, FEATURES, "y", rounds=5)
    for model in (forest, boosted):
        rows = ensemble.score_rows(model, df, "y").toPandas()
        assert ((rows.actual - rows.predicted) ** 2).mean() < rows.actual.var() / 2
    classes = ensemble.fit_entropy_tree(df.withColumn("code", (F.col("label") == "u").cast("double")), FEATURES, "code", maxDepth=2)
    assert classes.depth <= 2
    path = str(tmp_path / "model")
    assert ensemble.save_if_best(forest, path, 0.5, None)
    again = binned_trees.Ensemble.load(path)
    assert sorted(map(tuple, again.predict(df, "y").collect())) == sorted(map(tuple, forest.predict(df, "y").collect()))
    history = df.sparkSession.createDataFrame([(0.4,)], "metric double")
    assert not ensemble.save_if_best(boosted, path, 0.5, history)


def test_forecast_equals_a_plain_recursion(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(rng.integers(0, 3)), pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=7 * i), *rng.random(3).tolist()) for i in range(300)]
    rows.append((300, 9, pd.Timestamp("2024-01-01"), 0.5, 0.5, 0.5))   # a series shorter than the window
    pdf = pd.DataFrame(rows, columns=["idx", "cell", "time", "mag", "dmin", "rms"])
    df = spark.createDataFrame(pdf, "idx bigint, cell int, time timestamp_ntz, mag double, dmin double, rms double").repartition(4)
    got = forecast.forecast(df, "cell", days=0.25, lags=3).toPandas().sort_values(["cell", "timestamp"])
    t = list(forecast.TARGETS)
    low, width = pdf[t].min(), pdf[t].max() - pdf[t].min()
    z = pdf.assign(**((pdf[t] - low) / width)).sort_values(["cell", "time"])
    design = pd.concat([z.groupby("cell")[t].shift(j).add_suffix(f"_{j}") for j in (1, 2, 3)], axis=1)
    ok = design.notna().all(axis=1)
    x = np.column_stack([np.ones(ok.sum()), design[ok]])
    w = np.linalg.lstsq(x, z.loc[ok, t].to_numpy(), rcond=None)[0]
    for cell, g in z.groupby("cell"):
        hist = [g[t].to_numpy()[max(0, len(g) - 1 - j)] for j in range(3)]
        mine = got[got.cell == cell]
        assert len(mine) == 6
        for k in range(6):
            new = np.concatenate([[1.0], *hist]) @ w
            hist = [new, *hist[:2]]
            assert mine[t].to_numpy()[k] == pytest.approx((new * width + low).to_numpy(), abs=1e-8)
        assert mine.timestamp.iloc[0] == g.time.max() + pd.Timedelta("1h")


def test_registered_models_use_the_full_settings(spark, monkeypatch):
    from faultline.plans import QUERIES, model_queries

    asked = {}

    def spy(name, result):
        def run(*args, **kw):
            asked[name] = (args, kw)
            return result
        return run

    out = spark.range(1)
    monkeypatch.setattr(model_queries, "_base_splits", lambda spark, d: {"train": None, "valid": None, "test": None})
    for name, result in (("fit_forest", None), ("fit_boosted", None), ("score_rows", out), ("grid_search", out)):
        monkeypatch.setattr(model_queries.ensemble, name, spy(name, result))
    monkeypatch.setattr(model_queries.tree, "grid_scores", spy("grid_scores", out))
    for name in ("ml_rf", "ml_gbt", "ml_grid_cv", "ml_tree_grid"):
        QUERIES[name](spark, "")
    for name in ("fit_forest", "fit_boosted", "grid_search"):
        assert len(asked[name][0]) == 3 and not asked[name][1]  # nothing but the functions' own settings
    depths, minima = asked["grid_scores"][0][-2:]
    assert list(depths) == list(range(2, 21)) and list(minima) == list(range(2, 21))


def test_registered_forecasts_use_a_week_of_hours(spark, monkeypatch):
    from faultline.plans import QUERIES, model_queries

    asked = []
    monkeypatch.setattr(model_queries, "_series", lambda spark, d: None)
    monkeypatch.setattr(model_queries.forecast, "forecast", lambda df, series, **kw: asked.append(kw["lags"]) or spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1), 0.5)], "cell int, timestamp timestamp_ntz, mag double"))
    for name in ("fc_recursive", "sink_forecast_payload"):
        QUERIES[name](spark, "")
    assert asked == [168, 168]


def test_forecast_from_168_rows_equals_a_plain_recursion(spark, many_partitions):
    """One series longer than the window, one shorter, one of a single row."""
    rng, lags = np.random.default_rng(4), 168
    rows = [(i, int(i % 9 == 0), pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=7 * i), *rng.random(3).tolist()) for i in range(1400)]
    rows.append((1400, 9, pd.Timestamp("2024-01-01"), 0.5, 0.5, 0.5))
    pdf = pd.DataFrame(rows, columns=["idx", "cell", "time", "mag", "dmin", "rms"])
    df = spark.createDataFrame(pdf, "idx bigint, cell int, time timestamp_ntz, mag double, dmin double, rms double").repartition(4)
    got = forecast.forecast(df, "cell", days=0.25, lags=lags, repeat_oldest=True).toPandas().sort_values(["cell", "timestamp"])
    t = list(forecast.TARGETS)
    low, width = pdf[t].min(), pdf[t].max() - pdf[t].min()
    z = pdf.assign(**((pdf[t] - low) / width)).sort_values(["cell", "time"])
    series = {cell: g[t].to_numpy() for cell, g in z.groupby("cell")}

    def window(v, end):
        return np.concatenate([v[max(0, end - j)] for j in range(1, lags + 1)])

    x = np.array([[1.0, *window(v, i)] for v in series.values() for i in range(1, len(v))])
    w = np.linalg.lstsq(x, np.concatenate([v[1:] for v in series.values()]), rcond=None)[0]
    for cell, v in series.items():
        state, mine = window(v, len(v)), got[got.cell == cell][t].to_numpy()
        assert len(mine) == 6
        for k in range(6):
            new = np.concatenate([[1.0], state]) @ w
            state = np.concatenate([new, state[:-3]])
            assert mine[k] == pytest.approx((new * width + low).to_numpy(), abs=1e-6)


def test_windows_of_a_series_are_met_across_batches():
    """Each row's window, newest first, whatever the batches; copies give windows to others but have none, NULLs void theirs."""
    import pyarrow as pa

    rng, lags = np.random.default_rng(6), 3
    chunk, series = np.repeat([0, 0, 0, 1, 1], [7, 2, 9, 6, 1]), np.repeat([4, 5, 6, 6, 7], [7, 2, 9, 6, 1]).tolist()
    series = [None if s == 5 else s for s in series]
    values = [[None if rng.random() < 0.06 else float(v) for v in row] for row in rng.random((len(chunk), 2))]
    own = [not (c == 1 and i < 21) for i, c in enumerate(chunk)]
    table = pa.table({"chunk": chunk, "series": pa.array(series, pa.int32()), "own": own, **{
        t: pa.array([row[k] for row in values], pa.float64()) for k, t in enumerate("ab")}})
    for repeat in (False, True):
        want = []
        for i in range(len(chunk)):
            past = [values[j] for j in range(i - 1, -1, -1) if (chunk[j], series[j]) == (chunk[i], series[i])][:lags]
            if own[i] and len(past) >= (1 if repeat else lags) and None not in sum(past + [values[i]], []):
                want.append((sum(past + past[-1:] * (lags - len(past)), []), values[i]))
        for size in (1, 2, 5, 100):
            got = [(w, y) for a, b in forecast._windows(iter(table.to_batches(size)), ("a", "b"), lags, repeat) for w, y in zip(a.tolist(), b.tolist())]
            assert got == want and len(want) > 3


def test_payload(spark):
    rows = [(7, dt.datetime(2024, 1, 2, 3, 4, 5, 678000), 1.0), (7, dt.datetime(2024, 1, 1), 2.0), (8, dt.datetime(2024, 1, 1), 3.0)]
    df = spark.createDataFrame(rows, "cell int, timestamp timestamp_ntz, mag double")
    got = {r["cell"]: r["payload"] for r in forecast.payload_columns(df, "cell").collect()}
    assert got[7] == '{"timestamp":["2024-01-01 00:00:00.000000","2024-01-02 03:04:05.678000"],"mag":[2.0,1.0]}' and '[3.0]' in got[8]


def test_mean_fill(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert fill_numeric(df).agg(F.sum("x")).first()[0] == 6.0
