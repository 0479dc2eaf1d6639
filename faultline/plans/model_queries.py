"""Imputation, models, evaluation, forecasts."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from faultline.operators import binned_trees, clean, ensemble, features, forecast, impute, knn, linear, metrics, tree, windows
from faultline.operators.profile import safe_std
from faultline.plans import views
from faultline.plans.clean_queries import _SPLIT, bin_ctes
from faultline.plans.feature_queries import _z, hot
from faultline.plans.registry import query, r, rs
from faultline.plans.window_queries import STRATIFIED

_KNN_COLS = ("latitude", "longitude", "dmin", "gap", "rms")


def _neighbours_sql(weight: float, full: bool, target: str = "gap", name: str = "knn") -> str:
    """CTEs after ``strat`` ending in ``name`` (idx, target): brute force over all pairs."""
    def std(c, train):
        return f"(SELECT stddev_samp({c}) FROM strat{' WHERE part = ' + chr(39) + 'train' + chr(39) if train else ''})"

    others = [c for c in _KNN_COLS if c != target]

    def scaled(train):
        return ", ".join(f"({c} / {std(c, train)}) * {1.0 if c in impute.GEO else weight} AS {c}" for c in others)

    diff = " + ".join(f"coalesce((q.{c} - x.{c}) ** 2, 0)" for c in others)
    shared = " + ".join(f"CASE WHEN q.{c} IS NULL OR x.{c} IS NULL THEN 0 ELSE 1 END" for c in others)
    ratio = f"({std(target, False)} / {std(target, True)})" if full else "1.0"
    return (
        f"don_{name} AS (SELECT idx, {target} AS raw, {scaled(True)} FROM strat WHERE part = 'train' AND {target} IS NOT NULL), "
        f"ask_{name} AS (SELECT idx, 1.0 AS ratio, {scaled(True)} FROM strat WHERE part = 'train' AND {target} IS NULL UNION ALL "
        f"SELECT idx, {ratio}, {scaled(not full)} FROM strat WHERE part = 'pred' AND {target} IS NULL), "
        f"pairs_{name} AS (SELECT q.idx, q.ratio, x.idx AS donor, x.raw, sqrt(({diff}) * (5.0 / ({shared}))) AS d "
        f"FROM ask_{name} q, don_{name} x), "
        f"near_{name} AS (SELECT * FROM pairs_{name} QUALIFY row_number() OVER (PARTITION BY idx ORDER BY round(d, 9), donor) <= 5), "
        f"{name} AS (SELECT idx, any_value(ratio) * coalesce(avg(raw) FILTER (d = 0), "
        f"sum(raw / nullif(d, 0)) / sum(1 / nullif(d, 0))) AS {target} FROM near_{name} GROUP BY idx)"
    )


def _measured(spark, d):
    return views.catalog(spark, d).select("idx", "latitude", "longitude", "dmin", "gap", "rms")


@query("imp_knn_gap", f"WITH {STRATIFIED}, {_neighbours_sql(0.4, True)} SELECT idx, {r('gap', 'gap')} FROM knn")
def _(spark, d):
    train, pred = impute.train_pred(_measured(spark, d))
    return impute.neighbour_values(train, pred, "gap")


@query("imp_knn_centered", f"WITH {STRATIFIED}, {_neighbours_sql(0.3, False)} SELECT c.idx, {r('coalesce(c.gap, k.gap)', 'gap')} "
       "FROM cat c LEFT JOIN knn k ON c.idx = k.idx")
def _(spark, d):
    df = _measured(spark, d)
    train, pred = impute.train_pred(df)
    options = impute.NeighbourOptions(other_weight=0.3, scale="train")
    return impute.fill_from(df.select("idx", "gap"), impute.neighbour_values(train, pred, "gap", options))


@query("imp_numeric",
       f"WITH {STRATIFIED}, {_neighbours_sql(0.4, True, 'gap', 'kg')}, {_neighbours_sql(0.4, True, 'dmin', 'kd')} "
       f"SELECT c.idx, {r('c.latitude', 'latitude')}, {r('c.longitude', 'longitude')}, {r('c.rms', 'rms')}, "
       f"{r('coalesce(c.gap, kg.gap)', 'gap')}, {r('coalesce(c.dmin, kd.dmin)', 'dmin')} "
       "FROM cat c LEFT JOIN kg ON c.idx = kg.idx LEFT JOIN kd ON c.idx = kd.idx")
def _(spark, d):
    return impute.impute_numeric(_measured(spark, d))


_RIDGE = ["latitude", "longitude", "gap", "rms"]


def _solve_sql(features, known: str, alpha: float, targets=("y",)) -> str:
    """CTEs ending in ``fit`` (w0, w1, …, b; suffixed by the target when there are
    several): elimination on the centred normal equations of ``known``."""
    n, m = len(features), len(targets)
    mean = "mu AS (SELECT " + ", ".join(
        [f"avg({c}) AS m{i}" for i, c in enumerate(features)] + [f"avg({t}) AS my{k}" for k, t in enumerate(targets)]) + " FROM kn)"
    terms = [f"sum(({a} - m{i}) * ({b} - m{j})){f' + {alpha}' if i == j else ''} AS a{i}_{j}"
             for i, a in enumerate(features) for j, b in enumerate(features)]
    terms += [f"sum(({a} - m{i}) * ({t} - my{k})) AS a{i}_{n + k}" for i, a in enumerate(features) for k, t in enumerate(targets)]
    ctes = [f"kn AS MATERIALIZED ({known})", mean, f"e0 AS MATERIALIZED (SELECT {', '.join(terms)} FROM kn, mu)"]
    for k in range(n):
        cols = [f"a{k}_{j} / a{k}_{k} AS a{k}_{j}" if i == k else f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k} AS a{i}_{j}"
                for i in range(n) for j in range(n + m)]
        ctes.append(f"e{k + 1} AS MATERIALIZED (SELECT {', '.join(cols)} FROM e{k})")
    out = []
    for k, t in enumerate(targets):
        tail = "" if m == 1 else f"_{t}"
        out += [f"a{i}_{n + k} AS w{i}{tail}" for i in range(n)]
        out.append(f"my{k} - " + " - ".join(f"a{i}_{n + k} * m{i}" for i in range(n)) + f" AS b{tail}")
    return ", ".join(ctes) + f", fit AS MATERIALIZED (SELECT {', '.join(out)} FROM e{n}, mu)"


def _complete_sql(features, y: str, source: str) -> str:
    return f"SELECT {', '.join(features)}, {y} AS y FROM {source} WHERE {y} IS NOT NULL" + "".join(f" AND {c} IS NOT NULL" for c in features)


def _ridge_sql(source: str) -> str:
    return _solve_sql(_RIDGE, _complete_sql(_RIDGE, "ln(dmin + 1)", source), 1.0)


_RIDGE_PRED = "exp(b + " + " + ".join(f"w{i} * {c}" for i, c in enumerate(_RIDGE)) + ")"


@query("imp_ridge_dmin", f"WITH {_ridge_sql('cat')} SELECT idx, {r(f'coalesce(dmin, {_RIDGE_PRED})', 'dmin')} FROM cat, fit")
def _(spark, d):
    return impute.ridge_fill(_measured(spark, d))[0].select("idx", "dmin")


@query("pipe_impute",
       f"WITH {STRATIFIED}, {_neighbours_sql(0.4, True)}, fl AS (SELECT c.idx, c.latitude, c.longitude, c.rms, c.dmin, coalesce(c.gap, k.gap) AS gap "
       f"FROM cat c LEFT JOIN knn k ON c.idx = k.idx), {_ridge_sql('fl')} "
       f"SELECT idx, {rs('latitude', 'longitude', 'rms', 'gap')}, {r(f'coalesce(dmin, {_RIDGE_PRED})', 'dmin')} FROM fl, fit")
def _(spark, d):
    return impute.impute_and_regress(_measured(spark, d))["final"]


_CBRT = ["mag", "rms", "gap", "longitude", "latitude", "elevation"]


@query("pipe_dmin_regression",
       f"WITH {STRATIFIED}, {_neighbours_sql(0.4, True)}, "
       "p AS (SELECT c.idx, c.magType, c.dmin, CASE WHEN c.dmin IS NULL THEN 'pred' ELSE 'train' END AS part, "
       + ", ".join(f"CASE WHEN {e} <> 0 THEN cbrt({e}) ELSE {e} END AS {c}" for c, e in
                   ((c, "coalesce(c.gap, k.gap)" if c == "gap" else f"c.{c}") for c in _CBRT))
       + " FROM cat c LEFT JOIN knn k ON c.idx = k.idx), "
       f"{hot('p')}, tr AS (SELECT * FROM p WHERE part = 'train') "
       f"SELECT idx, part, ml, mb, md, mww, others, {r('dmin', 'dmin')}, " + ", ".join(r(_z(c, "tr"), c) for c in _CBRT) + " FROM hot")
def _(spark, d):
    cat = views.catalog(spark, d).select("idx", "magType", "mag", "rms", "gap", "dmin", "longitude", "latitude", "elevation")
    train, pred = impute.train_pred(cat)
    return impute.dmin_regression_table(cat, impute.neighbour_values(train, pred, "gap"))


# --- neighbours as classifier ---------------------------------------------------

_VOTE = ["latitude", "longitude", "rms"]
_NEAR_LABELS = (
    f"{STRATIFIED}, sd AS (SELECT {', '.join(f'coalesce(nullif(stddev_samp({c}), 0), 1) AS s_{c}' for c in _VOTE)} FROM strat WHERE part = 'train'), "
    f"sc AS (SELECT idx, part, magType, {', '.join(f'{c} / s_{c} AS {c}' for c in _VOTE)} FROM strat, sd), "
    "pairs AS (SELECT q.idx, q.magType AS actual, x.idx AS donor, x.magType AS label, sqrt("
    + " + ".join(f"(q.{c} - x.{c}) ** 2" for c in _VOTE) + ") AS distance FROM sc q, sc x WHERE q.part = 'pred' AND x.part = 'train'), "
    "near AS (SELECT *, row_number() OVER (PARTITION BY idx ORDER BY round(distance, 9), donor) AS rank FROM pairs QUALIFY rank <= 5)"
)


def _near_labels(spark, d):
    cat = views.catalog(spark, d).select("idx", "magType", "latitude", "longitude", "rms", "gap")
    train, pred = impute.train_pred(cat)
    std = train.agg(*[safe_std(c).alias(c) for c in _VOTE]).first()

    def scaled(df):
        return df.select("idx", "magType", *[(F.col(c) / F.lit(std[c])).alias(c) for c in _VOTE])

    return scaled(pred), knn.nearest(scaled(pred), scaled(train), _VOTE, 5, "magType")


@query("topk_nearest", f"WITH {_NEAR_LABELS} SELECT idx, CAST(rank AS INT) AS rank, {r('distance', 'distance')}, donor FROM near")
def _(spark, d):
    return _near_labels(spark, d)[1].drop("value")


@query("ml_knn_classify",
       f"WITH {_NEAR_LABELS}, votes AS (SELECT idx, actual, label, count(*) AS n, min(rank) AS first FROM near GROUP BY 1, 2, 3) "
       "SELECT idx, actual, label AS predicted FROM votes QUALIFY row_number() OVER (PARTITION BY idx ORDER BY n DESC, first) = 1")
def _(spark, d):
    pred, near = _near_labels(spark, d)
    return pred.select("idx", F.col("magType").alias("actual")).join(knn.majority(near), "idx")


# --- linear models ----------------------------------------------------------------

_LIN = ["rms", "gap", "longitude", "latitude", "elevation", "dmin"]


@query("ml_ols_simple", "SELECT " + r("regr_slope(mag, rms)", "slope") + ", " + r("regr_intercept(mag, rms)", "intercept") + " FROM cat")
def _(spark, d):
    m = linear.fit_ols(views.catalog(spark, d), ["rms"], "mag")
    return m.table(spark).groupBy().agg(
        F.max(F.when(F.col("term") == "rms", F.col("weight"))).alias("slope"),
        F.max(F.when(F.col("term") == "intercept", F.col("weight"))).alias("intercept"))


def _fit_terms(names) -> str:
    rows = [f"SELECT 'intercept' AS term, {r('b', 'weight')} FROM fit"]
    return " UNION ALL ".join(rows + [f"SELECT '{c}', {r(f'w{i}')} FROM fit" for i, c in enumerate(names)])


_OLS = ["rms", "gap", "longitude", "latitude", "dmin"]


@query("ml_ols", f"WITH {_solve_sql(_OLS, _complete_sql(_OLS, 'mag', 'cat'), 0.0)} {_fit_terms(_OLS)}")
def _(spark, d):
    return linear.fit_ols(views.catalog(spark, d), _OLS, "mag").table(spark)


def _z_base(spark, d):
    """Complete base rows with z-scored features."""
    base = clean.model_base(views.catalog(spark, d))
    return features.fit_zscore(base, _LIN).transform(base)


def _descent_sql(rate: float = 0.001, iterations: int = 50_000, tolerance: float = 1e-6) -> str:
    """The recurrence on the sums of products, one row per iteration."""
    z = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in _LIN)
    x = ["1.0", *_LIN]
    p = len(x)
    sums = [f"avg({a} * {b}) AS a{i}_{j}" for i, a in enumerate(x) for j, b in enumerate(x)]
    sums += [f"avg({a} * mag) AS c{i}" for i, a in enumerate(x)] + ["avg(mag * mag) AS s"]
    new = ", ".join(f"t{i} - {rate} * (" + " + ".join(f"a{i}_{j} * t{j}" for j in range(p)) + f" - c{i}) AS t{i}" for i in range(p))
    cost = ("0.5 * (" + " + ".join(f"t{i} * t{j} * a{i}_{j}" for i in range(p) for j in range(p)) + " - 2 * ("
            + " + ".join(f"c{i} * t{i}" for i in range(p)) + ") + s)")
    ts = ", ".join(f"t{i}" for i in range(p))
    terms = " UNION ALL ".join(f"SELECT '{n}' AS term, {r(f't{i}', 'weight')} FROM last" for i, n in enumerate(["intercept", *_LIN]))
    return (
        f"WITH RECURSIVE z AS (SELECT mag, {z} FROM base), g AS MATERIALIZED (SELECT {', '.join(sums)} FROM z), "
        f"it AS (SELECT 0 AS i, {', '.join(f'0.0::DOUBLE AS t{i}' for i in range(p))}, NULL::DOUBLE AS cost, false AS done UNION ALL "
        f"SELECT i + 1, {ts}, now, coalesce(abs(cost - now) < {tolerance}, false) FROM (SELECT i, {ts}, cost, {cost} AS now FROM "
        f"(SELECT i, cost, g.*, {new} FROM it, g WHERE NOT done AND i < {iterations}))), "
        f"last AS (SELECT * FROM it ORDER BY i DESC LIMIT 1) {terms}"
    )


@query("ml_lr_gd", _descent_sql(), ("base",))
def _(spark, d):
    return linear.fit_gradient_descent(_z_base(spark, d), _LIN, "mag", theta0=[0.0] * (len(_LIN) + 1)).table(spark)


@query("ml_sgd")
def _(spark, d):
    return linear.fit_sgd(_z_base(spark, d), _LIN, "mag").table(spark)


@query("ml_compare")
def _(spark, d):
    z = _z_base(spark, d)
    models = {
        "gradient_descent": linear.fit_gradient_descent(z, _LIN, "mag"),
        "least_squares": linear.fit_ols(z, _LIN, "mag"),
        "sgd": linear.fit_sgd(z, _LIN, "mag"),
    }
    return metrics.regression_metrics(linear.compare_models(z, models, "mag"), "actual", "predicted", by=("model",))


# --- trees ------------------------------------------------------------------------

_TREE = ["rms", "longitude", "latitude", "elevation"]


def _root_sql() -> str:
    parts = []
    for i, c in enumerate(_TREE):
        probs = "[" + ", ".join(repr(p) for p in tree.THRESHOLD_PROBS) + "]"
        parts.append(
            f"SELECT {i} AS feature, t, count(*) AS n, count(*) FILTER (x <= t) AS nl, "
            "var_pop(mag) AS v, var_pop(mag) FILTER (x <= t) AS vl, var_pop(mag) FILTER (x > t) AS vr FROM "
            f"(SELECT (q[k] + q[k + 1]) / 2 AS t FROM (SELECT quantile_cont({c}, {probs}) AS q FROM cat), (SELECT unnest(range(1, 20)) AS k)), "
            f"(SELECT {c} AS x, mag FROM cat) GROUP BY t")
    return ("WITH s AS (" + " UNION ALL ".join(parts) + "), g AS (SELECT feature, t, v - (nl * vl + (n - nl) * vr) / n AS gain, v FROM s "
            f"WHERE nl > 0 AND nl < n) SELECT CAST(feature AS INT) AS feature, {r('t', 'threshold')}, {r('gain', 'gain')} FROM g "
            "ORDER BY round(gain / v, 12) DESC, feature, t LIMIT 1")


@query("ml_tree_root_split", _root_sql())
def _(spark, d):
    grown = tree.fit_regression_tree(views.catalog(spark, d), _TREE, "mag", max_depth=0)
    return grown.filter("node = 0").select("feature", "threshold", "gain")


def _first_rows(names, y: str, source: str) -> str:
    return ("SELECT idx, 0::BIGINT AS node, " + ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(names))
            + f", {y} AS y FROM {source}")


def _next_rows(names, rows: str, level: int) -> str:
    """Rows of ``rows{level}`` moved to the children their node's split sends them to."""
    xs = ", ".join(f"x{i}" for i in range(len(names)))
    return (f"{rows}{level + 1} AS MATERIALIZED (SELECT idx, CASE WHEN feature IS NULL THEN node ELSE node * 2 + 1 + "
            f"CASE WHEN list_value({xs})[feature + 1] > t THEN 1 ELSE 0 END END AS node, {xs}, y "
            f"FROM {rows}{level} LEFT JOIN b{level} USING (node))")


def _grown_sql(names, y: str, levels: int, min_sample: int, impurity: str, gains: str, source: str = "cat", digits: int = tree.TIE_DIGITS) -> str:
    """CTEs ending in ``r<levels>`` (idx, node, x0…, y): every level splits the nodes
    that gain. ``gains`` fills CTE ``g{l}`` (node, feature, t, gain, v) from ``v{l}``."""
    ctes = [f"r0 AS ({_first_rows(names, y, source)})"]
    for k in range(levels):
        ctes += [
            f"s{k} AS MATERIALIZED (SELECT node, count(*) AS n, {impurity.format(l=k)} AS v FROM r{k} GROUP BY node)",
            f"v{k} AS MATERIALIZED (SELECT r{k}.*, n, v FROM r{k} JOIN s{k} USING (node) WHERE n >= {min_sample} AND v > 0)",
            gains.format(l=k),
            f"b{k} AS MATERIALIZED (SELECT node, feature, t FROM g{k} WHERE round(gain / v, {digits}) > 0 "
            f"QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain / v, {digits}) DESC, feature, t) = 1)",
            _next_rows(names, "r", k),
        ]
    return ", ".join(ctes)


def _variance_gains(names) -> str:
    probs = "[" + ", ".join(f"{p!r}e0" for p in tree.THRESHOLD_PROBS) + "]"  # plain literals would be decimals, and off by a bit
    place = "(len(l) - 1) * p"
    value = f"l[1 + CAST(floor({place}) AS BIGINT)] + (l[1 + CAST(ceil({place}) AS BIGINT)] - l[1 + CAST(floor({place}) AS BIGINT)]) * ({place} - floor({place}))"
    cuts = " UNION ALL ".join(f"SELECT node, {i} AS feature, list_transform({probs}, lambda p: {value}) AS q FROM (SELECT node, list_sort(list(x{i})) AS l FROM v{{l}} GROUP BY node)"
                              for i in range(len(names)))
    sums = " UNION ALL ".join(
        f"SELECT node, feature, t, any_value(v) AS v, any_value(n) AS n, count(*) FILTER (x{i} <= t) AS nl, "
        f"var_pop(y) FILTER (x{i} <= t) AS vl, var_pop(y) FILTER (x{i} > t) AS vr FROM c{{l}} JOIN v{{l}} USING (node) WHERE feature = {i} "
        "GROUP BY node, feature, t" for i in range(len(names)))
    return (f"c{{l}} AS MATERIALIZED (SELECT DISTINCT node, feature, (q[k] + q[k + 1]) / 2 AS t FROM ({cuts}), (SELECT unnest(range(1, 20)) AS k)), "
            f"g{{l}} AS MATERIALIZED (SELECT node, feature, t, v, v - (nl * vl + (n - nl) * vr) / n AS gain FROM ({sums}) WHERE nl > 0 AND nl < n)")


@query("ml_tree_reg", f"WITH {_grown_sql(_TREE, 'mag', 12, 20, 'var_pop(y)', _variance_gains(_TREE))} "
       f"SELECT idx, {r('y', 'mag')}, node, count(*) OVER (PARTITION BY node) AS leaf_rows, {r('sum(y) OVER (PARTITION BY node)', 'leaf_sum')} FROM r12")
def _(spark, d):
    cat = views.catalog(spark, d)
    grown = tree.fit_regression_tree(cat, _TREE, "mag", max_depth=11, min_sample=20)
    leaves = grown.select("node", F.col("n").alias("leaf_rows"), (F.col("value") * F.col("n")).alias("leaf_sum"))  # means may end on a half digit, sums do not
    return tree.with_path(cat, grown, _TREE, ["idx", "mag"]).join(leaves, "node").select("idx", "mag", "node", "leaf_rows", "leaf_sum")


_CLASS = ["mag", "rms", "latitude"]


def _gain_sql() -> str:
    labels = ("mb", "md", "mh", "ml", "mwb", "mww")
    long = " UNION ALL ".join(f"SELECT {i} AS feature, {c} AS v, magType FROM cat" for i, c in enumerate(_CLASS))
    per = ", ".join(f"count(*) FILTER (magType = '{lb}') AS c{i}" for i, lb in enumerate(labels))
    left = ", ".join(f"sum(c{i}) OVER (PARTITION BY feature ORDER BY v) AS l{i}, sum(c{i}) OVER (PARTITION BY feature) AS t{i}"
                     for i in range(len(labels)))

    def entropy(parts, total):
        return " - ".join(["0"] + [f"CASE WHEN {x} > 0 THEN ({x} / {total}) * ln({x} / {total}) ELSE 0 END" for x in parts])

    ls, ts = [f"l{i}" for i in range(len(labels))], [f"t{i}" for i in range(len(labels))]
    rest = [f"({t} - {x})" for t, x in zip(ts, ls)]
    return (f"WITH lg AS ({long}), pc AS (SELECT feature, v, {per} FROM lg GROUP BY 1, 2), cu AS (SELECT feature, v, {left} FROM pc), "
            f"tt AS (SELECT *, {' + '.join(ls)} AS nl, {' + '.join(ts)} AS n FROM cu), "
            f"g AS (SELECT feature, v, {entropy(ts, 'n')} AS h, (nl / n) * ({entropy(ls, 'nl')}) + ((n - nl) / n) * ({entropy(rest, '(n - nl)')}) AS rest "
            "FROM tt WHERE nl < n) "
            f"SELECT CAST(feature AS INT) AS feature, {r('v', 'threshold')}, {r('h - rest', 'gain')} FROM g "
            f"ORDER BY round((h - rest) / h, {tree.CLASS_DIGITS}) DESC, feature, v LIMIT 1")


@query("ml_info_gain", _gain_sql())
def _(spark, d):
    grown = tree.fit_classification_tree(views.catalog(spark, d), _CLASS, "magType", max_depth=0)
    return grown.filter("node = 0").select("feature", "threshold", "gain")


_LABELS = ("mb", "md", "mh", "ml", "mwb", "mww")


def _h(parts, total: str) -> str:
    return "(0 - " + " - ".join(f"CASE WHEN {x} > 0 THEN ({x} / ({total})) * ln({x} / ({total})) ELSE 0 END" for x in parts) + ")"


def _entropy_gains(names) -> str:
    per = ", ".join(f"count(*) FILTER (y = '{lb}') AS c{i}" for i, lb in enumerate(_LABELS))
    counts = " UNION ALL ".join(f"SELECT node, {i} AS feature, x{i} AS t, any_value(v) AS v, any_value(n) AS n, {per} FROM v{{l}} GROUP BY node, t"
                                for i in range(len(names)))
    left = [f"sum(c{i}) OVER w" for i in range(len(_LABELS))]
    whole = [f"sum(c{i}) OVER (PARTITION BY node, feature)" for i in range(len(_LABELS))]
    ls, rs_ = [f"l{i}" for i in range(len(_LABELS))], [f"(t{i} - l{i})" for i in range(len(_LABELS))]
    cols = ", ".join(f"{a} AS l{i}, {b} AS t{i}" for i, (a, b) in enumerate(zip(left, whole)))
    nl = " + ".join(ls)
    return (f"c{{l}} AS MATERIALIZED (SELECT node, feature, t, v, n, {cols} FROM ({counts}) WINDOW w AS (PARTITION BY node, feature ORDER BY t)), "
            f"g{{l}} AS MATERIALIZED (SELECT node, feature, t, v, v - (({nl}) * {_h(ls, nl)} + (n - ({nl})) * {_h(rs_, f'n - ({nl})')}) / n AS gain "
            f"FROM c{{l}} WHERE {nl} < n)")


_NODE_ENTROPY = _h([f"count(*) FILTER (y = '{lb}')" for lb in _LABELS], "count(*)")


@query("ml_tree_cls", f"WITH {_grown_sql(_CLASS, 'magType', 3, 2, _NODE_ENTROPY, _entropy_gains(_CLASS), digits=tree.CLASS_DIGITS)}, "
       "votes AS (SELECT node, y, count(*) AS n FROM r3 GROUP BY 1, 2), "
       "top AS (SELECT node, y AS predicted FROM votes QUALIFY row_number() OVER (PARTITION BY node ORDER BY n DESC, y) = 1) "
       "SELECT idx, y AS magType, predicted FROM r3 JOIN top USING (node)")
def _(spark, d):
    cat = views.catalog(spark, d)
    grown = tree.fit_classification_tree(cat, _CLASS, "magType", max_depth=2, min_sample=2)
    return tree.predict(cat, grown, _CLASS, ["idx", "magType"])


def _base_splits(spark, d):
    parts = windows.split_sequential(clean.model_base(views.catalog(spark, d)))
    return {name: parts.filter(F.col("split") == name).drop("split") for name in ("train", "valid", "test")}


_DEPTHS, _MINIMA = range(2, 5), range(2, 21)  # of the short form; the full one has depths 2 to 20


def _grid_sql() -> str:
    levels = max(_DEPTHS) + 1
    walk = [f"w0 AS ({_first_rows(_TREE, 'mag', 'held')})"] + [_next_rows(_TREE, "w", k) for k in range(levels)]
    means = [f"a{k} AS (SELECT node, count(*) AS n, avg(y) AS value FROM r{k} GROUP BY node)" for k in range(levels + 1)]
    path = " UNION ALL ".join(
        f"SELECT idx, y, {k} AS level, n, value, " + (f"node IN (SELECT node FROM b{k})" if k < levels else "false")
        + f" AS cut FROM w{k} JOIN a{k} USING (node)" for k in range(levels + 1))
    return (
        f"WITH {_SPLIT}, tr AS (SELECT * FROM splits WHERE split = 'train'), held AS (SELECT * FROM splits WHERE split = 'valid'), "
        f"{_grown_sql(_TREE, 'mag', levels, min(_MINIMA), 'var_pop(y)', _variance_gains(_TREE), 'tr')}, {', '.join(walk + means)}, "
        f"path AS MATERIALIZED ({path}), grid AS (SELECT unnest(range({min(_DEPTHS)}, {max(_DEPTHS) + 1})) AS depth), "
        f"minima AS (SELECT unnest(range({min(_MINIMA)}, {max(_MINIMA) + 1})) AS min_sample), "
        "p AS (SELECT depth, min_sample, idx, any_value(y) AS y, arg_min(value, level) AS p FROM path, grid, minima "
        "WHERE level > depth OR n < min_sample OR NOT cut GROUP BY 1, 2, 3) "
        "SELECT CAST(depth AS INT) AS depth, CAST(min_sample AS INT) AS min_sample, "
        + r("1 - sum((y - p) ** 2) / (var_pop(y) * count(*))", "r2") + " FROM p GROUP BY 1, 2"
    )


@query("ml_tree_grid_short", _grid_sql(), ("base",))
def _(spark, d):
    parts = _base_splits(spark, d)
    return tree.grid_scores(parts["train"], parts["valid"], _TREE, "mag", _DEPTHS, _MINIMA)


@query("ml_tree_grid")
def _(spark, d):
    parts = _base_splits(spark, d)
    return tree.grid_scores(parts["train"], parts["valid"], _TREE, "mag", range(2, 21), _MINIMA)


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in [*_LIN, "mag"])


def _coded_sql() -> str:
    """CTEs ending in ``coded`` (idx, split, mag, y, x0…): the target in fixed point and the bins of all columns."""
    bins = binned_trees.BINS
    cuts = ", ".join(
        f"cut{i} AS MATERIALIZED (SELECT coalesce(list(v ORDER BY v), []) AS cuts{i} FROM (SELECT v, c, sum(c) OVER (ORDER BY v) AS e, sum(c) OVER () AS n "
        f"FROM (SELECT CAST({c} AS DOUBLE) AS v, count(*) AS c FROM tr GROUP BY 1)) WHERE e < n AND e * {bins} // n > (e - c) * {bins} // n)"
        for i, c in enumerate(_LIN))
    codes = ", ".join(f"len(list_filter(cuts{i}, lambda c: c < {c})) AS x{i}" for i, c in enumerate(_LIN))
    return (
        f"{_SPLIT}, cr AS (SELECT * FROM splits WHERE split <> 'valid' AND {_COMPLETE}), tr AS (SELECT * FROM cr WHERE split = 'train'), {cuts}, "
        f"fixed AS (SELECT pow(2, {binned_trees.BITS - 1} - floor(log2(max(abs(mag))))) AS unit FROM tr), "
        f"coded AS MATERIALIZED (SELECT idx, split, mag, unit, CAST(floor(mag * unit + 0.5) AS BIGINT) AS y, {codes} "
        f"FROM cr, fixed, {', '.join(f'cut{i}' for i in range(len(_LIN)))})")


_XS = ", ".join(f"x{i}" for i in range(len(_LIN)))


def _best_sql(rows: str, weight: str, rest: str, where: str, keys: str, penalty: float) -> str:
    """Best split (``keys``, f, at) of each node among ``rows``: highest gain, first column, lowest bin."""
    h = " UNION ALL ".join(f"SELECT {keys}, {i} AS f, x{i} AS bin, sum({weight}) AS w, sum({rest}) AS s FROM {rows} WHERE {where} GROUP BY {keys}, x{i}"
                           for i in range(len(_LIN)))

    def square(s, w):
        return f"CAST({s} AS DOUBLE) * CAST({s} AS DOUBLE) / (CAST({w} AS DOUBLE) + {penalty})"

    gain = f"{square('sl', 'wl')} + {square('st - sl', 'wt - wl')} - {square('st', 'wt')}"
    return (f"SELECT {keys}, f, bin FROM (SELECT *, {gain} AS gain FROM (SELECT {keys}, f, bin, sum(w) OVER a AS wl, sum(s) OVER a AS sl, sum(w) OVER p AS wt, "
            f"sum(s) OVER p AS st FROM ({h}) WINDOW a AS (PARTITION BY {keys}, f ORDER BY bin), p AS (PARTITION BY {keys}, f)) WHERE wl < wt) "
            f"WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY gain DESC, f, bin) = 1")


_CODE_AT = "CASE f " + " ".join(f"WHEN {i} THEN x{i}" for i in range(len(_LIN))) + " END"


def _forest_sql(trees: int, depth: int, seed: int) -> str:
    """The forest level by level: in-bag rows carry their weight, test rows walk along with weight 0."""
    counts = " + ".join(f"CASE WHEN u >= {p!r} THEN 1 ELSE 0 END" for p in binned_trees.BOOTSTRAP)
    ctes = [f"r0 AS MATERIALIZED (SELECT * FROM (SELECT idx, mag, unit, tree, 0::BIGINT AS node, CASE WHEN split = 'train' THEN {counts} ELSE 0 END AS w, split, y, {_XS} "
            f"FROM (SELECT *, {binned_trees.uniform_sql('idx', f'{seed} + tree')} AS u FROM coded, range({trees}) t(tree))) WHERE split = 'test' OR w > 0)"]
    for k in range(depth):
        best = _best_sql(f"r{k}", "w", "w * y", f"w > 0 AND node >= {2 ** k - 1}", "tree, node", 0.0)
        ctes.append(f"b{k} AS MATERIALIZED ({best})")
        ctes.append(f"r{k + 1} AS MATERIALIZED (SELECT idx, mag, unit, tree, CASE WHEN f IS NULL THEN node ELSE node * 2 + 1 + CASE WHEN {_CODE_AT} > bin THEN 1 ELSE 0 END END AS node, "
                    f"w, split, y, {_XS} FROM r{k} LEFT JOIN b{k} USING (tree, node))")
    return (f"WITH {_coded_sql()}, {', '.join(ctes)}, leaf AS (SELECT tree, node, floor(CAST(sum(w * y) AS DOUBLE) / sum(w) + 0.5) AS v FROM r{depth} WHERE w > 0 GROUP BY 1, 2) "
            f"SELECT idx, {r('any_value(mag)', 'actual')}, {r(f'sum(v) / {trees} / any_value(unit)', 'predicted')} FROM r{depth} JOIN leaf USING (tree, node) "
            "WHERE split = 'test' GROUP BY idx")


@query("ml_rf", _forest_sql(**ensemble.FOREST), ("base",))
def _(spark, d):
    parts = _base_splits(spark, d)
    model = ensemble.fit_forest(parts["train"], _LIN, "mag")
    return ensemble.score_rows(model, parts["test"], "mag")


def _boosting_sql(models: list[tuple], rounds: int, seed: int, where: str) -> str:
    """CTEs (of a recursive WITH) ending in ``it``: one step of the recursion per level, for all ``models`` (depth, rate, rows,
    columns, fold). Rows move by the best splits of their model, and at the end of a round their prediction p takes the
    leaf's value."""
    depth = max(m[0] for m in models)
    listed = ", ".join(f"({i}, {', '.join(map(str, m))})" for i, m in enumerate(models))
    drawn = binned_trees.uniform_sql("f + 1000003", f"{seed} + turn")
    bag = f"split = 'train' AND fold <> own AND {binned_trees.uniform_sql('idx', f'{seed} + step // {depth}')} < rows"
    used = "(turn, share, f) IN (SELECT turn, share, f FROM drawn)"
    best = _best_sql("live", "1", "y - p", f"bag AND step % {depth} < depth AND node >= pow(2, step % {depth}) - 1", "m, turn, share, node", ensemble.PENALTY)
    best = best.replace(" WHERE wl < wt)", f" WHERE wl < wt AND {used})")
    last = f"step % {depth} = {depth - 1}"
    return (
        f"models AS (SELECT * FROM (VALUES {listed}) t(m, depth, rate, rows, share, own)), "
        f"placed AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY idx) - 1 AS rn, count(*) OVER (PARTITION BY split) AS n FROM coded WHERE {where}), "
        f"folded AS (SELECT * EXCLUDE (rn, n), CASE WHEN split <> 'train' THEN -2 WHEN rn < n % 5 * (n // 5 + 1) THEN rn // (n // 5 + 1) "
        "ELSE n % 5 + (rn - n % 5 * (n // 5 + 1)) // greatest(n // 5, 1) END AS fold FROM placed), "
        f"drawn AS MATERIALIZED (SELECT turn, share, f FROM (SELECT *, row_number() OVER (PARTITION BY turn, share ORDER BY {drawn}, f) AS place FROM range({rounds}) t(turn), "
        f"range({len(_LIN)}) u(f), (SELECT DISTINCT share FROM models)) WHERE place <= greatest(1, floor(share * {len(_LIN)}))), "
        "bases AS (SELECT m, CAST(floor(CAST(sum(y) AS DOUBLE) / count(*) + 0.5) AS BIGINT) AS base FROM folded, models WHERE split = 'train' AND fold <> own GROUP BY m), "
        f"it AS (SELECT 0 AS step, m, depth, rate, rows, share, own, fold, idx, mag, unit, split, 0::BIGINT AS node, y, base AS p, {_XS} FROM folded, models JOIN bases USING (m) "
        f"UNION ALL SELECT * FROM (WITH live AS MATERIALIZED (SELECT *, step // {depth} AS turn, {bag} AS bag FROM it WHERE step < {rounds * depth}), best AS MATERIALIZED ({best}), "
        f"moved AS MATERIALIZED (SELECT l.*, CASE WHEN f IS NULL THEN l.node ELSE l.node * 2 + 1 + CASE WHEN {_CODE_AT} > bin THEN 1 ELSE 0 END END AS deep "
        "FROM live l LEFT JOIN best b ON b.m = l.m AND b.node = l.node), "
        f"leaf AS MATERIALIZED (SELECT m, deep, floor(any_value(rate) * CAST(sum(y - p) AS DOUBLE) / (count(*) + {ensemble.PENALTY}) + 0.5) AS v FROM moved WHERE bag GROUP BY m, deep) "
        f"SELECT step + 1, o.m, depth, rate, rows, share, own, fold, idx, mag, unit, split, CASE WHEN {last} THEN 0 ELSE o.deep END, y, "
        f"CASE WHEN {last} THEN p + CAST(coalesce(v, 0) AS BIGINT) ELSE p END, {_XS} FROM moved o LEFT JOIN leaf ON leaf.m = o.m AND leaf.deep = o.deep))")


def _boosted_sql(rounds: int, depth: int, rate: float, rows: float, columns: float, seed: int) -> str:
    return (f"WITH RECURSIVE {_coded_sql()}, {_boosting_sql([(depth, rate, rows, columns, -1)], rounds, seed, 'true')} "
            f"SELECT idx, {r('mag', 'actual')}, {r('CAST(p AS DOUBLE) / unit', 'predicted')} FROM it WHERE step = {rounds * depth} AND split = 'test'")


@query("ml_gbt", _boosted_sql(**ensemble.BOOSTED), ("base",))
def _(spark, d):
    parts = _base_splits(spark, d)
    model = ensemble.fit_boosted(parts["train"], _LIN, "mag")
    return ensemble.score_rows(model, parts["test"], "mag")


_SMALL_SEARCH = {"rounds": [4, 8], "depth": [2, 3], "rate": [0.5, 0.1], "rows": [0.8], "columns": [0.8, 1.0]}


def _search_sql(grid: dict[str, list], folds: int = 5, seed: int = 42) -> str:
    shapes = list(product(*(grid[c] for c in ("depth", "rate", "rows", "columns"))))
    models = [(*shape, k) for shape in shapes for k in range(folds)]
    runs = ", ".join(f"({i}, {n}, {', '.join(map(str, shape))})" for i, (n, shape) in enumerate(product(grid["rounds"], shapes)))
    return (
        f"WITH RECURSIVE {_coded_sql()}, {_boosting_sql(models, max(grid['rounds']), seed, "split = 'train'")}, "
        f"runs AS (SELECT * FROM (VALUES {runs}) t(run, rounds, depth, rate, rows, columns)), "
        "e AS (SELECT step, depth, rate, rows, share, own, avg(((y - p) / unit) ** 2) AS mse FROM it WHERE fold = own GROUP BY ALL), "
        "s AS (SELECT run, any_value(rounds) AS rounds, any_value(r.depth) AS depth, any_value(r.rate) AS rate, any_value(r.rows) AS rows, any_value(columns) AS columns, avg(mse) AS mse "
        f"FROM runs r JOIN e ON e.step = r.rounds * {max(grid['depth'])} AND e.depth = r.depth AND e.rate = r.rate AND e.rows = r.rows AND e.share = r.columns GROUP BY run) "
        f"SELECT run, rounds, depth, {rs('rate', 'rows', 'columns', 'mse')}, row_number() OVER (ORDER BY s.mse, run) = 1 AS is_best FROM s")


@query("ml_grid_cv")
def _(spark, d):
    parts = _base_splits(spark, d)
    return ensemble.grid_search(parts["train"], _LIN, "mag")


@query("ml_grid_cv_short", _search_sql(_SMALL_SEARCH), ("base",))
def _(spark, d):
    parts = _base_splits(spark, d)
    return ensemble.grid_search(parts["train"], _LIN, "mag", _SMALL_SEARCH)


# --- runs, reports, forecasts --------------------------------------------------------

_RUNS = [(i, a) for i, a in enumerate((0.8, 0.9, 1.0, 1.1))]


@query("ml_runs_best",
       "WITH s AS (" + " UNION ALL ".join(
           f"SELECT {i} AS run, {a} AS shrink, sqrt(avg((mag - ({a} * mag + rms - 0.5)) ** 2)) AS rmse FROM cat" for i, a in _RUNS)
       + f") SELECT CAST(run AS INT) AS run, {r('shrink', 'shrink')}, {r('rmse', 'rmse')}, rmse = (SELECT min(rmse) FROM s) AS is_best FROM s")
def _(spark, d):
    return ensemble.mark_best(_runs(spark, d), "rmse")


def _runs(spark, d):
    scored = views.catalog(spark, d).select("mag", F.inline(F.array(*[
        F.struct(F.lit(i).alias("run"), F.lit(a).alias("shrink"), (F.lit(a) * F.col("mag") + F.col("rms") - 0.5).alias("p")) for i, a in _RUNS
    ])))
    return scored.groupBy("run", "shrink").agg(metrics.regression_exprs("mag", "p")["rmse"].alias("rmse"))


@query("topk_best_params",
       "WITH s AS (" + " UNION ALL ".join(
           f"SELECT {i} AS run, {a} AS shrink, -sqrt(avg((mag - ({a} * mag + rms - 0.5)) ** 2)) AS score FROM cat" for i, a in _RUNS)
       + f") SELECT CAST(run AS INT) AS run, {r('shrink', 'shrink')}, {r('score', 'score')} FROM s ORDER BY score DESC, run LIMIT 1")
def _(spark, d):
    scores = _runs(spark, d).withColumn("score", -F.col("rmse"))
    return tree.best_parameters(scores, ["run", "shrink"], "score", ["run"])


_TARGETS = ("mag", "dmin", "rms")


@query("ml_test_report",
       "WITH p AS (SELECT *, row_number() OVER o - 1 AS rn, count(*) OVER () AS n, "
       + ", ".join(f"lag({t}) OVER o AS prev_{t}" for t in _TARGETS) + " FROM base WINDOW o AS (ORDER BY time, idx)), "
       "test AS (SELECT * FROM p WHERE rn >= CAST(floor(n * 0.7) AS BIGINT) + CAST(floor(n * 0.15) AS BIGINT)) "
       + " UNION ALL ".join(
           f"SELECT '{t}' AS target, count(*) AS n, {r(f'sqrt(avg(({t} - prev_{t}) ** 2))', 'rmse')} FROM test" for t in _TARGETS), ("base",))
def _(spark, d):
    base = clean.model_base(views.catalog(spark, d), with_time=True).na.drop("any").select("idx", "time", *_TARGETS)
    scale = features.fit_minmax(base, list(_TARGETS))
    laid = windows.lay_out(scale.transform(base), "time", "idx")
    w = windows.frame()
    rows = windows.home(windows.chunked(laid, before=1).withColumns({f"{t}_predicted": F.lag(t).over(w) for t in _TARGETS}))
    test = rows.filter(windows.split_by_row(F.col("_row"), laid.total, 0.7, 0.15) == "test")
    report = forecast.test_report(test.withColumnsRenamed({t: f"{t}_actual" for t in _TARGETS}), scale, _TARGETS)
    return metrics.regression_metrics(report, "actual", "predicted", by=("target",)).select("target", "n", "rmse")


def _series(spark, d):
    from faultline.functions import binning
    cat = impute.ridge_fill(_measured_with_time(spark, d))[0]
    bins = binning.fit_bins(cat, ["latitude", "longitude"], 50)
    return binning.spatial_bins(cat, bins).withColumn("cell", F.col("lat_bin") * 50 + F.col("lon_bin"))


def _measured_with_time(spark, d):
    from faultline.operators.profile import fill_numeric
    cat = views.catalog(spark, d).select("idx", "time", "mag", "dmin", "rms", "gap", "latitude", "longitude")
    return fill_numeric(cat, ["gap"])


_LAGS, _WEEK = 4, 7 * 24   # rows of history: of the SQL twins, which cannot solve 504 unknowns, and of the job


def _forecast_sql(steps: int = 48) -> str:
    names = forecast.lag_names(_TARGETS, _LAGS)
    n = len(_TARGETS)
    lags = ", ".join(f"lag({t}, {j}) OVER o AS {t}_lag{j}" for j in range(1, _LAGS + 1) for t in _TARGETS)
    scaled = ", ".join(f"({t} - min({t}) OVER ()) / (max({t}) OVER () - min({t}) OVER ()) AS {t}" for t in _TARGETS)
    limits = ", ".join(f"min({t}) AS lo_{t}, max({t}) - min({t}) AS w_{t}" for t in _TARGETS)
    pred = {t: f"b_{t} + " + " + ".join(f"w{i}_{t} * s{i}" for i in range(len(names))) for t in _TARGETS}
    # State s0…: the newest row's targets first, a short series repeating its oldest row.
    state = ", ".join(f"coalesce(max({t}) FILTER (rn = {j}), arg_max({t}, rn)) AS s{(j - 1) * n + k}"
                      for j in range(1, _LAGS + 1) for k, t in enumerate(_TARGETS))
    shifted = ", ".join([f"{pred[t]} AS s{k}" for k, t in enumerate(_TARGETS)]
                        + [f"s{i - n} AS s{i}" for i in range(n, len(names))])
    known = f"SELECT {', '.join(names)}, {', '.join(_TARGETS)} FROM lg WHERE {' AND '.join(f'{c} IS NOT NULL' for c in names)}"
    filled = "gapped AS MATERIALIZED (SELECT * REPLACE (coalesce(gap, avg(gap) OVER ()) AS gap) FROM cat)"
    ridge = _ridge_sql("gapped").replace("fit AS", "rfit AS")
    for cte in ("kn", "mu", "e0", "e1", "e2", "e3", "e4"):   # the second solver needs its own names
        ridge = ridge.replace(f"{cte} AS", f"r{cte} AS").replace(f"FROM {cte}", f"FROM r{cte}").replace(f", {cte})", f", r{cte})")
    return (
        f"WITH RECURSIVE {filled}, {ridge}, "
        f"series AS (SELECT idx, time, mag, coalesce(dmin, {_RIDGE_PRED}) AS dmin, rms, latitude, longitude FROM gapped, rfit), "
        f"{bin_ctes('series', 50)}, sc AS MATERIALIZED (SELECT idx, time, CAST(lat_bin * 50 + lon_bin AS INT) AS cell, {scaled} FROM binned), "
        f"lim2 AS (SELECT {limits} FROM series), lg AS (SELECT *, {lags} FROM sc WINDOW o AS (PARTITION BY cell ORDER BY time, idx)), "
        f"{_solve_sql(names, known, 0.0, _TARGETS)}, "
        f"nw AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY time DESC, idx DESC) AS rn FROM sc QUALIFY rn <= {_LAGS}), "
        f"go AS (SELECT cell, max(time) AS last_time, 0 AS step, {state} FROM nw GROUP BY cell UNION ALL "
        f"SELECT cell, last_time, step + 1, {shifted} FROM go, fit WHERE step < {steps}) "
        f"SELECT cell, last_time + step * INTERVAL 1 HOUR AS timestamp, "
        + ", ".join(r(f"s{k} * w_{t} + lo_{t}", t) for k, t in enumerate(_TARGETS)) + " FROM go, lim2 WHERE step > 0"
    )


def _week_forecast(spark, d):
    return forecast.forecast(_series(spark, d), "cell", days=2, lags=_WEEK, repeat_oldest=True)


@query("fc_recursive")
def _(spark, d):
    return _week_forecast(spark, d)


@query("sink_forecast_payload")
def _(spark, d):
    return forecast.payload(_week_forecast(spark, d))


@query("fc_recursive_short", _forecast_sql())
def _(spark, d):
    return forecast.forecast(_series(spark, d), "cell", days=2, lags=_LAGS)


@query("sink_forecast_payload_short",
       f"SELECT cell, strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, mag, dmin, rms FROM ({_forecast_sql()})")
def _(spark, d):
    return forecast.payload(forecast.forecast(_series(spark, d), "cell", days=2, lags=_LAGS))
