"""SQL with the same results for the learning queries, for DuckDB over the base tables."""

from __future__ import annotations

from ledgerlens.registry.oracles_tables import _NUMERIC, sql

_POINTS = (
    "SELECT c_custkey AS id, CAST(c_custkey % 101 AS DOUBLE) AS x1, c_acctbal AS x2,"
    " CAST(c_acctbal < 0 AS INTEGER) AS label FROM customer"
)
_SCORED = (
    "SELECT id, label, score, CAST(score >= 0.5 AS INTEGER) AS prediction FROM (SELECT c_custkey AS id,"
    " CAST(c_acctbal < 0 AS INTEGER) AS label,"
    " CAST(c_custkey * 37 % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS score FROM customer)"
)
_HEX = "CAST('0x' || substr(md5({t}), 1, 8) AS BIGINT)"
_SPLIT = (
    "SELECT id, label, x1, x2, CASE WHEN rn <= floor(n * 0.2::DOUBLE + 0.5) THEN 'test' ELSE 'train' END AS part"
    " FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(id || '|42'), id) AS rn,"
    " count(*) OVER (PARTITION BY label) AS n FROM points)"
)
_UNDER = (
    "SELECT id, label FROM (SELECT *, row_number() OVER (PARTITION BY label"
    " ORDER BY md5(id || '|under-42'), id) AS rn FROM points)"
    " WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM points GROUP BY label))"
)


def _d2(a: str, b: str) -> str:
    return f"(({a}.x1 - {b}.x1) * ({a}.x1 - {b}.x1) + ({a}.x2 - {b}.x2) * ({a}.x2 - {b}.x2))"


# Every pair of minority rows, five nearest of each; then the round of draws.
_SMOTE = {
    "points": _POINTS,
    "rows_": "SELECT CAST(id AS VARCHAR) AS id, label, x1, x2 FROM points",
    "sizes": "SELECT label, count(*) AS n FROM rows_ GROUP BY 1",
    "small": "SELECT label AS small_label, n AS have, (SELECT max(n) FROM sizes) - n AS need FROM sizes"
    " ORDER BY n, label DESC LIMIT 1",
    "minority": "SELECT r.*, have, need, row_number() OVER (ORDER BY md5(id || '|smote-42'), id) AS rn"
    " FROM rows_ r JOIN small ON label = small_label",
    "near": "SELECT * FROM (SELECT a.id, b.x1 AS y1, b.x2 AS y2, row_number() OVER (PARTITION BY a.id"
    f" ORDER BY {_d2('a', 'b')}, b.id) AS pos, least(5, a.have - 1) AS k"
    " FROM minority a JOIN minority b ON a.id <> b.id) WHERE pos <= 5",
    "drawn": "SELECT m.*, unnest(range(1, CAST(need // have + CASE WHEN rn <= need % have THEN 1 ELSE 0 END"
    " AS BIGINT) + 1)) AS copy FROM minority m",
    "made": "SELECT d.id || '#' || d.copy AS id, d.label,"
    " d.x1 + u * (n.y1 - d.x1) AS x1, d.x2 + u * (n.y2 - d.x2) AS x2 FROM (SELECT *, "
    + _HEX.format(t="id || '|' || copy || '|neighbour-42'") + " AS pick, "
    + _HEX.format(t="id || '|' || copy || '|step-42'")
    + " / CAST(4294967296 AS DOUBLE) AS u FROM drawn) d"
    " JOIN near n ON n.id = d.id AND n.pos = d.pick % n.k + 1",
    "grown": "SELECT id, label, x1, x2 FROM rows_ UNION ALL SELECT id, label, x1, x2 FROM made",
}
_CELLS = (
    "SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) AS n00,"
    " count(*) FILTER (WHERE label = 0 AND prediction = 1) AS n01,"
    " count(*) FILTER (WHERE label = 1 AND prediction = 0) AS n10,"
    " count(*) FILTER (WHERE label = 1 AND prediction = 1) AS n11 FROM scored"
)
_CLASSES = (
    "SELECT c AS class, precision, recall, support, coalesce(2 * precision * recall"
    " / nullif(precision + recall, 0), 0) AS f1 FROM (SELECT c,"
    " coalesce(count(*) FILTER (WHERE label = c AND prediction = c)"
    " / nullif(CAST(count(*) FILTER (WHERE prediction = c) AS DOUBLE), 0), 0) AS precision,"
    " coalesce(count(*) FILTER (WHERE label = c AND prediction = c)"
    " / nullif(CAST(count(*) FILTER (WHERE label = c) AS DOUBLE), 0), 0) AS recall,"
    " CAST(count(*) FILTER (WHERE label = c) AS DOUBLE) AS support"
    " FROM scored CROSS JOIN (VALUES (0), (1)) AS v(c) GROUP BY c)"
)
_REPORT_ROWS = " UNION ALL ".join(
    [
        f"SELECT CAST(class AS VARCHAR) AS class, '{m}' AS metric, round({m}, 9) AS value FROM classes"
        for m in ("precision", "recall", "f1", "support")
    ]
    + [f"SELECT 'macro avg', '{m}', round(avg({m}), 9) FROM classes" for m in ("precision", "recall", "f1")]
    + [
        f"SELECT 'weighted avg', '{m}', round(sum({m} * support) / sum(support), 9) FROM classes"
        for m in ("precision", "recall", "f1")
    ]
    + [f"SELECT '{a}', 'support', sum(support) FROM classes" for a in ("macro avg", "weighted avg")]
    + [
        "SELECT 'accuracy', 'accuracy', round(avg(CASE WHEN label = prediction THEN CAST(1 AS DOUBLE)"
        " ELSE 0 END), 9) FROM scored"
    ]
)

# The train part in folds by the hash of the id. What a fit gives has no SQL; the rows it is rated on have.
_FOLD = _HEX.format(t="id || '|fold-42'") + " % {n}"
_RATED = "count(*) AS test_rows, CAST(sum(label) AS BIGINT) AS positives"
_MODELS = "(VALUES ('LogitReg'), ('KNN'), ('LDA'), ('CART'), ('SVM'), ('XGB'), ('RF')) AS m(model)"
_FOLDS = (
    f"SELECT {_FOLD.format(n=10)} AS fold, {_RATED}, sum(label) > 0 AND sum(label) < count(*) AS auc_valid"
    " FROM split WHERE part = 'train' GROUP BY 1"
)
_BALANCED = (
    "SELECT id, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(id || '|under-42'),"
    " CAST(id AS VARCHAR)) AS rn FROM split WHERE part = 'train') WHERE rn <= (SELECT min(n) FROM"
    " (SELECT count(*) AS n FROM split WHERE part = 'train' GROUP BY label))"
)

# Pooled covariance of two classes in two columns, its inverse written out, and the linear score.
_LDA = {
    "points": _POINTS,
    "split": _SPLIT,
    "train": "SELECT * FROM split WHERE part = 'train'",
    "means": "SELECT label, count(*)::DOUBLE AS n, avg(x1) AS a, avg(x2) AS b FROM train GROUP BY 1",
    "pooled": "SELECT sum((x1 - a) ** 2) / (sum(1) - 2) AS s11, sum((x1 - a) * (x2 - b)) / (sum(1) - 2) AS s12,"
    " sum((x2 - b) ** 2) / (sum(1) - 2) AS s22 FROM train JOIN means USING (label)",
    "solved": "SELECT (s22 * (q.a - p.a) - s12 * (q.b - p.b)) / (s11 * s22 - s12 * s12) AS w1,"
    " (s11 * (q.b - p.b) - s12 * (q.a - p.a)) / (s11 * s22 - s12 * s12) AS w2, p.a + q.a AS a2, p.b + q.b AS b2,"
    " ln(q.n / p.n) AS odds FROM pooled, means p, means q WHERE p.label = 0 AND q.label = 1",
}
# The angle of the first axis of two centred columns; a direction's greater loading is positive.
_PCA = {
    "points": _POINTS,
    "centred": "SELECT id, label, x1 - avg(x1) OVER () AS u, x2 - avg(x2) OVER () AS v FROM points",
    "turned": "SELECT 0.5 * atan2(2 * covar_samp(u, v), var_samp(u) - var_samp(v)) AS t FROM centred",
    "signs": "SELECT cos(t) AS c, sin(t) AS s, CASE WHEN CASE WHEN abs(cos(t)) >= abs(sin(t)) THEN cos(t) ELSE sin(t)"
    " END < 0 THEN -1 ELSE 1 END AS g, CASE WHEN CASE WHEN abs(sin(t)) >= abs(cos(t)) THEN -sin(t) ELSE cos(t)"
    " END < 0 THEN -1 ELSE 1 END AS h FROM turned",
}
_TEST_ROWS = "SELECT id, label, true AS score_valid, true AS prediction_follows FROM split WHERE part = 'test'"
_ACTIONS = "SELECT c_custkey AS id, true AS probability_valid, true AS action_allowed, true AS label_follows FROM customer"
_REPORT_NAMES = (
    "SELECT CAST(c AS VARCHAR) AS class, metric, CASE WHEN metric = 'support' THEN (SELECT count(*) FROM split"
    " WHERE part = 'test' AND label = c)::DOUBLE END AS support, true AS value_valid FROM (VALUES (0), (1)) AS k(c)"
    " CROSS JOIN (VALUES ('precision'), ('recall'), ('f1'), ('support')) AS m(metric)"
    " UNION ALL SELECT avg_, metric, CASE WHEN metric = 'support' THEN (SELECT count(*) FROM split"
    " WHERE part = 'test')::DOUBLE END, true FROM (VALUES ('macro avg'), ('weighted avg')) AS k(avg_)"
    " CROSS JOIN (VALUES ('precision'), ('recall'), ('f1'), ('support')) AS m(metric)"
    " UNION ALL SELECT 'accuracy', 'accuracy', NULL, true"
)

ORACLES = {
    **{f"model_{m}": sql(_TEST_ROWS, points=_POINTS, split=_SPLIT) for m in ("logreg", "cart", "svm", "gbt", "rf")},
    "model_lda": sql(
        "SELECT id, label, round(1 / (1 + exp(-(w1 * x1 + w2 * x2 - (w1 * a2 + w2 * b2) / 2 + odds))), 6) AS score"
        " FROM split, solved WHERE part = 'test'", **_LDA),
    "pca_2d": sql(
        "SELECT id, label, round(g * (c * u + s * v), 4) AS pc1, round(h * (c * v - s * u), 4) AS pc2"
        " FROM centred, signs", **_PCA),
    "train_model": sql(_REPORT_NAMES, points=_POINTS, split=_SPLIT),
    "save_load_pipeline": "SELECT c_custkey AS id, true AS score_valid, true AS prediction_follows FROM customer",
    "score_users": f"{_ACTIONS} WHERE c_acctbal < 0",
    "pipeline_train_predict": _ACTIONS,
    "standard_scale": sql(
        " UNION ALL ".join(
            f"SELECT id, '{c}' AS feature, round((CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM features))"
            f" / (SELECT CASE WHEN min({c}) = max({c}) THEN 1 ELSE stddev_pop({c}) END FROM features), 6)"
            " AS value FROM features"
            for c in _NUMERIC
        ),
        "features"),
    "stratified_split": sql("SELECT id, label, part FROM split", points=_POINTS, split=_SPLIT),
    "under_sample": sql(_UNDER, points=_POINTS),
    "smote": sql("SELECT * FROM grown", **_SMOTE),
    "smote_enn": sql(
        "SELECT id, label, x1, x2 FROM grown WHERE id IN (SELECT id FROM close_by GROUP BY id"
        " HAVING bool_and(same))",
        **_SMOTE,
        close_by="SELECT * FROM (SELECT a.id, a.label = b.label AS same, row_number() OVER (PARTITION BY a.id"
        f" ORDER BY {_d2('a', 'b')}, b.id) AS pos FROM grown a JOIN grown b ON a.id <> b.id) WHERE pos <= 3",
    ),
    "class_balance": sql(
        "SELECT 'before' AS stage, label, count(*) AS n FROM points GROUP BY label"
        " UNION ALL SELECT 'after', label, count(*) FROM under_ GROUP BY label",
        points=_POINTS, under_=_UNDER),
    "model_knn": sql(
        "SELECT id, any_value(label) AS label, CAST(sum(vote) AS DOUBLE) / 5 AS score,"
        " CAST(sum(vote) / 5 > 0.5 AS DOUBLE) AS prediction FROM (SELECT a.id, a.label, b.label AS vote,"
        f" row_number() OVER (PARTITION BY a.id ORDER BY {_d2('a', 'b')}, b.id) AS pos"
        " FROM split a CROSS JOIN split b WHERE a.part = 'test' AND b.part = 'train') WHERE pos <= 5 GROUP BY id",
        points=_POINTS, split=_SPLIT),
    "cv_auc_by_model": sql(
        "SELECT 'under' AS sampling, model, CAST(fold AS INTEGER) AS fold, test_rows, positives, auc_valid"
        f" FROM folds CROSS JOIN {_MODELS}", points=_POINTS, split=_SPLIT, folds=_FOLDS),
    "choose_sampling": sql(
        "SELECT sampling, model, count(*) AS folds, CAST(sum(test_rows) AS BIGINT) AS test_rows,"
        " CAST(sum(positives) AS BIGINT) AS positives, bool_or(auc_valid) AS auc_valid FROM folds"
        f" CROSS JOIN {_MODELS} CROSS JOIN (VALUES ('under'), ('smote'), ('combine')) AS k(sampling)"
        " GROUP BY 1, 2", points=_POINTS, split=_SPLIT, folds=_FOLDS),
    "grid_search": sql(
        "SELECT params, count(*) AS folds, CAST(sum(test_rows) AS BIGINT) AS test_rows,"
        " CAST(sum(positives) AS BIGINT) AS positives, bool_or(p > 0 AND p < test_rows) AS auc_valid FROM"
        f" (SELECT {_FOLD.format(n=5)} AS fold, {_RATED}, sum(label) AS p FROM balanced GROUP BY 1) CROSS JOIN"
        " (SELECT '[(''minInstancesPerNode'', ' || a || '), (''numTrees'', ' || b || ')]' AS params"
        " FROM (VALUES (1), (3)) AS x(a) CROSS JOIN (VALUES (5), (10)) AS y(b)) GROUP BY 1",
        points=_POINTS, split=_SPLIT, balanced=_BALANCED),
    "roc_auc": sql(
        "SELECT round((sum(mean_rank) FILTER (WHERE label = 1) - n1 * (n1 + 1) / 2) / (n1 * n0), 9) AS auc"
        " FROM (SELECT label, avg(CAST(r AS DOUBLE)) OVER (PARTITION BY score) AS mean_rank,"
        " sum(label) OVER () ::DOUBLE AS n1, sum(1 - label) OVER () ::DOUBLE AS n0"
        " FROM (SELECT *, row_number() OVER (ORDER BY score) AS r FROM scored)) GROUP BY n1, n0",
        scored=_SCORED),
    "confusion_matrix": sql(
        "SELECT a AS label, b AS prediction, count(score) AS n FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1))"
        " AS v(a, b) LEFT JOIN scored ON label = a AND prediction = b GROUP BY a, b", scored=_SCORED),
    "f1_score": sql(
        "SELECT round(2 * n11 / CAST(2 * n11 + n01 + n10 AS DOUBLE), 9) AS f1 FROM cells",
        scored=_SCORED, cells=_CELLS),
    "classification_report": sql(_REPORT_ROWS, scored=_SCORED, classes=_CLASSES),
    "decide_action": sql(
        "SELECT id, p AS probability, action, CASE action WHEN 'ALERT' THEN 'ALERT_AGENT' WHEN 'BOTH'"
        " THEN 'BOTH' ELSE 'NON FRAUDSTER' END AS action_label FROM (SELECT id, p,"
        " CASE WHEN has_transactions = 0 THEN 'NOTHING' WHEN p >= 0.7 THEN 'BOTH' WHEN p >= 0.6 THEN"
        " CASE WHEN is_lock = 1 OR mean_amount >= 1000 OR kyc = 'failed' THEN 'BOTH' ELSE 'ALERT' END"
        " WHEN p >= 0.5 AND (kyc <> 'SUCCESS' OR source_minos = 1) THEN 'ALERT' ELSE 'NOTHING' END AS action"
        " FROM (SELECT *, CAST(id * 37 % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS p FROM features))",
        "features"),
}
