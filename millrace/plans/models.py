"""Metrics, folds and models over scored labels, churn features and embeddings."""

import numpy as np
from pyspark.sql import functions as F

from millrace.functions import arrays
from millrace.functions.numbers import edge_bin
from millrace.operators import features as ft
from millrace.operators import metrics as mx
from millrace.operators import models as ml
from millrace.operators.neighbours import knn_classify, knn_fitted
from millrace.operators.ordering import store
from millrace.plans.inputs import CHURN_FEATURES, SQL_CHURN, SQL_SCORED, churn, scored, sql_hash
from millrace.plans.registry import query
from millrace.session import new_folder
from millrace.sources.files import json_sink


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("standardise", f"""
WITH {SQL_CHURN}
SELECT user_id, {", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in CHURN_FEATURES)}, label
FROM churn
""")
def standardise(t):
    return _rounded(ft.standardise(churn(t), CHURN_FEATURES), *CHURN_FEATURES)


@query("kfold_assign", f"""
WITH {SQL_CHURN} SELECT user_id, CAST({sql_hash(0, 'user_id')} % 5 AS INTEGER) AS fold FROM churn
""")
def kfold_assign(t):
    return ft.kfold_assign(churn(t), "user_id").select("user_id", "fold")


@query("holdout_split", f"""
SELECT doc_id, {sql_hash(0, 'doc_id')} < {int(0.2 * 2**32)} AS is_test FROM documents
""")
def holdout_split(t):
    return ft.holdout_split(t.documents.select("doc_id"), "doc_id", 0.2)


@query("value_counts_with_rate", f"""
WITH {SQL_SCORED} SELECT round(score, 1) AS score, count(*) AS n, round(avg(y), 6) AS rate FROM scored GROUP BY 1
""")
def value_counts_with_rate(t):
    rounded = scored(t).withColumn("score", F.round("score", 1))
    return _rounded(mx.value_counts_with_rate(rounded), "rate")


@query("edge_bin", f"""
WITH {SQL_SCORED}
SELECT doc_id, CAST((SELECT count(*) FROM range(11) AS e(i) WHERE score >= i / 10) AS INTEGER) AS bin FROM scored
""")
def edge_bin_query(t):
    return scored(t).select("doc_id", edge_bin(F.col("score")).alias("bin"))


@query("accuracy", f"""
WITH {SQL_SCORED} SELECT round(100 * avg(CASE WHEN y = p THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy FROM scored
""")
def accuracy(t):
    return _rounded(mx.accuracy(scored(t)), "accuracy")


@query("confusion_matrix", f"""
WITH {SQL_SCORED}, listed AS (
  SELECT CASE WHEN doc_id % 17 = 0 THEN -1 ELSE y END AS y, CASE WHEN doc_id % 13 = 0 THEN -1 ELSE p END AS p FROM scored)
SELECT a.c AS y, b.c AS p, (SELECT count(*) FROM listed WHERE y = a.c AND p = b.c) AS n
FROM (VALUES (0), (1), (-1)) AS a(c), (VALUES (0), (1), (-1)) AS b(c)
""")
def confusion_matrix(t):
    """Some labels are of a class outside the list, some predictions are missing."""
    mixed = scored(t).select(
        F.when(F.col("doc_id") % 17 == 0, 7).otherwise(F.col("y")).alias("y"),
        F.when(F.col("doc_id") % 13 != 0, F.col("p")).alias("p"),
    )
    return mx.confusion_matrix(mixed, [0, 1])


_COUNTS = """
count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 0 AND p = 1) AS fp,
count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 0 AND p = 0) AS tn"""
_RATES = "round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1"
_LOSS = "round(avg(-ln(CASE WHEN y = 1 THEN q ELSE 1 - q END)), 6)"
_CLIP = "greatest(least(CAST({p} AS DOUBLE), 1 - 1e-15), 1e-15) AS q"


@query("precision_recall_f1", f"WITH {SQL_SCORED}, c AS (SELECT {_COUNTS} FROM scored) SELECT {_RATES} FROM c")
def precision_recall_f1(t):
    return _rounded(mx.precision_recall_f1(scored(t)), "precision", "recall", "f1")


@query("log_loss", f"WITH {SQL_SCORED} SELECT {_LOSS} AS log_loss FROM (SELECT y, {_CLIP.format(p='score')} FROM scored)")
def log_loss(t):
    return _rounded(mx.log_loss(scored(t), "score"), "log_loss")


@query("roc_curve", f"""
WITH {SQL_SCORED}, d AS (SELECT DISTINCT score FROM scored)
SELECT score, round((SELECT count(*) FROM scored s WHERE s.score >= d.score AND y = 1) / (SELECT count(*) FROM scored WHERE y = 1), 6) AS tpr,
       round((SELECT count(*) FROM scored s WHERE s.score >= d.score AND y = 0) / (SELECT count(*) FROM scored WHERE y = 0), 6) AS fpr FROM d
""")
def roc_curve(t):
    return _rounded(mx.roc_curve(scored(t)), "tpr", "fpr")


_AUC = """
SELECT {g}, round(avg(CASE WHEN a.score > b.score THEN 1.0::DOUBLE WHEN a.score = b.score THEN 0.5 ELSE 0 END), 6) AS auc
FROM scored a JOIN scored b ON {on} WHERE a.y = 1 AND b.y = 0 GROUP BY 1"""


@query("roc_auc", f"WITH {SQL_SCORED}, r AS ({_AUC.format(g='1 AS one', on='TRUE')}) SELECT auc FROM r")
def roc_auc(t):
    return _rounded(mx.roc_auc(scored(t)), "auc")


_SQL_BINS = f"""
WITH {SQL_SCORED},
b AS (SELECT y, score, (SELECT count(*) FROM range(11) AS e(i) WHERE score >= i / 10) AS bin FROM scored),
g AS (SELECT bin, count(*) AS n, avg(score) AS m, avg(y) AS rate FROM b GROUP BY 1)"""


@query("calibration", f"{_SQL_BINS} SELECT round(sum(n * (m - rate) ** 2) / sum(n), 9) AS calibration FROM g")
def calibration(t):
    return _rounded(mx.calibration(scored(t)), "calibration", digits=9)


@query("discrimination", f"""
{_SQL_BINS} SELECT round(sum(n * (rate - (SELECT avg(y) FROM scored)) ** 2) / sum(n), 9) AS discrimination FROM g
""")
def discrimination(t):
    return _rounded(mx.discrimination(scored(t)), "discrimination", digits=9)


@query("metrics_report", f"""
WITH {SQL_SCORED},
c AS (SELECT dataset, count(*) AS n, {_COUNTS}, round(100 * avg(CASE WHEN y = p THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy
      FROM scored GROUP BY 1),
l AS (SELECT dataset, {_LOSS} AS log_loss FROM (SELECT dataset, y, {_CLIP.format(p='p')} FROM scored) GROUP BY 1),
r AS ({_AUC.format(g='a.dataset', on='a.dataset = b.dataset')})
SELECT dataset, n, tp, fp, fn, tn, accuracy, {_RATES}, log_loss, auc
FROM c JOIN l USING (dataset) JOIN r USING (dataset)
""")
def metrics_report(t):
    report = _rounded(
        mx.metrics_report(scored(t)), "accuracy", "precision", "recall", "f1", "log_loss", "auc"
    )
    path = new_folder(t.spark, "metrics-json")
    json_sink(report, path)
    return t.spark.read.schema(report.schema).json(path)


# ---- models -------------------------------------------------------------------------------


def _churn_model_table(t):
    scaled = ft.standardise(churn(t), CHURN_FEATURES)
    return ml.assemble(ft.kfold_assign(scaled, "user_id"), CHURN_FEATURES)


LEAST = 50.0  # per cent of labels a model must get right out of fold


def _judged(found, key, shown, is_valid):
    """Each row with its fold and label, whether its value is one a model may give, and whether the model is right for
    ``LEAST`` per cent of all rows."""
    found = store(found, "out-of-fold")
    right = found.agg(F.avg((F.round(shown) == F.col("label")).cast("double")) * 100).scalar()
    return found.select(key, "fold", F.col("label").cast("int").alias("label"), is_valid.alias("is_valid"), (right >= LEAST).alias("is_good"))


_OUT_OF_FOLD = f"""
WITH {SQL_CHURN}
SELECT user_id, CAST({sql_hash(0, 'user_id')} % 5 AS INTEGER) AS fold, label, true AS is_valid, true AS is_good FROM churn
"""


@query("random_forest", _OUT_OF_FOLD)
def random_forest(t):
    found = ml.cv_predict(_churn_model_table(t), ml.random_forest(10), ["user_id"])
    return _judged(found, "user_id", F.col("prediction"), F.col("prediction").isin(0.0, 1.0))


@query("cv_predict", f"""
WITH {SQL_CHURN}, f AS (SELECT CAST({sql_hash(0, 'user_id')} % 5 AS INTEGER) AS fold, label FROM churn)
SELECT model, fold, count(*) AS n, count(*) FILTER (label = 1) AS n_positive, count(*) AS n_predicted, true AS is_good
FROM f, (VALUES ('forest'), ('svm')) AS x(model) GROUP BY 1, 2
""")
def cv_predict(t):
    """Rows, positive rows and predictions per model and fold, and whether the model is right often enough."""
    table = _churn_model_table(t)
    folds = []
    for name, model in (("forest", ml.random_forest(10)), ("svm", ml.linear_svm())):
        judged = _judged(ml.cv_predict(table, model, ["user_id"]), "user_id", F.col("prediction"), F.col("prediction").isin(0.0, 1.0))
        folds.append(judged.groupBy("fold").agg(
            F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("n_positive"), F.count_if("is_valid").alias("n_predicted"),
            F.bool_and("is_good").alias("is_good"),
        ).withColumn("model", F.lit(name)))
    return folds[0].unionByName(folds[1])


@query("cv_predict_proba", _OUT_OF_FOLD)
def cv_predict_proba(t):
    found = ml.cv_predict_proba(_churn_model_table(t), ml.random_forest(10), ["user_id"])
    return _judged(found, "user_id", F.col("probability"), F.col("probability").between(0, 1))


@query("svm", _OUT_OF_FOLD)
def svm(t):
    found = ml.cv_predict_proba(_churn_model_table(t), ml.linear_svm(), ["user_id"])
    return _judged(found, "user_id", F.col("probability"), F.col("probability").between(0, 1))


@query("mlp_classifier", f"""
SELECT vec_id, CAST({sql_hash(0, 'vec_id')} % 5 AS INTEGER) AS fold,
       CASE WHEN embedding[1] > 0 THEN 1 ELSE 0 END + CASE WHEN embedding[2] > 0 THEN 2 ELSE 0 END AS label, true AS is_valid, true AS is_good FROM embeddings
""")
def mlp_classifier(t):
    """Which quarter of their first two dimensions embeddings lie in, 64 inputs and 100 hidden units to 4 classes, out
    of fold. The table's own labels have nothing to do with the vectors, so no model could be judged by them."""
    from pyspark.ml.functions import array_to_vector

    table = t.embeddings.select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        ((F.col("embedding")[0] > 0).cast("int") + 2 * (F.col("embedding")[1] > 0).cast("int")).cast("double").alias("label"),
    )
    found = ml.cv_predict(ft.kfold_assign(table, "vec_id"), ml.mlp([64, 100, 4], 40), ["vec_id"])
    return _judged(found, "vec_id", F.col("prediction"), F.col("prediction").isin(*map(float, range(4))))


FITTED = 400  # rows of the fitted nearest neighbours
_KNN = """
WITH p AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label,
                  CAST({hash} % 5 AS INTEGER) AS fold FROM embeddings),
fitted AS (SELECT * FROM p {draw}),
d AS (SELECT a.id, b.id AS n_id, b.label AS n_label, round(list_distance(a.vec, b.vec), 9) AS d
      FROM p a JOIN fitted b ON a.fold <> b.fold),
k AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, n_id) <= 5),
v AS (SELECT id, n_label, count(*) AS votes FROM k GROUP BY 1, 2),
w AS (SELECT id, n_label AS predicted FROM v QUALIFY row_number() OVER (PARTITION BY id ORDER BY votes DESC, n_label) = 1)
SELECT id, fold, label, predicted FROM p JOIN w USING (id)
"""


def _knn_points(t):
    points = t.embeddings.select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label"
    )
    return ft.kfold_assign(points, "id")


@query("knn_classify", _KNN.format(hash=sql_hash(0, "vec_id"), draw=""))
def knn(t):
    return knn_classify(_knn_points(t))


@query("knn_fitted", _KNN.format(
    hash=sql_hash(0, "vec_id"), draw=f"QUALIFY row_number() OVER (ORDER BY {sql_hash(3, 'id')}, id) <= {FITTED}"))
def knn_on_sample(t):
    return knn_fitted(_knn_points(t), sample=FITTED, seed=3)


# What a stored model brings along: a weight per feature, in their order, and a bias.
WEIGHTS, BIAS = [0.2, -0.1, 0.05, 0.3, 0.012, 0.004], -1.5


@query("batch_predict", f"""
WITH {SQL_CHURN}
SELECT user_id, label, round(1 / (1 + exp(-({' + '.join(f'{w} * {c}' for w, c in zip(WEIGHTS, CHURN_FEATURES))} + {BIAS}))), 9) AS score FROM churn
""")
def batch_predict(t):
    """Churn scores of all users by a stored model's weights."""
    weights, bias = np.array(WEIGHTS), BIAS

    def predict(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(x @ weights + bias)))

    scored = ml.batch_predict(churn(t), predict, CHURN_FEATURES, ["user_id", "label"], 256)
    return scored.withColumn("score", F.round("score", 9))


@query("one_hot", """
SELECT vec_id, array_to_string(list_transform(range(10), lambda i: CASE WHEN i = label THEN 1 ELSE 0 END), ' ') AS hot
FROM embeddings
""")
def one_hot(t):
    hot = arrays.one_hot(F.col("label"), 10).cast("array<string>")
    return t.embeddings.select("vec_id", F.array_join(hot, " ").alias("hot"))


@query("argmax_label", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS ix FROM embeddings
""")
def argmax_label(t):
    return t.embeddings.select("vec_id", arrays.argmax(F.col("embedding")).alias("ix"))
