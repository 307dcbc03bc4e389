"""Training and scoring on the driver tables; the perceptron is iterative and has no SQL twin, the fixed-step fit has one."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from bindings.catalog import query, split_sql, table
from rowsentry.operators import features, scoring, softmax, split, train

WIDTH, CLASSES, EPOCHS = 64, 10, 10


def _vectors(spark, sf):
    """Embeddings as feature vectors with a test part and three folds."""
    rows = table(spark, sf, "embeddings").select(
        "vec_id", F.col("label").alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return split.split_and_fold(rows, "label", "vec_id")


def _first_fold(spark, sf):
    return _vectors(spark, sf).filter("fold = 1 and split = 'train'")


@query()
def train_classifier(spark, sf):
    """The training accuracy curve's end: predictions of a model on its own training rows."""
    rows = _first_fold(spark, sf)
    model = train.train_classifier(rows, WIDTH, CLASSES, epochs=EPOCHS)
    scored = scoring.predict_proba(model, rows.select("vec_id", "label", "features"))
    return scoring.argmax_confidence(scored).select("vec_id", "label", "prediction", "confidence")


@query()
def train_over_folds(spark, sf):
    fitted = train.train_over_folds(_vectors(spark, sf), [1, 2, 3], WIDTH, CLASSES, epochs=EPOCHS)
    return fitted.metrics_table(spark)


@query()
def tune(spark, sf):
    trials, _ = train.tune(_vectors(spark, sf), [1, 2, 3], WIDTH, CLASSES, trials=(5, 10, 15))
    return train.top_models(trials, 2)


@query()
def predict_proba(spark, sf):
    rows = _vectors(spark, sf)
    model = train.train_logistic(rows.filter("fold = 1 and split = 'train'"), epochs=EPOCHS)
    test = rows.filter("split = 'test'").select("vec_id", "features")
    return scoring.predict_proba(model, test).select("vec_id", "probabilities")


@query(f"""
  SELECT vec_id, CAST(1.0 AS DOUBLE) AS total, {CLASSES} AS width
  FROM ({split_sql("SELECT * FROM embeddings", "label", "vec_id", "'42'", keep="vec_id")}) WHERE split = 'test'
""")
def predict_proba_totals(spark, sf):
    """Which rows are scored, and that their probabilities add up."""
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x)
    return predict_proba(spark, sf).select("vec_id", F.round(total, 6).alias("total"), F.size("probabilities").alias("width"))


_STEPS, _FIXED_EPOCHS, _FEATURES = (0.5, 2.0), 3, 64
_FOLDED_VECTORS = split_sql("SELECT vec_id, label, embedding, fold FROM embeddings, (SELECT unnest([1, 2, 3]) AS fold) f", "label", "vec_id",
                            "concat_ws('|', '41', r.fold_)", fold="fold", keep="fold, vec_id, label, embedding", other="validation")


def _descent_sql(result: str) -> str:
    """Plain gradient descent, an epoch after the other: tables ``w<e>`` (weights), ``p<e>`` (probabilities), ``m<e>`` (metrics)."""
    steps = ", ".join(f"({t}, CAST({s} AS DOUBLE))" for t, s in enumerate(_STEPS))
    ctes = [f"""r AS MATERIALIZED (SELECT CAST(fold AS INT) AS fold, split, vec_id, CAST(label AS INT) AS label, list_append(CAST(embedding AS DOUBLE[]), 1.0) AS x
              FROM ({_FOLDED_VECTORS}))""",
            f"""w0 AS MATERIALIZED (SELECT CAST(f.fold AS INT) AS fold, CAST(trial AS INT) AS trial, step, CAST(k AS INT) AS class,
                  list_resize(CAST([] AS DOUBLE[]), {_FEATURES + 1}, CAST(0 AS DOUBLE)) AS w
              FROM (SELECT unnest([1, 2, 3]) AS fold) f, (VALUES {steps}) AS t(trial, step), range({CLASSES}) AS c(k))"""]
    for e in range(_FIXED_EPOCHS + 1):
        ctes.append(f"""p{e} AS MATERIALIZED (SELECT *, u / sum(u) OVER one AS p FROM (SELECT *, exp(s - max(s) OVER one) AS u FROM (
            SELECT fold, trial, split, vec_id, label, class, x, list_dot_product(x, w) AS s FROM r JOIN w{e} USING (fold))
            WINDOW one AS (PARTITION BY fold, trial, vec_id)) WINDOW one AS (PARTITION BY fold, trial, vec_id))""")
        if e:
            ctes.append(f"""m{e} AS (SELECT fold, trial, split, {e} AS epoch, avg(loss) AS loss, avg(hit) AS accuracy FROM (
                SELECT fold, trial, split, vec_id, -ln(max(p) FILTER (class = label)) AS loss, CAST(arg_max(class, p) = any_value(label) AS DOUBLE) AS hit
                FROM p{e} GROUP BY ALL) GROUP BY fold, trial, split)""")
        if e < _FIXED_EPOCHS:
            ctes.append(f"""w{e + 1} AS MATERIALIZED (SELECT fold, trial, any_value(step) AS step, class, list(v - step * g ORDER BY i) AS w FROM (
                SELECT fold, trial, class, i, avg(d * v) AS g FROM (
                  SELECT fold, trial, class, p - CAST(class = label AS DOUBLE) AS d, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM p{e} WHERE split = 'train')
                GROUP BY ALL) JOIN (SELECT fold, trial, step, class, unnest(w) AS v, generate_subscripts(w, 1) AS i FROM w{e}) USING (fold, trial, class, i)
              GROUP BY fold, trial, class)""")
    return f"WITH {', '.join(ctes)} {result}"


_EVERY_EPOCH = " UNION ALL ".join(f"SELECT * FROM m{e}" for e in range(1, _FIXED_EPOCHS + 1))


def _fixed_fits(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("features"))
    folded = split.stratified_folds(rows, "label", "vec_id")
    return softmax.train_softmax(folded, [1, 2, 3], _FEATURES, CLASSES, _FIXED_EPOCHS, _STEPS)


@query(_descent_sql(f"""SELECT fold, trial, class, CAST(i - 1 AS INT) AS index, round(v, 6) AS weight FROM (
    SELECT fold, trial, class, unnest(w) AS v, generate_subscripts(w, 1) AS i FROM w{_FIXED_EPOCHS})"""))
def train_softmax(spark, sf):
    """All weights of all folds and steps after the last epoch."""
    return _fixed_fits(spark, sf).weights_table(spark).withColumn("weight", F.round("weight", 6))


@query(_descent_sql(f"""
  SELECT fold, trial, epoch, CASE WHEN split = 'train' THEN '' ELSE 'val_' END || metric AS metric, round(value, 6) AS value
  FROM (SELECT fold, trial, split, epoch, unnest(['loss', 'accuracy']) AS metric, unnest([loss, accuracy]) AS value FROM ({_EVERY_EPOCH}))"""))
def softmax_fold_metrics(spark, sf):
    """Loss and accuracy of both sides of each fold after every epoch."""
    return _fixed_fits(spark, sf).metrics_table(spark).withColumn("value", F.round("value", 6))


_TRIALS = (1, 2, 3)


@query(_descent_sql(f"""
  SELECT CAST(row_number() OVER (ORDER BY trial, epoch) - 1 AS INT) AS trial, trial AS step, epoch AS epochs, round(accuracy, 6) AS val_accuracy
  FROM ({_EVERY_EPOCH}) WHERE fold = 3 AND split = 'validation' AND epoch IN {_TRIALS}
  QUALIFY row_number() OVER (ORDER BY round(accuracy, 6) DESC, trial, epoch) <= 3"""))
def tune_softmax(spark, sf):
    """The three best of all steps and numbers of epochs by the validation accuracy of the last fold."""
    trials = softmax.softmax_trials(_fixed_fits(spark, sf), spark, _TRIALS)
    return train.top_models(trials.withColumn("val_accuracy", F.round("val_accuracy", 6)), 2).drop("rank")


@query(_descent_sql(f"""
  SELECT vec_id, CAST(arg_max(class, p) AS INT) AS prediction, round(max(p), 6) AS confidence
  FROM p{_FIXED_EPOCHS} WHERE fold = 2 AND trial = 1 AND split = 'validation' GROUP BY vec_id"""))
def predict_softmax(spark, sf):
    """Class and confidence of the held-out rows of a fold by the model trained on its other rows."""
    model = _fixed_fits(spark, sf).models[2, 1]
    rows = table(spark, sf, "embeddings").select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    held = split.stratified_folds(rows, "label", "vec_id").filter("fold = 2 AND split = 'validation'")
    scored = scoring.argmax_confidence(scoring.predict_proba(model, held.select("vec_id", "features")))
    return scored.select("vec_id", F.col("prediction").cast("int").alias("prediction"), F.round("confidence", 6).alias("confidence"))


_ORDER_DDL = "o_orderstatus STRING, o_totalprice DOUBLE, o_custkey BIGINT"
_PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _order_model(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_totalprice", "o_custkey", "o_orderpriority")
    fitted = features.fit_columns(orders, "o_orderpriority")
    ready = features.transform_with(orders, fitted, keep=["o_orderpriority"])
    coded = scoring.as_vector(ready, fitted.feature_names).withColumn(
        "label", F.array_position(F.array(*[F.lit(p) for p in _PRIORITY]), F.col("o_orderpriority")) - 1)
    return fitted, train.train_logistic(coded, epochs=5)


@query()
def score_requests(spark, sf):
    """Every order as a CSV or JSON request, answered in the type it came in."""
    fitted, model = _order_model(spark, sf)
    o = table(spark, sf, "orders")
    even = F.col("o_orderkey") % 2 == 0
    kind = F.when(even, "text/csv").otherwise("application/json")
    body = F.when(even, F.concat_ws(",", "o_orderstatus", "o_totalprice", "o_custkey")).otherwise(
        F.to_json(F.struct("o_orderstatus", "o_totalprice", "o_custkey")))
    sent = o.select(F.col("o_orderkey").cast("string").alias("inference_id"), kind.alias("content_type"),
                    kind.alias("accept"), body.alias("body"))
    scored, _ = scoring.score_requests(sent, fitted, model, _PRIORITY, _ORDER_DDL)
    return scoring.answer_requests(scored)


@query(f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS inference_id, CASE WHEN o_orderkey % 2 = 0 THEN 'text/csv' ELSE 'application/json' END AS accept,
         CAST(NULL AS VARCHAR) AS error, true AS in_domain, true AS in_range FROM orders
""")
def score_requests_checked(spark, sf):
    """That every request is answered in its type, with a class of the domain and a confidence."""
    answers = score_requests(spark, sf)
    is_csv = F.col("accept") == "text/csv"
    name = F.when(is_csv, F.substring_index("response", ",", 1)).otherwise(F.get_json_object("response", "$.0"))
    share = F.when(is_csv, F.substring_index("response", ",", -1)).otherwise(F.get_json_object("response", "$.1")).cast("double")
    return answers.select("inference_id", "accept", "error", name.isin(_PRIORITY).alias("in_domain"), share.between(0.2, 1.0).alias("in_range"))


def _weight(k: int, i: int) -> float:
    """A weight by rule, small and different for each class and feature."""
    return ((k * 7 + i * 3) % 11 - 5) / 4


def _sum_sql(k: int, terms: list[str]) -> str:
    return f"CAST({k / 10} AS DOUBLE) + " + " + ".join(f"CAST({_weight(k, i)} AS DOUBLE) * {t}" for i, t in enumerate(terms))


def _softmax_sql(rows: str, keep: str, n: int) -> str:
    """Probabilities ``p`` (a list) of the scores ``s0``, ``s1``, … in ``rows``."""
    names = [f"s{k}" for k in range(n)]
    top = f"greatest({', '.join(names)})"
    exps = [f"exp({x} - {top})" for x in names]
    return f"SELECT {keep}, [{', '.join(f'{e} / ({" + ".join(exps)})' for e in exps)}] AS p FROM ({rows})"


_DIMENSIONS = 64
_SCORED_VECTORS = "SELECT vec_id, " + ", ".join(
    _sum_sql(k, [f"CAST(embedding[{i + 1}] AS DOUBLE)" for i in range(_DIMENSIONS)]) + f" AS s{k}" for k in range(CLASSES)) + " FROM embeddings"


@query(f"""
  SELECT vec_id, unnest(range({CLASSES})) AS class, round(unnest(p), 6) AS probability FROM ({_softmax_sql(_SCORED_VECTORS, "vec_id", CLASSES)})
""")
def predict_proba_fixed(spark, sf):
    """Every probability of a model with given weights."""
    model = scoring.SoftmaxModel([[_weight(k, i) for i in range(_DIMENSIONS)] for k in range(CLASSES)], [k / 10 for k in range(CLASSES)])
    rows = table(spark, sf, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    found = scoring.predict_proba(model, rows).select("vec_id", F.posexplode("probabilities").alias("class", "probability"))
    return found.select("vec_id", F.col("class").cast("long").alias("class"), F.round("probability", 6).alias("probability"))


_TERMS = ["(o_totalprice - pm) / ps", "(o_custkey - cm) / cs", *[f"CAST(o_orderstatus = '{c}' AS DOUBLE)" for c in "FOP"]]
_SCORED_ORDERS = "SELECT o_orderkey, " + ", ".join(_sum_sql(k, _TERMS) + f" AS s{k}" for k in range(len(_PRIORITY))) + """
  FROM orders, (SELECT avg(o_totalprice) AS pm, stddev_pop(o_totalprice) AS ps, avg(o_custkey) AS cm, stddev_pop(o_custkey) AS cs FROM orders)"""
_REFUSED = "o_orderkey % 10 = 3"


@query(f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS inference_id, CASE WHEN o_orderkey % 2 = 0 THEN 'text/csv' ELSE 'application/json' END AS accept,
         CASE WHEN {_REFUSED} THEN 'Error transforming the input data.' END AS error,
         CASE WHEN NOT {_REFUSED} THEN {_PRIORITY!r}[list_position(p, list_max(p))] END AS prediction,
         CASE WHEN NOT {_REFUSED} THEN round(list_max(p), 6) END AS confidence
  FROM ({_softmax_sql(_SCORED_ORDERS, "o_orderkey", len(_PRIORITY))})
""")
def score_requests_exact(spark, sf):
    """Class and confidence of every order, sent as a CSV or JSON request; some name a status nobody knows and are refused."""
    o = table(spark, sf, "orders")
    fitted = features.fit_columns(o.select("o_orderstatus", "o_totalprice", "o_custkey", "o_orderpriority"), "o_orderpriority")
    names = fitted.feature_names
    order = [["o_totalprice", "o_custkey", *[f"o_orderstatus_{c}" for c in "FOP"]].index(n) for n in names]
    model = scoring.SoftmaxModel([[_weight(k, i) for i in order] for k in range(len(_PRIORITY))], [k / 10 for k in range(len(_PRIORITY))])
    even = F.col("o_orderkey") % 2 == 0
    kind = F.when(even, "text/csv").otherwise("application/json")
    sent = o.withColumn("o_orderstatus", F.when(F.expr(_REFUSED), "X").otherwise(F.col("o_orderstatus")))
    body = F.when(even, F.concat_ws(",", "o_orderstatus", "o_totalprice", "o_custkey")).otherwise(
        F.to_json(F.struct("o_orderstatus", "o_totalprice", "o_custkey")))
    sent = sent.select(F.col("o_orderkey").cast("string").alias("inference_id"), kind.alias("content_type"),
                       kind.alias("accept"), body.alias("body"))
    answers = scoring.answer_requests(*scoring.score_requests(sent, fitted, model, _PRIORITY, _ORDER_DDL))
    is_csv = F.col("accept") == "text/csv"
    name = F.when(is_csv, F.substring_index("response", ",", 1)).otherwise(F.get_json_object("response", "$.0"))
    share = F.when(is_csv, F.substring_index("response", ",", -1)).otherwise(F.get_json_object("response", "$.1")).cast("double")
    return answers.select("inference_id", "accept", "error", name.alias("prediction"), F.round(share, 6).alias("confidence"))


@query("""
  SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'large' ELSE 'small' END AS prediction FROM orders
""")
def score_with(spark, sf):
    """A user's own model, given as four functions."""

    def load():
        return {"limit": 250000.0, "names": ["small", "large"]}

    def parse(frame):
        return frame["o_totalprice"]

    def predict(prices, model):
        return [model["names"][int(p > model["limit"])] for p in prices]

    def render(frame, outputs):
        return frame[["o_orderkey"]].assign(prediction=outputs)

    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return scoring.score_with(orders, load, parse, predict, render, "o_orderkey bigint, prediction string")
