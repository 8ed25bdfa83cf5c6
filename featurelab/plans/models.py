"""Model, scoring and explanation queries.

Model fits are distributed ``pyspark.ml`` jobs; their outputs cannot be
compared row by row with SQL, so most of these are rows-only checks with
quality bounds in ``tests/``.  kNN, linear Shapley, version comparison and
the global rank have exact SQL oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.functions.columns import round4, round4_sql, stable_unit
from featurelab.operators import forest
from featurelab.operators import models as T
from featurelab.operators import score as K
from featurelab.plans.registry import query
from featurelab.session import materialize, scratch_path, spread, written
from featurelab.sources.tables import Tables

TRAIN_FEATURES = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]


def price_frame(spark: SparkSession, d: str) -> DataFrame:
    """A learnable regression target on lineitem joined to part: the log net
    list value ln(quantity * retail price * (1 - discount)).  (The driver's
    extended prices are drawn independently of quantity and part price, so
    ln(l_extendedprice) itself carries no signal to learn.)"""
    t = Tables(spark, d)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                           "l_discount", "l_tax", "l_extendedprice")
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice", F.col("p_size").cast("double").alias("p_size"))
    j = li.join(p, "l_partkey", "inner")
    net = F.col("l_quantity") * F.col("p_retailprice") * (1 - F.col("l_discount"))
    j = j.where(net > 0)
    return j.withColumn("label", F.ln(net)).withColumn(
        "is_test", stable_unit(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")) < 250_000)


def doc_frame(spark: SparkSession, d: str) -> DataFrame:
    """Documents with labels: simple text features and the toxic label."""
    from featurelab.plans.evaluation import TOXIC_RE
    t = Tables(spark, d)
    j = spread(t.documents.select("doc_id", "text", "n_chars")).join(t.labels, "doc_id", "inner").select(
        "doc_id", "text", F.col("n_chars").cast("double").alias("n_chars"),
        F.regexp_count("text", F.lit(f"(?i){TOXIC_RE}")).cast("double").alias("hits"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"), "quality", "toxic")
    return j.withColumn("label", F.col("toxic").cast("double")).withColumn(
        "is_test", stable_unit(F.col("doc_id")) < 300_000)


DOC_FEATURES = ["n_chars", "hits", "n_lines"]


# ---------------------------------------------------------------- T1 K1


@query("forest_score", "T1 K1")
def forest_score(spark: SparkSession, d: str) -> DataFrame:
    df = price_frame(spark, d)
    m = T.fit(df.where(~F.col("is_test")), TRAIN_FEATURES, "random_forest_regressor",
              n_estimators=100, max_depth=10)
    return K.batch_predict(m, df.where("is_test"), ["l_orderkey", "l_linenumber", "l_partkey", "label"])


@query("gbt_score", "T3")
def gbt_score(spark: SparkSession, d: str) -> DataFrame:
    df = doc_frame(spark, d)
    m = T.fit(df.where(~F.col("is_test")), DOC_FEATURES, "gbt_classifier",
              n_estimators=40, max_depth=5, learning_rate=0.2)
    out = m.transform(df.where("is_test"))
    return out.select("doc_id", "label", "prediction", T.probability_of_one().alias("p_toxic"))


@query("logreg_score", "T5 T9")
def logreg_score(spark: SparkSession, d: str) -> DataFrame:
    df = doc_frame(spark, d)
    train = df.where(~F.col("is_test"))
    m = T.fit(train, DOC_FEATURES, "logistic_regression", n_rows=train.count(), C=1.0, max_iter=100)
    out = m.transform(df.where("is_test"))
    return out.select("doc_id", "label", "prediction", T.probability_of_one().alias("p_toxic"))


@query("random_forest_classify", "T2")
def random_forest_classify(spark: SparkSession, d: str) -> DataFrame:
    df = doc_frame(spark, d)
    m = T.fit(df.where(~F.col("is_test")), DOC_FEATURES, "random_forest_classifier",
              n_estimators=150, max_depth=12)
    return m.transform(df.where("is_test")).select("doc_id", "label", "prediction")


@query("gbt_regress", "T4")
def gbt_regress(spark: SparkSession, d: str) -> DataFrame:
    df = price_frame(spark, d)
    m = T.fit(df.where(~F.col("is_test")), TRAIN_FEATURES, "gbt_regressor", n_estimators=20, max_depth=5)
    return K.batch_predict(m, df.where("is_test"), ["l_orderkey", "l_linenumber", "l_partkey", "label"])


# ---------------------------------------------------------------- T6

KNN_SQL = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
                  ((('0x' || substr(md5(CAST(vec_id AS VARCHAR) || '42'), 1, 8))::BIGINT) % 1000000) < 200000 AS is_test
           FROM embeddings),
d AS (SELECT q.vec_id AS qid, t.vec_id AS tid, t.label, list_distance(q.v, t.v) AS dist
      FROM e q JOIN e t ON q.is_test AND NOT t.is_test),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS rn FROM d),
v AS (SELECT qid, label, count(*) AS n FROM r WHERE rn <= 5 GROUP BY qid, label),
b AS (SELECT qid, label, row_number() OVER (PARTITION BY qid ORDER BY n DESC, label) AS rb FROM v)
SELECT qid AS vec_id, CAST(label AS INTEGER) AS prediction FROM b WHERE rb = 1
"""


@query("knn_vote", "T6", sql=KNN_SQL)
def knn_vote(spark: SparkSession, d: str) -> DataFrame:
    from featurelab.operators.knn import knn_classify
    e = Tables(spark, d).embeddings.select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"), "label",
        (stable_unit(F.col("vec_id")) < 200_000).alias("is_test"))
    pred = knn_classify(e.where(~F.col("is_test")), e.where("is_test").select("id", "v"), k=5)
    return pred.select(F.col("id").alias("vec_id"), F.col("prediction").cast("int").alias("prediction"))


# ---------------------------------------------------------------- T7 F5 F4


@query("poly_regression", "T7 F5 F4 M4")
def poly_regression(spark: SparkSession, d: str) -> DataFrame:
    from featurelab.operators import encode as E
    from featurelab.operators.metrics import regression_metrics
    from featurelab.plans.core import monthly_spend_revenue
    data = monthly_spend_revenue(spark, d)
    data = data.withColumn("is_test", stable_unit(F.concat_ws("-", "year", "month")) < 200_000)
    cols = ["spend_a", "spend_n", "spend_r"]
    poly = E.polynomial_features(data, cols, keep=["year", "month", "revenue", "is_test"])
    feats = [c for c in poly.columns if c.startswith("poly_") and c != "poly_1"]
    sc = E.fit_standard_scaler(poly.where(~F.col("is_test")), feats)  # fitted on train only
    scaled = sc.transform(poly).withColumn("label", F.col("revenue"))
    m = T.fit(scaled.where(~F.col("is_test")), feats, "linear_regression")
    out = []
    for part, cond in (("train", ~F.col("is_test")), ("test", F.col("is_test"))):
        r = regression_metrics(m.transform(scaled.where(cond)))
        out.append(r.select(F.lit(part).alias("split"), "rmse", "r2", "n"))
    return out[0].unionByName(out[1])


# ---------------------------------------------------------------- T8 T9 T10 T13


@query("huber_regression", "T8")
def huber_regression(spark: SparkSession, d: str) -> DataFrame:
    from featurelab.operators.metrics import regression_metrics
    df = price_frame(spark, d)
    m = T.fit(df.where(~F.col("is_test")), TRAIN_FEATURES, "huber_regression")
    return regression_metrics(m.transform(df.where("is_test")))


def _kfold_cv_sql() -> str:
    from featurelab.plans.learning import PRICE_SQL, error_sql, normal_equations_sql
    return PRICE_SQL + f""",
f AS (SELECT *, CAST(u * 10 // 1000000 AS INTEGER) AS fold FROM j),
{normal_equations_sql("f", TRAIN_FEATURES, "label", True)}
SELECT CAST(count(*) AS INTEGER) AS folds, round(avg(sqrt({error_sql("own", len(TRAIN_FEATURES) + 2)} / own.s0_0)), 4) AS avg_rmse
FROM beta JOIN own ON own.fold = beta.fold
"""


@query("kfold_cv", "T10", sql=_kfold_cv_sql())
def kfold_cv(spark: SparkSession, d: str) -> DataFrame:
    """Mean test RMSE of ten least-squares fits, from one pass over the data."""
    from featurelab.operators import linear
    from featurelab.plans.learning import _folded
    found = linear.cross_validate(_folded(spark, d), TRAIN_FEATURES, "label", "fold")
    avg = sum(f.rmse for f in found) / len(found)
    return spark.createDataFrame([(len(found), avg)], "folds int, avg_rmse double").select("folds", round4("avg_rmse").alias("avg_rmse"))


CANDIDATES = {"random_forest_regressor": {"n_estimators": 20, "max_depth": 8},
              "gbt_regressor": {"n_estimators": 20, "max_depth": 5},
              "linear_regression": {}}


@query("auto_model_pick", "T13 F8 A13")
def auto_model_pick(spark: SparkSession, d: str) -> DataFrame:
    from featurelab.operators.split import three_way_column
    df = price_frame(spark, d).withColumn(
        "part", three_way_column(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")))
    # read by every fit and every score
    df = written(df.select(*TRAIN_FEATURES, "label", "part"), "pick-rows")
    train, valid = df.where(F.col("part") == "train"), df.where(F.col("part") == "validation")
    rows, cells = [], T.Cells(train, TRAIN_FEATURES)
    for name, params in CANDIDATES.items():
        m = T.fit(train, TRAIN_FEATURES, name, cells=cells, **params)
        rows.append((name, T.rmse_of(forest.predict(m, valid))))
    best = min(rows, key=lambda r: (r[1], r[0]))[0]
    return spark.createDataFrame([(n, v, n == best) for n, v in rows],
                                 "model string, val_rmse double, chosen boolean")


@query("tuning_trials", "T11 T12 A13")
def tuning_trials(spark: SparkSession, d: str) -> DataFrame:
    df = written(price_frame(spark, d).select(*TRAIN_FEATURES, "label", "is_test"), "trial-rows")
    train, valid = df.where(~F.col("is_test")), df.where("is_test")
    params = T.trial_params(6, {"n_estimators": ("int", 20, 100), "max_depth": ("int", 3, 8)})
    trials = T.run_trials(train, valid, TRAIN_FEATURES, "random_forest_regressor", params, T.rmse_of,
                          parallel=3)
    rows = [(t.trial_id, t.params["n_estimators"], t.params["max_depth"], t.metric) for t in trials]
    tbl = spark.createDataFrame(rows, "trial_id int, n_estimators int, max_depth int, rmse double")
    best = tbl.agg(F.min_by("trial_id", F.struct("rmse", "trial_id")).alias("best")).first()["best"]
    return tbl.withColumn("best", F.col("trial_id") == F.lit(best))


# ---------------------------------------------------------------- F12


TOP_FEATURES = 25
SUBSET_INPUTS = [*TRAIN_FEATURES, "l_partkey", "l_suppkey"]


def wide_frame(spark: SparkSession, d: str) -> tuple[DataFrame, list[str]]:
    """The price frame with the 35 columns of a degree-2 polynomial of seven
    inputs (two of them keys, which carry nothing)."""
    from featurelab.operators import encode as E
    df = price_frame(spark, d)
    for c in ("l_partkey", "l_suppkey"):
        df = df.withColumn(c, F.col(c).cast("double"))
    # the seven inputs are kept, not their 35 products
    df = written(df.select(*SUBSET_INPUTS, "label", "is_test"), "wide-inputs")
    wide = E.polynomial_features(df, SUBSET_INPUTS, keep=["label", "is_test"])
    return wide, [c for c in wide.columns if c.startswith("poly_") and c != "poly_1"]


def fitted_subset(spark: SparkSession, d: str) -> tuple[list[tuple[str, float]], float, float]:
    """(the 25 most important features, RMSE of the fit on all columns, RMSE of
    the fit on those alone)."""
    wide, names = wide_frame(spark, d)
    train, test = wide.where(~F.col("is_test")), wide.where("is_test")
    cells = T.Cells(train, names)
    m = T.fit(train, names, "random_forest_regressor", cells=cells, n_estimators=20, max_depth=8)
    imp = T.feature_importances(m, names)[:TOP_FEATURES]
    chosen = [f for f, _ in imp]
    again = T.fit(train.select(*chosen, "label"), chosen, "random_forest_regressor", cells=cells, n_estimators=20, max_depth=8)
    return imp, T.rmse_of(forest.predict(m, test)), T.rmse_of(forest.predict(again, test))


@query("importance_top_features", "F12")
def importance_top_features(spark: SparkSession, d: str) -> DataFrame:
    """The 25 most important of 35 features, and the fit on them alone."""
    imp, whole, subset = fitted_subset(spark, d)
    return spark.createDataFrame([(f, v, i + 1, whole, subset) for i, (f, v) in enumerate(imp)],
                                 "feature string, importance double, rank int, whole_rmse double, refit_rmse double")


# ---------------------------------------------------------------- K2 K6 T14

LINEAR_W = {"o_totalprice": 0.001, "priority_code": -2.0, "status_code": 1.5}
SHAP_FEATURES = list(LINEAR_W)


def order_feature_frame(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    return o.select("o_orderkey", "o_totalprice",
                    F.substring("o_orderpriority", 1, 1).cast("double").alias("priority_code"),
                    F.when(F.col("o_orderstatus") == "F", 0.0).when(F.col("o_orderstatus") == "O", 1.0)
                    .otherwise(2.0).alias("status_code"))


def _readback_sql() -> str:
    from featurelab.plans.learning import PRICE_SQL, normal_equations_sql
    means = ", ".join(f"avg({c}) AS m_{c}" for c in TRAIN_FEATURES)
    attrs = ", ".join(f"{round4_sql(f'b{i + 1} * (j.{c} - m_{c})', 3)} AS attr_{c}" for i, c in enumerate(TRAIN_FEATURES))
    total = " + ".join(f"b{i + 1} * j.{c}" for i, c in enumerate(TRAIN_FEATURES))
    return PRICE_SQL + f""",
f AS (SELECT * FROM j WHERE u >= 250000), mean AS (SELECT {means} FROM f),
{normal_equations_sql("f", TRAIN_FEATURES, "label", False)}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(label, 3) AS label, round(b0 + {total}, 3) AS prediction, {attrs}
FROM j, beta, mean WHERE u < 250000
"""


@query("predict_readback", "K1 K2 K6 T14", sql=_readback_sql())
def predict_readback(spark: SparkSession, d: str) -> DataFrame:
    """Fit, save, load, predict to JSON Lines, read back, and explain every
    prediction by 25 sampled paths, side by side (three decimals)."""
    from featurelab.operators import attribution
    from featurelab.sources.files import valid_rows
    df = materialize(price_frame(spark, d))
    train, test = df.where(~F.col("is_test")), df.where("is_test")
    m = T.fit(train, TRAIN_FEATURES, "linear_regression")
    mpath = scratch_path(spark, "model")
    T.save(m, mpath)
    loaded = T.load(mpath)
    out = scratch_path(spark, "predictions")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    K.batch_predict(loaded, test, [*keys, "label", *TRAIN_FEATURES], out)
    back = K.read_predictions(spark, out, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, "
                              + "".join(f"{c} double, " for c in ("label", *TRAIN_FEATURES)) + "prediction double", "*.json")
    # explanations next to the predictions (K6): an output line holds its whole
    # instance, so each is explained where it is read, without a join
    lr = loaded.stages[-1]
    means = train.agg(*[F.avg(c).alias(c) for c in TRAIN_FEATURES]).first().asDict()
    ex = attribution.shapley(valid_rows(back, "l_orderkey"), keys, TRAIN_FEATURES,
                             attribution.linear(lr.coefficients.toArray(), lr.intercept), means, paths=25)
    return ex.select(*keys, *[round4(c, 3).alias(c) for c in ["label", "prediction", *["attr_" + x for x in TRAIN_FEATURES]]])


# ---------------------------------------------------------------- K5


def _shap_sql() -> str:
    cols = ", ".join(f"round({w} * ({c} - (SELECT avg({c}) FROM f)), 4) AS attr_{c}"
                     for c, w in LINEAR_W.items())
    return f"""
WITH f AS (SELECT o_orderkey, o_totalprice, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority_code,
                  CASE o_orderstatus WHEN 'F' THEN 0.0 WHEN 'O' THEN 1.0 ELSE 2.0 END AS status_code FROM orders)
SELECT o_orderkey, {cols} FROM f
"""


@query("shapley_linear", "K5", sql=_shap_sql())
def shapley_linear(spark: SparkSession, d: str) -> DataFrame:
    f = spread(order_feature_frame(spark, d))
    means = f.agg(*[F.avg(c).alias(c) for c in SHAP_FEATURES]).first().asDict()  # baseline: one row
    from featurelab.operators import attribution
    ex = attribution.shapley(f, "o_orderkey", SHAP_FEATURES, attribution.linear(list(LINEAR_W.values())), means, paths=25)
    return ex.select("o_orderkey", *[round4("attr_" + c).alias("attr_" + c) for c in SHAP_FEATURES])


# ---------------------------------------------------------------- J10 K4

V1 = {"o_totalprice": 0.001, "priority_code": 0.5}
V2 = {"o_totalprice": 0.0012, "priority_code": 0.4}


@query("version_compare", "J10 K4", sql="""
WITH f AS (SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority_code
           FROM orders),
a AS (SELECT o_orderkey, 0.001 * o_totalprice + 0.5 * priority_code AS s FROM f),
b AS (SELECT o_orderkey, 1.0 + 0.0012 * o_totalprice + 0.4 * priority_code AS s FROM f WHERE o_orderstatus <> 'P')
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, round(a.s, 4) AS score_v1, round(b.s, 4) AS score_v2,
       round(b.s - a.s, 4) AS score_delta
FROM a FULL OUTER JOIN b ON a.o_orderkey = b.o_orderkey
""")
def version_compare(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders.select(
        "o_orderkey", "o_orderstatus", "o_totalprice",
        F.substring("o_orderpriority", 1, 1).cast("double").alias("priority_code"))
    cmp = K.compare_versions(o, "o_orderkey", {
        "v1": (K.linear_scorer(V1), None),
        "v2": (K.linear_scorer(V2, 1.0), F.col("o_orderstatus") != "P")}, list(V1))
    return cmp.select("o_orderkey", round4("score_v1").alias("score_v1"), round4("score_v2").alias("score_v2"),
                      round4("score_delta").alias("score_delta"))


# ---------------------------------------------------------------- F10


SMOTE_SQL = """
WITH e AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
cnt AS (SELECT label, count(*) AS n FROM e GROUP BY label),
mx AS (SELECT max(n) AS m FROM cnt),
mino AS (SELECT e.*, cnt.n, mx.m - cnt.n AS need FROM e JOIN cnt ON e.label = cnt.label CROSS JOIN mx
         WHERE cnt.n < mx.m AND cnt.n > 1),
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY
                 ((('0x' || substr(md5(CAST(id AS VARCHAR) || '42'), 1, 8))::BIGINT) % 1000000), id) AS rn FROM mino),
cp AS (SELECT rk.id, rk.label, rk.v, c.copy FROM rk, LATERAL (SELECT unnest(range(0, CAST(floor(rk.need / rk.n)
          + CASE WHEN rk.rn <= rk.need % rk.n THEN 1 ELSE 0 END AS BIGINT))) AS copy) c),
d AS (SELECT a.id AS qid, b.id AS tid, list_distance(a.v, b.v) AS dist
      FROM mino a JOIN mino b ON a.label = b.label AND a.id <> b.id),
nb AS (SELECT qid, tid, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS r FROM d),
nb5 AS (SELECT * FROM nb WHERE r <= 5),
nn AS (SELECT qid, count(*) AS nnb FROM nb5 GROUP BY qid),
pk AS (SELECT cp.*,
              ((('0x' || substr(md5(CAST(cp.id AS VARCHAR) || '|' || CAST(cp.copy AS VARCHAR) || '|42'), 1, 8))::BIGINT)
                % nn.nnb) + 1 AS pick,
              ((('0x' || substr(md5(CAST(cp.id AS VARCHAR) || '|' || CAST(cp.copy AS VARCHAR) || '43'), 1, 8))::BIGINT)
                % 1000000) / 1000000.0 AS gap
       FROM cp JOIN nn ON cp.id = nn.qid),
s AS (SELECT pk.*, nb5.tid AS neighbour_id FROM pk JOIN nb5 ON nb5.qid = pk.id AND nb5.r = pk.pick),
o AS (SELECT s.*, list_transform(range(1, len(s.v) + 1), lambda i: s.v[i] + s.gap * (w.v[i] - s.v[i])) AS sv
      FROM s JOIN e w ON w.id = s.neighbour_id)
SELECT 's' || CAST(id AS VARCHAR) || '_' || CAST(copy AS VARCHAR) AS synthetic_id, label, id AS base_id, neighbour_id,
       CAST(gap AS DOUBLE) AS gap,
       CASE WHEN round(list_sum(sv), 4) = 0 THEN CAST(0 AS DOUBLE) ELSE round(list_sum(sv), 4) END AS vec_sum,
       CASE WHEN round(sv[1], 4) = 0 THEN CAST(0 AS DOUBLE) ELSE round(sv[1], 4) END AS vec_first
FROM o
"""


@query("smote", "F10", sql=SMOTE_SQL)
def smote_q(spark: SparkSession, d: str) -> DataFrame:
    from featurelab.operators.smote import smote
    e = Tables(spark, d).embeddings
    s = smote(e, "vec_id", "embedding", "label", k=5)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return s.select("synthetic_id", "label", "base_id", "neighbour_id", "gap",
                    round4(total).alias("vec_sum"), round4(F.element_at("embedding", 1)).alias("vec_first"))


# ---------------------------------------------------------------- H1


@query("global_rank", "H1", sql="""
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS rank FROM orders
""")
def global_rank(spark: SparkSession, d: str) -> DataFrame:
    """Global row number without a single-partition window: range
    partitions of the sort key, numbered inside, offset by earlier ones."""
    from featurelab.operators.rank import range_rank
    o = Tables(spark, d).orders.select("o_orderkey", (-F.col("o_totalprice")).alias("neg_price"))
    ranked = range_rank(o, ["neg_price", "o_orderkey"], "rank")
    return ranked.select("o_orderkey", "rank")


# ---------------------------------------------------------------- R6


@query("gated_publish", "R6 S2 R1 R2 M1 IO5 A11")
def gated_publish(spark: SparkSession, d: str) -> DataFrame:
    """validate -> train -> gate -> publish; nothing is written unless every
    gate passes.  Returns the step log."""
    from featurelab.operators.flow import gated_run
    # two runs against one metrics log: the second must also beat the first
    metrics = scratch_path(spark, "metrics-log")
    first = gated_run(spark, d, metrics_path=metrics, gates={"accuracy": (">", 0.5)})
    second = gated_run(spark, d, metrics_path=metrics, gates={"accuracy": (">", 0.5)})
    return (first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))
            .select("run", "step", "status", "detail"))


@query("tree_attributions", "K5 K6 T3")
def tree_attributions(spark: SparkSession, d: str) -> DataFrame:
    """Sampled Shapley (25 paths) of the gradient-boosted classifier's
    P(toxic) for every test document, baseline = training means; the
    prediction and its attributions side by side (K6)."""
    df = doc_frame(spark, d)
    train, test = df.where(~F.col("is_test")), df.where("is_test")
    m = T.fit(train, DOC_FEATURES, "gbt_classifier", n_estimators=40, max_depth=5, learning_rate=0.2)
    means = train.agg(*[F.avg(c).alias(c) for c in DOC_FEATURES]).first().asDict()
    attrs = K.sampled_shapley_model(m, test, "doc_id", DOC_FEATURES, means, paths=25, output="probability")
    pred = m.transform(test).select("doc_id", "prediction", T.probability_of_one().alias("p_toxic"))
    return pred.join(attrs, "doc_id", "inner")
