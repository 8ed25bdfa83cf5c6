"""Metrics, gates and registry queries (M-, R-groups, A9, A10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featurelab.functions.columns import round4, stable_unit
from featurelab.operators import gates as G
from featurelab.operators import metrics as M
from featurelab.operators import registry as R
from featurelab.plans.registry import query
from featurelab.session import spread
from featurelab.sources.tables import Tables

# Keyword rule used as a baseline toxicity classifier (fixed values: words
# that occur in the driver's toxic documents)
TOXIC_WORDS = ["trash", "scum", "clown", "idiot", "worthless", "moron", "pathetic", "loser",
               "disgusting", "stupid"]
TOXIC_RE = "|".join(TOXIC_WORDS)


def toxic_rule_predictions(spark: SparkSession, d: str) -> DataFrame:
    """A keyword rule over the whole text of the labelled documents: the join
    comes first, so the pattern runs on labelled text only."""
    t = Tables(spark, d)
    j = spread(t.documents.select("doc_id", "text")).join(t.labels, "doc_id", "inner")
    hits = F.regexp_count("text", F.lit(f"(?i){TOXIC_RE}"))
    return j.select("doc_id", F.col("toxic").alias("label"), "quality", hits.alias("hits")).select(
        "doc_id", "label", (F.col("hits") > 0).cast("int").alias("prediction"),
        F.col("hits").cast("double").alias("score"), "quality")


RULE_CTE = f"""
WITH p AS (
  SELECT l.doc_id, l.toxic AS label, l.quality,
         len(regexp_extract_all(lower(d.text), '{TOXIC_RE}')) AS hits
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
q AS (SELECT doc_id, label, quality, CAST(hits > 0 AS INTEGER) AS prediction, CAST(hits AS DOUBLE) AS score FROM p)
"""


@query("binary_metrics", "M1", sql=RULE_CTE + """
, c AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
               count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
               count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
               count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn FROM q)
SELECT tp, fp, fn, tn,
       round(coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0), 4) AS accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1
FROM c
""")
def binary_metrics(spark: SparkSession, d: str) -> DataFrame:
    m = M.binary_metrics(toxic_rule_predictions(spark, d))
    return m.select("tp", "fp", "fn", "tn", *[round4(c).alias(c) for c in
                                              ("accuracy", "precision", "recall", "f1")])


@query("confusion", "M2", sql=RULE_CTE + """
, t AS (SELECT * FROM (VALUES (0), (1)) v(truth))
SELECT t.truth, CAST(count(q.doc_id) FILTER (WHERE q.prediction = 0) AS BIGINT) AS pred_0,
       CAST(count(q.doc_id) FILTER (WHERE q.prediction = 1) AS BIGINT) AS pred_1
FROM t LEFT JOIN q ON q.label = t.truth GROUP BY t.truth
""")
def confusion(spark: SparkSession, d: str) -> DataFrame:
    return M.confusion_matrix(toxic_rule_predictions(spark, d))


@query("class_report", "M3", sql=RULE_CTE + """
, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = prediction) AS correct,
               count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tp0,
               count(*) FILTER (WHERE prediction = 0) AS pp0, count(*) FILTER (WHERE label = 0) AS s0,
               count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp1,
               count(*) FILTER (WHERE prediction = 1) AS pp1, count(*) FILTER (WHERE label = 1) AS s1 FROM q),
pc AS (
  SELECT '0' AS class, coalesce(tp0 / nullif(pp0, 0), 0) AS precision, coalesce(tp0 / nullif(s0, 0), 0) AS recall,
         CAST(s0 AS DOUBLE) AS support, n FROM c
  UNION ALL
  SELECT '1', coalesce(tp1 / nullif(pp1, 0), 0), coalesce(tp1 / nullif(s1, 0), 0), CAST(s1 AS DOUBLE), n FROM c),
pf AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM pc),
allr AS (
  SELECT class, precision, recall, f1, support FROM pf
  UNION ALL SELECT 'accuracy', coalesce(correct / nullif(n, 0), 0), coalesce(correct / nullif(n, 0), 0),
                   coalesce(correct / nullif(n, 0), 0), CAST(n AS DOUBLE) FROM c
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), max(n) FROM pf
  UNION ALL SELECT 'weighted avg', sum(precision * support) / max(n), sum(recall * support) / max(n),
                   sum(f1 * support) / max(n), max(n) FROM pf)
SELECT class, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1,
       round(support, 4) AS support FROM allr
""")
def class_report(spark: SparkSession, d: str) -> DataFrame:
    r = M.classification_report(toxic_rule_predictions(spark, d))
    return r.select("class", *[round4(c).alias(c) for c in ("precision", "recall", "f1", "support")])


@query("roc_auc", "M5 H1", sql=RULE_CTE + """
, g AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
        FROM q GROUP BY score),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM g)
SELECT round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 4) AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
FROM c
""")
def roc_auc(spark: SparkSession, d: str) -> DataFrame:
    a = M.roc_auc(toxic_rule_predictions(spark, d), "label", "score")
    return a.select(round4("auc").alias("auc"), "n_pos", "n_neg")


@query("rmse_r2", "M4", sql="""
WITH e AS (SELECT event_type, value,
                  ((('0x' || substr(md5(CAST(event_id AS VARCHAR) || '42'), 1, 8))::BIGINT) % 1000000) < 250000 AS is_test
           FROM events),
fit AS (SELECT event_type, avg(value) AS pred FROM e WHERE NOT is_test GROUP BY event_type),
s AS (SELECT value AS y, pred FROM e JOIN fit USING (event_type) WHERE is_test)
SELECT round(sqrt(sum((y - pred) * (y - pred)) / count(*)), 4) AS rmse,
       round(1 - sum((y - pred) * (y - pred)) / (var_pop(y) * count(*)), 4) AS r2, count(*) AS n
FROM s
""")
def rmse_r2(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events.withColumn("is_test", stable_unit(F.col("event_id")) < 250_000)
    # a per-type mean "model" fitted on train rows, scored on test rows
    fit = e.where(~F.col("is_test")).groupBy("event_type").agg(F.avg("value").alias("prediction"))
    scored = e.where("is_test").join(fit, "event_type", "inner").select(
        F.col("value").alias("label"), "prediction")
    m = M.regression_metrics(scored)
    return m.select(round4("rmse").alias("rmse"), round4("r2").alias("r2"), "n")


# ------------------------------------------------ A9 A10 M6 M8 model evaluation

EVAL_CTE = """
WITH ev AS (
  SELECT d.lang AS model, CAST(l.quality AS DOUBLE) AS quality, CAST(1 - l.toxic AS DOUBLE) AS groundedness
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
s AS (SELECT model, avg(quality) AS quality_mean, stddev_samp(quality) AS quality_std,
             avg(groundedness) AS groundedness_mean, stddev_samp(groundedness) AS groundedness_std,
             count(*) AS row_count FROM ev GROUP BY model)
"""


def eval_table(spark: SparkSession, d: str) -> DataFrame:
    """(model, quality, groundedness) per scored response: the document's
    language stands for the model that wrote it."""
    t = Tables(spark, d)
    return t.labels.join(t.documents.select("doc_id", "lang"), "doc_id").select(
        F.col("lang").alias("model"), F.col("quality").cast("double").alias("quality"),
        (1 - F.col("toxic")).cast("double").alias("groundedness"))


def eval_summary_df(spark, d) -> DataFrame:
    return M.summary_by(eval_table(spark, d), "model", ["quality", "groundedness"])


@query("eval_summary", "A9 A10", sql=EVAL_CTE + """
SELECT model, round(quality_mean, 3) AS quality_mean, round(quality_std, 3) AS quality_std,
       round(groundedness_mean, 3) AS groundedness_mean, round(groundedness_std, 3) AS groundedness_std,
       row_count FROM s
""")
def eval_summary(spark: SparkSession, d: str) -> DataFrame:
    s = eval_summary_df(spark, d)
    return s.select("model", *[round4(c, 3).alias(c) for c in
                               ("quality_mean", "quality_std", "groundedness_mean", "groundedness_std")],
                    "row_count")


BASELINE_MODEL = "en"


@query("eval_compare", "M6 J10", sql=EVAL_CTE + """
SELECT c.model, round(c.quality_mean - b.quality_mean, 4) AS quality_delta,
       round(c.groundedness_mean - b.groundedness_mean, 4) AS groundedness_delta
FROM s c JOIN s b ON b.model = 'en' WHERE c.model <> 'en'
""")
def eval_compare(spark: SparkSession, d: str) -> DataFrame:
    return _deltas(spark, d).select("model", round4("quality_delta").alias("quality_delta"),
                                    round4("groundedness_delta").alias("groundedness_delta"))


def _deltas(spark, d) -> DataFrame:
    s = eval_summary_df(spark, d)
    # one row per model: the baseline's means reach every row through a
    # window over this small summary (no join, no cross product)
    w = Window.partitionBy()
    base = lambda c: F.max(F.when(F.col("model") == BASELINE_MODEL, F.col(c))).over(w)
    j = s.withColumns({"bq": base("quality_mean"), "bg": base("groundedness_mean")})
    return j.where(F.col("model") != BASELINE_MODEL).select(
        "model", (F.col("quality_mean") - F.col("bq")).alias("quality_delta"),
        (F.col("groundedness_mean") - F.col("bg")).alias("groundedness_delta"))


@query("eval_decision", "M8", sql=EVAL_CTE + """
, dl AS (SELECT c.model, c.quality_mean - b.quality_mean AS qd, c.groundedness_mean - b.groundedness_mean AS gd
         FROM s c JOIN s b ON b.model = 'en' WHERE c.model <> 'en')
SELECT model, CASE WHEN gd IS NULL OR qd IS NULL THEN 'stay' WHEN gd < 0 THEN 'keep_baseline'
                   WHEN qd > 0.5 AND gd >= 0 THEN 'switch' ELSE 'stay' END AS decision
FROM dl
""")
def eval_decision(spark: SparkSession, d: str) -> DataFrame:
    dl = _deltas(spark, d)
    return dl.select("model", M.decision_rule(F.col("quality_delta"), F.col("groundedness_delta"))
                     .alias("decision"))


# ------------------------------------------------ M7 text overlap

@query("text_overlap_scores", "M7", sql="""
WITH u AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'),
pr AS (SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS response
       FROM u JOIN a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1),
tk AS (SELECT conv_id, turn,
              list_distinct(string_split_regex(regexp_replace(lower(prompt), '^\\s+|\\s+$', '', 'g'), '\\s+')) AS ta,
              list_distinct(string_split_regex(regexp_replace(lower(response), '^\\s+|\\s+$', '', 'g'), '\\s+')) AS tb,
              len(string_split_regex(regexp_replace(prompt, '^\\s+|\\s+$', '', 'g'), '\\s+')) AS na,
              len(string_split_regex(regexp_replace(response, '^\\s+|\\s+$', '', 'g'), '\\s+')) AS nb
       FROM pr),
sc AS (SELECT *, len(list_intersect(ta, tb)) AS i FROM tk)
SELECT conv_id, turn, round(coalesce(i / nullif(len(ta) + len(tb) - i, 0), 0), 4) AS overlap,
       round(coalesce(i / nullif(len(tb), 0), 0), 4) AS groundedness,
       round(coalesce(nb / nullif(na, 0), 0), 4) AS compression
FROM sc
""")
def text_overlap_scores(spark: SparkSession, d: str) -> DataFrame:
    c = Tables(spark, d).conversations
    u = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    a = c.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    pairs = u.join(a, ["conv_id", "turn"], "inner")
    return pairs.select("conv_id", "turn",
                        *[round4(col).alias(name) for col, name in
                          zip(M.overlap_scores(F.col("prompt"), F.col("response")),
                              ["overlap", "groundedness", "compression"])])


# ------------------------------------------------ R1 R2 gates

GATES = [("mean_value", ">", 20.0), ("n_runs", ">=", 1000.0), ("max_value", "<=", 500.0)]


@query("gate_decision", "R1 R2", sql="""
WITH m AS (SELECT event_type AS model, avg(value) AS mean_value, CAST(count(*) AS DOUBLE) AS n_runs,
                  max(value) AS max_value FROM events GROUP BY event_type)
SELECT model, (mean_value > 20.0) AND (n_runs >= 1000.0) AND (max_value <= 500.0)
              AND model NOT IN ('error', 'view') AS passes,
       CAST(3 AS BIGINT) AS n_checks
FROM m
""")
def gate_decision(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    wide = e.groupBy(F.col("event_type").alias("model")).agg(
        F.avg("value").alias("mean_value"), F.count(F.lit(1)).cast("double").alias("n_runs"),
        F.max("value").alias("max_value"))
    long = wide.select("model", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m, _, _ in GATES])).alias("x")) \
        .select("model", "x.metric", "x.value")
    # a model may lack a metric or have a NULL one: both fail its gates
    long = long.where((F.col("model") != "error") | (F.col("metric") != "n_runs")).withColumn(
        "value", F.when((F.col("model") != "view") | (F.col("metric") != "max_value"), F.col("value")))
    gates = spark.createDataFrame(GATES, "metric string, op string, bound double")
    return G.threshold_gate(long, gates, ["model"])


# ------------------------------------------------ R3 R4 registry aliases

ALIAS_CTE = """
WITH ev AS (
  SELECT event_type AS model, 'champion' AS alias, event_id AS version, ts AS set_at, 1 AS seq, 'add' AS action
  FROM events WHERE value > 250
  UNION ALL
  SELECT event_type, 'champion', event_id, ts, 0, 'remove' FROM events WHERE value > 250 AND event_id % 5 = 0
  UNION ALL
  SELECT event_type, 'challenger', event_id, ts, 1, 'add' FROM events WHERE value < 1.0),
r AS (SELECT *, row_number() OVER (PARTITION BY model, alias ORDER BY set_at DESC, seq DESC) AS rn FROM ev)
"""


def alias_events(events: DataFrame) -> DataFrame:
    """Alias history derived from the event log: high values promote to
    champion, some are removed again, very low values mark challengers."""
    base = events.select(F.col("event_type").alias("model"), F.col("event_id").alias("version"),
                         F.col("ts").alias("at"), "value")
    add_c = base.where("value > 250").select("model", F.lit("champion").alias("alias"), "version", "at",
                                             F.lit(1).alias("seq"), F.lit("add").alias("action"))
    rem_c = base.where((F.col("value") > 250) & (F.pmod("version", F.lit(5)) == 0)).select(
        "model", F.lit("champion").alias("alias"), "version", "at", F.lit(0).alias("seq"),
        F.lit("remove").alias("action"))
    add_ch = base.where("value < 1.0").select("model", F.lit("challenger").alias("alias"), "version",
                                              "at", F.lit(1).alias("seq"), F.lit("add").alias("action"))
    return add_c.unionByName(rem_c).unionByName(add_ch)


@query("model_versions", "R3 R4", sql=ALIAS_CTE + """,
cur AS (SELECT model, version, string_agg(alias, ',' ORDER BY alias) AS aliases FROM r
        WHERE rn = 1 AND action = 'add' GROUP BY model, version),
v AS (SELECT event_type AS model, event_id AS version, ts AS created_at,
             row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS number,
             lag(event_id) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS parent FROM events)
SELECT v.model, v.number, v.version, v.created_at, v.parent, coalesce(cur.aliases, '') AS aliases
FROM v LEFT JOIN cur ON v.model = cur.model AND v.version = cur.version
""")
def model_versions(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    versions = e.select(F.col("event_type").alias("model"), F.col("event_id").alias("version"), F.col("ts").alias("created_at"))
    return R.list_versions(versions, alias_events(e))


@query("alias_resolution", "R4", sql=ALIAS_CTE + """
SELECT model, alias, version, set_at FROM r WHERE rn = 1 AND action = 'add'
""")
def alias_resolution(spark: SparkSession, d: str) -> DataFrame:
    return R.resolve_aliases(alias_events(Tables(spark, d).events)).select(
        "model", "alias", "version", F.col("at").alias("set_at"))


TRAFFIC = [("v1", 90), ("v2", 10)]


@query("traffic_split", "R5 A8", sql="""
WITH r AS (SELECT CASE WHEN floor(((('0x' || substr(md5(CAST(user_id AS VARCHAR) || '11'), 1, 8))::BIGINT) % 1000000) / 10000) < 90
                       THEN 'v1' ELSE 'v2' END AS target FROM events)
SELECT target, count(*) AS n_requests, round(count(*) / sum(count(*)) OVER (), 4) AS share
FROM r GROUP BY target
""")
def traffic_split(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    routed = e.select(R.traffic_route(F.col("user_id"), TRAFFIC).alias("target"))
    counts = routed.groupBy("target").agg(F.count(F.lit(1)).alias("n_requests"))
    # one row per target: the share's denominator is a window over that
    share = F.col("n_requests") / F.sum("n_requests").over(Window.partitionBy())
    return counts.select("target", "n_requests", round4(share).alias("share"))
