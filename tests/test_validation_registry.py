"""Schema checks (S1-S3), table creation (IO6), alias swaps (R3, R4),
gates (R1), reference assertions on encoders' shapes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from featurelab.operators import gates as G
from featurelab.operators import registry as R
from featurelab.operators import validate as V
from featurelab.session import scratch_path
from featurelab.sources import files as IO


def test_ordered_columns_raise(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    V.require_ordered_columns(df, ["a", "b"])
    with pytest.raises(V.SchemaMismatch):
        V.require_ordered_columns(df, ["b", "a"])  # order matters in this mode


def test_column_set_report(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, x int")
    rep = V.column_set_report(df, ["b", "a", "c"])
    assert not rep.matches and rep.missing == ("c",) and rep.unexpected == ("x",)
    assert V.column_set_report(df, ["x", "a", "b"]).matches  # set mode ignores order
    rows = {(r.column, r.status) for r in V.report_frame(spark, rep).collect()}
    assert rows == {("c", "missing"), ("x", "unexpected")}


def test_missing_fields_absent_vs_null(spark):
    df = spark.createDataFrame([('{"a": 1, "b": null}',), ('{"a": 2}',), ("not json",)], "p string")
    got = [r.m for r in df.select(F.array_join(V.missing_fields(F.col("p"), ["a", "b"]), ",").alias("m"))
           .collect()]
    assert got == ["", "b", "a,b"]


def test_null_audit_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), None), (None, "y")], "d double, s string")
    r = V.null_audit(df).first()
    assert (r.n_rows, r.null_d, r.null_s) == (3, 2, 1)


def test_create_table_if_missing(spark):
    path = scratch_path(spark, "tbl")
    schema = T.StructType([T.StructField("name", T.StringType(), False),
                           T.StructField("post_abbr", T.StringType(), False)])
    IO.create_table_if_missing(spark, "us_states_t", schema, path)
    IO.create_table_if_missing(spark, "us_states_t", schema, path)  # second call is a no-op
    assert spark.table("us_states_t").columns == ["name", "post_abbr"]
    spark.sql("DROP TABLE IF EXISTS us_states_t")


def test_alias_swap_and_resolution(spark):
    t = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([("m", "champion", 1, t, 1, "add")],
                               "model string, alias string, version bigint, at timestamp, seq int, action string")
    ev = ev.unionByName(R.swap_alias_events(spark, "m", "champion", 1, 2, t + dt.timedelta(days=1)))
    cur = R.resolve_aliases(ev).collect()
    assert [(r.model, r.alias, r.version) for r in cur] == [("m", "champion", 2)]
    removed = ev.unionByName(spark.createDataFrame([("m", "champion", 2, t + dt.timedelta(days=2), 0, "remove")],
                                                   ev.schema))
    assert R.resolve_aliases(removed).count() == 0


def test_traffic_split_sticky_and_shares(spark):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    a = e.select("user_id", R.traffic_route(F.col("user_id"), [("v1", 90), ("v2", 10)]).alias("t"))
    assert a.groupBy("user_id").agg(F.countDistinct("t").alias("n")).where("n > 1").count() == 0
    with pytest.raises(ValueError):
        R.traffic_route(F.col("user_id"), [("v1", 90), ("v2", 20)])


def test_threshold_gate_ops_are_data(spark):
    metrics = spark.createDataFrame([("m", "f1", 0.70), ("m", "accuracy", 0.5)],
                                    "model string, metric string, value double")
    strict = spark.createDataFrame([("f1", ">", 0.70)], "metric string, op string, bound double")
    loose = spark.createDataFrame([("f1", ">=", 0.70)], "metric string, op string, bound double")
    assert not G.threshold_gate(metrics, strict, ["model"]).first().passes
    assert G.threshold_gate(metrics, loose, ["model"]).first().passes


def test_a_missing_or_null_metric_fails_the_gate(spark):
    metrics = spark.createDataFrame([("a", "acc", 0.9), ("a", "f1", 0.9), ("b", "f1", 0.9), ("c", "acc", None), ("c", "f1", 0.9)],
                                    "model string, metric string, value double")
    gates = spark.createDataFrame([("acc", ">", 0.5), ("f1", ">", 0.5)], "metric string, op string, bound double")
    got = {r.model: (r.passes, r.n_checks) for r in G.threshold_gate(metrics, gates, ["model"]).collect()}
    assert got == {"a": (True, 2), "b": (False, 2), "c": (False, 2)}
    assert not G.threshold_gate(metrics.where("model = 'b'").drop("model"), gates).first().passes


def test_beat_the_last_with_a_null_metric(spark):
    log = spark.createDataFrame([("a", 1, 0.9), ("a", 2, None), ("b", 1, None), ("b", 2, 0.8), ("c", 1, 0.9), ("c", 2, 0.8)],
                                "algo string, run int, metric double")
    got = {r.algo: r.passes for r in G.beat_the_last(log, "algo", ["run"], "metric", 0.5).collect()}
    assert got == {"a": False, "b": True, "c": False}


def test_an_unreadable_metrics_log_stops_the_run(spark, tmp_path):
    from featurelab.operators.flow import last_metric
    assert last_metric(spark, str(tmp_path / "none"), "x", "f1") is None
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        last_metric(spark, str(tmp_path / "log"), "x", "f1")


def test_beat_the_last_without_history(spark):
    log = spark.createDataFrame([("knn", 1, 0.99)], "algo string, run int, metric double")
    r = G.beat_the_last(log, "algo", ["run"], "metric", 0.98).first()
    assert r.passes and r.previous_metric is None


def test_run_log_append_and_summary(spark):
    from featurelab.sources.logs import append_log, run_log_entries
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    path = scratch_path(spark, "runlog")
    entries = run_log_entries(ev)
    append_log(entries, path)
    append_log(entries, path)  # a second run appends, nothing is rewritten
    back = spark.read.schema("keyword string, ts timestamp, message string, status int").json(path)
    assert back.count() == 2 * ev.count()
    assert set(r.status for r in back.select("status").distinct().collect()) <= {0, 1}


def test_category_counts_zero_rows_and_other(spark):
    from featurelab.operators.aggregate import category_counts
    df = spark.createDataFrame([("billing",), ("bug",), ("bug",), ("weird",)], "c string")
    rows = [(r.category, r.position, r.n) for r in category_counts(df, "c", ["billing", "account", "bug"])
            .orderBy("position").collect()]
    assert rows == [("billing", 0, 1), ("account", 1, 0), ("bug", 2, 2), ("other", 3, 1)]


def test_confusion_matrix_has_every_class(spark):
    from featurelab.operators.metrics import confusion_matrix
    df = spark.createDataFrame([(1, 1), (1, 1)], "label int, prediction int")
    rows = {r.truth: (r.pred_0, r.pred_1) for r in confusion_matrix(df).collect()}
    assert rows == {0: (0, 0), 1: (0, 2)}


def test_lookup_join_lets_the_planner_choose(spark):
    from featurelab.operators.joins import lookup_join
    out = lookup_join(spark.range(100), spark.range(10).withColumn("x", F.lit(1)), "id")
    assert out.count() == 100 and out.where("x = 1").count() == 10
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString()


def test_cli_lists_every_query(capsys):
    from featurelab.__main__ import main
    from featurelab.plans.registry import load_all
    assert main(["list"]) == 0
    lines = [line for line in capsys.readouterr().out.splitlines() if line.strip()]
    assert len(lines) == len(load_all())
    assert main([]) == 2
