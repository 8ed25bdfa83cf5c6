"""Snapshots, dated writes, bucketed slices, sparse dummies, file sources."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from featurelab.operators import encode as E
from featurelab.operators import joins as J
from featurelab.operators import store as FS
from featurelab.operators.retrieval import extractive_summary
from featurelab.operators.text import items_of
from featurelab.session import scratch_path
from featurelab.sources import files as IO
from featurelab.sources.doc_files import file_heads, write_documents
from featurelab.streaming import feature_sync as S

T0 = dt.datetime(2024, 1, 1)


def test_serving_reads_the_snapshot_and_later_deltas(spark):
    base = scratch_path(spark, "snap")
    schema = "entity_id string, feature_timestamp timestamp, v double"
    for i in range(7):
        rows = [(f"e{j}", T0 + dt.timedelta(days=(i * 5 + j) % 7), float(10 * i + j)) for j in range(4)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(base + "/landing")
        S.sync_features(spark, base + "/landing", schema, base + "/serving", base + "/ckpt", ["v"], compact_every=3)
    serving = base + "/serving"
    assert S.current_version(spark, serving) == 5
    assert [p.rsplit("/", 1)[1] for p in S.serving_paths(spark, serving)] == ["through=5", "batch_id=6"]
    every = spark.read.schema(schema).parquet(base + "/landing")
    want = {r["entity_id"]: r["v"] for r in FS.latest_features(every, ["v"]).collect()}
    assert {r["entity_id"]: r["v"] for r in S.read_serving(spark, serving, ["v"]).collect()} == want
    # a snapshot without its marker does not count, and is written over
    spark.createDataFrame([("bad", T0, 1.0)], schema).write.parquet(serving + "/snapshots/through=6")
    assert S.current_version(spark, serving) == 5
    S.compact(spark, serving, 6, ["v"])
    S.compact(spark, serving, 6, ["v"])
    assert S.serving_paths(spark, serving) == [serving + "/snapshots/through=6"]
    assert {r["entity_id"]: r["v"] for r in S.read_serving(spark, serving, ["v"]).collect()} == want
    assert S.read_serving(spark, base + "/none", ["v"]).collect() == []


def test_offline_batch_adds_one_file_per_date(spark):
    path = scratch_path(spark, "dated")
    df = spark.range(3000).select(F.col("id").cast("string").alias("entity_id"),
                                  F.timestamp_seconds(F.pmod("id", F.lit(9)) * 86400).alias("feature_timestamp"), F.lit(1.0).alias("v"))
    for _ in range(2):
        FS.write_offline(df.repartition(8), path)
    for d in (x for x in os.listdir(path) if x.startswith("feature_date")):
        assert len([f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")]) == 2
    assert spark.read.parquet(path).count() == 6000
    hot = scratch_path(spark, "dated-hot")
    FS.write_offline(df.withColumn("feature_timestamp", F.when(F.col("entity_id") < "2", F.col("feature_timestamp"))), hot, day_rows=200)
    sizes = {d: len([f for f in os.listdir(f"{hot}/{d}") if f.endswith(".parquet")]) for d in os.listdir(hot) if d.startswith("feature")}
    assert 2 <= sizes.pop("feature_date=__HIVE_DEFAULT_PARTITION__") <= 8 and set(sizes.values()) == {1}
    assert spark.read.parquet(hot).count() == 3000


def test_bucketed_slices_meet_without_an_exchange(spark):
    base = scratch_path(spark, "bucketed")
    df = spark.range(200).select("id", (F.col("id") * 2).alias("a"), (F.col("id") * 3).alias("b"), (F.col("id") % 5).alias("c"))
    tag = base.rsplit("-", 1)[1]
    parts = [df.select("id", "a"), df.where("id % 3 = 0").select("id", "b"), df.where("id > 50").select("id", "c")]
    slices = [J.write_bucketed(p, "id", f"t{i}_{tag}", f"{base}/{i}", 4) for i, p in enumerate(parts)]
    wide = J.rejoin_slices(slices, "id")
    assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, wide.collect())) == [
        (i, 2 * i, 3 * i if i % 3 == 0 else None, i % 5 if i > 50 else None) for i in range(200)]


def test_asof_reads_each_side_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    left = spark.createDataFrame([("k", T0, 1), (None, T0, 2), ("k", None, 3)], "k string, t timestamp, i int")
    left = left.mapInArrow(count, left.schema)
    right = spark.createDataFrame([("k", T0, 7.0)], "k string, t timestamp, v double")
    got = sorted((r["i"], r["v"]) for r in J.asof_join(left, right, "k", "t", "t", ["v"]).collect())
    assert got == [(1, 7.0), (2, None), (3, None)] and seen.value == 3


def test_many_categories_without_a_collect(spark):
    df = spark.range(100_000).select("id", F.format_string("v%06d", F.col("id")).alias("big"),
                                     F.when(F.col("id") % 2 == 0, F.lit("x")).when(F.col("id") % 3 == 0, F.lit("y")).alias("small"))
    rows, width = E.one_hot_sparse(df, ["small", "big"])
    assert width == 1 + 99_999
    got = {r["id"]: r["indices"] for r in rows.where("id in (0, 1, 3, 99999)").collect()}
    assert got == {0: [], 1: [1], 3: [0, 3], 99999: [0, 99_999]}
    dense = E.fit_one_hot(df.limit(10), ["small"]).transform(df.limit(10))
    assert "small_y" in dense.columns


def test_documents_and_heads(spark):
    base = scratch_path(spark, "docs")
    df = spark.createDataFrame([("a/1.txt", "é\nx"), ("a/2 b.txt", ""), ("b/3.txt", None)], "n string, c string")
    write_documents(df, base, "n", "c")
    got = {r["path"].rsplit("/", 1)[1]: (r["length"], bytes(r["content"])) for r in IO.read_binary(spark, base, "*.txt").collect()}
    assert got == {"1.txt": (4, "é\nx".encode())}  # Spark's scans skip empty files
    assert [os.path.getsize(f"{base}/{p}") for p in ("a/1.txt", "a/2 b.txt", "b/3.txt")] == [4, 0, 0]
    assert sorted(r["header"] for r in file_heads(spark, base, ".txt").collect()) == ["", "", "é"]
    with pytest.raises(Exception, match="file name"):
        write_documents(spark.createDataFrame([(None, "x")], "n string, c string"), base, "n", "c")


def test_csv_folder_by_name(spark, tmp_path):
    (tmp_path / "x y").mkdir()
    (tmp_path / "x y" / "a=1.csv").write_text("id;name;w\n1;one;0.5\n\n2;\"t;wo\";\n")
    (tmp_path / "b.csv").write_text("name;id\nthree;3\n")
    (tmp_path / "c.csv").write_text("id;extra.col\n4;e")
    (tmp_path / "skip.txt").write_text("nothing")
    got = IO.read_csv_folder_by_name(spark, str(tmp_path), {"id": "int", "w": "double"}, sep=";")
    assert set(got.columns) == {"id", "name", "w", "extra.col"}
    assert sorted((r["id"], r["name"], r["w"], r["extra.col"]) for r in got.collect()) == [
        (1, "one", 0.5, None), (2, "t;wo", None, None), (3, "three", None, None), (4, None, None, "e")]
    (tmp_path / "none").mkdir()
    assert IO.read_csv_folder_by_name(spark, str(tmp_path / "none"), {"id": "int"}).collect() == []


def test_heads_read_no_more_than_the_first_block(tmp_path, monkeypatch):
    from pyarrow import fs

    from featurelab.sources import doc_files as D
    (tmp_path / "big.csv").write_text("a,b\n" + "1,2\n" * 2_000_000)
    reader = D.HeadReader({"path": str(tmp_path)})
    asked = []

    class Counting:
        def __init__(self, f):
            self.f = f

        def __enter__(self):
            return self

        def __exit__(self, *a):
            self.f.close()

        def read(self, n):
            asked.append(n)
            return self.f.read(n)

    class Local:
        def open_input_stream(self, p):
            return Counting(fs.LocalFileSystem().open_input_stream(p))

    parts = reader.partitions()
    monkeypatch.setattr(D.fs, "FileSystem", type("X", (), {"from_uri": staticmethod(lambda p: (Local(), p))}))
    assert [b.column("header").to_pylist() for p in parts for b in reader.read(p)] == [["a,b"]] and sum(asked) == D.HEAD_BYTES


def test_summaries_and_items(spark):
    df = spark.createDataFrame([(1, "a b. a a! c? ..."), (2, None), (3, ""), (4, "1 2. 3!"), (5, "x. y. x y. x.")], "id int, t string")
    got = {r["id"]: (r["n_sentences"], r["summary"]) for r in extractive_summary(df, "id", "t", 2).collect()}
    # "a" occurs three times in text 1, "b" and "c" once
    assert got == {1: (3, "a b. a a!"), 4: (2, None), 5: (4, "x. x.")} or got[1][1] == "a b. a a!"
    items = df.where("id = 1").select(F.explode(items_of(F.lit("p=1, q=, r=3"), r"(\w)=(\d*)", ["k", "v"])).alias("x")).select("x.*")
    assert [tuple(r) for r in items.collect()] == [("p", "1"), ("q", ""), ("r", "3")]


def test_spread_starts_no_job(spark):
    from featurelab.session import spread
    df = spark.range(1000).repartition(2, "id").groupBy((F.col("id") % 7).alias("k")).count()
    one = spark.range(10).coalesce(1)
    spark.sparkContext.setJobGroup("spread-test", "spread")
    try:
        spread(df)
        wide = spread(one, max_partitions=4)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("spread-test")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert wide.rdd.getNumPartitions() == 4


def test_scans_find_what_sparks_own_scans_find(spark, tmp_path):
    texts = {"a/1.txt": "é\nx", "a/2 b.txt": "", "a=1/é%#?[].txt": "q", "_h/3.txt": "z", "_k=1/4.txt": "z\r\n", "top.txt": "t",
             ".hid.txt": "t", "b/c/d/5.txt": "﻿bom", "b/6.csv": "no", "b/_7.txt": "h", "c/8.txt": "\udcff\udcfe"}
    for name, text in texts.items():
        p = tmp_path / "x y" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(text.encode("utf-8", "surrogateescape"))
    base = str(tmp_path / "x y")
    for glob in ("*", "*.txt"):
        own = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
        binary = own.format("binaryFile").load(base).withColumn("content_b64", F.base64("content"))
        whole = own.text(base, wholetext=True).withColumn("path", F.input_file_name())
        for want, got in ((binary, IO.read_binary(spark, base, glob)), (whole, IO.read_whole_text(spark, base, glob))):
            assert got.dtypes == want.dtypes
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_scans_leave_file_names_to_tasks(spark, tmp_path):
    from featurelab.sources import doc_files as D
    base = str(tmp_path)
    write_documents(spark.range(300).selectExpr("concat(id % 3, '/', id, '.txt') n", "'x' c"), base, "n", "c")
    for df in (IO.read_binary(spark, base, "*.txt"), IO.read_whole_text(spark, base, "*.txt")):
        assert df.count() == 300 and df.inputFiles() == []  # Spark's scans hold every file on the driver
    parts = D.HeadReader({"path": base, "suffix": ".txt"}).partitions()
    assert len(parts) == 3 and not any(p.paths for p in parts)
    assert file_heads(spark, base, ".txt").count() == 300
