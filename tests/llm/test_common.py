"""Bounds on what the shared helpers hold: Arrow batches and shuffle files."""

import time

import pyarrow as pa
from pyspark.sql import functions as F

from featurelab.llm import common as C


def test_long_texts_come_in_small_batches(spark):
    before = spark.conf.get(C.BATCH)
    spark.conf.unset(C.BATCH)
    try:
        docs = spark.range(0, 400, 1, 1).select("id", F.repeat(F.lit("x"), 100_000).alias("text"))

        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

        got = C.text_rows(docs).coalesce(1).mapInArrow(sizes, "n long, size long").collect()
        assert sum(r["n"] for r in got) == 400
        assert max(r["size"] for r in got) < 2 * C.BATCH_BYTES
        spark.conf.set(C.BATCH, "1m")  # a smaller bound stays
        C.text_rows(docs)
        assert spark.conf.get(C.BATCH) == "1m"
    finally:
        spark.conf.set(C.BATCH, before)
    assert [C._bytes(x) for x in ("67108864b", "64m", "1kb", "7")] == [1 << 26, 1 << 26, 1 << 10, 7]


def test_a_shared_table_leaves_no_shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles() -> set:
        files = blocks.getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    before, setting = shuffles(), spark.conf.get(C.CLEANUP)
    df = spark.range(10_000).groupBy((F.col("id") % 999).alias("k")).count()
    made = C.shared_table(df, "shuffles")
    until = time.time() + 20
    while (left := shuffles() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and spark.conf.get(C.CLEANUP) == setting and made.count() == 999
