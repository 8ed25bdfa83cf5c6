"""The pipeline's stages, each on its predecessor's output, and odd tables."""

import corpus_pipeline as C
from featurelab.llm import bpe, decontaminate, line_dedup, quality_gam, simhash_dedup
from featurelab.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def stages(spark, docs, sf_dir, tmp_path):
    out = [docs]
    for i, (_, f) in enumerate(C.STAGES):
        f(spark, out[-1], sf_dir).write.parquet(str(tmp_path / str(i)))
        out.append(spark.read.parquet(str(tmp_path / str(i))))
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    d = stages(spark, docs, SF, tmp_path)
    assert all(x.columns == docs.columns for x in d[:5])
    scored = quality_gam.score(docs, quality_gam.train(docs, labels))
    assert ids(d[1]) == ids(scored.where("predicted = 1"))
    cut = {r["doc_id"]: r for r in line_dedup.dedup_lines(d[1], whole=True).collect()}
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in d[2].collect()} == {
        k: (r["text"], len(r["text"]) if r["n_removed"] else r["n_chars"]) for k, r in cut.items()}
    groups = simhash_dedup.simhash_components(d[2])
    assert ids(d[3]) == {r["component_id"] for r in groups.collect()}
    leaks = ids(decontaminate.find_leaks(d[3], bench))
    assert ids(d[4]) == ids(d[3]) - leaks
    import public_tokenizers
    want = bpe.encode_decode(d[4], public_tokenizers.path("word_bpe_49k.json"))
    assert sorted(map(tuple, want.collect())) == sorted(map(tuple, d[5].collect()))
    assert sorted(map(tuple, C.run(spark, SF).collect())) == sorted(map(tuple, d[5].collect()))


def test_odd_documents(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, None, None, None, None, "a"), (2, "", "en", "s", 0, None), (None, "words of no one", "en", "s", 15, "b"),
         (3, "some plain words in a line of text", "en", "s", 34, "c"),
         (3, "some plain words in a line of text", "en", "s", 34, "c"),
         (4, "other plain words " * 20_000, "en", "s", 1, "d")],
        "doc_id long, text string, lang string, source string, n_chars long, fp string")
    d = stages(spark, docs, SF, tmp_path)
    assert all(x.columns == docs.columns for x in d[:5])
    empty = stages(spark, docs.limit(0), SF, tmp_path / "empty")
    assert all(x.count() == 0 for x in empty)


def test_registered():
    import __spark_entry__ as E
    names = E.queries()
    assert [n for n in names if n in QUERIES] == list(QUERIES)
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert set(SQL) <= set(E.oracle_sql())
    assert 4 <= len(C.STAGES) <= 5


def test_stages_with_clashing_columns(spark, tmp_path):
    """Extra columns under names that the operators use inside."""
    names = ["gone", "gone_id", "keep", "_keep", "_drop", "_drop_id", "_id", "_text", "_y", "_t", "id", "t", "fp", "w", "x", "k1",
             "component_id", "component", "node", "drop", "score", "predicted", "item", "item_id"]
    docs = spark.createDataFrame([(i, f"plain words number {i} in a line\nand the same words again here", "en", "s", 60) for i in range(6)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", *[f"concat('{n}', doc_id) AS `{n}`" for n in names])
    d = stages(spark, docs, SF, tmp_path)
    for x in d[1:5]:
        assert x.columns == docs.columns
        assert all(r[n] == f"{n}{r['doc_id']}" for r in x.collect() for n in names)
