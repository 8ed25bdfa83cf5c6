"""The registered queries of this subpackage, with their SQL where DuckDB can
express them: ``QUERIES`` maps a name to a callable (spark, sf_dir), ``SQL`` a
name to DuckDB SQL over the same tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.llm import (bpe, decontaminate, language_id, line_dedup, periodic_runs, phrases, pii,
                            quality_gam, simhash_dedup, suffix_dedup, token_count, topk_search, warc)
from featurelab.llm.common import workers_import
from featurelab.session import scratch_path
from featurelab.sources.tables import table

PSEUDONYM_KEY = "featurelab"  # production jobs pass their own


def remainder(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(mod))


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents by SimHash, 3-word shingles, 2 bits."""
    found = simhash_dedup.simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BPE ids and their decoded text, as digests, of all documents."""
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by linked pseudonyms."""
    return pii.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with one occurrence of each group of similar lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, whole=True)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder("doc_id", 4) == 2
    model = language_id.train(docs.where(~held_out & F.col("doc_id").isNotNull()))
    return language_id.predict(docs, model, keep=[held_out.alias("held_out")]).select(
        "doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of all documents, and whether they pass 4,096 tokens."""
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                                    limit=4096)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents, learned from four fifths of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    model = quality_gam.train(docs, labels)
    return quality_gam.score(docs, model, keep=[(remainder("doc_id", 5) == 0).alias("held_out")], threshold=0.3).select(
        "doc_id", "held_out", "score", "predicted")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, test item) whose passage holds the item."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other vectors of every 50th vector by integer inner product."""
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0, k=5)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 200-byte strings that occur twice."""
    cut = suffix_dedup.drop_repeats(table(spark, sf_dir, "documents"), length=200)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as a WARC archive and read back from it."""
    pages = warc.mark_revisits(table(spark, sf_dir, "pages").select("page_id", "url", "html"), "page_id", "html")
    urn = [F.when(F.col(c).isNotNull(), F.concat(F.lit("urn:page:"), F.col(c).cast("string"))).alias(n)
           for c, n in (("page_id", "record_id"), ("refers_to", "refers_to"))]
    path = scratch_path(spark, "op11-warc")
    warc.write_archive(pages.select(*urn, "record_type", F.col("url").alias("target_uri"), "payload_digest",
                                    "payload_length", F.lit("text/html; charset=utf-8").alias("content_type"),
                                    "payload"), path)
    back = warc.read_archive(spark, path).where(F.col("record_type").isin("response", "revisit"))
    page = [F.substring_index(c, ":", -1).cast("long").alias(n) for c, n in (("record_id", "page_id"), ("refers_to", "refers_to"))]
    whole = F.col("record_type") == "response"  # its bytes are at hand: measured again, not taken from the headers
    return back.select(
        page[0], F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(whole, warc.base32_sha1(F.col("payload"))).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", page[1])


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 best phrases of two or three words, met 10 times."""
    return phrases.collocations(table(spark, sf_dir, "documents"), depth=3, min_count=10, swallow_pct=50, top=2000)


def repeated_tail(doc_id: Column, text: Column) -> Column:
    """Op 13's input: with h = crc32 of the id in decimal, one text in ten
    repeats its words from word a on with period p (a, p from h); the others,
    and texts of a null id, stay as they are."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = F.crc32(doc_id.cast("string"))

    def cut(w: Column) -> Column:
        g, n = F.floor(h / 10), F.size(w)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, a + F.pmod(i - a, p)))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, 1, a), tail), " ")).otherwise(text)

    # a one-element array gives the words a name, so they are split once
    one = F.transform(F.array(words), cut)
    return F.when(F.pmod(h, F.lit(10)) == 0, F.get(one, F.lit(0))).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least 24 words and three periods in all documents, and the
    texts without their repeats, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", repeated_tail(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.collapse_runs(docs, min_words=24, min_periods=3).drop("text")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listing = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    # greater exponent first, without division: lengths and periods cross-multiplied
    ahead = lambda x, y: (x["length"].cast("decimal(19,0)") * y["period"], y["length"].cast("decimal(19,0)") * x["period"])

    def better(x: Column, y: Column) -> Column:
        a, b = ahead(x, y)
        return F.when(x.isNull() | (b > a) | ((a == b) & (F.struct(y["start"], y["period"]) < F.struct(x["start"], x["period"]))),
                      y).otherwise(x)

    best = F.aggregate("runs", F.get("runs", F.lit(0)), better)
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listing, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def _ready(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_import(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _ready(f) for f in (op1_simhash_dedup, op2_bpe, op3_pii, op4_line_dedup, op5_language_id, op6_token_counts,
                            op7_quality, op8_decontaminate, op9_topk, op10_suffix_dedup, op11_warc, op12_phrases,
                            op13_periodic_runs,
                            pipeline)}

OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP11_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS s
  FROM pages),
g AS (SELECT h, max(page_id) AS top FROM p GROUP BY h)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         (CAST('0x' || substr(p.s, 1 + 5 * CAST(i // 4 AS INTEGER), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN g.top IS NOT NULL AND p.page_id IS DISTINCT FROM g.top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id IS DISTINCT FROM g.top THEN g.top END AS refers_to
FROM p JOIN g USING (h)
"""

OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda v: v <> '') AS ws FROM pieces),
g AS (
  SELECT lang, 1 AS k, unnest(ws) AS phrase FROM w
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS v FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT lang, phrase, a, 1 AS j, v[1] AS head, array_to_string(v[2:], ' ') AS rest FROM c
  UNION ALL
  SELECT lang, phrase, a, 2, v[1] || ' ' || v[2], v[3] FROM c WHERE k = 3),
s AS (
  SELECT cuts.lang, cuts.phrase, a, j, x.f AS l, y.f AS r,
         CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head JOIN f y ON y.lang = cuts.lang AND y.phrase = rest),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM s),
longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, v[1] || ' ' || v[2] AS phrase, a FROM c WHERE k = 3
    UNION ALL
    SELECT lang, v[2] || ' ' || v[3], a FROM c WHERE k = 3) GROUP BY lang, phrase),
kept AS (
  SELECT b.lang, b.phrase, b.a, l, r, score,
         row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank
  FROM b LEFT JOIN longer ON longer.lang = b.lang AND longer.phrase = b.phrase
  WHERE o = 1 AND (longer.a IS NULL OR 100 * longer.a < 50 * b.a))
SELECT kept.lang, rank, phrase, a, l, r, n, score FROM kept JOIN n ON n.lang = kept.lang WHERE rank <= 2000
"""

SQL: dict[str, str] = {"op9_topk": OP9_SQL, "op11_warc": OP11_SQL, "op12_phrases": OP12_SQL}
