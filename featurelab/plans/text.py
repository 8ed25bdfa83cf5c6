"""Text queries: batch requests and responses, extraction, chunking,
retrieval, summaries (P16-P24, K7-K12, S6, A7, J8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.functions.columns import round4
from featurelab.operators import text as X
from featurelab.operators.aggregate import category_counts
from featurelab.operators.validate import enum_or_other
from featurelab.plans.registry import query
from featurelab.session import spread
from featurelab.sources.tables import Tables

# Triage categories of the batch job (fixed values)
CATEGORIES = ["billing", "account", "bug", "sales", "auth"]
SYSTEM_TEMPLATE = "Classify the message into one of: %s. Answer with one lowercase word."


# ---------------------------------------------------------------- P17 P18 IO7


def build_requests(docs: DataFrame, id_col: str, text_col: str, temperature: float = 0.0) -> DataFrame:
    """One nested batch request per row, the ticket id carried in labels so
    that predictions can be joined back (P17, P18).  ``to_json`` keeps the
    whole text; the result is ready for ``write.text`` as JSON Lines (IO7)."""
    system = F.format_string(SYSTEM_TEMPLATE, F.lit(", ".join(CATEGORIES)))
    req = F.struct(F.struct(
        F.array(F.struct(F.lit("user").alias("role"),
                         F.array(F.struct(F.col(text_col).alias("text"))).alias("parts"))).alias("contents"),
        F.struct(F.array(F.struct(system.alias("text"))).alias("parts")).alias("systemInstruction"),
        F.struct(F.lit(temperature).alias("temperature")).alias("generationConfig"),
        F.struct(F.col(id_col).cast("string").alias("ticket_id")).alias("labels"),
    ).alias("request"))
    return docs.select(F.col(id_col).cast("string").alias("ticket_id"), F.to_json(req).alias("line"))


@query("prompt_requests", "P17 P18 IO7", sql="""
WITH r AS (
  SELECT CAST(doc_id AS VARCHAR) AS ticket_id,
         json_object('request', json_object(
            'contents', json_array(json_object('role', 'user', 'parts', json_array(json_object('text', text)))),
            'systemInstruction', json_object('parts', json_array(json_object('text',
                'Classify the message into one of: billing, account, bug, sales, auth. Answer with one lowercase word.'))),
            'generationConfig', json_object('temperature', 0.0),
            'labels', json_object('ticket_id', CAST(doc_id AS VARCHAR)))) AS line
  FROM documents)
SELECT ticket_id,
       json_extract_string(line, '$.request.contents[0].role') AS role,
       md5(json_extract_string(line, '$.request.contents[0].parts[0].text')) AS message_md5,
       length(json_extract_string(line, '$.request.systemInstruction.parts[0].text')) AS system_chars,
       CAST(json_extract(line, '$.request.generationConfig.temperature') AS DOUBLE) AS temperature,
       json_extract_string(line, '$.request.labels.ticket_id') = ticket_id AS label_roundtrip
FROM r
""")
def prompt_requests(spark: SparkSession, d: str) -> DataFrame:
    req = build_requests(spread(Tables(spark, d).documents), "doc_id", "text")
    g = lambda p: F.get_json_object("line", p)
    return req.select(
        "ticket_id", g("$.request.contents[0].role").alias("role"),
        F.md5(g("$.request.contents[0].parts[0].text")).alias("message_md5"),
        F.length(g("$.request.systemInstruction.parts[0].text")).cast("bigint").alias("system_chars"),
        g("$.request.generationConfig.temperature").cast("double").alias("temperature"),
        (g("$.request.labels.ticket_id") == F.col("ticket_id")).alias("label_roundtrip"))


# ---------------------------------------------------------------- P19 P20 S6 A7 J8

# Reply text the mock batch job gives per event type (fixed rule)
REPLIES = {"view": " Billing ", "click": "account", "error": "BUG.", "purchase": "sales", "signup": "auth"}


def mock_responses(events: DataFrame) -> DataFrame:
    """Response lines of a batch job, derived from events: some replies come
    as fenced JSON, some have no candidates, some lost their labels, and
    requests with id % 7 == 0 were never answered."""
    reply = F.coalesce(F.create_map(*[x for k, v in REPLIES.items() for x in (F.lit(k), F.lit(v))])
                       [F.col("event_type")], F.lit("other"))
    text = F.when(F.pmod("event_id", F.lit(3)) == 0,
                  F.concat(F.lit('```json\n{"category": "'), F.trim(reply), F.lit('"}\n```'))).otherwise(reply)
    cand = F.when(F.pmod("event_id", F.lit(10)) == 0, F.array().cast(
        "array<struct<content:struct<parts:array<struct<text:string>>>>>")).otherwise(
        F.array(F.struct(F.struct(F.array(F.struct(text.alias("text"))).alias("parts")).alias("content"))))
    labels = F.when(F.pmod("event_id", F.lit(13)) == 0, F.lit(None)).otherwise(
        F.struct(F.col("event_id").cast("string").alias("ticket_id")))
    rec = F.struct(F.struct(cand.alias("candidates")).alias("response"),
                   F.struct(labels.alias("labels")).alias("request"))
    return events.where(F.pmod("event_id", F.lit(7)) != 0).select(F.to_json(rec).alias("line"))


RESPONSE_SCHEMA = ("response struct<candidates: array<struct<content: struct<parts: "
                   "array<struct<text: string>>>>>>, request struct<labels: struct<ticket_id: string>>")


def parse_responses_df(lines: DataFrame, categories=None) -> DataFrame:
    """(ticket_id, category) per response line.

    ``get(array, 0)`` is NULL on an empty array (``arr[0]`` raises under
    ANSI); missing pieces default to "" / "UNKNOWN" as the reference does.
    """
    r = lines.select(F.from_json("line", RESPONSE_SCHEMA).alias("r"))
    first = F.get(F.col("r.response.candidates"), 0)
    text = F.coalesce(F.get(first["content"]["parts"], 0)["text"], F.lit(""))
    raw = F.lower(F.trim(text))
    obj = X.json_object_text(raw)
    parsed = F.when(obj != "", F.get_json_object(obj, "$.category")).otherwise(raw)
    ticket = F.coalesce(F.col("r.request.labels.ticket_id"), F.lit("UNKNOWN"))
    return r.select(ticket.alias("ticket_id"),
                    enum_or_other(F.coalesce(parsed, F.lit("")), categories or CATEGORIES).alias("category"))


RESP_CTE = """
WITH e AS (SELECT event_id, event_type,
                  CASE event_type WHEN 'view' THEN ' Billing ' WHEN 'click' THEN 'account' WHEN 'error' THEN 'BUG.'
                                  WHEN 'purchase' THEN 'sales' WHEN 'signup' THEN 'auth' ELSE 'other' END AS reply
           FROM events WHERE event_id % 7 <> 0),
p AS (SELECT event_id,
             CASE WHEN event_id % 10 = 0 THEN ''
                  WHEN event_id % 3 = 0 THEN json_extract_string(
                       '{"category": "' || lower(trim(reply)) || '"}', '$.category')
                  ELSE lower(trim(reply)) END AS raw,
             CASE WHEN event_id % 13 = 0 THEN 'UNKNOWN' ELSE CAST(event_id AS VARCHAR) END AS ticket_id
      FROM e),
c AS (SELECT ticket_id, CASE WHEN raw IN ('billing', 'account', 'bug', 'sales', 'auth') THEN raw ELSE 'other' END AS category
      FROM p)
"""


@query("parse_responses", "P19 P20 S6 A7", sql=RESP_CTE + """
, cats AS (SELECT * FROM (VALUES ('billing', 0), ('account', 1), ('bug', 2), ('sales', 3), ('auth', 4), ('other', 5))
           v(category, position))
SELECT cats.category, CAST(cats.position AS INTEGER) AS position, count(c.category) AS n
FROM cats LEFT JOIN c ON c.category = cats.category GROUP BY cats.category, cats.position
""")
def parse_responses(spark: SparkSession, d: str) -> DataFrame:
    parsed = parse_responses_df(mock_responses(Tables(spark, d).events))
    return category_counts(parsed, "category", CATEGORIES)


@query("response_correlation", "J8", sql=RESP_CTE + """
SELECT CAST(event_id AS VARCHAR) AS ticket_id, event_type, coalesce(c.category, 'unanswered') AS category
FROM events LEFT JOIN c ON CAST(events.event_id AS VARCHAR) = c.ticket_id
""")
def response_correlation(spark: SparkSession, d: str) -> DataFrame:
    """Predictions joined back to their source rows by the round-tripped id, in
    one left join; requests without an answer are marked."""
    ev = Tables(spark, d).events
    parsed = parse_responses_df(mock_responses(ev)).where(F.col("ticket_id") != "UNKNOWN")
    src = ev.select(F.col("event_id").cast("string").alias("ticket_id"), "event_type")
    return src.join(parsed, "ticket_id", "left").withColumn("category", F.coalesce("category", F.lit("unanswered")))


# ---------------------------------------------------------------- P21 P16 P24


@query("field_extraction", "P21 P16 P24", sql="""
WITH p AS (SELECT page_id, url, html,
                  trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS body
           FROM pages)
SELECT page_id,
       regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host,
       regexp_extract(html, '<html[^>]*lang="([^"]*)"', 1) AS lang,
       regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
       CAST(len(regexp_extract_all(html, '<a\\s[^>]*href=')) AS INTEGER) AS n_links,
       CASE WHEN length(body) <= 80 THEN body ELSE substr(body, 1, 79) || '...' END AS preview,
       CAST(CASE WHEN body = '' THEN 0 ELSE len(string_split(body, ' ')) END AS INTEGER) AS n_words
FROM p
""")
def field_extraction(spark: SparkSession, d: str) -> DataFrame:
    p = spread(Tables(spark, d).pages)
    body = X.strip_tags(F.col("html"))
    return p.select(
        "page_id",
        F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1).alias("host"),
        F.regexp_extract("html", r'<html[^>]*lang="([^"]*)"', 1).alias("lang"),
        F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"),
        F.size(F.regexp_extract_all("html", F.lit(r"<a\s[^>]*href="), F.lit(0))).alias("n_links"),
        X.short_text(body, 80).alias("preview"),
        X.word_count(body).cast("int").alias("n_words"))


LINK_RE = r'<a\s[^>]*href="([^"]*)"[^>]*>([^<]*)</a>'


@query("page_items", "P21 P22", sql=f"""
WITH p AS (SELECT page_id, regexp_extract_all(html, '{LINK_RE}', 1) AS h, regexp_extract_all(html, '{LINK_RE}', 2) AS t FROM pages),
z AS (SELECT page_id, list_zip(h, list_transform(t, lambda x: trim(x))) AS items FROM p)
SELECT page_id, CAST(len(items) AS INTEGER) AS n_items,
       CAST(len(list_filter(items, lambda i: starts_with(i[1], '/'))) AS INTEGER) AS n_local,
       items[1][2] AS first_label,
       md5(array_to_string(list_transform(items, lambda i: i[1] || '=' || i[2]), ';')) AS items_md5
FROM z
""")
def page_items(spark: SparkSession, d: str) -> DataFrame:
    """An array of items taken out of running text: every link of a page as a
    struct of target and label."""
    items = X.items_of(F.col("html"), LINK_RE, ["href", "label"])
    p = spread(Tables(spark, d).pages).select("page_id", F.transform(
        items, lambda i: F.struct(i["href"].alias("href"), F.trim(i["label"]).alias("label"))).alias("items"))
    return p.select("page_id", F.size("items").alias("n_items"),
                    F.size(F.filter("items", lambda i: i["href"].startswith("/"))).alias("n_local"),
                    F.get("items", 0)["label"].alias("first_label"),
                    F.md5(F.array_join(F.transform("items", lambda i: F.concat_ws("=", i["href"], i["label"])), ";")).alias("items_md5"))


# ---------------------------------------------------------------- K7


@query("chunk_documents", "K7", sql="""
WITH t AS (SELECT doc_id, CASE WHEN trim(regexp_replace(text, '\\s+', ' ', 'g')) = '' THEN []::VARCHAR[]
                               ELSE string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ') END AS tok
           FROM documents),
s AS (SELECT doc_id, tok, unnest(range(0, CASE WHEN len(tok) = 0 THEN 0
                                                ELSE CAST((greatest(0, ceil((len(tok) - 512) / 412)) + 1) * 412 AS BIGINT) END, 412)) AS start
      FROM t)
SELECT doc_id, CAST(start // 412 AS INTEGER) AS chunk_id, CAST(start AS INTEGER) AS start,
       CAST(len(tok[start + 1:start + 512]) AS INTEGER) AS n_tokens,
       md5(array_to_string(tok[start + 1:start + 512], ' ')) AS chunk_md5
FROM s
""")
def chunk_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(Tables(spark, d).documents)
    ch = X.chunk_rows(docs, ["doc_id"], F.col("text"))
    return ch.select("doc_id", F.col("chunk_id").cast("int").alias("chunk_id"),
                     F.col("start").cast("int").alias("start"),
                     F.size("tokens").cast("int").alias("n_tokens"),
                     F.md5(F.array_join("tokens", " ")).alias("chunk_md5"))


# ---------------------------------------------------------------- K9 K10

EMB_CTE = """
WITH e AS (SELECT label, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM embeddings),
c AS (SELECT label, list(m ORDER BY i) AS centroid FROM (SELECT label, i, avg(v) AS m FROM e GROUP BY label, i)
      GROUP BY label),
s AS (SELECT CAST(c.label AS VARCHAR) AS query, x.vec_id,
             list_cosine_similarity(c.centroid, CAST(x.embedding AS DOUBLE[])) AS score
      FROM c, embeddings x),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS rnk FROM s
      WHERE score IS NOT NULL)
"""


def _centroid_topk(spark: SparkSession, d: str) -> DataFrame:
    from featurelab.operators.retrieval import centroids, top_k_similar
    emb = Tables(spark, d).embeddings
    q = centroids(emb, "label", "embedding").select(F.col("label").cast("string").alias("query"),
                                                    "embedding")
    return top_k_similar(emb, "vec_id", "embedding", q, "query", "embedding", k=5)


@query("topk_similar", "K9", sql=EMB_CTE + """
SELECT query, CAST(rnk AS INTEGER) AS rank, vec_id, round(score, 4) AS score FROM r WHERE rnk <= 5
""")
def topk_similar(spark: SparkSession, d: str) -> DataFrame:
    t = _centroid_topk(spark, d)
    return t.select("query", "rank", "vec_id", round4("score").alias("score"))


@query("retrieval_citations", "K10", sql=EMB_CTE + """
SELECT query, CAST(count(*) AS INTEGER) AS n_hits,
       string_agg('[' || CAST(rnk AS VARCHAR) || '] ' || CAST(vec_id AS VARCHAR), ' ' ORDER BY rnk) AS citations
FROM r WHERE rnk <= 5 GROUP BY query
""")
def retrieval_citations(spark: SparkSession, d: str) -> DataFrame:
    from featurelab.operators.retrieval import citations
    return citations(_centroid_topk(spark, d), "query", "vec_id")


# ---------------------------------------------------------------- K8, and K7 to K10 in a row

TOKENS_SQL = r"""CASE WHEN trim(regexp_replace(lower(text), '\s+', ' ', 'g')) = '' THEN []::VARCHAR[]
                      ELSE string_split(trim(regexp_replace(lower(text), '\s+', ' ', 'g')), ' ') END"""
EMBED_CTE = f"""
WITH t AS (SELECT doc_id, {TOKENS_SQL} AS tok FROM documents),
s AS (SELECT doc_id, tok, unnest(range(0, CASE WHEN len(tok) = 0 THEN 0
                                               ELSE CAST((greatest(0, ceil((len(tok) - 512) / 412)) + 1) * 412 AS BIGINT) END, 412)) AS start
      FROM t),
ch AS (SELECT doc_id, CAST(start // 412 AS INTEGER) AS chunk_id, tok[start + 1:start + 512] AS tok FROM s),
occ AS (SELECT doc_id, chunk_id, unnest(tok) AS w FROM ch),
tf AS (SELECT doc_id, chunk_id, ('0x' || substr(md5(w), 1, 8))::BIGINT % 16384 AS b, count(*) AS tf FROM occ GROUP BY ALL),
n AS (SELECT count(*) AS n FROM ch),
df AS (SELECT b, count(*) AS df FROM tf GROUP BY b),
idf AS (SELECT r.b, CAST(round(1000.0 * ln((n.n + 1.0) / (coalesce(df.df, 0) + 1.0))) AS BIGINT) AS w
        FROM (SELECT unnest(range(0, 16384)) AS b) r LEFT JOIN df ON df.b = r.b, n),
emb AS (SELECT doc_id, chunk_id, tf.b, tf.tf * idf.w AS v FROM tf JOIN idf ON idf.b = tf.b),
norm AS (SELECT doc_id, chunk_id, count(*) AS n_terms, CAST(sum(v * v) AS BIGINT) AS norm2,
                md5(string_agg(b || ':' || v, ',' ORDER BY b)) AS vec_md5 FROM emb GROUP BY doc_id, chunk_id)
"""
RAG_CTE = EMBED_CTE + f""",
q0 AS (SELECT item_id, unnest({TOKENS_SQL}) AS w FROM benchmark),
q1 AS (SELECT item_id, ('0x' || substr(md5(w), 1, 8))::BIGINT % 16384 AS b, count(*) AS tf FROM q0 GROUP BY ALL),
q AS (SELECT item_id, q1.b, q1.tf * idf.w AS v FROM q1 JOIN idf ON idf.b = q1.b),
qn AS (SELECT item_id, CAST(sum(v * v) AS BIGINT) AS norm2 FROM q GROUP BY item_id),
dots AS (SELECT item_id, doc_id, chunk_id, CAST(sum(q.v * emb.v) AS BIGINT) AS dot FROM q JOIN emb ON emb.b = q.b
         GROUP BY item_id, doc_id, chunk_id HAVING sum(q.v * emb.v) > 0),
sc AS (SELECT dots.item_id, dots.doc_id || '#' || dots.chunk_id AS chunk, dot,
              dot / (sqrt(CAST(qn.norm2 AS DOUBLE)) * sqrt(CAST(norm.norm2 AS DOUBLE))) AS score
       FROM dots JOIN qn ON qn.item_id = dots.item_id JOIN norm ON norm.doc_id = dots.doc_id AND norm.chunk_id = dots.chunk_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, chunk) AS INTEGER) AS rank FROM sc)
"""


def _embedded(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(chunks, questions) as sparse vectors under the chunks' weights: the
    documents in chunks, the benchmark items as questions (K7, K8)."""
    from featurelab.operators import embed
    from featurelab.session import materialize
    t = Tables(spark, d)
    chunks = X.chunk_rows(spread(t.documents), ["doc_id"], F.lower("text")).select(
        "doc_id", F.col("chunk_id").cast("int").alias("chunk_id"), "tokens")
    counts = materialize(embed.term_counts(chunks, "tokens", ["doc_id", "chunk_id"]))
    idf = embed.idf_weights(counts)
    questions = embed.term_counts(t.benchmark.select("item_id", X.tokens(F.lower("text")).alias("tokens")), "tokens", ["item_id"])
    return embed.weighted(counts, idf), embed.weighted(questions, idf)


@query("tfidf_embed", "K8", sql=EMBED_CTE + "SELECT doc_id, chunk_id, n_terms, norm2, vec_md5 FROM norm")
def tfidf_embed(spark: SparkSession, d: str) -> DataFrame:
    """Every chunk's sparse vector, by its number of buckets, norm and digest."""
    chunks, _ = _embedded(spark, d)
    pairs = F.zip_with("idx", "w", lambda i, w: F.concat_ws(":", i.cast("string"), w.cast("string")))
    return chunks.select("doc_id", "chunk_id", F.size("idx").cast("long").alias("n_terms"), "norm2",
                         F.md5(F.array_join(pairs, ",")).alias("vec_md5"))


def _rag_hits(spark: SparkSession, d: str) -> DataFrame:
    from featurelab.operators import embed
    chunks, questions = _embedded(spark, d)
    chunks = chunks.withColumn("chunk", F.concat_ws("#", "doc_id", "chunk_id"))
    return embed.sparse_top_k(chunks, "chunk", questions, "item_id", k=5)


@query("chunk_topk", "K7 K8 K9", sql=RAG_CTE + "SELECT item_id, rank, chunk, dot, round(score, 4) AS score FROM r WHERE rank <= 5")
def chunk_topk(spark: SparkSession, d: str) -> DataFrame:
    """The five chunks of all documents that are nearest to each question."""
    return _rag_hits(spark, d).select("item_id", "rank", "chunk", "dot", round4("score").alias("score"))


@query("rag_citations", "K7 K8 K9 K10", sql=RAG_CTE + """
SELECT item_id, CAST(count(*) AS INTEGER) AS n_hits,
       string_agg('[' || rank || '] ' || chunk, ' ' ORDER BY rank) AS citations FROM r WHERE rank <= 5 GROUP BY item_id
""")
def rag_citations(spark: SparkSession, d: str) -> DataFrame:
    """Chunk, embed, search, cite: the whole chain for each question."""
    from featurelab.operators.retrieval import citations
    return citations(_rag_hits(spark, d), "item_id", "chunk")


# ---------------------------------------------------------------- K11


@query("lead_summary", "K11 P24", sql="""
WITH a AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[^.!?]+[.!?]*'), lambda x: trim(x)),
                                      lambda x: x <> '')[1:5] AS sents FROM documents),
b AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(array_to_string(sents, ' '), ''), '[ \\t\\n\\r\\f]+'),
                                 lambda x: x <> '') AS ws FROM a)
SELECT doc_id, coalesce(array_to_string(ws[1:50], ' '), '') AS summary, CAST(least(len(ws), 50) AS INTEGER) AS n_words,
       len(ws) > 50 AS was_cut FROM b
""")
def lead_summary(spark: SparkSession, d: str) -> DataFrame:
    from featurelab.operators.retrieval import lead_summary as lead
    return lead(spread(Tables(spark, d).documents.select("doc_id", "text")), "doc_id", "text")


@query("extractive_summary", "K11", sql="""
WITH s AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^.!?]+[.!?]*')) AS s0,
                  unnest(range(len(regexp_extract_all(text, '[^.!?]+[.!?]*')))) AS pos FROM documents),
s2 AS (SELECT doc_id, pos, trim(s0) AS s FROM s WHERE trim(s0) <> ''),
w AS (SELECT doc_id, pos, unnest(regexp_extract_all(lower(s), '\\p{L}+')) AS w FROM s2),
tf AS (SELECT doc_id, w, count(*) AS tf FROM w GROUP BY doc_id, w),
sc AS (SELECT w.doc_id, w.pos, avg(tf.tf) AS score FROM w JOIN tf ON w.doc_id = tf.doc_id AND w.w = tf.w
       GROUP BY w.doc_id, w.pos),
r AS (SELECT s2.doc_id, s2.pos, s2.s,
             row_number() OVER (PARTITION BY s2.doc_id ORDER BY sc.score DESC, s2.pos) AS rn
      FROM s2 JOIN sc ON s2.doc_id = sc.doc_id AND s2.pos = sc.pos),
ns AS (SELECT doc_id, count(*) AS n_sentences FROM s2 GROUP BY doc_id),
su AS (SELECT doc_id, string_agg(s, ' ' ORDER BY pos) AS summary FROM r WHERE rn <= 3 GROUP BY doc_id)
SELECT ns.doc_id, ns.n_sentences, su.summary FROM ns LEFT JOIN su ON ns.doc_id = su.doc_id
""")
def extractive_summary(spark: SparkSession, d: str) -> DataFrame:
    from featurelab.operators.retrieval import extractive_summary as summarize
    return summarize(spread(Tables(spark, d).documents), "doc_id", "text", 3)
