"""Every operator as a query over its whole table, and the SQL that some of them must agree with."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import contamination
from tidemark.llm.exact_dedup import dedup
from tidemark.llm.frames import KEY
from tidemark.llm.infill import infill, restored
from tidemark.llm.lexical import search
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.lm_score import score, targets
from tidemark.llm.near_join import near_groups
from tidemark.llm.packing import pack
from tidemark.llm.passages import near_passages
from tidemark.llm.quality import quality
from tidemark.llm.sketches import fingerprints
from tidemark.llm.toxicity import toxicity
from tidemark.llm.warc import round_trip

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the folder. Python workers started elsewhere are told where this library is."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.read.parquet(f"{root}/{name}.parquet")


def op1_packing(spark: SparkSession, root: str) -> DataFrame:
    return pack(table(spark, root, "documents")).drop(*KEY)


def op2_exact_dedup(spark: SparkSession, root: str) -> DataFrame:
    return dedup(table(spark, root, "documents")).drop(*KEY)


def op3_jaccard_join(spark: SparkSession, root: str) -> DataFrame:
    return near_groups(table(spark, root, "documents")).drop(*KEY, "group")


def op4_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    """A digest stands for what is left of a text."""
    found = dedup_lines(table(spark, root, "documents"))
    return found.select("doc_id", "n_lines", "n_deleted", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op5_decontaminate(spark: SparkSession, root: str) -> DataFrame:
    return contamination(table(spark, root, "documents"), table(spark, root, "benchmark")).drop(*KEY)


def op6_passages(spark: SparkSession, root: str) -> DataFrame:
    return near_passages(table(spark, root, "documents"))


def op7_quality(spark: SparkSession, root: str) -> DataFrame:
    return quality(table(spark, root, "documents"), table(spark, root, "labels")).drop(*KEY)


def op8_lm_score(spark: SparkSession, root: str) -> DataFrame:
    return score(targets(table(spark, root, "documents"), table(spark, root, "labels"))).drop(*KEY)


def op9_toxicity(spark: SparkSession, root: str) -> DataFrame:
    return toxicity(table(spark, root, "documents"), table(spark, root, "labels")).drop(*KEY)


def op10_warc(spark: SparkSession, root: str) -> DataFrame:
    return round_trip(table(spark, root, "pages")).drop("payload")


def op11_lexical_search(spark: SparkSession, root: str) -> DataFrame:
    return search(table(spark, root, "documents"), table(spark, root, "benchmark")).select("item_id", "rank", "doc_id", "score")


def op12_sketch(spark: SparkSession, root: str) -> DataFrame:
    """Fingerprints as text: 12 hex digits for each hash."""
    found = fingerprints(table(spark, root, "documents")).drop(*KEY)
    return found.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def op13_infill(spark: SparkSession, root: str) -> DataFrame:
    """Digests stand for the output and for the text that was rebuilt from it."""
    found = infill(table(spark, root, "documents"))
    digests = {"output_sha256": F.col("output"), "restored_sha256": restored(F.col("output"), F.col("form"))}
    return found.withColumns({name: F.sha2(text, 256) for name, text in digests.items()}).drop("output")


QUERIES = {
    f.__name__: f
    for f in (
        op1_packing, op2_exact_dedup, op3_jaccard_join, op4_line_dedup, op5_decontaminate, op6_passages, op7_quality, op8_lm_score,
        op9_toxicity, op10_warc, op11_lexical_search, op12_sketch, op13_infill,
    )
}

#: Words as lists, from the text in a column; the class of word characters is the argument.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{}')"

ORACLES = {
    "op1_packing": r"""
WITH RECURSIVE d AS (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n FROM documents),
p AS (
  SELECT doc_id, n, unnest(CASE WHEN n > 0 THEN range((n + 2047) // 2048) ELSE [NULL] END) AS piece FROM d),
q AS (SELECT doc_id, piece, coalesce(piece * 2048, 0) AS start, least(n - coalesce(piece * 2048, 0), 2048) AS n_tokens FROM p),
h AS (SELECT n_tokens AS len, count(*) AS c, row_number() OVER (ORDER BY n_tokens) AS i FROM q WHERE piece IS NOT NULL GROUP BY n_tokens),
s AS (SELECT i, len, sum(c) OVER (ORDER BY i)::BIGINT AS r, sum(c * len) OVER (ORDER BY i)::BIGINT AS f FROM h UNION ALL SELECT 0, 0, 0, 0),
c AS (SELECT a.i, b.i AS j, b.len * (b.r - a.r) - (b.f - a.f) AS cost FROM s a JOIN s b ON a.i < b.i),
best AS (
  SELECT 1 AS k, j, cost, i FROM c WHERE i = 0
  UNION ALL
  SELECT k + 1, j, m.cost, m.i FROM (
    SELECT k, c.j, min({'cost': best.cost + c.cost, 'i': c.i}) AS m FROM best JOIN c ON c.i = best.j WHERE k < 8 GROUP BY k, c.j)),
trace AS (
  SELECT (SELECT least(8, count(*)) FROM h) AS k, (SELECT max(i) FROM h) AS j
  UNION ALL
  SELECT trace.k - 1, best.i FROM trace JOIN best ON best.k = trace.k AND best.j = trace.j WHERE trace.k > 1),
ends AS (SELECT len::BIGINT AS bucket FROM trace JOIN s ON s.i = trace.j),
w AS (SELECT q.*, CASE WHEN piece IS NOT NULL THEN (SELECT min(bucket) FROM ends WHERE bucket >= n_tokens) END AS bucket FROM q),
x AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY n_tokens, doc_id NULLS LAST, piece) - 1 AS pos, greatest(1, 65536 // bucket) AS room FROM w)
SELECT doc_id, piece, start, n_tokens, bucket, CASE WHEN bucket IS NOT NULL THEN pos // room END AS batch, CASE WHEN bucket IS NOT NULL THEN pos % room END AS slot
FROM x""",
    "op2_exact_dedup": r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST)""",
    "op10_warc": """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS best FROM pages),
d AS (
  SELECT *, page_id > best AS again, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0],
    lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(sha1(h), i * 5 + 1, 5))::INT >> b) % 32 + 1, 1)), '')), '') AS payload_digest
  FROM p)
SELECT page_id, url, strlen(h) AS payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN best END AS refers_to
FROM d""",
    "op3_jaccard_join": rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(r"[^\x20\x09-\x0D]+")} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda p: array_to_string(w[p:p + 4], ' '))) AS g
  FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT a, b FROM edges UNION SELECT reached.a, edges.b FROM reached JOIN edges ON reached.b = edges.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, (SELECT min(b) FROM reached WHERE a = doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id)""",
    "op5_decontaminate": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")} AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")} AS w FROM benchmark),
wanted AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
         unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda p: array_to_string(w[p:p + 12], ' '))) AS g
  FROM i WHERE len(w) > 0),
runs AS (
  SELECT r, n, unnest(range(1, len(w) - n + 2)) AS p, unnest(list_transform(range(1, len(w) - n + 2), lambda p: array_to_string(w[p:p + n - 1], ' '))) AS g
  FROM d, (SELECT DISTINCT n FROM wanted) WHERE len(w) >= n),
hits AS (SELECT r, p, runs.n, item_id FROM runs JOIN wanted USING (n, g)),
places AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)""",
    "op11_lexical_search": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")} AS t FROM documents),
c AS (SELECT count(*) AS docs, sum(len(t))::BIGINT AS terms FROM d WHERE len(t) > 0),
q AS (
  SELECT k, item_id, unnest(list_distinct(t)) AS term
  FROM (SELECT row_number() OVER () AS k, item_id, {_WORDS.format(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")} AS t FROM benchmark)),
p AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM d)
  SEMI JOIN (SELECT DISTINCT term FROM q) USING (term) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY term, docs),
s AS (
  SELECT k, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term), c GROUP BY ALL),
x AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM x WHERE rank <= 10""",
    "op13_infill": r"""
WITH d AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
c AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS c2,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT *, array_to_string(u[1:least(c1, c2)], '') AS a, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS b,
         array_to_string(u[greatest(c1, c2) + 1:], '') AS e
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || e || '<M>' || b
              ELSE '<S>' || e || '<P>' || a || '<M>' || b END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p""",
}
