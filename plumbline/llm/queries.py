"""Queries over the given tables, one for each operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, conversation_repair, divergence, exact_search, language_id, license_scan, mixing, ngram_join, packing, prefix_trees, suffix_dedup, toxicity, warc
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def id_remainder(n: int):
    """crc32 of the doc_id as text, modulo n; null for a null id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def unescaped(text: str) -> str:
    """SQL of a text with its character references decoded, each once; `known` maps names, and numbers read as Windows-1252."""
    cut, found = f"regexp_split_to_array({text}, '{warc.REFERENCE}')", f"regexp_extract_all({text}, '{warc.REFERENCE}')"
    digits = "regexp_replace(r[3:len(r) - 1], '^[xX]?0*', '')"
    number = f"""CASE WHEN len({digits}) > 7 THEN 0 WHEN r[3] IN ('x', 'X') THEN ('0x' || lpad({digits}, 8, '0'))::BIGINT
      ELSE coalesce(try_cast({digits} AS BIGINT), 0) END"""
    point = f"list_transform([{number}], lambda n : coalesce(known[n::VARCHAR], chr((CASE WHEN n > 0 AND n <= 1114111 AND n NOT BETWEEN 55296 AND 57343 THEN n ELSE 65533 END)::INTEGER)))[1]"
    one = f"list_transform([{found}[i]], lambda r : CASE WHEN r[2] = '#' THEN {point} ELSE coalesce(known[r[2:len(r) - 1]], r) END)[1]"
    return f"list_aggregate(list_transform(range(1, len({cut}) + 1), lambda i : {cut}[i] || coalesce({one}, '')), 'string_agg', '')"


def known_references() -> str:
    """SQL of a map of all of HTML's names."""
    pairs = {**{n: c for own in warc.NAMED.values() for n, c in own.items()}, **warc.WINDOWS}
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    return "MAP {" + ", ".join(f"{quoted(n)}: {quoted(c)}" for n, c in pairs.items()) + "}"


@query
def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


SQL["op1_warc_derivatives"] = r"""
WITH k AS (
  SELECT KNOWN AS known
), r AS (
  SELECT url, coalesce(html, '') AS html, md5(concat_ws('|', 'response', page_id, url)) AS h FROM pages
), i AS (
  SELECT url, html, '<urn:uuid:' || concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) || '>' AS refers_to,
    sha1(html) AS s FROM r
), d AS (
  SELECT *, 'sha1:' || translate(list_aggregate(list_transform(range(8), lambda k :
    to_base(('0x' || s[5 * k + 1 : 5 * k + 5])::BIGINT, 32, 4)), 'string_agg', ''),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS digest,
    md5('conversion|' || refers_to) AS c, md5('metadata|' || refers_to) AS m FROM i
), n AS (
  SELECT *, '<urn:uuid:' || concat_ws('-', c[1:8], c[9:12], c[13:16], c[17:20], c[21:32]) || '>' AS conversion_id,
    '<urn:uuid:' || concat_ws('-', m[1:8], m[9:12], m[13:16], m[17:20], m[21:32]) || '>' AS metadata_id FROM d
), t AS (
  SELECT *, regexp_replace(regexp_replace(html,
    '(?is)<!--.*?-->|<(script|style|noscript|template)\b[^>]*>.*?</(script|style|noscript|template)\s*>', '', 'g'), '\s+', ' ', 'g') AS shown,
    regexp_replace(trim(TITLE), '\s+', ' ', 'g') AS title, known FROM n, k
), b AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(SHOWN, '[ \t]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g') AS plain,
    'conversion-record: ' || conversion_id || E'\r\n' || 'source-payload-digest: ' || digest || E'\r\n'
    || 'source-payload-length: ' || strlen(html) || E'\r\n' || CASE WHEN title <> '' THEN 'title: ' || title || E'\r\n' ELSE '' END
    || E'http-header: HTTP/1.1 200 OK\r\nhttp-header: Content-Type: text/html; charset=utf-8\r\nhttp-header: Content-Length: '
    || strlen(html) || E'\r\n' || coalesce(list_aggregate(list_transform(regexp_extract_all(html,
      '(?i)<a\b[^>]*?\bhref\s*=\s*["'']([^"''>]*)["'']', 1), lambda x :
      'outlink: ' || regexp_replace(LINK, '\s+', '%20', 'g') || E' L a/@href\r\n'), 'string_agg', ''), '') AS fields
  FROM t
), o AS (
  SELECT metadata_id AS record_id, 'metadata' AS warc_type, url, refers_to, digest, 'application/warc-fields' AS content_type,
    fields AS block FROM b
  UNION ALL
  SELECT conversion_id, 'conversion', url, refers_to, digest, 'text/plain; charset=utf-8', plain FROM b
)
SELECT record_id, warc_type, url AS target_uri, '2024-01-01T00:00:00Z' AS warc_date, refers_to, digest AS source_payload_digest,
  content_type, strlen(block)::BIGINT AS content_length, 'sha1:' || translate(list_aggregate(list_transform(range(8), lambda k :
    to_base(('0x' || sha1(block)[5 * k + 1 : 5 * k + 5])::BIGINT, 32, 4)), 'string_agg', ''),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS block_digest, block
FROM o
""".replace("KNOWN", known_references()).replace("TITLE", unescaped("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")).replace("LINK", unescaped("x")).replace(
    "SHOWN", unescaped(r"""regexp_replace(regexp_replace(shown,
    '(?i)</?(address|article|aside|blockquote|br|dd|div|dl|dt|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>',
    chr(10), 'g'), '(?s)<[^>]*>', '', 'g')"""))


@query
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(table(spark, sf_dir, "documents"), k=4, percent=85)


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


SQL["op3_mixing"] = r"""
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM sizes GROUP BY source
), filled(step, source, source_size, weight, target, full_) AS (
  SELECT 0, source, source_size, weight, 1.5 * sum(source_size) OVER () * weight / sum(weight) OVER (), false FROM totals
  UNION ALL
  SELECT step + 1, source, source_size, weight,
    CASE WHEN full_ OR target >= 2 * source_size THEN 2.0 * source_size ELSE
      (1.5 * sum(source_size) OVER () - coalesce(sum(2.0 * source_size) FILTER (full_ OR target >= 2 * source_size) OVER (), 0))
      / sum(weight) FILTER (NOT (full_ OR target >= 2 * source_size)) OVER () * weight END,
    full_ OR target >= 2 * source_size
  FROM filled WHERE step < 60
), targets AS (
  SELECT source, source_size, target FROM filled WHERE step = 60
), seats AS (
  SELECT source, count(*) AS seats FROM (
    SELECT source FROM (
      SELECT source, target / (2 * k - 1) AS q, k
      FROM targets, generate_series(1, (SELECT ceil(max(source_size) * 2 / 16.0)::BIGINT + 2 FROM targets)) g(k))
    ORDER BY q DESC, source NULLS LAST, k LIMIT (SELECT round(sum(target) / 16)::BIGINT FROM targets))
  GROUP BY source
), placed AS (
  SELECT doc_id, s.source, size,
    ('0x' || substr(md5(concat_ws('|', 'mix', 'shard', doc_id, size)), 1, 8))::BIGINT
      % greatest(ceil(source_size / 262144.0), 1)::BIGINT AS shard
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source WHERE size > 0
), streams AS (
  SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY md5(concat_ws('|', 'mix', 'place', doc_id)), doc_id, size
    ROWS UNBOUNDED PRECEDING)::BIGINT AS end_ FROM placed
), shards AS (
  SELECT source, shard, max(end_) AS words FROM streams GROUP BY ALL
), quotas AS (
  SELECT source, shard, words, count(*) FILTER (r <= coalesce(seats, 0)) AS quota FROM (
    SELECT h.*, seats, row_number() OVER (PARTITION BY h.source ORDER BY words / (2 * k - 1) DESC, shard, k) AS r
    FROM shards h LEFT JOIN seats s ON h.source IS NOT DISTINCT FROM s.source,
      generate_series(1, (SELECT ceil(max(words) * 2 / 16.0)::BIGINT + 2 FROM shards)) g(k))
  GROUP BY ALL
), blocks AS (
  SELECT source, shard, block, quota // n + (r <= quota % n)::INT AS times FROM (
    SELECT source, shard, least(quota, 2 * n) AS quota, n, block,
      row_number() OVER (PARTITION BY source, shard ORDER BY md5(concat_ws('|', 'mix', 'block', shard, block)), block) AS r
    FROM (SELECT *, ceil(words / 16.0)::BIGINT AS n FROM quotas), generate_series(0, n - 1) g(block))
), taken AS (
  SELECT d.source, d.shard, d.end_, sum((least((block + 1) * 16, end_) - greatest(block * 16, end_ - size)) * times) AS taken
  FROM streams d JOIN blocks b ON d.source IS NOT DISTINCT FROM b.source AND d.shard = b.shard
    AND block * 16 < end_ AND (block + 1) * 16 > end_ - size
  GROUP BY ALL
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM (SELECT doc_id, d.source, size, taken FROM streams d LEFT JOIN taken t
        ON d.source IS NOT DISTINCT FROM t.source AND d.shard = t.shard AND d.end_ = t.end_
      UNION ALL SELECT doc_id, source, size, 0 FROM sizes WHERE size = 0) a
  JOIN targets t ON a.source IS NOT DISTINCT FROM t.source
"""


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), length=2048)


@query
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=200)


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify(table(spark, sf_dir, "documents"), labelled=id_remainder(4) != 2)
    return found.select("doc_id", F.coalesce(id_remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op7_vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_search.best_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


SQL["op9_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x : floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z : z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 5
"""


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = toxicity.score_toxicity(docs, labels, labelled=id_remainder(5) != 0)
    return found.select("doc_id", F.coalesce(id_remainder(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_digests(conversation_repair.damaged(rows), rows)


def repair_sql() -> str:
    """The same repairs by a recursion from the last row on, and a second one that follows the letters."""
    add = "{{'c': {c} + {v}.c, 'a': '{x}' || {v}.a}}".format
    keep = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    named = [2, 2, 3, 2]  # the state after a row is inserted or renamed
    late = "(symbol <> 'x' AND symbol = upper(symbol))::INT"
    best = []
    for q in range(4):
        kept = " ".join(f"WHEN lower(symbol) = '{r}' THEN {add(c=late, x='K', v=f'v{to}')}" for (at, r), to in keep.items() if at == q)
        best.append(f"list_min([{add(c=3, x='D', v=f'v{q}')}, CASE {kept} END, "
                    f"CASE WHEN symbol <> 'x' THEN {add(c='2 + ' + late, x='R', v=f'v{named[q]}')} END]) AS b{q}")
    once = [f"list_min([b{q}, {add(c=2, x='I', v=f'b{named[q]}')}]) AS i{q}" for q in range(4)]
    twice = [f"list_min([b{q}, {add(c=2, x='I', v=f'i{named[q]}')}]) AS v{q}" for q in range(4)]
    after = " ".join(f"WHEN letter = 'K' AND q = {at} AND role[1] = '{r}' THEN {to}" for (at, r), to in keep.items())
    return rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i : list_reduce(list_prepend(i, range(8)),
    lambda c, k : CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), seeded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_prepend(4294967295, list_transform(
      string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x : ascii(x)::BIGINT)),
      lambda c, b : xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 20 AS kind
  FROM conversations, crc
), r AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM seeded, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS last FROM r
), f AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM o
), s AS (
  SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'x' WHEN role[1] NOT IN ('s', 'u', 'a') THEN 'o' ELSE role[1] END AS own FROM f
), symbols AS (
  SELECT conv_id, i, CASE WHEN fault = 'truncated' THEN upper(own) ELSE own END AS symbol FROM s
), stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS n FROM s GROUP BY conv_id
), d(conv_id, i, v0, v1, v2, v3) AS (
  SELECT conv_id, n, {{'c': 0::BIGINT, 'a': ''}}, {{'c': 4::BIGINT, 'a': 'II'}}, {{'c': 2::BIGINT, 'a': 'I'}}, {{'c': 0::BIGINT, 'a': ''}} FROM stats
  UNION ALL
  SELECT conv_id, i, {', '.join(twice)} FROM (
    SELECT *, {', '.join(once)} FROM (
      SELECT d.conv_id, d.i - 1 AS i, {', '.join(best)}
      FROM d JOIN symbols ON d.conv_id IS NOT DISTINCT FROM symbols.conv_id AND d.i = symbols.i))
), a AS (
  SELECT conv_id, v0.c AS cost, v0.a AS audit FROM d WHERE i = 0
), walk(conv_id, audit, k, i, q, line) AS (
  SELECT conv_id, audit, 0, 0, 0, NULL::VARCHAR FROM a
  UNION ALL
  SELECT conv_id, audit, k, i, CASE WHEN letter = 'D' THEN q {after} WHEN q = 2 THEN 3 ELSE 2 END,
    CASE letter WHEN 'D' THEN NULL WHEN 'K' THEN role || ':' || text
      ELSE CASE WHEN q = 2 THEN 'assistant:' ELSE 'user:' END || CASE letter WHEN 'R' THEN text ELSE '' END END
  FROM (SELECT w.conv_id, audit, k + 1 AS k, w.i + (audit[k + 1] <> 'I')::INT AS i, q, audit[k + 1] AS letter FROM walk w WHERE k < len(audit)) w
    LEFT JOIN (SELECT conv_id AS id, i AS place, role, text FROM o) o ON w.conv_id IS NOT DISTINCT FROM id AND w.i = place
), repaired AS (
  SELECT conv_id, sha256(coalesce(string_agg(line, chr(10) ORDER BY k), '')) AS repaired_sha256 FROM walk GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
  LEFT JOIN stats ON c.conv_id IS NOT DISTINCT FROM stats.conv_id
  LEFT JOIN a ON c.conv_id IS NOT DISTINCT FROM a.conv_id
  LEFT JOIN repaired ON c.conv_id IS NOT DISTINCT FROM repaired.conv_id
"""


SQL["op11_conversation_repair"] = repair_sql()


@query
def op12_prefix_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trees.remove_earlier(table(spark, sf_dir, "documents"), length=20)


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


SQL["op13_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), t AS (
  SELECT r, lang, source, unnest(terms) AS term FROM d
), kept AS (
  SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3
), v AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), c AS (
  SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL
), g AS (
  SELECT lang, source, coalesce((SELECT sum(n) FROM c WHERE c.lang = e.lang AND c.source = e.source), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM d) e
), p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(n, 0) + 1) // (total + v) AS p
  FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)
), q AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (w + 1) // (total + v) AS q
  FROM (SELECT lang, term, sum(n) AS w FROM c GROUP BY ALL) JOIN (SELECT lang, sum(total) AS total FROM g GROUP BY lang) USING (lang)
    JOIN v USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), o AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM o)
WHERE part = 'pair' OR rank <= 200
"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
