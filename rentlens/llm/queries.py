"""Named queries ``opN_<name>``: each operator with its production parameters over its whole table, and its check SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.llm import bagminhash, bpe, chat_format, exact_dedup, imatch, kmeans_tree, langid, license_scan, line_dedup, mixing, pair_maxscore, token_alignment, url_filter
from rentlens.llm.common import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

URL_RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]
SOURCE_WEIGHTS = (5, 2, 1)


def query(sql: str | None = None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        @functools.wraps(fn)
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = call
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return call

    return wrap


def hex_of(binary: str) -> F.Column:
    return F.lower(F.hex(F.col(binary)))


@query(r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
  l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
  k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
  f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
  m AS (SELECT k.*, f.key IS NULL OR doc_id = keeper AS stays FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN stays THEN 0 ELSE 1 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE stays), '')) AS kept_sha256
FROM m GROUP BY doc_id
""")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query(r"""
WITH t AS (SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS n FROM conversations),
  r AS (SELECT t.*, CAST((n - 1) // 256 AS BIGINT) AS part, speaker, role = speaker AS own, CASE WHEN role = speaker THEN '<|assistant|>' ELSE '<|user:' || role || '|>' END || chr(10) AS head,
      text || '<|end|>' || chr(10) AS body FROM t JOIN (SELECT DISTINCT conv_id AS c, role AS speaker FROM t) ON conv_id IS NOT DISTINCT FROM c),
  s AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker, part ORDER BY n) AS upto FROM r)
SELECT conv_id, speaker, part, count(*) AS n_turns, string_agg(head || body, '' ORDER BY n) AS text,
  coalesce(string_agg(CAST(upto - length(body) AS BIGINT) || '-' || CAST(upto AS BIGINT), ',' ORDER BY n) FILTER (own), '') AS mask,
  CAST(coalesce(sum(length(body)) FILTER (own), 0) AS BIGINT) AS n_masked
FROM s GROUP BY conv_id, speaker, part
""")
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.rotate_perspectives(table(spark, sf_dir, "conversations"))


@query()
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.round_trip(docs, path)
    return done.select("doc_id", bpe.token_count().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query()
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bagminhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "class_size", "kept")


@query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train_model(docs.filter(~langid.held_out()))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query(r"""
WITH s AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
  src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM s GROUP BY source),
  w AS (SELECT *, CAST([5, 2, 1][(place - 1) % 3 + 1] AS DOUBLE) AS w FROM src),
  r AS (SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / w, place) AS k, sum(source_size) OVER () AS total,
      coalesce(sum(3 * source_size) OVER (ORDER BY 3.0 * source_size / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
      sum(w) OVER (ORDER BY 3.0 * source_size / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM w),
  l AS (SELECT CAST(total - held AS DOUBLE) / open AS level FROM r WHERE w * (CAST(total - held AS DOUBLE) / open) <= 3 * source_size ORDER BY k LIMIT 1),
  t AS (SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), w * level) AS target,
      CAST(('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM r, l),
  d AS (SELECT doc_id, size, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS step,
      row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id NULLS LAST) AS n FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source),
  c AS (SELECT *, CAST(least(floor(n * step + u) - floor((n - 1) * step + u), 3) AS BIGINT) AS copies FROM d)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c
""")
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), SOURCE_WEIGHTS)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


_TEMPLATES = ", ".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(license_scan.templates()))
_MARKS = license_scan.MARKS.replace("'", "''")
_PARAGRAPH_END = license_scan.PARAGRAPH_END.replace("'", "''")


@query(rf"""
WITH f AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '-') || '/' || coalesce(CAST(doc_id // 1000 AS VARCHAR), '-') || '/' || coalesce(CAST(doc_id // 20 AS VARCHAR), '-') || '/' || coalesce(CAST(doc_id AS VARCHAR), '-') AS path FROM documents),
  b AS (SELECT path, text, regexp_extract(text, '^\x{{FEFF}}?[\x20\x09-\x0D]*(?:#![^\n]*\n)?{_MARKS}*', 0) AS before FROM f),
  p AS (SELECT path, 's' AS kind, string_split_regex(text, '{license_scan.STATEMENT_END}') AS ps, len(string_split_regex(before, '{license_scan.STATEMENT_END}')) AS place FROM b
    UNION ALL SELECT path, 'p', string_split_regex(text, '{_PARAGRAPH_END}'), len(string_split_regex(before, '{_PARAGRAPH_END}')) FROM b
    UNION ALL SELECT path, 'w', [text], 0 FROM b),
  q AS (SELECT path, kind, place, unnest(range(1, len(ps) + 1)) AS n, unnest(ps) AS piece FROM p),
  s AS (SELECT path, kind || n AS pos, n = place AS head, regexp_extract_all(lower(piece), '{license_scan.TERM}') AS terms FROM q),
  t AS (SELECT * FROM (VALUES {_TEMPLATES}) AS v(template, license, text)),
  tf AS (SELECT template, license, term, count(*) AS tf FROM (SELECT template, license, unnest(regexp_extract_all(lower(text), '{license_scan.TERM}')) AS term FROM t) GROUP BY ALL),
  n AS (SELECT ln(CAST(1 + count(*) AS DOUBLE)) AS unseen FROM t),
  i AS (SELECT term, unseen - ln(CAST(1 + count(*) AS DOUBLE)) AS idf FROM tf, n GROUP BY term, unseen),
  w AS (SELECT template, license, tf.term AS term, (1 + ln(CAST(tf AS DOUBLE))) * idf AS w FROM tf JOIN i ON i.term = tf.term),
  u AS (SELECT template, license, term, w / sqrt(sum(w * w) OVER (PARTITION BY template)) AS unit FROM w),
  c AS (SELECT path, pos, head, term, count(*) AS tf FROM (SELECT path, pos, head, unnest(terms) AS term FROM s) GROUP BY ALL),
  x AS (SELECT c.*, (1 + ln(CAST(tf AS DOUBLE))) * coalesce(idf, unseen) AS v FROM c LEFT JOIN i ON i.term = c.term, n),
  l AS (SELECT path, pos, bool_or(head) AS head, sqrt(sum(v * v)) AS length FROM x GROUP BY path, pos),
  dots AS (SELECT path, pos, license, template, sum(v * unit) AS dot FROM x JOIN u ON u.term = x.term WHERE pos[1] = 's' OR template >= {license_scan.FIRST_BLOCK} GROUP BY path, pos, license, template),
  z AS (SELECT path, pos, head, license, round(dot / length, 6) AS score FROM dots JOIN l USING (path, pos)),
  best AS (SELECT * FROM z WHERE score >= {license_scan.MIN_SCORE} QUALIFY row_number() OVER (PARTITION BY path, pos ORDER BY score DESC, license) = 1),
  own AS (SELECT path, first(license ORDER BY score DESC, license) AS license, max(score) AS score, bool_or(head) AS head, regexp_replace(path, '/?[^/]*$', '') AS dir FROM best GROUP BY path),
  given AS (SELECT * FROM own WHERE head QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, path) = 1),
  r AS (SELECT f.doc_id, f.path, o.license AS lic, o.score AS sc, g.license AS glic, g.score AS gsc, g.path AS gpath
    FROM f LEFT JOIN own o ON o.path = f.path LEFT JOIN given g ON g.dir = '' OR starts_with(f.path, g.dir || '/')
    QUALIFY row_number() OVER (PARTITION BY f.doc_id ORDER BY length(g.dir) DESC NULLS LAST) = 1)
SELECT doc_id, path, coalesce(lic, glic) AS license, coalesce(sc, gsc) AS score, CASE WHEN lic IS NOT NULL THEN 'own' WHEN glic IS NOT NULL THEN 'inherited' END AS origin,
  CASE WHEN lic IS NOT NULL THEN path ELSE gpath END AS from_path FROM r
""")
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source / thousands of the id / twenties of the id / id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    parts = [F.col("source"), F.expr("doc_id div 1000"), F.expr("doc_id div 20"), F.col("doc_id")]
    files = docs.withColumn("path", F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    found = license_scan.scan_licenses(files)
    return files.select("doc_id", "path").join(found, "path").select("doc_id", "path", "license", "score", "origin", "from_path")


@query()
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
  g AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.dedup_in_batches(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", hex_of("digest").alias("text_sha256"))


@query()
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "block_score")


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
  s AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d),
  q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
  t AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, CAST(len(ts) AS BIGINT) AS n, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
  w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, s GROUP BY term, n_docs),
  i AS (SELECT doc_id, t.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS impact FROM t JOIN w ON w.term = t.term, s),
  r AS (SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM q JOIN i ON i.term = q.term GROUP BY item_id, doc_id HAVING sum(impact) > 0),
  k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM r)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
""")
def op11_pair_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item as a query against all documents."""
    return pair_maxscore.search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op12_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.nearest_neighbours(table(spark, sf_dir, "embeddings"))


@query()
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.token_alignment(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
