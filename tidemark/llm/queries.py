"""The operators of this package over the benchmark tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    archives,
    collocations,
    line_dedup,
    line_frequency,
    mixing,
    near_dup,
    nearest,
    packing,
    quality,
    resampling,
    substring_dedup,
    token_counts,
    vector_dup,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL that defines its result where there is one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 ids."""
    path = public_tokenizers.path("word_bpe_49k.json")
    packed = packing.pack(_table(spark, sf_dir, "documents"), path)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query()
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.taken_words(mixing.mix(_table(spark, sf_dir, "documents")))


LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS place, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL)
), solid AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS bare FROM lines
  WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''
), windows AS (
  SELECT * FROM (
    SELECT doc_id, place, bare AS one, lead(place, 1) OVER w AS place2, lead(bare, 1) OVER w AS two,
           lead(place, 2) OVER w AS place3, lead(bare, 2) OVER w AS three
    FROM solid WINDOW w AS (PARTITION BY doc_id ORDER BY place)
  ) WHERE place3 IS NOT NULL
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY one, two, three ORDER BY doc_id, place) AS nth FROM windows
), gone AS (
  SELECT DISTINCT doc_id, unnest([place, place2, place3]) AS place FROM placed WHERE nth > 1
), kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.place) AS n_removed,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.place) FILTER (WHERE g.place IS NULL), '') AS text
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.place = g.place GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(k.text) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


@query(LINES_SQL)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated runs of three lines."""
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


WARC_SQL = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), coded AS (
  SELECT page_id, payload_bytes, list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> CAST(5 * (3 - i % 4) AS INTEGER)) & 31 AS BIGINT), 1)
  ), 'string_agg', '') AS payload_digest FROM hashed
), top AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM coded
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM top
"""


@query(WARC_SQL)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through ARC and WARC files."""
    rows = archives.archive_pages(_table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


UPPER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "123456789"

RULES_SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row_no, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), lines AS (
  SELECT row_no, source, unnest(string_split(t, chr(10))) AS line FROM texts
), solid AS (
  SELECT row_no, source, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), normal AS (
  SELECT row_no, source, line, len(w) AS n,
         translate(array_to_string(w, ' '), '{UPPER}{DIGITS}', '{UPPER.lower()}{"0" * len(DIGITS)}') AS key
  FROM solid
), repeats AS (
  SELECT row_no, count(*) - count(DISTINCT line) AS n_dup_lines FROM normal GROUP BY row_no
), windows AS (
  SELECT row_no, i, count(*) OVER (PARTITION BY row_no, key) AS n
  FROM (SELECT row_no, unnest(range(1, len(w) - 1)) AS i,
               unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS key
        FROM texts WHERE len(w) >= 3)
), covered AS (
  SELECT row_no, count(DISTINCT i) AS n_repeat_words
  FROM (SELECT row_no, unnest([i, i + 1, i + 2]) AS i FROM windows WHERE n > 1) GROUP BY row_no
), hosts AS (
  SELECT source, count(*) AS n_docs FROM documents GROUP BY source
), frequent AS (
  SELECT n.source, key FROM normal n JOIN hosts h ON n.source IS NOT DISTINCT FROM h.source
  GROUP BY n.source, key, n_docs
  HAVING count(DISTINCT row_no) >= {line_frequency.LEAST_DOCUMENTS} AND count(DISTINCT row_no) > {line_frequency.MOST_SHARE} * n_docs
), removed AS (
  SELECT row_no, CAST(sum(n) AS BIGINT) AS n_removed_words
  FROM normal n JOIN frequent f ON n.key = f.key AND n.source IS NOT DISTINCT FROM f.source GROUP BY row_no
), told AS (
  SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_removed_words, 0) AS n_removed_words,
         len(w) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w) AS base_failed
  FROM texts LEFT JOIN repeats USING (row_no) LEFT JOIN covered USING (row_no) LEFT JOIN removed USING (row_no)
)
SELECT *, NOT base_failed AND n_removed_words <= {line_frequency.MOST_REMOVED} * n_words AS kept FROM told
"""


@query(RULES_SQL)
def op6_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdicts of all documents."""
    judged = line_frequency.judge_lines(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *line_frequency.MEASURES, "base_failed", "kept", "n_removed_words")


@query()
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance and verdict of all documents."""
    return quality.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and tokens of all documents."""
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


TOP_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(d.v AS DOUBLE[])) AS BIGINT) AS score
  FROM whole q JOIN whole d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query(TOP_SQL)
def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector."""
    return nearest.top_k(_table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


NEAR_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)
), reach AS (
  SELECT doc_id AS node, doc_id AS least FROM documents
  UNION
  SELECT l.dst, r.least FROM reach r JOIN (SELECT a AS src, b AS dst FROM links UNION ALL SELECT b, a FROM links) l
    ON r.node = l.src
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT node, min(least) AS component_id FROM reach GROUP BY node) c ON c.node = d.doc_id
"""


@query(NEAR_SQL)
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents, on four-word shingles."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), size=4)


SUBSTRING_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 12], ' ')) AS key
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)
), first AS (
  SELECT key, min(doc_id) AS doc_id FROM windows GROUP BY key HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT windows.doc_id, unnest(range(i, i + 13)) AS i
  FROM windows JOIN first USING (key) WHERE windows.doc_id > first.doc_id
), listed AS (
  SELECT doc_id, list(i) AS places FROM gone GROUP BY doc_id
), kept AS (
  SELECT words.doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
         list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: places IS NULL OR NOT list_contains(places, x[2])) AS k
  FROM words LEFT JOIN listed USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(list_transform(k, lambda x: x[1]), ' '), '')) AS kept_sha256
FROM kept
"""


@query(SUBSTRING_SQL)
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of earlier documents' windows."""
    kept = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


VECTOR_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
  SELECT vec_id AS node, vec_id AS least FROM embeddings
  UNION
  SELECT b, least FROM reach JOIN links ON node = a
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN counts ON vec_id = a
JOIN (SELECT node, min(least) AS component_id FROM reach GROUP BY node) ON node = vec_id
"""


@query(VECTOR_SQL)
def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors, within labels."""
    return vector_dup.near_vectors(_table(spark, sf_dir, "embeddings"))


RESAMPLE_SQL = r"""
WITH RECURSIVE crcs AS (
  SELECT list(crc ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, bit: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END)) AS crc
    FROM (SELECT unnest(range(256)) AS i))
), texts AS (
  SELECT 'raw' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT 'target', item_id, text FROM benchmark
), words AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
), runs AS (
  SELECT side, id, w[i] AS f FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM words)
  UNION ALL
  SELECT side, id, w[i] || ' ' || w[i + 1] FROM (SELECT *, unnest(range(1, len(w))) AS i FROM words)
  UNION ALL
  SELECT side, id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM words)
), counted AS (
  SELECT side, id, f, count(*) AS n FROM runs GROUP BY ALL
), hexed AS (
  SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)
), bytes AS (
  SELECT f, list_transform(range(0, strlen(h) // 2), lambda i:
           16 * (strpos('123456789ABCDEF', h[2 * i + 1])) + strpos('123456789ABCDEF', h[2 * i + 2])) AS b
  FROM hexed
), placed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, crc[xor(c & 255, x) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, crcs
), buckets AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'raw'), 0) AS s, coalesce(sum(n) FILTER (WHERE side = 'target'), 0) AS t
  FROM counted JOIN placed USING (f) GROUP BY bucket
), totals AS (
  SELECT sum(s) AS s_all, sum(t) AS t_all FROM buckets
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM buckets, totals
), weights AS (
  SELECT id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight
  FROM counted JOIN placed USING (f) JOIN gains USING (bucket) WHERE side = 'raw' GROUP BY id
), scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents JOIN words ON side = 'raw' AND id = doc_id LEFT JOIN weights ON weights.id = doc_id
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""


@query(RESAMPLE_SQL)
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance of all documents for the benchmark, and the draw of a twentieth."""
    drawn = resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


PHRASE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), placed AS (
  SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words)
), one AS (
  SELECT lang, x, count(*) AS f, sum(count(*)) OVER (PARTITION BY lang) AS n FROM placed GROUP BY lang, x
), two AS (
  SELECT lang, x, y, count(*) AS f FROM placed WHERE y IS NOT NULL GROUP BY lang, x, y HAVING count(*) >= 10
), three AS (
  SELECT lang, x, y, z, count(*) AS f FROM placed WHERE z IS NOT NULL GROUP BY lang, x, y, z HAVING count(*) >= 10
), longer AS (
  SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM three UNION ALL SELECT lang, y, z, f FROM three) GROUP BY lang, x, y
), cuts AS (
  SELECT c.lang, c.x || ' ' || c.y AS phrase, 1 AS k, c.f AS a, p.f AS l, q.f AS r, p.n
  FROM two c JOIN one p ON p.lang = c.lang AND p.x = c.x JOIN one q ON q.lang = c.lang AND q.x = c.y
  LEFT JOIN longer g ON g.lang = c.lang AND g.x = c.x AND g.y = c.y WHERE g.f IS NULL OR 100 * g.f < 50 * c.f
  UNION ALL
  SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, 1, c.f, p.f, q.f, p.n
  FROM three c JOIN one p ON p.lang = c.lang AND p.x = c.x JOIN two q ON q.lang = c.lang AND q.x = c.y AND q.y = c.z
  UNION ALL
  SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, 2, c.f, p.f, q.f, q.n
  FROM three c JOIN two p ON p.lang = c.lang AND p.x = c.x AND p.y = c.y JOIN one q ON q.lang = c.lang AND q.x = c.z
), scored AS (
  SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM lowest QUALIFY rank <= 2000
"""


@query(PHRASE_SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language of all documents."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))
