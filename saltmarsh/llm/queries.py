"""Registered queries: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from .exact_dup import exact_duplicates
from .imatch import fingerprints
from .licenses import license_notices
from .lines import without_repeated_lines
from .mixing import schedule
from .near_dup import near_duplicates
from .passages import repeated_passages
from .phrases import collocations
from .quality import resample
from .registry import ORACLES, QUERIES, query
from .shared import LOWER, UPPER
from .token_files import token_round_trip
from .tokens import encode_documents
from .value_codes import ENTRIES, PARTS, coded_vectors
from .vectors import near_vectors

__all__ = ["ORACLES", "QUERIES"]

NORMAL = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
BLANK_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query("op6_exact_dedup", f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, {NORMAL} AS t FROM documents) WINDOW w AS (PARTITION BY t)""")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).drop("n_chunks")


LINES_SQL = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, translate(trim(line, {BLANK_SQL}), '{UPPER}', '{LOWER}') AS k FROM lines),
repeats AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT doc_id, i, line, coalesce(doc_id < last, false) AS gone FROM keyed LEFT JOIN repeats USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS kept_text
FROM marked GROUP BY doc_id"""


@query("op10_line_dedup", f"SELECT doc_id, n_lines, n_dropped, sha256(kept_text) AS kept_sha256 FROM ({LINES_SQL})")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                      F.col("__sha").alias("kept_sha256"))


MIX_WEIGHTS = {"src0": 240} | {f"src{i}": 40 for i in range(1, 20)}
_NAMES = sorted(f"={n}" for n in MIX_WEIGHTS)
_SHARES = [MIX_WEIGHTS[n[1:]] for n in _NAMES]
MIX_SQL = f"""
WITH RECURSIVE sched(t, done, pick) AS (
  SELECT -1, list_transform(range({len(_NAMES)}), lambda x: 0), -1
  UNION ALL
  SELECT t + 1, list_transform(done, lambda d, i: d + CASE WHEN i - 1 = p THEN 1 ELSE 0 END), p FROM (
    SELECT t, done, (list_min(list_filter(list_transform(range({len(_NAMES)}), lambda x:
      CASE WHEN done[x + 1] < k[x + 1] AND (done[x + 1] * {sum(_SHARES)}) // k[x + 1] <= t + 1
           THEN (((done[x + 1] + 1) * {sum(_SHARES)} + k[x + 1] - 1) // k[x + 1]) * 1000 + x END), lambda y: y IS NOT NULL))) % 1000 AS p
    FROM (SELECT *, {_SHARES} AS k FROM sched) WHERE t < {sum(_SHARES) - 1})),
period AS (SELECT t AS slot, {_NAMES}[pick + 1] AS name, {_SHARES}[pick + 1] AS weight,
                  row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS k FROM sched WHERE t >= 0),
share AS (SELECT DISTINCT name, weight FROM period),
rows AS (SELECT doc_id, CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END AS name FROM documents),
placed AS (SELECT doc_id, name, weight, (row_number() OVER (PARTITION BY name ORDER BY md5('mix:' || doc_id), doc_id) - 1) AS i
           FROM rows JOIN share USING (name)),
ends AS (SELECT name, weight, (coalesce(n, 0) + 15) // 16 AS missing FROM share LEFT JOIN (SELECT name, count(*) AS n FROM placed GROUP BY name) USING (name)),
horizon AS (SELECT min(slot + (missing // ends.weight) * {sum(_SHARES)}) AS h FROM ends JOIN period ON period.name = ends.name AND k = missing % ends.weight),
slots AS (SELECT doc_id, placed.name, i // 16 AS block, i % 16 AS place, slot + ((i // 16) // placed.weight) * {sum(_SHARES)} AS slot
          FROM placed JOIN period ON period.name = placed.name AND k = (i // 16) % placed.weight)
SELECT doc_id, name, CAST(block AS BIGINT) AS block, CAST(place AS BIGINT) AS place, CAST(slot AS BIGINT) AS slot, slot < h AS in_mix FROM slots, horizon
UNION ALL SELECT doc_id, name, NULL, NULL, NULL, false FROM rows WHERE name NOT IN (SELECT name FROM share)"""


@query("op2_mix_sources", MIX_SQL)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule(table(spark, sf_dir, "documents"), {f"={n}": w for n, w in MIX_WEIGHTS.items()})


@query("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_round_trip(table(spark, sf_dir, "documents"))


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_bpe")
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))


@query("op1_minhash_near_dedup")
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_license_scan")
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_notices(table(spark, sf_dir, "documents"))


COSINE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CASE WHEN embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                       AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN CAST(embedding AS DOUBLE[]) END AS e FROM embeddings),
pairs AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
links AS (SELECT x, count(*) AS n FROM pairs GROUP BY x)
SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN least ON least.x = v.vec_id LEFT JOIN links ON links.x = v.vec_id"""


@query("op9_embedding_near_dedup", COSINE_SQL)
def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op3_passage_dedup")
def op3_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


PHRASE_SQL = r"""
WITH pieces AS MATERIALIZED (
  SELECT row_number() OVER () AS piece, lang, string_split(replace(p, chr(9), ' '), ' ') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(%s, '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
words AS MATERIALIZED (SELECT piece, lang, i, word FROM (SELECT piece, lang, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM pieces) WHERE word <> ''),
runs AS MATERIALIZED (SELECT lang, word AS w1, lead(word, 1) OVER p AS w2, lead(word, 2) OVER p AS w3, lead(word, 3) OVER p AS w4
  FROM words WINDOW p AS (PARTITION BY piece ORDER BY i)),
grams AS MATERIALIZED (SELECT lang, k, g, count(*) AS f FROM (
  SELECT lang, 1 AS k, w1 AS g FROM runs UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM runs WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM runs WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM runs WHERE w4 IS NOT NULL) GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, g, k, f AS a, string_split(g, ' ') AS w FROM grams WHERE k > 1 AND f >= 30),
parts AS (SELECT lang, a, array_to_string(w[i : i + m - 1], ' ') AS g FROM cand, (VALUES (1), (2), (3)) s(i), (VALUES (2), (3)) t(m) WHERE m < k AND i + m - 1 <= k),
inside AS MATERIALIZED (SELECT DISTINCT s.lang, s.g FROM cand s JOIN parts b USING (lang, g) WHERE 100 * b.a >= 80 * s.a),
cuts AS (SELECT c.lang, c.g, c.a, t.c AS cut, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
         FROM cand c ANTI JOIN inside USING (lang, g) JOIN (VALUES (1), (2), (3)) t(c) ON t.c < c.k
         JOIN grams x ON x.lang = c.lang AND x.g = array_to_string(c.w[1 : t.c], ' ')
         JOIN grams y ON y.lang = c.lang AND y.g = array_to_string(c.w[t.c + 1 : c.k], ' ')),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) AS pick FROM cuts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM best WHERE pick = 1)
SELECT lang, rank, g AS phrase, a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""" % NORMAL


@query("op11_phrases", PHRASE_SQL)
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents")).drop("path_words")


@query("op12_imatch")
def op12_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def _assigned(book: str) -> str:
    """Nearest entry and its distance per vector and part, from a codebook."""
    return f"""(SELECT vec_id, part, min(d * {ENTRIES} + entry) % {ENTRIES} AS entry, min(d) AS d FROM (
      SELECT vec_id, part, entry, CAST(list_sum(list_transform(range(1, len(p) + 1), lambda j: (p[j] - e[j]) * (p[j] - e[j]))) AS BIGINT) AS d
      FROM parts JOIN {book} b USING (part)) GROUP BY ALL)"""


def _moved(book: str) -> str:
    """The codebook after every used entry went to the floor of the mean of its parts."""
    return f"""(SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM {book} b LEFT JOIN (
      SELECT part, entry, list(v ORDER BY j) AS e FROM (
        SELECT part, entry, j, CAST((s - ((s % c) + c) % c) // c AS BIGINT) AS v FROM (
          SELECT a.part, a.entry, j, sum(p[j]) AS s, count(*) AS c
          FROM {_assigned(book)} a JOIN parts USING (vec_id, part), (SELECT unnest(range(1, (SELECT max(len(p)) FROM parts) + 1)) AS j) GROUP BY ALL))
      GROUP BY ALL) m USING (part, entry))"""


CODES_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, part, v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] AS p
  FROM kept, (SELECT unnest(range({PARTS})) AS part)),
b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, p AS e
  FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES})),
b1 AS MATERIALIZED (SELECT * FROM {_moved("b0")}),
b2 AS MATERIALIZED (SELECT * FROM {_moved("b1")}),
codes AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM {_assigned("b2")} GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes JOIN kept USING (vec_id), digest"""


@query("op13_value_codes", CODES_SQL)
def op13_value_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded_vectors(table(spark, sf_dir, "embeddings"))
