"""Encodings and scaling."""

from pyspark.sql import functions as F

from ..functions import text
from ..functions.numbers import tidy
from ..operators import encode, scale
from ..sources import table, use_all_slots
from .registry import query, rnd
from .scalars import WORDS_SQL


@query("one_hot", """
SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS "o_orderstatus_F", CAST(o_orderstatus = 'O' AS INTEGER) AS "o_orderstatus_O",
  CAST(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus_P", 0 AS "o_orderstatus_X" FROM orders""")
def one_hot(spark, sf):
    """``X`` was seen when the encoder was fitted but is absent here."""
    return encode.one_hot(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O", "P", "X"]).drop("o_orderstatus")


VOCABULARY = ["the", "der", "que", "les", "license"]  # fixed values


@query("multi_hot", "SELECT doc_id, " + ", ".join(f"CAST(list_contains(w, '{v}') AS INTEGER) AS has_{v}" for v in VOCABULARY)
       + f" FROM (SELECT doc_id, {WORDS_SQL} AS w FROM documents)")
def multi_hot(spark, sf):
    docs = use_all_slots(table(spark, sf, "documents")).select("doc_id", text.words(F.col("text")).alias("w"))
    return encode.multi_hot(docs, F.col("w"), VOCABULARY, "has").drop("w")


@query("merge_multi_hot", """
SELECT doc_id, CAST(coalesce(list_contains(t, 'de'), false) AS INTEGER) AS is_de, CAST(coalesce(list_contains(t, 'en'), false) AS INTEGER) AS is_en,
  CAST(coalesce(list_contains(t, 'src3'), false) AS INTEGER) AS is_src3 FROM (
  SELECT doc_id, CASE WHEN quality IS NOT NULL THEN [lang, source] END AS t FROM documents LEFT JOIN labels USING (doc_id))""")
def merge_multi_hot(spark, sf):
    """Language, source and label merged; a missing label makes the whole list null and all bits zero."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source").join(
        table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("quality")), "doc_id", "left")
    merged = docs.select("doc_id", encode.merged_items([F.col("lang"), F.col("source"), F.col("quality")]).alias("t"))
    return encode.multi_hot(merged, F.col("t"), ["de", "en", "src3"], "is").drop("t")


@query("bag_of_words", r"""
WITH t AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS word FROM documents) GROUP BY 1, 2),
v AS (SELECT word FROM t GROUP BY 1 HAVING count(*) >= (SELECT count(*) FROM documents) * 0.05::DOUBLE)
SELECT doc_id, word, n FROM t WHERE word IN (SELECT word FROM v)""")
def bag_of_words(spark, sf):
    words = text.words(F.col("text"), r"[\p{L}\p{N}_]{2,}")
    return encode.bag_of_words(use_all_slots(table(spark, sf, "documents").select("doc_id", "text")), "doc_id", words, min_df=0.05).select("doc_id", "word", "n")


@query("bag_of_words_presence", r"""
WITH t AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> '' GROUP BY 1, 2),
v AS (SELECT word FROM t GROUP BY 1 ORDER BY sum(n) DESC, word LIMIT 200) SELECT doc_id, word, 1 AS present FROM t WHERE word IN (SELECT word FROM v)""")
def bag_of_words_presence(spark, sf):
    """Presence bits of the 200 most frequent space-separated words."""
    words = F.filter(F.split("text", " "), lambda w: w != "")
    bag = encode.bag_of_words(use_all_slots(table(spark, sf, "documents").select("doc_id", "text")), "doc_id", words, max_features=200)
    return bag.select("doc_id", "word", F.lit(1).alias("present"))


@query("rare_to_other", """
WITH c AS (SELECT p_name, count(*) AS n FROM part GROUP BY 1), k AS (SELECT p_name, sum(n) OVER (ORDER BY n DESC, p_name ROWS UNBOUNDED PRECEDING) / CAST((SELECT count(*) FROM part) AS DOUBLE) * 100 AS cum FROM c)
SELECT p_partkey, CASE WHEN cum < 80 THEN p_name ELSE 'OTHERS' END AS name FROM part JOIN k USING (p_name)""")
def rare_to_other(spark, sf):
    return encode.rare_to_other(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", 80, "name").select("p_partkey", "name")


@query("label_index", """
SELECT event_id, event_type, code FROM events JOIN (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS code FROM (SELECT DISTINCT event_type FROM events)) USING (event_type)""")
def label_index(spark, sf):
    return encode.label_index(table(spark, sf, "events").select("event_id", "event_type"), "event_type").select("event_id", "event_type", "code")


SCALED = ["l_quantity", "l_extendedprice", "l_discount"]


@query("standard_scale", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    rnd(f"({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem)") + f" AS {c}" for c in SCALED) + " FROM lineitem")
def standard_scale(spark, sf):
    scaled = scale.standard_scale(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *SCALED), SCALED)
    return scaled.select("l_orderkey", "l_linenumber", *[tidy(c, 6).alias(c) for c in SCALED])


@query("minmax_scale", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    rnd(f"({c} - (SELECT min({c}) FROM lineitem)) / (SELECT max({c}) - min({c}) FROM lineitem)") + f" AS {c}" for c in SCALED) + " FROM lineitem")
def minmax_scale(spark, sf):
    scaled = scale.minmax_scale(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *SCALED), SCALED)
    return scaled.select("l_orderkey", "l_linenumber", *[tidy(c, 6).alias(c) for c in SCALED])
