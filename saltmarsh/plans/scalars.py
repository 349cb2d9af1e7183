"""Scalar functions: text, dates, numbers, arrays, JSON."""

from pyspark.sql import functions as F

from ..functions import dates, numbers, text
from ..functions.numbers import tidy
from ..operators import scale
from ..operators.aggregate import equal_width_bin
from ..operators.stats import quantile_values
from ..sources import table, use_all_slots
from .aggregations import bin_sql
from .registry import query, rnd

STOP_WORDS = "the of and to in a is that it for de la der die le und et en".split()  # fixed values
BAD_WORDS = ["license", "password", "error"]  # fixed values
TIERS = {5: ["the", "and"], 4: ["der", "die"], 3: ["que", "la"], 2: ["les", "des"]}  # fixed values
WORDS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"


@query("text_normalize", r"""
SELECT doc_id, md5(regexp_replace(replace(lower(text), chr(160), ' '), '[^\p{L}\p{N}_\s]', '', 'g')) AS digest,
  length(regexp_replace(replace(lower(text), chr(160), ' '), '[^\p{L}\p{N}_\s]', '', 'g')) AS n FROM documents""")
def text_normalize(spark, sf):
    clean = text.text_normalize(F.col("text"))
    return use_all_slots(table(spark, sf, "documents")).select("doc_id", F.md5(clean).alias("digest"), F.length(clean).alias("n"))


@query("hhmm_to_minutes", "SELECT event_id, hour(ts) * 60 + minute(ts) AS minutes FROM events")
def hhmm_to_minutes(spark, sf):
    hhmm = F.date_format("ts", "HHmm")
    return table(spark, sf, "events").select("event_id", dates.hhmm_to_minutes(hhmm).alias("minutes"))


@query("hhmm_to_hour", "SELECT event_id, strftime(ts, '%H') AS hour FROM events")
def hhmm_to_hour(spark, sf):
    return table(spark, sf, "events").select("event_id", dates.hhmm_to_hour(F.date_format("ts", "HHmm")).alias("hour"))


@query("tag_cleanup", "SELECT doc_id, source || ' ' || lang AS tags FROM documents")
def tag_cleanup(spark, sf):
    raw = F.concat(F.lit("<"), "source", F.lit("><"), "lang", F.lit(">"))
    return table(spark, sf, "documents").select("doc_id", text.tag_cleanup(raw).alias("tags"))


@query("split_count", "SELECT doc_id, len(string_split(trim(text), ',')) AS n FROM documents")
def split_count(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.split_count(F.col("text")).alias("n"))


@query("list_contains_score", f"""
SELECT doc_id, CASE WHEN list_has_any({WORDS_SQL}, ['license', 'password', 'error']) THEN 1 ELSE 5 END AS score FROM documents""")
def list_contains_score(spark, sf):
    return use_all_slots(table(spark, sf, "documents")).select("doc_id", text.list_contains_score(text.words(F.col("text")), BAD_WORDS).alias("score"))


@query("tiered_tag_score", f"""
SELECT doc_id, CASE WHEN list_has_any(w, ['the', 'and']) THEN 5 WHEN list_has_any(w, ['der', 'die']) THEN 4 WHEN list_has_any(w, ['que', 'la']) THEN 3
  WHEN list_has_any(w, ['les', 'des']) THEN 2 ELSE 1 END AS score FROM (SELECT doc_id, {WORDS_SQL} AS w FROM documents)""")
def tiered_tag_score(spark, sf):
    return use_all_slots(table(spark, sf, "documents")).select("doc_id", text.tiered_tag_score(text.words(F.col("text")), TIERS).alias("score"))


@query("map_value", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 5 WHEN 'O' THEN 3 END AS score FROM orders")
def map_value(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", numbers.map_value(F.col("o_orderstatus"), {"F": 5, "O": 3}).alias("score"))


@query("cut_fixed", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 0 AND l_quantity <= 3 THEN 5 WHEN l_quantity > 3 AND l_quantity <= 5 THEN 4
  WHEN l_quantity > 5 AND l_quantity <= 7 THEN 3 WHEN l_quantity > 7 AND l_quantity <= 10 THEN 2 WHEN l_quantity > 10 AND l_quantity <= 45 THEN 1 END AS score FROM lineitem""")
def cut_fixed(spark, sf):
    score = numbers.cut_fixed(F.col("l_quantity"), [0, 3, 5, 7, 10, 45], [5, 4, 3, 2, 1])
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", score.alias("score"))


@query("cut_equal_width", f"WITH {bin_sql(50)} SELECT o_orderkey, bin FROM b")
def cut_equal_width(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", equal_width_bin(orders, "o_totalprice", 50).alias("bin"))


@query("cut_quantile", """
WITH q AS (SELECT quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS e FROM orders)
SELECT o_orderkey, CAST(1 + len(list_filter(e, lambda x: o_totalprice > x)) AS INTEGER) AS quartile FROM orders, q""")
def cut_quantile(spark, sf):
    orders = table(spark, sf, "orders")
    edges = quantile_values(orders, "o_totalprice", [0, 0.25, 0.5, 0.75, 1])
    return orders.select("o_orderkey", numbers.cut_edges(F.col("o_totalprice"), edges).alias("quartile"))


@query("log_scale", f"""
SELECT s_suppkey, {rnd('CASE WHEN s_acctbal > 0 THEN log10(s_acctbal) END')} AS log10_balance, {rnd('ln(1 + greatest(s_acctbal, 0))')} AS log1p_balance FROM supplier""")
def log_scale(spark, sf):
    x = F.col("s_acctbal")
    return table(spark, sf, "supplier").select("s_suppkey", tidy(numbers.log10_positive(x), 6).alias("log10_balance"),
                                               tidy(F.log1p(F.greatest(x, F.lit(0.0))), 6).alias("log1p_balance"))


@query("poly_features", f"""
SELECT l_orderkey, l_linenumber, {rnd('pow(l_quantity, 2)', 4)} AS "l_quantity_DEG2", {rnd('pow(l_quantity, 3)', 4)} AS "l_quantity_DEG3",
  {rnd('pow(l_tax, 2)', 6)} AS "l_tax_DEG2", {rnd('pow(l_tax, 3)', 8)} AS "l_tax_DEG3", 1 AS intercept FROM lineitem""")
def poly_features(spark, sf):
    p = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *numbers.powers("l_quantity", 3), *numbers.powers("l_tax", 3))
    return p.select("l_orderkey", "l_linenumber", tidy("l_quantity_DEG2", 4).alias("l_quantity_DEG2"), tidy("l_quantity_DEG3", 4).alias("l_quantity_DEG3"),
                    tidy("l_tax_DEG2", 6).alias("l_tax_DEG2"), tidy("l_tax_DEG3", 8).alias("l_tax_DEG3"), F.lit(1).alias("intercept"))


@query("poly_cross_terms", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"{rnd(f'{a} * {b}')} AS {a}_x_{b}" for i, a in enumerate(["l_quantity", "l_discount", "l_tax"]) for b in ["l_quantity", "l_discount", "l_tax"][i:]) + " FROM lineitem")
def poly_cross_terms(spark, sf):
    terms = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *numbers.cross_terms(["l_quantity", "l_discount", "l_tax"]))
    return terms.select("l_orderkey", "l_linenumber", *[tidy(c, 6).alias(c) for c in terms.columns[2:]])


LAMBDAS = [i / 10 for i in range(-20, 21)]


@query("boxcox", f"""
WITH s AS (SELECT abs(min(o_totalprice)) + 1 AS shift FROM orders), x AS (SELECT o_orderkey, o_totalprice + shift AS x FROM orders, s),
g AS (SELECT CAST(unnest(range(-20, 21)) AS DOUBLE) / 10 AS lam), l AS (SELECT lam, -count(*) / 2.0 * ln(var_pop(CASE WHEN lam = 0 THEN ln(x) ELSE (pow(x, lam) - 1) / lam END)) + (lam - 1) * sum(ln(x)) AS llf FROM x, g GROUP BY lam),
b AS (SELECT arg_max(lam, llf) AS lam FROM l)
SELECT o_orderkey, {rnd('lam', 2)} AS lam, {rnd('CASE WHEN lam = 0 THEN ln(x) ELSE (pow(x, lam) - 1) / lam END', 4)} AS transformed, {rnd('x - shift', 2)} AS restored FROM x, b, s""")
def boxcox(spark, sf):
    """Transformed price and its inverse, which gives the price back."""
    t = scale.boxcox_transform(use_all_slots(table(spark, sf, "orders").select("o_orderkey", "o_totalprice")), "o_totalprice", LAMBDAS, "y")
    back = numbers.boxcox_inverse(F.col("y"), F.col("lam")) - F.col("shift")
    return t.select("o_orderkey", tidy("lam", 2).alias("lam"), tidy("y", 4).alias("transformed"), tidy(back, 2).alias("restored"))


@query("clip_upper", "SELECT l_orderkey, l_linenumber, CAST(least(l_linenumber, 3) AS INTEGER) AS capped FROM lineitem")
def clip_upper(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.least("l_linenumber", F.lit(3)).alias("capped"))


@query("month_trunc", "SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month FROM orders")
def month_trunc(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.date_format(dates.month_trunc(F.col("o_orderdate")), "yyyy-MM-dd").alias("month"))


@query("months_since", f"""
SELECT o_orderkey, {rnd('greatest((epoch((SELECT max(o_orderdate) FROM orders)) - epoch(o_orderdate)) / (86400 * 30.436875::DOUBLE), 1)')} AS months FROM orders""")
def months_since(spark, sf):
    orders = table(spark, sf, "orders")
    last = orders.agg(F.max("o_orderdate").alias("m")).scalar()
    return orders.select("o_orderkey", tidy(dates.months_between_instants(F.col("o_orderdate"), last), 6).alias("months"))


HTML_SQL = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<script[^>]*>.*?</script>', ' ', 'gis'),
  '<style[^>]*>.*?</style>', ' ', 'gis'), '<!--.*?-->', ' ', 'gs'), '<[^>]*>', ' ', 'gs')"""
for _entity, _char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
    HTML_SQL = f"replace({HTML_SQL}, '{_entity}', '{_char}')"
HTML_SQL = rf"trim(regexp_replace({HTML_SQL}, '[ \t\r\n]+', ' ', 'g'))"


@query("html_to_text", f"SELECT page_id, length(t) AS n, md5(t) AS digest FROM (SELECT page_id, {HTML_SQL} AS t FROM pages)")
def html_to_text(spark, sf):
    clean = use_all_slots(table(spark, sf, "pages")).select("page_id", text.html_to_text(F.col("html")).alias("t"))
    return clean.select("page_id", F.length("t").alias("n"), F.md5("t").alias("digest"))


@query("concat_text", "SELECT page_id, md5(url || '. ' || html) AS digest, 'page: ' || page_id AS label FROM pages")
def concat_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(text.concat_title_body(F.col("url"), F.col("html"))).alias("digest"),
                                            F.concat(F.lit("page: "), F.col("page_id").cast("string")).alias("label"))


@query("tokenize_counts", r"""
SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+')) AS token FROM documents) GROUP BY 1""")
def tokenize_counts(spark, sf):
    tokens = use_all_slots(table(spark, sf, "documents")).select(F.explode(text.tokens(F.col("text"))).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


@query("word_counts_without_stop_words", f"""
SELECT word, count(*) AS n FROM (SELECT unnest({WORDS_SQL}) AS word FROM documents) WHERE word NOT IN ({', '.join(f"'{w}'" for w in STOP_WORDS)}) GROUP BY 1""")
def word_counts_without_stop_words(spark, sf):
    words = use_all_slots(table(spark, sf, "documents")).select(F.explode(text.words(F.col("text"))).alias("word"))
    return words.where(~F.col("word").isin(STOP_WORDS)).groupBy("word").agg(F.count("*").alias("n"))


@query("parse_list_string", f"""
SELECT event_id, {rnd('value', 2)} AS u1, CAST(user_id AS DOUBLE) AS u2, CAST(event_id AS DOUBLE) AS u3, {rnd('value * 2', 4)} AS u4, CAST(length(event_type) AS DOUBLE) AS u5 FROM events""")
def parse_list_string(spark, sf):
    packed = F.concat(F.lit("["), F.concat_ws(", ", *[c.cast("string") for c in (
        F.col("value"), F.col("user_id"), F.col("event_id"), F.col("value") * 2, F.length("event_type"))]), F.lit("]"))
    events = table(spark, sf, "events").select("event_id", packed.alias("scores"))
    u = text.parse_list_string(F.col("scores"), 5)
    return events.select("event_id", tidy(u[0], 2).alias("u1"), u[1].alias("u2"), u[2].alias("u3"), tidy(u[3], 4).alias("u4"), u[4].alias("u5"))


OPTIONS = {"click": [0.1, 0.2, 0.3], "view": [1.0, 2.0], "purchase": [5.0, 6.0, 7.0, 8.0], "error": [9.0], "signup": [0.5, 0.25]}  # fixed values


@query("decode_params", "SELECT event_id, event_type, CASE event_type " + " ".join(
    f"WHEN '{k}' THEN CAST(list_extract({v}, CAST(user_id % 4 + 1 AS BIGINT)) AS DOUBLE)" for k, v in OPTIONS.items()) + " END AS value FROM events")
def decode_params(spark, sf):
    """Value at an index in the option list of the row's key; an index past the list gives null."""
    options = F.create_map(*[x for k, v in OPTIONS.items() for x in (F.lit(k), F.array(*[F.lit(o) for o in v]))])
    return table(spark, sf, "events").select("event_id", "event_type", F.get(
        F.try_element_at(options, F.col("event_type")), (F.col("user_id") % 4).cast("int")).alias("value"))


@query("path_label", r"""
SELECT page_id, list_extract(p, 1) AS host, list_extract(p, 2) AS label FROM (
  SELECT page_id, string_split(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://', ''), '/') AS p FROM pages)""")
def path_label(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select("page_id", text.path_part(url, 1).alias("host"), text.path_part(url, 2).alias("label"))


@query("json_field", "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events")
def json_field(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("json_result", """
SELECT event_type, '[' || string_agg('{"day":"' || d || '","n":' || n || '}', ',' ORDER BY d) || ']' AS result FROM (
  SELECT event_type, strftime(ts, '%Y-%m-%d') AS d, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1""")
def json_result(spark, sf):
    """Daily counts per type as one JSON text; one entry per day."""
    daily = table(spark, sf, "events").groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))
    return daily.groupBy("event_type").agg(F.to_json(F.sort_array(F.collect_list(F.struct("day", "n")))).alias("result"))


@query("sigmoid", f"SELECT event_id, {rnd('1 / (1 + exp(-(0.02::DOUBLE * value - 1)))')} AS p FROM events")
def sigmoid(spark, sf):
    return table(spark, sf, "events").select("event_id", tidy(numbers.sigmoid(0.02 * F.col("value") - 1), 6).alias("p"))


FILL_SQL = "WITH t AS (SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


def with_gaps(spark, sf):
    return table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")


@query("fill_constant", FILL_SQL + " SELECT doc_id, coalesce(quality, -999) AS quality, coalesce(toxic, -999) AS toxic FROM t")
def fill_constant(spark, sf):
    return with_gaps(spark, sf).na.fill(-999, subset=["quality", "toxic"])


@query("fill_mean", FILL_SQL + f" SELECT doc_id, {rnd('coalesce(quality, (SELECT avg(quality) FROM t))')} AS quality, {rnd('coalesce(toxic, (SELECT avg(toxic) FROM t))')} AS toxic FROM t")
def fill_mean(spark, sf):
    filled = scale.fill_mean(with_gaps(spark, sf), ["quality", "toxic"])
    return filled.select("doc_id", tidy("quality", 6).alias("quality"), tidy("toxic", 6).alias("toxic"))


@query("fill_median", FILL_SQL + f" SELECT doc_id, {rnd('coalesce(quality, (SELECT quantile_cont(quality, 0.5) FROM t))')} AS quality, {rnd('coalesce(toxic, (SELECT quantile_cont(toxic, 0.5) FROM t))')} AS toxic FROM t")
def fill_median(spark, sf):
    filled = scale.fill_median(with_gaps(spark, sf), ["quality", "toxic"])
    return filled.select("doc_id", tidy("quality", 6).alias("quality"), tidy("toxic", 6).alias("toxic"))


@query("blend_rowwise", f"""
SELECT l_orderkey, l_linenumber, {rnd('(l_quantity / 50 + l_discount * 10 + l_tax * 12.5::DOUBLE) / 3')} AS mean_score,
  {rnd('list_median([l_quantity / 50, l_discount * 10, l_tax * 12.5::DOUBLE])')} AS median_score FROM lineitem""")
def blend_rowwise(spark, sf):
    scores = [F.col("l_quantity") / 50, F.col("l_discount") * 10, F.col("l_tax") * 12.5]
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", tidy(numbers.row_mean(scores), 6).alias("mean_score"),
                                               tidy(numbers.row_median(scores), 6).alias("median_score"))


@query("array_top_k", f"""
SELECT vec_id, r AS rank, i AS position, {rnd('v')} AS value FROM (SELECT vec_id, i, v, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, i) AS r FROM (
  SELECT vec_id, unnest(embedding) AS v, CAST(unnest(range(64)) AS INTEGER) AS i FROM embeddings)) WHERE r <= 5""")
def array_top_k(spark, sf):
    """Five largest components with their positions, sorted inside the row."""
    pairs = F.transform("embedding", lambda v, i: F.struct((-v).alias("neg"), i.alias("i")))
    top = table(spark, sf, "embeddings").select("vec_id", F.posexplode(F.slice(F.array_sort(pairs), 1, 5)).alias("r", "x"))
    return top.select("vec_id", (F.col("r") + 1).alias("rank"), F.col("x.i").alias("position"), tidy(-F.col("x.neg"), 6).alias("value"))


@query("nonzero_labels", r"""
SELECT doc_id, concat_ws(',', CASE WHEN text LIKE '%the%' THEN 'english' END, CASE WHEN text LIKE '%der%' THEN 'german' END,
  CASE WHEN text LIKE '%que%' THEN 'romance' END, CASE WHEN n_chars > 1000 THEN 'long' END) AS labels FROM documents""")
def nonzero_labels(spark, sf):
    flags = F.array(*[F.struct(F.lit(n).alias("name"), c.cast("int").alias("v")) for n, c in (
        ("english", F.col("text").contains("the")), ("german", F.col("text").contains("der")),
        ("romance", F.col("text").contains("que")), ("long", F.col("n_chars") > 1000))])
    names = F.transform(F.filter(flags, lambda s: s["v"] > 0), lambda s: s["name"])
    return table(spark, sf, "documents").select("doc_id", F.array_join(names, ",").alias("labels"))
