"""I-Match fingerprints: hashes of the terms that randomised lexicons keep; DataFrame functions only.

The lexicon is the terms whose share of the documents lies in a band: frequent ones say nothing, rare ones
are changed by every slip of the pen. A text's distinct lexicon terms, sorted, are hashed once as a whole,
and once per family of randomised lexicons. The families split the lexicon by a hash of the term; inside a
family each lexicon holds a random half of the one before it. A text uses the last lexicon of a family
that still keeps one of its terms, so few terms decide each hash whatever the length of the text. The
likeness of two fingerprints is the share of families, among those that keep a term of either text, whose
hashes agree.

A term is known by its 64-bit hash, and sorted by it. The lexicon goes to all workers: a term in a share s
of N documents takes s * N of the postings, so there are at most 1/s times as many terms as a document has
on average (1000 times, whatever N). Texts move once, to the rows of their documents, and the first quarter
of each moves to the document before it; terms stay in the task where their text is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import previous_value
from .shared import attach, stored

#: inverse share of documents between which a term is kept: idf from ln 4 to ln 1000
COMMON, RARE = 4, 1000
FAMILIES = 64
#: a text with fewer than a third of its terms in the lexicon is fingerprinted on all its terms
ENOUGH = 3
NOT_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_STOP = 1 << 30


def terms(text: Column) -> Column:
    """Hashes of the distinct words (runs of letters, digits and all non-ASCII characters, in lower case)."""
    words = F.filter(F.split(F.lower(text), NOT_WORDS), lambda w: w != "")
    return F.transform(F.array_distinct(words), lambda w: F.xxhash64(w))


def lexicon(texts: DataFrame, common: int = COMMON, rare: int = RARE) -> DataFrame:
    """Hashes (h) of the terms in two documents at least and in a share from 1/rare to 1/common of all."""
    n = texts.agg(F.count("*").alias("n")).scalar()
    seen = texts.select(F.explode(terms(F.col("text"))).alias("h")).groupBy("h").agg(F.count("*").alias("df"))
    return seen.where((F.col("df") > 1) & (F.col("df") * rare >= n) & (F.col("df") * common <= n)).select("h")


def _level(h: Column) -> Column:
    """How many lexicons of its family keep the term: trailing zeros of thirty bits of its hash."""
    x = F.shiftrightunsigned(h, 6).bitwiseAND(_STOP - 1).bitwiseOR(_STOP)
    return F.bit_count(x.bitwiseXOR(x - 1))


def signatures(kept: Column) -> Column:
    """Per family a hash of the terms that its last lexicon in use keeps, null where no lexicon keeps any."""
    eight = F.sequence(F.lit(0), F.lit(7))
    coarse = F.transform(eight, lambda i: F.filter(kept, lambda h: F.shiftright(h, 3).bitwiseAND(7) == i))
    fine = F.flatten(F.transform(coarse, lambda part: F.transform(eight, lambda j: F.filter(part, lambda h: h.bitwiseAND(7) == j))))
    last = F.transform(fine, lambda part: F.struct(part.alias("part"), F.array_max(F.transform(part, _level)).alias("level")))
    return F.transform(last, lambda x: F.when(F.size(x["part"]) > 0, F.xxhash64(
        F.filter(x["part"], lambda h: _level(h) == x["level"])).bitwiseAND(0xFFFF).cast("int")))


def likeness(a: Column, b: Column) -> Column:
    """Share of the families in use whose hashes agree; 1 if neither text has a term."""
    same = F.zip_with(a, b, lambda x, y: F.when(x.isNotNull() | y.isNotNull(), F.coalesce(x == y, F.lit(False))))
    used = F.filter(same, lambda s: s.isNotNull())
    return F.when(F.size(used) == 0, 1.0).otherwise(F.size(F.filter(used, lambda s: s)) / F.size(used).cast("double"))


def as_text(whole: Column, lanes: Column) -> Column:
    """Fingerprint as text: the hash of all kept terms, then four digits per family."""
    return F.concat(F.lpad(F.lower(F.hex(whole)), 16, "0"), F.lit(":"), F.array_join(F.transform(
        lanes, lambda x: F.coalesce(F.lpad(F.lower(F.hex(x)), 4, "0"), F.lit("----"))), ""))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A null text counts as empty. The edited text has its last floor(n_chars / 4) code points replaced by the
    first as many (or all) of the next document in ascending doc_id order; the last document is followed by
    the first, a null doc_id comes before all others, and different texts of one doc_id are ordered by
    digest. Rows that are equal in doc_id and text count as one document in that order and get equal results
    (in the lexicon they count one by one). Texts without a word share one fingerprint. Other columns are ignored.
    """
    some = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    named = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("null"))
    digest = F.unhex(F.substring(F.sha2(F.concat(named, F.lit(":"), F.sha2("text", 256)), 256), 1, 32))
    keyed = some.select(digest.alias("key"), "doc_id", "text")
    known = stored(lexicon(some), "lexicon")

    order = keyed.groupBy("key", "doc_id", F.length("text").alias("n")).agg(F.count("*").alias("copies"))
    order = previous_value(order, [], [F.col("doc_id").desc_nulls_last(), F.desc("key")], "key", None, "next_key")
    first = order.agg(F.min_by("key", F.struct("doc_id", "key"))).scalar()
    order = order.select("key", "copies", F.coalesce("next_key", first).alias("next_key"), (F.col("n") / 4).cast("int").alias("quarter"))

    # one struct, so that both readers ask for the same columns and share one shuffle of the texts
    rows = keyed.groupBy("key").agg(F.first(F.struct("doc_id", "text")).alias("own"))
    heads = order.join(rows.select(F.col("key").alias("next_key"), F.col("own").alias("next")), "next_key").select(
        "key", F.expr("left(next.text, quarter)").alias("head"), "quarter", "copies")
    both = rows.join(heads, "key").select("key", "own.doc_id", "own.text", "copies", F.length("own.text").cast("long").alias("n_chars"),
                                          F.concat(F.expr("left(own.text, length(own.text) - quarter)"), "head").alias("edited"))
    row = F.struct("doc_id", "copies", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    none, no_row = F.lit(None).cast("long"), F.lit(None).cast("struct<doc_id:%s,copies:bigint,n_chars:bigint,edited_sha256:string>"
                                                              % some.schema["doc_id"].dataType.simpleString())
    entry = lambda side, h, r: F.struct(F.lit(side).alias("side"), h.alias("h"), r.alias("row"))
    sides = both.withColumn("t1", terms(F.col("text"))).withColumn("t2", terms(F.col("edited")))
    entries = sides.select("key", F.explode(F.concat(
        F.array(entry(0, none, row)), F.transform(F.array_intersect("t1", "t2"), lambda h: entry(3, h, no_row)),
        F.transform(F.array_except("t1", "t2"), lambda h: entry(1, h, no_row)),
        F.transform(F.array_except("t2", "t1"), lambda h: entry(2, h, no_row)))).alias("e")).select("key", "e.side", "e.h", "e.row")
    entries = entries.join(F.broadcast(known.withColumn("known", F.lit(True))), "h", "left")
    lists = [F.sort_array(F.collect_list(F.when((F.col("side").bitwiseAND(side) != 0) & (F.col("known") if band else F.lit(True)), F.col("h")))).alias(f"{name}{side}")
             for side in (1, 2) for name, band in (("all", False), ("band", True))]
    texts = entries.groupBy("key").agg(F.first("row", ignorenulls=True).alias("row"), *lists)
    for side in (1, 2):
        texts = texts.withColumn(f"kept{side}", F.when(F.size(f"band{side}") * ENOUGH >= F.size(f"all{side}"), F.col(f"band{side}")).otherwise(F.col(f"all{side}")))
    prints = stored(texts.select("key", "row.*", *[c for side in (1, 2) for c in (
        F.xxhash64(f"kept{side}").alias(f"whole{side}"), signatures(F.col(f"kept{side}")).alias(f"lanes{side}"))]), "fingerprints")

    after = prints.select(F.col("key").alias("next_key"), F.col("lanes1").alias("lanes_next"))
    pairs = order.select("key", "next_key").join(after, "next_key").select("key", "lanes_next")
    done = stored(prints.join(pairs, "key").select(
        "key", "copies", "doc_id", "n_chars", "edited_sha256", as_text(F.col("whole1"), F.col("lanes1")).alias("fingerprint"),
        as_text(F.col("whole2"), F.col("lanes2")).alias("edited_fingerprint"), likeness(F.col("lanes1"), F.col("lanes2")).alias("near_edited"),
        likeness(F.col("lanes1"), F.col("lanes_next")).alias("near_next")), "document-fingerprints")
    out = attach(keyed.select("key", F.monotonically_increasing_id().alias("at")), done, "key", "copies", spread="at")
    return out.drop("key", "at", "copies")
