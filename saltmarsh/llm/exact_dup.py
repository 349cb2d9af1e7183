"""Exact duplicates by recipes of content-defined chunks; DataFrame functions only.

A normalised text is cut where its content says so: past a minimum length, behind the first place that
fits a fixed pattern of neighbouring characters, at a maximum length at the latest. An insertion moves
the cuts near it and no others. Chunks are stored once: distinct (SHA-256, chunk text) pairs are
compared, and a digest with two texts ends the run, so an identifier stands for one text. A document is
then the ordered list of its identifiers (its recipe). Texts are equal when their recipes are; long
texts themselves never move, only their distinct chunks do, once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ascii_lower, attach, stored

MIN_CHUNK, MAX_CHUNK = 256, 4096
#: fixed pattern of the five characters around a cut, one place in some hundreds of running text
CUT = r"[02468acegikmoqsuwy.,;:!?][ \n][0-3a-f][^aeiou\s]\S"


def chunks_of(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """The chunks of a text in order; joined they give the text again. An empty text has none."""
    pattern = rf"(?s).{{{least},{most - 5}}}?{CUT}|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_chunks.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty, and empty texts
    are equal to each other. The row with the largest id of a group stays. Rows that repeat an id count
    one by one in ``group_size``, and all rows with the id that stays are kept; an id of null is smaller than
    any other and is kept only in a group without other ids. Other columns of ``docs`` are ignored.
    """
    norm = docs.select(docs[id_col].alias("doc_id"), ascii_lower(docs[text_col]).alias("__text"))
    pieces = norm.select(F.explode(chunks_of(F.col("__text"))).alias("chunk"))
    pieces = pieces.select(F.unhex(F.sha2("chunk", 256)).alias("chunk_id"), "chunk").distinct()
    clash = pieces.groupBy("chunk_id").agg(F.count("*").alias("texts")).where("texts > 1")
    if clash.take(1):
        raise RuntimeError("two chunk texts share a SHA-256; identifiers can't be trusted")

    recipes = stored(norm.select(
        "doc_id", F.sha2("__text", 256).alias("text_sha256"),
        F.transform(chunks_of(F.col("__text")), lambda c: F.unhex(F.sha2(c, 256))).alias("recipe")), "recipes")
    recipe_key = F.sha2(F.array_join(F.transform("recipe", lambda c: F.hex(c)), ","), 256)
    groups = recipes.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = stored(groups.select(recipe_key.alias("recipe_key"), "keep_id", "group_size"), "recipe-groups")
    rows = recipes.select("doc_id", "text_sha256", F.size("recipe").alias("n_chunks"), recipe_key.alias("recipe_key"))
    out = attach(rows, groups, "recipe_key", "group_size", spread="doc_id")
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      "text_sha256", "n_chunks")
