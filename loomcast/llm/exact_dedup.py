"""Exact duplicates by content-defined chunk recipes, with DataFrame functions only.

A text is cut where its content says so, each chunk gets an identifier, and two texts
are equal exactly if their ordered identifier lists (recipes) are. A chunk's text
moves once, for the proof that its identifier names one text; whole documents never do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import free_name, keep, one_space

#: A chunk ends after the first sentence end past the least size, at the latest at the
#: largest size, or with the text.
LEAST, MOST = 512, 4096
#: Bytes up to which the tags of the rows that go are broadcast.
BROADCAST_BYTES = 32 << 20


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The content-defined chunks of a text, in order; joined they give the text."""
    ends = rf"(?s).{{{least},{most}}}?(?<=[.!?;] )|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(ends), F.lit(0))


def identifier(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_sha256 and recipe (list of chunk identifiers) of every row."""
    norm = docs.select(F.col(id_col).alias("doc_id"), one_space(F.col(text_col)).alias("_norm"))
    return norm.select(
        "doc_id",
        F.sha2("_norm", 256).alias("text_sha256"),
        F.transform(chunks(F.col("_norm")), identifier).alias("recipe"),
    )


def chunk_store(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Each distinct chunk once: id and chunk. Repeats are dropped before they move."""
    norm = docs.select(one_space(F.col(text_col)).alias("_norm"))
    cut = norm.select(F.explode(chunks(F.col("_norm"))).alias("chunk"))
    return cut.select(identifier(F.col("chunk")).alias("id"), "chunk").distinct()


def unverified(store: DataFrame) -> DataFrame:
    """Identifiers that stand for more than one chunk text."""
    return store.groupBy("id").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space became one space.
    Null text counts as empty, so null and empty texts (and no others) form a group; white
    space alone is the text of one space. The smallest doc_id of a group stays; rows
    that share this doc_id all count as kept. A null doc_id is kept only where its group
    has no other. Other columns are ignored, whatever their names. An empty table gives
    an empty result. Raises if an identifier should ever stand for two chunk texts.
    """
    if not unverified(chunk_store(docs, text_col)).isEmpty():
        raise RuntimeError("two different chunks have the same identifier")
    listed = keep(recipes(docs, id_col, text_col), "recipes")
    groups = keep(
        listed.groupBy("recipe")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1"),
        "recipe-groups",
    )
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return listed.join(groups, "recipe", "left").select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were.

    One row stays of each group of equal texts: one with the group's smallest id (a null id
    only where the group has no other), of several such rows the first in the table. Only
    row tags, ids and digests move to find the rows that go. These are broadcast up to
    ``BROADCAST_BYTES``, so that no document moves; more of them are joined by one shuffle.
    A row goes only where its tag and its text's hash agree, so a table that is read in
    another order the second time loses no document.
    """
    if not unverified(chunk_store(docs, text_col)).isEmpty():
        raise RuntimeError("two different chunks have the same identifier")
    row = free_name(docs, "row")
    tagged = docs.withColumn(row, F.monotonically_increasing_id())
    who = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row"), F.xxhash64(text_col).alias("hash"))
    listed = keep(recipes(tagged.select(who.alias("who"), F.col(text_col).alias("text")), "who", "text").drop("text_sha256"), "recipe-rows")
    first = listed.groupBy("recipe").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    gone = listed.join(keep(first, "recipe-first"), "recipe").filter(F.col("doc_id.row") != F.col("first.row"))
    gone = keep(gone.select(F.col("doc_id.row").alias("_gone_row"), F.col("doc_id.hash").alias("_gone_hash")), "copies")
    if gone.count() * 32 <= BROADCAST_BYTES:
        gone = F.broadcast(gone)
    same = (tagged[row] == gone["_gone_row"]) & (F.xxhash64(tagged[text_col]) == gone["_gone_hash"])
    return tagged.join(gone, same, "left_anti").drop(row)
