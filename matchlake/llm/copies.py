"""Exact duplicates: a Bloom filter finds what may be repeated, and only that is shuffled.

DataFrame functions only. Every text becomes its digest, once. The first pass counts hashed
digests in a filter and keeps the places that were hit more than once; the second pass asks the
filter about every row. Rows that hit a place nobody else has hit are alone and go straight to the
result. The others are grouped by their exact digest, so a wrong guess of the filter costs a
shuffled row and never a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm import sketch
from matchlake.llm.common import Scratch, pack, replace_columns

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MADE = ["keep_id", "group_size", "kept", "text_sha256"]


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed; NULL is the empty text."""
    text = F.coalesce(text, F.lit(""))
    # a text of single bytes has no other letters, and the built-in function is faster
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def exact_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
    pages_mb: int = sketch.PAGES_MB,
    hot_rows: int = sketch.HOT_ROWS,
) -> DataFrame:
    """``docs`` with keep_id, group_size, kept and text_sha256 of the lower-cased text.

    Texts are equal when they are identical after A-Z is lower-cased; NULL and empty texts are equal.
    Of each group exactly one row stays, that of the largest id; NULL ids come after all others,
    and rows of one id are told apart by their place in the input, so of repeated rows one stays
    too. ``keep_id`` is NULL where all ids of a group are. An empty table gives an empty result.
    Columns of ``docs`` named like a result column are replaced. Only the columns of ``carry`` (all
    by default) are moved and written. ``pages_mb`` bounds the filter in every task; with more rows
    than it suits (about 64 million at 128 MB) more rows are shuffled and the result stays the same.
    """
    scratch = Scratch(docs.sparkSession, "copies")
    text = lower_ascii(F.col(f"`{text_col}`").cast("string"))
    hashed = docs.select(
        pack(docs.select(*[f"`{x}`" for x in carry]) if carry else docs),
        F.col(f"`{id_col}`").alias("_id"),
        F.monotonically_increasing_id().alias("_at"),
        F.unhex(F.sha2(text, 256)).alias("_hash"),
    )
    rows = scratch.save(hashed, "rows")
    length = sketch.row_length(rows.count(), pages_mb)
    pages = sketch.repeated_pages(rows, ["_hash"], length, scratch, "filter")
    asked = sketch.flag_repeated(rows, ["_hash"], pages, length, "_repeated")

    alone = asked.filter(~F.col("_repeated")).select(
        "*", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    some = asked.filter("_repeated")
    best = F.max(F.struct("_id", "_at"))
    groups = scratch.save(
        some.groupBy("_hash").agg(best.alias("_best"), F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "groups"
    )
    facts = groups.withColumn("_size", F.col("_n"))
    found = sketch.attach(some, facts, ["_hash"], "_n", hot_rows=hot_rows)
    grouped = found.select(
        *asked.columns,
        F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_best._id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("_at") == F.col("_best._at"), F.lit(True)).alias("kept"),
    )
    result = alone.unionByName(grouped).withColumn("text_sha256", F.lower(F.hex("_hash")))
    return replace_columns(result, "_row", MADE)


def copies_table(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256; carries nothing but the id."""
    return exact_copies(docs, carry=["doc_id"]).select("doc_id", *MADE)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every group of equal texts, all columns as they were."""
    marked = exact_copies(docs.select(pack(docs, "_doc"), f"`{id_col}`", f"`{text_col}`"), id_col, text_col, ["_doc"])
    return marked.filter("kept").select("_doc.*")
